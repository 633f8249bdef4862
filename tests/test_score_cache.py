"""The score cache: what is scored when, and when it gives nothing."""

import os

import pytest
from pyspark.sql import functions as F

from corpusloom import tables
from corpusloom.jobs.score_cache import ScoreCache, version_of


@pytest.fixture
def counted():
    """A scorer that remembers what it was given."""
    seen = []

    def score(rows):
        seen.append(sorted(r.idx for r in rows.select("idx").collect()))
        return rows.withColumn("loss", F.length("text").cast("double")).drop("text")

    return seen, score


def corpus(spark, n=12):
    return spark.createDataFrame([(f"s{k % 3}", k, "x" * k) for k in range(n)], "shard_key string, idx long, text string")


def shards(spark, *keys, digest=None):
    return spark.createDataFrame([(k, digest) for k in keys], "shard_key string, digest string")


def test_only_missing_shards_are_scored(spark, tmp_path, counted):
    seen, score = counted
    cache = ScoreCache(spark, str(tmp_path), "v1", score)
    assert cache.read(shards(spark, "s0")) is None
    cache.update(shards(spark, "s0", "s0"), corpus(spark))
    assert seen == [[0, 3, 6, 9]]
    assert cache.update(shards(spark, "s0"), corpus(spark)).collect() == [] and len(seen) == 1
    assert cache.read(shards(spark, "s0", "s1")) is None
    assert [r.shard_key for r in cache.update(shards(spark, "s0", "s1"), corpus(spark)).collect()] == ["s1"]
    assert seen[1:] == [[1, 4, 7, 10]]
    got = {(r.shard_key, r.idx, r.loss) for r in cache.read(shards(spark, "s0", "s1")).collect()}
    assert got == {(f"s{k % 3}", k, float(k)) for k in range(12) if k % 3 < 2}
    again = ScoreCache(spark, str(tmp_path), "v1", score)
    assert again.read(shards(spark, "s1")).count() == 4 and len(seen) == 2


def test_versions_and_contents(spark, tmp_path, counted):
    """A changed rule or model, or a changed shard, is scored; going back finds the old scores."""
    seen, score = counted
    one = ScoreCache(spark, str(tmp_path), version_of("model", {"rep": 0.2}), score)
    two = ScoreCache(spark, str(tmp_path), version_of("model", {"rep": 0.3}), score)
    one.update(shards(spark, "s0"), corpus(spark))
    assert two.read(shards(spark, "s0")) is None
    two.update(shards(spark, "s0"), corpus(spark))
    assert len(seen) == 2 and one.read(shards(spark, "s0")).count() == 4
    one.update(shards(spark, "s0", digest="new"), corpus(spark, 6))
    assert len(seen) == 3 and one.read(shards(spark, "s0", digest="new")).count() == 2 and one.read(shards(spark, "s0")).count() == 4


def test_a_run_that_broke_off(spark, tmp_path, counted):
    """Scores without an entry in the ledger do not count and are written over."""
    seen, score = counted
    cache = ScoreCache(spark, str(tmp_path), "v1", score)
    cache.update(shards(spark, "s0"), corpus(spark))
    ledger, kept = f"{cache.at}/ledger", str(tmp_path / "aside")
    os.rename(ledger, kept)
    assert cache.read(shards(spark, "s0")) is None
    cache.update(shards(spark, "s0"), corpus(spark))
    assert len(seen) == 2 and cache.read(shards(spark, "s0")).count() == 4


def test_shards_without_rows_and_without_names(spark, tmp_path, counted):
    seen, score = counted
    cache = ScoreCache(spark, str(tmp_path), "v1", score)
    cache.update(shards(spark, "none", "s1", None), corpus(spark))
    assert cache.read(shards(spark, "none", "s1")).count() == 4 and cache.read(shards(spark, "none")).count() == 0
    assert {r.shard_key: r.n_rows for r in cache.ledger().collect()} == {"none": 0, "s1": 4} and len(seen) == 1
    assert cache.update(spark.createDataFrame([], "shard_key string, digest string"), corpus(spark)).collect() == []


def test_kept_tables(spark, tmp_path):
    """Made once for the files as they are, and anew when they change."""
    made = []

    def make():
        made.append(1)
        return spark.read.parquet(f"{tmp_path}/in").select((F.col("id") * 2).alias("x"))

    spark.range(3).write.parquet(f"{tmp_path}/in")
    name = f"t{os.getpid()}"
    for _ in range(2):
        assert sorted(r.x for r in tables.kept(spark, name, f"{tmp_path}/in", make).collect()) == [0, 2, 4]
    assert len(made) == 1
    spark.range(5).write.mode("append").parquet(f"{tmp_path}/in")
    assert tables.kept(spark, name, f"{tmp_path}/in", make).count() == 8 and len(made) == 2
