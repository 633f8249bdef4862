"""What keeps queries within their limits on large tables: which side is broadcast, how many tasks, how texts are counted."""

import random
import re

from pyspark.sql import functions as F

from corpusloom import rule_queries
from corpusloom.functions.tokens import ngram_repeat_ratio, repeat_ratio, unique_ratio
from corpusloom.operators import curriculum, evaluation, packing
from corpusloom.operators.scoring import UnigramScorer
from corpusloom.sources import array_files


def test_weighted_bootstrap_broadcasts_the_holdout_and_not_the_draws(spark):
    """The holdout comes out of a join that the planner takes for large; broadcasting the draws instead filled the driver."""
    rows = spark.range(40).select(F.col("id").alias("k"), (F.col("id") / 40).alias("lo"), ((F.col("id") + 1) / 40).alias("hi"), F.col("id").cast("double").alias("diff"))
    diffs = rows.join(spark.range(10**9).select(F.col("id").alias("k")), "k").select("diff", "lo", "hi")
    plan = evaluation.weighted_bootstrap_means(spark, diffs, 1000, "s")._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join Inner, .*cell.*rightHint=\(strategy=broadcast\)", plan)


def test_many_small_shards_share_tasks(spark, tmp_path):
    """A task for each file of a few kilobytes took longer than all else."""
    rows = spark.range(1200).select(F.when(F.col("id") < 400, "train").otherwise("eval").alias("split"), F.floor(F.col("id") / 2).alias("shard"), F.col("id").alias("window_id"), F.array(F.col("id").cast("int"), F.lit(7)).alias("ids"))
    path = str(tmp_path / "arrays")
    array_files.write_arrays(rows, path, 2)
    df = array_files.read_arrays(spark, path)
    assert df.rdd.getNumPartitions() == 1
    assert sorted((r.shard_key.rsplit("_", 1)[1], r.row_idx, r.input_ids) for r in df.collect()) == [(f"{k // 2:06d}.npy", k % 2, [k, 7]) for k in range(1200)]
    assert sorted(r.input_ids[0] for r in df.where("row_idx = 1").collect()) == list(range(1, 1200, 2))
    checked = array_files.verify_arrays(spark, path, 2)
    assert checked.rdd.getNumPartitions() < 100 and {r.error for r in checked.collect()} == {None} and checked.count() == 600


def test_equal_texts_have_equal_losses(spark):
    """Sums of doubles in the order of a shuffle told copies apart, which split them at a cut."""
    rng = random.Random(3)
    words = [f"w{rng.randrange(400)}" for _ in range(300)]
    copies = [(k, rng.sample(words, len(words))) for k in range(60)]
    others = [(100 + k, [f"w{int(rng.expovariate(0.01))}" for _ in range(200)]) for k in range(60)]
    rows = spark.createDataFrame(copies + others, "doc_id long, ids array<string>").repartition(7)
    losses = UnigramScorer(rows, "ids").score(rows, "doc_id", "ids").where("doc_id < 100").collect()
    assert len(losses) == 60 and len({r["loss"] for r in losses}) == 1


def test_scores_read_the_texts_once(spark, tmp_path):
    """One reading for losses and measures, beside the one that counts; ratios as the column functions give them."""
    rng = random.Random(4)
    docs = [(k, "s", [rng.choice("abcde") * rng.choice([1, 1, 2]) for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 40]))]) for k in range(80)] + [(80, None, None), (7, "twice", ["a", "b"])]
    spark.createDataFrame(docs, "doc_id long, source string, ids array<string>").write.parquet(str(tmp_path / "texts"))
    rows = spark.read.parquet(str(tmp_path / "texts"))
    out = curriculum.scored_rows(rows, "doc_id")
    assert len(re.findall(r"Scan parquet .*texts|FileScan parquet .*ids", out._jdf.queryExecution().sparkPlan().toString())) == 1
    ids = F.col("ids")
    want = rows.where("size(ids) > 0").select("doc_id", "source", unique_ratio(ids).alias("u"), repeat_ratio(ids).alias("r"), ngram_repeat_ratio(ids).alias("g"))
    assert sorted(map(tuple, out.select("doc_id", "source", "unique_r", "rep_r", "rep_ng4").collect())) == sorted(map(tuple, want.collect()))


def test_ranges_come_from_one_sort(spark):
    """Hash tables of all pairs and of all ranges made a task's memory grow with the table."""
    rng = random.Random(5)
    pairs = [(rng.randrange(6), rng.choice([0, 1000, 5000]) + rng.randrange(300)) for _ in range(400)] + [(9, 5), (9, 5), (8, 1), (8, 65), (8, 130)]
    out = packing.coalesce_ranges(spark.createDataFrame(pairs, "k long, i long"), "k", "i", 64)
    assert "HashAggregate" not in out._jdf.queryExecution().sparkPlan().toString()
    want = []
    for k in {k for k, _ in pairs}:
        held = []
        for i in sorted({i for q, i in pairs if q == k}):
            if held and i - held[-1] > 64:
                want.append((k, held[0], held[-1], len(held)))
                held = []
            held.append(i)
        want.append((k, held[0], held[-1], len(held)))
    assert sorted(map(tuple, out.collect())) == sorted(want)
    odd = spark.createDataFrame([(1, None), (1, 5), (1, None), (2, None)], "k long, i long")
    assert sorted(map(tuple, packing.coalesce_ranges(odd, "k", "i", 64).collect())) == [(1, 5, 5, 2), (2, None, None, 1)]


def test_models_of_a_sweep_are_counted_once(spark):
    """The counts of all models were made anew, from the texts, wherever they were read."""
    docs = spark.createDataFrame([(1, "en", ["a", "b", "a"]), (2, "de", ["a"]), (3, None, ["c", "c"]), (4, "en", ["x"]), (5, "en", None)], "doc_id long, lang string, ids array<string>")
    counts, totals = rule_queries._config_counts(docs, docs.where("doc_id = 4"))
    assert "Generate" not in counts._jdf.queryExecution().sparkPlan().toString()
    assert sorted(map(tuple, counts.select("config", "tok", "c").collect())) == [("all", "a", 3), ("all", "b", 1), ("all", "c", 2), ("de", "a", 1), ("en", "a", 2), ("en", "b", 1)]
    assert sorted(map(tuple, totals.collect())) == [("all", 6, 3), ("de", 1, 1), ("en", 3, 2)]
