"""Properties of operators that hold whatever the data."""

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import curriculum, evaluation, packing, records, sampling
from corpusloom.operators.scoring import UnigramScorer


def test_packing_conserves_tokens_in_order(spark):
    rng = random.Random(1)
    docs = [(k * 700, [f"{k}.{i}" for i in range(rng.choice([0, 1, 5, 40, 130]))]) for k in range(60)]
    out = packing.pack_windows(spark.createDataFrame(docs, "doc_id long, ids array<string>"), 16).orderBy("window_id").collect()
    stream = [t for _, ids in docs for t in ids]
    assert [t for r in out for t in r["ids"]] == stream[: len(stream) // 16 * 16]


@pytest.mark.parametrize("total, weights, expected", [(0, [0.5, 0.5], [0, 0]), (1, [0.5, 0.5], [1, 0]), (10, [0.05, 0.95], [1, 9]), (7, [1 / 3] * 3, [3, 2, 2])])
def test_largest_remainder(spark, total, weights, expected):
    rows = [("k", f"s{i}", w, total) for i, w in enumerate(weights)]
    out = sampling.largest_remainder(spark.createDataFrame(rows, "kind string, source string, weight double, total long"), ["kind"], "source")
    assert [r["alloc"] for r in out.orderBy("source").collect()] == expected


def test_uniform_model_loss(spark):
    import math

    docs = spark.createDataFrame([(1, ["a", "b", "c", "d"])], "doc_id long, ids array<string>")
    assert abs(UnigramScorer(docs, "ids").score(docs, "doc_id", "ids").first()["loss"] - math.log(4)) < 1e-12


def test_identical_models_are_rejected(spark):
    loss = spark.createDataFrame([(k, float(k)) for k in range(50)], "doc_id long, loss double")
    diffs = evaluation.paired_differences(loss, loss, "doc_id").withColumn("pos", F.col("doc_id"))
    v = evaluation.verdict(diffs, evaluation.bootstrap_means(spark, diffs, "pos", 20, "s"), 0.01, 0.0025).first()
    assert v["mu_hat"] == 0 and v["lcb"] == 0 and not v["accepted"]


def test_curriculum_sets_are_disjoint(spark):
    rows = [(k, "s", ["easy", "general", "hard", "suspicious"][k % 4]) for k in range(400)]
    out = curriculum.split_curriculum(spark.createDataFrame(rows, "doc_id long, source string, bucket string"), ["doc_id"], ["source"], "x", 40, 100)
    got = out.groupBy("split", "bucket").count().collect()
    n = {(r["split"], r["bucket"]): r["count"] for r in got}
    assert out.count() == out.select("doc_id").distinct().count() and not any(b == "suspicious" for _, b in n)
    assert n["train", "general"] == 60 and n["train", "hard"] == 30 and n["train", "easy"] == 10


def test_idle_limits_are_inclusive(spark):
    rows = [(k, 1, t) for k, t in enumerate(["2024-01-01 00:00:00", "2024-01-01 00:02:59", "2024-01-01 00:05:59", "2024-01-01 00:12:59"])]
    ev = spark.createDataFrame(rows, "event_id long, user_id long, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    out = records.idle_gaps(ev, "user_id", "ts", 180, 420, "event_id").orderBy("event_id").collect()
    assert [r["state"] for r in out] == ["active", "active", "warn", "timeout"]


def test_ancestors_stop_at_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, None)], "node long, parent long")
    out = records.ancestors(spark, edges, spark.createDataFrame([(1,), (4,)], "node long"), 10).collect()
    assert sorted((r["start"], r["node"]) for r in out) == [(1, 1), (1, 2), (1, 3), (4, 4)]


def test_absent_and_null_settings_differ(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "x", "v")], "id long, name string, v string")
    b = spark.createDataFrame([(2, "x", "v")], "id long, name string, v string")
    out = records.lock_violations(a, b, "id", "name", "v", F.col("name")).collect()
    assert [(r["id"], r["first_mismatch"]) for r in out] == [(1, "x")]


def test_offsets_hold_for_any_ids(spark):
    """Dense, sparse, negative and repeated distances between ids; few runs whatever they are."""
    rng = random.Random(4)
    for ids in (range(3000), sorted({rng.randrange(-(1 << 62), 1 << 62) for _ in range(3000)}), [k * k * k for k in range(3000)]):
        rows = [(i, rng.randrange(9), "ab"[k % 2] if k % 5 else None) for k, i in enumerate(ids)]
        out = {(r["i"]): r["offset"] for r in packing.running_offset(spark.createDataFrame(rows, "i long, n long, s string"), "i", "n", ["s"]).collect()}
        at = {"a": 0, "b": 0, None: 0}
        for i, n, s in rows:
            assert out[i] == at[s]
            at[s] += n


def test_exact_quantiles(spark, monkeypatch):
    import numpy as np

    from corpusloom.operators import quantiles as Q

    monkeypatch.setattr(Q, "SMALL", 100)
    monkeypatch.setattr(Q, "ACCURACY", 100)
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=4000), np.zeros(3000), [1e9]])
    rows = [("ab"[k % 2], float(v)) for k, v in enumerate(values)] + [("c", 5.0), ("d", None), (None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    marks = [0.0, 0.1, 0.5, 0.85, 1.0]
    out = {r["g"]: (r["n"], r["q"]) for r in Q.quantiles(df, F.col("x"), marks, ["g"]).collect()}
    for g in "ab":
        mine = [v for k, v in rows if k == g]
        assert out[g][0] == len(mine) and np.allclose(out[g][1], np.quantile(mine, marks), rtol=1e-12)
    assert out["c"] == (1, [5.0] * 5) and out["d"] == (0, [None] * 5) and out[None][1][2] == 1.5
    whole = Q.quantiles(df, F.col("x"), marks).first()
    assert np.allclose(whole["q"], np.quantile([v for _, v in rows if v is not None], marks), rtol=1e-12)


def test_corpus_build_keeps_the_order_of_files(spark, tmp_path):
    from corpusloom.functions.text import QualityRules
    from corpusloom.jobs import corpus

    rules = QualityRules(least_chars=1, least_alpha=0, most_repeat=0, most_url=0, most_navigation=0)
    texts = [[f"f{f}r{r}t{t} x" for t in range(1) for r in range(40)] for f in range(3)]
    for f, rows in enumerate(texts):
        spark.createDataFrame([(t,) for t in rows], "text string").coalesce(1).write.parquet(str(tmp_path / f"in/{f}"))
    listed = corpus.build_corpus(spark, str(tmp_path / "in/*"), str(tmp_path / "out"), 16, 4, 1, rules)
    stream = [t for rows in texts for x in rows for t in [*x.split(), "<end>"]]
    got = spark.read.parquet(str(tmp_path / "out/windows")).orderBy("window_id").collect()
    assert [t for r in got for t in r["ids"]] == stream[: len(stream) // 16 * 16]
    assert {r["split"] for r in listed.collect()} == {"train", "eval"} and sum(r["rows"] for r in listed.collect()) == len(got)


def test_score_and_curate_writes_tokens(spark, tmp_path):
    from corpusloom.jobs import corpus

    rng = random.Random(2)
    rows = [(k, "ab"[k % 2], [f"w{rng.randrange(30)}" for _ in range(rng.randrange(20, 60))]) for k in range(120)]
    out = corpus.score_and_curate(spark.createDataFrame(rows, "doc_id long, source string, ids array<string>"), "doc_id", "source", str(tmp_path), "s", 5, 20).collect()
    of = {k: (s, ids) for k, s, ids in rows}
    assert all((r["source"], r["input_ids"]) == of[r["doc_id"]] for r in out) and len({r["doc_id"] for r in out}) == len(out)
    assert sum(r["split"] == "val" for r in out) == 10


def test_eviction_and_pruning_rules(spark):
    files = spark.createDataFrame([("g", 10, 1, False), ("g", 30, 2, True), ("g", 30, 3, False), ("g", 20, 4, False), ("g", 20, 5, False)], "g string, size long, t long, keep boolean")
    out = records.evictions(files, "g", "size", ["t"], F.lit(100), 0.7, F.col("keep")).orderBy("t").collect()
    assert [r["evict"] for r in out] == [True, False, True, True, False]
    rows = [("g", k, k, state) for k, state in enumerate(["done", "open", "done", "done", "open", "done", "done"])]
    df = spark.createDataFrame(rows, "g string, id long, t long, state string")
    out = records.pruned(df, "g", F.col("state") == "done", "t", "id", F.lit(1), 3).orderBy("id").collect()
    # The first is too old; of the six others three have to go, the oldest finished ones.
    assert [r["drop"] for r in out] == [True, False, True, True, False, True, False]
