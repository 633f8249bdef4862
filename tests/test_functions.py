"""Measures and rules on inline rows whose results are known."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import parsing as P
from corpusloom.functions import text as T
from corpusloom.functions.tokens import ngram_repeat_ratio, repeat_ratio, suspicious, unique_ratio
from corpusloom.operators import records


def one(spark, column, **values):
    names = list(values)
    return spark.range(1).select(*(F.lit(values[n]).alias(n) for n in names)).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, reason",
    [
        (None, "empty"), ("", "empty"), ("   \n ", "too_short"), ("short", "too_short"),
        ("1234567890 " * 30, "low_alpha_ratio"), ("a" * 300, "high_repeat_ratio"),
        ("ab cd " * 30 + " https://example.org/" + "qwerty" * 10, "high_url_density"),
        ("menu navigation " * 20, "navigation_boilerplate"), ("the quick brown fox jumps " * 20, None),
    ],
)
def test_first_failing_rule(spark, text, reason):
    row = spark.createDataFrame([(text,)], "t string").select(T.reject_reason(F.col("t")).alias("r")).first()
    assert row["r"] == reason


def test_repetition_of_short_windows(spark):
    rows = [([],), (["a"],), (["a", "a", "a"],), (["a", "b", "c", "d"],), (["a", "b"] * 4,)]
    c = F.col("ids")
    out = spark.createDataFrame(rows, "ids array<string>").select(unique_ratio(c).alias("u"), repeat_ratio(c).alias("r"), ngram_repeat_ratio(c).alias("g")).collect()
    assert [tuple(round(v, 4) for v in x) for x in out] == [(0, 0, 0), (1, 0, 0), (0.3333, 1, 0), (1, 0, 0), (0.25, 0, 0.6)]


def test_losses_that_are_no_numbers_are_suspicious(spark):
    rows = [(float("nan"),), (float("inf"),), (float("-inf"),), (None,), (1.0,)]
    s = suspicious(F.col("x"), F.lit(0.5), F.lit(0.0), F.lit(0.0))
    assert [r["s"] for r in spark.createDataFrame(rows, "x double").select(s.alias("s")).collect()] == [True] * 4 + [False]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("prefetch exceeded; timeout", (False, "prefetch_exhausted")), ("Eval server error: timeout", (False, "eval_server_reported")),
        ("request timed out after timeout", (True, "timed out")), ("HTTP 502", (True, "502")), ("bad config", (False, "")),
    ],
)
def test_error_classes(spark, text, expected):
    a, b = records.classify_error(F.lit(text))
    assert tuple(spark.range(1).select(a.alias("a"), b.alias("b")).first()) == expected


def test_reveals(spark):
    digest, key = "sha256:" + "0a" * 32, "5" * 48
    good = f"v4|me/model|{digest}|{key}"
    rows = [(good,), (f" {good} ",), (f"v3|me/model|{digest}|{key}",), (f"v4|me|{digest}|{key}",), (f"v4|me/model|xyz|{key}",), (f"v4|me/model|{digest}|0{key[1:]}",), ("",), (None,)]
    out = spark.createDataFrame(rows, "p string").select(P.parse_reveal(F.col("p")).alias("r")).collect()
    assert [r["r"] is not None for r in out] == [True, True] + [False] * 6 and out[0]["r"]["repo"] == "me/model"


def test_sweep_specs(spark):
    rows = [("R64:a128:lr1e-4:d0.05:e0.8",), (" r8:a8:lr0.001 ",), ("r8:a8",), ("",), (None,)]
    c = F.col("t")
    out = spark.createDataFrame(rows, "t string").select(P.parse_spec(c).alias("p"), P.configuration(F.lit(None), c).alias("q")).collect()
    assert tuple(out[0]["p"]) == (64, 128, 1e-4, 0.05, 0.8) and tuple(out[1]["p"]) == (8, 8, 0.001, 0.0, 0.5)
    assert [r["p"] for r in out[2:]] == [None] * 3 and out[2]["q"] is None and out[3]["q"]["r"] == out[4]["q"]["a"] == 64


@pytest.mark.parametrize("x, text", [(5e-5, "5e-05"), (0.0001, "0.0001"), (1.5, "1.5"), (0.0, "0"), (1234567.0, "1.23457e+06"), (100000.0, "100000"), (-2e-7, "-2e-07")])
def test_general_numbers(spark, x, text):
    assert one(spark, P.general(F.col("v")), v=x) == text


def test_commitments(spark):
    rows = [("\x0cabc",), ("0x0c616263",), ("0x0d00616263",), ("0x0e000000616263ff",), ("",), (None,)]
    out = spark.createDataFrame(rows, "p string").select(P.commitment_text(F.col("p")).alias("t")).collect()
    assert [r["t"] for r in out] == ["abc"] * 4 + [None, None]


def test_token_shards_round_trip(spark, tmp_path):
    from corpusloom.sources.array_files import ArrayFile, store_of
    from corpusloom.sources.token_shards import read_token_shards

    flat, matrix = np.arange(23, dtype="<u4"), np.arange(12, dtype="<u4").reshape(3, 4)
    np.save(tmp_path / "a.npy", flat)
    np.save(tmp_path / "b.npy", matrix)
    rows = read_token_shards(spark, str(tmp_path), 4).orderBy("shard_key", "row_idx").collect()
    assert [list(r["input_ids"]) for r in rows] == flat[:20].reshape(5, 4).tolist() + matrix.tolist()
    np.save(tmp_path / "c.npy", np.arange(3, dtype="<i8"))
    with pytest.raises(ValueError):
        ArrayFile.of(*store_of(str(tmp_path / "c.npy")), (tmp_path / "c.npy").stat().st_size, 4)


def test_manifest_dialects(spark, tmp_path):
    from corpusloom.sources.token_shards import read_manifest

    (tmp_path / "m.json").write_text('{"version": "v3", "shards": [{"key": "b", "num_tokens": 7, "bytes": 28, "split": "eval"}, {"key": "a", "num_tokens": 9, "bytes": 36, "split": "train"}]}')
    assert [(r["key"], r["n_tokens"], r["size_bytes"], r["split"]) for r in read_manifest(spark, str(tmp_path / "m.json")).collect()] == [("a", 9, 36, "train"), ("b", 7, 28, "eval")]


def test_manifests_without_lists(spark, tmp_path):
    from corpusloom.sources.token_shards import read_json_lines, read_manifest, read_texts

    (tmp_path / "m.json").write_text('{"version": "v3"}')
    (tmp_path / "e.json").write_text('{"version": "v3", "shards": []}')
    assert read_manifest(spark, str(tmp_path / "m.json")).count() == read_manifest(spark, str(tmp_path / "e.json")).count() == 0
    spark.createDataFrame([(1, "a"), (2, ""), (3, None)], "n int, body string").coalesce(1).write.parquet(str(tmp_path / "files"))
    listed = read_manifest(spark, str(tmp_path / "m.json"), str(tmp_path / "files")).collect()
    assert len(listed) == 1 and listed[0]["key"].endswith(".parquet") and listed[0]["size_bytes"] > 0
    assert [r["text"] for r in read_texts(spark, str(tmp_path / "files")).collect()] == ["a"]
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\nbroken {\n{"a": 2}\n')
    assert sorted(r["a"] for r in read_json_lines(spark, str(tmp_path / "x.jsonl"), "a int").collect()) == [1, 2]


def test_package_is_shipped(spark):
    import zipfile

    from pyspark import SparkFiles

    from corpusloom.session import ship

    ship(spark)
    assert "corpusloom/operators/packing.py" in zipfile.ZipFile(SparkFiles.get("corpusloom.zip")).namelist()
