"""Token arrays: planned ranges, pushed filters, ranged fetches, and the sink's two phases."""

import hashlib
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.sources import array_files as A


@pytest.fixture
def shards(tmp_path):
    rng = np.random.default_rng(1)
    made = {"a": rng.integers(0, 50000, (300, 8), dtype="<u4"), "b": rng.integers(0, 50000, 8 * 40 + 5, dtype="<u4"), "c": rng.integers(0, 9, (0, 8), dtype="<u4")}
    for name, x in made.items():
        np.save(tmp_path / f"{name}.npy", x)
    (tmp_path / "_temporary").mkdir()
    np.save(tmp_path / "_temporary" / "left.npy", made["a"])
    rows = [(f"{tmp_path}/a.npy", k, r.tolist()) for k, r in enumerate(made["a"])]
    rows += [(f"{tmp_path}/b.npy", k, r.tolist()) for k, r in enumerate(made["b"][:320].reshape(-1, 8))]
    return str(tmp_path), rows


def collected(df):
    return sorted((r.shard_key, r.row_idx, list(r.input_ids)) for r in df.collect())


@pytest.mark.parametrize("partition_bytes, batch_bytes", [(64 << 20, 4 << 20), (320, 96), (1, 1)])
def test_rows_whatever_the_split(spark, shards, partition_bytes, batch_bytes):
    df = A.read_arrays(spark, shards[0], 8, partition_bytes=partition_bytes, batch_bytes=batch_bytes)
    assert collected(df) == shards[1]
    assert df.rdd.getNumPartitions() == {64 << 20: 2, 320: 34, 1: 340}[partition_bytes]


@pytest.mark.parametrize("condition", [
    "row_idx >= 290", "row_idx > 38 and row_idx <= 41", "row_idx in (3, 5, 70, 299)", "row_idx = 7", "row_idx = 7 and row_idx in (7, 8)", "row_idx < 3 and size(input_ids) = 8",
    "shard_key like '%b.npy' and row_idx < 2", "row_idx < 0", "row_idx in (1, 2) or row_idx = 299",
])
def test_filters(spark, shards, condition):
    want = collected(spark.createDataFrame(shards[1], A.SCHEMA).where(condition))
    assert collected(A.read_arrays(spark, shards[0], 8).where(condition)) == want


def test_filters_reach_the_plan(shards):
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, Not

    reader = A.ArrayReader({"path": shards[0], "length": "8"})
    left = Not(EqualTo(("row_idx",), 1))
    assert list(reader.pushFilters([EqualTo(("shard_key",), f"{shards[0]}/a.npy"), GreaterThanOrEqual(("row_idx",), 5), In(("row_idx",), (2, 9, 20, 200)), left])) == [left]
    assert [(p.low, p.high) for p in reader.partitions()] == [(9, 21), (200, 201)]


def test_a_shard_of_production_size_is_planned_from_its_header(spark, tmp_path):
    """2 GiB and its header in a sparse file; only wanted rows are read."""
    rows, length = 262_144, 2048
    path = tmp_path / "big.npy"
    head = A.header_bytes("<u4", (rows, length))
    with path.open("wb") as f:
        f.write(head)
        f.truncate(len(head) + 4 * rows * length)
        f.seek(len(head) + 4 * length * 200_001)
        f.write(np.arange(length, dtype="<u4").tobytes())
    reader = A.ArrayReader({"path": str(path)})
    assert len(reader.partitions()) == 32 and path.stat().st_size > 2**31
    got = A.read_arrays(spark, str(path)).where("row_idx between 200000 and 200002").orderBy("row_idx").collect()
    assert [sum(r.input_ids) for r in got] == [0, length * (length - 1) // 2, 0]
    assert np.load(path, mmap_mode="r").shape == (rows, length)


def test_fetch_wanted_rows(spark, shards):
    wanted = [(k, i) for k, i, _ in shards[1] if i % 37 in (0, 1)] * 2 + [(f"{shards[0]}/a.npy", 10**6), (None, 1), (f"{shards[0]}/a.npy", None)]
    got = collected(A.fetch_rows(spark.createDataFrame(wanted, "shard_key string, row_idx long"), shards[0], 8))
    assert got == [r for r in shards[1] if r[1] % 37 in (0, 1)]
    short = spark.createDataFrame([("b.npy", 3)], "shard_key string, row_idx long")
    assert [r.input_ids for r in A.fetch_rows(short, shards[0], 8).collect()] == [r[2] for r in shards[1] if r[0].endswith("b.npy") and r[1] == 3]


def test_joined():
    assert A.joined([], 64, 100) == [] and A.joined([3], 64, 100) == [(3, 3)]
    assert A.joined([0, 64, 129, 130], 64, 1000) == [(0, 64), (129, 130)]
    assert A.joined(list(range(10)), 64, 4) == [(0, 3), (4, 7), (8, 9)]


def test_broken_files(spark, tmp_path):
    for name, raw in {"x.npy": b"no array at all", "y.npy": A.header_bytes("<u4", (10, 8)) + b"\0" * 100}.items():
        folder = tmp_path / name[0]
        folder.mkdir()
        (folder / name).write_bytes(raw)
        with pytest.raises(Exception, match="not an array file|shorter than its header"):
            A.read_arrays(spark, str(folder), 8).count()
    (tmp_path / "empty").mkdir()
    assert A.read_arrays(spark, str(tmp_path / "empty"), 8).collect() == []


def windows(spark, n, length=6, rows=7):
    df = spark.range(n).select(F.col("id").alias("window_id"), F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda j: (F.col("id") * 10 + j).cast("int")).alias("ids"))
    shard = F.floor(F.col("window_id") / rows)
    return df.withColumn("shard", shard).withColumn("split", F.when(shard < 3, "train").otherwise("eval"))


def test_sink(spark, tmp_path):
    out = str(tmp_path / "out")
    A.write_arrays(windows(spark, 40), out, 6)
    manifest = json.load(open(f"{out}/manifest.json"))
    assert sorted(os.listdir(out)) == ["eval", "manifest.json", "train"] and manifest["total_shards"] == 6 and manifest["total_tokens"] == 240
    assert [e["key"] for e in manifest["shards"]][:4] == ["train/shard_000000.npy", "train/shard_000001.npy", "train/shard_000002.npy", "eval/holdout_000003.npy"]
    at = 0
    for e in sorted(manifest["shards"], key=lambda e: e["shard"]):
        raw = open(f"{out}/{e['key']}", "rb").read()
        x = np.load(f"{out}/{e['key']}")
        assert (hashlib.sha256(raw).hexdigest(), len(raw), list(x.shape), x.dtype) == (e["sha256"], e["bytes"], e["shape"], np.dtype("<u4"))
        assert x.tolist() == [[(at + k) * 10 + j for j in range(6)] for k in range(len(x))]
        at += len(x)
    assert at == 40 and {r.error for r in A.verify_arrays(spark, out, 6).collect()} == {None}
    assert A.read_arrays(spark, out).count() == 40


def test_sink_modes(spark, tmp_path):
    out = str(tmp_path / "out")
    A.write_arrays(windows(spark, 14), out, 6)
    with pytest.raises(Exception, match="there already"):
        A.write_arrays(windows(spark, 14), out, 6)
    A.write_arrays(windows(spark, 21).where("shard = 2"), out, 6)
    assert len(json.load(open(f"{out}/manifest.json"))["shards"]) == 3
    A.write_arrays(windows(spark, 7), out, 6, "overwrite")
    assert len(json.load(open(f"{out}/manifest.json"))["shards"]) == 1 and os.listdir(f"{out}/train") == ["shard_000000.npy"]
    assert sorted(os.listdir(out)) == ["manifest.json", "train"]


def test_a_failing_task_leaves_nothing_behind(spark, tmp_path):
    out = str(tmp_path / "out")
    A.write_arrays(windows(spark, 14), out, 6)
    before = {f: open(f"{d}/{f}", "rb").read() for d, _, names in os.walk(out) for f in names}
    bad = windows(spark, 60).where("shard > 1").withColumn("ids", F.when(F.col("window_id") == 55, F.slice("ids", 1, 5)).otherwise(F.col("ids")))
    with pytest.raises(Exception, match="rows must have 6 tokens"):
        A.write_arrays(bad, out, 6)
    assert {f: open(f"{d}/{f}", "rb").read() for d, _, names in os.walk(out) for f in names} == before and sorted(os.listdir(out)) == ["manifest.json", "train"]


def test_a_repeated_attempt_leaves_one_shard(tmp_path):
    """Files of an attempt whose message never reached the driver go with the job's folder."""
    import pyarrow as pa

    writer = A.ArrayWriter({"path": str(tmp_path), "length": "2"}, False)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["train"] * 2), pa.array([0, 0]), pa.array([0, 1]), pa.array([2, 2]), pa.array([[1, 2], [3, 4]], pa.list_(pa.int32()))], ["split", "shard", "row_idx", "shard_rows", "input_ids"]
    )
    writer.write(iter([batch]))
    with pytest.raises(ValueError):
        writer.write(iter([batch.slice(0, 1)]))
    writer.commit([writer.write(iter([batch])), None])
    assert sorted(os.listdir(tmp_path)) == ["manifest.json", "train"] and os.listdir(tmp_path / "train") == ["shard_000000.npy"]
    with pytest.raises(ValueError):
        writer.commit([writer.write(iter([batch])), writer.write(iter([batch]))])
    assert sorted(os.listdir(tmp_path)) == ["manifest.json", "train"]


def test_verify_finds_what_is_wrong(spark, tmp_path):
    out = str(tmp_path / "out")
    A.write_arrays(windows(spark, 49), out, 6)
    names = [f"{out}/train/shard_{k:06d}.npy" for k in range(3)] + [f"{out}/eval/holdout_{k:06d}.npy" for k in range(3, 7)]
    os.remove(names[0])
    open(names[1], "wb").write(b"nothing")
    np.save(names[2], np.zeros(42, "<u4"))
    np.save(names[3], np.zeros((7, 5), "<u4"))
    np.save(names[4], np.zeros((6, 6), "<u4"))
    np.save(names[5], np.zeros((7, 6), "<i8"))
    x = np.load(names[6])
    x[3, 3] += 1
    np.save(names[6], x)
    errors = {r.key: r.error for r in A.verify_arrays(spark, out, 6).collect()}
    want = ["missing", "unreadable", "1 dimensions", "rows of 5", "6 rows", "tokens of int64", "digest"]
    assert [errors[n.removeprefix(out + "/")] for n in names] == want


def shard_batch(shards, split="eval"):
    import pyarrow as pa

    n = len(shards)
    return pa.RecordBatch.from_arrays(
        [pa.array([split] * n), pa.array(shards, pa.int64()), pa.array([0] * n), pa.array([1] * n), pa.array([[k, k + 1] for k in shards], pa.list_(pa.int32()))],
        ["split", "shard", "row_idx", "shard_rows", "input_ids"],
    )


def traced(f):
    """What ``f`` gives, and the most memory, in bytes, that Python held meanwhile."""
    import tracemalloc

    tracemalloc.start()
    try:
        return f(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_the_driver_holds_little_of_many_shards(tmp_path, monkeypatch):
    import pickle

    n, path = 3000, str(tmp_path)
    monkeypatch.setattr(A, "LISTED", 64, raising=False)
    writer = A.ArrayWriter({"path": path, "length": "2"}, False)
    messages = [writer.write(iter([shard_batch(list(range(k, n, 3)))])) for k in range(3)]
    assert len(pickle.dumps(messages)) < 16 * n
    _, most = traced(lambda: writer.commit(messages))
    assert most < 1000 * n
    text = open(f"{path}/manifest.json").read()
    manifest = json.loads(text)
    assert text == json.dumps(manifest, indent=1) and [e["shard"] for e in manifest["shards"]] == list(range(n))
    assert (manifest["total_shards"], manifest["total_eval_shards"], manifest["total_tokens"]) == (n, n, 2 * n)
    reader = A.ArrayReader({"path": path})
    parts, most = traced(reader.partitions)
    assert most < 1000 * n and len(pickle.dumps(parts)) < 64 * n
    rows = [(key.rsplit("/", 1)[1], i, ids) for p in parts for b in reader.read(p) for key, i, ids in zip(*(c.to_pylist() for c in b.columns))]
    assert rows == [(f"holdout_{k:06d}.npy", 0, [k, k + 1]) for k in range(n)]


def test_many_small_files_beside_a_large_one(spark, tmp_path):
    names = [f"{tmp_path}/{'ab'[k % 2]}/{k:03d}.npy" for k in range(300)]
    for folder in "ab":
        (tmp_path / folder).mkdir()
    for k, name in enumerate(names):
        np.save(name, np.full((k % 3, 4), k, "<u4"))
    np.save(tmp_path / "large.npy", np.arange(4000, dtype="<u4").reshape(-1, 4))
    rows = [(name, i, [k] * 4) for k, name in enumerate(names) for i in range(k % 3)] + [(f"{tmp_path}/large.npy", i, list(range(4 * i, 4 * i + 4))) for i in range(1000)]
    df = A.read_arrays(spark, str(tmp_path), partition_bytes=4096)
    assert collected(df) == sorted(rows)
    for condition in ["row_idx = 1", "row_idx in (0, 999)", f"shard_key in ('{names[5]}', '{names[8]}')", "row_idx >= 1 and row_idx < 500"]:
        assert collected(df.where(condition)) == collected(spark.createDataFrame(rows, A.SCHEMA).where(condition))
    (tmp_path / "b" / "bad.npy").write_bytes(b"no array at all")
    with pytest.raises(Exception, match="not an array file"):
        A.read_arrays(spark, str(tmp_path), partition_bytes=4096).count()


def test_a_manifest_is_read_piece_by_piece(tmp_path):
    store, path = A.store_of(str(tmp_path))
    assert list(A.shard_entries(store, path)) == []
    entries = [{"key": f"train/{'é' * (k % 50)}{k}", "shape": [k, {"x": None}], "text": "\\\"]}" * (k % 7), "n": k / 7} for k in range(4000)]
    for value, indent in [({"a": 1.25, "shards": entries, "z": [1]}, 1), ({"shards": entries}, None), ({"shards": [], "b": "}"}, 3)]:
        (tmp_path / "manifest.json").write_text(json.dumps(value, indent=indent, ensure_ascii=indent is None), "utf-8")
        assert list(A.shard_entries(store, path)) == value["shards"]
    for text, error in [("{}", KeyError), ('{"shards": [{"key": 1}', ValueError), ("", ValueError)]:
        (tmp_path / "manifest.json").write_text(text)
        with pytest.raises(error):
            list(A.shard_entries(store, path))


def test_shards_under_other_keys(tmp_path):
    """A manifest from elsewhere, out of order and with keys of its own: they are kept, told from new ones, and deleted when all is overwritten."""
    path = str(tmp_path)
    os.makedirs(f"{path}/eval")
    old = [{"key": key, "split": "eval", "shard": k, "num_tokens": 2} for key, k in [("eval/holdout_000007.npy", 3), ("eval/mine.npy", 1)]]
    for e in old:
        np.save(f"{path}/{e['key']}", np.zeros((1, 2), "<u4"))
    json.dump({"shards": old}, open(f"{path}/manifest.json", "w"))

    def commit(shards, overwrite):
        writer = A.ArrayWriter({"path": path, "length": "2"}, overwrite)
        writer.commit([writer.write(iter([shard_batch(shards)]))])
        return [e["key"] for e in json.load(open(f"{path}/manifest.json"))["shards"]]

    with pytest.raises(ValueError, match="there already.*holdout_000007"):
        commit([7], False)
    assert commit([2, 1], False) == ["eval/mine.npy", "eval/holdout_000001.npy", "eval/holdout_000002.npy", "eval/holdout_000007.npy"]
    assert commit([7], True) == ["eval/holdout_000007.npy"] and os.listdir(f"{path}/eval") == ["holdout_000007.npy"]
    assert np.load(f"{path}/eval/holdout_000007.npy").tolist() == [[7, 8]]
