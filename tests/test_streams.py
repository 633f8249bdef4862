"""Alarms of silent streams in event and processing time, and the snapshot sink under replays and failing stores."""

import datetime
import time

import pytest
from pyspark.sql import functions as F

from corpusloom.streaming import events, sinks, watchdog

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
T0 = datetime.datetime(2024, 1, 1)


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def put(spark, folder, rows, k):
    """(key, seconds, type) rows as one file."""
    made = [(key, T0 + datetime.timedelta(seconds=s), kind) for key, s, kind in rows]
    spark.createDataFrame(made, "user_id string, ts timestamp, event_type string").coalesce(1).write.parquet(f"{folder}/{k:03d}")


def stream(spark, folder):
    return spark.readStream.schema("user_id string, ts timestamp, event_type string").option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def test_alarms_in_event_time(spark, rocks, tmp_path):
    src = str(tmp_path / "in")
    put(spark, src, [("a", 0, "progress"), ("b", 0, "progress"), ("c", 0, "progress"), ("d", 0, "progress"), (None, 0, "progress")], 0)
    put(spark, src, [("b", 179, "progress"), ("c", 181, "progress"), ("d", 10, "verdict"), ("z", 181, "progress")], 1)
    put(spark, src, [("z", 300, "progress"), ("b", 250, None)], 2)
    put(spark, src, [("z", 420, "progress"), ("c", 400, "progress")], 3)
    put(spark, src, [("z", 600, "progress")], 4)
    put(spark, src, [("z", 900, "progress")], 5)
    put(spark, src, [("z", 901, "verdict"), ("a", 902, "progress")], 6)
    put(spark, src, [("y", 5000, "progress"), ("y", 5001, "error")], 7)
    q = watchdog.idle_alarms(stream(spark, src), by_event=True)
    events.run_once(q, str(tmp_path / "out"), str(tmp_path / "check"))
    got = sorted((r.key, r.kind, int((r.last_at - T0).total_seconds())) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    want = [
        ("a", "fail", 0), ("a", "fail", 902), ("a", "warn", 0), ("a", "warn", 902),
        ("b", "fail", 250), ("b", "warn", 250), ("c", "fail", 400), ("c", "warn", 0), ("c", "warn", 181), ("c", "warn", 400), ("z", "warn", 600), ("z", "warn", 420),
    ]
    assert got == sorted(want)


def test_alarms_in_processing_time(spark, rocks, tmp_path):
    """Short limits: each alarm once, events re-arm, closing events disarm, and nothing but timers makes alarms come."""
    src = str(tmp_path / "in")
    put(spark, src, [("quiet", 0, "progress"), ("closed", 0, "progress"), ("closed", 1, "verdict"), ("busy", 0, "progress")], 0)
    q = watchdog.idle_alarms(stream(spark, src), warn_after=4.0, fail_after=12.0).writeStream.format("memory").queryName("alarms").outputMode("append")
    q = q.option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="500 milliseconds").start()
    try:
        found = lambda: sorted((r.key, r.kind) for r in spark.table("alarms").collect())
        end = time.time() + 90
        while ("quiet", "warn") not in found() and time.time() < end:
            time.sleep(0.3)
        put(spark, src, [("busy", 2, "progress")], 1)
        while ("busy", "fail") not in found() and time.time() < end:
            time.sleep(0.3)
        time.sleep(2)
        rows = {(r.key, r.kind): r.idle_s for r in spark.table("alarms").collect()}
        assert found().count(("quiet", "warn")) == found().count(("quiet", "fail")) == found().count(("busy", "fail")) == 1
        assert not any(k == "closed" for k, _ in rows) and rows["quiet", "warn"] >= 4 and rows["quiet", "fail"] >= 12
    finally:
        q.stop()


def batch(spark, rows):
    return spark.createDataFrame(rows, "key string, at long, value string")


def state(sink, spark):
    snap = sink.snapshot(spark)
    return {} if snap is None else {r.key: (r.at, r.value) for r in snap.collect()}


class Clock:
    now = 0.0

    def __call__(self):
        return self.now


def made(tmp_path, clock, **more):
    return sinks.SnapshotSink([str(tmp_path / "first"), str(tmp_path / "second")], str(tmp_path / "deltas"), ["key"], ["at", "value"], clock=clock, **more)


def test_flushes_are_apart(spark, tmp_path):
    clock, writes = Clock(), []

    def write(df, path):
        writes.append(path)
        sinks.write_parquet(df, path)

    sink = made(tmp_path, clock, write=write)
    for n in range(12):
        clock.now = n * 1.0
        sink(batch(spark, [("a", n, f"v{n}"), (f"k{n}", n, "x")]), n)
    assert [p.rsplit("=", 1)[1] for p in writes] == ["0", "5", "10"]
    assert state(sink, spark)["a"] == (10, "v10")
    sink.close(spark)
    assert state(sink, spark) == {"a": (11, "v11"), **{f"k{n}": (n, "x") for n in range(12)}}
    assert sink.flush(spark) is None and len(writes) == 4


def test_replayed_batches_change_nothing(spark, tmp_path):
    clock = Clock()
    sink = made(tmp_path, clock)
    sink(batch(spark, [("a", 5, "new")]), 0)
    clock.now = 1.0
    sink(batch(spark, [("b", 1, "one")]), 1)
    sink(batch(spark, [("b", 1, "one")]), 1)
    sink(batch(spark, [("a", 4, "old")]), 0)
    again = made(tmp_path, clock)  # a driver that starts anew reads what is there
    again(batch(spark, [("b", 1, "one")]), 1)
    again.close(spark)
    assert state(again, spark) == {"a": (5, "new"), "b": (1, "one")}
    again(batch(spark, [("b", 9, "changed")]), 1)
    again.close(spark)
    assert state(again, spark) == {"a": (5, "new"), "b": (1, "one")}


def test_a_failing_store_is_survived(spark, tmp_path):
    clock, down = Clock(), {"first"}

    def write(df, path):
        if any(f"/{d}/" in path for d in down):
            raise OSError("store is down")
        sinks.write_parquet(df, path)

    sink = made(tmp_path, clock, write=write)
    sink(batch(spark, [("a", 1, "x")]), 0)
    assert state(sink, spark) == {"a": (1, "x")} and sink.newest()[1].endswith("second/version=0") and sink.failures[0][1] == "store is down"
    down.clear()
    clock.now = 10.0
    sink(batch(spark, [("a", 2, "y")]), 1)
    assert sink.newest()[1].endswith("second/version=1")  # the first one rests
    clock.now = 400.0
    sink(batch(spark, [("a", 3, "z")]), 2)
    assert sink.newest()[1].endswith("first/version=2") and state(sink, spark) == {"a": (3, "z")}
    down.update({"first", "second"})
    clock.now = 410.0
    sink(batch(spark, [("b", 1, "kept")]), 3)
    assert state(sink, spark) == {"a": (3, "z")}
    down.clear()
    clock.now = 1000.0
    sink(batch(spark, [("c", 1, "c")]), 4)
    assert state(sink, spark) == {"a": (3, "z"), "b": (1, "kept"), "c": (1, "c")}


def test_sink_of_a_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    for k in range(3):
        put(spark, src, [("a", k, f"t{k}"), (f"u{k}", k, "x")], k)
    sink = sinks.SnapshotSink([str(tmp_path / "first")], str(tmp_path / "deltas"), ["user_id"], ["ts"])
    for _ in range(2):
        stream(spark, src).writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
        sink.close(spark)
    assert {(r.user_id, r.event_type) for r in sink.snapshot(spark).collect()} == {("a", "t2"), ("u0", "x"), ("u1", "x"), ("u2", "x")}
