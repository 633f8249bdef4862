"""Registered queries against the same SQL in DuckDB, and the streams against their batch twins."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from corpusloom import parse_queries, queries, record_queries, rule_queries, service_queries, shard_queries, store_queries, view_queries
from corpusloom.tables import NAMES, load

SMALL = "/root/testdata/sf0.001"
MODULES = (queries, record_queries, service_queries, parse_queries, shard_queries, rule_queries, store_queries, view_queries)
ALL = {k: f for m in MODULES for k, f in m.QUERIES.items()}
SQL = {k: t for m in MODULES for k, t in m.ORACLE.items()}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in NAMES:
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")
@pytest.mark.parametrize("name", sorted(ALL))
def test_same_as_sql(spark, duck, name):
    got, want = ALL[name](spark, SMALL).toPandas(), duck.execute(SQL[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    rows = lambda df: sorted(map(str, df[cols].astype(object).values.tolist()))
    assert rows(got) == rows(want)


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")
def test_queries_reach_workers_without_a_path(tmp_path):
    """Outside the repository, with nothing but the entry module's own folder known to the driver."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {root!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local-cluster[1,2,1024]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate()
print("ROWS", e.queries()["byte_pair_tokens"](spark, {SMALL!r}).count(), e.queries()["array_shards"](spark, {SMALL!r}).count() > 0)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable, "SPARK_SCALA_VERSION": "2.13", "SPARK_WORKER_DIR": str(tmp_path / "work")}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 200 True" in done.stdout, done.stderr[-2000:]


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")
def test_bootstrap_has_the_reference_sizes(spark):
    """The bound against brute force over 10,000 replicates of the whole holdout."""
    import hashlib

    import numpy as np

    english = queries.documents(spark, SMALL, "lang").where("lang = 'en'").count()
    d = {r["pos"]: r["diff"] for r in queries.duel(spark, SMALL).collect()}
    n = len(d)
    assert n == min(2000, english // 2) and sorted(d) == list(range(n))
    at = [int(hashlib.md5(f"b:{b}:{k}".encode()).hexdigest()[:15], 16) % n for b in range(10_000) for k in range(n)]
    means = np.array([d[k] for k in range(n)])[np.array(at).reshape(10_000, n)].mean(axis=1)
    got = queries.duel_verdict(spark, SMALL).first()
    assert got["n"] == n and abs(got["lcb"] - np.quantile(means, 0.01)) < 2e-6
    assert got["decision"] in ("DO_NOT_SUBMIT", "PROMISING_NEEDS_MORE_EVAL")


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")
def test_service_queries_take_whole_tables(spark, duck, tmp_path):
    docs, lines = load(spark, SMALL, "documents"), load(spark, SMALL, "lineitem")
    run = lambda name: ALL[name](spark, SMALL)
    assert run("humanised_sizes").count() == docs.count() and run("humanised_sizes").where("size like '% MiB'").count() > 0
    assert run("cache_complete").agg({"wanted": "sum"}).first()[0] == docs.where("source is not null").count()
    found = run("range_lookup")
    assert found.count() == lines.count() and found.select("source").distinct().count() == docs.select("source").distinct().count()


def test_sizes_around_the_units(spark):
    from corpusloom.functions.parsing import file_size_text

    sizes = {0: "0.00 B", 1023: "1023.00 B", 1024: "1.00 KiB", 1152: "1.12 KiB", 1048575: "1024.00 KiB", 1048576: "1.00 MiB", 1 << 40: "1.00 TiB", 1 << 50: "1024.00 TiB"}
    out = spark.createDataFrame([(n,) for n in sizes], "n long").select("n", file_size_text(F.col("n")).alias("t")).collect()
    assert {r["n"]: r["t"] for r in out} == sizes


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")
def test_streams_equal_their_batch_twins(spark, tmp_path):
    import shutil

    from corpusloom.streaming import events as S

    os.makedirs(tmp_path / "in")
    shutil.copy(f"{SMALL}/events.parquet", tmp_path / "in/events.parquet")
    stream = S.event_stream(spark, str(tmp_path / "in"))
    S.run_once(S.admitted(stream), str(tmp_path / "a"), str(tmp_path / "ca"))
    ev = load(spark, SMALL, "events")
    assert spark.read.parquet(str(tmp_path / "a")).count() == ev.select("user_id").distinct().count()
    S.run_once(S.current_state(stream), str(tmp_path / "b"), str(tmp_path / "cb"), "complete")
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "b")).select("user_id", "event_type", "event_id", "n").collect()}
    want = {tuple(r) for r in record_queries.event_state(spark, SMALL).select("user_id", "event_type", "event_id", "n").collect()}
    assert got == want
    # A second run over the same files finds nothing new.
    S.run_once(S.admitted(stream), str(tmp_path / "a"), str(tmp_path / "ca"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == len({r[0] for r in want})


def test_hours_sessions_and_retries(spark, tmp_path):
    """Streams against what the rows say; the stateful operator over two runs of one stream."""
    from corpusloom.streaming import events as S

    stamp = lambda k: f"2024-01-01 {k // 3600:02d}:{k // 60 % 60:02d}:{k % 60:02d}"
    kinds = ["error", "error", "click", "error", "error", "error", "error"]
    rows = [(k, stamp(k * 1000), k % 2, kinds[k // 2], 1.0, "{}") for k in range(14)]
    ev = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    ev.where("event_id < 8").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = S.event_stream(spark, str(tmp_path / "in"))
    S.run_once(S.hourly(stream), str(tmp_path / "h"), str(tmp_path / "ch"), "complete")
    got = {(r["window"]["start"].hour, r["event_type"]): r["n"] for r in spark.read.parquet(str(tmp_path / "h")).collect()}
    assert got == {(0, "error"): 4, (1, "click"): 2, (1, "error"): 2} and sum(got.values()) == 8
    S.run_once(S.idle_sessions(stream, "1500 seconds"), str(tmp_path / "s"), str(tmp_path / "cs"), "complete")
    assert spark.read.parquet(str(tmp_path / "s")).count() == 8
    reveals = stream.select(F.col("user_id").alias("hotkey"), F.col("event_id").alias("block"), F.concat(F.lit("p"), "event_id").alias("payload"))
    S.run_once(S.latest_reveals(reveals), str(tmp_path / "l"), str(tmp_path / "cl"), "complete")
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "l")).select("hotkey", "payload", "n").collect()} == {(0, "p6", 4), (1, "p7", 4)}
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        keyed = lambda: S.event_stream(spark, str(tmp_path / "in")).withColumn("repo", F.concat(F.lit("r"), "user_id"))
        S.run_once(S.retries(keyed(), cap=2), str(tmp_path / "r"), str(tmp_path / "cr"))
        ev.where("event_id >= 8").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        S.run_once(S.retries(keyed(), cap=2), str(tmp_path / "r"), str(tmp_path / "cr"))
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "r")).where("repo = 'r0'").select("event_id", "retry", "action").collect())
    assert got == [(0, 1, "front"), (2, 2, "front"), (6, 1, "front"), (8, 2, "front"), (10, 3, "failed"), (12, 4, "failed")]
