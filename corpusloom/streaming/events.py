"""Event streams: admission once per key, current state, idle sessions and a stateful watchdog."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(spark: SparkSession, folder: str, files_per_trigger: int = 16) -> DataFrame:
    """Event files of a folder as a stream; the zone-less time becomes an event time."""
    raw = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def admitted(stream: DataFrame, key: str = "user_id") -> DataFrame:
    """The first event of each key ever seen; keys are burned for good, so the state has no watermark."""
    return stream.dropDuplicates([key])


def current_state(stream: DataFrame) -> DataFrame:
    """The latest event of each (user, type) and how many there were, in update or complete mode."""
    return stream.groupBy("user_id", "event_type").agg(
        F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"), F.count("*").alias("n")
    )


def hourly(stream: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Counts and sums by hour and type; events later than the watermark allows are left out."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", "1 hour"), "event_type").agg(
        F.count("*").alias("n"), F.sum("value").alias("total")
    )


def idle_sessions(stream: DataFrame, gap: str = "420 seconds", late: str = "10 minutes") -> DataFrame:
    """Sessions of a user that end when no event comes for the gap."""
    return stream.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))


def latest_reveals(stream: DataFrame) -> DataFrame:
    """The last reveal of each key with how many there were, for streams of (hotkey, block, payload) in update or complete mode."""
    return stream.groupBy("hotkey").agg(F.max_by("payload", "block").alias("payload"), F.max("block").alias("block"), F.count("*").alias("n"))


class RequeueOnFailure(StatefulProcessor):
    """The queue of each repository: a failure sends its entry to the front with one more retry, up to the cap; success clears it."""

    def __init__(self, cap: int = 3):
        self.cap = cap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.retry = handle.getValueState("retry", "n int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        n = self.retry.get()[0] if self.retry.exists() else 0
        out = []
        for e in pd.concat(list(rows)).sort_values(["ts", "event_id"]).itertuples(index=False):
            if e.event_type == "error":
                n += 1
                out.append((key[0], int(e.event_id), n, "front" if n <= self.cap else "failed"))
            else:
                n = 0
        self.retry.update((n,))
        yield pd.DataFrame(out, columns=["repo", "event_id", "retry", "action"])

    def close(self) -> None:
        pass


def retries(stream: DataFrame, repo: str = "repo", cap: int = 3) -> DataFrame:
    """(repo, event_id, retry, action) of each failure, by a stateful operator (needs the RocksDB state store)."""
    return stream.groupBy(F.col(repo).alias("repo")).transformWithStateInPandas(
        statefulProcessor=RequeueOnFailure(cap), outputStructType="repo string, event_id bigint, retry int, action string",
        outputMode="Append", timeMode="None",
    )


def run_once(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Processes what is there and stops; a later run goes on from the checkpoint."""
    if mode == "append":
        q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    else:
        def replace(df: DataFrame, _: int) -> None:
            df.write.mode("overwrite").parquet(path)

        q = stream.writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
