"""Event streams, verdict histories and state, as batch operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def idle_gaps(events: DataFrame, key: str, ts: str, warn_s: int, fail_s: int, tie: str) -> DataFrame:
    """Adds gap_s since the key's last event and its state: active, warn or timeout (at or above the limits)."""
    w = Window.partitionBy(key).orderBy(ts, tie)
    gap = F.timestamp_diff("SECOND", F.lag(ts).over(w), F.col(ts))
    return events.withColumn("gap_s", gap).withColumn(
        "state", F.when(F.col("gap_s") >= fail_s, "timeout").when(F.col("gap_s") >= warn_s, "warn").otherwise("active")
    )


def latest(rows: DataFrame, keys: list[str], by: list[Column], columns: list[str]) -> DataFrame:
    """The last row of each key; an aggregate with map-side combine, not a window."""
    pick = F.max_by(F.struct(*columns), F.struct(*by))
    return rows.groupBy(*keys).agg(pick.alias("_r")).select(*keys, "_r.*")


def first_seen(rows: DataFrame, keys: list[str], by: list[Column], columns: list[str]) -> DataFrame:
    pick = F.min_by(F.struct(*columns), F.struct(*by))
    return rows.groupBy(*keys).agg(pick.alias("_r")).select(*keys, "_r.*")


def runs(rows: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """(key, value, first, n): maximal runs of equal values in order."""
    w = Window.partitionBy(key).orderBy(*order)
    new = (~F.col(value).eqNullSafe(F.lag(value).over(w))).cast("int")
    marked = rows.withColumn("_run", F.sum(new).over(w))
    return marked.groupBy(key, "_run", value).agg(F.min(order[0]).alias("first"), F.count("*").alias("n")).drop("_run")


def reigns(history: DataFrame, key: str, order: list[str], crowned: Column, holder: str) -> DataFrame:
    """Adds reign (crownings so far) and the holder before, for crowned rows only."""
    w = Window.partitionBy(key).orderBy(*order)
    won = history.where(crowned)
    return won.withColumn("reign", F.row_number().over(w)).withColumn("previous", F.lag(holder).over(w))


def ancestors(spark: SparkSession, edges: DataFrame, starts: DataFrame, depth: int) -> DataFrame:
    """(start, node, depth): the chain of parents, cut at cycles and at ``depth``.

    ``edges`` has (node, parent), one parent for each node; each step is a join
    of the frontier only.
    """
    frontier = starts.select(F.col("node").alias("start"), "node", F.array("node").alias("path"))
    out = frontier.select("start", "node", F.lit(0).alias("depth"))
    for d in range(1, depth + 1):
        step = frontier.join(edges, "node").where(F.col("parent").isNotNull() & ~F.array_contains("path", F.col("parent")))
        frontier = step.select("start", F.col("parent").alias("node"), F.concat("path", F.array("parent")).alias("path"))
        out = out.union(frontier.select("start", "node", F.lit(d)))
    return out


def lock_violations(left: DataFrame, right: DataFrame, key: str, name: str, value: str, order: Column) -> DataFrame:
    """The first mismatching setting of each key in a fixed order; an absent setting only equals an absent one."""
    a = left.select(key, name, F.col(value).alias("a"), F.lit(True).alias("a_there"))
    b = right.select(key, name, F.col(value).alias("b"), F.lit(True).alias("b_there"))
    both = a.join(b, [key, name], "full").where(~(F.col("a").eqNullSafe(F.col("b")) & F.col("a_there").eqNullSafe(F.col("b_there"))))
    return both.groupBy(key).agg(F.min_by(name, order).alias("first_mismatch"), F.count("*").alias("mismatches"))


def evictions(files: DataFrame, group: str, size: str, order: list[str], watermark: Column, share: float, protected: Column | None = None) -> DataFrame:
    """Adds evict: oldest files first until less than ``share`` of the watermark is left; nothing below the watermark.

    A protected file is passed over and its size stays in the total.
    """
    kept = F.coalesce(protected, F.lit(False)) if protected is not None else F.lit(False)
    total = F.sum(size).over(Window.partitionBy(group))
    gone = F.when(~kept, F.col(size)).otherwise(F.lit(0))
    older = F.coalesce(F.sum(gone).over(Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return files.withColumn("evict", ~kept & (total >= watermark) & (total - older >= share * watermark))


def pruned(records: DataFrame, group: str, finished: Column, created: str, tie: str, oldest: Column, keep: int) -> DataFrame:
    """Adds drop: finished records created before ``oldest``, then the oldest finished ones while more than ``keep`` records are left.

    Open records are never dropped, but count among those that are left.
    """
    each = Window.partitionBy(group)
    done = F.coalesce(finished, F.lit(False))
    aged = records.withColumn("_done", done).withColumn("_aged", done & (F.col(created) < oldest))
    left = F.count("*").over(each) - F.count_if(F.col("_aged")).over(each)
    place = F.row_number().over(Window.partitionBy(group, F.col("_done") & ~F.col("_aged")).orderBy(created, tie))
    out = aged.withColumn("_excess", left - keep).withColumn("_place", place)
    return out.withColumn("drop", F.col("_aged") | (F.col("_done") & ~F.col("_aged") & (F.col("_place") <= F.col("_excess")))).drop("_done", "_aged", "_excess", "_place")


def upper_medians(rows: DataFrame, group: str, size: str) -> DataFrame:
    """(group, median): the size at place floor(n / 2) from 0, by counts of equal sizes, of which there are far fewer than rows."""
    counts = rows.groupBy(group, size).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(group)
    upto = F.sum("_n").over(w.orderBy(size).rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.withColumn("_upto", upto).withColumn("_half", F.floor(F.sum("_n").over(w) / 2))
    return placed.where("_upto > _half").groupBy(group).agg(F.min(size).alias("median"))


# Fixed values, in the order they are looked for.
TRANSIENT = (
    "internal error", "stream idle", "watchdog timeout", "timed out", "timeout", "server disconnected", "connection reset",
    "connecterror", "readerror", "remoteprotocolerror", "streamconsumed", "streamclosed", "streamerror",
    "peer closed connection", "incomplete chunked", "incompleteread", "503", "502", "504",
)


def classify_error(text: Column, cancelled: Column | None = None) -> tuple[Column, Column]:
    """(transient, marker): cancellation first, then two permanent patterns, then the first marker found."""
    t = F.lower(text)
    stopped = F.coalesce(cancelled, F.lit(False)) if cancelled is not None else F.lit(False)
    exhausted = t.contains("stuck cdn") | (t.contains("prefetch") & t.contains("exceeded"))
    reported = t.startswith("eval server error") | t.contains("'eval server error'")
    found = F.filter(F.array(*(F.lit(m) for m in TRANSIENT)), lambda m: t.contains(m))
    first = F.when(F.size(found) > 0, F.element_at(found, 1))
    marker = (
        F.when(stopped, "validator_cancelled").when(exhausted, "prefetch_exhausted").when(reported, "eval_server_reported")
        .otherwise(F.coalesce(first, F.lit("")))
    )
    return stopped | (~exhausted & ~reported & (F.size(found) > 0)), marker
