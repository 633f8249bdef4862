"""Packing of token streams into fixed windows, shards and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Documents in one run of the two-level running sum, about.
RUN = 1024


def running_offset(df: DataFrame, order: str, size: str, stream: list[str] = [], out: str = "offset", extent: DataFrame | None = None) -> DataFrame:
    """Adds the sum of ``size`` over the rows before, by the integer ``order`` within ``stream``.

    Two levels: inside runs of ``order`` values, and over one row for each run,
    so no task gets the whole stream.  The width of a run follows from the extent
    of ``order`` and the number of rows, so sparse ids such as hashes make as few
    runs as dense ones.  ``extent``, by default ``df``, is where these are taken
    from: any table with at least these rows that is cheap to read.
    """
    seen = (df if extent is None else extent).agg(F.min(order).alias("_low"), F.max(order).alias("_high"), F.count("*").alias("_rows"))
    wide = F.ceil((F.col("_high").cast("double") - F.col("_low").cast("double") + 1) / F.greatest(F.lit(1), F.floor(F.col("_rows") / RUN)))
    width = seen.select(F.greatest(F.lit(1.0), F.least(wide.cast("double"), F.lit(float(1 << 62)))).alias("_width"))
    df = df.crossJoin(F.broadcast(width)).withColumn("_run", F.floor(F.col(order) / F.col("_width"))).drop("_width")  # one row
    sums = df.groupBy(*stream, "_run").agg(F.sum(size).alias("_size"))
    before = Window.partitionBy(*stream).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_base", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    inside = Window.partitionBy(*stream, "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    right = sums.select(*(F.col(c).alias(f"_k_{c}") for c in [*stream, "_run"]), "_base")
    same = df["_run"] == right["_k__run"]
    for c in stream:
        same = same & df[c].eqNullSafe(right[f"_k_{c}"])
    return (
        df.join(right, same)
        .withColumn(out, F.col("_base") + F.coalesce(F.sum(size).over(inside), F.lit(0)))
        .drop("_run", "_base", *(f"_k_{c}" for c in [*stream, "_run"]))
    )


def pack_windows(df: DataFrame, length: int, order: str = "doc_id", ids: str = "ids", stream: list[str] = []) -> DataFrame:
    """(*stream, window_id, ids): the concatenated token arrays cut every ``length`` tokens, tail dropped.

    Each document contributes one slice per window it touches; slices, not
    tokens, are shuffled.
    """
    sized = df.select(*stream, order, ids).withColumn("_n", F.size(ids).cast("long")).where("_n > 0")
    placed = running_offset(sized, order, "_n", stream, extent=df.select(order))
    first, last = F.floor(F.col("offset") / length), F.floor((F.col("offset") + F.col("_n") - 1) / length)
    parts = placed.withColumn("window_id", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("window_id") * length - F.col("offset"), F.lit(0))
    end = F.least((F.col("window_id") + 1) * length - F.col("offset"), F.col("_n"))
    parts = parts.select(
        *stream, "window_id",
        F.struct(F.col("offset").alias("at"), F.slice(ids, (begin + 1).cast("int"), (end - begin).cast("int")).alias("part")).alias("s"),
    )
    whole = parts.groupBy(*stream, "window_id").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list("s")), lambda x: x["part"])).alias("ids")
    )
    return whole.where(F.size("ids") == length)


def assign_shards(windows: DataFrame, rows_per_shard: int, train_shards: int, full_only: bool = False) -> DataFrame:
    """Adds shard and split: train shards come first, then eval; ``full_only`` drops a short last shard."""
    out = windows.withColumn("shard", F.floor(F.col("window_id") / rows_per_shard)).withColumn(
        "split", F.when(F.col("shard") < train_shards, "train").otherwise("eval")
    )
    if full_only:
        full = out.groupBy("shard").count().where(F.col("count") == rows_per_shard).select("shard")
        out = out.join(full, "shard", "left_semi")
    return out


def manifest(sharded: DataFrame, digest: Column) -> DataFrame:
    """One row for each shard: rows, tokens, bytes (4 a token) and a digest of its rows in order."""
    tokens = F.sum(F.size("ids")).cast("long")
    rows = F.sort_array(F.collect_list(F.struct("window_id", digest.alias("d"))))
    return sharded.groupBy("shard", "split").agg(
        F.count("*").alias("rows"), tokens.alias("n_tokens"), (tokens * 4).alias("size_bytes"),
        F.sha2(F.array_join(F.transform(rows, lambda r: r["d"]), "\n"), 256).alias("sha256"),
    )


def reshard(sources: DataFrame, order: str, size: str, capacity: int) -> DataFrame:
    """(order, shard, begin, end): which part of each source goes to which fixed-size shard; the tail is kept."""
    placed = running_offset(sources.where(F.col(size) > 0), order, size)
    first, last = F.floor(F.col("offset") / capacity), F.floor((F.col("offset") + F.col(size) - 1) / capacity)
    return placed.withColumn("shard", F.explode(F.sequence(first, last))).select(
        order, "shard",
        F.greatest(F.col("shard") * capacity - F.col("offset"), F.lit(0)).alias("begin"),
        F.least((F.col("shard") + 1) * capacity - F.col("offset"), F.col(size)).alias("end"),
    )


def coalesce_ranges(wanted: DataFrame, key: str, index: str, gap: int = 64) -> DataFrame:
    """(key, low, high, n): distinct indices of a key joined into ranges where they lie within ``gap``."""
    w = Window.partitionBy(key).orderBy(index)
    i = F.col(index)
    # One sort serves all: equal indices lie beside each other, and a range is told by its first row and what follows, so
    # no table of all pairs or of all ranges is needed.  The struct tells a null index from no row before.
    near = wanted.select(key, index).withColumn("_before", F.lag(F.struct(index)).over(w))
    first = near.where(F.col("_before").isNull() | ~F.col(f"_before.{index}").eqNullSafe(i))
    placed = first.select(key, index, F.col(f"_before.{index}").alias("_prev"), F.row_number().over(w).alias("_at"), F.lead(F.lit(True)).over(w).isNull().alias("_last"), F.coalesce(i, F.lead(index).over(w)).alias("_low"))
    starts = (F.col("_at") == 1) | F.coalesce(i - F.col("_prev") > gap, F.lit(False))  # a null index goes with the first range
    ends = placed.withColumn("_starts", starts).where("_starts or _last")
    after = F.lead(F.struct(index, "_prev", "_at", "_starts")).over(w)
    ranges = ends.withColumn("_next", after).where("_starts")
    beyond = F.col("_next._starts")  # null after the last range
    high = F.when(F.col("_next").isNull(), i).when(beyond, F.col("_next._prev")).otherwise(F.col(f"_next.{index}"))
    n = F.when(F.col("_next").isNull(), 1).when(beyond, F.col("_next._at") - F.col("_at")).otherwise(F.col("_next._at") - F.col("_at") + 1)
    return ranges.select(key, F.col("_low").alias("low"), high.alias("high"), n.cast("long").alias("n"))
