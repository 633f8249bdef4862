"""Small rules over listings, logs and histories that services keep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import seeded
from .packing import running_offset


def completeness(wanted: DataFrame, have: DataFrame, group: str, key: str) -> DataFrame:
    """(group, wanted, missing, usable): a group is usable only when nothing of it is missing."""
    there = have.select(F.col(key).alias("_key")).distinct()
    out = wanted.join(there, wanted[key] == there["_key"], "left").groupBy(group)
    return out.agg(F.count("*").alias("wanted"), F.count_if(F.col("_key").isNull()).alias("missing")).withColumn("usable", F.col("missing") == 0)


def download_status(wanted: DataFrame, have: DataFrame, key: str, got: str, least: float) -> DataFrame:
    """Adds status: cached, pending (nothing there) or failed (less than ``least``)."""
    there = have.select(F.col(key).alias("_key"), F.col(got).alias("_got"))
    status = F.when(F.col("_key").isNull(), "pending").when(F.col("_got") < least, "failed").otherwise("cached")
    return wanted.join(there, wanted[key] == there["_key"], "left").withColumn("status", status).drop("_key", "_got")


def not_mirrored(wanted: DataFrame, there: DataFrame, key: str, size: str) -> DataFrame:
    """What is not there in the same size."""
    return wanted.join(there.select(key, size).distinct(), [key, size], "left_anti")


def last_seen(events: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """(*keys, age_s): seconds from the last event of each key to the last of all."""
    now = events.agg(F.max(ts).alias("_now"))
    last = events.groupBy(*keys).agg(F.max(ts).alias("_last")).crossJoin(F.broadcast(now))  # one row
    return last.select(*keys, F.timestamp_diff("SECOND", F.col("_last"), F.col("_now")).alias("age_s"))


def needing(rows: DataFrame, group: str, least: int) -> DataFrame:
    """(group, cached, missing) of groups with fewer than ``least`` rows."""
    n = rows.groupBy(group).agg(F.count("*").alias("cached")).where(F.col("cached") < least)
    return n.withColumn("missing", least - F.col("cached"))


def seed_mix(seed: Column, step: Column) -> Column:
    """A seed for each step: the seed and a multiple of a fixed odd number, 32 bits."""
    return seed.bitwiseXOR((F.lit(0x9E3779B1) * (step + 1)) % F.lit(1 << 32))


def schedule(step: Column, warmup: int, decay_from: int, total: int) -> Column:
    """Rises over the warm-up, stays, and falls to 0 at the end."""
    down = F.greatest(F.lit(0.0), 1.0 - (step - decay_from) / float(total - decay_from))
    return F.when(step < warmup, step / float(warmup)).when(step < decay_from, 1.0).otherwise(down)


def suggested_threshold(good: Column, bad: Column) -> Column:
    """Between the largest good value and the smallest bad one, at least twice the former; null where they overlap."""
    return F.when(good < bad, F.greatest((good + bad) / 2, 2 * good))


def batch_means(rows: DataFrame, key: str, order: list[str], value: str, size: int) -> DataFrame:
    """(key, mean_of_batches, mean_of_rows); a ragged last batch counts as much as a full one in the first."""
    batch = F.floor((F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1) / size)
    per = rows.withColumn("_batch", batch).groupBy(key, "_batch").agg(F.avg(value).alias("_mean"), F.sum(value).alias("_total"), F.count("*").alias("_n"))
    return per.groupBy(key).agg(F.avg("_mean").alias("mean_of_batches"), (F.sum("_total") / F.sum("_n")).alias("mean_of_rows"))


def best_so_far(rows: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Adds best and improved: only a strictly greater value replaces the best."""
    before = F.max(value).over(Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    out = rows.withColumn("_before", before)
    improved = F.col("_before").isNull() | (F.col(value) > F.col("_before"))
    return out.withColumn("best", F.greatest("_before", value)).withColumn("improved", improved).drop("_before")


def top_each(rows: DataFrame, group: str, order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows of each group, with k; tasks keep no more than that before the shuffle."""
    return rows.withColumn("k", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("k") <= most)


def spliced(chain: DataFrame, group: str, place: str, at: int, new: DataFrame) -> DataFrame:
    """The chains with a node put in at ``at``; what stood there and behind it moves on. ``new`` has the same columns."""
    moved = chain.withColumn(place, F.when(F.col(place) >= at, F.col(place) + 1).otherwise(F.col(place)))
    long_enough = chain.where(F.col(place) == at).select(group)
    return moved.unionByName(new.join(long_enough, group, "left_semi"))


def sent(rows: DataFrame, key: str, order: list[str], digest: Column) -> DataFrame:
    """(key, sent, kept_back): a report goes out only when it differs from the one before."""
    out = rows.withColumn("_d", digest).withColumn("_before", F.lag("_d").over(Window.partitionBy(key).orderBy(*order)))
    same = F.coalesce(F.col("_before") == F.col("_d"), F.lit(False))
    return out.groupBy(key).agg(F.count_if(~same).alias("sent"), F.count_if(same).alias("kept_back"))


def phases(rows: DataFrame, key: str, order: list[str], ts: str, phase: str) -> DataFrame:
    """(key, phase number, phase, elapsed_s, n) of each run of one phase."""
    w = Window.partitionBy(key).orderBy(*order)
    fresh = (~F.col(phase).eqNullSafe(F.lag(phase).over(w))).cast("int")
    marked = rows.withColumn("_fresh", fresh).withColumn("phase", F.sum("_fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(key, "phase").agg(
        F.min(phase).alias(phase), F.timestamp_diff("SECOND", F.min(ts), F.max(ts)).alias("elapsed_s"), F.count("*").alias("n")
    )


def capped(public: Column, private: Column, most: int) -> tuple[Column, Column]:
    """Both counts cut in proportion to at most ``most`` together; what rounding leaves goes to the public one."""
    over = public + private > most
    small = F.floor(most * private / (public + private))
    return F.when(over, most - small).otherwise(public), F.when(over, small).otherwise(private)


def wrap_slice(rows: DataFrame, order: str, start: int, count: int) -> DataFrame:
    """``count`` rows from place ``start`` in order, on from the first after the last; numbered in two levels."""
    n = rows.agg(F.count("*").alias("_n"))
    placed = running_offset(rows.withColumn("_one", F.lit(1).cast("long")), order, "_one", out="_ord").crossJoin(F.broadcast(n))  # one row
    return placed.where(F.pmod(F.col("_ord") - start, F.col("_n")) < count).drop("_one", "_ord", "_n")


def local_rows(lookups: DataFrame, index: str, sizes: DataFrame, name: str, size: str) -> DataFrame:
    """Each global index (taken modulo the total) with the source it falls on and the place inside.

    ``sizes`` is the few sources; their bounds go to every task as one sorted
    array, which each lookup passes; for many parts see ``permutation.locate``.
    """
    w = Window.orderBy(name)
    bounds = sizes.select(name, F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_hi"), F.col(size).alias("_size"))
    one = bounds.agg(F.array_sort(F.collect_list(F.struct("_hi", "_size", name))).alias("_b"), F.max("_hi").alias("_total"))
    out = lookups.crossJoin(F.broadcast(one)).withColumn("_g", F.pmod(F.col(index), F.col("_total")))  # one row
    hit = F.get(F.filter("_b", lambda x: x["_hi"] > F.col("_g")), F.lit(0))
    out = out.withColumn("_hit", hit)
    return out.withColumn(name, F.col(f"_hit.{name}")).withColumn("local", (F.col("_g") - F.col("_hit._hi") + F.col("_hit._size")).cast("long")).drop("_b", "_total", "_g", "_hit")


def overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: how many different rows both have, and whether there are none."""
    return left.intersect(right).agg(F.count("*").alias("overlap")).withColumn("disjoint", F.col("overlap") == 0)


def numbered_queue(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds challenge, the number in the queue as ``eval-0001``, and behind, how many come after."""
    k = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    n = F.count("*").over(Window.partitionBy(group))
    name = F.concat(F.lit("eval-"), F.lpad(F.col("_k").cast("string"), 4, "0"))
    return rows.withColumn("_k", k).withColumn("behind", n - F.col("_k")).withColumn("challenge", name).drop("_k")


def pooled_rows(rows: DataFrame, group: str, key: str, most: int, seed: str) -> DataFrame:
    """Up to ``most`` references of each group in seeded order: (group, k, key)."""
    return top_each(rows.select(group, key), group, [seeded(seed, F.col(key)), F.col(key)], most)
