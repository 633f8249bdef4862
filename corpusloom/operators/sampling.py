"""Seeded samples, weighted draws and allocations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import number, seeded, uniform


def take(rows: DataFrame, n: int, seed: str, *keys: str) -> DataFrame:
    """n rows without replacement, with ``rk`` their place in the sample; a sort and limit, no global window."""
    digest = seeded(seed, *(F.col(k) for k in keys))
    top = rows.withColumn("_h", digest).orderBy("_h", *keys).limit(n)
    return top.withColumn("rk", F.row_number().over(Window.orderBy("_h", *keys))).drop("_h")  # n rows


def take_each(rows: DataFrame, n: int, seed: str, by: list[str], *keys: str) -> DataFrame:
    """Up to n rows of each group, with ``rk``."""
    w = Window.partitionBy(*by).orderBy(seeded(seed, *(F.col(k) for k in keys)), *keys)
    return rows.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= n)


def normalised(weights: DataFrame, weight: str = "weight") -> DataFrame:
    """Positive weights divided by their sum."""
    good = weights.where(F.col(weight) > 0)
    total = good.agg(F.sum(weight).alias("_total"))
    return good.crossJoin(F.broadcast(total)).withColumn(weight, F.col(weight) / F.col("_total")).drop("_total")  # one row


def weighted_draws(draws: DataFrame, weights: DataFrame, seed: str, order: str, weight: str = "weight") -> DataFrame:
    """Each draw (a row with ``draw``) with the row of ``weights`` it falls on, with replacement.

    ``weights`` is a source table, of which there are few; their cumulative
    intervals go to every task as one sorted array, which each draw passes, so
    there is no join by range.  The work for a draw grows with the sources.
    """
    w = Window.orderBy(order)
    intervals = normalised(weights, weight)
    high = F.sum(weight).over(w.rowsBetween(Window.unboundedPreceding, 0))
    last = F.row_number().over(Window.orderBy(F.col(order).desc())) == 1
    intervals = intervals.withColumn("_hi", F.when(last, F.lit(2.0)).otherwise(high))
    one = intervals.agg(F.array_sort(F.collect_list(F.struct("_hi", *weights.columns))).alias("_intervals"))
    u = draws.withColumn("u", uniform(seeded(seed, F.col("draw")))).crossJoin(F.broadcast(one))  # one row
    hit = F.get(F.filter("_intervals", lambda x: x["_hi"] > F.col("u")), F.lit(0))
    return u.withColumn("_hit", hit).where("_hit is not null").select(*draws.columns, "u", *(F.col(f"_hit.{c}") for c in weights.columns))


def index_below(seed: str, n: Column, *keys: Column) -> Column:
    """A repeatable index in 0..n-1."""
    return F.pmod(number(seeded(seed, *keys)), n)


def largest_remainder(shares: DataFrame, by: list[str], order: str, least: int = 1) -> DataFrame:
    """Adds alloc: ``total`` split by ``weight`` (summing to 1 within ``by``), at least ``least`` each.

    The minimum is dropped where the total is too small; the units left after
    rounding down go to the largest remainders, in input order on ties.
    """
    each = Window.partitionBy(*by)
    k = F.count("*").over(each)
    base = shares.withColumn("_m", F.when(F.col("total") >= k * least, F.lit(least)).otherwise(F.lit(0)))
    base = base.withColumn("_raw", F.col("weight") * (F.col("total") - k * F.col("_m"))).withColumn("_base", F.col("_m") + F.floor("_raw"))
    rank = F.row_number().over(each.orderBy((F.round("_raw", 9) - F.floor("_raw")).desc(), order))
    left = F.col("total") - F.sum("_base").over(each)
    base = base.withColumn("_left", left).withColumn("_rank", rank)
    return base.withColumn("alloc", (F.col("_base") + (F.col("_rank") <= F.col("_left")).cast("int")).cast("long")).drop("_m", "_raw", "_base", "_left", "_rank")


def proportional_take(sources: DataFrame, order: str, total: int) -> DataFrame:
    """Adds pick: round(total * weight), at least 1 and at most ``size``, in order until the total is
    used up; the last source takes what is left."""
    w = Window.orderBy(order)
    last = F.row_number().over(Window.orderBy(F.col(order).desc())) == 1
    cap = F.when(last, F.col("size")).otherwise(F.least(F.greatest(F.lit(1), F.bround(F.lit(total) * F.col("weight")).cast("long")), F.col("size")))
    capped = sources.withColumn("_cap", cap)
    used = F.coalesce(F.sum("_cap").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return capped.withColumn("pick", F.least(F.col("_cap"), F.greatest(F.lit(0), total - used)).cast("long")).drop("_cap")
