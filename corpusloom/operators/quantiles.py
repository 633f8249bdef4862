"""Exact order statistics and linear quantiles without a task that holds every value.

A sketch brackets the wanted ranks; a second pass counts what lies below each
bracket and how often each different value inside it occurs, so ties take one row
however many they are; running counts over these lead to the ranks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rank error of the sketch is 1 / ACCURACY of the rows; groups of up to SMALL rows are bracketed as a whole.
ACCURACY, SMALL = 10_000, 100_000


def _joined(left: DataFrame, right: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """By the group columns, nulls included; a side without groups is one row."""
    if not by:
        return left.crossJoin(F.broadcast(right))  # one row
    right = right.select(*(F.col(c).alias(f"_k_{c}") for c in by), *(c for c in right.columns if c not in by))
    same = F.lit(True)
    for c in by:
        same = same & left[c].eqNullSafe(right[f"_k_{c}"])
    return left.join(right, same, how).drop(*(f"_k_{c}" for c in by))


def order_statistics(rows: DataFrame, value: Column, wanted: list[tuple[float, Callable[[Column], Column]]], by: list[str] = []) -> DataFrame:
    """(*by, n, s0, s1, ...): the value at each wanted rank, counted from 0; null for a group without values.

    A wanted rank is a share of the rows near which it lies and a function from
    the number of values to the rank.  Null values do not count.
    """
    slack = 2.0 / ACCURACY
    x = rows.select(*by, value.cast("double").alias("_x"))
    shares = sorted({m for m, _ in wanted})
    ends = [max(0.0, m - slack) for m in shares] + [min(1.0, m + slack) for m in shares]
    sketch = x.groupBy(*by).agg(
        F.count("_x").alias("n"), F.min("_x").alias("_low"), F.max("_x").alias("_high"), F.percentile_approx("_x", ends, ACCURACY).alias("_ends"),
    )
    k = len(shares)
    small = F.col("n") <= SMALL
    brackets = sketch.select(
        *by, "n",
        *(F.when(small, F.col("_low")).otherwise(F.col("_ends")[i]).alias(f"_a{i}") for i in range(k)),
        *(F.when(small, F.col("_high")).otherwise(F.col("_ends")[k + i]).alias(f"_b{i}") for i in range(k)),
    )
    there = _joined(x.where("_x is not null"), brackets.drop("n"), by)
    inside = [F.col("_x").between(F.col(f"_a{i}"), F.col(f"_b{i}")) for i in range(k)]
    below = there.groupBy(*by).agg(*(F.count_if(F.col("_x") < F.col(f"_a{i}")).alias(f"_below{i}") for i in range(k)))
    any_of = inside[0]
    for c in inside[1:]:
        any_of = any_of | c
    values = there.where(any_of).groupBy(*by, "_x").agg(F.count("*").alias("_c"), *(F.first(c).alias(f"_in{i}") for i, c in enumerate(inside)))
    upto = Window.partitionBy(*by).orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = values.select(*by, "_x", *(F.when(F.col(f"_in{i}"), F.sum(F.when(F.col(f"_in{i}"), F.col("_c"))).over(upto)).alias(f"_upto{i}") for i in range(k)))
    counted = _joined(values, _joined(brackets.select(*by, "n"), below, by, "left"), by)
    picks = []
    for j, (m, rank) in enumerate(wanted):
        i = shares.index(m)
        picks.append(F.min(F.when(F.col(f"_upto{i}") > rank(F.col("n")) - F.col(f"_below{i}"), F.col("_x"))).alias(f"s{j}"))
    found = counted.groupBy(*by).agg(*picks)
    return _joined(brackets.select(*by, "n"), found, by, "left")


def quantiles(rows: DataFrame, value: Column, marks: list[float], by: list[str] = []) -> DataFrame:
    """(*by, n, q): ``q`` has the linearly interpolated quantile of each mark, null for a group without values.

    Null values do not count.
    """
    at = lambda n, m: (n - 1) * F.lit(m)
    wanted = [(m, end) for m in marks for end in (lambda n, m=m: F.floor(at(n, m)), lambda n, m=m: F.ceil(at(n, m)))]
    found = order_statistics(rows, value, wanted, by)

    def between(j: int, m: float) -> Column:
        low, high = F.col(f"s{2 * j}"), F.col(f"s{2 * j + 1}")
        return low + (at(F.col("n"), m) - F.floor(at(F.col("n"), m))) * (high - low)

    return found.select(*by, "n", F.array(*(between(j, m) for j, m in enumerate(marks))).alias("q"))


def exclusive_quantiles(rows: DataFrame, value: Column, k: int, of: int, by: list[str] = []) -> DataFrame:
    """(*by, n, q): the k-th of ``of`` - 1 cut points by the exclusive method; the only value where there is one."""
    place = lambda n: F.least(F.greatest(F.floor(F.lit(k) * (n + 1) / of), F.lit(1)), n - 1)
    found = order_statistics(rows, value, [(k / of, lambda n: F.greatest(place(n) - 1, F.lit(0))), (k / of, lambda n: F.greatest(place(n), F.lit(0)))], by)
    rest = F.lit(k) * (F.col("n") + 1) - place(F.col("n")) * of
    return found.select(*by, "n", F.when(F.col("n") == 1, F.col("s0")).otherwise((F.col("s0") * (of - rest) + F.col("s1") * rest) / of).alias("q"))
