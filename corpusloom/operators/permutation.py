"""Samples without replacement by index: a keyed permutation of 0..N-1 instead of a sort or scan.

The permutation is a Feistel network over pairs (l, r) of a x b numbers, a the
least with a * a >= N and b the least with a * b >= N; rounds add a hash of one half to the
other, in turn, modulo a and b.  A result of N or more goes through again (cycle
walking), which seldom happens: fewer than a of the a * b pairs lie beyond N.  So
the first n images are n different indices, drawn in O(n) whatever N is, and any
one of them can be computed alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rounds of the network, and walks at most; below 4,096 indices fewer are needed, above the chance to need more is under 2 ** -384.
ROUNDS, WALKS = 6, 64


def sides(total: Column) -> tuple[Column, Column]:
    """a and b for N indices."""
    root = F.sqrt(total.cast("double")).cast("long")
    a = F.greatest(root + (root * root < total).cast("long"), F.lit(1).cast("long"))
    return a, F.greatest(F.ceil(total / a).cast("long"), F.lit(1).cast("long"))


def keyed(seed: str, step: int, half: Column) -> Column:
    """60 bits from the seed, the round and one half."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:{step}:"), half.cast("string")).cast("binary")), 1, 15), 16, 10).cast("long")


def network(x: Column, a: Column, b: Column, seed: str) -> Column:
    """One pass through all rounds; a bijection of 0..a*b-1."""
    pair = F.struct(F.floor(x / b).cast("long").alias("l"), F.pmod(x, b).alias("r"))
    for step in range(ROUNDS):
        pair = F.transform(F.array(pair), _round(step, a, b, seed))[0]
    return F.transform(F.array(pair), lambda p: p["l"] * b + p["r"])[0]


def _round(step: int, a: Column, b: Column, seed: str):
    """A lambda for one round, so that its argument is computed once."""

    def even(p: Column) -> Column:
        return F.struct(F.pmod(p["l"] + keyed(seed, step, p["r"]), a).alias("l"), p["r"].alias("r"))

    def odd(p: Column) -> Column:
        return F.struct(p["l"].alias("l"), F.pmod(p["r"] + keyed(seed, step, p["l"]), b).alias("r"))

    return odd if step % 2 else even


def permuted(index: Column, total: Column, seed: str) -> Column:
    """The image of ``index`` (0..total-1) under the seed's permutation of 0..total-1."""
    a, b = sides(total)
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)), F.lit(-1).cast("long"),
        lambda x, _: F.when(x < 0, network(index, a, b, seed)).when(x >= total, network(x, a, b, seed)).otherwise(x),
    )
    return F.when(walk < total, walk).otherwise(F.raise_error(F.lit("the walk did not end")).cast("long"))


def sample_indices(spark: SparkSession, n: int, total: int, seed: str) -> DataFrame:
    """(draw, index): min(n, total) different indices of 0..total-1, in the order drawn."""
    draws = spark.range(min(n, total)).select(F.col("id").alias("draw"))
    return draws.withColumn("index", permuted(F.col("draw"), F.lit(total).cast("long"), seed))


def prefix_sums(counts: DataFrame, order: str, rows: str) -> DataFrame:
    """Adds first: the rows of all parts before.  ``counts`` is a listing, one row for each shard or source."""
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.where(F.col(rows) > 0).withColumn("first", F.coalesce(F.sum(rows).over(before), F.lit(0)).cast("long"))


def locate(indices: DataFrame, counts: DataFrame, order: str, rows: str, index: str = "index") -> DataFrame:
    """Each index with its part and ``row_idx``, the place in it.

    A join by equal steps of the index space instead of by range: a part stands
    in each step it touches, and with a step of the mean size these are at most
    twice as many rows as parts.
    """
    placed = prefix_sums(counts.select(order, rows), order, rows)
    step = placed.agg(F.greatest(F.lit(1), F.ceil(F.sum(rows) / F.count("*"))).cast("long").alias("_step"))
    steps = placed.crossJoin(F.broadcast(step))  # one row
    cell = F.sequence(F.floor(F.col("first") / F.col("_step")), F.floor((F.col("first") + F.col(rows) - 1) / F.col("_step")))
    steps = steps.withColumn("_cell", F.explode(cell)).withColumnRenamed(rows, "_rows").drop("_step")
    asked = indices.crossJoin(F.broadcast(step)).withColumn("_cell", F.floor(F.col(index) / F.col("_step"))).drop("_step")  # one row
    hit = asked.join(steps, "_cell").where((F.col(index) >= F.col("first")) & (F.col(index) < F.col("first") + F.col("_rows")))
    return hit.withColumn("row_idx", F.col(index) - F.col("first")).drop("_cell", "_rows", "first")
