"""Sweeps over configurations in two phases: all on a small part of the holdout, survivors on the whole of it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..tables import written
from .evaluation import bootstrap_means

#: Positions of the holdout in the first phase.
FIRST = 256


def bounds(diffs: DataFrame, replicates: int, seed: str, alpha: float) -> DataFrame:
    """(config, n, mu, loss, low, high): means of a configuration's differences and losses, and its bootstrap bounds at alpha and 1 - alpha."""
    means = bootstrap_means(diffs.sparkSession, diffs, "pos", replicates, seed, ["config"])
    cut = means.groupBy("config").agg(F.percentile("mean", F.lit(alpha)).alias("low"), F.percentile("mean", F.lit(1 - alpha)).alias("high"))  # ``replicates`` values
    point = diffs.groupBy("config").agg(F.count("*").alias("n"), F.avg("diff").alias("mu"), F.avg("loss").alias("loss"))
    return point.join(cut, "config")


def two_phase_sweep(
    configs: DataFrame, score: Callable[[DataFrame, int, int], DataFrame], n: int, replicates: int, seed: str, alpha: float, first: int = FIRST
) -> DataFrame:
    """(config, phase, n, mu, loss, low, high, place): a row for each configuration in each phase it came to.

    ``score`` takes (config) rows and a range of holdout positions and returns
    (config, pos, loss, diff).  After the ``first`` positions a configuration goes
    on if its upper bound reaches the best lower bound, so one that could still
    win is not dropped; survivors are scored on the other positions only, and
    their first losses are used again.  Places are by lower bound, mean, loss and
    name within a phase.
    """
    early = written(score(configs.select("config").distinct(), 0, min(first, n)))
    micro = written(bounds(early, replicates, f"{seed}:micro", alpha))
    best = micro.agg(F.max("low").alias("best"))
    going = written(micro.crossJoin(F.broadcast(best)).where("high >= best").select("config"))  # one row
    parts = early.join(going, "config", "left_semi")
    if first < n:
        parts = parts.unionByName(written(score(going, first, n)))
    whole = bounds(written(parts), replicates, f"{seed}:full", alpha)
    both = micro.withColumn("phase", F.lit("micro")).unionByName(whole.withColumn("phase", F.lit("full")))
    place = F.row_number().over(Window.partitionBy("phase").orderBy(F.desc("low"), F.desc("mu"), "loss", "config"))  # configurations
    return both.select("config", "phase", "n", "mu", "loss", "low", "high", place.cast("long").alias("place"))
