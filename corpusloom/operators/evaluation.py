"""Paired comparison of two models by bootstrap, and the decisions drawn from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.hashing import seeded, uniform
from .sampling import index_below


def paired_differences(king: DataFrame, challenger: DataFrame, key: str) -> DataFrame:
    """(key, king_loss, challenger_loss, diff): positive where the challenger is better."""
    k = king.select(key, F.col("loss").alias("king_loss"))
    c = challenger.select(key, F.col("loss").alias("challenger_loss"))
    return k.join(c, key).withColumn("diff", F.col("king_loss") - F.col("challenger_loss"))


def bootstrap_means(spark: SparkSession, diffs: DataFrame, position: str, replicates: int, seed: str, by: list[str] = []) -> DataFrame:
    """(*by, replicate, mean): each resamples all n differences with replacement, within each value of ``by``.

    ``diffs`` is a holdout of a fixed number of rows with positions 0..n-1 within
    ``by``; indices are hashes of (seed, *by, replicate, slot), and the resampling
    is a join.
    """
    n = diffs.groupBy(*by).agg(F.count("*").alias("n"))
    slots = spark.range(replicates).select(F.col("id").alias("replicate")).crossJoin(F.broadcast(n))  # one row for each source
    slots = slots.where("n > 0").withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    slots = slots.withColumn("pick", index_below(seed, F.col("n"), *(F.col(c) for c in by), F.col("replicate"), F.col("slot")))
    held = diffs.select(*by, F.col(position).alias("pick"), "diff")
    return slots.join(F.broadcast(held), [*by, "pick"]).groupBy(*by, "replicate").agg(F.avg("diff").alias("mean"))  # the holdout


def weighted_bootstrap_means(spark: SparkSession, diffs: DataFrame, replicates: int, seed: str) -> DataFrame:
    """As above, with draws in proportion to ``weight``: ``diffs`` has cumulative bounds (lo, hi] of [0, 1)."""
    n = diffs.agg(F.count("*").alias("n"))
    slots = spark.range(replicates).select(F.col("id").alias("replicate")).crossJoin(F.broadcast(n))
    slots = slots.where("n > 0").withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    slots = slots.withColumn("u", uniform(seeded(seed, F.col("replicate"), F.col("slot"))))
    # A range join by grid cell: a draw meets only the differences whose interval touches its cell.
    cells = 1024
    grid = diffs.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * cells), F.floor(F.least(F.col("hi"), F.lit(0.9999999)) * cells))))
    # The holdout is broadcast by name: the planner takes the slots, which it sees before they are exploded, for the smaller side.
    hit = slots.withColumn("cell", F.floor(F.col("u") * cells)).join(F.broadcast(grid), "cell").where("u >= lo and u < hi")
    return hit.groupBy("replicate").agg(F.avg("diff").alias("mean"))


def lower_bound(means: DataFrame, alpha: float) -> DataFrame:
    """One row: the linear alpha-quantile of the replicate means; 0 without any."""
    return means.agg(F.coalesce(F.percentile("mean", F.lit(alpha)), F.lit(0.0)).alias("lcb"))


def accepted_locally(lcb: str, mu: str, floor: float, least_mu: float) -> tuple[Column, Column]:
    """(accepted, reasons): the bound above the floor and the mean at its floor or above; reasons list what fails."""
    low = F.when(F.col(lcb) <= floor, "lcb")
    small = F.when((F.lit(least_mu) > 0) & (F.col(mu) < least_mu), "mu_hat")
    return (F.col(lcb) > floor) & (F.col(mu) >= least_mu), F.concat_ws(",", low, small)


def component_means(diffs: DataFrame, position: str, public: int) -> DataFrame:
    """One row: means of the differences at positions below ``public`` and from there on; 0 where there are none."""
    first = F.col(position) < public
    mean = lambda c: F.coalesce(F.avg(F.when(c, F.col("diff"))), F.lit(0.0))
    return diffs.agg(
        F.count("*").alias("n"), F.count_if(first).alias("n_public"), mean(first).alias("mu_public"), mean(~first).alias("mu_private"),
        F.coalesce(F.avg("diff"), F.lit(0.0)).alias("mu_hat"),
    )


def source_verdicts(spark: SparkSession, diffs: DataFrame, replicates: int, seed: str, alpha: float, floor: float, guarded: Column, least: float = -0.001) -> DataFrame:
    """One row for each source of a holdout: n, mean, bound, whether accepted, and whether a guarded source has regressed.

    A guarded source regresses when its mean or its bound lies below ``least``.
    """
    placed = diffs.withColumn("_at", (F.row_number().over(Window.partitionBy("source").orderBy("pos")) - 1).cast("long"))
    means = bootstrap_means(spark, placed, "_at", replicates, seed, ["source"])
    bound = means.groupBy("source").agg(F.percentile("mean", F.lit(alpha)).alias("lcb"))  # ``replicates`` values
    point = diffs.groupBy("source").agg(F.count("*").alias("n"), F.avg("diff").alias("mu_hat"))
    out = point.join(bound, "source").withColumn("guarded", guarded)
    bad = F.col("guarded") & ((F.col("mu_hat") < least) | (F.col("lcb") < least))
    return out.withColumn("accepted", F.col("lcb") > floor).withColumn("regressed", bad)


def pooled_verdict(diffs: DataFrame, means: DataFrame, sources: DataFrame, alpha: float, floor: float, least_mu: float = 0.0) -> DataFrame:
    """One row over all sources: ``diffs`` has ``weight`` summing to 1, ``means`` are weighted replicate means.

    Sources that have regressed are reasons beside the two floors.
    """
    point = diffs.agg(F.count("*").alias("n_eval"), F.coalesce(F.sum(F.col("weight") * F.col("diff")), F.lit(0.0)).alias("mixture_mu"))
    warned = sources.agg(F.array_join(F.sort_array(F.collect_list(F.when(F.col("regressed"), F.col("source")))), ",").alias("warnings"))
    out = point.crossJoin(F.broadcast(lower_bound(means, alpha).withColumnRenamed("lcb", "mixture_lcb"))).crossJoin(F.broadcast(warned))  # one row each
    ok, why = accepted_locally("mixture_lcb", "mixture_mu", floor, least_mu)
    return out.withColumn("accepted", ok & (F.col("n_eval") > 0)).withColumn("reasons", F.concat_ws(",", F.nullif(why, F.lit("")), F.nullif("warnings", F.lit("")))).drop("warnings")


def verdict(diffs: DataFrame, means: DataFrame, alpha: float, delta: float) -> DataFrame:
    """One row: mean difference, bound, average losses and whether the challenger is accepted (bound > delta)."""
    point = diffs.agg(
        F.count("*").alias("n"), F.coalesce(F.avg("diff"), F.lit(0.0)).alias("mu_hat"),
        F.avg("king_loss").alias("avg_king_loss"), F.avg("challenger_loss").alias("avg_challenger_loss"),
    )
    return point.crossJoin(F.broadcast(lower_bound(means, alpha))).withColumn("accepted", F.col("lcb") > delta)  # one row each


def decision(lcb: str, mu: str, n: str, warned: str, floor: float = 0.0025, margin: float = 0.0035, preferred_mu: float = 0.0075, least_n: int = 3000):
    """Four-way verdict; a regression warning comes before everything."""
    return (
        F.when(F.col(warned), "DO_NOT_SUBMIT").when(F.col(lcb) <= floor, "DO_NOT_SUBMIT")
        .when(F.col(n) < least_n, "PROMISING_NEEDS_MORE_EVAL")
        .when((F.col(lcb) >= margin) & (F.col(mu) >= preferred_mu), "READY_TO_UPLOAD").otherwise("READY_TO_MERGE")
    )


def two_part_holdout(public: DataFrame, private: DataFrame, order: str, ids: str = "ids") -> tuple[DataFrame, int]:
    """(pos, component, ids) of a public and a private holdout, one after the other, and the number of public rows.

    ``order`` numbers the rows of each part from 0.  An empty private part leaves
    the public one alone.
    """
    n = public.count()  # a holdout of a fixed size
    first = public.select(F.col(order).cast("long").alias("pos"), F.lit("public").alias("component"), ids)
    rest = private.select((F.col(order) + n).cast("long").alias("pos"), F.lit("private").alias("component"), ids)
    return first.unionByName(rest), n


def audit_record(spark: SparkSession, diffs: DataFrame, public: int, replicates: int, seed: str, alpha: float, delta: float) -> DataFrame:
    """One row: the verdict over both parts of a holdout, the means of each, and the settings it rests on."""
    v = verdict(diffs, bootstrap_means(spark, diffs, "pos", replicates, seed), alpha, delta)
    parts = component_means(diffs, "pos", public).select("n_public", "mu_public", "mu_private")
    settings = [F.lit(replicates).cast("long").alias("n_bootstrap"), F.lit(alpha).alias("alpha"), F.lit(delta).alias("delta")]
    return v.crossJoin(F.broadcast(parts)).select("*", (F.col("n") - F.col("n_public")).alias("n_private"), *settings)  # one row each
