"""Loss percentiles, buckets and disjoint, stratified train and validation sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import seeded
from ..functions.tokens import ngram_repeat_ratio, repeat_ratio, suspicious, unique_ratio
from .quantiles import quantiles
from .scoring import Scorer, UnigramScorer

BUCKETS = ("general", "hard", "easy", "suspicious")


def scored_rows(rows: DataFrame, key: str, ids: str = "ids", scorer: Scorer | None = None) -> DataFrame:
    """``rows`` that have tokens, with loss, unique_r, rep_r and rep_ng4."""
    scorer = scorer or UnigramScorer(rows, ids)
    if isinstance(scorer, UnigramScorer):
        return scorer.score_measured(rows, key, ids)
    losses = scorer.score(rows, key, ids)
    measured = rows.select(
        *(c for c in rows.columns if c != ids),
        unique_ratio(F.col(ids)).alias("unique_r"), repeat_ratio(F.col(ids)).alias("rep_r"), ngram_repeat_ratio(F.col(ids)).alias("rep_ng4"),
    )
    return measured.join(losses.select(key, "loss"), key).select(*(c for c in rows.columns if c != ids), "loss", "unique_r", "rep_r", "rep_ng4")


def finite(loss: str = "loss") -> Column:
    x = F.col(loss)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def loss_summary(rows: DataFrame, *by: str) -> DataFrame:
    """Count, extremes, mean, population deviation and linear percentiles of the finite losses."""
    marks = [0.10, 0.25, 0.50, 0.75, 0.85, 0.90]
    good = rows.where(finite())
    out = good.groupBy(*by).agg(
        F.count("*").alias("n"), F.min("loss").alias("min"), F.max("loss").alias("max"), F.avg("loss").alias("mean"), F.stddev_pop("loss").alias("std")
    )
    p = quantiles(good, F.col("loss"), marks, list(by)).select(*(F.col(c).alias(f"_{c}") for c in by), "q")
    same = F.lit(True)
    for c in by:
        same = same & out[c].eqNullSafe(p[f"_{c}"])
    return out.join(p, same).select(*by, "n", "min", "max", "mean", "std", *(F.col("q")[k].alias(f"p{round(m * 100)}") for k, m in enumerate(marks)))


def loss_cuts(rows: DataFrame) -> DataFrame:
    """One row: the median p50 and the 85th percentile p85 of all finite losses."""
    return quantiles(rows.where(finite()), F.col("loss"), [0.5, 0.85]).select(F.col("q")[0].alias("p50"), F.col("q")[1].alias("p85"))


def assign_buckets(rows: DataFrame) -> DataFrame:
    """Adds bucket: suspicious first, then by the 85th percentile and 0.8 of the median of all finite losses.

    A bucket that a row already has, and that is not empty, stays.
    """
    odd = suspicious(F.col("loss"), F.col("unique_r"), F.col("rep_r"), F.col("rep_ng4"))
    new = F.when(odd, "suspicious").when(F.col("loss") >= F.col("p85"), "hard").when(F.col("loss") >= 0.8 * F.col("p50"), "general").otherwise("easy")
    if "bucket" in rows.columns:
        new = F.coalesce(F.nullif(F.col("bucket"), F.lit("")), new)
    return rows.crossJoin(F.broadcast(loss_cuts(rows))).withColumn("bucket", new).drop("p50", "p85")  # one row of cuts


def older_buckets(rows: DataFrame) -> DataFrame:
    """The older rule: general also asks for a loss of at most the 85th percentile."""
    odd = suspicious(F.col("loss"), F.col("unique_r"), F.col("rep_r"), F.col("rep_ng4"))
    general = (F.col("loss") >= 0.8 * F.col("p50")) & (F.col("loss") <= F.col("p85"))
    new = F.when(odd, "suspicious").when(F.col("loss") >= F.col("p85"), "hard").when(general, "general").otherwise("easy")
    return rows.crossJoin(F.broadcast(loss_cuts(rows))).withColumn("bucket", new).drop("p50", "p85")  # one row of cuts


def bucket_counts(rows: DataFrame, *by: str) -> DataFrame:
    """Counts of all buckets, zero where empty, and the mean loss of the clean rows."""
    return rows.groupBy(*by).agg(
        *(F.count_if(F.col("bucket") == b).alias(b) for b in BUCKETS),
        F.count("*").alias("n"), F.avg(F.when(F.col("bucket") != "suspicious", F.col("loss"))).alias("clean_loss"),
    )


def ranked(rows: DataFrame, seed: str, keys: list[str], by: list[str], out: str) -> DataFrame:
    """Adds the 1-based place in the seeded order within ``by``."""
    w = Window.partitionBy(*by).orderBy(seeded(seed, *(F.col(k) for k in keys)), *keys)
    return rows.withColumn(out, F.row_number().over(w))


def split_curriculum(
    rows: DataFrame, keys: list[str], by: list[str], seed: str, val_size: int, train_size: int,
    general: float = 0.6, hard: float = 0.3, easy: float = 0.1,
) -> DataFrame:
    """(…, split): validation rows first, then training rows by bucket quota, disjoint by key.

    Works within each value of ``by``, or over all rows where it is empty.  Shares are normalised, quotas cut to
    integers, the remainder goes to easy; a short bucket is not topped up.
    """
    total = general + hard + easy
    n_general, n_hard = int(train_size * general / total), int(train_size * hard / total)
    clean = rows.where("bucket <> 'suspicious'")
    # Filters on a rank by a number keep that many rows of each task before anything is shuffled.
    val = ranked(clean, f"{seed}:val", keys, by, "_v").where(F.col("_v") <= val_size).drop("_v").withColumn("split", F.lit("val"))
    taken = val.select(*(F.col(k).alias(f"_{k}") for k in [*by, *keys]))
    same = F.lit(True)
    for k in [*by, *keys]:
        same = same & clean[k].eqNullSafe(taken[f"_{k}"])
    pool = ranked(clean.join(F.broadcast(taken) if len(by) == 0 else taken, same, "left_anti"), f"{seed}:train", keys, [*by, "bucket"], "_t")
    n_easy = train_size - n_general - n_hard
    quota = F.when(F.col("bucket") == "general", n_general).when(F.col("bucket") == "hard", n_hard).otherwise(n_easy)
    train = pool.where(F.col("_t") <= max(n_general, n_hard, n_easy)).where(F.col("_t") <= quota).drop("_t").withColumn("split", F.lit("train"))
    return val.unionByName(train)
