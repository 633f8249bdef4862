"""Screening of mixture sources before training on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .curriculum import BUCKETS, finite
from .quantiles import quantiles


def trainability(rows: DataFrame, source: str, shards: DataFrame, train_alloc: int, mix: tuple[float, float, float] = (0.6, 0.3, 0.1)) -> DataFrame:
    """One row for each source: bucket counts, score, achievable size and issues.

    ``rows`` are scored and bucketed; ``shards`` has (source, shards_cached).
    """
    g, h, e = (x / sum(mix) for x in mix)
    want_hard, want_general = int(train_alloc * h), int(train_alloc * g)
    want_easy = train_alloc - want_general - want_hard
    clean_loss = F.when((F.col("bucket") != "suspicious") & finite(), F.col("loss"))
    per = rows.groupBy(source).agg(
        *(F.count_if(F.col("bucket") == b).alias(b) for b in BUCKETS), F.count("*").alias("n_scored"),
    )
    marks = quantiles(rows, clean_loss, [0.5, 0.85], [source]).select(F.col(source).alias("_s"), F.col("q")[0].alias("p50"), F.col("q")[1].alias("p85"))
    per = per.join(marks, per[source].eqNullSafe(marks["_s"])).drop("_s")
    per = per.join(shards, source, "left").withColumn("shards_cached", F.coalesce("shards_cached", F.lit(0)))
    per = per.withColumn("clean_n", F.col("general") + F.col("hard") + F.col("easy"))
    per = per.withColumn("hard_frac", F.coalesce(F.try_divide(F.col("hard"), F.col("clean_n")), F.lit(0.0)))
    per = per.withColumn("spread", F.coalesce(F.col("p85") - F.col("p50"), F.lit(0.0))).withColumn("susp_frac", F.col("suspicious") / F.col("n_scored"))
    per = per.withColumn("hard_saturated", F.lit(want_hard > 0) & (F.col("hard") <= want_hard))
    per = per.withColumn(
        "achievable",
        F.least(F.lit(train_alloc), F.col("clean_n"), want_general + F.least(F.lit(want_hard), F.col("hard")) + F.least(F.lit(want_easy), F.col("easy"))),
    )
    score = (
        0.35 * F.least(F.lit(1.0), F.col("hard_frac") / 0.15)
        + 0.25 * F.least(F.lit(1.0), F.col("spread") / 0.5)
        + 0.20 * F.when(F.col("shards_cached") > 0, F.least(F.lit(1.0), F.col("shards_cached") / 12.0)).otherwise(0.2)
        + 0.10 * F.least(F.lit(1.0), F.col("clean_n") / 1500.0)
        + 0.10 * F.greatest(F.lit(0.0), 1.0 - 5.0 * F.col("susp_frac"))
    )
    issues = F.array_compact(F.array(
        F.when(F.col("shards_cached") < 4, "low_shard_cache"),
        F.when(F.col("hard_saturated"), "hard_saturated"),
        F.when(F.col("achievable") < 0.85 * train_alloc, "train_undersized"),
        F.when(F.col("susp_frac") > 0.05, "suspicious_frac"),
        F.when(F.col("clean_n") < 200, "small_scored_pool"),
    ))
    return per.select(source, "n_scored", "clean_n", "hard_frac", "spread", "susp_frac", "hard_saturated", "achievable", score.alias("score"), F.array_join(issues, ",").alias("issues"))


def suggested_mix(hard_frac: Column, usable: Column, mix: tuple[float, float, float] = (0.6, 0.3, 0.1)) -> dict[str, Column]:
    """Bucket shares that the scored pool can supply: at most nine tenths of its hard rows."""
    g, h, e = (x / sum(mix) for x in mix)
    most = F.least(F.lit(h), hard_frac * 0.9)
    hard = F.when((F.lit(h) > 0) & (most < 0.05), F.least(F.lit(h), hard_frac)).otherwise(most)
    rest = F.greatest(F.lit(0.0), 1.0 - hard)
    general = g / max(g + e, 1e-9) * rest
    return {
        "general": F.when(usable, general).otherwise(0.6),
        "hard": F.when(usable, hard).otherwise(0.3),
        "easy": F.when(usable, F.greatest(rest - general, F.lit(0.0))).otherwise(0.1),
    }


def suggested_weights(scores: DataFrame, source: str, least: float = 0.03) -> DataFrame:
    """(source, suggested): half the prior ``weight``, half the share of ``score``, floored and normalised.

    Sums are one-row joins, so any number of sources does.
    """
    s = scores.select(source, "weight", F.greatest(F.lit(0.05), F.col("score")).alias("s"))
    s = s.crossJoin(F.broadcast(s.agg(F.sum("s").alias("_s")))).withColumn("b", 0.5 * F.col("weight") + 0.5 * F.col("s") / F.col("_s"))
    s = s.crossJoin(F.broadcast(s.agg(F.sum("b").alias("_b")))).withColumn("f", F.greatest(F.lit(least), F.col("b") / F.col("_b")))
    return s.crossJoin(F.broadcast(s.agg(F.sum("f").alias("_f")))).select(source, (F.col("f") / F.col("_f")).alias("suggested"))
