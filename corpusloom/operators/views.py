"""Views for reports and dashboards: recent verdicts, payouts, bench rows, run reports and status texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Blocks of an hour, letters of a short key, rows of a dashboard's lists.
BLOCKS_PER_HOUR, SHORT, RECENT = 300, 16, 5


def short_key(key: Column) -> Column:
    return F.concat(F.substring(F.coalesce(key, F.lit("")), 1, SHORT), F.lit("..."))


def recent(rows: DataFrame, by: str, order: list[Column], most: int = RECENT) -> DataFrame:
    """The latest rows of each group with their place."""
    place = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return rows.withColumn("place", place).where(F.col("place") <= most)


def payouts(rows: DataFrame, per_block: str, price: Column, rate: Column) -> DataFrame:
    """Adds what a key earns an hour in its own unit, in the chain's and in money; unknown emissions count as 0."""
    hour = F.coalesce(per_block, F.lit(0.0)) * BLOCKS_PER_HOUR
    return rows.select("*", F.round(hour, 6).alias("per_hour"), F.round(hour * price, 8).alias("chain_per_hour"), F.round(hour * price * rate, 8).alias("money_per_hour"))


def bench_row(scores: DataFrame, run: str, task: str, score: str) -> DataFrame:
    """One row for each run: its scores as a sorted text, how many, and their mean; null scores are left out."""
    good = scores.where(F.col(score).isNotNull())
    cell = F.concat(F.col(task), F.lit("="), F.format_string("%.4f", F.col(score)))
    listed = F.array_join(F.array_sort(F.collect_list(cell)), " ")  # the tasks of one run
    return good.groupBy(run).agg(F.count("*").alias("n_tasks"), F.round(F.avg(score), 6).alias("mean"), listed.alias("scores"))


def run_report(buckets: DataFrame, run: str, bucket: str, n: str) -> DataFrame:
    """(run, report): a run's bucket counts as Markdown lines, the largest first."""
    row = F.struct((-F.col(n)).alias("by"), F.col(bucket).alias("name"), F.col(n).alias("n"))
    lines = F.transform(F.array_sort(F.collect_list(row)), lambda x: F.concat(F.lit("- "), x["name"], F.lit(": "), x["n"].cast("string")))  # few buckets
    return buckets.groupBy(run).agg(F.concat_ws("\n", F.concat(F.lit("# Run "), F.first(run)), F.lit(""), F.lit("## Curriculum"), F.array_join(lines, "\n")).alias("report"))


def status_text(done: Column, total: Column, failed: Column) -> Column:
    """``done/total`` with a percentage, and the failures where there are any."""
    share = F.when(total > 0, F.round(100 * done / total).cast("int")).otherwise(0)
    bad = F.when(failed > 0, F.concat(F.lit(", failed "), failed.cast("string"))).otherwise("")
    return F.concat(done.cast("string"), F.lit("/"), total.cast("string"), F.lit(" ("), share.cast("string"), F.lit("%)"), bad)
