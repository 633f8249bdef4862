"""Corpus build and curation as jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import QualityRules, reject_reason
from ..functions.tokens import tokens
from ..operators import curriculum, packing
from ..operators.scoring import Scorer


def source_order(texts: DataFrame) -> DataFrame:
    """Adds doc_id, the place of a row by file name and row in the file, for a DataFrame read from Parquet files."""
    rows = texts.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    files = texts.select(F.col("_metadata.file_path").alias("_name")).distinct()
    files = files.withColumn("_place", F.row_number().over(Window.orderBy("_name")) - 1)  # a listing of files
    return rows.join(F.broadcast(files), rows["_file"] == files["_name"]).withColumn(
        "doc_id", F.shiftleft(F.col("_place").cast("long"), 40) + F.col("_row")
    ).drop("_file", "_row", "_name", "_place")


def build_corpus(spark: SparkSession, source: str, out: str, length: int = 2048, rows_per_shard: int = 4096, train_shards: int = 1, rules: QualityRules = QualityRules()) -> DataFrame:
    """Texts to filtered, tokenized, packed and sharded windows; writes windows by split and shard, and the manifest.

    Documents are packed in the order of their files and rows.
    """
    texts = source_order(spark.read.parquet(source))
    good = texts.where(reject_reason(F.col("text"), rules).isNull())
    ids = good.select("doc_id", F.concat(tokens(F.col("text")), F.array(F.lit("<end>"))).alias("ids"))
    windows = packing.assign_shards(packing.pack_windows(ids, length), rows_per_shard, train_shards)
    windows.write.partitionBy("split", "shard").parquet(f"{out}/windows")
    written = spark.read.parquet(f"{out}/windows")
    listed = packing.manifest(written, F.md5(F.array_join("ids", " ").cast("binary")))
    listed.write.json(f"{out}/manifest")
    return listed


def score_and_curate(rows: DataFrame, key: str, source: str, out: str, seed: str, val_size: int, train_size: int, scorer: Scorer | None = None) -> DataFrame:
    """Scores, buckets and splits rows of (key, source, ids); writes the scored table and the curriculum, as JSON lines of tokens."""
    scored = curriculum.assign_buckets(curriculum.scored_rows(rows, key, "ids", scorer))
    scored.write.partitionBy(source).parquet(f"{out}/scored")
    chosen = curriculum.split_curriculum(rows.sparkSession.read.parquet(f"{out}/scored"), [key], [source], seed, val_size, train_size)
    chosen = chosen.join(rows.select(key, F.col("ids").alias("input_ids")), key)
    chosen.write.partitionBy("split").json(f"{out}/curriculum")
    schema = chosen.select(key, source, "bucket", "input_ids", "split").schema
    return rows.sparkSession.read.schema(schema).json(f"{out}/curriculum")
