"""Token shards, and text and JSON-lines sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .array_files import read_arrays


def read_token_shards(spark: SparkSession, path: str, length: int) -> DataFrame:
    """(shard_key, row_idx, input_ids) of all ``.npy`` files at or below a path, by ranges of rows."""
    return read_arrays(spark, path, length)


def read_texts(spark: SparkSession, path: str, column: str = "text", keep: list[str] = []) -> DataFrame:
    """(text, *keep) of Parquet files: the named column, else the first string column; null and empty ones dropped."""
    df = spark.read.parquet(path)
    name = column if column in df.columns else next(f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType))
    return df.select(F.col(name).alias("text"), *keep).where("text is not null and text <> ''")


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of JSON-lines files; blank and broken lines are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


# The names that manifests of different writers use for one thing.
ALIASES = {
    "key": ("key", "dest_key", "path"), "n_tokens": ("n_tokens", "num_tokens", "token_count"),
    "rows": ("rows", "num_sequences", "n_samples"), "size_bytes": ("size_bytes", "bytes"),
}


#: At most so many files of a folder stand in for a manifest.
LISTED = 10_000


def read_manifest(spark: SparkSession, path: str, folder: str | None = None) -> DataFrame:
    """One row for each shard of a manifest file, whatever its dialect: key, n_tokens, rows, size_bytes, split.

    A manifest without any list gives the Parquet files of ``folder``, sorted, or
    no rows without a folder.
    """
    raw = spark.read.option("multiLine", "true").json(path)
    lists = [c for c in ("shards", "files", "train_shards", "eval_shards") if c in raw.columns and raw.schema[c].dataType.simpleString().startswith("array<struct")]
    out = spark.createDataFrame([], "key string, n_tokens long, rows long, size_bytes long, split string")
    if not lists and folder:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(folder)
        out = files.select(F.col("path").alias("key"), F.col("length").alias("size_bytes")).orderBy("key").limit(LISTED)
        return out.select("key", F.lit(None).cast("long").alias("n_tokens"), F.lit(None).cast("long").alias("rows"), "size_bytes", F.lit(None).cast("string").alias("split"))
    for c in lists:
        one = raw.select(F.explode(c).alias("s"))
        there = {f.name for f in one.schema["s"].dataType.fields}
        cols = [
            F.coalesce(*(F.col(f"s.{a}") for a in names if a in there), F.lit(None)).cast("string" if k == "key" else "long").alias(k) for k, names in ALIASES.items()
        ]
        split = F.col("s.split") if "split" in there else F.lit({"train_shards": "train", "eval_shards": "eval"}.get(c)).cast("string")
        out = out.unionByName(one.select(*cols, split.alias("split")))
    return out.orderBy("key")
