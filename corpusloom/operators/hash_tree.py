"""Digests of large contents by a tree of hashes over fixed chunks.

A content is cut every ``leaf`` bytes; a leaf's digest is the SHA-256 of a zero
byte and its bytes, an inner one's that of a one byte and its ``FAN`` children, and
the root's that of a two byte, the length and the top digest.  Chunks of one content are
hashed by any tasks in any order, and no task holds more than ``FAN`` digests, so the
root is the same whatever the split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.array_files import fs, store_of
from ..tables import written

#: Bytes of a leaf and children of an inner digest.
LEAF, FAN = 8 << 20, 1024


def _sha(tag: int, content: Column) -> Column:
    return F.unhex(F.sha2(F.concat(F.lit(bytes([tag])), content), 256))


def roots(leaves: DataFrame, key: str) -> DataFrame:
    """(key, size, n_leaves, root) from (key, leaf_no, size, digest) of all leaves; the root in hex.

    An empty content has one leaf of no bytes.
    """
    whole = written(leaves.groupBy(key).agg(F.sum("size").alias("size"), F.count("*").alias("n_leaves")))
    counted = whole.select(F.col(key).alias("_of"), F.col("n_leaves").alias("left"))
    level = leaves.select(key, F.col("leaf_no").alias("at"), "digest").join(counted, F.col(key).eqNullSafe(F.col("_of"))).drop("_of")
    most = whole.agg(F.max("n_leaves")).first()[0] or 0
    while most > 1:
        rows = F.sort_array(F.collect_list(F.struct("at", "digest")))  # at most FAN
        inner = _sha(1, F.aggregate(rows, F.lit(b""), lambda x, r: F.concat(x, r["digest"])))
        # A content that has come down to one digest is done, whatever the others have.
        level = level.groupBy(key, F.floor(F.col("at") / FAN).alias("at"), F.col("left")).agg(F.when(F.col("left") == 1, F.first("digest")).otherwise(inner).alias("digest"))
        level = level.withColumn("left", F.ceil(F.col("left") / FAN))
        most = -(-most // FAN)
    length = F.unhex(F.lpad(F.hex("size"), 16, "0"))
    top = level.select(F.col(key).alias("_key"), "digest")
    return whole.join(top, F.col(key).eqNullSafe(F.col("_key"))).select(key, "size", "n_leaves", F.sha2(F.concat(F.lit(b"\x02"), length, "digest"), 256).alias("root"))


def row_digests(rows: DataFrame, key: str, content: str, leaf: int = LEAF) -> DataFrame:
    """(key, size, n_leaves, root) of a column of texts or bytes; null counts as empty.  Keys are distinct."""
    raw = rows.select(key, F.coalesce(F.col(content).cast("binary"), F.lit(b"")).alias("raw"))
    n = F.octet_length("raw")
    cut = raw.select(key, "raw", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(n / leaf).cast("int") - 1, F.lit(0)))).alias("leaf_no"))
    part = F.expr(f"substring(raw, leaf_no * {leaf} + 1, {leaf})")
    leaves = cut.select(key, F.col("leaf_no").cast("long").alias("leaf_no"), F.octet_length(part).cast("long").alias("size"), _sha(0, part).alias("digest"))
    return roots(leaves, key)


def file_digests(spark: SparkSession, path: str, suffix: str = "", leaf: int = LEAF) -> DataFrame:
    """(file, size, n_leaves, root) of the files at or below a path, leaves dealt over all tasks by byte range."""
    store, base = store_of(path.rstrip("/"))
    info = store.get_file_info(base)
    found = [info] if info.is_file else store.get_file_info(fs.FileSelector(base, recursive=True))
    listed = [(f.path, f.size) for f in found if f.is_file and f.path.endswith(suffix)]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, _ = store_of(path)
        for batch in it:
            made = []
            for name, size, k in zip(*(batch.column(c).to_pylist() for c in ("file", "size", "leaf_no"))):
                n = min(leaf, size - k * leaf)
                with at.open_input_file(name) as f:
                    raw = f.read_at(n, k * leaf)
                if len(raw) != n:
                    raise ValueError(f"{name}: shorter than listed")
                made.append((name, k, n, hashlib.sha256(b"\0" + raw).digest()))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in made], t) for c, t in enumerate(kinds)], ["file", "leaf_no", "size", "digest"])

    files = spark.createDataFrame(listed, "file string, size long")
    cut = files.select("file", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("size") / leaf) - 1, F.lit(0).cast("long")))).alias("leaf_no"))
    # Few leaves to an Arrow batch are enough; ranges keep neighbouring bytes together.
    cut = cut.repartitionByRange("file", "leaf_no")
    return roots(cut.mapInArrow(batches, "file string, leaf_no long, size long, digest binary"), "file")


def folder_digest(digests: DataFrame, folder: Column) -> DataFrame:
    """(folder, n_files, size, digest): one digest over the names and roots of a folder's files, sorted by name; a row for each file is listed."""
    named = F.array_sort(F.collect_list(F.concat_ws(":", F.substring_index("file", "/", -1), "root")))
    return digests.groupBy(folder.alias("folder")).agg(F.count("*").alias("n_files"), F.sum("size").alias("size"), F.sha2(F.array_join(named, "\n"), 256).alias("digest"))
