"""What the operators of this subpackage share: tables, lineage cuts, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import shared_folder, written

__all__ = ["connected_components", "durable", "held_out", "key_filter", "may_match", "shared_folder", "table", "written"]

#: The columns of ``documents``; every filtering stage returns these.
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def durable(df: DataFrame) -> DataFrame:
    """Materialised in the shared folder, where a lost executor takes nothing along."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def held_out(column: str, folds: int, fold: int):
    """Whether crc32 of the id as text falls into the held-out fold."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds == fold


#: Edges that a task joins up at a time.
JOINED = 1 << 20


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) of all nodes of these edges but the smallest ones: edges that connect the same."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    x, y = at[: len(u)], at[len(u) :]
    low = np.arange(len(nodes))
    while True:
        a, b = low[x], low[y]
        if (a == b).all():
            break
        np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
        while (low[low] != low).any():
            low = low[low]
    more = np.flatnonzero(low < np.arange(len(nodes)))
    return nodes[more], nodes[low[more]]


def joined_up(edges: DataFrame) -> DataFrame:
    """(u, v) with u > v: each task's edges as stars, JOINED at a time; the components stay as they are."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in it:
            held.append((batch.column("u").to_numpy(), batch.column("v").to_numpy()))
            n += batch.num_rows
            if n >= JOINED:
                yield star_batch(held)
                held, n = [], 0
        if n:
            yield star_batch(held)

    def star_batch(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        u, v = stars(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return edges.select(F.col("u").cast("long"), F.col("v").cast("long")).mapInArrow(batches, "u long, v long")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component): the smallest node reachable over undirected edges.

    Tasks join up the edges they hold first, so that few rounds are left; the driver
    keeps a plan, threads and records of tasks for every round.  Then it
    alternates large-star and small-star steps until the edges are stars around
    the smallest node of each component; each round is linear in the edges and
    the number of rounds logarithmic in the component size.  Only nodes with an
    edge appear.  Nothing is collected but a count and a checksum per round.
    """
    now = durable(
        joined_up(
            edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
            .where("u <> v")
            .distinct()
        )
    )
    before = None
    while True:
        n, check = now.agg(
            F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))
        ).first()
        if (n, check) == before:
            break
        before = (n, check)
        both = now.union(now.select("v", "u")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(
            low.select("u", F.col("m").alias("v"))
        )
        now = durable(small.distinct())
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(now.select("v", "v").distinct())


#: Bits of a key filter: 8 MB, whatever the number of keys.
FILTER_BITS = 1 << 26


def key_filter(keys: DataFrame, column: str):
    """A broadcast bitmap that has the bit of every key set.

    It spares a shuffle the rows that cannot match.  Its size is fixed; with
    very many keys it lets more rows through, and never stops one that matches.
    """
    bit = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))
    words = (
        keys.select(F.shiftright(bit, 6).alias("w"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64({column}), 64) as int))").alias("b"))
        .groupBy("w")
        .agg(F.bit_or("b").alias("b"))
        .toArrow()
    )  # at most FILTER_BITS / 64 rows
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return keys.sparkSession.sparkContext.broadcast(bits)


def may_match(column: str, bits):
    """Whether the filter lets a key through."""

    @F.pandas_udf("boolean")
    def test(bit: pd.Series) -> pd.Series:
        at = bit.to_numpy()
        return pd.Series((bits.value[at >> 6] >> (at & 63)) & 1 == 1)

    return test(F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)))
