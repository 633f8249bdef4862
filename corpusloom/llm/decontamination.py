"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are partitioned by the size of their shingle set; the partition sets the
length of the item's MinHash sketch, its ``s`` smallest shingle hashes.  With
containment of at least c, at most (1 - c) * |item| of its shingles are missing
from a document, so ``s = floor((1 - c) * upper size of the partition) + 1``
sketch entries cannot all be missing: the search loses no match.  Every shingle
of every whole document is looked up among the sketch entries, however long the
document is, and each (document, item) met is verified by exact containment of
the full shingle sets.

A banded signature of the document, as containment search is often done, sees a
40-shingle item in a 20,000-shingle document at a Jaccard similarity of 0.002
and would miss it; sketching only the items has the same cost and no misses.

The items go to the tasks in blocks of ``ITEM_BYTES``, one pass over the
documents for each; a benchmark of any size thus has bounded broadcasts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, table
from .hashing import U64, mix, shingle_hashes, word_hashes

WIDTH, PERCENT = 5, 80
#: Text of items in one broadcast, about.
ITEM_BYTES = 16 << 20
#: Upper sizes of the partitions grow by this factor.
GROWTH = 1.25


class SketchIndex:
    """Sketches of items and their full shingle sets."""

    def __init__(self, ids: list[int], texts: list[str | None], width: int, percent: int):
        self.percent = percent
        self.ids, self.sets = [], []
        entries, owners = [], []
        for item, text in zip(ids, texts):
            s = shingle_hashes(word_hashes(text), width)
            if not len(s):
                continue
            upper = int(GROWTH ** np.ceil(np.log(len(s)) / np.log(GROWTH) - 1e-9) + 1e-9)
            n = min(len(s), (100 - percent) * max(upper, len(s)) // 100 + 1)
            entries.append(s[np.argsort(mix(s ^ U64(0x5851F42D4C957F2D)))[:n]])
            owners.append(np.full(n, len(self.ids)))
            self.ids.append(item)
            self.sets.append(s)
        keys = np.concatenate(entries) if entries else np.empty(0, U64)
        owner = np.concatenate(owners) if owners else np.empty(0, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner = keys[order], owner[order]
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.keys >> U64(44)).astype(np.int64)] = True

    def search(self, shingles: np.ndarray) -> list[tuple[int, int, int]]:
        """(item id, its shingles, how many the document shares) of each contained item."""
        near = shingles[self.bits[(shingles >> U64(44)).astype(np.int64)]]
        if not len(near):
            return []
        lo, hi = np.searchsorted(self.keys, near), np.searchsorted(self.keys, near, side="right")
        met = {int(o) for a, b in zip(lo, hi) for o in self.owner[a:b]}
        found = []
        for k in sorted(met):
            s = self.sets[k]
            at = np.minimum(np.searchsorted(shingles, s), len(shingles) - 1)
            shared = int((shingles[at] == s).sum())
            if 100 * shared >= self.percent * len(s):
                found.append((self.ids[k], len(s), shared))
        return found


def contaminated(docs: DataFrame, items: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared): items with at least ``percent`` % of their
    distinct word shingles in a document.

    Texts with fewer than ``width`` words have their whole sequence as one
    shingle; null and empty texts have none and match nothing.  Texts of any
    length are searched whole.  Every item that is contained gives a row, so there
    are no ties to break: an item id that occurs with several texts gives a row
    for each, a repeated document its rows again.  Empty tables give an empty
    result; other columns of both tables are ignored.
    """
    spark = docs.sparkSession
    items = items.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    blocks = max(1, -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // ITEM_BYTES))
    found = None
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()  # about ITEM_BYTES
        index = spark.sparkContext.broadcast(SketchIndex([r[0] for r in rows], [r[1] for r in rows], width, percent))

        def batches(it, index=index):
            for batch in it:
                ids, hits = [], []
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                    for hit in index.value.search(shingle_hashes(word_hashes(text.as_py()), width)):
                        ids.append(doc)
                        hits.append(hit)
                item, n, shared = zip(*hits) if hits else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(item, pa.int64()), pa.array(n, pa.int64()), pa.array(shared, pa.int64())],
                    ["doc_id", "item_id", "n_item_shingles", "n_shared"],
                )

        part = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
            batches, "doc_id long, item_id long, n_item_shingles long, n_shared long"
        )
        found = part if found is None else found.union(part)
    return found


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item.

    All rows of a doc_id go when one of its texts contains one; rows with a null
    doc_id likewise.  Null and empty texts stay, very long ones are searched
    whole, and without items or documents nothing goes.
    """
    bad = durable(contaminated(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("bad_id")).distinct())
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]), "left_anti")


ORACLE = r"""
with w as (
  select 0 as kind, doc_id as id, text from documents union all select 1, item_id, text from benchmark where text is not null
), x as (
  select kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from w
), s as (
  select kind, id, unnest(list_distinct(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end)) as sh from x
), i as (select id as item_id, sh, count(*) over (partition by id) as n from s where kind = 1)
select d.id as doc_id, i.item_id, any_value(i.n)::bigint as n_item_shingles, count(*)::bigint as n_shared
from s d join i on d.sh = i.sh where d.kind = 0 group by d.id, i.item_id having 100 * count(*) >= 80 * any_value(i.n)
"""
