"""Fill-in-the-middle transformation with cuts found in Fenwick trees over text blocks.

A text's UTF-8 bytes lie in blocks of fixed size.  Two Fenwick trees over the
blocks hold how many units end in each and how many code points begin in it.  A
cut after k units is found by binary-lifting descent: the steps that keep the
unit count below k lead to the block of the k-th end and add up the code points
before it; inside that one block the boundary is looked up.  So a text is read
once for its counts, whatever its length, and each cut touches one block more.

A unit is a word with the white space before it; white space at the end of the
text is a unit of its own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: What opens the prefix, the suffix and the middle in an output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes in one text block, and in one pass of counting (whole blocks).
BLOCK, PASS = 4096, 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


class TextBlocks:
    """Units and code points of one text, by block."""

    def __init__(self, data: bytes, block: int = BLOCK) -> None:
        self.data, self.block = data, block
        step = max(1, PASS // block) * block
        counts = [self._counts(at, min(len(data), at + step)) for at in range(0, len(data), step)]
        each = np.concatenate(counts) if counts else np.zeros((0, 2), np.int64)
        self.n, self.n_chars = (int(x) for x in each.sum(axis=0))
        self.tree = self._fenwick(each)

    def _ends(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Where units end and where code points begin among the bytes lo to hi."""
        a = np.frombuffer(self.data, np.uint8, hi - lo, lo)
        space = SPACE[a]
        follows = np.append(space[1:], True if hi == len(self.data) else SPACE[self.data[hi]])
        ends = ~space & follows
        if hi == len(self.data):
            ends[-1] = True
        return ends, (a & 0xC0) != 0x80

    def _counts(self, lo: int, hi: int) -> np.ndarray:
        first = np.arange(0, hi - lo, self.block)
        return np.stack([np.add.reduceat(x, first, dtype=np.int64) for x in self._ends(lo, hi)], axis=1)

    @staticmethod
    def _fenwick(each: np.ndarray) -> list[list[int]]:
        """1-based; node i holds the sums of the ``i & -i`` blocks that end with block i."""
        tree = [[0, 0], *each.tolist()]
        for i in range(1, len(tree)):
            up = i + (i & -i)
            if up < len(tree):
                tree[up][0] += tree[i][0]
                tree[up][1] += tree[i][1]
        return tree

    def cut(self, units: int) -> tuple[int, int]:
        """(byte offset, code points) of the first ``units`` units, of 0 to ``n``."""
        if units == 0:
            return 0, 0
        at, left, chars = 0, units, 0
        step = 1 << (len(self.tree) - 1).bit_length()
        while step:
            if at + step < len(self.tree) and self.tree[at + step][0] < left:
                at += step
                left -= self.tree[at][0]
                chars += self.tree[at][1]
            step >>= 1
        lo = at * self.block
        ends, begins = self._ends(lo, min(len(self.data), lo + self.block))
        local = int(np.flatnonzero(ends)[left - 1]) + 1
        return lo + local, chars + int(begins[:local].sum())


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four unsigned 32-bit numbers from the seed and the id; a null id counts as empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def transform(data: bytes, h: list[int], rate: int, spm: int, block: int = BLOCK) -> tuple[int, str, bytes, int | None, int | None]:
    """(units, form, output, code points of the prefix, of the middle) of one text."""
    text = TextBlocks(data, block)
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    if not data or p in data or s in data or m in data or h[2] % 100 >= rate:
        return text.n, "plain", data, None, None
    a, b = sorted((h[0] % (text.n + 1), h[1] % (text.n + 1)))
    (a, chars), (b, both) = text.cut(a), text.cut(b)
    head, middle, tail = data[:a], data[a:b], data[b:]
    if h[3] % 100 < spm:
        return text.n, "spm", b"".join((s, tail, p, head, m, middle)), chars, both - chars
    return text.n, "psm", b"".join((p, head, s, tail, m, middle)), chars, both - chars


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80, block: int = BLOCK) -> DataFrame:
    """(doc_id, n, form, output, prefix_chars, middle_chars) of every row of ``docs``.

    ``rate`` percent of the texts are rearranged, ``spm`` percent of these with
    the suffix first.  Null texts count as empty; empty texts and texts that
    contain a marker stay plain.  The cuts follow from the seed and the id
    alone: rows of one id share their draws, rows with a null id draw as if the
    id were empty text, and repeated rows give repeated results.  Two equal cuts
    give an empty middle.  Texts of any length are cut over their whole bytes;
    other columns are ignored, and an empty table gives an empty result.
    """

    def batches(it):
        for batch in it:
            made = [
                transform(t.as_buffer().to_pybytes() if t.is_valid else b"", draws(seed, i.as_py()), rate, spm, block)
                for i, t in zip(batch.column(0), batch.column(1))
            ]
            kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
            columns = [pa.array([r[k] for r in made], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *columns], ["doc_id", "n", "form", "output", "prefix_chars", "middle_chars"]
            )

    made = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        batches, "doc_id long, n long, form string, output binary, prefix_chars long, middle_chars long"
    )
    return made.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text from an output and its form; markers occur once each, so they part the pieces."""
    middle = F.substring_index(output, MIDDLE, -1)

    def apart(first: str, second: str) -> tuple[Column, Column]:
        rest = F.substring_index(output, MIDDLE, 1)
        return F.substr(F.substring_index(rest, second, 1), F.lit(len(first) + 1)), F.substring_index(rest, second, -1)

    psm_head, psm_tail = apart(PREFIX, SUFFIX)
    spm_tail, spm_head = apart(SUFFIX, PREFIX)
    return (
        F.when(form == "psm", F.concat(psm_head, middle, psm_tail))
        .when(form == "spm", F.concat(spm_head, middle, spm_tail))
        .otherwise(output)
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


#: Cuts by the list of units; the restored text is the text itself.
ORACLE = r"""
with u as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as us,
    sha256('42:' || doc_id) as x from documents
), h as (
  select *, len(us) as n, ('0x' || x[1:8])::ubigint as h1, ('0x' || x[9:16])::ubigint as h2, ('0x' || x[17:24])::ubigint as h3, ('0x' || x[25:32])::ubigint as h4 from u
), f as (
  select *, least(h1 % (n + 1), h2 % (n + 1))::bigint as a, greatest(h1 % (n + 1), h2 % (n + 1))::bigint as b,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 50 then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form from h
), c as (
  select *, array_to_string(us[1:a], '') as p, array_to_string(us[a + 1:b], '') as m, array_to_string(us[b + 1:], '') as s from f
)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(p)::bigint end as prefix_chars, case when form <> 'plain' then length(m)::bigint end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(t) as restored_sha256
from c
"""
