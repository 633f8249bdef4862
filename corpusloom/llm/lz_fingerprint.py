"""Lempel-Ziv phrase fingerprints: compression-like similarity of documents.

A text is parsed as LZ78 does: each phrase is the shortest piece not yet in the
dictionary, and joins it.  The set of phrases is hashed, and the smallest value
under each of ``COORDINATES`` hash functions, cut to 16 bits, is the fingerprint;
the share of equal coordinates estimates the Jaccard similarity of the phrase
sets, which is high where one text helps to compress the other.

The parse goes from left to right, so a text and its edited form, which share
their beginning, share that part of the parse; it is done once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .hashing import U64, minhash, mix, prefix_sums, span_hashes

COORDINATES = 64
#: Rows in one range of ids, about, and the most ranges, whose bounds the driver holds.  A range is
#: streamed, not held, so beyond that many ranges only grow longer.
RANGE_ROWS, MOST_RANGES = 4000, 200_000


def parse(text: str, at: int, limit: int, known: set[str], ends: list[int]) -> int:
    """Parses ``text`` on from ``at`` and returns where it stopped.

    Phrases that end within ``limit`` join ``known``, their ends ``ends``; the
    parse stops before the first that does not.  At the end of the text, a last
    piece that is a known phrase ends there too.  Every beginning of a known
    phrase is known, so a phrase's length is searched from the one before.
    """
    n, length = len(text), 1
    add, end = known.add, ends.append
    while at < n:
        stop = min(at + length, n)
        if text[at:stop] in known:
            stop += 1
            while stop <= n and text[at:stop] in known:
                stop += 1
        else:
            while stop > at + 1 and text[at : stop - 1] not in known:
                stop -= 1
        if stop > limit:
            if limit == n:  # the rest is a known phrase
                end(n)
                at = n
            break
        add(text[at:stop])
        end(stop)
        length = stop - at
        at = stop
    return at


def signature(text: str, ends: list[int]) -> np.ndarray:
    """Minimum hashes of the phrases that end at ``ends``; no coordinates for an empty text."""
    if not ends:
        return np.empty(0, np.uint16)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    stop = np.array(ends, np.int64)
    start = np.concatenate([[0], stop[:-1]])
    hashes = []
    for lo in range(0, len(stop), 1 << 17):
        s, e = start[lo : lo + (1 << 17)], stop[lo : lo + (1 << 17)]
        sums = prefix_sums(codes[s[0] : e[-1]])
        hashes.append(span_hashes(sums, s - s[0], e - s[0]))
    low = minhash(np.concatenate(hashes), COORDINATES)
    return (mix(low.astype(U64)) >> U64(48)).astype(np.uint16)


def fingerprint(text: str) -> np.ndarray:
    ends: list[int] = []
    parse(text, 0, len(text), set(), ends)
    return signature(text, ends)


def fingerprint_pair(text: str, edited: str, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints of two texts that agree in their first ``shared`` characters."""
    known: set[str] = set()
    ends: list[int] = []
    if text == edited:
        own = fingerprint(text)
        return own, own
    at = parse(text, 0, min(shared, len(text) - 1, len(edited) - 1), known, ends) if text and edited else 0
    known2, ends2 = set(known), list(ends)
    parse(text, at, len(text), known, ends)
    parse(edited, at, len(edited), known2, ends2)
    return signature(text, ends), signature(edited, ends2)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal coordinates; 1 for two empty texts, 0 for an empty and another one."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return float((a == b).mean())


def edit(text: str, following: str) -> tuple[str, int]:
    """The text with its last floor(n / 2) characters replaced by the first as many of the
    following one, and how many characters are left of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half], len(text) - half


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The next document is the one with the next smaller doc_id, and the largest
    one after the last.  Rows of the same doc_id follow one another by text;
    rows with a null doc_id come last.  Null texts are empty; the fingerprint of
    an empty text is the empty string.  Ids are cut into ranges at quantiles;
    the first document of each range also goes, as a tail, to the range before.
    Texts of any length are parsed whole, one text and its successor at a time.
    Repeated rows follow one another, an empty table gives an empty result, and
    other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = rows.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"))
    n = ids.count()
    ranges = max(1, min(MOST_RANGES, -(-n // RANGE_ROWS)))
    cuts = sorted(set(ids.approxQuantile("id", [k / ranges for k in range(1, ranges)], 0.2 / ranges))) if ranges > 1 else []
    cuts = np.array(cuts, np.float64)

    def place(id_: np.ndarray) -> np.ndarray:
        return np.searchsorted(cuts, id_.astype(np.float64), side="right")

    def placed(it):
        for batch in it:
            id_ = batch.column("id").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(place(id_).astype(np.int32)), batch.column("id")], ["part", "id"])

    heads = ids.mapInArrow(placed, "part int, id long").groupBy("part").agg(F.max("id").alias("id")).orderBy("part").collect()  # at most MOST_RANGES rows
    first = np.array([r["id"] for r in heads], np.int64)  # ascending like the parts
    target = np.array([heads[(k + 1) % len(heads)]["part"] for k in range(len(heads))], np.int32)

    def with_tails(it):
        for batch in it:
            if not len(batch):
                continue
            id_ = batch.column("doc_id").fill_null(-(1 << 63)).to_numpy()
            at = np.minimum(np.searchsorted(first, id_), len(first) - 1)
            again = np.flatnonzero(first[at] == id_)
            both = pa.Table.from_batches([batch, batch.take(pa.array(again))]).combine_chunks()
            part = np.concatenate([place(id_).astype(np.int32), target[at[again]]])
            tail = np.concatenate([np.zeros(len(id_), bool), np.ones(len(again), bool)])
            both = both.append_column("part", pa.array(part)).append_column("tail", pa.array(tail))
            yield from both.to_batches()

    dealt = (
        rows.mapInArrow(with_tails, "doc_id long, text string, part int, tail boolean")
        .repartitionById(ranges, "part")
        .sortWithinPartitions("part", "tail", F.col("doc_id").desc_nulls_last(), "text")
    )

    def compare(it):
        held = None  # the row before: (part, doc_id, text)
        waiting = None  # a finished row but for near_next, with its fingerprint
        ended = None  # the part whose tail has come
        out: list[tuple] = []

        def batch_of(rows_):
            cols = list(zip(*rows_)) if rows_ else [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

        for batch in it:
            for part, doc, text, tail in zip(batch.column("part").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("tail").to_pylist()):
                if part == ended:
                    continue
                if held is not None:
                    edited, shared = edit(held[2], text)
                    own, other = fingerprint_pair(held[2], edited, shared)
                    if waiting is not None:
                        out.append((*waiting[0], likeness(waiting[1], own)))
                    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    row = (held[1], len(held[2]), sha, own.astype(">u2").tobytes().hex(), other.astype(">u2").tobytes().hex(), likeness(own, other))
                    waiting = (row, own)
                held = (part, doc, text)
                if tail:
                    out.append((*waiting[0], likeness(waiting[1], fingerprint(text))))
                    held, waiting, ended = None, None, part
                if len(out) >= 1000:
                    yield batch_of(out)
                    out = []
        yield batch_of(out)

    return dealt.select("part", "doc_id", "text", "tail").mapInArrow(
        compare,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )


def op7_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
