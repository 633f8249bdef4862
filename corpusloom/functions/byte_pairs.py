"""Byte-pair tokens: texts are cut into pieces, and pieces merged pair by pair in the order of ranks.

All different pieces of a batch are merged together as arrays: each round finds
the best-ranked pair of every piece that still has one and merges all its places.
A piece beyond ``LONG`` bytes takes a linked list and a heap instead, so a text
without white space costs n log n.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A piece is a word with one space before it, or one character of other white space.
PIECES = re.compile(rb"\x20?[^\x20\x09-\x0D]+|[\x20\x09-\x0D]")
BASE, LONG = 256, 256


class Tokenizer(Protocol):
    """Anything that turns texts into token ids below ``size``."""

    size: int

    def encode(self, texts: list[bytes]) -> list[np.ndarray]: ...


class BytePairs:
    """Tokens of bytes 0 to 255 and, from 256, of merges in the order of their ranks.

    A merge joins two tokens made before it.
    """

    def __init__(self, merges: list[tuple[int, int]]):
        pairs = np.array(merges, np.int64).reshape(-1, 2)
        made = BASE + np.arange(len(pairs))
        if len(pairs) and ((pairs < 0).any() or (pairs >= made[:, None]).any()):
            raise ValueError("a merge joins tokens made before it")
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        # The first of equal merges counts.
        self.keys, first = np.unique(keys, return_index=True)
        self.made, self.size = made[first], BASE + len(pairs)
        self.rank = dict(zip(self.keys.tolist(), self.made.tolist()))

    def _made(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that a pair makes, which is its rank as well; ``size`` where it makes none."""
        if not len(self.keys):
            return np.full(len(left), self.size)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], self.size)

    def merge_together(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The tokens of each piece (none empty), all merged in rounds."""
        token = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        of = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        done_token, done_of = [], []
        while len(token):
            pair = np.append(np.where(of[1:] == of[:-1], self._made(token[:-1], token[1:]), self.size), self.size)
            starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            best = np.minimum.reduceat(pair, starts)
            ends = np.append(starts[1:], len(token))
            best = np.repeat(best, ends - starts)
            over = best == self.size
            done_token.append(token[over])
            done_of.append(of[over])
            hit = (pair == best) & ~over
            # Of overlapping places, as in a run of one token, every other one from the left.
            run = np.arange(len(hit)) - np.maximum.accumulate(np.where(hit & ~np.append(False, hit[:-1]), np.arange(len(hit)), 0))
            hit &= run % 2 == 0
            token = np.where(hit, best, token)
            keep = ~over & ~np.append(False, hit[:-1])
            token, of = token[keep], of[keep]
        token, of = np.concatenate(done_token or [np.empty(0, np.int64)]), np.concatenate(done_of or [np.empty(0, np.int64)])
        order = np.argsort(of, kind="stable")
        return np.split(token[order], np.cumsum(np.bincount(of, minlength=len(pieces)))[:-1]) if pieces else []

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The tokens of one piece, by a heap of pairs over a linked list."""
        token, n = list(piece), len(piece)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(self.rank[k], i) for i in range(n - 1) if (k := token[i] << 32 | token[i + 1]) in self.rank]
        heapq.heapify(heap)
        while heap:
            made, i = heapq.heappop(heap)
            j = after[i] if token[i] >= 0 else -1
            if j < 0 or self.rank.get(token[i] << 32 | token[j]) != made:
                continue  # one of the two is gone or has changed
            token[i], token[j] = made, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (k := token[a] << 32 | token[b]) in self.rank:
                    heapq.heappush(heap, (self.rank[k], a))
        return np.array([t for t in token if t >= 0], np.int64)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Token ids of each text, without special tokens."""
        cut = [PIECES.findall(t) for t in texts]
        words = list(dict.fromkeys(p for pieces in cut for p in pieces))
        short = [w for w in words if len(w) <= LONG]
        of = dict(zip(short, self.merge_together(short)))
        of.update((w, self.merge_long(w)) for w in words if len(w) > LONG)
        none = np.empty(0, np.int64)
        return [np.concatenate([of[p] for p in pieces]) if pieces else none for pieces in cut]


def from_pieces(ranked: list[tuple[str, str]]) -> BytePairs:
    """A tokenizer of merges that are given as pairs of texts, each a single byte or an earlier merge."""
    ids: dict[bytes, int] = {bytes([k]): k for k in range(BASE)}
    merges = []
    for a, b in ranked:
        a_, b_ = a.encode(), b.encode()
        merges.append((ids[a_], ids[b_]))
        ids.setdefault(a_ + b_, BASE + len(merges) - 1)
    return BytePairs(merges)


def encoded(rows: DataFrame, text: str, tokenizer: Tokenizer, out: str = "ids", end: int | None = None, together: int = 256) -> DataFrame:
    """Adds the token ids of a column, ``end`` after each text; null counts as empty text.

    ``together`` texts are encoded at once; each is taken whole.
    """
    shared = rows.sparkSession.sparkContext.broadcast(tokenizer)
    names = rows.columns
    tail = np.array([end] if end is not None else [], np.int64)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for low in range(0, batch.num_rows, together):
                part = batch.slice(low, together)
                raw = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in part.column("_text")]
                ids = [np.append(x, tail) for x in shared.value.encode(raw)]
                offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                values = np.concatenate(ids).astype(np.int32) if ids else np.empty(0, np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), lists], [*names, out])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.withColumn("_text", F.col(text).cast("binary")).mapInArrow(batches, f"{kinds}, `{out}` array<int>")


def vocabulary_reason(ids: Column, size: int) -> Column:
    """``empty_tokenization`` or ``out_of_vocab``, or null: whether a document's tokens fit a model of ``size`` tokens."""
    return F.when(F.size(ids) == 0, "empty_tokenization").when((F.array_min(ids) < 0) | (F.array_max(ids) >= size), "out_of_vocab")
