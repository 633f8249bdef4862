"""Byte-pair tokens against a merger that looks for the best pair again and again."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import byte_pairs as B


def brute(piece, merges):
    rank = {}
    for k, pair in enumerate(merges):
        rank.setdefault(pair, k)
    t = list(piece)
    while True:
        best = min((rank[p] for p in zip(t, t[1:]) if p in rank), default=None)
        if best is None:
            return t
        out, k = [], 0
        while k < len(t):
            if k + 1 < len(t) and (t[k], t[k + 1]) == merges[best]:
                out.append(256 + best)
                k += 2
            else:
                out.append(t[k])
                k += 1
        t = out


def vocabulary(rng, letters, n):
    merges, seen = [], [*letters]
    for k in range(n):
        merges.append((rng.choice(seen), rng.choice(seen)))
        seen.append(256 + k)
    return merges


@pytest.mark.parametrize("seed", range(12))
def test_random_vocabularies(seed):
    rng = random.Random(seed)
    merges = vocabulary(rng, b"ab c"[: 2 + seed % 3], rng.choice([0, 3, 20, 60]))
    pairs = B.BytePairs(merges)
    pieces = [bytes(rng.choices(b"abc ", k=rng.choice([1, 2, 7, 30, 200]))) for _ in range(60)] + [b"a" * n for n in (1, 2, 3, 4, 5, 64, 255)]
    want = [brute(p, merges) for p in pieces]
    assert [x.tolist() for x in pairs.merge_together(pieces)] == want
    assert [pairs.merge_long(p).tolist() for p in pieces] == want


def test_long_pieces():
    rng = random.Random(2)
    merges = vocabulary(rng, b"ab", 40)
    pairs = B.BytePairs(merges)
    text = bytes(rng.choices(b"ab", k=3000))
    assert pairs.encode([text, b"", text + b" " + text]) [0].tolist() == brute(text, merges)
    assert len(pairs.encode([b"a" * 300_000])[0]) <= 300_000


def test_texts(spark):
    rng = random.Random(3)
    ranked = [("t", "h"), ("th", "e"), (" ", "the"), ("a", "a"), ("aa", "a"), ("a", "aa")]
    tokenizer = B.from_pieces(ranked)
    texts = [None, "", " ", "the the  the\n\nthe", "Ünï 日本 😀", "aaaa aaaaa\taaa"] + ["".join(rng.choice(["the", "a", " ", "é", "\n"]) for _ in range(rng.randrange(99))) for _ in range(30)]
    rows = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "k int, text string, ids string").withColumnRenamed("ids", "old")
    got = {r.k: list(r.ids) for r in B.encoded(rows, "text", tokenizer, end=999, together=4).collect()}
    merges = [tuple(p) for p in _ids(ranked)]
    for k, t in enumerate(texts):
        pieces = re.findall(rb"\x20?[^\x20\x09-\x0D]+|[\x20\x09-\x0D]", (t or "").encode())
        assert got[k] == [x for p in pieces for x in brute(p, merges)] + [999]
    assert B.encoded(rows.limit(0), "text", tokenizer).collect() == []


def _ids(ranked):
    ids = {bytes([k]): k for k in range(256)}
    for n, (a, b) in enumerate(ranked):
        yield ids[a.encode()], ids[b.encode()]
        ids.setdefault((a + b).encode(), 256 + n)


def test_reasons(spark):
    rows = spark.createDataFrame([(0, []), (1, [5, 9]), (2, [5, 10]), (3, [-1])], "k int, ids array<int>")
    got = {r.k: r.r for r in rows.select("k", B.vocabulary_reason(F.col("ids"), 10).alias("r")).collect()}
    assert got == {0: "empty_tokenization", 1: None, 2: "out_of_vocab", 3: "out_of_vocab"}


def test_merges_of_unknown_tokens():
    with pytest.raises(ValueError):
        B.BytePairs([(97, 256)])
    assert np.array_equal(B.BytePairs([]).encode([b"ab"])[0], [97, 98])
