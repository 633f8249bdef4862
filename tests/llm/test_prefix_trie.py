"""The prefix trie against whole sequences of rebuilt turns in plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from corpusloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, f1 string, n long, block int, run string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 3, "x", None, 1, "y") for r in rows], SCHEMA)


def expected(rows):
    turns = defaultdict(list)
    for c, k, role, text in rows:
        if c is not None:
            turns[c].append((k is not None, k or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        rebuilt[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(list)
    for seq in members:
        if seq:
            children[seq[:-1]].append(seq)
    out, leaves, saved = {}, {}, {}
    for seq in sorted(members, key=len, reverse=True):
        below = children[seq]
        leaves[seq] = sum(leaves[x] for x in below) or 1
        own_bytes = len(seq[-1][1].encode()) if seq else 0
        saved[seq] = (len(members[seq]) - 1) * own_bytes + sum(saved[x] for x in below)
        ends = ",".join(map(str, sorted(c for c in members[seq] if len(rebuilt[c]) == len(seq))))
        out[seq] = (
            min(members[seq]), len(seq), min(members[seq[:-1]]) if seq else None, len(members[seq]), len(below), leaves[seq], saved[seq],
            hashlib.sha256(ends.encode()).hexdigest(),
        )
    return sorted(map(repr, out.values()))


def found(df):
    return sorted(repr(tuple(r)[:8]) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    rows = []
    for c in [*range(60), 100, 107, 108, 109, -3, -10, -11, 10**15]:
        for k in range(rng.choice([1, 2, 3, 9, 12])):
            rows.append((c, rng.choice([k, k, k, None, 2]), rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "b", "é😀", None, "", "long " * 50])))
    same = [(0, "system", "be brief"), (1, "user", "hello"), (2, "assistant", "hi there")]
    for c in range(200, 260):
        rows += [(c, *t) for t in same] + [(c, 3, "user", f"text {c}")] * (c % 4)
    rows += rows[:6] + [(None, 1, "user", "nobody"), (None, None, None, None)]
    rows += [(300, k, "user", f"t{k % 7}") for k in range(500)]
    return rows


def test_against_sequences(spark, rows):
    assert found(prefix_trie.prefix_trie(frame(spark, rows))) == expected(rows)


def test_small_blocks_and_pieces(spark, rows, monkeypatch):
    """The same whatever the widths of blocks and pieces."""
    monkeypatch.setattr(prefix_trie, "DEPTHS", 3)
    monkeypatch.setattr(prefix_trie, "PIECE", 2)
    monkeypatch.setattr(prefix_trie, "SALTS", 2)
    assert found(prefix_trie.prefix_trie(frame(spark, rows))) == expected(rows)


def test_stored_turns(spark, rows):
    """A node's reference leads to a turn with the text that ends it."""
    out = [r for r in prefix_trie.prefix_trie(frame(spark, rows[-502:])).collect() if r.depth]
    assert out and all((r.ref_conv_id, r.ref_pos) == (300, r.depth) for r in out)


def test_colliding_keys_are_found(spark, monkeypatch):
    """Keys and bases of a poor first seed give way to another seed."""
    whole, seeds = prefix_trie.turn_key, []

    def poor(role, text, seed):
        return (1, 1) if seed == 0 else whole(role, text, seed)

    bases = prefix_trie.bases
    monkeypatch.setattr(prefix_trie, "turn_key", poor)
    monkeypatch.setattr(prefix_trie, "bases", lambda seed: seeds.append(seed) or bases(seed))
    rows = [(c, k, "user", f"{c % 3} {k}") for c in range(12) for k in range(4)]
    assert found(prefix_trie.prefix_trie(frame(spark, rows))) == expected(rows) and set(seeds) == {0, 1}


def test_no_rows(spark):
    assert prefix_trie.prefix_trie(frame(spark, [])).collect() == []
    assert prefix_trie.prefix_trie(frame(spark, [(None, 1, "user", "x")])).collect() == []


def test_arithmetic():
    rng = random.Random(1)
    a = [rng.randrange(prefix_trie.PRIME) for _ in range(500)] + [0, 1, prefix_trie.PRIME - 1]
    b = [rng.randrange(prefix_trie.PRIME) for _ in range(500)] + [prefix_trie.PRIME - 1] * 3
    assert prefix_trie.times(np.array(a), np.array(b)).tolist() == [x * y % prefix_trie.PRIME for x, y in zip(a, b)]
    assert prefix_trie.power(12345, np.array([0, 1, 2, 77, 10**9])).tolist() == [pow(12345, k, prefix_trie.PRIME) for k in (0, 1, 2, 77, 10**9)]
