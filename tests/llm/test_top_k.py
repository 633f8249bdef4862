"""Exact top-k search against all inner products in plain Python."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from corpusloom.llm import top_k

SCHEMA = "vec_id long, embedding array<float>, label int, row long, v string, length double, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, None, "x", 0.5, 3) for r in rows], SCHEMA)


def expected(rows, k=20):
    """(query_id, rank, vec_id, score) of every query row, and how often."""
    usable = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((i, [min(max(math.floor(float(np.float32(x)) * 64), -(2**63)), 2**63 - 1) for x in v]))
    out = []
    for a, (i, q) in enumerate(usable):
        if i % 20 == 0:
            scored = [(min(max(sum(x * y for x, y in zip(q, v)), -(2**63)), 2**63 - 1), j) for b, (j, v) in enumerate(usable) if a != b]
            scored.sort(key=lambda s: (-s[0], s[1]))
            out += [(i, r, j, s) for r, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) * rng.choice([0.1, 1, 4]) * (3 if j < 3 else 0.3) for j in range(12)]) for i in range(600)]
    rows += [(i, [0.25] * 12) for i in range(600, 660)]  # ties
    rows += [(i, [0.0] * 12) for i in range(660, 700)]
    rows += [(700, None), (720, [1.0, None]), (740, [float("nan")] * 12), (760, [float("inf")] * 12), (None, [1.0] * 12), (780, []), (800, [1.0, -2.0])]
    rows += [(20, [0.5] * 12), (21, [0.5] * 12), (40, rows[40][1]), (40, rows[40][1])]
    return rows


def test_against_all_products(spark, rows):
    assert found(top_k.exact_top_k(frame(spark, rows))) == expected(rows)


def test_small_blocks(spark, rows):
    assert found(top_k.exact_top_k(frame(spark, rows), k=7, rows=100, queries=9)) == expected(rows, 7)


def blocks_of(v, n_queries):
    n, d = v.shape
    turn = np.linalg.svd(v.astype(float), full_matrices=False)[2].T

    def side(m):
        return top_k.Side({"n": m, "d": d, "vectors": v[:m].tobytes(), "ids": np.arange(m).tobytes(), "rows": np.arange(m).tobytes()}, turn)

    return side(n_queries), side(n)


@pytest.mark.parametrize("piece, dense", [(7, 1.0), (64, 0.0), (2048, 0.05)])
def test_one_block(monkeypatch, piece, dense):
    """The same whatever the size of pieces, scored pair by pair or as a whole."""
    monkeypatch.setattr(top_k, "PIECE", piece)
    monkeypatch.setattr(top_k, "DENSE", dense)
    v = np.random.default_rng(3).integers(-9, 9, size=(500, 6))
    q, c = blocks_of(v, 40)
    at, to, score = top_k.best_of_block(q, c, np.full(40, -np.inf), 5)
    for k in range(40):
        want = sorted((-int(s), i) for i, s in enumerate(v @ v[k]) if i != k)[:5]
        assert [(-int(s), int(i)) for i, s in zip(to[at == k], score[at == k])] == want


def test_lengths_beyond_doubles_and_longs(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-2, 38) for _ in range(3)]) for i in range(60)]
    rows += [(i, [rng.choice([-1, 1]) * 2.0 ** rng.randrange(20, 26) + rng.randrange(9) for _ in range(3)]) for i in range(60, 200)]
    assert found(top_k.exact_top_k(frame(spark, rows), k=5, rows=16, queries=4)) == expected(rows, 5)


def test_bounds_keep_most_pairs_out(spark):
    """Where lengths and the leading coordinates differ, few pairs of the last blocks are scored."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 16)) * 0.7 ** np.arange(16) * rng.gamma(2, 1, size=(4000, 1))
    v = np.floor(64 * x).astype(np.int64)
    q, c = blocks_of(v, 100)
    scored = []
    whole = top_k.exact_pairs
    top_k.exact_pairs = lambda a, b, at, to: scored.append(len(at)) or whole(a, b, at, to)
    try:
        at, to, score = top_k.best_of_block(q, c, np.full(100, -np.inf), 20)
    finally:
        top_k.exact_pairs = whole
    want = v[:100] @ v.T
    want[np.arange(100), np.arange(100)] = -(10**12)
    assert (score.reshape(100, 20) == -np.sort(-want, axis=1)[:, :20]).all() and sum(scored) < 0.05 * 100 * 2000


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 2.0]), (20, [2.0, 1.0]), (3, [1.0, 1.0])]
    assert found(top_k.exact_top_k(frame(spark, rows))) == expected(rows)
    assert found(top_k.exact_top_k(frame(spark, []))) == []
    assert found(top_k.exact_top_k(frame(spark, [(0, [1.0])]))) == []
    assert found(top_k.exact_top_k(frame(spark, [(1, [1.0]), (2, [3.0])]))) == []
