"""The keyed permutation: bijective, even, and found by one index alone."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import permutation as P


def image(x, total, seed):
    """The same rounds in plain Python."""
    a = max(1, math.isqrt(total - 1) + 1 if total else 1)
    b = max(1, -(-total // a))
    while True:
        l, r = divmod(x, b)
        for step in range(P.ROUNDS):
            h = lambda v: int(hashlib.md5(f"{seed}:{step}:{v}".encode()).hexdigest()[:15], 16)  # noqa: B023, E731
            l, r = (l, (r + h(l)) % b) if step % 2 else ((l + h(r)) % a, r)
        x = l * b + r
        if x < total:
            return x


@pytest.mark.parametrize("total", [1, 2, 3, 7, 16, 17, 100, 1009])
def test_bijection(spark, total):
    got = [r["index"] for r in P.sample_indices(spark, total + 5, total, "s").orderBy("draw").collect()]
    assert sorted(got) == list(range(total)) and got == [image(x, total, "s") for x in range(total)]


def test_far_indices(spark):
    total = 10**17 + 3
    got = [r["index"] for r in P.sample_indices(spark, 50, total, "far").orderBy("draw").collect()]
    assert len(set(got)) == 50 and got == [image(x, total, "far") for x in range(50)] and max(got) > total // 2


def test_even():
    """Over 400 seeds each of 20 indices is among the first 5 about equally often (chi-squared, 19 degrees)."""
    counts = [0] * 20
    for seed in range(400):
        for x in range(5):
            counts[image(x, 20, f"e{seed}")] += 1
    assert sum((c - 100) ** 2 / 100 for c in counts) < 43.8  # 0.1 % point


def test_locate(spark):
    counts = spark.createDataFrame([("a", 3), ("b", 0), ("c", 1), ("d", 500), ("e", 2), ("f", 1)], "key string, n long")
    out = P.locate(P.sample_indices(spark, 507, 507, "l"), counts, "key", "n").collect()
    want = [(k, i) for k, n in [("a", 3), ("c", 1), ("d", 500), ("e", 2), ("f", 1)] for i in range(n)]
    assert sorted((r["index"], r["key"], r["row_idx"]) for r in out) == [(x, *kr) for x, kr in enumerate(want)]
    assert P.locate(P.sample_indices(spark, 5, 507, "l").where(F.lit(False)), counts, "key", "n").collect() == []
