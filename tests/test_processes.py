"""Processes over ordered blocks: buffers, greedy parts, streamed digests; and the sweep in two phases."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import digests, folds, mixing_buffer, shards, sweeps


def ids(spark, values):
    return spark.createDataFrame([(v, "x") for v in values], "k long, place string")


def drained(values, buffer, seed):
    held, out, drains = [], [], 0
    for x in sorted(values):
        held.append(x)
        if len(held) >= buffer:
            ranked = sorted(held, key=lambda v: (mixing_buffer.draw(seed, drains, v), v))[: max(1, len(held) // 2)]
            out += [v for v in reversed(held) if v in ranked]
            held = [v for v in held if v not in ranked]
            drains += 1
    return out + held


@pytest.mark.parametrize("block", [7, 50, 10_000])
@pytest.mark.parametrize("buffer", [1, 2, 5, 32, 1000])
def test_draining_buffer(spark, buffer, block):
    """The same whatever the blocks; nothing is lost."""
    if block == 7 and buffer in (1, 1000):
        pytest.skip("many small jobs")
    values = random.Random(1).sample(range(10**6), 60 if block == 7 else 220)
    got = mixing_buffer.drained_order(ids(spark, [*values, None]), "k", buffer, "s", block).orderBy("place").collect()
    assert [r.k for r in got] == drained(values, buffer, "s") and [r.place for r in got] == list(range(len(values)))


def test_rows_stay_for_several_drains(spark):
    """Half of the rows leave at each drain, so the wait in drains falls off by halves."""
    n, buffer = 4000, 100
    got = mixing_buffer.drained_order(ids(spark, range(n)), "k", buffer, "d").orderBy("place").collect()
    # 50 rows leave at each drain; a row enters before the drain that its coming makes due or the next one.
    drains = np.array([r.place // 50 - max(0, -(-(r.k + 1 - buffer) // 50)) for r in got if r.k < n - 20 * buffer])
    share = [(drains >= d).mean() for d in (1, 2, 3, 4)]
    assert drains.min() == 0 and drains.max() > 5 and all(abs(s - 0.5**k) < 0.05 for k, s in enumerate(share, 1))


@pytest.mark.parametrize("block", [16, 10_000])
def test_stream_buffer(spark, block):
    values = list(range(0, 150, 3))
    held, out = values[:10], []
    for x in values[10:]:
        k = mixing_buffer.draw("s", len(out)) % 10
        out.append(held[k])
        held[k] = x
    out += sorted(held, key=lambda v: (mixing_buffer.draw("s", "end", v), v))
    got = mixing_buffer.streamed_order(ids(spark, values), "k", "s", 10, block).orderBy("place").collect()
    assert [r.k for r in got] == out
    assert mixing_buffer.streamed_order(ids(spark, []), "k", "s").collect() == []


@pytest.mark.parametrize("block", [5, 1000])
def test_balanced_parts(spark, block):
    rng = random.Random(3)
    files = [(f"f{k:02d}", rng.choice([1, 5, 5, 9, 100])) for k in range(23)]
    sums, want = [0, 0, 0], {}
    for key, n in sorted(files, key=lambda f: (-f[1], f[0])):
        k = sums.index(min(sums))
        want[key] = k
        sums[k] += n
    got = shards.balanced(spark.createDataFrame(files, "key string, size long"), "size", "key", 3, block).collect()
    assert {r["key"]: r["part"] for r in got} == want


def test_fold_passes_the_state(spark):
    def step(t, total):
        x = t.column("x").to_pylist()
        return pa.table({"x": t.column("x"), "upto": np.cumsum(x) + total}), total + sum(x)

    rows = spark.createDataFrame([(k,) for k in range(40)], "x long").repartition(3)
    got = folds.fold_blocks(rows, [F.desc("x")], "x long, upto long", 0, step, lambda s: pa.table({"x": [-1], "upto": [s]}), block=9).collect()
    want, total = [], 0
    for x in range(39, -1, -1):
        total += x
        want.append((x, total))
    assert sorted((r.x, r.upto) for r in got) == sorted([*want, (-1, 780)])


def test_streamed_digests(spark, monkeypatch):
    """Lists that span pieces and tasks, hot groups, null texts and null groups."""
    rng = random.Random(4)
    rows = [("hot", k, rng.choice(["a", "bé", "", None, "x" * 99])) for k in range(900)] + [("g", k, str(k)) for k in range(3)] + [(None, 1, "no")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, k long, t string").repartition(5)
    for piece in (1, 300, 1 << 14):
        monkeypatch.setattr(digests, "PIECE", piece)
        got = {r.g: (r.n, r.sha256) for r in digests.listed_sha256(df, "g", ["k"], F.col("t"), "|", "<", ">").collect()}
        want = {}
        for g in ("hot", "g"):
            texts = [t or "" for _, _, t in sorted((r for r in rows if r[0] == g), key=lambda r: r[1])]
            want[g] = (len(texts), hashlib.sha256(f"<{'|'.join(texts)}>".encode()).hexdigest())
        assert got == want


def test_two_phases_find_the_winner_of_the_full_sweep(spark):
    rng = np.random.default_rng(5)
    n, first = 120, 40
    effect = {"good": 0.30, "close": 0.28, "poor": -0.2, "bad": -0.5, "same": -0.2}
    diffs = {c: e + rng.normal(0, 0.2, n) for c, e in effect.items()}
    diffs["same"] = diffs["poor"]
    asked = []

    def score(configs, low, high):
        names = sorted(r.config for r in configs.collect())
        asked.append((names, low, high))
        return spark.createDataFrame([(c, k, float(1 - diffs[c][k]), float(diffs[c][k])) for c in names for k in range(low, high)], "config string, pos long, loss double, diff double")

    configs = spark.createDataFrame([(c,) for c in effect], "config string")
    out = {(r.config, r.phase): r for r in sweeps.two_phase_sweep(configs, score, n, 300, "t", 0.01, first).collect()}
    assert asked == [(sorted(effect), 0, 40), (["close", "good"], 40, 120)]
    assert {k for k in out if k[1] == "micro"} == {(c, "micro") for c in effect} and {k[0] for k in out if k[1] == "full"} == {"good", "close"}
    full = {r.config: r for r in sweeps.two_phase_sweep(configs, score, n, 300, "t", 0.01, n).collect() if r.phase == "full"}
    winner = min(full.values(), key=lambda r: r.place).config
    two = {k[0]: r for k, r in out.items() if k[1] == "full"}
    assert min(two.values(), key=lambda r: r.place).config == winner
    for c in two:
        assert abs(two[c].mu - diffs[c].mean()) < 1e-12 and two[c].n == n and abs(two[c].low - full[c].low) < 1e-12


def test_holdout_of_two_parts(spark):
    from corpusloom.operators import evaluation

    part = lambda n, x: spark.createDataFrame([(k, [x]) for k in range(n)], "at long, ids array<string>")
    both, n = evaluation.two_part_holdout(part(3, "a"), part(2, "b"), "at")
    assert n == 3 and sorted((r.pos, r.component, r.ids) for r in both.collect()) == [(0, "public", ["a"]), (1, "public", ["a"]), (2, "public", ["a"]), (3, "private", ["b"]), (4, "private", ["b"])]
    assert evaluation.two_part_holdout(part(3, "a"), part(0, "b"), "at")[0].count() == 3
    diffs = spark.createDataFrame([(k, 2.0, 1.5, 0.5 if k < 3 else -1.0) for k in range(5)], "pos long, king_loss double, challenger_loss double, diff double")
    r = evaluation.audit_record(spark, diffs, 3, 50, "x", 0.01, 0.0).first()
    assert (r.n, r.n_public, r.n_private, r.mu_public, r.mu_private, r.n_bootstrap) == (5, 3, 2, 0.5, -1.0, 50) and r.lcb <= r.mu_hat
