"""Bigram losses by packed pairs, and scorers that split texts themselves."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.functions.tokens import tokens
from corpusloom.jobs.score_cache import ScoreCache
from corpusloom.operators import scoring, token_tables
from corpusloom.operators.scoring import BigramScorer, UnigramScorer


def plain(fitted: dict[int, list], rows: dict[int, list]) -> dict[int, float]:
    both, first = Counter(), Counter()
    types = len({t for x in fitted.values() for t in x if t is not None})
    for x in fitted.values():
        both.update(zip(x, x[1:]))
        first.update(x[:-1])
    both = Counter({p: n for p, n in both.items() if None not in p})
    first[None] = 0
    return {k: sum(math.log(first[a] + types) - math.log(both[a, b] + 1) for a, b in zip(x, x[1:])) / (len(x) - 1) for k, x in rows.items() if len(x) > 1}


def drawn(seed: int, n: int) -> dict[int, list]:
    """Rows of no, one and more tokens; some are null, hold a space or a line feed."""
    r = random.Random(seed)
    return {k: [r.choice(["a", "b c", "c", None, "\n3", f"w{r.randrange(40)}"]) for _ in range(r.randrange(20))] for k in range(n)}


@pytest.mark.parametrize(("frequent", "common", "bucket"), [(200_000, 20_000, 1 << 21), (50, 30, 150), (1, 1, 60)])
def test_bigram_losses_equal_plain_ones(spark, monkeypatch, frequent, common, bucket):
    monkeypatch.setattr(scoring, "FREQUENT", frequent)
    monkeypatch.setattr(scoring, "COMMON_PAIRS", common)
    monkeypatch.setattr(scoring, "BUCKET", bucket)
    fitted, other = drawn(1, 120), drawn(2, 40)
    frames = [spark.createDataFrame(list(x.items()), "id long, ids array<string>").repartition(3) for x in (fitted, other)]
    model = BigramScorer(frames[0], "ids")
    for frame, rows in zip(frames, (fitted, other)):
        got = {r["id"]: (r["loss"], r["n_pos"]) for r in model.score(frame, "id", "ids").collect()}
        want = plain(fitted, rows)
        assert {k: n for k, (_, n) in got.items()} == {k: len(rows[k]) - 1 for k in want}
        assert all(abs(got[k][0] - want[k]) < 1e-12 for k in want)


def test_pairs_are_shuffled_once_and_packed(spark):
    rows = spark.createDataFrame([(k, [f"w{(k * j) % 7}" for j in range(50)]) for k in range(40)], "id long, ids array<string>")
    scores = BigramScorer(rows, "ids").score(rows, "id", "ids")
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 2  # of packed pairs, and of the documents' sums


def test_empty_rows_have_no_bigram_loss(spark):
    rows = spark.createDataFrame([], "id long, ids array<string>")
    assert BigramScorer(rows, "ids").score(rows, "id", "ids").collect() == []


def test_texts_are_split_as_the_column_function_splits_them(spark):
    texts = ["a b\tb\x0bc\x0c", "", None, "  ", "x y z", " a a ", "b\x1cc a\r\n", "c"] * 3
    lists = spark.createDataFrame(list(enumerate(texts)), "id long, ids string")
    want = lists.select("id", tokens(lists["ids"]).alias("ids"))
    for scorer in (UnigramScorer, BigramScorer):
        a, b = (sorted(map(tuple, scorer(x, "ids").score(x, "id", "ids").collect())) for x in (lists, want))
        assert a == b and a
    sizes, words = token_tables.split(pa.array(texts))
    assert sizes.tolist() == [len(r["ids"]) for r in want.orderBy("id").collect()] and len(words) == sizes.sum()


def test_an_empty_ledger_needs_no_python_tasks(spark, tmp_path):
    ledger = ScoreCache(spark, str(tmp_path), "v", lambda r: r).ledger()
    assert ledger.schema.names == ["shard_hash", "shard_key", "digest", "n_rows", "fields"] and ledger.count() == 0
    assert "ExistingRDD" not in ledger._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("most", "found"), [(3, {"a", "b", "c"}), (2, {"a", "b"}), (0, set()), (22, {"a", "b", "c"}), (23, {"a", "b", "c"} | {f"w{k}" for k in range(20)})])
def test_as_many_of_the_most_frequent_words_as_allowed_are_looked_up(spark, monkeypatch, most, found):
    monkeypatch.setattr(scoring, "FREQUENT", most)
    text = " ".join(["a"] * 5 + ["b"] * 4 + ["c"] * 3 + [f"w{k}" for k in range(20)])
    rows = spark.createDataFrame([(1, text), (2, "a b w3 new")], "id long, text string")
    scorer = UnigramScorer(rows.where("id = 1"), "text")
    assert set(scorer.frequent.column("tok").to_pylist()) == found
    got = {r["id"]: r["loss"] for r in scorer.score(rows, "id", "text").collect()}
    assert abs(got[2] - (math.log(32 + 23) - (math.log(6) + math.log(5) + math.log(2)) / 4)) < 1e-12


def test_steps_of_counts_never_reach_more_rows_than_allowed(spark):
    counts = sorted(int(1.17**k) + k % 3 for k in range(150))
    frame = spark.createDataFrame([(c,) for c in counts], "c long")
    for most in (0, 1, 7, 40, 149, 150, 1000):
        least = scoring.least_count(frame, most)
        listed = sum(c >= least for c in counts)
        assert most - 12 <= listed <= most or listed == 150  # no step has more than twelve of these


@pytest.mark.parametrize("kinds", [1, 3, 40, 100_000])
def test_different_runs_are_counted_by_document(kinds):
    r = random.Random(kinds)
    texts = [[r.randrange(kinds) for _ in range(r.choice([0, 1, 3, 4, 5, 60, 400]))] for _ in range(60)]
    doc = np.repeat(np.arange(60), [len(x) for x in texts])
    codes = np.array([c for x in texts for c in x], np.int64)
    for width in (1, 4):
        assert token_tables.different(doc, codes, 60, width).tolist() == [len({tuple(x[k : k + width]) for k in range(len(x) - width + 1)}) for x in texts]
