"""Unigram losses by words that are packed by buckets, and counts that a task adds up before it lists them."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.operators import scoring, token_tables
from corpusloom.operators.scoring import UnigramScorer
from corpusloom.tables import spread


def plain(fitted: list[list], rows: list[tuple]) -> dict:
    """Losses by key; rows of one key count together, a null token as one that was not seen."""
    counts = Counter(t for x in fitted for t in x)
    size = math.log(sum(counts.values()) + len(counts))
    counts.pop(None, None)
    texts: dict = {}
    for k, x in rows:
        texts.setdefault(k, []).extend(x or [])
    return {k: (size - sum(math.log(counts[t] + 1) for t in x) / len(x), len(x)) for k, x in texts.items() if x}


def drawn(seed: int, n: int) -> list[tuple]:
    r = random.Random(seed)
    rows = [(k, [r.choice(["a", "b c", "c", None, "\n3", "é" * 3, f"w{r.randrange(60)}", f"{seed}x{k}"]) for _ in range(r.randrange(25))]) for k in range(n)]
    return rows + [(3, ["a", "w1", "w1"]), (None, ["c", "w2", None]), (n, None), (n + 1, [None])]


@pytest.mark.parametrize(("frequent", "types", "words"), [(200_000, 1 << 16, 1 << 19), (5, 1 << 16, 1 << 19), (5, 7, 1 << 19), (0, 1 << 16, 60)])
def test_losses_of_packed_words_equal_plain_ones(spark, monkeypatch, frequent, types, words):
    for name, value in (("FREQUENT", frequent), ("BUCKET_TYPES", types), ("BUCKET_WORDS", words)):
        monkeypatch.setattr(scoring, name, value)
    fitted, other = drawn(1, 90), drawn(2, 40)
    frames = [spark.createDataFrame(x, "id long, ids array<string>").repartition(4) for x in (fitted, other)]
    model = UnigramScorer(frames[0], "ids")
    assert (model.buckets == 0) == (frequent > 1000)
    for frame, rows in zip(frames, (fitted, other)):
        want = plain([x for _, x in fitted if x], rows)
        got = {r["id"]: (r["loss"], r["n_pos"]) for r in model.score(frame, "id", "ids").collect()}
        assert {k: n for k, (_, n) in got.items()} == {k: n for k, (_, n) in want.items()}
        assert all(abs(got[k][0] - want[k][0]) < 1e-12 for k in want)
        measured = model.score_measured(frame, "id", "ids").collect()
        assert sorted((r["id"] is None, r["id"] or 0) for r in measured) == sorted((k is None, k or 0) for k, x in rows if x)  # each row for itself
        assert all(r["loss"] == got[r["id"]][0] for r in measured)


def test_words_meet_their_counts_without_a_join(spark, monkeypatch):
    monkeypatch.setattr(scoring, "FREQUENT", 2)
    monkeypatch.setattr(scoring, "BUCKET_TYPES", 5)
    rows = spark.createDataFrame([(k, " ".join(f"w{(k * j) % 17}" for j in range(50))) for k in range(40)], "id long, text string")
    scores = UnigramScorer(rows, "text").score(rows, "id", "text")
    plan = scores._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert "SortMergeJoin" not in plan and "hashpartitioning(tok" not in plan and "hashpartitioning(bucket" in plan


def test_a_model_without_rare_words_and_empty_rows(spark, monkeypatch):
    monkeypatch.setattr(scoring, "FREQUENT", 1)
    none = spark.createDataFrame([], "id long, text string")
    some = spark.createDataFrame([(1, "a a b"), (2, "  "), (3, None)], "id long, text string")
    assert UnigramScorer(none, "text").score(some, "id", "text").count() == 1
    assert UnigramScorer(some, "text").score_measured(none, "id", "text").collect() == []
    assert [r["id"] for r in UnigramScorer(some, "text").score(some, "id", "text").collect()] == [1]


def test_a_task_lists_a_word_once(monkeypatch):
    stretches = [(pa.array([f"w{k}" for k in range(s, s + 300)] + [None]), np.full(301, 2)) for s in range(0, 600, 20)]
    want = Counter()
    for words, n in stretches:
        want.update(dict(zip(words.to_pylist(), n.tolist())))
    for held in (1 << 26, 20_000, 1):  # room for all words, for some stretches, for none
        monkeypatch.setattr(token_tables, "HELD", held)
        rows = [r for b in token_tables.held_counts(iter(stretches)) for r in zip(b.column("tok").to_pylist(), b.column("n").to_pylist())]
        got = Counter()
        for tok, n in rows:
            got[tok] += n
        assert got == want and (len(rows) == len(want) or held < 1 << 26)


def test_many_files_are_not_dealt_again(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(4000).selectExpr("id", "repeat(sha2(cast(id as string), 256), 20) as text")
    rows.repartition(2 * cores).write.parquet(f"{tmp_path}/many")
    rows.coalesce(1).write.parquet(f"{tmp_path}/one")
    many, one = (spark.read.parquet(f"{tmp_path}/{x}") for x in ("many", "one"))
    assert spread(one).rdd.getNumPartitions() == cores
    if many.rdd.getNumPartitions() == cores:
        assert "Exchange" not in spread(many)._jdf.queryExecution().executedPlan().toString()
