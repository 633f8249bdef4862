"""The pipeline, its stages and the registered queries, on tables of their own against brute force."""

import hashlib
import html
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import lattice_lm, lz_fingerprint, mixing, oracle_sql, queries, suffix_dedup, token_counts

from .brute import components, repeats, shingles, tokens

LANGS, SOURCES = ("en", "de", "fr", "es"), ("a", "b", "c")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, kind="w"):
    return " ".join(f"{kind}{rng.randrange(4000):04d}" for _ in range(n))


@pytest.fixture(scope="module")
def tables():
    """Documents with toxic ones, near copies, shared passages, benchmark passages and odd rows; labels and items."""
    rng = random.Random(11)
    texts = [words(rng, rng.choice([20, 60, 130, 150])) for _ in range(160)]
    toxic = set(range(0, 160, 8))
    for k in toxic:
        w = texts[k].split()
        for bad in ("grumpf", "snarlok", "vexen", "blorgus"):
            w.insert(rng.randrange(len(w)), bad)
        texts[k] = " ".join(w)
    for k in (3, 5, 9, 17):
        texts += [texts[k], texts[k].replace(texts[k].split()[4], "changed", 1)]
    passage, short = words(rng, 60, "p"), words(rng, 45, "q")
    for k in range(4):
        texts += [f"{words(rng, 30)} {passage} {words(rng, 25)}", f"{words(rng, 30)} {short} {words(rng, 25)}"]
    items = [(k, words(rng, 40, "i")) for k in range(5)] + [(8, None), (9, "")]
    texts += [f"{words(rng, 50)} {items[1][1]} {words(rng, 9)}", items[2][1], f"{words(rng, 40)} {' '.join(items[3][1].split()[:15])}"]
    texts += [None, "", " \n ", words(rng, 2500), "Ünï ß 日本語 " * 9]
    documents = [(k, t, LANGS[k % 4], SOURCES[k * k % 3], len(t or "")) for k, t in enumerate(texts)]
    labels = [(k, 1, int(k in toxic)) for k in range(160)] + [(None, 1, 1), (9999, 1, 1)]
    return documents, labels, items, toxic


@pytest.fixture(scope="module")
def folder(spark, tables, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    documents, labels, items, _ = tables
    for name, rows, schema in (
        ("documents", documents, DOCUMENTS), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id long, text string"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return path


def without_passages(rows, least, wanted):
    """Texts without the stretches covered by repeated strings that have enough words."""
    count = Counter()
    data = {i: (t or "").encode() for i, t in rows}
    for b in data.values():
        count.update(b[k : k + least] for k in range(len(b) - least + 1))
    out = {}
    for i, b in data.items():
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - least + 1):
            if count[b[k : k + least]] > 1:
                gone[k : k + least] = True
        kept, at = b"", 0
        while at < len(b):
            end = at
            while end < len(b) and gone[end] == gone[at]:
                end += 1
            if not gone[at] or len(b[at:end].split()) < wanted:
                kept += b[at:end]
            at = end
        out[i] = kept.decode("utf-8", "ignore")
    return out


def rake(n, aims, budget):
    """Bisection of one scale after the other until all margins hold under the bound."""
    scales = [np.ones(k) for k in n.shape]
    for _ in range(400):
        worst = 0.0
        for axis, aim in enumerate(aims):
            for k in range(n.shape[axis]):
                lo, hi = 0.0, 1e6
                for _ in range(60):
                    scales[axis][k] = (lo + hi) / 2
                    p = np.minimum(1, np.einsum("i,j,k->ijk", *scales))
                    got = np.take(n * p, k, axis).sum()
                    lo, hi = (scales[axis][k], hi) if got < aim[k] * budget else (lo, scales[axis][k])
        p = np.minimum(1, np.einsum("i,j,k->ijk", *scales))
        worst = max(abs((n * p).sum(tuple(x for x in range(3) if x != axis)) / budget - aim).max() for axis, aim in enumerate(aims))
        if worst < 1e-8:
            break
    return p


def topic(text):
    n, marks = len(tokens(text)), sum((text or "").count(c) for c in "#$%&*|")
    return "empty" if not n else "marked" if marks > n else "brief" if n < 100 else "listed" if (text or "").count("\n") * 20 > n else "prose"


def feasible(asked, most):
    asked, most = np.array(asked), np.array(most)
    aim, full = asked.copy(), np.zeros(len(asked), bool)
    while (aim > most + 1e-12).any():
        full |= aim >= most
        aim = np.where(full, most, asked * (1 - most[full].sum()) / max(asked[~full].sum(), 1e-300))
    return aim


def expected_probabilities(rows):
    """{(source, lang, topic): probability} by the mixing stage's targets, raked independently."""
    cells = Counter()
    for _, t, lang, source, _ in rows:
        cells[source, lang, topic(t)] += len(tokens(t))
    values = [sorted({c[k] for c, x in cells.items() if x}) for k in range(3)]
    n = np.zeros([len(v) for v in values])
    for c, x in cells.items():
        if x:
            n[tuple(v.index(y) for v, y in zip(values, c))] = x
    budget = mixing.FRACTION * n.sum()
    had = [n.sum(tuple(x for x in range(3) if x != axis)) for axis in range(3)]
    asked = [had[0] ** mixing.SOURCE_POWER, np.array([mixing.LANG_SHARES[v] for v in values[1]]), had[2] ** mixing.TOPIC_POWER]
    p = rake(n, [feasible(a / a.sum(), h / budget) for a, h in zip(asked, had)], budget)
    return {tuple(v[k] for v, k in zip(values, at)): p[at] for at in np.ndindex(*n.shape)}


def test_run_against_brute_force(spark, tables, folder):
    documents, _, items, toxic = tables
    rows = [r for r in documents if r[0] not in toxic]
    groups = components([(r[0], r[1]) for r in rows], 5, 80)
    rows = [r for r in rows if groups[r[0]][1] == r[0]]
    kept = without_passages([(r[0], r[1]) for r in rows], suffix_dedup.STAGE_LEAST, suffix_dedup.STAGE_WORDS)
    changed = {r[0] for r in rows if kept[r[0]] != (r[1] or "")}
    assert len(changed) == 4
    rows = [(r[0], kept[r[0]], *r[2:4], len(kept[r[0]])) if r[0] in changed else r for r in rows if r[0] not in changed or kept[r[0]]]
    wanted = [shingles(t, 5) for _, t in items]
    rows = [r for r in rows if not any(w and 100 * len(w & shingles(r[1], 5)) >= 80 * len(w) for w in wanted)]
    p = expected_probabilities(rows)
    ids = spark.createDataFrame([(r[0],) for r in rows], "doc_id long")
    draw = {r[0]: r[1] / float(1 << 40) for r in ids.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(mixing.SEED)), F.lit(1 << 40))).collect()}
    chance = {r[0]: p[r[3], r[2], topic(r[1])] if tokens(r[1]) else 0.0 for r in rows}
    sure = {r[0] for r in rows if abs(draw[r[0]] - chance[r[0]]) > 1e-3}
    want = {r for r in rows if r[0] in sure and draw[r[0]] < chance[r[0]]}
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = {tuple(r) for r in out.collect()}
    assert {r for r in got if r[0] in sure} == want and {r[0] for r in got} <= {r[0] for r in rows} and len(want) > 30


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, tables, folder, name, stage):
    """Nulls in every column, repeated rows, clashing extra columns, and no rows at all."""
    documents = tables[0]
    odd = [(None, None, None, None, None), (None, "some text of a row without an id", None, "a", 3), (7, documents[7][1], "en", "a", 9), (7, documents[7][1], "en", "a", 9)]
    extra = [(*r, 1, "x", 2.0, "y") for r in [*documents[100:130], *odd]]
    docs = spark.createDataFrame(extra, DOCUMENTS + ", rid int, word string, score double, kept string")
    out = stage(spark, docs, folder)
    assert set(docs.columns[:5]) <= set(out.columns)
    got = [tuple(r) for r in out.select(docs.columns[:5]).collect()]
    assert len(got) <= len(extra) and Counter(r[0] for r in got)[7] in (0, 2)
    if name not in ("source_mixing",):
        assert sum(r[0] is None for r in got) == 2
    assert stage(spark, docs.limit(0), folder).count() == 0


# Registered queries ---------------------------------------------------------

def test_every_query_has_sql_or_a_test_here():
    here = open(__file__).read()
    assert all(name in oracle_sql() or f'queries()["{name}"]' in here for name in queries())


def test_op1(spark, tables, folder):
    out = {r["doc_id"]: r for r in queries()["op1_toxicity"](spark, folder).collect()}
    assert set(out) == {r[0] for r in tables[0]} and {k for k, r in out.items() if r["predicted"]} == tables[3]
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for k, r in out.items())
    assert all(zlib.crc32(str(e["doc_id"]).encode()) % 5 for r in out.values() for e in r["evidence"])


def test_op2(spark, tables, folder):
    out = sorted(map(tuple, queries()["op2_suffix_array_dedup"](spark, folder).collect()))
    assert out == sorted(repeats([(r[0], r[1]) for r in tables[0]], 400)) and any(r[2] for r in out)


def test_op3(spark, tables, folder):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=token_counts.default_model())
    want = {(r[0], len((r[1] or "").encode()), len(sp.encode(r[1] or "")), len(sp.encode(r[1] or "")) > 4096) for r in tables[0]}
    assert {tuple(r)[:4] for r in queries()["op3_token_counts"](spark, folder).collect()} == want and any(w[3] for w in want)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data")
def test_op6(spark):
    """The registered query on whole pages against the article as a pattern finds it."""
    folder = "/root/testdata/sf0.001"
    want = {}
    for r in spark.read.parquet(f"{folder}/pages.parquet").collect():
        inside = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = re.split(r"</?(?:h1|p)>", inside.replace("<br>", " "))
        text = "\n".join(t for t in (" ".join(html.unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in parts) if t)
        want[r["page_id"]] = (r["url"], text, len(text))
    got = {r["page_id"]: tuple(r)[1:4] for r in queries()["op6_html_extraction"](spark, folder).collect()}
    assert got == want and len(got) == 50


def test_op7(spark, tables, folder):
    rows = sorted(((r[0], r[1] or "") for r in tables[0]), reverse=True)
    text = lambda f: f.astype(">u2").tobytes().hex()
    want = {}
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        changed = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        a, b, c = (lz_fingerprint.fingerprint(x) for x in (t, changed, after))
        want[i] = (len(t), hashlib.sha256(changed.encode()).hexdigest(), text(a), text(b), lz_fingerprint.likeness(a, b), lz_fingerprint.likeness(a, c))
    assert {r[0]: tuple(r)[1:] for r in queries()["op7_lz_fingerprint"](spark, folder).collect()} == want


def test_op8(spark, tables, folder):
    p = expected_probabilities(tables[0])
    out = queries()["op8_source_mixing"](spark, folder).collect()
    assert len(out) == len(tables[0])
    for r in out:
        t = tables[0][r["doc_id"]][1]
        assert r["n_tokens"] == len(tokens(t)) and abs(r["probability"] - (p[r["source"], r["lang"], r["topic"]] if tokens(t) else 0.0)) < 2e-4


def brute_scores(rows):
    """Weights by expectation-maximisation over all segmentations of all different training words, in plain Python."""
    pieces, start = lattice_lm.vocabulary(token_counts.default_model())
    of = {x: k for k, x in enumerate(pieces)}
    longest = max(map(len, pieces))
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 7 != 2]
    c = Counter(w for r in train for w in (r[1] or "").encode().lower().split())
    logp = list(start)

    def arcs(b, s):
        yield s + 1, len(pieces) + b[s]
        for e in range(s + 1, min(len(b), s + longest) + 1):
            if b[s:e] in of:
                yield e, of[b[s:e]]

    def forward(b):
        a = [1.0] + [0.0] * len(b)
        for s in range(len(b)):
            for e, k in arcs(b, s):
                a[e] += a[s] * math.exp(logp[k])
        return a

    for _ in range(lattice_lm.ROUNDS):
        uses = np.full(len(logp), 0.01)
        uses[-1] += 1
        for w in c:
            b = b" " + w
            a, after = forward(b), [0.0] * len(b) + [1.0]
            for s in range(len(b) - 1, -1, -1):
                for e, k in arcs(b, s):
                    x = math.exp(logp[k]) * after[e]
                    after[s] += x
                    uses[k] += a[s] * x / a[-1]
        logp = np.log(uses / uses.sum())
    total = sum(c.values()) + len(train)
    fresh = (sum(1 for x in c.values() if x == 1) + 1) / (total + 2)
    end = math.log10((1 - fresh) * len(train) / total + fresh * math.exp(logp[-1]))
    of_word = {}

    def word(w):
        if w not in of_word:
            of_word[w] = math.log10((1 - fresh) * c[w] / total + fresh * forward(b" " + w)[-1])
        return of_word[w]

    return {r[0]: end + sum(word(w) for w in (r[1] or "").encode().lower().split()) for r in rows}


def test_op10(spark, tables, folder, monkeypatch):
    """Scores against plain Python, the same whichever words are looked up by a join and whatever counts as long."""
    want = brute_scores(tables[0])
    for head, long in ((1e-6, 48), (0.01, 3)):
        monkeypatch.setattr(lattice_lm, "HEAD", head)
        monkeypatch.setattr(lattice_lm, "LONG", long)
        got = {r["doc_id"]: r["score"] for r in queries()["op10_lattice_lm"](spark, folder).collect()}
        assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-6 * abs(want[k]) for k in want)
