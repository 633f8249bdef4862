"""Training-data operators against brute force on small tables, with nulls, empty and long texts,
repeated rows, empty tables and extra columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import (
    chat, decontamination, hashing, html_extract, lattice_lm, lz_fingerprint, mixing, near_dup, suffix_dedup, token_counts, toxicity,
)
from corpusloom.llm.common import connected_components

from .brute import components, repeats, shingles, tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid long, kept string, word string"


def table(spark, rows, schema=SCHEMA):
    """(doc_id, text) rows with the other columns of documents and some whose names clash with inner ones."""
    full = [(i, t, "en", f"s{i % 3}" if i is not None else None, None if t is None else len(t), 7, "x", None) for i, t in rows]
    return spark.createDataFrame(full, schema)


def words(rng, n):
    return " ".join(rng.choice(["tion", "the", "and", "ber", "ou", "ly", "er"]) + rng.choice(["a", "en", "st", "ing"]) + str(rng.randrange(40)) for _ in range(n))


def edited(rng, text, share):
    return " ".join("zz" + str(rng.randrange(10**6)) if rng.random() < share else w for w in text.split())


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    base = [words(rng, rng.choice([3, 8, 60, 150])) for _ in range(25)]
    rows = list(enumerate(base))
    for t in base[:12]:
        for share in (0.0, 0.01, 0.03, 0.08):
            rows.append((len(rows), edited(rng, t, share)))
    shared = words(rng, 70)
    rows += [(len(rows) + k, words(rng, 30) + " " + shared + " " + words(rng, 20)) for k in range(4)]
    n = len(rows)
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\t "), (n + 3, "Ünï ß 日本語 😀 " + base[3]), (n + 4, "ab" * 900), (n + 5, words(rng, 6000))]
    return rows


EMPTY = []
ws = tokens


# Near-duplicates ------------------------------------------------------------

@pytest.mark.parametrize("width, block", [(4, 1024), (5, 2)])
def test_near_duplicates(spark, corpus, width, block):
    out = near_dup.near_duplicates(table(spark, corpus), width=width, block=block).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == components(corpus, width, 80)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def test_near_duplicates_edges(spark, corpus):
    assert near_dup.near_duplicates(table(spark, EMPTY)).count() == 0
    rows = corpus[3:5] + corpus[3:4] + [(None, corpus[3][1])]
    out = near_dup.near_duplicates(table(spark, rows)).collect()
    assert len(out) == 4 and [r["kept"] for r in out if r["doc_id"] is None] == [True]


def test_one_id_with_several_texts(spark):
    """Rows of one doc_id have the links of all its texts, whichever text leads its class."""
    rng = random.Random(21)
    a, b, c, d = (words(rng, 90) for _ in range(4))
    rows = [(5, a), (5, b), (8, edited(rng, a, 0.01)), (9, edited(rng, b, 0.01)), (7, a), (7, c), (3, edited(rng, c, 0.01)), (20, d), (21, edited(rng, d, 0.01))]
    rows += [(5, a), (5, ""), (30, ""), (40, None), (None, b), (None, d)]
    out = near_dup.near_duplicates(table(spark, rows), width=4).collect()
    got = {(r["doc_id"], r["component_id"]) for r in out if r["n_shingles"]}
    assert got == {(5, 3), (7, 3), (3, 3), (8, 3), (9, 3), (20, 20), (21, 20), (None, None)} and len(out) == len(rows)
    assert {(r["doc_id"], r["component_id"]) for r in out if not r["n_shingles"]} == {(5, 5), (30, 30), (40, 40)}
    for k in range(4):  # hashes of texts decide nothing
        two = [(5, f"{a} {k}"), (5, f"{b} {k}"), (8, f"{a} {k} x"), (9, f"{b} {k} y")]
        found = near_dup.near_duplicates(table(spark, two), width=4).collect()
        assert {(r["doc_id"], r["component_id"]) for r in found} == {(5, 5), (8, 5), (9, 5)}


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(400, 460)] + [(999, k) for k in range(500, 560)]
    out = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    parent = {}
    for a, b in edges:
        if a == b:
            continue
        group = {x for x in parent if parent[x] in (parent.get(a, a), parent.get(b, b))} | {a, b}
        low = min(min(group), parent.get(a, a), parent.get(b, b))
        parent.update({x: low for x in group})
    assert out == parent


# Repeats --------------------------------------------------------------------

@pytest.mark.parametrize("least, hot", [(400, 50_000), (120, 50_000), (120, 2)])
def test_repeated_strings(spark, corpus, monkeypatch, least, hot):
    """By sorting, and with crowded cores by counts."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rows = corpus + corpus[3:4]
    out = suffix_dedup.without_repeats(table(spark, rows), least)
    got = out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(repeats(rows, least), key=str)


def test_repeats_keep_columns_and_empty_tables(spark, corpus):
    out = suffix_dedup.without_repeats(table(spark, corpus[:3]), 400)
    assert {"rid", "word", "source"} <= set(out.columns) and {r["rid"] for r in out.collect()} == {7}
    assert suffix_dedup.without_repeats(table(spark, EMPTY), 400).count() == 0


def test_suffixes_sort_as_bytes_do():
    rng = random.Random(3)
    parts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 31))) for _ in range(80)]
    grid, sizes, sums = suffix_dedup._grid(parts, False)
    order, reach = suffix_dedup.suffix_sort(sums, grid, sizes, np.arange(len(parts)))
    assert [parts[k] for k in order] == sorted(parts)
    common = lambda x, y: next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
    assert reach[1:] == [common(parts[a], parts[b]) for a, b in zip(order, order[1:])]


# Tokens ---------------------------------------------------------------------

def test_token_counts_of_all_prefixes(spark, corpus):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=token_counts.default_model())
    rows = corpus + [(900, "<s> <unk> </s>  <0x0A>\n\n\tx   y "), (901, " "), (902, "a" * 3000)]
    got = {r["doc_id"]: r for r in token_counts.count_tokens(table(spark, rows), 100).collect()}
    for i, t in rows:
        r, n = got[i], len(sp.encode(t or ""))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((t or "").encode()), n, n > 100)
    prefixes = token_counts.prefix_table(table(spark, rows[-3:] + rows[20:24]))
    texts = dict(rows)
    for r in prefixes.collect():
        t = texts[r["doc_id"]]
        assert r["counts"][:200] == [len(sp.encode(t[:k])) for k in range(min(len(t) + 1, 200))]
    for r in token_counts.longest_within(prefixes, 9).collect():
        t = texts[r["doc_id"]]
        assert r["chars"] == max(k for k in range(len(t) + 1) if k < 400 and len(sp.encode(t[:k])) <= 9)
    assert token_counts.count_tokens(table(spark, EMPTY)).count() == 0


# Toxicity -------------------------------------------------------------------

def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(4)
    rows, marks = [], []
    for k in range(700):
        toxic = k % 5 == 0
        t = words(rng, 60).split()
        if toxic:
            for w in rng.sample(["grumpf", "snarlok", "vexen", "blorgus"], 3):
                t.insert(rng.randrange(len(t)), w + rng.choice(["", "a", "ing"]))
        rows.append((k, " ".join(t)))
        marks.append((k, 1, int(toxic)))
    rows += [(700, None), (701, ""), (702, "x" * 50_000), (703, rows[5][1])]
    labels = spark.createDataFrame(marks + [(999, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in toxicity.toxicity_scores(table(spark, rows), labels).collect()}
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out.values())
    assert all(out[k]["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0) for k in range(704))
    held = [k for k in range(700) if out[k]["held_out"]]
    assert sum(out[k]["predicted"] == (k % 5 == 0) for k in held) >= 0.95 * len(held)
    assert out[703]["score"] == out[5]["score"] and out[700]["score"] == out[701]["score"] < 0.5
    assert toxicity.toxicity_scores(table(spark, rows[:9]), labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.toxicity_scores(table(spark, EMPTY), labels).count() == 0


def test_all_words_of_the_sample_enter_the_vectors(spark, monkeypatch):
    """Documents whose only toxic words are in too few texts to mark the class, against brute force over all words."""
    monkeypatch.setattr(toxicity, "SHORT", 30)  # by bounds and by sums
    rng = random.Random(6)
    rows, marks = [], []
    for k in range(240):
        t = words(rng, 4 + k % 37).split()
        if k % 8 == 0:
            t += [f"{chr(97 + k // 32)}vile"] * 9  # in four toxic texts each
        rows.append((k, " ".join(t)))
        marks.append((k, 1, int(k % 8 == 0)))
    out = {r["doc_id"]: r for r in toxicity.toxicity_scores(table(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).collect()}
    bags = [Counter(ws(t)) for _, t in rows]
    learnt = [k for k in range(240) if not out[k]["held_out"]]
    known, df = set().union(*(bags[k] for k in learnt)), Counter(w for b in bags for w in b)
    weigh = lambda b: {w: (1 + math.log(n)) * (math.log(241 / (1 + df[w])) + 1) for w, n in b.items() if w in known}
    unit = lambda v: {w: x / math.sqrt(sum(y * y for y in v.values())) for w, x in v.items()}
    vs = [unit(weigh(b)) for b in bags]

    def near(k, others):
        cos = ((round(sum(x * vs[j].get(w, 0) for w, x in vs[k].items()), 12), j) for j in learnt)
        return sorted((-c, j) for c, j in cos if c > 0 and not (others and c > 1 - 1e-9))[:9]

    def vote(found):
        return (sum(c * c * marks[j][2] for c, j in found) + 0.5 / 20) / (sum(c * c for c, _ in found) + 0.5)

    # Isotonic regression by its minimax formula over the votes of the others.
    cases = sorted((round(vote(near(k, True)), 9), marks[k][2]) for k in learnt)
    xs, ys = np.array([v for v, _ in cases]), np.array([float(y) for _, y in cases])
    total = np.concatenate([[0], np.cumsum(ys)])
    m = len(ys)
    mean = lambda a, b: (total[b] - total[a]) / (b - a)
    edge = [a for a in range(m + 1) if a in (0, m) or xs[a] != xs[a - 1]]
    fit = np.array([max(min(mean(a, b) for b in edge if b > i) for a in edge if a <= i) for i in range(m)])
    knots, values = toxicity.isotonic(xs, ys)
    blocks = [np.flatnonzero(np.isclose(fit, v)) for v in sorted(set(np.round(fit, 12)))]
    assert np.allclose(knots, [xs[b].mean() for b in blocks]) and np.allclose(values, [(ys[b].sum() + 0.5) / (len(b) + 1) for b in blocks])
    for k in range(240):
        found = near(k, False)
        assert [(e["doc_id"], e["toxic"]) for e in out[k]["evidence"]] == [(j, marks[j][2]) for _, j in found] and out[k]["neighbours"] == len(found) > 0
        assert abs(out[k]["score"] - np.interp(vote(found), knots, values)) < 1e-9


def test_weight_is_chosen_inside_the_training_rows(spark):
    """Labels of held-out rows change neither the weight nor any score; marks of a fold come from the other folds."""
    rng = random.Random(9)
    rows = [(k, words(rng, 40) + (" " + " ".join(rng.sample(["grumpf", "snarlok", "vexen"], 2)) if k % 6 == 0 else "")) for k in range(400)]
    held = {k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0}
    scores = []
    for flip in (False, True):
        labels = spark.createDataFrame([(k, 1, int((k % 6 == 0) != (flip and k in held))) for k in range(400)], "doc_id long, quality int, toxic int")
        scores.append({r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(table(spark, rows), labels).collect()})
    assert scores[0] == scores[1]
    one = spark.createDataFrame([(k, rows[k][1], int(k % 6 == 0), k % toxicity.FOLDS) for k in range(400)], "doc_id long, text string, toxic int, fold int")
    fitted = toxicity.fit_vocabulary(one)
    for k in (None, 0, 3):
        bags = [(set(map(int, toxicity.features(t)[0])) | set(map(int, toxicity.features(t)[1])), i % 6 == 0) for i, t in rows if k is None or i % toxicity.FOLDS != k]
        t1 = sum(y for _, y in bags)
        n1 = np.array([sum(f in b for b, y in bags if y) for f in map(int, fitted.known)])
        n0 = np.array([sum(f in b for b, y in bags if not y) for f in map(int, fitted.known)])
        t0 = len(bags) - t1
        p1, p0, pooled = n1 / t1, (n0 + 0.5) / (t0 + 1), (n1 + n0 + 0.5) / (t1 + t0)
        z = (p1 - p0) / np.sqrt(pooled * (1 - np.minimum(pooled, 0.999)) * (1 / t1 + 1 / t0))
        want = (n1 >= toxicity.LEAST_TEXTS) & (z >= toxicity.LEAST_Z) & (p1 >= toxicity.LEAST_RATIO * p0)
        assert (want == (fitted.marks if k is None else fitted.without[k])).all() and want.any()


def test_block_max_search_is_exact():
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(400):
        idx = np.sort(rng.choice(50, rng.integers(0, 9), replace=False))
        rows.append((idx.tolist(), rng.integers(1, 5, len(idx)).tolist()))
    index = toxicity.BlockMaxIndex(rows, rng.integers(0, 2, 400).tolist(), rng.random(50) + 0.5)
    dense = np.zeros((400, 50))
    for k, (i, t) in enumerate(rows):
        dense[k, i] = index.weigh(np.array(i, int), np.array(t, float))
    dense = dense[[k for k in range(400) if rows[k][0]]]
    skipped = 0
    for i, t in rows[:80]:
        if i:
            q = np.zeros(50)
            q[i] = index.weigh(np.array(i), np.array(t, float))
            _, cos, read = index.search(np.array(i), np.array(t, float), 5)
            best = np.sort(dense @ q)[::-1][:5]
            assert np.allclose(np.sort(cos)[::-1], best[best > 0], atol=1e-9)
            skipped += index.blocks - read
    assert skipped > 0


def test_escape_of_heads_can_be_undone(spark):
    rng = random.Random(14)
    texts = ["".join(rng.choices(["<", "|", "\\", "a", "\n", "é"], k=rng.randrange(12))) for _ in range(300)] + ["<|", "<\\", "<\\|", "<<||", "", "<"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = rows.withColumn("e", chat.escaped(F.col("t"))).withColumn("u", chat.unescaped(F.col("e"))).collect()
    assert all(r.u == r.t and "<|" not in r.e for r in rows)


# Decontamination ------------------------------------------------------------

def test_contained_items(spark, corpus):
    rng = random.Random(6)
    items = [(k, words(rng, n)) for k, n in enumerate([1, 4, 5, 6, 30, 60, 200])] + [(50, None), (51, ""), (52, "Same Item two words here")]
    long = words(rng, 5000)
    rows = corpus + [
        (200, long[:9000] + " " + items[4][1].upper() + " " + long[9000:]), (201, " ".join(items[5][1].split()[:57]) + " x"),
        (202, " ".join(items[6][1].split()[:120])), (203, items[1][1]), (204, "same item TWO words here"), (204, "same item TWO words here"),
    ]
    got = sorted(map(tuple, decontamination.contaminated(table(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()))
    want = []
    for i, t in rows:
        have = shingles(t, 5)
        for j, u in items:
            s = shingles(u, 5)
            if s and 100 * len(s & have) >= 80 * len(s):
                want.append((i, j, len(s), len(s & have)))
    assert got == sorted(want) and {(200, 4), (201, 5), (204, 52)} <= {x[:2] for x in got}
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contaminated(table(spark, rows[:3]), empty).count() == 0
    assert decontamination.contaminated(table(spark, EMPTY), spark.createDataFrame(items, "item_id long, text string")).count() == 0


# Pages ----------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head><body class="home">
<header class=site-header>Site</header><nav><ul><li><a href="/">Home {0}</a></ul></nav><div class="cookie-notice">We use cookies</div>
<div class="ad">Buy {0}</div><aside>Side {0}</aside><article><h1>Title&nbsp;{0} &amp; more</h1><p>One <b>bold {0}<br>line
<p>Two &lt;tags&gt; &#233; {0}<ul><li>first {0}<li>second</ul><p class="tagline">Follow us today</p><form><input>Mail</form>
<div id="comments"><p>Nice {0}!</p></div></article><footer>&copy; {0}</footer>{1}"""
TEXT = "Title {0} & more\nOne bold {0} line\nTwo <tags> é {0}\nfirst {0}\nsecond"


def test_main_text(spark):
    rows = [(k, f"https://h.example/{k}", PAGE.format(k, "</body></html>" if k % 2 else "")) for k in range(8)]
    rows += [(20, "http://one.example/", "<p>Only &amp; page</p><p> </p>"), (21, None, None), (22, "", ""), (23, "no-host", "plain   text <b"), (24, "http://deep.example/", "<div>" * 3000 + "deep" + "</div>" * 10)]
    rows += [(25, "http://m.example/a", "<body><main><p>In</p></main><p>Out</p></body>"), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, template string, host int")
    out = html_extract.extracted(df).collect()
    got = defaultdict(list)
    for r in out:
        got[r["page_id"]].append(r["text"])
        assert r["n_chars"] == len(r["text"])
    # "second" and the tagline stand in every page of the host: they are template.
    assert all(got[k][0] == TEXT.format(k).replace("\nsecond", "") for k in range(8)) and len(got[0]) == 2
    assert got[20] == ["Only & page"] and got[21] == got[22] == [""] and got[23] == ["plain text"] and got[24] == ["deep"] and got[25] == ["In"]
    assert html_extract.extracted(df.limit(0)).count() == 0


# Fixed pages and what is the article in each, when the page stands alone.
ALONE = [
    ("<main><p>lead</p><article><p>body text</p></article></main>", ["lead", "body text"]),
    ("<article><p>long enough</p><section id='related-work'><p>rw</p></section><p class='ad hoc'>a</p><p class='notice'>n</p><div class='share-price'>s</div><div class='comments'><p>c</p></div><div class=ad>x</div></article>", ["long enough", "rw", "a", "n", "s"]),
    ("<article><p>body text long enough</p><article><p>reply</p></article></article><article><p>teaser</p></article>", ["body text long enough"]),
    ("<main><div class='article-header'><h1>Title</h1></div><div class='article-body'><p>text of it all</p></div><div class=box><p>x</p></div></main>", ["Title", "text of it all"]),
    ("<div class=content><header><h1>Site</h1></header><p>one</p><p>two</p></div><div class='site-footer'><p>longer than the text above it</p></div>", ["one", "two"]),
    ("<article><header><h1>Head</h1></header><p>text</p><footer>by</footer></article><div id=comments><article><p>a reader with a very long reply</p></article></div>", ["Head", "text"]),
    ("<div><div><p>first part of the text</p></div><div><p>second part of the text</p></div></div>", ["first part of the text", "second part of the text"]),
]


@pytest.mark.parametrize("html, want", ALONE)
def test_pages_that_stand_alone(html, want):
    assert [t for _, t in html_extract.blocks(f"<body>{html}</body>")] == want


def test_the_host_decides_where_a_page_would_not(spark):
    """Slots are weighed over all pages: a short article beside a long box, an empty one, and boxes that are constant."""
    rows, want = [], {}
    long = "The same offer stands on every page of this host and is a good deal longer than most of its texts."
    for k in range(24):
        text = f"text {k}" if k in (3, 9) else "" if k == 5 else f"Text {k} " + f"word{k} " * 12
        own = f"Latest from elsewhere, item {k} of many" if k in (3, 5) else f"Item {k}"
        rows.append((k, f"http://slots.example/{k}", f"<body><div class=top><p>{long}</p></div><div class=content><p>{text}</p></div><div class=side><p>{own}</p></div></body>"))
        want[k] = text.strip()
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in html_extract.extracted(df).collect()} == want
    alone = {k: "\n".join(t for _, t in html_extract.blocks(h)) for k, _, h in rows}
    assert all(alone[k] != want[k] for k in range(24))  # without induction every page differs


def test_slot_weights_against_plain_sums(spark):
    """Different texts of a slot add up, equal ones count once, links and removed elements not at all."""
    rng = random.Random(12)
    rows = []
    for k in range(40):
        body = "".join(f"<{t} class={rng.choice('ab')}><p>{rng.choice(['same', 'x' * rng.randrange(9), str(k)])}</p><a>link</a></{t}>" for t in rng.choices(["div", "section", "nav", "article"], k=4))
        rows.append((k, f"http://{'pq'[k % 2]}.example/", f"<body>{body}</body>"))
    rows += [(99, "http://few.example/", "<div>a</div>")]
    got = {r["host"]: {x["key"]: x["weight"] for x in r["slots"]} for r in html_extract.slot_weights(spark.createDataFrame(rows, "page_id int, host string, html string")).collect()}
    pages, texts = defaultdict(set), defaultdict(lambda: defaultdict(list))
    for _, host, html in rows:
        found = html_extract.slots_within(html_extract.slots_of(html_extract.parse(html)))
        pages[host].add(tuple(sorted((s.key, s.text) for s in found)))
        for s in found:
            texts[host][s.key].append(s)
    want = {}
    for host in pages:
        if len(pages[host]) >= html_extract.LEAST_PAGES:
            often = {k: v for k, v in texts[host].items() if len(v) >= html_extract.LEAST_PAGES}
            own = {k: sum({s.text: s.own for s in v}.values()) for k, v in texts[host].items()}
            want[host] = {k: own[k] + (0 if k else sum(w for j, w in own.items() if j)) for k in often}  # slots lie side by side in the body
    assert got == want and set(got) == {"http://p.example/", "http://q.example/"}


def test_templates_are_counted_over_all_pages_and_layouts(spark):
    """Two layouts share the places of a host, a third has few pages; boilerplate may be missing, chance repeats are none."""
    rows, want = [], {}
    for k in range(60):
        kind = "abc"[0 if k < 31 else 1 if k < 55 else 2]
        extra = f"Shared by some {k % 7}"  # on 8 or 9 of 60 pages
        box = "" if k in (3, 40) else f"<p>Sign up to {kind}</p>"
        # Every other page has a box of its own, so that layouts have variants.
        more = f"<div class=quote><p>Quote {k}</p></div>" if k % 2 else ""
        rows.append((k, f"http://two.example/{k}", f"<article><div class='{kind} body'><section><div class=in{kind}>{box}<p>Text {k}</p><p>{extra}</p>{more}</div></section></div></article>"))
        want[k] = "\n".join([f"Text {k}", extra] + ([f"Quote {k}"] if more else []))
    # The layouts differ in the frame alone.
    for k in range(60, 90):
        kind = "xy"[k % 3 == 0]
        box = f"<p>All about {kind}</p>" if k != 70 else ""
        rows.append((k, f"http://frame.example/{k}", f"<body><div class={kind}><div class=w{kind}><main><article><p>Text {k}</p>{box}</article></main></div></div></body>"))
        want[k] = f"Text {k}"
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in html_extract.extracted(df).collect()} == want


def test_tree_matching_keeps_order():
    a = html_extract.blocks("<article><p>a</p><p>b</p><p>c</p></article>")
    b = html_extract.blocks("<article><p>x</p><p>a</p><p>c</p><p>y</p></article>")
    _, pairs = html_extract.simple_tree_matching(html_extract.tree_of(a), html_extract.tree_of(b), a, b)
    assert {(0, 1), (2, 2)} <= set(pairs)


def plain_matching(a, b, x, y):
    """The recursion over all pairs of children."""
    if isinstance(a, int) or isinstance(b, int):
        return (4.0 if x[a][1] == y[b][1] else 1.0) if isinstance(a, int) and isinstance(b, int) else 0.0
    if a[0] != b[0]:
        return 0.0
    best = [[0.0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, p in enumerate(a[1], 1):
        for j, q in enumerate(b[1], 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + plain_matching(p, q, x, y))
    return 1.0 + best[-1][-1]


def test_tree_matching_against_plain_recursion():
    rng = random.Random(3)
    for _ in range(150):
        pages = []
        for _ in range(2):
            n = rng.randrange(1, 14)
            pages.append([("/".join(rng.choice("ab") for _ in range(rng.randrange(1, 4))), rng.choice("xyz")) for _ in range(n)])
        a, b = (html_extract.tree_of(p) for p in pages)
        weight, pairs = html_extract.simple_tree_matching(a, b, *pages)
        assert weight == plain_matching(a, b, *pages)
        assert len({p for p, _ in pairs}) == len({q for _, q in pairs}) == len(pairs)


def test_pages_of_very_many_blocks_are_quick():
    import time

    began = time.time()
    many = html_extract.layout_and_blocks("<article>" + "".join(f"<p>{k}</p>" for k in range(20_000)) + "</article>")
    layouts = ["\n".join(html_extract.layout_and_blocks("<article>" + "".join(f"<div class=c{k}><p>{k}</p></div>" for k in range(n, 3000)) + "</article>")[0]) for n in (0, 5)]
    assert len(many[1]) == 20_000 and html_extract.layout_classes([(1, 5, layouts[0]), (2, 4, layouts[1])]) == [1, 1] and time.time() - began < 20


# Fingerprints ---------------------------------------------------------------

def lz78(t):
    known, w, out = set(), "", []
    for c in t:
        w += c
        if w not in known:
            known.add(w)
            out.append(w)
            w = ""
    return out + ([w] if w else [])


def signature_of(t):
    ends, p = [], 0
    for x in lz78(t):
        p += len(x)
        ends.append(p)
    return lz_fingerprint.signature(t, ends)


def test_fingerprints(spark, corpus, monkeypatch):
    monkeypatch.setattr(lz_fingerprint, "RANGE_ROWS", 10)
    out = {r["doc_id"]: r for r in lz_fingerprint.fingerprints(table(spark, corpus)).collect()}
    rows = sorted(((i, t or "") for i, t in corpus), reverse=True)
    assert len(out) == len(rows)
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        e = t[: len(t) - half] + nxt[:half]
        a, b, c = signature_of(t), signature_of(e), signature_of(nxt)
        r = out[i]
        assert r["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest() and r["n_chars"] == len(t)
        assert (r["fingerprint"], r["edited_fingerprint"]) == (a.astype(">u2").tobytes().hex(), b.astype(">u2").tobytes().hex())
        assert abs(r["near_edited"] - lz_fingerprint.likeness(a, b)) < 1e-12 and abs(r["near_next"] - lz_fingerprint.likeness(a, c)) < 1e-12


def test_fingerprint_edges(spark):
    assert lz_fingerprint.fingerprints(table(spark, EMPTY)).count() == 0
    one = lz_fingerprint.fingerprints(table(spark, [(1, "abc")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1
    some = lz_fingerprint.fingerprints(table(spark, [(1, "abc abc"), (1, "abc abc"), (None, "zzz"), (2, "q")])).collect()
    assert len(some) == 4 and len({r["fingerprint"] for r in some if r["doc_id"] == 1}) == 1


# Mixing ---------------------------------------------------------------------

def test_raked_margins(spark, corpus):
    rng = random.Random(8)
    rows = [(k, words(rng, rng.choice([5, 40, 200, 300])), rng.choice(["en", "de", "fr", None]), rng.choice(["a", "b", "c"])) for k in range(400)]
    docs = spark.createDataFrame(rows + [(900, None, "en", "a"), (901, "", None, None)], "doc_id long, text string, lang string, source string")
    share = lambda d: spark.createDataFrame(list(d.items()), "value string, share double")
    targets = {"source": share({"a": 0.6, "b": 0.3, "c": 0.1}), "lang": share({"en": 0.5, "de": 0.3})}
    out = mixing.sampled(docs, 0.3, targets=targets).toPandas()
    assert len(out) == 402
    expected = out["probability"] * out["n_tokens"]
    by = expected.groupby(out["source"]).sum() / expected.sum()
    assert abs(by["a"] - 0.6) < 1e-5 and abs(by["b"] - 0.3) < 1e-5
    lang = expected.groupby(out["lang"]).sum() / expected.sum()
    assert abs(lang["en"] / lang["de"] - 5 / 3) < 1e-4
    assert abs(expected.sum() / out["n_tokens"].sum() - 0.3) < 1e-6
    assert not out[out["n_tokens"] == 0]["kept"].any() and out["probability"].between(0, 1).all()
    assert mixing.sampled(docs.limit(0), 0.3).count() == 0


@pytest.mark.parametrize("fraction, shares", [(0.3, {"a": 0.6, "b": 0.3, "c": 0.1}), (0.55, {"a": 0.55, "b": 0.25, "c": 0.2}), (0.7, {"a": 0.9, "b": 0.05, "c": 0.05})])
def test_mixing_against_brute_force(spark, fraction, shares):
    """Margins under the bound that no token is drawn twice, against independent raking in numpy, and the draws by their hash."""
    rng = random.Random(9)
    rows = [(k % 380, words(rng, rng.choice([5, 40, 120])), rng.choice(["en", "de"]), rng.choice("aabc"), "x", 1) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, value string, tokens int")
    share = lambda d: spark.createDataFrame(list(d.items()), "value string, share double")
    langs = {"en": 0.6, "de": 0.4}
    out = mixing.sampled(docs, fraction, topic_of=F.lit("t"), targets={"source": share(shares), "lang": share(langs)}).toPandas()
    n = out.groupby(["source", "lang"])["n_tokens"].sum().unstack().to_numpy(float)
    budget = fraction * n.sum()

    def feasible(asked, most):
        aim, full = asked.copy(), np.zeros(len(asked), bool)
        while (aim > most + 1e-12).any():
            full |= aim >= most
            aim = np.where(full, most, asked * (1 - most[full].sum()) / asked[~full].sum())
        return aim

    row, col = feasible(np.array([shares[k] for k in "abc"]), n.sum(1) / budget), feasible(np.array([langs[k] for k in ("de", "en")]), n.sum(0) / budget)
    a, b = np.ones(3), np.ones(2)
    for _ in range(3000):  # bisection of each scale, margins by turns
        for x, aim, axis in ((a, row, 1), (b, col, 0)):
            for k in range(len(x)):
                lo, hi = 0.0, 1e9
                for _ in range(80):
                    x[k] = (lo + hi) / 2
                    got = np.minimum(n, n * np.outer(a, b)).sum(axis)[k]
                    lo, hi = (x[k], hi) if got < aim[k] * budget else (lo, x[k])
        e = np.minimum(n, n * np.outer(a, b))
        if abs(e.sum(1) / budget - row).max() < 1e-9 and abs(e.sum(0) / budget - col).max() < 1e-9:
            break
    got = out.assign(e=out["probability"] * out["n_tokens"]).groupby(["source", "lang"])["e"].sum().unstack().to_numpy()
    assert np.allclose(got / budget, e / budget, atol=1e-4)
    asked = np.array([shares[k] for k in "abc"])
    missed = out.groupby("source")["missed_source"].first().to_numpy()
    assert np.allclose(missed, row - asked, atol=1e-5)
    h = {r[0]: r[1] for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(mixing.SEED)), F.lit(1 << 40)).alias("h")).collect()}
    assert all(k == (h[d] / float(1 << 40) < p) for d, p, k in zip(out["doc_id"], out["probability"], out["kept"])) and len(out) == 400


# Chat -----------------------------------------------------------------------

def test_perspectives(spark):
    turns = [(1, 0, "system", "Be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, "cy", "yo"), (1, 3, "ann", "two"), (2, 5, None, "alone"), (3, 0, "system", "only"), (None, 1, "x", "n"), (4, 1, "d", "r"), (4, 1, "d", "r")]
    turns += [(9, k, ["p", "q"][k % 2], "t" * (k % 5)) for k in range(700)]
    df = spark.createDataFrame([(*t, 1, "c") for t in turns], "conv_id long, turn long, role string, text string, run int, mask string")
    out = chat.rotate_perspectives(df).toPandas()
    convs = defaultdict(list)
    for c, n, r, t in turns:
        convs[c].append((n, r or "unknown", t or ""))
    seen = 0
    for c, ts in convs.items():
        for who in {r for _, r, _ in ts if r != "system"}:
            part = out[(out["perspective"] == who) & (out["conv_id"].isna() if c is None else out["conv_id"] == c)].sort_values("seq")
            whole, want = "".join(part["segment"]), []
            for _, r, t in sorted(ts):
                name = "system" if r == "system" else "assistant" if r == who else f"user:{r}"
                want.append(f"<|{name}|>\n{t}\n")
            assert whole == "".join(want)
            spoken = [whole[a:b] for a, b, m in zip(part["mask_start"], part["mask_end"], part["mask"]) if m]
            assert spoken == [t for _, r, t in sorted(ts) if r == who]
            seen += len(part)
    assert seen == len(out) and chat.rotate_perspectives(df.limit(0)).count() == 0
    # Rendered, in parts that put together are the whole, with masks at the same places.
    for size in (chat.PART, 50):
        parts = chat.dialogues(df, size).toPandas().sort_values("part")
        for (c, who), p in parts.groupby(["conv_id", "perspective"], dropna=False):
            own = out[(out["perspective"] == who) & (out["conv_id"].isna() if c != c else out["conv_id"] == c)].sort_values("seq")
            text = "".join(p["text"])
            assert text == "".join(own["segment"]) and list(p["char_start"]) == list(np.cumsum([0, *p["text"].str.len()])[:-1])
            spans = [x for m in p["masks"] if m for x in m.split(",")]
            assert [text[int(x.split("-")[0]) : int(x.split("-")[1])] for x in spans] == [t for _, r, t in sorted(convs[None if c != c else int(c)]) if r == who]
    assert (chat.dialogues(df).groupBy("conv_id", "perspective").count().where("count > 1").count()) == 0


def test_heads_in_texts_are_broken_up(spark):
    df = spark.createDataFrame([(1, 0, "a<|b", "say <|assistant|> now"), (1, 1, "c", "ok")], "conv_id long, turn long, role string, text string")
    out = {r["perspective"]: r["text"] for r in chat.dialogues(df).collect()}
    assert out["c"] == "<|user:a<\\|b|>\nsay <\\|assistant|> now\n<|assistant|>\nok\n"


# Language model -------------------------------------------------------------

def test_lattice_is_the_sum_over_segmentations():
    pieces = [b" a", b"b", b"ab", b" ab", b"ba", b"a", b" "]
    logp = np.log(np.full(len(pieces) + 257, 1.0 / (len(pieces) + 257)))
    lattice = lattice_lm.Lattice(pieces, logp)

    def total(b):
        if not b:
            return 1.0
        p = math.exp(logp[0])
        return p * total(b[1:]) + sum(p * total(b[len(x) :]) for x in pieces if b.startswith(x))

    ws_ = [b"ab", b"abba", b"aaab", b"zz", b"b", b"a" * 60]
    got = lattice.words(ws_)
    assert np.allclose(got[:5], [math.log(total(b" " + w)) for w in ws_[:5]]) and abs(got[5] - lattice.word(ws_[5])) < 1e-9
    uses = lattice.expected([b"ab"], np.ones(1))
    spelled = sum(uses[k] * len(p) for k, p in enumerate(pieces)) + uses[len(pieces) : -1].sum()
    assert abs(spelled - 3) < 1e-9


def test_long_words_count_over_their_segmentations(spark, monkeypatch):
    rng = random.Random(8)
    pieces = [b" a", b"b", b"ab", b" ab", b"ba", b"a", b" ", b"abab"]
    lattice = lattice_lm.Lattice(pieces, np.log(np.arange(1, len(pieces) + 258) / 9999.0))
    long = ["".join(rng.choice("abz") for _ in range(n)).encode() for n in (20, 47)]
    short = lattice.expected(long, np.array([1.0, 2.0]))
    monkeypatch.setattr(lattice_lm, "LONG", 10)
    assert np.allclose(lattice.expected(long, np.array([1.0, 2.0])), short, atol=1e-9)
    # In a word of 5,000 bytes the uses spell the word, and pieces have their share.
    w = b"ab" * 2500
    uses = lattice.expected([w], np.ones(1))
    spelled = sum(uses[k] * len(p) for k, p in enumerate(pieces)) + uses[len(pieces) : -1].sum()
    assert abs(spelled - 5001) < 1e-6 and uses[: len(pieces)].sum() > 100


def test_scores(spark, corpus):
    rows = corpus + corpus[2:3]
    out = defaultdict(list)
    for r in lattice_lm.lattice_scores(table(spark, rows)).collect():
        out[r["doc_id"]].append(r)
    c = Counter()
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    for i, t in rows:
        if not held(i):
            c.update([*ws(t), "END"])
    n, v = sum(c.values()), len(c)
    for i, t in rows:
        tokens = [*ws(t), "END"]
        for r in out[i]:
            base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens)
            assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(i), len(tokens), sum(c[w] > 0 for w in tokens), n)
            assert abs(r["base_score"] - base) < 1e-6 * max(1, abs(base)) and r["score"] < 0
    assert len(out[corpus[2][0]]) == 2 and len({round(r["score"], 9) for r in out[corpus[2][0]]}) == 1
    assert lattice_lm.lattice_scores(table(spark, EMPTY)).count() == 0


def test_long_texts_hash_like_short_ones(monkeypatch):
    rng = random.Random(1)
    text = words(rng, 3000) + " " + "y" * 5000 + " end"
    whole = hashing.word_hashes(text)
    monkeypatch.setattr(hashing.segments, "__defaults__", (64,))
    assert (hashing.word_hashes(text) == whole).all() and len(whole) == len(re.findall(r"\S+", text))


def test_components_take_few_rounds_where_tasks_can_join_up_edges(spark, monkeypatch):
    from corpusloom.llm import common

    made = []
    monkeypatch.setattr(common, "durable", lambda df, f=common.durable: made.append(1) or f(df))
    order = np.random.default_rng(5).permutation(600).tolist()
    chain = spark.createDataFrame(list(zip(order, order[1:])), "src long, dst long")
    assert {tuple(r) for r in connected_components(chain).collect()} == {(k, 0) for k in range(600)}
    assert len(made) <= 2


@pytest.mark.parametrize("held", [1, 7, 1 << 20])
def test_stars_connect_what_edges_connect(spark, monkeypatch, held):
    from corpusloom.llm import common

    monkeypatch.setattr(common, "JOINED", held)
    r = np.random.default_rng(held)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 300, (220, 2))]
    low = {x: x for e in edges for x in e}
    for _ in low:
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    frame = spark.createDataFrame(edges, "src long, dst long").repartition(5)
    got = {(x["node"], x["component"]) for x in connected_components(frame).collect()}
    assert got == {(x, c) for x, c in low.items() if x != c or any(x in e and e[0] != e[1] for e in edges)}
