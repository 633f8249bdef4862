"""Fill-in-the-middle against lists of units cut by a regular expression."""

import hashlib
import random
import re

import pytest

from corpusloom.llm import fill_middle

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected(doc_id, text, rate=50, spm=80):
    text = text or ""
    units = UNITS.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", text, None, None
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return n, "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    parts = ["word", "Ünï", "日本語", "😀", "a", "<", "<P", "S>", " ", "  ", "\n", "\t\x0b", " ", "\x1f", "é" * 50]
    texts = ["".join(rng.choice(parts) for _ in range(rng.choice([1, 3, 20, 200, 3000]))) for _ in range(150)]
    texts += ["", None, " ", " \n", "x", " x", "x ", "<P>", "a <S> b", "a<M>", "<P" * 300, "one two three " * 20000, "😀" * 5000, "　 x"]
    rows = list(enumerate(texts))
    return rows + rows[:2] + [(None, "no id at all"), (None, None), (-7, "below zero here")]


SCHEMA = "doc_id long, text string, lang string, n long, form string, output int, h long"


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_against_lists_of_units(spark, rows, block):
    docs = spark.createDataFrame([(i, t, None, 5, "x", 1, None) for i, t in rows], SCHEMA)
    out = fill_middle.fill_in_middle(docs, rate=90, spm=40, block=block)
    got = sorted(map(repr, map(tuple, out.collect())))
    assert got == sorted(repr((i, *expected(i, t, 90, 40))) for i, t in rows)
    assert {r.form for r in out.collect()} == {"plain", "psm", "spm"}


def test_restored_exactly(spark, rows):
    docs = spark.createDataFrame([(i, t, None, 5, "x", 1, None) for i, t in rows], SCHEMA)
    out = fill_middle.fill_in_middle(docs, rate=100)
    back = out.withColumn("back", fill_middle.restored(out["output"], out["form"])).collect()
    assert sorted((str(r.doc_id), r.back) for r in back) == sorted((str(i), t or "") for i, t in rows)


def test_no_rows(spark):
    assert fill_middle.fill_in_middle(spark.createDataFrame([], SCHEMA)).collect() == []


def test_descent_finds_every_cut():
    data = ("ab  cd\né " * 400 + "  ").encode()
    units = UNITS.findall(data.decode())
    text = fill_middle.TextBlocks(data, 16)
    assert (text.n, text.n_chars) == (len(units), len(data.decode()))
    for k in range(len(units) + 1):
        head = "".join(units[:k])
        assert text.cut(k) == (len(head.encode()), len(head))
