"""Language-model scoring by subword lattice likelihood.

The pieces and scores of an existing vocabulary (plus one piece for each byte
and one for the end) start a unigram model whose weights are learnt from the
training documents by expectation-maximisation; nothing is added to the
vocabulary.  A word's probability is the sum over all its segmentations into
pieces, by a forward recursion in log space over the lattice of pieces that fit;
no piece crosses a word, so a document's probability is the product over words.

The lattice has one more arc over a whole word that training has seen, with the
word's relative frequency; all arcs of pieces together get the share of tokens
that a new word has had so far (Good and Turing: words seen once, by tokens).  As
pieces have to spell what is new, their weights are learnt from distinct words,
each counting once.

Counts of words cover every training document.  Words of at least ``HEAD`` of all
training tokens (so at most 1 / HEAD of them) go to the tasks; the rest are
looked up by a join.  Every round of expectation-maximisation runs on every distinct
training word, over all its segmentations whatever its length.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, table, written
from .hashing import U64, powers, span_hashes
from .token_counts import default_model

HEAD, ROUNDS, SMOOTH = 1e-6, 5, 0.01
#: Longer words, in bytes, are scored and learnt from one at a time.
LONG = 48
#: Words handled together.
MANY = 60_000


@lru_cache(maxsize=2)
def vocabulary(model: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces that can occur inside one word, then the 256 single bytes, then the end; and starting log weights."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces, start = [], []
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or p.startswith("▁▁") or p != p.translate(_LOWER):
            continue
        pieces.append(p.replace("▁", " ").encode())
        start.append(max(sp.get_score(i), -1e6))
    rank = np.argsort(np.argsort(-np.array(start), kind="stable"), kind="stable")
    weight = np.concatenate([1 / (rank + 20.0), np.full(256, 1e-6), [1e-2]])
    return pieces, np.log(weight / weight.sum())


_LOWER = {c: c + 32 for c in range(65, 91)}


class Lattice:
    """All segmentations of words under piece log weights (natural logarithm)."""

    def __init__(self, pieces: list[bytes], logp: np.ndarray):
        self.logp = logp
        self.n = len(pieces)
        self.of = {p: k for k, p in enumerate(pieces)}
        self.lengths = sorted({len(p) for p in pieces})
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([len(p) for p in pieces])
        # Like span_hashes of a word's prefix sums: the hash depends on the bytes alone.
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * powers(len(data))[0], out=sums[1:])
        keys = span_hashes(sums, np.concatenate([[0], ends[:-1]]), ends)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.keys >> U64(42)).astype(np.int64)] = True

    def _arcs(self, block: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(length, piece by [start, word] or -1) for words of equal length, bytes down, words across."""
        size, n = block.shape
        sums = np.zeros((size + 1, n), U64)
        np.cumsum((block.astype(U64) + U64(1)) * powers(size)[0][:, None], axis=0, out=sums[1:])
        out = [(1, self.n + block.astype(np.int64))]
        starts = np.arange(size)
        flat = sums.ravel()
        for k in self.lengths:
            if k > size:
                break
            s = (starts[: size - k + 1, None] * n + np.arange(n)[None, :]).ravel()
            h = self._hash(flat, s, k, n)
            hit = np.flatnonzero(self.bits[(h >> U64(42)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.keys, h[hit]), len(self.keys) - 1)
            real = self.keys[at] == h[hit]
            if real.any():
                ids = np.full(len(s), -1, np.int64)
                ids[hit[real]] = self.order[at[real]]
                out.append((k, ids.reshape(size - k + 1, n)))
        return out

    @staticmethod
    def _hash(flat: np.ndarray, s: np.ndarray, k: int, n: int) -> np.ndarray:
        from .hashing import mix

        inv = powers(len(flat) // n)[1]
        raw = (flat[s + k * n] - flat[s]) * np.repeat(inv[: len(s) // n], n)
        return mix(raw ^ U64(k * 0x9FB21C651E98DF25 % 2**64))

    def _forward(self, arcs: list, logs: list, size: int, n: int) -> np.ndarray:
        a = np.zeros((size + 1, n))
        for t in range(1, size + 1):
            c = np.stack([a[t - k] + lp[t - k] for (k, _), lp in zip(arcs, logs) if k <= t])
            top = c.max(axis=0)
            a[t] = top + np.log(np.exp(c - top).sum(axis=0))
        return a

    def _blocks(self, words: list[bytes]):
        by: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            by.setdefault(len(w), []).append(k)
        for size, at in by.items():
            step = max(1, 200_000 // (size + 1))  # bounds the arrays, whatever the lengths
            for lo in range(0, len(at), step):
                part = at[lo : lo + step]
                yield size + 1, np.array(part)

    def _log(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids >= 0, self.logp[ids], -np.inf)

    def _long(self, b: bytes) -> array:
        """Forward log sums at every place of a word of any length, its space included."""
        a = array("d", [0.0])
        for t in range(1, len(b) + 1):
            c = [a[t - 1] + self.logp[self.n + b[t - 1]]]
            for k in self.lengths:
                if k > t:
                    break
                p = self.of.get(b[t - k : t])
                if p is not None:
                    c.append(a[t - k] + self.logp[p])
            top = max(c)
            a.append(top + math.log(sum(math.exp(x - top) for x in c)))
        return a

    def word(self, w: bytes) -> float:
        """Log probability of one word of any length."""
        return self._long(b" " + w)[-1]

    def _long_uses(self, w: bytes, count: float, out: np.ndarray) -> None:
        """Adds the expected uses of a word of any length; the backward sums are kept over the longest piece only."""
        b = b" " + w
        a, longest = self._long(b), max(self.lengths, default=1)
        after, total = {len(b): 0.0}, a[-1]
        for s in range(len(b) - 1, -1, -1):
            c = []
            for k, p in [(1, self.n + b[s]), *((k, self.of.get(b[s : s + k])) for k in self.lengths if s + k <= len(b))]:
                if p is not None:
                    x = self.logp[p] + after[s + k]
                    c.append(x)
                    out[p] += count * math.exp(a[s] + x - total)
            top = max(c)
            after[s] = top + math.log(sum(math.exp(x - top) for x in c))
            after.pop(s + longest, None)

    def words(self, words: list[bytes]) -> np.ndarray:
        """Log probabilities of the words: the marginals over all segmentations."""
        out = np.zeros(len(words))
        short = [k for k, w in enumerate(words) if len(w) < LONG]
        if len(short) < len(words):
            for k in set(range(len(words))) - set(short):
                out[k] = self.word(words[k])
        at = np.array(short, np.int64)
        for size, part in self._blocks([words[k] for k in short]):
            block = np.frombuffer(b"".join(b" " + words[k] for k in at[part]), np.uint8).reshape(len(part), size).T
            arcs = self._arcs(block)
            out[at[part]] = self._forward(arcs, [self._log(i) for _, i in arcs], size, len(part))[-1]
        return out

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over the words' segmentations."""
        out = np.zeros(len(self.logp))
        short = [k for k, w in enumerate(words) if len(w) < LONG]
        if len(short) < len(words):
            for k in set(range(len(words))) - set(short):
                self._long_uses(words[k], counts[k], out)
        at = np.array(short, np.int64)
        for size, part in self._blocks([words[k] for k in short]):
            n = len(part)
            block = np.frombuffer(b"".join(b" " + words[k] for k in at[part]), np.uint8).reshape(n, size).T
            arcs = self._arcs(block)
            logs = [self._log(i) for _, i in arcs]
            a = self._forward(arcs, logs, size, n)
            b = np.zeros((size + 1, n))
            for s in range(size - 1, -1, -1):
                c = np.stack([lp[s] + b[s + k] for (k, _), lp in zip(arcs, logs) if s + k <= size])
                top = c.max(axis=0)
                b[s] = top + np.log(np.exp(c - top).sum(axis=0))
            for (k, ids), lp in zip(arcs, logs):
                use = np.exp(a[: size - k + 1] + lp + b[k:] - a[size]) * counts[at[part]]
                mask = ids >= 0
                out += np.bincount(ids[mask], use[mask], minlength=len(out))
        return out


def learnt(expected: np.ndarray, ends: float) -> np.ndarray:
    """Log weights from expected uses, smoothed; the last piece is the end."""
    e = expected + SMOOTH
    e[-1] = ends + SMOOTH
    return np.log(e / e.sum())


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all texts of ``docs``; words are bytes."""

    def batches(it):
        for batch in it:
            c: Counter = Counter()
            for t in batch.column("text"):
                c.update(words_of(t.as_py()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c.keys()), pa.binary()), pa.array(list(c.values()), pa.int64())], ["word", "c"])

    return docs.select("text").mapInArrow(batches, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def fit(vocab: DataFrame, model: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces and log weights, by rounds over all training words."""
    pieces, logp = vocabulary(model)
    for _ in range(ROUNDS):
        logp = one_round(vocab, pieces, logp)
    return pieces, logp


def one_round(vocab: DataFrame, pieces: list[bytes], logp: np.ndarray) -> np.ndarray:
    shared = vocab.sparkSession.sparkContext.broadcast((pieces, logp))

    def batches(it):
        lattice, total, words, size = Lattice(*shared.value), None, [], 0
        for batch in it:
            for w in batch.column("word").to_pylist():
                words.append(w)
                size += 1 + len(w) // LONG
            if size >= MANY:
                e = lattice.expected(words, np.ones(len(words)))
                total = e if total is None else total + e
                words, size = [], 0
        if words:
            e = lattice.expected(words, np.ones(len(words)))
            total = e if total is None else total + e
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["piece", "uses"])

    uses = np.zeros(len(logp))
    for piece, n in vocab.select("word").mapInArrow(batches, "piece long, uses double").groupBy("piece").agg(F.sum("uses")).collect():  # one row for each piece
        uses[piece] = n
    shared.destroy()
    return learnt(uses, 1)


def lattice_scores(docs: DataFrame, folds: int = 7, fold: int = 2, model: str | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Null and empty texts are their end alone.  Repeated rows give repeated
    results; other columns are ignored.  A table without training rows gives a
    model of the starting weights and counts of 0.
    """
    path = model or default_model()
    spark = docs.sparkSession
    train = docs.where(F.coalesce(~held_out("doc_id", folds, fold), F.lit(False)))
    vocab = written(word_counts(train))
    ends = train.count()
    tokens, types, once = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.count_if(F.col("c") == 1)).first()
    total, distinct = tokens + ends, types + (1 if ends else 0)
    fresh = (once + 1) / (total + 2) if total else 1.0  # the share of new words
    least = max(1, math.ceil(HEAD * total))
    head = vocab.where(F.col("c") >= least).toArrow()  # at most 1 / HEAD rows
    pieces, logp = fit(vocab, path) if types else vocabulary(path)
    shared = spark.sparkContext.broadcast((pieces, logp, head.column("word").to_pylist(), head.column("c").to_numpy()))

    def batches(it):
        lattice = Lattice(shared.value[0], shared.value[1])
        words, counts = shared.value[2], shared.value[3]
        place = dict(zip(words, range(len(words))))
        log_c = np.append(np.log10(counts + 1.0), 0.0)
        seen = (1 - fresh) * counts / max(total, 1) + fresh * np.exp(lattice.words(words)) if words else np.empty(0)
        log_p = np.append(np.log10(seen), 0.0)
        end = math.log10((1 - fresh) * ends / max(total, 1) + fresh * math.exp(lattice.logp[-1]))
        for batch in it:
            rows, rare, uses = [], {}, []
            for k, text in enumerate(batch.column("text")):
                found = words_of(text.as_py())
                at = np.fromiter((place.get(w, -1) for w in found), np.int64, len(found))
                few = Counter(w for w, x in zip(found, at.tolist()) if x < 0) if (at < 0).any() else {}
                for w, n in few.items():
                    uses.append((rare.setdefault(w, len(rare)), k, n))
                rows.append((len(found) + 1, int((at >= 0).sum()), float(log_c[at].sum()), float(log_p[at].sum()) + end))
            rare_words = list(rare)
            marginal = np.zeros(len(rare_words))
            for lo in range(0, len(rare_words), MANY):
                marginal[lo : lo + MANY] = lattice.words(rare_words[lo : lo + MANY])
            u = np.array(uses, np.int64).reshape(-1, 3)
            ids = batch.column("rid")
            n_tokens, known, base, score = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    ids, batch.column("doc_id"), pa.nulls(len(rows), pa.binary()), pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()),
                    pa.array(base, pa.float64()), pa.array(score, pa.float64()),
                ],
                names,
            )
            for lo in range(0, len(u), 200_000):
                part = u[lo : lo + 200_000]
                k = len(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(part[:, 1])), pa.nulls(k, pa.int64()), pa.array([rare_words[x] for x in part[:, 0]], pa.binary()),
                        pa.array(part[:, 2]), pa.nulls(k, pa.int64()), pa.nulls(k, pa.float64()), pa.array(marginal[part[:, 0]] / math.log(10)),
                    ],
                    names,
                )

    names = ["rid", "doc_id", "word", "n", "known", "base", "score"]
    scored = written(
        docs.select(F.xxhash64("doc_id", "text").alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            batches, "rid long, doc_id long, word binary, n long, known long, base double, score double"
        )
    )
    rows = scored.where("word is null")
    copies = rows.groupBy("rid").agg(F.count("*").alias("copies"))
    # The marginal of a word over its arcs: as a whole, if seen, and by pieces.
    pieces_only = F.col("score") + math.log10(fresh)
    whole = F.log10(F.col("c") * ((1 - fresh) / max(total, 1)) + F.pow(F.lit(10.0), pieces_only))
    rare = (
        scored.where("word is not null").select("rid", "word", "n", "score").join(vocab, "word", "left")
        .groupBy("rid")
        .agg(
            F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rare_known"),
            F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(1.0))).alias("rare_base"),
            F.sum(F.col("n") * F.when(F.col("c").isNull(), pieces_only).otherwise(whole)).alias("rare_score"),
        )
    )
    # A row that occurs several times brought its rare words as often.
    share = lambda c: F.col(c) / F.col("copies")
    rare = rare.join(copies, "rid").select(
        "rid", share("rare_known").cast("long").alias("rare_known"), share("rare_base").alias("rare_base"), share("rare_score").alias("rare_score")
    )
    held = F.coalesce(held_out("doc_id", folds, fold), F.lit(True))
    seen_end = 1 if ends else 0
    known = F.col("known") + F.coalesce("rare_known", F.lit(0)) + seen_end
    base = F.col("base") + F.coalesce("rare_base", F.lit(0.0)) + math.log10(ends + 1) - F.col("n") * math.log10(total + distinct + 1)
    return rows.join(rare, "rid", "left").select(
        "doc_id", held.alias("held_out"), F.col("n").alias("n_tokens"), known.cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"),
    )


def op10_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_scores(table(spark, sf_dir, "documents"))
