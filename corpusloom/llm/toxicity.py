"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Fit: the vocabulary is every word of a bounded sample of labelled texts
(``SAMPLE`` rows, the smallest id hashes), and those word beginnings of several
byte lengths that mark the toxic class beyond chance.  Words and beginnings that
mark it weigh more; by how much is chosen from ``WEIGHTS`` by cross-validation
inside the sample, marks found anew in each fold.  Document frequencies are
counted over all documents.  The sample's TF-IDF vectors form an inverted index whose postings are
cut into blocks of examples with the largest weight of each block stored, so that
the bound of a block is a sum over the query's features.

Score: a short query visits blocks by falling bound until no bound reaches the
k-th best cosine; a long one, whose bounds are loose, adds up all its postings,
those of the commonest features as a matrix product.  The neighbours are exact
either way and are given as evidence.  Their labels vote with weight cosine
squared, smoothed towards the toxic share of sampled texts without any feature;
such texts get that share itself.

Calibrate: every sampled text is scored by the others, leaving out itself and
texts equal to it, and a rising step function from votes to the share of toxic
texts (isotonic regression, joined by straight lines) turns votes into
probabilities.  Scores depend on the text alone, so a sampled text that is scored
later does meet itself among its neighbours.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, held_out, table, written
from .hashing import U64, prefix_sums, segments, span_hashes

SAMPLE, NEIGHBOURS, BLOCK = 12_000, 9, 32
#: How much more a feature may weigh that marks the toxic class, the folds that decide, and the rows of the sample that they take.
WEIGHTS, FOLDS, TUNED = (1.0, 3.0, 10.0, 30.0), 5, 3_000
#: So many common features are held as full rows; queries of fewer (feature, block) cells than SHORT go by bounds.
FULL, SHORT = 256, 2_000
#: Queries scored together.
TOGETHER = 64
#: Byte lengths of the word beginnings.
HEADS = (4, 6, 8)
#: A feature that marks must be in so many toxic texts, so many standard errors beyond chance, with so many times the share.
LEAST_TEXTS, LEAST_Z, LEAST_RATIO = 3, 6, 10
#: Votes that the smoothing towards the prior counts for.
PRIOR_VOTES = 0.5
#: Texts of a larger cosine are equal word for word.
EQUAL = 1 - 1e-9

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and of all word beginnings of the text, repeats included."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    words, heads = [np.empty(0, U64)], [np.empty(0, U64)]
    for part in segments(data):
        a = np.frombuffer(part, np.uint8)
        edge = np.flatnonzero(np.diff(np.concatenate([[False], _LETTER[a], [False]]).view(np.int8)))
        if not len(edge):
            continue
        starts, ends, sums = edge[::2], edge[1::2], prefix_sums(a)
        words.append(span_hashes(sums, starts, ends))
        for n in HEADS:
            long = starts[ends - starts >= n]
            heads.append(span_hashes(sums, long, long + n) ^ U64(n))
    return np.concatenate(words), np.concatenate(heads)


def _class_counts(texts: DataFrame) -> DataFrame:
    """(feature, n1, n0, whole): in how many toxic and other sample texts of each fold a feature occurs, and whether it is a word."""

    def batches(it):
        for batch in it:
            for text, toxic, fold in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "fold"))):
                for f, whole in zip(features(text), (1, 0)):
                    f = np.unique(f).view(np.int64)
                    same = [pa.array(np.full(len(f), x, np.int32)) for x in (toxic, fold, whole)]
                    yield pa.RecordBatch.from_arrays([pa.array(f), *same], ["feature", "toxic", "fold", "whole"])

    of = lambda toxic: F.array(*(F.count_if((F.col("toxic") == toxic) & (F.col("fold") == k)) for k in range(FOLDS)))
    found = texts.select("text", "toxic", "fold").mapInArrow(batches, "feature long, toxic int, fold int, whole int")
    return found.groupBy("feature").agg(of(1).alias("n1"), of(0).alias("n0"), F.max("whole").alias("whole"))


@dataclass(frozen=True)
class Fitted:
    """Sorted hashes of the features, whether each is a word, and which mark the toxic class: in the whole sample, and in it without each fold."""

    known: np.ndarray
    word: np.ndarray
    marks: np.ndarray
    without: list[np.ndarray]

    def weights(self, weight: float, fold: int | None = None) -> np.ndarray:
        """What a feature's frequency is multiplied with: words count, marking features ``weight`` times, other beginnings not at all."""
        marks = self.marks if fold is None else self.without[fold]
        return np.where(marks, weight, np.where(self.word, 1.0, 0.0))


def fit_vocabulary(sample: DataFrame) -> Fitted:
    """All words of the sample, and the word beginnings that mark the toxic class in it or in it without a fold."""
    sizes = {r["fold"]: (r["t1"], r["t0"]) for r in sample.groupBy("fold").agg(F.sum("toxic").alias("t1"), F.sum(1 - F.col("toxic")).alias("t0")).collect()}  # one row a fold
    t1, t0 = (np.array([sizes.get(k, (0, 0))[c] for k in range(FOLDS)]) for c in (0, 1))
    empty = np.empty(0, bool)
    if not t1.sum() or not t0.sum():
        return Fitted(np.empty(0, U64), empty, empty, [empty] * FOLDS)
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda x, n: x + n)
    all1, all0 = total("n1"), total("n0")
    marks = [_marks(all1, all0, int(t1.sum()), int(t0.sum()))]
    marks += [_marks(all1 - F.col("n1")[k], all0 - F.col("n0")[k], int(t1.sum() - t1[k]), int(t0.sum() - t0[k])) for k in range(FOLDS)]
    # One bit for being a word and one for each way of marking; the counts stay in the tasks.
    bits = F.col("whole").cast("int")
    for k, m in enumerate(marks, 1):
        bits = bits + F.when(m, 1 << k).otherwise(0)
    found = _class_counts(sample).select("feature", bits.alias("bits")).where("bits > 0").toArrow()  # the different words of ``sample`` rows
    feature, of = found.column("feature").to_numpy().view(U64), found.column("bits").to_numpy()
    order = np.argsort(feature)
    feature, of = feature[order], of[order]
    has = [of >> k & 1 == 1 for k in range(FOLDS + 2)]
    return Fitted(feature, has[0], has[1], has[2:])


def _marks(n1: Column, n0: Column, t1: int, t0: int) -> Column:
    """Which features lie beyond chance in the toxic class, from their counts and the sizes of the classes."""
    if not t1 or not t0:
        return F.lit(False)
    p1, p0 = n1 / F.lit(float(t1)), (n0 + 0.5) / F.lit(float(t0 + 1))
    pooled = (n1 + n0 + 0.5) / F.lit(float(t1 + t0))
    z = (p1 - p0) / F.sqrt(pooled * (1 - F.least(pooled, F.lit(0.999))) * F.lit(1 / t1 + 1 / t0))
    return (n1 >= LEAST_TEXTS) & (z >= LEAST_Z) & (p1 >= LEAST_RATIO * p0)


class Vocabulary:
    """Looks the features of a text up."""

    def __init__(self, known: np.ndarray):
        self.known = known
        self.bits = np.zeros(1 << 24, bool)
        self.bits[(known >> U64(40)).astype(np.int64)] = True

    def count(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Places of the text's features in the vocabulary, rising, and how often they occur."""
        f = np.concatenate(features(text))
        f = f[self.bits[(f >> U64(40)).astype(np.int64)]]
        if not len(f):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        f, n = np.unique(f, return_counts=True)
        at = np.minimum(np.searchsorted(self.known, f), len(self.known) - 1)
        real = self.known[at] == f
        return at[real], n[real]


def vectors(docs: DataFrame, shared, extra: list[str]) -> DataFrame:
    """(doc_id, idx, tf, *extra): the vocabulary features of every whole text with their counts."""
    kinds = dict(docs.dtypes)

    def batches(it):
        vocabulary = Vocabulary(shared.value)
        for batch in it:
            idx, tf = zip(*(vocabulary.count(text.as_py()) for text in batch.column("text"))) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()), pa.array([i.astype(np.int32) for i in idx], pa.list_(pa.int32())),
                    pa.array([t.astype(np.int32) for t in tf], pa.list_(pa.int32())), *(batch.column(c) for c in extra),
                ],
                ["doc_id", "idx", "tf", *extra],
            )

    schema = ", ".join(["doc_id long", "idx array<int>", "tf array<int>", *(f"{c} {kinds[c]}" for c in extra)])
    return docs.select("doc_id", "text", *extra).mapInArrow(batches, schema)


def document_frequencies(counted: DataFrame, size: int) -> np.ndarray:
    """In how many of the rows of (idx, ...) each vocabulary feature occurs; tasks add up before they send."""

    def batches(it):
        seen = np.zeros(size, np.int64)
        for batch in it:
            seen += np.bincount(pc.list_flatten(batch.column("idx")).to_numpy(), minlength=size)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], ["i", "n"])

    out = np.zeros(size, np.int64)
    if size:
        found = counted.select("idx").mapInArrow(batches, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()  # one row for each feature
        out[found.column("i").to_numpy()] = found.column("n").to_numpy()
    return out


def lists_of(batch: pa.RecordBatch, place: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """(idx, tf) of each row; with ``place`` features move there, and go where it is below 0."""
    idx, tf = (batch.column(c) for c in ("idx", "tf"))
    ends = idx.offsets.to_numpy()
    i, t = (pc.list_flatten(c).to_numpy().astype(np.int64) for c in (idx, tf))
    rows = [(i[a - ends[0] : b - ends[0]], t[a - ends[0] : b - ends[0]]) for a, b in zip(ends, ends[1:])]
    if place is None:
        return rows
    return [(place[i][place[i] >= 0], t[place[i] >= 0]) for i, t in rows]


class BlockMaxIndex:
    """Postings of unit vectors by feature, with the largest weight for each block of examples."""

    def __init__(self, rows: list[tuple[list[int], list[int]]], labels: list[int], idf: np.ndarray, ids: list[int] | None = None):
        sizes = np.array([len(i) for i, _ in rows], np.int64)
        flat = lambda k, kind: np.concatenate([np.empty(0, kind), *(np.asarray(r[k], kind) for r in rows)])
        self._build(sizes, flat(0, np.int32), flat(1, np.int64), np.asarray(labels), idf, np.arange(len(rows)) if ids is None else np.asarray(ids))

    @classmethod
    def of_arrays(cls, sizes: np.ndarray, idx: np.ndarray, tf: np.ndarray, labels: np.ndarray, idf: np.ndarray, ids: np.ndarray) -> BlockMaxIndex:
        """The same from the examples' features one after another."""
        new = cls.__new__(cls)
        new._build(sizes, idx, tf, labels, idf, ids)
        return new

    def _build(self, sizes: np.ndarray, feature: np.ndarray, tf: np.ndarray, labels: np.ndarray, idf: np.ndarray, ids: np.ndarray) -> None:
        """Arrays take the narrowest type that holds them, and go as soon as they are used: each worker of an executor builds its own."""
        self.idf = idf
        full = np.flatnonzero(sizes)
        empty = labels[sizes == 0]
        self.labels, self.ids = labels[full].astype(float), ids[full].astype(np.int64)
        self.prior = (float(empty.sum()) + 1.0) / (len(empty) + 20.0)
        sizes = sizes[full]
        n = len(full)
        narrow = np.min_scalar_type(max(1, n))
        weight = np.log(tf, dtype=float)
        weight += 1
        weight *= idf[feature]
        if n:
            starts = np.cumsum(sizes) - sizes
            norms = np.sqrt(np.add.reduceat(weight * weight, starts))
            weight /= np.repeat(norms, sizes)
        # Examples rise already, so a stable order by feature orders both.
        order = np.argsort(feature, kind="stable").astype(np.int32)
        feature = feature[order]
        self.weight = weight[order]
        del weight
        self.example = np.repeat(np.arange(n, dtype=narrow), sizes)[order]
        del order
        self.blocks = max(1, -(-n // BLOCK))
        self.at = np.searchsorted(feature, np.arange(len(idf) + 1))
        block = self.example // np.array(BLOCK, narrow)
        # Cells are the stretches of one feature and one block.
        edge = np.ones(len(block), bool)
        edge[1:] = (feature[1:] != feature[:-1]) | (block[1:] != block[:-1])
        first = np.flatnonzero(edge)
        del edge
        self.cell_block, cell_feature = block[first], feature[first]
        del block, feature
        self.peak = np.maximum.reduceat(self.weight, first) if len(first) else np.empty(0)
        # Rounded up, so that a bound stays one.
        self.peak = np.nextafter(self.peak.astype(np.float32), np.float32(np.inf))
        self.first = np.empty(len(first) + 1, np.int32)
        self.first[:-1], self.first[-1] = first, len(self.weight)
        del first
        self.of_feature = np.searchsorted(cell_feature, np.arange(len(idf) + 1))
        # The commonest features as full rows over the examples.
        common = np.argsort(-np.diff(self.at), kind="stable")[:FULL]
        self.row = np.full(len(idf), -1, np.int32)
        self.row[common] = np.arange(len(common))
        self.full = np.zeros((len(common), n))
        for k, f in enumerate(common):
            here = slice(self.at[f], self.at[f + 1])
            self.full[k, self.example[here]] = self.weight[here]

    def weigh(self, idx: np.ndarray, tf: np.ndarray) -> np.ndarray:
        w = (1 + np.log(tf)) * self.idf[idx]
        return w / math.sqrt((w * w).sum()) if len(w) else w

    def search(self, idx: np.ndarray, tf: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray, int]:
        """The k nearest examples with their cosines, exactly, and how many blocks were read."""
        q = self.weigh(idx, tf)
        lo, hi = self.of_feature[idx], self.of_feature[idx + 1]
        at = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi)]) if len(idx) else np.empty(0, np.int64)
        w = np.repeat(q, hi - lo)
        bound = np.bincount(self.cell_block[at], w * self.peak[at], minlength=self.blocks)
        by_block = np.argsort(self.cell_block[at], kind="stable")
        at, w = at[by_block], w[by_block]
        starts = np.searchsorted(self.cell_block[at], np.arange(self.blocks + 1))
        who, cos, kth, read = np.empty(0, np.int64), np.empty(0), 0.0, 0
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or (len(cos) >= k and bound[b] < kth - 1e-12):
                break
            read += 1
            score = np.zeros(BLOCK)
            for c, x in zip(at[starts[b] : starts[b + 1]], w[starts[b] : starts[b + 1]]):
                s, e = self.first[c], self.first[c + 1]
                score[self.example[s:e].astype(np.int64) - b * BLOCK] += x * self.weight[s:e]
            hit = np.flatnonzero(score)
            who, cos = np.append(who, hit + b * BLOCK), np.append(cos, score[hit])
            if len(cos) > k:
                # By cosine rounded to 12 digits, then by example number, so that ties fall the same way always.
                best = np.lexsort((who, -np.round(cos, 12)))[:k]
                who, cos = who[best], cos[best]
            if len(cos) >= k:
                kth = cos.min()
        return who, cos, read

    def cosines(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The cosines of several queries to all examples."""
        rows = np.zeros((len(queries), len(self.full)))
        units = [self.weigh(idx, tf) for idx, tf in queries]
        for k, ((idx, _), q) in enumerate(zip(queries, units)):
            common = self.row[idx] >= 0
            rows[k, self.row[idx[common]]] = q[common]
        out = rows @ self.full
        for k, ((idx, _), q) in enumerate(zip(queries, units)):
            rare = self.row[idx] < 0
            lo, n = self.at[idx[rare]], self.at[idx[rare] + 1] - self.at[idx[rare]]
            at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
            out[k] += np.bincount(self.example[at], self.weight[at] * np.repeat(q[rare], n), minlength=out.shape[1])
        return out

    def _vote(self, who: np.ndarray, cos: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        # Rounded and ordered, so that the way the cosines were added up does not show.
        cos = np.round(cos, 12)
        order = np.argsort(who)
        votes = cos[order] ** 2
        score = float((votes @ self.labels[who[order]] + PRIOR_VOTES * self.prior) / (votes.sum() + PRIOR_VOTES))
        near = np.lexsort((who, -cos))
        return score, who[near], cos[near]

    def scores(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS, others: bool = False) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """For each query the share of toxic votes in 0..1, and the neighbours that voted, nearest first, with their cosines.

        Examples of the same cosine count in the order of their numbers.  With
        ``others``, examples equal to the query do not vote.
        """
        none = np.empty(0, np.int64), np.empty(0)
        out: list[tuple[float, np.ndarray, np.ndarray]] = [(self.prior, *none)] * len(queries)
        long = []
        for n, (idx, tf) in enumerate(queries):
            if not len(idx) or not len(self.labels):
                continue
            if not others and (self.of_feature[idx + 1] - self.of_feature[idx]).sum() < SHORT:
                out[n] = self._vote(*self.search(idx, tf, k)[:2])
            else:
                long.append(n)
        for lo in range(0, len(long), TOGETHER):
            part = long[lo : lo + TOGETHER]
            for n, cos in zip(part, self.cosines([queries[n] for n in part])):
                cos = np.round(cos, 12)
                if others:
                    cos[cos > EQUAL] = 0.0
                kth = np.partition(cos, -k)[-k] if len(cos) > k else 0.0
                who = np.flatnonzero((cos >= kth) & (cos > 0))
                who = who[np.lexsort((who, -cos[who]))[:k]]
                out[n] = self._vote(who, cos[who])
        return out


def isotonic(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising function from votes to the share of label 1 that fits best by squares.

    Blocks come from pooling neighbours that fall; a block's share is drawn
    towards one half by one case, so that no probability is 0 or 1.
    """
    at, of = np.unique(votes, return_inverse=True)
    n = np.bincount(of).astype(float)
    hit = np.bincount(of, labels)
    blocks: list[list[float]] = []  # size, hits, sum of votes
    for size, hits, x in zip(n, hit, at):
        blocks.append([size, hits, size * x])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    b = np.array(blocks).reshape(-1, 3)
    return b[:, 2] / b[:, 0], np.maximum.accumulate((b[:, 1] + 0.5) / (b[:, 0] + 1.0))


class Examples:
    """The sample's vectors; each worker makes the index of them, which is several times larger."""

    def __init__(self, rows: pa.Table, idf: np.ndarray):
        self.idf, self.labels, self.ids = idf, rows.column("toxic").to_pylist(), rows.column("doc_id").to_pylist()
        self.size = pc.list_value_length(rows.column("idx")).to_numpy()
        self.idx, tf = (pc.list_flatten(rows.column(c)).to_numpy() for c in ("idx", "tf"))
        self.tf = tf.astype(np.min_scalar_type(tf.max(initial=0)))

    @cached_property
    def index(self) -> BlockMaxIndex:
        idx, tf = self.idx, self.tf
        self.idx = self.tf = None  # the worker's copy, which the index takes the place of
        return BlockMaxIndex.of_arrays(self.size, idx, tf, np.array(self.labels), self.idf, np.array(self.ids))


def best_weight(texts: DataFrame, shared, fitted: Fitted, idf: np.ndarray) -> float:
    """The weight of marking features under which the sample's folds, each scored by the others, have the least log loss.

    ``TUNED`` rows of the sample decide, the smallest id hashes.  Each fold and
    weight is one task over their vectors; the marks are those found in the whole
    sample without the fold.  Without labels of both classes, or where weights
    tie, the least.
    """
    if not len(fitted.known):
        return WEIGHTS[0]
    spark = texts.sparkSession
    some = texts.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TUNED)
    rows = spark.sparkContext.broadcast(vectors(some, shared, ["toxic", "fold"]).toArrow().sort_by("doc_id"))
    everything = spark.sparkContext.broadcast((fitted, idf))

    def votes(it):
        for batch in it:
            for fold, weight in zip(batch.column("fold").to_pylist(), batch.column("weight").to_pylist()):
                mine = pc.equal(rows.value.column("fold"), fold)
                model, base = everything.value
                counted = model.weights(weight, fold) > 0
                place = np.cumsum(counted) - 1

                def kept(r):
                    i, t = (np.asarray(r[c].as_py() or [], np.int64) for c in ("idx", "tf"))
                    return place[i[counted[i]]], t[counted[i]]

                def of(part):
                    return [kept({"idx": i, "tf": t}) for i, t in zip(part.column("idx"), part.column("tf"))]

                train, held = rows.value.filter(pc.invert(mine)), rows.value.filter(mine)
                index = BlockMaxIndex(of(train), train.column("toxic").to_pylist(), (base * model.weights(weight, fold))[counted])
                got = index.scores(of(held))
                toxic = held.column("toxic").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(got), weight)), pa.array([v for v, _, _ in got], pa.float64()), pa.array(toxic.astype(np.int32))], ["weight", "vote", "toxic"]
                )

    tasks = spark.createDataFrame([(k, w) for w in WEIGHTS for k in range(FOLDS)], "fold int, weight double").repartition(len(WEIGHTS) * FOLDS)
    found = tasks.mapInArrow(votes, "weight double, vote double, toxic int").toArrow()  # one row for each weight and sample row
    rows.unpersist()
    best = []
    for weight in WEIGHTS:
        part = found.filter(pc.equal(found.column("weight"), weight))
        vote, toxic = np.round(part.column("vote").to_numpy(), 9), part.column("toxic").to_numpy().astype(float)
        if not 0 < toxic.sum() < len(toxic):
            return WEIGHTS[0]
        p = np.interp(vote, *isotonic(vote, toxic))
        best.append((round(float(-(toxic * np.log(p) + (1 - toxic) * np.log(1 - p)).mean()), 6), weight))
    return min(best)[1]


def toxicity_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, sample: int = SAMPLE, evidence: bool = True) -> DataFrame:
    """(doc_id, held_out, score, predicted, neighbours, evidence) of every row of ``docs``.

    ``evidence`` lists the neighbours that voted, nearest first, as (doc_id,
    toxic, cosine); of equally near ones the smaller doc_id comes first.  It is
    empty with ``evidence`` False.

    Labels are learnt from rows outside the fold only, at most ``sample`` of
    them.  Null and empty texts have no feature and get the prior.  Without
    labels of both classes every text gets the prior.  Of several texts with one
    doc_id the sample takes the least, and a doc_id with several labels is toxic
    if one of them says so.  Texts of any length count whole.  Repeated rows give
    repeated results, an empty table an empty one; other columns are ignored.
    """
    spark = docs.sparkSession
    marks = (
        labels.where("toxic is not null and doc_id is not null")
        .where(~held_out("doc_id", folds, fold))
        .groupBy("doc_id")
        .agg(F.max(F.when(F.col("toxic") >= 1, 1).otherwise(0)).alias("toxic"))
    )
    known = docs.select(F.col("doc_id").alias("key")).distinct()
    chosen = (
        marks.join(known, marks["doc_id"] == known["key"], "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    chosen = durable(chosen)  # at most ``sample`` rows of two small columns
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    fold_of = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    texts = durable(texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("*", fold_of))
    fitted = fit_vocabulary(texts)
    shared = spark.sparkContext.broadcast(fitted.known)
    # Every text is read once; its counts are written and serve the frequencies and the scores.
    counted = written(vectors(docs, shared, []))
    seen = document_frequencies(counted, len(fitted.known))
    plain = np.log((1 + counted.count()) / (1 + seen)) + 1
    weight = best_weight(texts, shared, fitted, plain)
    # Beginnings that mark in a fold alone would weigh nothing: they go.
    kept = fitted.word | fitted.marks
    idf = (plain * fitted.weights(weight))[kept]
    shared = spark.sparkContext.broadcast(fitted.known[kept])
    rows = vectors(texts, shared, ["toxic"]).toArrow().sort_by("doc_id")  # at most ``sample`` rows
    examples = spark.sparkContext.broadcast(Examples(rows, idf))

    def by_the_others(it):
        known = Vocabulary(shared.value)
        for batch in it:
            got = examples.value.index.scores([known.count(t.as_py()) for t in batch.column("text")], others=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v for v, _, _ in got], pa.float64()), pa.array([len(w) for _, w, _ in got], pa.int32()), batch.column("toxic").cast(pa.int32())], ["vote", "n", "toxic"]
            )

    held = texts.select("text", "toxic").mapInArrow(by_the_others, "vote double, n int, toxic int").where("n > 0").toArrow()  # at most ``sample`` rows
    labels_ = held.column("toxic").to_numpy()
    both = 0 < labels_.sum() < len(labels_)
    knots = isotonic(np.round(held.column("vote").to_numpy(), 9), labels_.astype(float)) if both else None

    place = spark.sparkContext.broadcast(np.where(kept, np.cumsum(kept) - 1, -1).astype(np.int32))

    def batches(it):
        for batch in it:
            got = []
            index = examples.value.index
            for lo in range(0, batch.num_rows, 8 * TOGETHER):
                got += index.scores(lists_of(batch.slice(lo, 8 * TOGETHER), place.value))
            n = np.array([len(w) for _, w, _ in got], np.int32)
            vote = np.array([v for v, _, _ in got], float)
            score = np.where(n > 0, np.interp(vote, *knots), vote) if knots is not None else vote
            shown = got if evidence else []
            who = np.concatenate([np.empty(0, np.int64), *(w for _, w, _ in shown)])
            listed = pa.StructArray.from_arrays(
                [pa.array(index.ids[who]), pa.array(index.labels[who].astype(np.int32)), pa.array(np.concatenate([np.empty(0), *(c for _, _, c in shown)]))], ["doc_id", "toxic", "cosine"]
            )
            ends = pa.array(np.concatenate([[0], np.cumsum(n if evidence else 0 * n)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(score, pa.float64()), pa.array(n), pa.ListArray.from_arrays(ends, listed)], ["doc_id", "score", "neighbours", "evidence"]
            )

    schema = "doc_id long, score double, neighbours int, evidence array<struct<doc_id: long, toxic: int, cosine: double>>"
    return counted.mapInArrow(batches, schema).select(
        "doc_id",
        F.coalesce(held_out("doc_id", folds, fold), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "neighbours",
        "evidence",
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic.

    Where one of several texts of a doc_id is, all its rows go; rows with a null
    doc_id share their fate likewise.  Null, empty and very long texts are scored
    like others; repeated rows go or stay together, an empty table stays empty.
    """
    bad = toxicity_scores(docs, table(spark, sf_dir, "labels"), evidence=False).where("predicted = 1")
    bad = bad.select(F.col("doc_id").alias("bad_id")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]), "left_anti")
