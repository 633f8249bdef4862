"""Counts of tokens by batches of texts, so that what is shuffled is counted already.

Batches come as Arrow lists; tokens become numbers of a batch's own dictionary, and
numpy counts them.  Spark adds up what the batches give.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tokens that are counted together, about; single words in shorter stretches, whose dictionaries stay in the processor's cache.
STEP, WORD_STEP = 1 << 21, 1 << 19
#: Logarithms are added up as whole numbers of 2**-50 in two parts, so sums do not depend on an order.
PART, UNIT = 1 << 25, 1 << 50


def split(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """How many words each text has, and all of them one after another, split where ``functions.tokens`` splits; a null text has none."""
    texts = pc.ascii_trim_whitespace(texts)
    lists = pc.ascii_split_whitespace(texts)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    blank = pc.fill_null(pc.equal(texts, ""), False).to_numpy(zero_copy_only=False)
    sizes[blank] = 0
    words = lists.flatten()
    return sizes, words.filter(pc.not_equal(words, "")) if blank.any() else words


def steps(batch: pa.RecordBatch, ids: str, step: int = STEP) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, pa.Array]]:
    """(rows, document of each token, its code, dictionary) for stretches of about ``step`` tokens.

    ``ids`` holds lists of tokens, or texts, which are split into words here.
    """
    column = batch.column(ids)
    texts = pa.types.is_string(column.type) or pa.types.is_large_string(column.type)
    length = pc.divide(pc.binary_length(column), 6) if texts else pc.list_value_length(column)  # a word has about six bytes
    sizes = pc.fill_null(length, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto = np.cumsum(sizes)
    low = 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + step, "right")))
        part = batch.slice(low, high - low)
        n, tokens = split(part.column(ids)) if texts else (sizes[low:high], part.column(ids).flatten())
        encoded = tokens.dictionary_encode(null_encoding="encode")
        yield part, np.repeat(np.arange(high - low), n), encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary
        low = high


def word_counts_by(rows: DataFrame, by: str, ids: str) -> DataFrame:
    """(by, tok, c): how often each token occurs in the texts of each of the few values of ``by``, null among them."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for part, doc, codes, words in steps(batch, "ids"):
                groups = part.column("by").dictionary_encode(null_encoding="encode")
                group = groups.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                pairs, n = np.unique(group[doc] * max(1, len(words)) + codes, return_counts=True)
                of, tok = np.divmod(pairs, max(1, len(words)))
                yield pa.RecordBatch.from_arrays([groups.dictionary.take(pa.array(of)).cast(pa.string()), words.take(pa.array(tok)).cast(pa.string()), pa.array(n)], ["by", "tok", "n"])

    counted = rows.select(F.col(by).cast("string").alias("by"), F.col(ids).alias("ids")).mapInArrow(batches, "by string, tok string, n long")
    return counted.groupBy(F.col("by").alias(by), "tok").agg(F.sum("n").alias("c"))


#: Bytes of words that a task holds while it counts.
HELD = 1 << 26


def held_counts(parts: Iterator[tuple[pa.Array, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """(tok, n) of a task's stretches of text, given as words and their counts: added up, so that a task lists a word once as long as its words fit into HELD."""
    held, size = [], 0
    for words, n in parts:
        held.append(pa.table({"tok": words.cast(pa.string()), "n": pa.array(n, pa.int64())}))
        size += held[-1].nbytes
        if size > HELD:
            held = [added(held)]
            size = held[0].nbytes
            if size > HELD // 2:
                yield from held[0].to_batches(1 << 17)
                held, size = [], 0
    if held:
        yield from added(held).to_batches(1 << 17)


def added(tables: list[pa.Table]) -> pa.Table:
    """Sums of n by tok, null among them."""
    out = pa.concat_tables(tables).group_by("tok", use_threads=False).aggregate([("n", "sum")])
    return pa.table({"tok": out.column("tok"), "n": out.column("n_sum")})


def word_counts(rows: DataFrame, ids: str) -> DataFrame:
    """(tok, c): how often each token occurs."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from held_counts((words, np.bincount(codes, minlength=len(words))) for batch in it for _, _, codes, words in steps(batch, "ids", WORD_STEP))

    return rows.select(F.col(ids).alias("ids")).mapInArrow(batches, "tok string, n long").groupBy("tok").agg(F.sum("n").alias("c"))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing step."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def different(doc: np.ndarray, codes: np.ndarray, n: int, width: int) -> np.ndarray:
    """How many different runs of ``width`` tokens each of ``n`` documents has; by 64-bit hashes."""
    if len(codes) < width:
        return np.zeros(n, np.int64)
    last = len(codes) - width + 1
    inside = doc[:last] == doc[width - 1 :]
    h = mixed(doc[:last].astype(np.uint64) + np.uint64(1))
    for j in range(width):
        h = mixed(h ^ (codes[j : last + j].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
    h, of = h[inside], doc[:last][inside]
    size, ordered = np.bincount(of, minlength=n), np.sort(h)
    copies = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(copies):  # each goes to the one document that has it; a bit map finds most that have none
        again, more = np.unique(copies, return_counts=True)
        low = np.uint64((1 << 22) - 1)
        marked = np.zeros(1 << 22, bool)
        marked[again & low] = True
        at = np.flatnonzero(marked[h & low])
        place = np.minimum(np.searchsorted(again, h[at]), len(again) - 1)
        same = again[place] == h[at]
        owner = np.zeros(len(again), np.int64)
        owner[place[same]] = of[at[same]]
        size -= np.bincount(owner, more, n).astype(np.int64)
    return size


def repetition(doc: np.ndarray, codes: np.ndarray, words: np.ndarray, n: int, width: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unique_r, rep_r, rep_ng4) of ``n`` documents with so many different ``words``, as the column functions of ``functions.tokens`` define them."""
    size = np.bincount(doc, minlength=n)
    same = (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])
    repeats = np.bincount(doc[1:][same], minlength=n)
    grams = size - width + 1
    return (
        words / np.maximum(1, size),
        np.where(size > 1, repeats / np.maximum(1, size - 1), 0.0),
        np.where(grams > 0, 1 - different(doc, codes, n, width) / np.maximum(1, grams), 0.0),
    )


def parts_of(logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms as whole numbers of PART / UNIT and of 1 / UNIT."""
    whole = np.rint(logs * UNIT).astype(np.int64)
    return whole // PART, whole % PART


def summed(terms: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Exact sums by document; ``of`` ascends."""
    out = np.zeros(n, np.int64)
    if len(of):
        starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        out[of[starts]] = np.add.reduceat(terms, starts)
    return out


MEASURES = ("unique_r", "rep_r", "rep_ng4")


class Heads:
    """What is known of documents from their texts alone: (n, high, low), the tokens and the sum of log(c + 1) over those of ``frequent``, (tok, c), in two parts.

    ``measured`` adds measures of repetition and the other columns of the document.
    """

    def __init__(self, rows: DataFrame, key: str, ids: str, frequent: pa.Table | None, measured: bool):
        kinds = dict(rows.dtypes)
        self.key, self.measured = key, measured
        self.others = [c for c in rows.columns if c != ids] if measured else []
        more = ", ".join(f"`{c}`: {kinds[c]}" for c in self.others)
        self.kind = "struct<n: bigint, high: bigint, low: bigint" + (f", {', '.join(f'{m}: double' for m in MEASURES)}, row: struct<{more}>>" if measured else ">")
        self.names = ["n", "high", "low", *(MEASURES + ("row",) if measured else ())]
        self.given = None if frequent is None or not frequent.num_rows else (frequent.column("tok").combine_chunks(), *parts_of(np.log(frequent.column("c").to_numpy().astype(float) + 1)))

    def needed(self, rows: DataFrame, ids: str) -> DataFrame:
        """The columns that ``stretches`` reads."""
        return rows.select(*(self.others or [self.key]), F.col(ids).alias("_ids"))

    def stretches(self, it: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.StructArray, np.ndarray, np.ndarray, np.ndarray, pa.Array]]:
        """(keys, heads, document, word, count, words): the last four list the different tokens of each document that are not frequent; documents ascend."""
        for batch in it:
            for part, doc, codes, words in steps(batch, "_ids", WORD_STEP):
                n, words = part.num_rows, words.cast(pa.string())
                pairs, k = np.unique(doc * max(1, len(words)) + codes, return_counts=True)
                of, tok = np.divmod(pairs, max(1, len(words)))
                high = low = np.zeros(n, np.int64)
                unlike = np.bincount(of, minlength=n)
                if self.given is not None:
                    place = pc.fill_null(pc.index_in(words, value_set=self.given[0]), -1).to_numpy(zero_copy_only=False)[tok]
                    hit = place >= 0
                    high, low = (summed(k[hit] * g[place[hit]], of[hit], n) for g in self.given[1:])
                    of, tok, k = of[~hit], tok[~hit], k[~hit]
                fields = [pa.array(np.bincount(doc, minlength=n)), pa.array(high), pa.array(low)]
                if self.measured:
                    fields += [*(pa.array(r, pa.float64()) for r in repetition(doc, codes, unlike, n)), pa.StructArray.from_arrays([part.column(c) for c in self.others], self.others)]
                yield part.column(self.key), pa.StructArray.from_arrays(fields, self.names), of, tok, k, words


def token_rows(rows: DataFrame, key: str, ids: str, measured: bool = False) -> DataFrame:
    """(key, tok, k, head): a row for each document and each of its different tokens, and one with ``head`` for each document.

    Heads have a ``tok`` that begins with a line feed, so they are dealt over all
    partitions and meet no token.
    """
    heads = Heads(rows, key, ids, None, measured)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, head, of, tok, k, words in heads.stretches(it):
            named = pc.binary_join_element_wise("\n", pc.fill_null(keys.cast(pa.string()), ""), "")
            yield pa.RecordBatch.from_arrays([keys, named.cast(pa.string()), pa.nulls(len(keys), pa.int64()), head], [key, "tok", "k", "head"])
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(of)), words.take(pa.array(tok)), pa.array(k), pa.nulls(len(k), head.type)], [key, "tok", "k", "head"])

    return heads.needed(rows, ids).mapInArrow(batches, f"`{key}` {dict(rows.dtypes)[key]}, tok string, k long, head {heads.kind}")


def buckets_of(words: pa.Array, buckets: int) -> np.ndarray:
    """A bucket for each word, by its hash."""
    return (mixed(hash_array(pc.fill_null(words, "").to_numpy(zero_copy_only=False), categorize=False)) % np.uint64(buckets)).astype(np.int64)


def lists(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    """Lists of these sizes, one after another."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values)


def listed(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray | pa.Array]:
    """The sizes of the lists of a column, a null one being empty, and their values, as numbers where they are such."""
    x = batch.column(column)
    values = x.flatten()
    return pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False).astype(np.int64), values.to_numpy(zero_copy_only=False) if pa.types.is_integer(values.type) else values


def runs(it: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Rows of batches, as long as neighbours have the same value."""
    for batch in it:
        x = batch.column(column).to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(np.r_[True, x[1:] != x[:-1], True]) if len(x) else []
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)


def head_rows(rows: DataFrame, counts: DataFrame, key: str, ids: str, frequent: pa.Table, measured: bool, buckets: int) -> DataFrame:
    """(key, head): a row for each document, whose two parts have the sums of log(c + 1) over all its tokens of ``counts``, (tok, c).

    Tokens of ``frequent`` are looked up at once.  Of each stretch of texts the others are packed by
    buckets of words, where they meet their counts, and come back as sums for the documents of the
    stretch; so what is shuffled are a few rows with long lists.  No bucket means that there are no others.
    """
    heads = Heads(rows, key, ids, frequent, measured)
    kind = f"struct<key: {dict(rows.dtypes)[key]}, head: {heads.kind}>"
    finished = f"`{key}` {dict(rows.dtypes)[key]}, head {heads.kind}"
    n_buckets = max(1, buckets)

    def named(keys: pa.Array, head: pa.StructArray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([keys, head], [key, "head"])

    if not buckets:
        return heads.needed(rows, ids).mapInArrow(lambda it: (named(keys, head) for keys, head, *_ in heads.stretches(it)), finished)

    def pack(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for step, (keys, head, of, tok, k, words) in enumerate(heads.stretches(it), first):
            used = np.unique(tok)
            bucket = buckets_of(words.take(pa.array(used)), n_buckets)
            order = np.argsort(bucket, kind="stable")
            used, bucket = used[order], bucket[order]  # words by their buckets
            here, sizes = np.unique(bucket, return_counts=True)
            place = np.zeros(len(words), np.int64)
            place[used] = np.arange(len(used))
            group = np.zeros(len(words), np.int64)
            group[used] = np.repeat(np.arange(len(here)), sizes)
            order = np.argsort(group[tok].astype(np.int32), kind="stable")  # documents still ascend in each bucket
            of, tok, k = of[order], tok[order], k[order]
            places = place[tok] - (np.cumsum(sizes) - sizes)[group[tok]]
            n = np.bincount(group[tok], minlength=len(here))
            count, m = len(here), pa.StructArray.from_arrays([keys, head], ["key", "head"])
            if count:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(here, pa.int32()), pa.array(np.full(count, step)), lists(words.take(pa.array(used)), sizes), lists(pa.array(of, pa.int32()), n),
                        lists(pa.array(places, pa.int32()), n), lists(pa.array(k, pa.int32()), n), pa.nulls(count, pa.list_(m.type)),
                    ],
                    ["bucket", "step", "words", "doc", "word", "k", "heads"],
                )
            none = [pa.nulls(1, pa.list_(t)) for t in (pa.string(), pa.int32(), pa.int32(), pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array([step % n_buckets], pa.int32()), pa.array([step]), *none, lists(m, np.array([len(m)]))], ["bucket", "step", "words", "doc", "word", "k", "heads"])

    def pack_counts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            bucket = buckets_of(batch.column("tok"), n_buckets)
            order = pa.array(np.argsort(bucket, kind="stable"))
            here, sizes = np.unique(bucket, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(here, pa.int32()), lists(batch.column("tok").take(order), sizes), lists(batch.column("c").take(order), sizes)], ["bucket", "words", "c"])

    def meet(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, known, logs, fresh = None, None, None, []  # words of the bucket at hand, which come before its texts
        for run in runs(it, "bucket"):
            if run.column("bucket")[0].as_py() != at:
                at, fresh, known = run.column("bucket")[0].as_py(), [], None
            counted = pc.is_null(run.column("step"))
            fresh.append(run.filter(counted))
            texts = run.filter(pc.invert(counted))
            if not texts.num_rows:
                continue
            if known is None:
                known = pa.chunked_array([listed(x, "words")[1] for x in fresh], pa.string()).combine_chunks()
                c = np.concatenate([listed(x, "c")[1] for x in fresh]) if len(known) else np.zeros(0)
                logs, fresh = parts_of(np.log(c.astype(float) + 1)), []
            (word_sizes, words), (sizes, doc), (_, word), (_, k) = (listed(texts, x) for x in ("words", "doc", "word", "k"))
            place = pc.fill_null(pc.index_in(words, value_set=known, skip_nulls=True), -1).to_numpy(zero_copy_only=False)
            of = np.repeat(np.arange(texts.num_rows), sizes)
            place = place[word + (np.cumsum(word_sizes) - word_sizes)[of]] if len(word) else np.zeros(0, np.int64)
            hit = place >= 0
            of, doc, k, place = of[hit], doc[hit].astype(np.int64), k[hit].astype(np.int64), place[hit]
            starts = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (of[1:] != of[:-1])]) if len(doc) else np.zeros(0, np.int64)
            sums = [np.add.reduceat(k * g[place], starts) if len(doc) else starts for g in logs]
            n = np.bincount(of[starts], minlength=texts.num_rows)
            yield pa.RecordBatch.from_arrays(
                [texts.column("step"), lists(pa.array(doc[starts], pa.int32()), n), lists(pa.array(sums[0]), n), lists(pa.array(sums[1]), n), texts.column("heads")],
                ["step", "doc", "high", "low", "heads"],
            )

    def finish(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, keys, head, sums = None, None, None, None
        for run in runs(it, "step"):
            if run.column("step")[0].as_py() != at:
                if at is not None:
                    yield named(keys, whole(head, sums))
                at, both = run.column("step")[0].as_py(), listed(run, "heads")[1]  # these come first
                keys, head = both.field("key"), both.field("head")
                sums = [head.field(c).to_numpy(zero_copy_only=False).copy() for c in ("high", "low")]
            doc = listed(run, "doc")[1]
            for total, c in zip(sums, ("high", "low")):
                np.add.at(total, doc, listed(run, c)[1])
        if at is not None:
            yield named(keys, whole(head, sums))

    def whole(head: pa.StructArray, sums: list[np.ndarray]) -> pa.StructArray:
        return pa.StructArray.from_arrays([head.field("n"), *map(pa.array, sums), *(head.field(c) for c in heads.names[3:])], heads.names)

    texts = heads.needed(rows, ids).mapInArrow(pack, f"bucket int, step long, words array<string>, doc array<int>, word array<int>, k array<int>, heads array<{kind}>")
    model = counts.where("tok is not null and c is not null").select("tok", "c").mapInArrow(pack_counts, f"bucket int, words array<string>, c array<{dict(counts.dtypes)['c']}>")
    met = texts.unionByName(model, allowMissingColumns=True).repartition(n_buckets, "bucket").sortWithinPartitions("bucket", F.col("step").asc_nulls_first())
    parts = met.mapInArrow(meet, f"step long, doc array<int>, high array<bigint>, low array<bigint>, heads array<{kind}>")
    return parts.repartition(n_buckets, "step").sortWithinPartitions("step", F.col("heads").isNull()).mapInArrow(finish, finished)


#: Pairs that make up more than 1 / COMMON_PAIRS of a fitted text, at most so many, are looked up in the tasks.
COMMON_PAIRS = 20_000


def pairs_of(doc: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first, second) of all neighbours within a document."""
    inside = doc[1:] == doc[:-1]
    return doc[1:][inside], codes[:-1][inside], codes[1:][inside]


def first_counts(rows: DataFrame, ids: str) -> DataFrame:
    """(a, b, pair, c): how often each word stands before another, with ``pair`` false and ``b`` null; and pairs that are common
    in some stretch of the texts, with ``pair`` true and their counts in such stretches."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for _, doc, codes, words in steps(batch, "ids"):
                words, (_, a, b) = words.cast(pa.string()), pairs_of(doc, codes)
                pairs, n = np.unique(a * max(1, len(words)) + b, return_counts=True)
                often = n * COMMON_PAIRS >= len(a)
                x, y = np.divmod(pairs[often], max(1, len(words)))
                yield pa.RecordBatch.from_arrays(
                    [words, pa.nulls(len(words), pa.string()), pa.array(np.zeros(len(words), bool)), pa.array(np.bincount(a, minlength=len(words)))], ["a", "b", "pair", "n"]
                )
                yield pa.RecordBatch.from_arrays([words.take(pa.array(x)), words.take(pa.array(y)), pa.array(np.ones(len(x), bool)), pa.array(n[often])], ["a", "b", "pair", "n"])

    counted = rows.select(F.col(ids).alias("ids")).mapInArrow(batches, "a string, b string, pair boolean, n long")
    return counted.groupBy("a", "b", "pair").agg(F.sum("n").alias("c"))


class PairPlaces:
    """Finds the places of pairs of words in a short list of pairs."""

    def __init__(self, listed: pa.Table):
        self.words = pc.unique(pa.chunked_array([*listed.column("a").chunks, *listed.column("b").chunks], pa.string()))
        a, b = (pc.index_in(listed.column(c), value_set=self.words).to_numpy().astype(np.int64) for c in ("a", "b"))
        keys = a * len(self.words) + b
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def find(self, words: pa.Array, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of codes of ``words`` its place in the list, -1 where it has none."""
        place = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        x, y = place[a], place[b]
        keys = np.where((x < 0) | (y < 0), -1, x * len(self.words) + y)
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        return np.where(self.keys[at] == keys, self.order[at], -1) if len(self.keys) else np.full(len(keys), -1)


def listed_counts(rows: DataFrame, ids: str, listed: pa.Table) -> np.ndarray:
    """How often each of a short list of pairs occurs in all the texts."""
    places = PairPlaces(listed)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for _, doc, codes, words in steps(batch, "ids"):
                at = places.find(words.cast(pa.string()), *pairs_of(doc, codes)[1:])
                at, n = np.unique(at[at >= 0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n, pa.int64())], ["i", "n"])

    out = np.zeros(listed.num_rows, np.int64)
    if len(out):
        found = rows.select(F.col(ids).alias("ids")).mapInArrow(batches, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()  # at most one row for each
        out[found.column("i").to_numpy()] = found.column("n").to_numpy()
    return out


#: Pairs in one bucket, about.
BUCKET = 1 << 21


def bucketed_pairs(rows: DataFrame, key: str, ids: str, firsts: pa.Table, listed: pa.Table, logs: np.ndarray, buckets: int) -> DataFrame:
    """(bucket, keys, words, doc, a, b, k, n, high, low): a row for each stretch of texts and bucket, and one with ``n`` for each stretch.

    ``doc``, ``a``, ``b`` and ``k`` list the different pairs of each document with their counts:
    ``doc`` is a place in ``keys``, ``a`` and ``b`` are places in ``firsts``, (a, c), or behind these in ``words``.
    Pairs lie in the bucket of their first word, and of both words where the first is one of ``firsts``.
    ``n`` has the pairs of each of ``keys``, ``high`` and ``low`` the sum of the ``logs`` of those that are ``listed``; these lie in no bucket.
    """
    kind = dict(rows.dtypes)[key]
    lists = {"doc": pa.int32(), "a": pa.int32(), "b": pa.int32(), "k": pa.int32(), "n": pa.int64(), "high": pa.int64(), "low": pa.int64()}
    schema = f"bucket int, keys array<{kind}>, words array<string>, doc array<int>, a array<int>, b array<int>, k array<int>, n array<bigint>, high array<bigint>, low array<bigint>"
    places, given, known = PairPlaces(listed), parts_of(logs), firsts.column("a").combine_chunks()

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for part, doc, codes, words in steps(batch, "_ids"):
                n, words, (of, a, b) = part.num_rows, words.cast(pa.string()), pairs_of(doc, codes)
                size = np.bincount(of, minlength=n)
                pairs, code = np.unique(a * max(1, len(words)) + b, return_inverse=True)
                each, k = np.unique(of * max(1, len(pairs)) + code, return_counts=True)
                of, code = np.divmod(each, max(1, len(pairs)))
                a, b = np.divmod(pairs, max(1, len(words)))
                place = places.find(words, a, b)[code]
                hit = place >= 0
                high, low = (summed(k[hit] * g[place[hit]], of[hit], n) for g in given)
                of, code, k = of[~hit], code[~hit], k[~hit]
                a, b = a[code], b[code]
                at = pc.fill_null(pc.index_in(words, value_set=known, skip_nulls=True), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                hashed = hash_array(pc.fill_null(words, "").to_numpy(zero_copy_only=False), categorize=False)
                bucket = (mixed(hashed[a] ^ np.where(at[a] >= 0, mixed(hashed[b] + np.uint64(1)), np.uint64(0))) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1)) if len(order) else np.zeros(1, np.int64)
                keys, out = part.column(key), {c: [] for c in lists}
                mine, own, named = [], [], []
                for low_, high_ in zip(edges, edges[1:]):
                    here = order[low_:high_]
                    docs, d = np.unique(of[here], return_inverse=True)
                    x, y = a[here], b[here]
                    rare = np.unique(np.concatenate([x[at[x] < 0], y[at[y] < 0]]))
                    x, y = (np.where(at[z] >= 0, at[z], len(known) + np.searchsorted(rare, z)) for z in (x, y))
                    for c, v in (("doc", d), ("a", x), ("b", y), ("k", k[here]), ("n", None), ("high", None), ("low", None)):
                        out[c].append(v)
                    mine.append(int(bucket[here[0]]))
                    own.append(docs)
                    named.append(rare)
                for c, v in (("doc", None), ("a", None), ("b", None), ("k", None), ("n", size), ("high", high), ("low", low)):
                    out[c].append(v)
                mine.append(len(doc) % buckets)
                own.append(np.arange(n))
                named.append(np.empty(0, np.int64))

                def listing(values: pa.Array, chosen: list[np.ndarray]) -> pa.ListArray:
                    ends = np.cumsum([0, *map(len, chosen)]).astype(np.int32)
                    return pa.ListArray.from_arrays(pa.array(ends), values.take(pa.array(np.concatenate(chosen))))

                yield pa.RecordBatch.from_arrays(
                    [pa.array(mine, pa.int32()), listing(keys, own), listing(words, named), *(pa.array(out[c], pa.list_(t)) for c, t in lists.items())], ["bucket", "keys", "words", *lists]
                )

    return rows.select(key, F.col(ids).alias("_ids")).mapInArrow(batches, schema)


def bucket_losses(t: pa.Table, firsts: pa.Table, types: int) -> pa.Table:
    """(key, n, high, low): what the rows of a bucket add to the documents; ``fit`` says whether a row is counted, ``scored`` whether it gets losses."""

    def flat(c: str) -> tuple[np.ndarray, pa.Array]:
        column = t.column(c).combine_chunks()
        return pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64), column.flatten()

    def numbers(c: str) -> np.ndarray:
        return flat(c)[1].to_numpy(zero_copy_only=False).astype(np.int64)

    known = firsts.num_rows
    key_sizes, keys = flat("keys")
    word_sizes, words = flat("words")
    sizes, doc = flat("doc")
    words = words.dictionary_encode(null_encoding="encode")
    word = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    null = known + pc.index_in(pa.nulls(1, words.dictionary.type), value_set=words.dictionary).to_numpy(zero_copy_only=False)[0]  # NaN, equal to nothing, without any
    of = np.repeat(np.arange(t.num_rows), sizes)
    doc = doc.to_numpy(zero_copy_only=False) + (np.cumsum(key_sizes) - key_sizes)[of]
    shift = (np.cumsum(word_sizes) - word_sizes)[of] - known

    def whole(c: str) -> np.ndarray:
        x = numbers(c)
        rare = x >= known
        x[rare] = known + word[(x + shift)[rare]]
        return x

    a, b, k = whole("a"), whole("b"), numbers("k")
    width = known + len(words.dictionary)
    f = np.where(t.column("fit").to_numpy(zero_copy_only=False)[of], k, 0)
    pairs, code = np.unique(a * max(1, width) + b, return_inverse=True)
    both = np.bincount(code, f, len(pairs))[code]
    first = np.bincount(a, f, width)
    first[:known] = firsts.column("c").to_numpy()
    none = (a == null) | (b == null)
    logs = np.log(np.where(a == null, 0, first[a]) + float(types)) - np.log(np.where(none, 0, both) + 1)
    asked = t.column("scored").to_numpy(zero_copy_only=False)
    order = np.argsort(doc, kind="stable")
    order = order[asked[of[order]]]
    high, low = (summed((k * g)[order], doc[order], len(keys)) for g in parts_of(logs))
    heads = np.repeat(flat("n")[0] > 0, key_sizes)
    n = np.zeros(len(keys), np.int64)
    n[heads] = numbers("n")
    high[heads], low[heads] = numbers("high"), numbers("low")
    out = pa.table({"key": keys, "n": n, "high": high, "low": low})
    return out.filter(pa.array(np.repeat(asked, key_sizes)))
