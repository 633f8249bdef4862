"""Exact repeats of long byte strings by a sparse, hash-compared suffix sort.

A string of ``least`` bytes that starts at two places holds, at the same offset,
the same anchor: the rightmost of the smallest of its ``gram``-byte hashes.
Only suffixes around anchors (two in ``least - gram + 2`` positions on average)
are looked at, and none that matters is left out.

1. Every whole text emits its anchors: hash of the gram, hash of the context (all
   strings of ``least`` bytes that hold the gram there), row and position.
2. Contexts that occur twice are repeats as a whole; most of what repeats ends here.
3. Other contexts matter only if their gram occurs in another one.  Their offsets
   are cut into slots; what all strings of a slot have in common (its core) is
   hashed twice, and slots meet by their cores.  So a short line in a third of
   all documents does not bring these together, and only margins travel.
4. Slots of one core are sorted as suffixes: a mergesort whose comparisons find
   the common extension by binary search over prefix polynomial hashes.
   Neighbours' extensions to the right and hashes of the extension to the left
   tell which strings occur again; the margins' bytes rule out collisions.
5. Cores with more slots than one task should hold go another way: each string of
   a slot is hashed twice with its core, strings are counted by their hashes, with
   partial counts before the shuffle, and those that occur twice are joined back.
6. Rows collect their repeated stretches, which are cut out of the text; a key filter of
   fixed size spares the other texts the shuffle.

A context counts as equal when its gram's polynomial hash and its xxh3 hash agree:
with 10^13 anchors the chance of any false match is below 2e-13.

A row is known by its doc_id and a hash of its id and text, so only equal rows
are one.
"""

from __future__ import annotations

import re
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, key_filter, may_match, table, written
from .hashing import U64, mix, powers, prefix_sums

LEAST = 400
#: Offsets in one slot.
SLOT = 32
#: Bytes of a text hashed at a time.
PIECE = 1 << 20
#: Slots sorted in one task, about, and the most of one core that go to one.
BUCKET, HOT = 4000, 50_000


#: What a row is known by.
ROW = ["rid", "sub"]


def gram_of(least: int) -> int:
    return max(1, 3 * least // 8)


def anchors(data: bytes, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the anchors of all strings of ``least`` bytes, and their gram hashes."""
    gram = gram_of(least)
    w, n = least - gram + 1, len(data)
    places, hashes = [], []
    for at in range(0, max(0, n - least + 1), PIECE):
        a = np.frombuffer(data, np.uint8)[at : min(n, at + PIECE + least - 1)]
        sums = prefix_sums(a)
        g = mix((sums[gram:] - sums[:-gram]) * powers(len(a) - gram + 1)[1])
        m, low = len(g), U64((1 << 21) - 1)
        v = (g & ~low) | (low - np.arange(m, dtype=U64))
        full = np.full(-(-m // w) * w, 2**64 - 1, U64)
        full[:m] = v
        rows = full.reshape(-1, w)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        k = m - w + 1
        best = np.minimum(back[:k], ahead[w - 1 : w - 1 + k])
        pos = (low - (best & low)).astype(np.int64)
        pos = pos[np.concatenate([[True], pos[1:] != pos[:-1]])]
        places.append(pos + at)
        hashes.append(g[pos])
    if not places:
        return np.empty(0, np.int64), np.empty(0, U64)
    pos, first = np.unique(np.concatenate(places), return_index=True)
    return pos, np.concatenate(hashes)[first]


def context(pos: int, n: int, least: int) -> tuple[int, int]:
    """The stretch of all strings of ``least`` bytes that hold the gram at ``pos``."""
    return max(0, pos - (least - gram_of(least))), min(n, pos + least)


def occurrences(rows: DataFrame, least: int) -> DataFrame:
    """(gram, ctx, rid, sub, pos) of every anchor of every row."""

    def batches(it):
        for batch in it:
            grams, places, ctx, counts = [np.empty(0, U64)], [np.empty(0, np.int64)], [], []
            for text in batch.column("text"):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                pos, g = anchors(data, least)
                grams.append(g)
                places.append(pos)
                counts.append(len(pos))
                for p in pos.tolist():
                    s, e = context(p, len(data), least)
                    ctx.append(xxhash.xxh3_64_intdigest(data[s:e], p - s))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(grams).view(np.int64)),
                    pa.array(np.array(ctx, U64).view(np.int64)),
                    *(pa.array(np.repeat(batch.column(c).to_numpy(), counts)) for c in ROW),
                    pa.array(np.concatenate(places).astype(np.int32)),
                ],
                ["gram", "ctx", *ROW, "pos"],
            )

    return rows.select(*ROW, "text").mapInArrow(batches, "gram long, ctx long, rid long, sub long, pos int")


def slots_of(data: bytes, pos: int, gram: int, least: int) -> list[tuple[int, int, int, int, bytes, bytes]]:
    """(core hash, second core hash, core's start, span, left margin, right margin) of each slot around an anchor.

    The strings of a slot start 0 to ``span`` bytes before its core and end as
    much less behind it.
    """
    n, out = len(data), []
    widest = least - gram_of(least)
    for lo in range(0, widest + 1, SLOT):
        span = min(SLOT - 1, widest - lo)
        start, end = pos - lo, pos + least - lo - span
        if start < 0 or end > n:
            continue
        left, right = data[max(0, start - span) : start], data[end : end + span]
        if len(left) + len(right) < span:
            continue
        core, seed = data[start:end], (gram ^ lo) & (2**64 - 1)
        out.append((xxhash.xxh3_64_intdigest(core, seed), xxhash.xxh64_intdigest(core, seed), start, span, left, right))
    return out


def suffix_sort(sums: np.ndarray, grid: np.ndarray, sizes: np.ndarray, members: np.ndarray) -> tuple[list[int], list[int]]:
    """``members`` in the order of their suffixes, and each one's common extension with the one before.

    All suffixes begin with the same core, so what decides is the ``sizes`` bytes
    behind it in ``grid``, whose prefix hashes are ``sums``: a mergesort, whose
    comparisons take a number of steps logarithmic in the extension.
    """

    def extension(x: int, y: int) -> int:
        lo, hi = 0, min(int(sizes[x]), int(sizes[y]))
        sx, sy = sums[x], sums[y]
        while lo < hi:
            mid = (lo + hi + 1) >> 1
            if sx[mid] == sy[mid]:
                lo = mid
            else:
                hi = mid - 1
        return lo

    def compare(x: int, y: int) -> int:
        k = extension(x, y)
        a = int(grid[x, k]) if k < sizes[x] else -1
        b = int(grid[y, k]) if k < sizes[y] else -1
        return a - b

    order = sorted(members.tolist(), key=cmp_to_key(compare))
    return order, [0, *(extension(x, y) for x, y in zip(order, order[1:]))]


def _grid(parts: list[bytes], back: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte strings as rows (from the end if ``back``), their lengths and prefix hashes."""
    sizes = np.array([len(b) for b in parts], np.int64)
    grid = np.zeros((len(parts), SLOT), np.uint8)
    for k, b in enumerate(parts):
        grid[k, : len(b)] = np.frombuffer(b[::-1] if back else b, np.uint8)
    sums = np.zeros((len(parts), SLOT + 1), U64)
    np.cumsum((grid.astype(U64) + U64(1)) * powers(SLOT)[0], axis=1, out=sums[:, 1:])
    return grid, sizes, sums


def repeated_offsets(core: np.ndarray, second: np.ndarray, span: np.ndarray, left: list[bytes], right: list[bytes]) -> np.ndarray:
    """For each slot and each step t to the left of its core: whether the string from there also
    starts in another slot of the same core.

    Hashes find the pairs and the margins' bytes confirm them; the cores' equality
    rests on two independent 64-bit hashes.
    """
    out = np.zeros((len(core), SLOT), bool)
    at = np.lexsort((second, core))
    fresh = np.concatenate([[True], (core[at][1:] != core[at][:-1]) | (second[at][1:] != second[at][:-1])])
    edges = np.append(np.flatnonzero(fresh), len(at))
    groups = [at[a:b] for a, b in zip(edges, edges[1:]) if b - a > 1]
    if not groups:
        return out
    used = np.concatenate(groups)
    r_grid, r_size, r_sums = _grid([right[k] for k in used], False)
    l_grid, l_size, l_sums = _grid([left[k] for k in used], True)
    order, reach, new = [], [], []
    done = 0
    for g in groups:
        got, ext = suffix_sort(r_sums, r_grid, r_size, np.arange(done, done + len(g)))
        order += got
        reach += ext
        new += [True] + [False] * (len(g) - 1)
        done += len(g)
    order, reach, new, spans = np.array(order), np.array(reach), np.array(new), span[used]
    for t in range(SLOT):
        need = spans[order] - t
        run = np.cumsum(new | (reach < need))
        fits = np.flatnonzero((need >= 0) & (l_size[order] >= t) & (r_size[order] >= need))
        if len(fits) < 2:
            continue
        hashed = l_sums[order, t]
        pick = fits[np.lexsort((hashed[fits], run[fits]))]
        same = (run[pick][1:] == run[pick][:-1]) & (hashed[pick][1:] == hashed[pick][:-1])
        x, y, n = order[pick[1:][same]], order[pick[:-1][same]], need[pick[1:][same]]
        real = (l_grid[x, :t] == l_grid[y, :t]).all(axis=1)
        real &= ((r_grid[x] == r_grid[y]) | (np.arange(SLOT)[None, :] >= n[:, None])).all(axis=1)
        out[used[x[real]], t] = True
        out[used[y[real]], t] = True
    return out


SLOT_SCHEMA = "core long, second long, rid long, sub long, start long, span int, left binary, right binary"


def slot_batch(got: list[tuple]) -> pa.RecordBatch:
    rid, sub, core, second, start, span, left, right = zip(*got) if got else ((),) * 8
    signed = lambda x: pa.array(np.array(x, U64).view(np.int64))
    return pa.RecordBatch.from_arrays(
        [
            signed(core), signed(second), pa.array(rid, pa.int64()), pa.array(sub, pa.int64()), pa.array(start, pa.int64()), pa.array(span, pa.int32()),
            pa.array(left, pa.binary()), pa.array(right, pa.binary()),
        ],
        ["core", "second", *ROW, "start", "span", "left", "right"],
    )


def counted_strings(slots: DataFrame, least: int) -> DataFrame:
    """(rid, sub, start, end) of the strings of the slots that occur in another slot of the same core, by counts of their hashes."""

    def strings(it):
        for batch in it:
            cols = [batch.column(c).to_pylist() for c in ("core", "second", "rid", "sub", "start", "span", "left", "right")]
            out: list[tuple] = []
            for core, second, rid, sub, start, span, left, right in zip(*cols):
                for t in range(max(0, span - len(right)), min(span, len(left)) + 1):
                    margin = left[len(left) - t :] + right[: span - t]
                    seed = (t * 0x9E3779B97F4A7C15) & (2**64 - 1)
                    out.append((xxhash.xxh3_64_intdigest(margin, (core ^ seed) & (2**64 - 1)), xxhash.xxh64_intdigest(margin, (second ^ seed) & (2**64 - 1)), rid, sub, start - t))
            a, b, rid, sub, start = zip(*out) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(a, U64).view(np.int64)), pa.array(np.array(b, U64).view(np.int64)), *(pa.array(x, pa.int64()) for x in (rid, sub, start))], ["a", "b", *ROW, "start"]
            )

    each = slots.mapInArrow(strings, "a long, b long, rid long, sub long, start long")
    twice = durable(each.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").select("a", "b"))
    return each.join(twice, ["a", "b"]).select(*ROW, "start", (F.col("start") + least).alias("end"))


def repeats(rows: DataFrame, least: int) -> DataFrame:
    """(rid, sub, start, end): stretches of bytes covered by strings that also start elsewhere."""
    reach = least - gram_of(least)
    found = written(occurrences(rows, least))
    # Tables of their own, so that a gram with very many anchors is split in the join.
    shared = durable(found.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"))
    found = durable(found.join(shared, "gram"))
    contexts = durable(found.groupBy("gram", "ctx").agg(F.count("*").alias("n"), F.min(F.struct(*ROW, "pos")).alias("at")))
    whole = found.join(contexts.where("n > 1").select("gram", "ctx"), ["gram", "ctx"]).select(
        *ROW, F.greatest(F.col("pos") - reach, F.lit(0)).alias("start"), (F.col("pos") + least).alias("end")
    )
    met = durable(contexts.groupBy("gram").agg(F.count("*").alias("d")).where("d > 1").select("gram"))
    apart = (
        contexts.join(met, "gram")
        .select("gram", "ctx", "at.rid", "at.sub", "at.pos")
        .groupBy(*ROW)
        .agg(F.collect_list(F.struct("gram", "pos")).alias("list"))
    )

    def cut_slots(it):
        for batch in it:
            got: list[tuple] = []
            for rid, sub, text, items in zip(batch.column("rid").to_pylist(), batch.column("sub").to_pylist(), batch.column("text"), batch.column("list").to_pylist()):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                for x in items:
                    got += [(rid, sub, *s) for s in slots_of(data, x["pos"], x["gram"], least)]
                    if len(got) >= 50_000:
                        yield slot_batch(got)
                        got = []
            yield slot_batch(got)

    apart = durable(apart)
    buckets = max(1, -(-(apart.agg(F.sum(F.size("list"))).first()[0] or 0) * (reach // SLOT + 1) // BUCKET))
    few = rows.select(*ROW, "text").where(may_match("sub", key_filter(apart, "sub")))
    # A row that occurs twice comes here twice, but all its contexts are known to repeat.
    slots = written(few.join(apart, ROW).mapInArrow(cut_slots, SLOT_SCHEMA))
    hot = durable(slots.groupBy("core", "second").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("core", "second"))
    crowded = not hot.isEmpty()
    asked = slots.join(hot, ["core", "second"], "left_anti") if crowded else slots
    asked = asked.withColumn("bucket", F.pmod("core", F.lit(buckets)))

    def sort_bucket(t: pa.Table) -> pa.Table:
        hit = repeated_offsets(
            t.column("core").to_numpy(), t.column("second").to_numpy(), t.column("span").to_numpy(), t.column("left").to_pylist(), t.column("right").to_pylist()
        )
        rid, sub, start = (t.column(c).to_numpy() for c in (*ROW, "start"))
        k, step = np.nonzero(hit)
        s = start[k] - step
        # Strings from steps next to each other make one stretch.
        if len(k):
            new = np.concatenate([[True], (k[1:] != k[:-1]) | (step[1:] != step[:-1] + 1)])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(k)) - 1
            k, lo, hi = k[first], s[last], s[first] + least
        else:
            lo = hi = s
        return pa.table({"rid": rid[k], "sub": sub[k], "start": pa.array(lo, pa.int64()), "end": pa.array(hi, pa.int64())})

    parts = asked.groupBy("bucket").applyInArrow(sort_bucket, "rid long, sub long, start long, end long")
    out = whole.select(*ROW, F.col("start").cast("long"), F.col("end").cast("long")).union(parts)
    return out.union(counted_strings(slots.join(hot, ["core", "second"], "left_semi"), least)) if crowded else out


WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def cut(data: bytes, starts: list[int], ends: list[int], words: int = 0) -> tuple[bytes, int, int]:
    """What is left, the bytes removed and the number of maximal stretches, of which only those of at least ``words`` words go."""
    runs: list[list[int]] = []
    for s, e in sorted(zip(starts, ends)):
        e = min(e, len(data))
        if runs and s <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], e)
        else:
            runs.append([s, e])
    if words:
        runs = [(s, e) for s, e in runs if sum(1 for _ in WORD.finditer(data, s, e)) >= words]
    kept, done = [], 0
    for s, e in runs:
        kept.append(data[done:s])
        done = e
    kept.append(data[done:])
    return b"".join(kept), sum(e - s for s, e in runs), len(runs)


def without_repeats(docs: DataFrame, least: int = LEAST, as_text: bool = False, words: int = 0) -> DataFrame:
    """``docs`` with kept, n_bytes, n_removed, n_spans; kept is binary, or else text without the
    bytes of characters that a cut has split.

    Every byte covered by a string of ``least`` bytes that also starts anywhere
    else in the table goes, in all places, judged on the input.  Null and
    shorter texts lose nothing; a null text has no bytes.  Texts of any length are
    judged whole, an empty table gives an empty result.  Rows that repeat as a
    whole are places of their own.  With ``words``, maximal stretches of fewer
    words stay.  Columns of ``docs`` other than these four are kept.
    """
    own = ["kept", "n_bytes", "n_removed", "n_spans"]
    rows = docs.drop(*own).withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(0))).withColumn("__row", F.xxhash64("doc_id", "text"))
    spans = repeats(rows.select(F.col("__id").alias("rid"), F.col("__row").alias("sub"), "text"), least)
    spans = durable(spans.groupBy(F.col("rid").alias("__id"), F.col("sub").alias("__row")).agg(F.collect_list("start").alias("__starts"), F.collect_list("end").alias("__ends")))
    touched = key_filter(spans, "__row")
    both = rows.where(may_match("__row", touched)).join(spans, ["__id", "__row"], "left").drop("__id", "__row")
    names = [c for c in both.columns if c not in ("__starts", "__ends")]
    kinds = {f.name: f.dataType.simpleString() for f in both.schema.fields}
    text = F.coalesce("text", F.lit(""))
    untouched = rows.where(~may_match("__row", touched)).select(
        *names, (text if as_text else text.cast("binary")).alias("kept"),
        F.octet_length(text).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
    )

    def batches(it):
        for batch in it:
            got = [
                cut((t.as_py() or "").encode("utf-8", "surrogatepass"), s or [], e or [], words)
                for t, s, e in zip(batch.column("text"), batch.column("__starts").to_pylist(), batch.column("__ends").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in names),
                    pa.array([k.decode("utf-8", "ignore") for k, _, _ in got], pa.string()) if as_text else pa.array([k for k, _, _ in got], pa.binary()),
                    pa.array([len(k) + r for k, r, _ in got], pa.int64()),
                    pa.array([r for _, r, _ in got], pa.int64()),
                    pa.array([s for _, _, s in got], pa.int64()),
                ],
                [*names, "kept", "n_bytes", "n_removed", "n_spans"],
            )

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in names), f"kept {'string' if as_text else 'binary'}, n_bytes long, n_removed long, n_spans long"])
    return both.mapInArrow(batches, schema).unionByName(untouched)


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: The stage takes repeated passages of more than 50 words; of all 51 words in a row hardly any have fewer bytes.
STAGE_LEAST, STAGE_WORDS = 140, 51


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated passages of over 50 words; those of which nothing is left go.

    Judged on the stage's input as a whole; null, empty and short texts stay as
    they are, repeated rows lose all they repeat, an empty table stays empty.
    """
    out = without_repeats(docs, STAGE_LEAST, as_text=True, words=STAGE_WORDS)
    touched = F.col("n_removed") > 0
    return (
        out.withColumn("text", F.when(touched, F.col("kept")).otherwise(F.col("text")))
        .withColumn("n_chars", F.when(touched, F.length("kept").cast("long")).otherwise(F.col("n_chars")))
        .where("n_removed = 0 or kept <> ''")
        .select(docs.columns)
    )
