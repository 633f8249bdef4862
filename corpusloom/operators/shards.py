"""Shards, listings and manifests: what is there, what is wanted, what is wrong with it, and what comes next."""

from __future__ import annotations

import heapq
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import number, seeded
from .folds import fold_blocks
from .packing import running_offset


def chunk_ranges(files: DataFrame, size: str, chunk: int) -> DataFrame:
    """One row for each range of at most ``chunk`` bytes, with begin and end (inclusive); empty files have none."""
    n = F.col(size)
    begins = F.sequence(F.lit(0).cast("long"), n.cast("long") - 1, F.lit(chunk).cast("long"))
    return files.where(n > 0).withColumn("begin", F.explode(begins)).withColumn("end", F.least(F.col("begin") + chunk, n) - 1)


def token_rows(rows: DataFrame, ids: str, length: int) -> DataFrame:
    """Rows of at least ``length`` tokens, cut to that; shorter ones are dropped."""
    return rows.where(F.size(ids) >= length).withColumn(ids, F.slice(ids, 1, length))


def window_errors(ids: Column, length: int, vocabulary: int) -> Column:
    """``length``, ``vocabulary`` or null: the first check that a window fails."""
    return F.when(F.size(ids) != length, "length").when(F.array_max(ids) >= vocabulary, "vocabulary")


def window_count(ids: Column, length: int) -> Column:
    """How many whole windows a flat array holds."""
    return F.floor(F.size(ids) / length)


def window_slice(ids: Column, window: Column, length: int) -> Column:
    return F.slice(ids, (window * length + 1).cast("int"), F.lit(length))


def resolved(key: Column, folder: Column) -> Column:
    """A shard's key below the manifest's folder; an absolute one stays."""
    return F.when(F.startswith(key, F.lit("/")), key).otherwise(F.concat(F.regexp_replace(folder, "/+$", ""), F.lit("/"), key))


def selected_keys(entries: DataFrame, group: str, field: str, order: str, key: str, start: int, count: int) -> DataFrame:
    """(group, key, ord) of the shards to fetch: the slice of the train list, or without one of the eval list and the slice of all.

    ``field`` is train_shards, eval_shards or shards.  Keys count once, where
    they come first; a train list with a key ends the search.
    """
    rank = F.when(F.col(field) == "train_shards", 0).when(F.col(field) == "eval_shards", 1).otherwise(2)
    place = F.row_number().over(Window.partitionBy(group, field).orderBy(order, key)) - 1
    rows = entries.select(group, field, F.trim(key).alias(key), order, rank.alias("_rank"), place.alias("_place"))
    sliced = rows.where((F.col("_rank") == 1) | F.col("_place").between(start, start + count - 1) | (F.lit(count) <= 0)).where(F.col(key) != "")
    first = sliced.groupBy(group, key).agg(F.min(F.struct("_rank", "_place")).alias("_at"))
    trained = F.min("_at._rank").over(Window.partitionBy(group)) == 0
    kept = first.withColumn("_trained", trained).where(~F.col("_trained") | (F.col("_at._rank") == 0))
    return kept.withColumn("ord", F.row_number().over(Window.partitionBy(group).orderBy("_at"))).select(group, key, "ord")


def existing_shards(listing: DataFrame, key: str, size: str, header: int = 128, token_bytes: int = 4) -> DataFrame:
    """Listed shards with their number, read from the key, and about how many tokens they hold; other keys are left out."""
    found = F.regexp_extract(key, r"shard_(\d+)\.", 1)
    return listing.where(found != "").withColumn("shard", found.cast("int")).withColumn("n_tokens", F.floor((F.col(size) - header) / token_bytes))


def latest_files(listing: DataFrame, group: str, key: str, extension: str, limit: int) -> DataFrame:
    """The first ``limit`` keys of a group that end in the extension, in order."""
    w = Window.partitionBy(group).orderBy(key)
    return listing.where(F.endswith(F.lower(F.col(key)), F.lit(extension))).withColumn("place", F.row_number().over(w)).where(F.col("place") <= limit)


def manifest_report(entries: DataFrame, group: str, length: int) -> DataFrame:
    """One row for each manifest: counts, totals, what is wrong with which shard, and warnings.

    ``entries`` has shard, split, expected rows, and of the file: size (null if
    missing), rows, length, dtype.
    """
    error = (
        F.when(F.col("size").isNull(), "missing").when(F.col("size") < 1024, "unreadable").when(F.col("length") != length, "length")
        .when(F.col("expected").isNotNull() & (F.col("expected") != 0) & (F.col("rows") != F.col("expected")), "rows").when(F.col("dtype") != "uint32", "dtype")
    )
    told = F.when(error.isNotNull(), F.concat_ws(":", "shard", "split", error))
    train, held = F.count_if(F.col("split") == "train"), F.count_if(F.col("split") == "eval")
    out = entries.groupBy(group).agg(
        F.count("*").alias("shards"), train.alias("train_shards"), held.alias("eval_shards"), F.count_if(error.isNull()).alias("ok"), F.count_if(error.isNotNull()).alias("failed"),
        F.sum("expected").alias("total_rows"), (F.sum("expected") * length).alias("total_tokens"), F.coalesce(F.sum("size"), F.lit(0)).alias("total_bytes"),
        F.array_join(F.sort_array(F.collect_list(told)), ",").alias("errors"),
        F.concat_ws(",", F.when(train == 0, "no_train_shards"), F.when(held == 0, "no_eval_shards")).alias("warnings"),
    )
    return out.withColumn("passed", F.col("failed") == 0)


def resume_offsets(sources: DataFrame, order: str, size: str, capacity: int, existing: int) -> DataFrame:
    """Adds begin, how much of each source ``existing`` full shards have taken, and the status done, partial or fresh."""
    taken = capacity * existing
    placed = running_offset(sources.where(F.col(size) > 0), order, size)
    begin = F.least(F.greatest(F.lit(taken) - F.col("offset"), F.lit(0)), F.col(size))
    status = F.when(F.col("begin") >= F.col(size), "done").when(F.col("begin") > 0, "partial").otherwise("fresh")
    return placed.withColumn("begin", begin).withColumn("status", status)


def completing(sources: DataFrame, order: str, size: str, length: int, stream: list[str]) -> DataFrame:
    """Adds completes: whether a source's tokens end at least one window of its stream."""
    placed = running_offset(sources.where(F.col(size) > 0), order, size, stream)
    return placed.withColumn("completes", F.floor((F.col("offset") + F.col(size)) / length) > F.floor(F.col("offset") / length))


def mixed_order(windows: DataFrame, window: str, buffer: int, seed: str) -> DataFrame:
    """Adds place: windows in random order within stretches of ``buffer``, as a buffered stream shuffle gives them; none is lost."""
    stretch = F.floor(F.col(window) / buffer)
    w = Window.partitionBy("_stretch").orderBy(seeded(seed, F.col(window)), window)
    return windows.withColumn("_stretch", stretch).withColumn("place", F.col("_stretch") * buffer + F.row_number().over(w) - 1).drop("_stretch")


def first_windows(windows: DataFrame, window: str, wanted: int) -> DataFrame:
    """The first ``wanted`` windows, with underfilled, whether there are fewer."""
    n = windows.agg((F.count("*") < wanted).alias("underfilled"))
    return windows.where(F.col(window) < wanted).crossJoin(F.broadcast(n))  # one row


def balanced(items: DataFrame, size: str, key: str, parts: int, block: int | None = None) -> DataFrame:
    """Adds part: largest first, each to the part with the least so far, the first on ties.

    Each choice rests on the one before, so blocks of items follow one another;
    from block to block only the sums of the parts pass.
    """

    def greedy(t: pa.Table, heap: list[tuple[int, int]]) -> tuple[pa.Table, list[tuple[int, int]]]:
        heap, out = list(heap), []
        heapq.heapify(heap)
        for n in t.column(size).to_pylist():
            total, k = heapq.heappop(heap)
            out.append(k)
            heapq.heappush(heap, (total + n, k))
        return t.append_column("part", pa.array(out, pa.int32())), heap

    kinds = dict(items.dtypes)
    start = [(0, k) for k in range(parts)]
    return fold_blocks(items.select(key, size), [F.desc(size), key], f"{key} {kinds[key]}, {size} {kinds[size]}, part int", start, greedy, block=block)


def uniform_tokens(rows: DataFrame, key: str, length: int, vocabulary: int, seed: str) -> DataFrame:
    """(key, ids): made-up tokens, uniform below ``vocabulary``, the same for the same seed and key."""
    at = F.sequence(F.lit(0), F.lit(length - 1))
    return rows.select(key, F.transform(at, lambda i: F.pmod(number(seeded(seed, F.col(key), i)), F.lit(vocabulary)).cast("int")).alias("ids"))


def not_yet(rows: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are not among the finished ones; null keys equal each other."""
    right = done.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
    same = reduce(lambda a, b: a & b, (rows[k].eqNullSafe(right[f"_{k}"]) for k in keys))
    return rows.join(right, same, "left_anti")


def owners(keys: DataFrame, key: str, lists: DataFrame, names: DataFrame, default: Column) -> DataFrame:
    """Adds owner: the first source (by ord) that lists the key, else the first whose name stands in a key that is a URL, else the default.

    ``lists`` has (key, name, ord); ``names``, (name, ord), is the few sources.
    """
    listed = lists.groupBy(F.col(key).alias("_key")).agg(F.min_by("name", "ord").alias("_listed"))
    known = names.agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "name"))), lambda x: x["name"]).alias("_names"))
    out = keys.join(listed, keys[key] == listed["_key"], "left").crossJoin(F.broadcast(known))  # one row
    named = F.get(F.filter("_names", lambda n: F.startswith(F.col(key), F.lit("http")) & F.col(key).contains(n)), F.lit(0))
    return out.withColumn("owner", F.coalesce("_listed", named, default)).drop("_key", "_listed", "_names")


def mixture_refs(draws: DataFrame, shards: DataFrame, seed: str) -> DataFrame:
    """Each draw, which has ``name``, with a uniform shard of that source's pool and a uniform row of it.

    ``shards`` has (name, shard, k, rows): k from 0 within the pool.
    """
    sizes = shards.groupBy("name").agg(F.count("*").alias("_shards"))
    d = draws.join(F.broadcast(sizes), "name").withColumn("k", F.pmod(number(seeded(f"{seed}:shard", F.col("draw"))), F.col("_shards")).cast("long"))
    d = d.join(shards.select("name", "k", "shard", "rows"), ["name", "k"])
    return d.withColumn("row_idx", F.pmod(number(seeded(f"{seed}:row", F.col("draw"))), F.col("rows")).cast("long")).drop("_shards", "k", "rows")
