"""MinHash near-duplicate detection by a signature-coordinate inverted join.

1. Every text becomes its set of distinct word shingles and a signature of
   minimum-hash coordinates.  Texts with equal sets form one class (a star of
   links to its smallest doc_id); only the class goes on.  Classes have numbers
   of their own, since rows of one doc_id may belong to several.
2. Each class is posted under its (coordinate, value) pairs.  A pair above the
   match threshold shares at least ``matches`` of the ``coordinates`` postings,
   so it shares one within the rarest ``coordinates - matches + 1`` of either:
   the prefix.  Postings of one class only come first in that order and are
   never joined; classes with fewer than ``matches`` shared postings are skipped.
3. Classes that meet in a prefix posting are joined into candidate groups
   through the posting's smallest class, never as pairs.  Groups are cut into
   blocks ordered by set size, and each pair of blocks whose sizes can reach the
   similarity is one task: it skips pairs below the match threshold, counts
   exact intersections over an inverted index of the full sets and returns a
   spanning forest of the confirmed links.
4. Connected components over the forests, with ids as nodes, give
   ``component_id``; an id with several texts joins the classes of all of them.

Chance of missing one link at exactly the threshold: a binomial tail of
``coordinates`` draws at the similarity below ``matches`` (2.3e-8 for 32, 0.8,
12); pairs above it are safer still.  No posting, group or block is capped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import connected_components, durable, table
from .hashing import minhash, shingle_hashes, word_hashes

COORDINATES, MATCHES, BLOCK = 32, 12, 1024


def set_key(shingles: np.ndarray) -> bytes:
    """A name for a set of shingles; sets of different names differ."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, width: int, coordinates: int = COORDINATES) -> DataFrame:
    """(doc_id, text_hash, n_shingles, set_key, coords): set_key is null for texts without words."""

    def batches(it):
        for batch in it:
            counts, keys, coords = [], [], []
            for text in batch.column("text"):
                s = shingle_hashes(word_hashes(text.as_py()), width)
                counts.append(len(s))
                keys.append(set_key(s) if len(s) else None)
                coords.append(minhash(s, coordinates).astype(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    batch.column("text_hash"),
                    pa.array(counts, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(coords, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "n_shingles", "set_key", "coords"],
            )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        batches, "doc_id long, text_hash long, n_shingles long, set_key binary, coords array<bigint>"
    )


def candidate_groups(classes: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """(class_id, group_id) of the classes that meet another one in a prefix posting."""
    posted = classes.select(
        "class_id", F.posexplode("coords").alias("coord", "value")
    ).select("class_id", F.expr("shiftleft(cast(coord as bigint), 32) | value").alias("posting"))
    shared = posted.groupBy("posting").agg(F.count("*").alias("n")).where("n > 1")
    rare = (
        posted.join(shared, "posting")
        .groupBy("class_id")
        .agg(F.sort_array(F.collect_list(F.struct("n", "posting"))).alias("p"))
        .where(F.size("p") >= matches)
        .select("class_id", F.explode(F.expr(f"slice(p, 1, size(p) - {matches - 1})")).alias("p"))
        .select("class_id", F.col("p.posting").alias("posting"))
    )
    rare = durable(rare)
    lead = rare.groupBy("posting").agg(F.min("class_id").alias("lead"))
    edges = rare.join(lead, "posting").where("lead <> class_id").select(
        F.col("class_id").alias("src"), F.col("lead").alias("dst")
    ).distinct()
    return connected_components(edges).toDF("class_id", "group_id")


def confirm_block(
    ids: np.ndarray, sets: list, coords: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int, matches: int
) -> list[tuple[int, int]]:
    """A spanning forest of the links between members of ``left`` and of ``right``.

    Links have 100 * intersection >= percent * union on the full sets.  Each
    member of ``left`` is compared with all of ``right`` at once over an inverted
    index; members already joined are skipped.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    parent = list(range(len(ids)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    right_at = np.flatnonzero(right)
    keys = np.concatenate([sets[i] for i in right_at]) if len(right_at) else np.empty(0, np.uint64)
    owner = np.repeat(right_at, sizes[right_at])
    order = np.argsort(keys, kind="stable")
    keys, owner = keys[order], owner[order]
    links = []
    for x in np.flatnonzero(left):
        y = right_at[(coords[right_at] == coords[x]).sum(axis=1) >= matches]
        y = y[100 * np.minimum(sizes[y], sizes[x]) >= percent * np.maximum(sizes[y], sizes[x])]
        y = [k for k in y if k != x and root(k) != root(x)]
        if not y:
            continue
        lo, hi = np.searchsorted(keys, sets[x]), np.searchsorted(keys, sets[x], side="right")
        n = hi - lo
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        common = np.bincount(owner[at], minlength=len(ids))
        for k in y:
            i = common[k]
            if 100 * i >= percent * (sizes[k] + sizes[x] - i) and root(k) != root(x):
                parent[root(k)] = root(x)
                links.append((int(ids[x]), int(ids[k])))
    return links


def confirmed_links(docs: DataFrame, groups: DataFrame, width: int, percent: int, matches: int, coordinates: int, block: int) -> DataFrame:
    """(src, dst): links between ids that join the same classes as all confirmed links do.

    ``groups`` has class_id, group_id and what names a row of the class: doc_id,
    text_hash and set_key.  Rows are looked up by id and hash of the text and told
    by the set itself, so an id with several texts gives each class its own.
    """

    def with_sets(it):
        for batch in it:
            sets = [shingle_hashes(word_hashes(t.as_py()), width) for t in batch.column("text")]
            mine = pa.array([set_key(s) == k.as_py() for s, k in zip(sets, batch.column("set_key"))], pa.bool_())
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column("class_id"),
                    batch.column("group_id"),
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["class_id", "group_id", "doc_id", "n", "members"],
            )
            yield out.filter(mine)

    first = F.row_number().over(Window.partitionBy("class_id").orderBy("doc_id"))
    named = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    member = (
        named.join(groups, ["doc_id", "text_hash"])
        .select("class_id", "group_id", "doc_id", "set_key", "text")
        .mapInArrow(with_sets, "class_id long, group_id long, doc_id long, n long, members binary")
        .withColumn("copy", first)  # repeated rows are equal
        .where("copy = 1")
        .drop("copy")
    )
    member = durable(member)

    # Blocks of a group: by size, cut by counting whole size steps, so that only blocks of like size meet.
    step = F.floor(F.log2("n") * 16)
    steps = member.groupBy("group_id", step.alias("step")).agg(F.count("*").alias("k"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    parts = steps.withColumn("cuts", F.ceil(F.col("k") / block).cast("int"))
    cut = parts.select("group_id", "step", "lo", "hi", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut"), "cuts")
    # Small groups are one block as a whole.
    small = steps.groupBy("group_id").agg(F.sum("k").alias("size")).where(F.col("size") <= block).select("group_id", F.lit(True).alias("whole"))
    a, b = cut.alias("a"), cut.alias("b")
    meets = (
        a.join(b, "group_id")
        .where("(a.step, a.cut) <= (b.step, b.cut)")
        .where(f"100 * a.hi >= {percent} * b.lo")
        .join(small, "group_id", "left_anti")
        .select("group_id", F.struct("a.step", "a.cut").alias("x"), F.struct("b.step", "b.cut").alias("y"))
    )
    meets = durable(meets.withColumn("task", F.xxhash64("group_id", "x", "y")))
    to = meets.select("group_id", "task", F.explode(F.array(
        F.struct(F.col("x.step").alias("step"), F.col("x.cut").alias("cut"), F.lit(True).alias("l"), (F.col("x") == F.col("y")).alias("r")),
        F.struct(F.col("y.step").alias("step"), F.col("y.cut").alias("cut"), (F.col("x") == F.col("y")).alias("l"), F.lit(True).alias("r")),
    )).alias("s")).select("group_id", "task", "s.*").distinct()
    sized = member.withColumn("step", step).join(
        parts.select("group_id", "step", "cuts"), ["group_id", "step"]
    ).withColumn("cut", F.pmod(F.xxhash64("class_id"), F.col("cuts")).cast("int"))
    big = sized.join(to, ["group_id", "step", "cut"]).select("task", "class_id", "doc_id", "l", "r", "members")
    one = member.join(small, "group_id").select(
        F.xxhash64("group_id").alias("task"), "class_id", "doc_id", F.lit(True).alias("l"), F.lit(True).alias("r"), "members"
    )

    def confirm(t: pa.Table) -> pa.Table:
        order = np.argsort(t.column("class_id").to_numpy(), kind="stable")
        t = t.take(pa.array(order))
        sets = [np.frombuffer(m.as_py(), np.uint64) for m in t.column("members")]
        coords = np.stack([minhash(s, coordinates) for s in sets])
        links = confirm_block(
            t.column("doc_id").to_numpy(), sets, coords,
            np.array(t.column("l").to_pylist(), bool), np.array(t.column("r").to_pylist(), bool), percent, matches,
        )
        return pa.table({"src": pa.array([x for x, _ in links], pa.int64()), "dst": pa.array([y for _, y in links], pa.int64())})

    return one.unionByName(big).groupBy("task").applyInArrow(confirm, "src long, dst long")


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, coordinates: int = COORDINATES, matches: int = MATCHES, block: int = BLOCK
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``.

    Null and empty texts have no shingle and link with nothing; texts of any
    length are compared on their full sets; of several least ids there is none,
    so groups have no ties.  Other columns
    of ``docs`` are ignored; a doc_id that occurs twice keeps its two rows, which
    count as one document that has the links of both texts (a row without words
    has none), and an empty table gives an empty result.  Rows with a null doc_id
    are left out of every component (component_id null, kept true).
    """
    base = durable(signatures(docs, width, coordinates))
    worded = base.where("set_key is not null and doc_id is not null")
    classes = (
        worded.groupBy("set_key")
        .agg(F.min(F.struct("doc_id", "text_hash", "coords")).alias("low"))
        .select("set_key", "low.*", F.monotonically_increasing_id().alias("class_id"))
    )
    classes = durable(classes)
    groups = durable(candidate_groups(classes, coordinates, matches).join(classes.drop("coords"), "class_id"))
    links = confirmed_links(docs.where("doc_id is not null"), groups, width, percent, matches, coordinates, block)
    several = worded.groupBy("doc_id").agg(F.min("set_key").alias("a"), F.max("set_key").alias("b")).where("a <> b").select("doc_id")
    lead = classes.select("set_key", F.col("doc_id").alias("node"))
    own = worded.join(several, "doc_id").select("doc_id", "set_key").distinct().join(lead, "set_key").select(F.col("doc_id").alias("src"), F.col("node").alias("dst"))
    components = connected_components(links.unionByName(own)).toDF("node", "component")
    of_class = lead.join(components, "node", "left").select("set_key", F.coalesce("component", "node").alias("component"))
    out = base.join(of_class, "set_key", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each group of near-duplicates (five-word shingles).

    Rows with a null doc_id and texts without words stay; rows of one doc_id stay
    or go together, and stay when one of their texts leads its group.  Very long
    texts are compared on their full sets; an empty table stays empty.
    """
    keep = near_duplicates(docs, width=5, percent=80).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(keep, docs["doc_id"].eqNullSafe(keep["kept_id"]), "left_semi")


#: The exact links by shingle join, for small inputs; the query finds the same.
ORACLE = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents
), s as (
  select doc_id, list_distinct(case when len(ws) = 0 then [] when len(ws) < 4 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) end) as ss from w
), n as (select doc_id, len(ss)::bigint as n_shingles, md5(array_to_string(list_sort(ss), chr(10))) as k from s),
c as (select k, min(doc_id) as class_id, any_value(n_shingles) as n from n where n_shingles > 0 group by k),
e as (select distinct class_id, md5_number_lower(x) as x from (select c.class_id, unnest(ss) as x from s join c on s.doc_id = c.class_id)),
f as (select e.class_id, e.x, c.n, row_number() over (partition by e.class_id order by count_x, e.x) as r
  from (select *, count(*) over (partition by x) as count_x from e) e join c using (class_id)),
p as (select * from f where 100 * (r - 1) <= 20 * n),
cand as (select distinct a.class_id as a, b.class_id as b from p a join p b on a.x = b.x and a.class_id < b.class_id
  where 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
links as (select a, b from (select cand.a, cand.b, count(*) as i from cand join e x on x.class_id = cand.a join e y on y.class_id = cand.b and y.x = x.x group by all)
  join c ca on ca.class_id = a join c cb on cb.class_id = b where 100 * i >= 80 * (ca.n + cb.n - i)),
pairs2 as (select a, b from links union all select b, a from links),
reach as (select class_id as a, class_id as b from c union select reach.a, pairs2.b from reach join pairs2 on reach.b = pairs2.a),
comp as (select a as class_id, min(b) as component_id from reach group by a)
select n.doc_id, n.n_shingles, coalesce(comp.component_id, n.doc_id) as component_id, n.doc_id = coalesce(comp.component_id, n.doc_id) as kept
from n left join c on c.k = n.k and n.n_shingles > 0 left join comp using (class_id)
"""
