"""Prefix trie of rebuilt conversations from composable fingerprints.

A conversation is rebuilt as a head of its base conversation and a suffix of its
own.  Its texts are never put together.  A sequence of turns is an element of a
monoid, (r^n, v) for n turns of value v modulo 2^61 - 1, in two lanes; elements
of neighbouring sequences multiply to the element of both.  With P[k] the value
of a conversation's first k turns, the rebuilt prefix that ends at its own turn
k has the value

    P_own[k] + (P_base[head] - P_own[h]) * r^(k - h)

so one number for each conversation splices all its prefixes.

1. Turns are sorted by conversation and turn over ranges, and each task keeps
   the products inside its stretch of a conversation (a run); runs are joined by
   multiplying few run products, so a conversation of any length is spread.
2. Each rebuilt prefix is a narrow row: value, key and reference of its last turn.
3. Prefixes of one depth and value form a node.  A node stores the reference of
   the turn that ends it; it holds if all its members' last turns have one key,
   and keys hold if all turns stored under one key have one text.  By induction
   over the depth, members then are equal.  If any fails, all is done again with
   another seed; the result never rests on a hash.
4. What a subtree adds up travels along conversations instead of edges: each node
   belongs to its smallest member, which owns a stretch of nodes down to its end,
   so sums over a stretch and one number for each other member give the rest.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

PRIME = (1 << 61) - 1
#: Turns taken from the base are fewer than this, and bases are multiples of GROUP.
HEADS, GROUP = 9, 5
#: Depths in one block of the two-level sums, and ids in one piece of a list to be hashed.
DEPTHS, PIECE = 4096, 1024
#: Characters of a text by which ranges are drawn; inside a range whole texts are compared.
DRAWN = 64
#: Over how many parts the children of one node are spread when they look their parent up.
SALTS = 64
NODE = ["depth", "f1", "f2"]
NO_IDS = hashlib.sha256(b"").hexdigest()

U64 = np.uint64


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo PRIME of values below it."""
    a, b = a.astype(U64), b.astype(U64)
    low = U64((1 << 31) - 1)
    ah, al, bh, bl = a >> U64(31), a & low, b >> U64(31), b & low
    mid = al * bh + ah * bl
    x = ah * bh * U64(2) + (mid >> U64(30)) + ((mid & U64((1 << 30) - 1)) << U64(31)) + al * bl
    return reduced(x)


def reduced(x: np.ndarray) -> np.ndarray:
    x = (x & U64(PRIME)) + (x >> U64(61))
    return np.where(x >= U64(PRIME), x - U64(PRIME), x)


def power(r: int, k: np.ndarray) -> np.ndarray:
    """r ** k modulo PRIME for exponents of 0 or more."""
    k = k.astype(U64)
    out = np.ones(len(k), U64)
    bit = 0
    while len(k) and int(k.max()) >> bit:
        odd = (k >> U64(bit)) & U64(1) == 1
        out[odd] = times(out[odd], np.full(odd.sum(), pow(r, 1 << bit, PRIME), U64))
        bit += 1
    return out


def bases(seed: int) -> tuple[int, int]:
    """The two lanes' bases."""
    digest = hashlib.blake2b(b"base", key=str(seed).encode(), digest_size=16).digest()
    return tuple(2 + int.from_bytes(digest[k : k + 8], "little") % (PRIME - 2) for k in (0, 8))


def turn_key(role: str, text: str, seed: int) -> tuple[int, int]:
    """Two values in [1, PRIME) of a turn."""
    a, b = role.encode(), text.encode()
    digest = hashlib.blake2b(len(a).to_bytes(8, "little") + a + b, key=str(seed).encode(), digest_size=16).digest()
    return tuple(1 + int.from_bytes(digest[k : k + 8], "little") % (PRIME - 1) for k in (0, 8))


def columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


def plain_turns(turns: DataFrame) -> DataFrame:
    return turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )


def run_products(turns: DataFrame, seed: int) -> DataFrame:
    """(conv_id, run, at, k1, k2, n_bytes, v1, v2): each turn with the product of its run up to it.

    A run is a conversation's stretch in one range of the sorted turns; ``at`` counts from 1.
    """
    r1, r2 = bases(seed)

    def scan(it):
        run = TaskContext.get().partitionId()
        conv, at, v1, v2 = None, 0, 0, 0
        for batch in it:
            rows = []
            for c, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                if c != conv:
                    conv, at, v1, v2 = c, 0, 0, 0
                k1, k2 = turn_key(role, text, seed)
                at, v1, v2 = at + 1, (v1 * r1 + k1) % PRIME, (v2 * r2 + k2) % PRIME
                rows.append((c, run, at, k1, k2, len(text.encode()), v1, v2))
            made = np.array(rows, np.int64).reshape(-1, 8)
            names = ["conv_id", "run", "at", "k1", "k2", "n_bytes", "v1", "v2"]
            yield pa.RecordBatch.from_arrays([pa.array(made[:, k]) for k in range(8)], names)

    order = ["conv_id", "turn", "role"]
    ranged = turns.repartitionByRange(*order, F.substring("text", 1, DRAWN)).sortWithinPartitions(*order, "text")
    return ranged.mapInArrow(scan, "conv_id long, run long, at long, k1 long, k2 long, n_bytes long, v1 long, v2 long")


def joined_runs(turns: DataFrame, seed: int) -> DataFrame:
    """(conv_id, run, n, before, b1, b2): turns of a run, and count and product of the runs before it."""
    r = bases(seed)

    def scan(it):
        conv, n, b = None, 0, [0, 0]
        for batch in it:
            rows = []
            for c, run, size, *v in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "run", "n", "v1", "v2"))):
                if c != conv:
                    conv, n, b = c, 0, [0, 0]
                rows.append((c, run, size, n, *b))
                n += size
                b = [(x * pow(y, size, PRIME) + z) % PRIME for x, y, z in zip(b, r, v)]
            made = np.array(rows, np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays([pa.array(made[:, k]) for k in range(6)], ["conv_id", "run", "n", "before", "b1", "b2"])

    runs = turns.groupBy("conv_id", "run").agg(
        F.count("*").alias("n"), F.max_by("v1", "at").alias("v1"), F.max_by("v2", "at").alias("v2")
    )
    return runs.repartition("conv_id").sortWithinPartitions("conv_id", "run").mapInArrow(
        scan, "conv_id long, run long, n long, before long, b1 long, b2 long"
    )


def whole_products(placed: DataFrame, seed: int) -> DataFrame:
    """Adds p1, p2: the product of the conversation up to the turn, from b1, b2 (before the run), at, v1 and v2."""
    r = bases(seed)

    def batches(it):
        for batch in it:
            at, *b = columns(batch, "at", "b1", "b2")
            made = [reduced(times(x, power(y, at)) + v.astype(U64)) for x, y, v in zip(b, r, columns(batch, "v1", "v2"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x.astype(np.int64)) for x in made)], [*batch.schema.names, "p1", "p2"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in placed.schema)
    return placed.mapInArrow(batches, f"{kinds}, p1 long, p2 long")


def fingerprints(prefixes: DataFrame, seed: int) -> DataFrame:
    """Adds f1, f2 of a rebuilt prefix and g1, g2 of the prefix one turn shorter.

    ``d1``, ``d2`` is the conversation's splice and ``over`` the turns behind it; the shorter
    prefix follows from the longer one and the key of its last turn.
    """
    r = bases(seed)
    back = [pow(x, PRIME - 2, PRIME) for x in r]

    def batches(it):
        for batch in it:
            over, *p = columns(batch, "over", "p1", "p2")
            f = [reduced(x.astype(U64) + times(d, power(y, over))) for x, d, y in zip(p, columns(batch, "d1", "d2"), r)]
            keys = columns(batch, "k1", "k2")
            g = [times(reduced(x + U64(PRIME) - k.astype(U64)), np.full(len(x), y, U64)) for x, k, y in zip(f, keys, back)]
            kept = [batch.column(n) for n in ("conv_id", "depth", "k1", "k2", "n_bytes", "at_end", "ref_conv_id", "ref_pos")]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x.astype(np.int64)) for x in (*f, *g))], names)

    names = ["conv_id", "depth", "k1", "k2", "n_bytes", "at_end", "ref_conv_id", "ref_pos", "f1", "f2", "g1", "g2"]
    return prefixes.mapInArrow(batches, ", ".join(f"{n} {'boolean' if n == 'at_end' else 'long'}" for n in names))


def head_turns(conv_id: Column) -> Column:
    """How many turns of the base a conversation would start with."""
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def rebuilt_prefixes(turns: DataFrame, seed: int) -> DataFrame:
    """A row for each rebuilt conversation and depth, from the root at depth 0."""
    turns = written(run_products(turns, seed))
    runs = written(joined_runs(turns, seed))
    early = turns.where(F.col("at") < HEADS).join(runs.where(F.col("before") < HEADS - 1).select("conv_id", "run", "before", "b1", "b2"), ["conv_id", "run"])
    early = early.withColumn("pos", F.col("before") + F.col("at")).where(F.col("pos") < HEADS)
    heads = written(whole_products(early, seed).select("conv_id", "pos", "k1", "k2", "n_bytes", "p1", "p2"))

    convs = runs.groupBy("conv_id").agg(F.sum("n").alias("n")).withColumn("h", head_turns(F.col("conv_id"))).withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
    spliced = convs.join(convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base")), "base", "left")
    spliced = spliced.withColumn("head", F.least("h", F.coalesce("n_base", F.lit(0))))
    of_base = heads.select(F.col("conv_id").alias("base"), F.col("pos").alias("head"), F.col("p1").alias("x1"), F.col("p2").alias("x2"))
    of_own = heads.select("conv_id", F.col("pos").alias("h"), F.col("p1").alias("y1"), F.col("p2").alias("y2"))
    spliced = spliced.join(of_base, ["base", "head"], "left").join(of_own, ["conv_id", "h"], "left")
    zero = F.lit(0).cast("long")
    splice = [F.pmod(F.coalesce(f"x{k}", zero) - F.coalesce(f"y{k}", zero), F.lit(PRIME)).alias(f"d{k}") for k in (1, 2)]
    length = F.col("head") + F.greatest(F.col("n") - F.col("h"), zero)
    spliced = written(spliced.select("conv_id", "base", "h", "head", length.alias("length"), *splice))

    own = turns.join(runs.join(spliced, "conv_id").where("before + n > h").drop("n", "base"), ["conv_id", "run"])
    own = own.withColumn("ref_pos", F.col("before") + F.col("at")).withColumn("over", F.col("ref_pos") - F.col("h")).where("over > 0")
    own = whole_products(own, seed).select(
        "conv_id", (F.col("head") + F.col("over")).alias("depth"), "k1", "k2", "n_bytes", F.col("conv_id").alias("ref_conv_id"), "ref_pos", "over", "p1", "p2", "d1", "d2", "length"
    )
    started = spliced.select("conv_id", F.col("base").alias("ref_conv_id"), "head", "length").join(
        heads.withColumnRenamed("conv_id", "ref_conv_id"), "ref_conv_id"
    ).where("pos <= head")
    started = started.select(
        "conv_id", F.col("pos").alias("depth"), "k1", "k2", "n_bytes", "ref_conv_id", F.col("pos").alias("ref_pos"), zero.alias("over"), "p1", "p2", zero.alias("d1"), zero.alias("d2"), "length"
    )
    prefixes = own.unionByName(started).withColumn("at_end", F.col("depth") == F.col("length"))
    root = spliced.select(
        "conv_id", (F.col("length") == 0).alias("at_end"), *(F.lit(None).cast("long").alias(n) for n in ("k1", "k2", "ref_conv_id", "ref_pos", "g1", "g2")),
        *(zero.alias(n) for n in ("depth", "n_bytes", "f1", "f2")),
    )
    return written(fingerprints(prefixes, seed).unionByName(root))


def keys_differ(turns: DataFrame, seed: int) -> DataFrame:
    """Keys under which turns of different roles or texts are stored."""

    def batches(it):
        for batch in it:
            keys = [turn_key(a, b, seed) for a, b in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())]
            made = np.array(keys, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(made[:, 0]), pa.array(made[:, 1]), batch.column("role"), batch.column("text")], ["k1", "k2", "role", "text"])

    keyed = turns.select("role", "text").mapInArrow(batches, "k1 long, k2 long, role string, text string")
    least = keyed.groupBy("k1", "k2").agg(*(f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("role", "text")))
    return least.where("min_role <> max_role or min_text <> max_text")


def grouped(path: DataFrame) -> DataFrame:
    """A row for each node; ``sound`` tells whether its members end with one turn and share a parent."""
    one = [F.min(c).eqNullSafe(F.max(c)) for c in ("k1", "k2", "g1", "g2", "n_bytes")]
    same = one[0]
    for c in one[1:]:
        same = same & c
    return path.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("n_bytes").alias("n_bytes"), F.min("g1").alias("g1"), F.min("g2").alias("g2"),
        F.min_by("ref_conv_id", "conv_id").alias("ref_conv_id"), F.min_by("ref_pos", "conv_id").alias("ref_pos"), same.alias("sound"),
    )


def hashed_ends(path: DataFrame) -> DataFrame:
    """(depth, f1, f2, ends_sha256) of the nodes at which conversations end.

    Ids are sorted over ranges, which part a crowded node as well; each task joins
    its stretches into pieces of text, and the pieces of a node pass its hash in
    order, one batch at a time.
    """

    def pieces(it):
        node, first, ids = None, None, []
        for batch in it:
            rows = []
            for *key, c in zip(*(batch.column(n).to_pylist() for n in (*NODE, "conv_id"))):
                if key != node or len(ids) == PIECE:
                    if ids:
                        rows.append((*node, first, ",".join(ids)))
                    node, first, ids = key, c, []
                ids.append(str(c))
            yield rows_of(rows)
        if ids:
            yield rows_of([(*node, first, ",".join(ids))])

    def rows_of(rows):
        kinds = [pa.int64()] * 4 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], [*NODE, "first", "ids"])

    def digests(it):
        node, state = None, None
        for batch in it:
            rows = []
            for *key, ids in zip(*(batch.column(n).to_pylist() for n in (*NODE, "ids"))):
                if key != node:
                    if node:
                        rows.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield of_digests(rows)
        if node:
            yield of_digests([(*node, state.hexdigest())])

    def of_digests(rows):
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], [*NODE, "ends_sha256"])

    ends = path.where("at_end").select(*NODE, "conv_id").repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    parts = ends.mapInArrow(pieces, "depth long, f1 long, f2 long, first long, ids string")
    return parts.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digests, "depth long, f1 long, f2 long, ends_sha256 string")


def salt() -> Column:
    return F.pmod(F.xxhash64("f1", "f2"), F.lit(SALTS)).cast("int")


def with_subtrees(nodes: DataFrame, path: DataFrame) -> DataFrame:
    """The nodes with parent_conv_id, n_children, n_leaves and saved_tokens.

    The parent is looked up by its own key and the part its child lies in, so
    that the children of one node are spread.
    """
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("g1").alias("f1"), F.col("g2").alias("f2")).agg(
        F.count("*").alias("n_children"), F.collect_set(salt()).alias("salts")
    )
    grown = written(
        nodes.join(kids, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("n_bytes")).withColumn("block", F.floor(F.col("depth") / DEPTHS))
    )
    # What a node's smallest member owns from it down to its end: inside blocks of depths, and over the blocks below.
    blocks = grown.groupBy("conv_id", "block").agg(
        F.min("depth").alias("top"), F.sum("saved").alias("all_saved"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf")
    )
    below = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    of_block = blocks.select(
        "conv_id", "block", F.coalesce(F.sum("all_saved").over(below), F.lit(0)).alias("below"), F.max("leaf").over(Window.partitionBy("conv_id")).alias("leaf")
    )
    down = Window.partitionBy("conv_id", "block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owned = grown.withColumn("inside", F.sum("saved").over(down)).join(of_block, ["conv_id", "block"])
    # What the other members own, each as a whole: they leave the smallest member's path below the node.
    owner = blocks.groupBy("conv_id").agg(F.min("top").alias("top"), F.sum("all_saved").alias("owned"), F.max("leaf").alias("other_leaf"))
    spread = owner.where("top > 0").withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("top") - 1) / DEPTHS))))
    others = path.select("conv_id", *NODE).withColumn("block", F.floor(F.col("depth") / DEPTHS)).join(spread, ["conv_id", "block"]).where("depth < top")
    others = others.groupBy(*NODE).agg(F.sum("owned").alias("other_saved"), F.sum("other_leaf").alias("other_leaves"))
    parents = grown.where("n_children > 0").select(
        F.col("depth").alias("up"), F.col("f1").alias("g1"), F.col("f2").alias("g2"), F.col("conv_id").alias("parent_conv_id"), F.explode("salts").alias("salt")
    )
    out = owned.withColumn("salt", salt()).withColumn("up", F.col("depth") - 1).join(parents, ["up", "g1", "g2", "salt"], "left")
    return out.join(others, NODE, "left").select(
        *NODE, "conv_id", "parent_conv_id", "n_convs", "n_children", "ref_conv_id", "ref_pos",
        (F.col("leaf") + F.coalesce("other_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("inside") + F.col("below") + F.coalesce("other_saved", F.lit(0))).alias("saved_tokens"),
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, and ref_conv_id with ref_pos, the stored turn (counted from 1) that ends the node.

    Turns are ordered by turn number, null first, then by role and text; a null
    role or text is empty.  Rows without a conv_id belong to no conversation and
    are left out; repeated rows are repeated turns; other columns are ignored.  A
    negative conv_id has the remainder of SQL, with the sign of the id.  Texts of
    any length count by their whole bytes.  An empty table has no node, not even
    the root.
    """
    turns = plain_turns(conversations)
    for seed in itertools.count():
        path = rebuilt_prefixes(turns, seed)
        nodes = written(grouped(path))
        if nodes.where("not sound").isEmpty() and keys_differ(turns, seed).isEmpty():
            break
    out = with_subtrees(nodes, path).join(hashed_ends(path), NODE, "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"), "ref_conv_id", "ref_pos",
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations")).drop("ref_conv_id", "ref_pos")


#: Whole prefixes as lists; a node's subtree is all nodes whose smallest member starts with it.
ORACLE = r"""
with t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos from conversations where conv_id is not null
), crc as (
  select conv_id, conv_id - conv_id % 5 as base, xor(list_reduce(list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint), lambda a, x:
    list_reduce(list_prepend(xor(a, x), range(8)), lambda y, z: case when y % 2 = 1 then xor(y // 2, 3988292384) else y // 2 end), 4294967295::bigint), 4294967295::bigint) % 9 as h
  from (select distinct conv_id from t)
), r as (
  select c.conv_id, t.pos as o, 0 as part, role, text from crc c join t on t.conv_id = c.base and t.pos <= c.h
  union all select c.conv_id, t.pos, 1, role, text from crc c join t on t.conv_id = c.conv_id and t.pos > c.h
), d as (
  select conv_id, row_number() over w as depth, text, list({'r': role, 't': text}) over w as seq from r window w as (partition by conv_id order by part, o)
), p as (
  select conv_id, depth, md5(to_json(seq)) as k, strlen(text) as b, depth = max(depth) over (partition by conv_id) as last from d
  union all select conv_id, 0, '', 0, conv_id not in (select conv_id from d) from crc
), n as (
  select depth, k, min(conv_id) as conv_id, count(*) as n_convs, any_value(b) as b,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (last), '')) as ends_sha256 from p group by all
), e as (
  select n.*, u.k as pk from n left join p u on u.conv_id = n.conv_id and u.depth = n.depth - 1
), c as (select pk as k, count(*) as n_children from e where pk is not null group by 1),
s as (
  select p.k, sum((n.n_convs - 1) * n.b) as saved, count(*) filter (c.k is null) as leaves from n join p on p.conv_id = n.conv_id and p.depth <= n.depth left join c on c.k = n.k group by 1
)
select e.conv_id, e.depth, u.conv_id as parent_conv_id, e.n_convs, coalesce(n_children, 0) as n_children, s.leaves as n_leaves, s.saved::bigint as saved_tokens, e.ends_sha256
from e left join n u on u.k = e.pk and u.depth = e.depth - 1 left join c on c.k = e.k join s on s.k = e.k
"""
