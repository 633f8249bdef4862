"""Exact top-k inner products: vectors by descending length, rotated partial sums, residual bounds.

1. Vectors become integers.  Their Gram matrix over all rows gives the rotation
   (the right singular vectors), after which the first coordinates hold most of
   the length.
2. All vectors are sorted by length over ranges and packed into blocks of rows,
   longest first; the queries are packed likewise.
3. Every query block meets the blocks of the longest vectors first; their k-th
   best score is a threshold under which nothing can enter the answer.
4. A query block meets another block only if the longest vector in it can reach
   the smallest threshold (Cauchy-Schwarz).  There, in pieces of descending
   length, queries that no vector of the piece can reach fall out; for the rest
   partial sums over the first rotated coordinates plus the product of the
   residual lengths bound each score, in steps, and only pairs above the threshold
   are scored, by the exact integer product.  Thresholds rise on the way.
5. The best k of each block, and of these the best k, are the answer.

Rotated sums carry rounding errors, so bounds are widened by a proven margin;
the scores themselves are integers.  A block pair is one task of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

#: Rows of a block of vectors and of queries; a piece of a block is scored at once.
ROWS, QUERIES, PIECE = 8192, 2048, 2048
#: Shares of the rotated coordinates after which a bound is taken.
STEPS = (0.25, 0.5)
#: Above this share of pairs left, a piece is scored as a whole instead of pair by pair.
DENSE = 0.05
#: Sums of products are exact in a double while the lengths' product stays below; margin of rotated sums.
EXACT, MARGIN = 2.0**51, 1e-9
LEAST, MOST = -(2**63), 2**63 - 1


def integer_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """(row, vec_id, v, length): floor(scale * x) of each usable vector, numbered by row."""
    fine = F.forall("embedding", lambda e: F.coalesce(F.abs(e.cast("double")) < float("inf"), F.lit(False)))
    usable = vectors.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))
    v = F.transform("embedding", lambda e: F.floor(e.cast("double") * F.lit(float(scale))))
    whole = usable.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda total, e: total + e.cast("double") * e.cast("double"))
    return whole.withColumn("length", F.sqrt(squares))


def packed(vectors: DataFrame, rows: int) -> DataFrame:
    """Blocks of at most ``rows`` vectors, longest first: (block, longest, n, d, ids, rows, vectors), arrays as bytes."""

    def flat(parts, d):
        made = np.zeros((sum(len(p) for p, _ in parts), d), np.int64)
        at = 0
        for p, _ in parts:
            made[at : at + len(p), : p.shape[1]] = p
            at += len(p)
        return made

    def block(number, parts):
        v = flat(parts, max(p.shape[1] for p, _ in parts))
        ids = np.concatenate([m for _, m in parts])
        longest = float(np.sqrt((v.astype(float) ** 2).sum(axis=1)).max())
        values = [[number], [longest], [len(v)], [v.shape[1]], [ids[:, 1].tobytes()], [ids[:, 0].tobytes()], [v.tobytes()]]
        kinds = [pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(values, kinds)], ["block", "longest", "n", "d", "ids", "rows", "vectors"])

    def matrix(lists):
        sizes = np.diff(lists.offsets.to_numpy())
        values = lists.flatten().to_numpy()
        made = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
        made[np.arange(made.shape[1]) < sizes[:, None]] = values
        return made

    def batches(it):
        number, parts, held = TaskContext.get().partitionId() << 32, [], 0
        for batch in it:
            m = np.stack([batch.column(n).to_numpy() for n in ("row", "vec_id")], axis=1)
            v = matrix(batch.column("v"))
            while len(v):
                take = rows - held
                parts.append((v[:take], m[:take]))
                held += len(parts[-1][0])
                v, m = v[take:], m[take:]
                if held == rows:
                    yield block(number, parts)
                    number, parts, held = number + 1, [], 0
        if parts:
            yield block(number, parts)

    n = -(-vectors.count() // rows) or 1
    # Few, full blocks: the ranges are drawn for the wanted number, and neighbours that are more are read together.
    order = [F.desc("length"), "row"]
    ranged = vectors.repartitionByRange(n, *order).sortWithinPartitions(*order).coalesce(n)
    return ranged.mapInArrow(batches, "block long, longest double, n long, d long, ids binary, rows binary, vectors binary")


def as_matrix(block: dict, d: int) -> np.ndarray:
    """The vectors of a block, filled up with zeros to d components."""
    v = np.frombuffer(block["vectors"], np.int64).reshape(block["n"], block["d"])
    return np.pad(v, ((0, 0), (0, d - block["d"]))) if block["d"] < d else v


def rotation(blocks: DataFrame) -> np.ndarray:
    """Right singular vectors of all vectors, largest first, from their Gram matrix.

    Each task adds up the products of its blocks; the driver gets one number for
    each pair of components, whatever the number of vectors.
    """

    def batches(it):
        total = np.zeros((0, 0))
        for batch in it:
            for b in batch.to_pylist():
                if b["d"] > len(total):
                    total = np.pad(total, (0, b["d"] - len(total)))
                v = as_matrix(b, b["d"]).astype(float)
                total[: b["d"], : b["d"]] += v.T @ v
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], ["i", "j", "x"])

    sums = blocks.select("n", "d", "vectors").mapInArrow(batches, "i long, j long, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).toArrow()
    i, j, x = (sums.column(n).to_numpy() for n in ("i", "j", "x"))
    gram = np.zeros((int(i.max(initial=-1)) + 1,) * 2)
    gram[i, j] = x
    return np.linalg.eigh((gram + gram.T) / 2)[1][:, ::-1] if len(gram) else gram


class Side:
    """A block's vectors, whole and rotated, with lengths and what is left of them behind each step."""

    def __init__(self, block: dict, turn: np.ndarray) -> None:
        self.v = as_matrix(block, len(turn))
        self.ids, self.rows = (np.frombuffer(block[n], np.int64) for n in ("ids", "rows"))
        self.x = self.v.astype(float)
        self.turned = self.x @ turn
        squares = np.cumsum(self.turned[:, ::-1] ** 2, axis=1)[:, ::-1]
        self.length = np.sqrt((self.x**2).sum(axis=1))
        self.steps = [max(0, min(len(turn), round(len(turn) * s))) for s in STEPS]
        self.left = [np.sqrt(squares[:, m]) if m < len(turn) else np.zeros(len(self.x)) for m in self.steps]


def exact_pairs(q: Side, c: Side, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Integer inner products of the pairs (at, to); beyond a long, the nearest long."""
    out = np.empty(len(at), np.int64)
    for k in range(0, len(at), 1 << 16):
        a, b = at[k : k + (1 << 16)], to[k : k + (1 << 16)]
        small = q.length[a] * c.length[b] < EXACT
        out[k : k + len(a)][small] = np.einsum("ij,ij->i", q.x[a[small]], c.x[b[small]]).astype(np.int64)
        for p in np.flatnonzero(~small):
            score = sum(int(x) * int(y) for x, y in zip(q.v[a[p]], c.v[b[p]]))
            out[k + p] = min(max(score, LEAST), MOST)
    return out


def floor_of(scores: np.ndarray) -> np.ndarray:
    """Doubles that are not above the scores; the least long stands for all below it, so it keeps nothing out."""
    x = scores.astype(float)
    x = np.where(np.abs(x) >= 2.0**53, np.nextafter(x, -np.inf), x)
    return np.where(x <= LEAST, -np.inf, x)


def best_of_block(q: Side, c: Side, floors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score) positions of the best k of ``c`` for each query that reach its floor.

    ``floors`` is raised in place as better scores are found.
    """
    order = np.argsort(-c.length, kind="stable")
    best = [np.empty(0, np.int64)] * 3
    own = np.full(len(q.rows), -1)
    _, a, b = np.intersect1d(q.rows, c.rows, return_indices=True)
    own[a] = b
    for lo in range(0, len(order), PIECE):
        to = order[lo : lo + PIECE]
        alive = np.flatnonzero(q.length * (c.length[to[0]] * (1 + MARGIN)) >= floors)
        if not len(alive):
            break  # later vectors are no longer
        margin = MARGIN * q.length[alive, None] * c.length[to]
        sums, done, mask = np.zeros((len(alive), len(to))), 0, None
        for m, left_q, left_c in zip(q.steps, q.left, c.left):
            sums += q.turned[alive, done:m] @ c.turned[to, done:m].T
            done = m
            mask = sums + left_q[alive, None] * left_c[to] + margin >= floors[alive, None]
            if not mask.any():
                break
        mask[own[alive, None] == to] = False
        n = np.count_nonzero(mask)
        if n > DENSE * mask.size and q.length[alive].max() * c.length[to[0]] < EXACT:
            scores = q.x[alive] @ c.x[to].T
            scores[~mask] = -np.inf
            if len(to) >= k:  # the k-th best of the piece alone is a floor as well
                floors[alive] = np.maximum(floors[alive], np.partition(scores, len(to) - k, axis=1)[:, len(to) - k])
            x, y = np.nonzero((scores >= floors[alive, None]) & mask)
            found = [alive[x], to[y], scores[x, y].astype(np.int64)]
        else:
            x, y = np.nonzero(mask)
            found = [alive[x], to[y], exact_pairs(q, c, alive[x], to[y])]
            found = [f[found[2] >= floors[found[0]]] for f in found]
        if not len(found[0]):
            continue
        best = [np.concatenate(p) for p in zip(best, found)]
        # By query, then score (not negated, which a least long would not survive), then id.
        by = np.lexsort((c.ids[best[1]], ~best[2], best[0]))
        best = [p[by] for p in best]
        starts = np.searchsorted(best[0], best[0])
        kept = np.arange(len(by)) - starts < k
        best, starts = [p[kept] for p in best], starts[kept]
        last = np.flatnonzero(np.bincount(best[0], minlength=len(q.rows)) == k)
        ends = np.searchsorted(best[0], last, side="right") - 1
        floors[last] = np.maximum(floors[last], floor_of(best[2][ends]))
    return best[0], best[1], best[2]


PAIRED = ["longest", "n", "d", "ids", "rows", "vectors"]


def side(row: dict, of: str, turn: np.ndarray) -> Side:
    return Side({n: row[f"{of}_{n}"] for n in PAIRED}, turn)


def renamed(blocks: DataFrame, of: str, *more: str) -> DataFrame:
    return blocks.select(F.col("block").alias(f"{of}_block"), *(F.col(n).alias(f"{of}_{n}") for n in (*PAIRED, *more)))


def exact_top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, rows: int = ROWS, queries: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows for each row whose vec_id is divisible by ``every``.

    Scores are inner products of floor(scale * x); ties go to the smaller vec_id.
    Vectors that are null or hold a null or a component that is not finite take
    no part, nor do rows without a vec_id, which could not be named.  A shorter
    vector counts as filled up with zeros; an empty one scores zero.  Components
    and scores beyond a long are the nearest long.  A vec_id that occurs twice is
    two rows: each is a query of its own and a candidate of the other, and their
    answers stand under one query_id.  Fewer than k other rows are all returned;
    other columns are ignored, and an empty table gives an empty result.
    """
    whole = written(integer_vectors(vectors, scale))
    blocks = written(packed(whole, rows))
    asked = written(packed(whole.where(F.col("vec_id") % every == 0), queries))
    turn = vectors.sparkSession.sparkContext.broadcast(rotation(blocks))

    def lead(it):
        """Floors and best k of each query among the longest vectors."""
        for batch in it:
            for row in batch.to_pylist():
                q, floors = side(row, "q", turn.value), np.full(row["q_n"], -np.inf)
                c = side(row, "c", turn.value)
                at, to, score = best_of_block(q, c, floors, k)
                # Lengths that a vector must have to reach a floor; none where zero reaches it.
                need = np.where(floors > 0, floors / np.maximum(q.length, 1e-300), -1.0).min(initial=np.inf)
                packed_hits = [x.tobytes() for x in (q.rows[at], q.ids[at], c.ids[to], score)]
                values = [row["q_block"], row["c_block"], need, floors.tobytes(), *packed_hits]
                kinds = [pa.int64(), pa.int64(), pa.float64(), *[pa.binary()] * 5]
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, kinds)], ["block", "leader", "need", "floors", *HITS])

    def rest(it):
        """Best k of each query in another block, above the floors."""
        for batch in it:
            for row in batch.to_pylist():
                q, c = side(row, "q", turn.value), side(row, "c", turn.value)
                floors = np.frombuffer(row["q_floors"], float).copy()
                at, to, score = best_of_block(q, c, floors, k)
                yield hits(q.rows[at], q.ids[at], c.ids[to], score)

    def unpack(it):
        for batch in it:
            for row in batch.to_pylist():
                yield hits(*(np.frombuffer(row[n], np.int64) for n in HITS))

    first = blocks.orderBy("block").limit(1)
    led = written(
        renamed(asked, "q").join(renamed(first, "c"), how="cross").mapInArrow(
            lead, "block long, leader long, need double, floors binary, " + ", ".join(f"{n} binary" for n in HITS)
        )
    )
    meets = led.select("block", "need", "leader").alias("q").join(
        blocks.select("block", "longest").alias("c"), F.col("c.block") != F.col("q.leader")
    ).where(F.col("c.longest") * (1 + MARGIN) >= F.col("q.need")).select(F.col("q.block").alias("q_block"), F.col("c.block").alias("c_block"))
    # Queries travel to the vectors' blocks, each of which moves once.
    with_floors = asked.join(led.select("block", "floors"), "block")
    pairs = renamed(with_floors, "q", "floors").join(written(meets), "q_block").join(renamed(blocks, "c"), "c_block")
    schema = "row long, query_id long, vec_id long, score long"
    every_hit = pairs.mapInArrow(rest, schema).unionByName(led.select(*HITS).mapInArrow(unpack, schema))
    place = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    return every_hit.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


HITS = ["hit_rows", "hit_queries", "hit_ids", "hit_scores"]


def hits(rows: np.ndarray, queries: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (rows, queries, ids, scores)], ["row", "query_id", "vec_id", "score"])


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"))


#: Every query against every other row.
ORACLE = r"""
with v as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
  where embedding is not null and vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.r, q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score from v q join v c on q.r <> c.r where q.vec_id % 20 = 0
)
select query_id, row_number() over (partition by r order by score desc, vec_id)::int as rank, vec_id, score from s
qualify rank <= 20
"""
