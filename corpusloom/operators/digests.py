"""SHA-256 of long ordered lists of texts, streamed in pieces instead of held as one list."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of a piece, about.
PIECE = 1 << 14


def listed_sha256(rows: DataFrame, by: str, order: list[str], text: Column, separator: str, head: str = "", tail: str = "") -> DataFrame:
    """(by, n, sha256): of each group the SHA-256, in hex, of ``head``, the texts in order between separators, and ``tail``.

    Rows are sorted over ranges of group and order, so a group that holds most
    rows is spread as well; tasks join neighbours to pieces, and only pieces pass
    the task that hashes a group, one batch at a time.  Rows of a null group are
    left out; a null text counts as empty.
    """

    def joined(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, parts, size, number, out = None, [], 0, 0, []

        def close() -> None:
            nonlocal parts, size, number
            if parts:
                out.append((group, number, len(parts), separator.join(parts)))
                parts, size, number = [], 0, number + 1

        task = TaskContext.get().partitionId() << 40
        for batch in it:
            for g, t in zip(batch.column("g").to_pylist(), batch.column("t").to_pylist()):
                if g != group or size >= PIECE:
                    close()
                    if g != group:
                        group, number = g, 0
                parts.append(t)
                size += len(t)
            yield _table(out, task)
            out = []
        close()
        yield _table(out, task)

    def _table(out: list[tuple], task: int) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        values = [[r[0] for r in out], [task + r[1] for r in out], [r[2] for r in out], [r[3] for r in out]]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["g", "piece", "n", "t"])

    def hashed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, state, n, out = None, None, 0, []

        def close() -> None:
            if group is not None:
                state.update(tail.encode())
                out.append((group, n, state.hexdigest()))

        for batch in it:
            for g, k, t in zip(*(batch.column(c).to_pylist() for c in ("g", "n", "t"))):
                if g != group:
                    close()
                    group, n, state = g, 0, hashlib.sha256(head.encode())
                elif n:
                    state.update(separator.encode())
                state.update(t.encode())
                n += k
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], k) for c, k in enumerate([pa.string(), pa.int64(), pa.string()])], ["g", "n", "sha256"])
            out = []
        close()
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], k) for c, k in enumerate([pa.string(), pa.int64(), pa.string()])], ["g", "n", "sha256"])

    keys = [F.col(c).alias(f"o{k}") for k, c in enumerate(order)]
    flat = rows.where(F.col(by).isNotNull()).select(F.col(by).cast("string").alias("g"), *keys, F.coalesce(text.cast("string"), F.lit("")).alias("t"))
    names = ["g", *(f"o{k}" for k in range(len(order)))]
    pieces = flat.repartitionByRange(*names).sortWithinPartitions(*names).select("g", "t").mapInArrow(joined, "g string, piece long, n long, t string")
    return pieces.repartition("g").sortWithinPartitions("g", "piece").select("g", "n", "t").mapInArrow(hashed, "g string, n long, sha256 string").withColumnRenamed("g", by)
