"""Processes over ordered rows whose state passes from block to block.

Rows are sorted over ranges and written in blocks.  Each block is one small job
that gets the state before it and leaves its rows and the state after it, so what
has to happen one after another is spread over tasks, no task holds more than a
block, and a lost executor costs one block.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import written

#: Rows of a block, about.
BLOCK = 1_000_000


def fold_blocks(
    rows: DataFrame, order: list, schema: str, start: Any, step: Callable[[pa.Table, Any], tuple[pa.Table, Any]],
    finish: Callable[[Any], pa.Table] | None = None, block: int | None = None,
) -> DataFrame:
    """All rows that ``step`` makes of the blocks of ``rows``, in ``order``.

    ``step`` takes a block as a table and the state, and returns rows of
    ``schema`` and the next state; ``finish`` makes rows of the last one.  A state
    is small: it is pickled and passes the driver.
    """
    spark = rows.sparkSession
    n = -(-rows.count() // (block or BLOCK))
    keys = [k if not isinstance(k, str) else F.col(k) for k in order]
    names = rows.columns
    at = rows.repartitionByRange(max(1, n), *keys).withColumn("_block", F.spark_partition_id())
    sorted_rows = written(at, "_block")
    numbers = sorted(r[0] for r in sorted_rows.select("_block").distinct().collect())  # one number for each block
    state, parts = pickle.dumps(start), []
    for number in numbers:
        one = sorted_rows.where(F.col("_block") == number).coalesce(1).sortWithinPartitions(*keys).select(*names)

        def run(it, before=state):
            batches = list(it)  # a block
            made, after = step(pa.Table.from_batches(batches), pickle.loads(before)) if batches else (None, pickle.loads(before))
            kinds = made.schema if made is not None else None
            raw = pickle.dumps(after)
            if made is not None and made.num_rows:
                for b in made.to_batches():
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.nulls(b.num_rows, pa.binary())], [*kinds.names, "_state"])
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, t) for t in types), pa.array([raw], pa.binary())], [*columns, "_state"])

        empty = spark.createDataFrame([], schema)
        columns, types = empty.columns, _arrow(empty)
        made = written(one.mapInArrow(run, f"{schema}, _state binary"))
        state = bytes(made.where("_state is not null").first()["_state"])
        parts.append(made.where("_state is null").drop("_state"))
    out = spark.createDataFrame([], schema)
    if finish is not None:
        rest = finish(pickle.loads(state))
        if rest.num_rows:
            out = spark.createDataFrame(rest, schema)
    for p in parts:
        out = out.unionByName(p)
    return out


def _arrow(df: DataFrame) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_schema

    return [f.type for f in to_arrow_schema(df.schema)]


