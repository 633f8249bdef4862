"""Orders of a stream after a buffer of bounded size, as processes with carried state.

Only ids pass: the state from block to block is the ids in the buffer, texts and
tokens stay where they are and are packed by the new place afterwards.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame

from .folds import fold_blocks

# Fixed value: rows in a stream's shuffle buffer.
STREAM_BUFFER = 10_000
PLACED = "{id} long, place long"


def draw(seed: str, *parts: object) -> int:
    """60 bits from the seed and what is drawn for."""
    return int(hashlib.md5(":".join([seed, *map(str, parts)]).encode()).hexdigest()[:15], 16)


def _placed(name: str, ids: list[int], first: int) -> pa.Table:
    return pa.table({name: pa.array(ids, pa.int64()), "place": pa.array(range(first, first + len(ids)), pa.int64())})


def drained_order(rows: DataFrame, order: str, buffer: int, seed: str, block: int | None = None) -> DataFrame:
    """(order, place) after a buffer that drains half of itself, at random, whenever it is full.

    Rows enter by the integer ``order``.  When ``buffer`` of them are in, half
    (rounded down) leave; which ones follows from (seed, number of the drain, id),
    and they leave from the back of the buffer to the front.  What is left at the
    end leaves from front to back.  So a row may stay for many drains, and none
    is lost.  A buffer of one row changes nothing.
    """

    def step(t: pa.Table, state: tuple[list[int], int, int]) -> tuple[pa.Table, tuple[list[int], int, int]]:
        held, drains, done = list(state[0]), state[1], state[2]
        out: list[int] = []
        for x in t.column(order).to_pylist():
            held.append(x)
            if len(held) >= buffer:
                ranked = sorted(range(len(held)), key=lambda k: (draw(seed, drains, held[k]), held[k]))
                picks = set(ranked[: max(1, len(held) // 2)])
                out += [held[k] for k in sorted(picks, reverse=True)]
                held = [x for k, x in enumerate(held) if k not in picks]
                drains += 1
        return _placed(order, out, done), (held, drains, done + len(out))

    ids = rows.select(order).where(f"`{order}` is not null")
    return fold_blocks(ids, [order], PLACED.format(id=order), ([], 0, 0), step, lambda s: _placed(order, s[0], s[2]), block)


def streamed_order(rows: DataFrame, order: str, seed: str, buffer: int = STREAM_BUFFER, block: int | None = None) -> DataFrame:
    """(order, place) after a shuffle buffer: each new row takes the place of a random one, which leaves.

    The k-th row beyond the buffer draws the place from (seed, k); what is left at
    the end leaves in the order of draws from (seed, id).
    """

    def step(t: pa.Table, state: tuple[list[int], int]) -> tuple[pa.Table, tuple[list[int], int]]:
        held, done = list(state[0]), state[1]
        out: list[int] = []
        for x in t.column(order).to_pylist():
            if len(held) < buffer:
                held.append(x)
                continue
            k = draw(seed, done + len(out)) % buffer
            out.append(held[k])
            held[k] = x
        return _placed(order, out, done), (held, done + len(out))

    def rest(state: tuple[list[int], int]) -> pa.Table:
        return _placed(order, sorted(state[0], key=lambda x: (draw(seed, "end", x), x)), state[1])

    ids = rows.select(order).where(f"`{order}` is not null")
    return fold_blocks(ids, [order], PLACED.format(id=order), ([], 0), step, rest, block)
