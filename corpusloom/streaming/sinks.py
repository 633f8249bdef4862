"""Sinks for foreachBatch: a keyed snapshot that is flushed seldom, survives replays and a store that fails."""

from __future__ import annotations

import re
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from ..sources.array_files import fs, store_of

#: Seconds between flushes, and of rest for a store that failed.
EVERY, REST = 5.0, 300.0


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


class SnapshotSink:
    """The latest row of each key, from the batches of a stream.

    A batch is first kept as a delta under its own number, written over when the
    batch is replayed.  A flush merges the deltas since the last snapshot into a
    new one, named by the last batch in it; a snapshot counts once Spark has
    marked it complete, so a flush that breaks off changes nothing.  Batches at
    or below the newest snapshot are known and ignored.  Flushes are at least
    ``every`` seconds apart; ``close`` flushes what is left.

    The first store is written; where that raises, it rests for ``rest`` seconds
    and the second store takes the snapshot.  If both fail the deltas stay and
    the next flush has them.  Snapshots are read from whichever store has the
    newest.
    """

    def __init__(
        self, stores: list[str], deltas: str, keys: list[str], order: list[str], every: float = EVERY, rest: float = REST,
        write: Callable[[DataFrame, str], None] = write_parquet, clock: Callable[[], float] = time.monotonic,
    ):
        self.stores, self.deltas, self.keys, self.order = stores, deltas, keys, order
        self.every, self.rest, self.write, self.clock = every, rest, write, clock
        self.flushed_at: float | None = None
        self.retry_after: dict[str, float] = {}
        self.failures: list[tuple[str, str]] = []

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id <= self.newest()[0]:
            return
        batch.write.mode("overwrite").parquet(f"{self.deltas}/batch={batch_id}")
        if self.flushed_at is None or self.clock() - self.flushed_at >= self.every:
            self.flush(batch.sparkSession)

    def close(self, spark) -> None:
        self.flush(spark)

    def newest(self) -> tuple[int, str | None]:
        """(last batch, path) of the newest complete snapshot in any store that can be listed; (-1, None) without one."""
        found = [(-1, None)]
        for at in self.stores:
            try:
                found += [(n, f"{at}/version={n}") for n in numbered(at, "version")]
            except OSError as e:
                self.failures.append((at, str(e)))
        return max(found, key=lambda x: x[0])

    def snapshot(self, spark) -> DataFrame | None:
        path = self.newest()[1]
        return spark.read.parquet(path) if path else None

    def flush(self, spark) -> int | None:
        """Writes a new snapshot if there are deltas; the last batch in it, or None."""
        last, path = self.newest()
        pending = sorted(n for n in numbered(self.deltas, "batch") if n > last)
        if not pending:
            return None
        self.flushed_at = self.clock()
        rows = spark.read.parquet(*(f"{self.deltas}/batch={n}" for n in pending))
        if path:
            rows = spark.read.parquet(path).unionByName(rows, allowMissingColumns=True)
        others = [c for c in rows.columns if c not in self.keys]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*others), F.struct(*self.order)).alias("_row"))
        merged = newest.select(*self.keys, "_row.*").select(*rows.columns)
        for at in self.stores:
            if self.clock() < self.retry_after.get(at, float("-inf")):
                continue
            try:
                self.write(merged, f"{at}/version={pending[-1]}")
            except Exception as e:  # noqa: BLE001 - whatever a store raises, the stream goes on with the next one
                if isinstance(e, AnalysisException):
                    raise  # a fault of the query, not of the store
                self.retry_after[at] = self.clock() + self.rest
                self.failures.append((at, str(e).splitlines()[0] if str(e) else type(e).__name__))
                continue
            self._tidy(pending[-1])
            return pending[-1]
        return None

    def _tidy(self, last: int) -> None:
        """Deltas that are in the newest snapshot go, and all snapshots but two of each store that can be reached."""
        for top, name, below in [(self.deltas, "batch", last + 1)] + [(at, "version", last) for at in self.stores]:
            try:
                numbers = sorted(n for n in numbered(top, name) if n < below)
                store, path = store_of(top)
                for n in numbers if name == "batch" else numbers[:-1]:
                    store.delete_dir(f"{path}/{name}={n}")
            except OSError as e:
                self.failures.append((top, str(e)))


def numbered(top: str, name: str) -> list[int]:
    """The numbers n of the complete folders ``name=n``."""
    store, path = store_of(top)
    if store.get_file_info(path).type != fs.FileType.Directory:
        return []
    inside = [f for f in store.get_file_info(fs.FileSelector(path)) if re.fullmatch(rf"{name}=\d+", f.base_name)]
    return [int(f.base_name.split("=")[1]) for f in inside if store.get_file_info(f"{f.path}/_SUCCESS").is_file]
