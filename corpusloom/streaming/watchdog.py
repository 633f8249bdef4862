"""Idle watchdog: one warning and one failure for each stream that falls silent, by timers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Seconds of silence after which a stream is warned of and given up, and the types that end it.
WARN_AFTER, FAIL_AFTER = 180.0, 420.0
LAST = ("verdict", "error")
ALARMS = "key string, kind string, idle_s double, last_at timestamp"


class IdleWatchdog(StatefulProcessor):
    """Keeps the time of a key's last event and whether its warning is out.

    Every event re-arms both alarms; a closing event disarms them.  After
    ``warn_after`` seconds of silence the key is warned of once, after
    ``fail_after`` it fails once and is forgotten; an event that comes later
    starts anew.  A timer that is overtaken by an event is deleted, and one that
    fires late tells how long the silence had lasted by then.
    """

    def __init__(self, warn_after: float, fail_after: float, last: tuple[str, ...], by_event: bool):
        self.warn_ms, self.fail_ms, self.last, self.by_event = round(warn_after * 1000), round(fail_after * 1000), last, by_event

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "at bigint, warned boolean")

    def _now(self, timers) -> int:
        return timers.getCurrentWatermarkInMs() if self.by_event else timers.getCurrentProcessingTimeInMs()

    def _clear(self) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)

    def _alarms(self, key, at: int, warned: bool, until: int) -> tuple[list[tuple], bool, bool]:
        """Alarms of a silence from ``at`` to ``until``; whether it is warned of and whether it is over."""
        out = []
        if until - at >= self.warn_ms and not warned:
            out.append((str(key[0]), "warn", (until - at) / 1000, pd.Timestamp(at, unit="ms")))
            warned = True
        failed = until - at >= self.fail_ms
        if failed:
            out.append((str(key[0]), "fail", (until - at) / 1000, pd.Timestamp(at, unit="ms")))
        return out, warned, failed

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows)).sort_values("at_ms", kind="stable")
        out = []
        at, warned = self.seen.get() if self.seen.exists() else (None, False)
        for e in events.itertuples(index=False):
            # In event time the rows themselves show a silence; in processing time they all come now.
            now = int(e.at_ms) if self.by_event else self._now(timerValues)
            if at is not None:
                more, warned, _ = self._alarms(key, at, warned, now)
                out += more
            at, warned = (None, False) if e.event_type in self.last else (max(now, at or now), False)
        self._clear()
        if at is None:
            self.seen.clear()
        else:
            self.seen.update((at, False))
            self.handle.registerTimer(at + self.warn_ms)
        yield frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out = []
        if self.seen.exists():
            at, warned = self.seen.get()
            out, warned, failed = self._alarms(key, at, warned, max(self._now(timerValues), expiredTimerInfo.getExpiryTimeInMs()))
            if failed:
                self.seen.clear()
            else:
                self.seen.update((at, warned))
                self.handle.registerTimer(at + (self.fail_ms if warned else self.warn_ms))
        yield frame(out)

    def close(self) -> None:
        pass


def frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame({n: [r[k] for r in rows] for k, n in enumerate(("key", "kind", "idle_s", "last_at"))}).astype(
        {"key": "object", "kind": "object", "idle_s": "float64", "last_at": "datetime64[ns]"}
    )


def idle_alarms(
    stream: DataFrame, key: str = "user_id", warn_after: float = WARN_AFTER, fail_after: float = FAIL_AFTER, last: tuple[str, ...] = LAST,
    by_event: bool = False, late: str = "0 seconds",
) -> DataFrame:
    """(key, kind, idle_s, last_at): 'warn' and 'fail' alarms of silent keys, each once for one silence.

    ``stream`` has ``key``, ts and event_type.  In processing time (the default)
    silence is measured by the clock; with ``by_event`` by the events' own times
    and the watermark, so that a replay gives the same alarms.  Needs the RocksDB
    state store.  Rows with a null key, or in event time a null ts, are left out.
    """
    rows = stream.where(F.col(key).isNotNull())
    if by_event:
        rows = rows.where("ts is not null").withWatermark("ts", late)
    rows = rows.select(F.col(key).cast("string").alias("key"), "ts", F.coalesce("event_type", F.lit("")).alias("event_type"), F.coalesce(F.unix_millis("ts"), F.lit(0)).alias("at_ms"))
    return rows.groupBy("key").transformWithStateInPandas(
        statefulProcessor=IdleWatchdog(warn_after, fail_after, last, by_event), outputStructType=ALARMS, outputMode="Append",
        timeMode="EventTime" if by_event else "ProcessingTime",
    )
