"""Alerts on streams: rising errors from window to window, and checkpoints that grow stale."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ALERTS = "consumer string, alert string, at long, value long"


class _Alerts(StatefulProcessor):
    """A consumer's open windows, its last closed one, and the time of its last checkpoint."""

    def __init__(self, width: int, stale: int):
        self.width, self.stale = width, stale

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "start long", "errors long")
        self.last = handle.getValueState("last", "errors long")
        self.saved = handle.getValueState("saved", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))
        tried = new[new["tried"]]
        for start, errors in tried.groupby(tried["at"] // self.width * self.width)["errors"].sum().items():
            known = self.open.getValue((int(start),))[0] if self.open.containsKey((int(start),)) else None
            if known is None:
                self.handle.registerTimer((int(start) + self.width) // 1000)
            self.open.updateValue((int(start),), ((known or 0) + int(errors),))
        points = new[~new["tried"]]["at"]
        if len(points):
            at = int(points.max())
            before = self.saved.get()[0] if self.saved.exists() else None
            if before is None or at > before:
                self.saved.update((at,))
                self.handle.registerTimer((at + self.stale) // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs() * 1000
        out = []
        # Timers of several windows may fire in any order: all that have ended close in theirs.
        for start, errors in sorted((k[0], v[0]) for k, v in self.open.iterator()):
            if start + self.width > now:
                break
            before = self.last.get()[0] if self.last.exists() else None
            if before is not None and errors > before:
                out.append((key[0], "errors_rising", start, errors - before))
            self.last.update((errors,))
            self.open.removeKey((start,))
        if self.saved.exists() and now > self.saved.get()[0] + self.stale:
            out.append((key[0], "checkpoint_stale", self.saved.get()[0], (now - self.saved.get()[0]) // 1_000_000))
            self.saved.clear()  # told once, until the next checkpoint
        if out:
            yield pd.DataFrame(out, columns=[f.split(" ")[0] for f in ALERTS.split(", ")])

    def close(self) -> None:
        pass


def stream_alerts(attempts: DataFrame, checkpoints: DataFrame, width_seconds: int, stale_seconds: int, watermark: str) -> DataFrame:
    """(consumer, alert, at, value) of streams of attempts (consumer, ts, ok) and checkpoints (consumer_name, updated_at).

    ``errors_rising``: a window (named by its start, in microseconds) had more
    errors than the consumer's window before it, told when the watermark passes its end, as
    ``alerts`` tells it of a table.  ``checkpoint_stale``: the watermark has
    passed a consumer's last checkpoint (``at``) by more than ``stale_seconds``.
    """
    tried = attempts.select("consumer", "ts", F.unix_micros("ts").alias("at"), (~F.col("ok")).cast("long").alias("errors"), F.lit(True).alias("tried"))
    saved = checkpoints.select(F.col("consumer_name").alias("consumer"), F.col("updated_at").alias("ts"), F.unix_micros("updated_at").alias("at"), F.lit(0).cast("long").alias("errors"), F.lit(False).alias("tried"))
    both = tried.unionByName(saved).withWatermark("ts", watermark)
    return both.groupBy("consumer").transformWithStateInPandas(_Alerts(width_seconds * 1_000_000, stale_seconds * 1_000_000), ALERTS, "Append", "EventTime")
