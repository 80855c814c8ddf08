"""Copies of messages on a stream: each accepted at most once a window.

Keys are dealt into buckets, and state belongs to a bucket: a stream of millions
of keys would otherwise call Python, its state and its timers once a key, which
takes milliseconds each.  What a bucket holds lies in parts that say which times
they hold, so that a batch reads and writes only the parts near its own times.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from outflow.operators.hops import NEVER, greedy

#: Buckets of keys; a stream keeps the number that it began with.
BUCKETS = 1024
#: Rows up to which what comes is joined to the part before.
PART_ROWS = 8192


class _Parts:
    """A bucket's rows (key, row, at) in state, in numbered parts."""

    def __init__(self, handle: StatefulProcessorHandle, name: str):
        self.rows = handle.getMapState(name, "part long", "rows binary")
        self.index = handle.getValueState(f"{name}_index", "spans binary")

    def spans(self) -> np.ndarray:
        """Part, least and largest time, and number of rows of each part, in order of the parts."""
        found = self.index.get()
        return np.empty((0, 4), np.int64) if found is None else np.frombuffer(found[0], np.int64).reshape(-1, 4)

    def read(self, spans: np.ndarray) -> list[pd.DataFrame]:
        return [pa.ipc.open_stream(bytes(self.rows.getValue((int(n),))[0])).read_pandas() for n in spans[:, 0]]

    def drop(self, spans: np.ndarray, gone: np.ndarray) -> np.ndarray:
        """The spans that are left without some parts."""
        for n in spans[gone, 0]:
            self.rows.removeKey((int(n),))
        return spans[~gone]

    def add(self, spans: np.ndarray, rows: pd.DataFrame) -> np.ndarray:
        """The spans with more rows, in the last part as long as that is short."""
        if not len(rows):
            return spans
        number = int(spans[-1, 0]) + 1 if len(spans) else 0
        if len(spans) and spans[-1, 3] + len(rows) <= PART_ROWS:
            number -= 1
            rows = pd.concat([*self.read(spans[-1:]), rows], ignore_index=True)
            spans = spans[:-1]
        for k in range(0, len(rows), PART_ROWS):
            part = rows.iloc[k : k + PART_ROWS]
            batch = pa.RecordBatch.from_pandas(part, preserve_index=False)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as out:
                out.write_batch(batch)
            self.rows.updateValue((number,), (sink.getvalue().to_pybytes(),))
            spans = np.append(spans, [[number, int(part["at"].min()), int(part["at"].max()), len(part)]], axis=0)
            number += 1
        return spans

    def save(self, spans: np.ndarray) -> None:
        self.index.update((spans.tobytes(),)) if len(spans) else self.index.clear()


def _coded(frames: list[pd.DataFrame]) -> tuple[list[np.ndarray], int]:
    """Numbers for the frames' keys (a null key is one too), and how many there are."""
    codes, keys = pd.factorize(pd.concat([f["key"] for f in frames], ignore_index=True), use_na_sentinel=False)
    return np.split(codes, np.cumsum([len(f) for f in frames])[:-1]), len(keys)


class _Bucketed(StatefulProcessor):
    """What both ways to judge copies share: the accepted times of a bucket's keys, and one timer a bucket."""

    def __init__(self, window_micros: int):
        self.window = window_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.accepted = _Parts(handle, "accepted")

    def wake(self, micros: int | None) -> None:
        """The bucket's only timer, just after this time."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if micros is not None:
            self.handle.registerTimer(micros // 1000 + 1)

    def passed(self, timerValues) -> int:
        return timerValues.getCurrentWatermarkInMs() * 1000

    def near(self, spans: np.ndarray, low: int, high: int) -> pd.DataFrame:
        """Accepted times that may lie less than a window from some time in low to high."""
        parts = self.accepted.read(spans[(spans[:, 2] > low - self.window) & (spans[:, 1] < high + self.window)])
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"key": pd.Series([], dtype=object), "at": pd.Series([], dtype=np.int64)})

    def close(self) -> None:
        pass


class _Dedupe(_Bucketed):
    """A bucket's accepted times as far back as a late copy may still come.

    A copy is held against the accepted times of both sides: accepted if none is
    less than a window before it.  One that comes late and stands less than a
    window before an accepted copy is a copy of a message that is out already,
    so it is dropped too and nothing that was given out is ever wrong.
    """

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)[["key", "row", "at"]]
        spans = self.accepted.spans()
        old = self.near(spans, int(new["at"].min()), int(new["at"].max()))
        (code, had), _ = _coded([new, old])
        order = np.lexsort((_ranks(new["row"]), new["at"].to_numpy(), code))
        new, code = new.iloc[order], code[order]
        free = ~_held(code, new["at"].to_numpy(), had, old["at"].to_numpy(), self.window)
        new, code = new[free], code[free]
        kept = new[greedy(code, new["at"].to_numpy(), np.full(len(np.unique(code)), NEVER), self.window)]
        # Times that no copy inside the watermark can meet any more leave.
        spans = self.accepted.drop(spans, spans[:, 2] < self.passed(timerValues) - self.window)
        spans = self.accepted.add(spans, kept[["key", "at"]])
        self.accepted.save(spans)
        self.wake(int(spans[:, 2].max()) + self.window if len(spans) else None)
        if len(kept):
            yield kept

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        spans = self.accepted.spans()
        self.accepted.save(self.accepted.drop(spans, np.ones(len(spans), bool)))
        return iter(())


def _ranks(rows: pd.Series) -> np.ndarray:
    """Places of the rows among them, of any type."""
    values = rows.to_numpy()
    if values.dtype != object:
        return values
    ranks = np.empty(len(rows), np.int64)
    ranks[rows.argsort(kind="stable").to_numpy()] = np.arange(len(rows))
    return ranks


def _held(code: np.ndarray, at: np.ndarray, had: np.ndarray, times: np.ndarray, window: int) -> np.ndarray:
    """Which sorted (code, at) lie less than a window from one of the times that a code had, on either side."""
    order = np.lexsort((times, had))
    had, times = had[order], times[order]
    held = np.zeros(len(at), bool)
    # Places among both: how many had times come before each, those at its own time included.
    both = np.lexsort((np.append(np.zeros(len(had), np.int8), np.ones(len(code), np.int8)), np.append(times, at), np.append(had, code)))
    mine = both >= len(had)
    place = np.empty(len(code), np.int64)
    place[both[mine] - len(had)] = np.cumsum(~mine)[mine]
    before, after = place > 0, place < len(had)
    k = place[before] - 1
    held[before] |= (had[k] == code[before]) & (at[before] - times[k] < window)
    k = place[after]
    held[after] |= (had[k] == code[after]) & (times[k] - at[after] < window)
    return held


class _Settled(_Bucketed):
    """A bucket's copies wait until the watermark has passed them; then no earlier one can come, and they are judged in time order."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.waiting = _Parts(handle, "waiting")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        spans = self.waiting.spans()
        for part in rows:
            spans = self.waiting.add(spans, part[["key", "row", "at"]])
        self.waiting.save(spans)
        self.wake(int(spans[:, 1].min()))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = self.passed(timerValues)
        waiting, accepted = self.waiting.spans(), self.accepted.spans()
        due = waiting[:, 1] <= passed
        kept = None
        if due.any():
            found = pd.concat(self.waiting.read(waiting[due]), ignore_index=True)
            waiting = self.waiting.drop(waiting, due)
            ripe = found["at"] <= passed
            waiting = self.waiting.add(waiting, found[~ripe])
            kept = self.judged(found[ripe], accepted)
            accepted = self.accepted.add(accepted, kept.drop_duplicates("key", keep="last")[["key", "at"]])
        # What was accepted a window before the watermark holds back nothing any more.
        accepted = self.accepted.drop(accepted, accepted[:, 2] + self.window <= passed)
        self.waiting.save(waiting)
        self.accepted.save(accepted)
        self.wake(int(waiting[:, 1].min()) if len(waiting) else int(accepted[:, 2].max()) + self.window if len(accepted) else None)
        if kept is not None and len(kept):
            yield kept

    def judged(self, rows: pd.DataFrame, accepted: np.ndarray) -> pd.DataFrame:
        """The rows kept, by key and time, when those of a key follow its time accepted last."""
        old = self.near(accepted, int(rows["at"].min()), int(rows["at"].max()))
        (code, had), n = _coded([rows, old])
        last = np.full(n, NEVER)
        np.maximum.at(last, had, old["at"].to_numpy())
        order = np.lexsort((_ranks(rows["row"]), rows["at"].to_numpy(), code))
        rows, code = rows.iloc[order], code[order]
        return rows[greedy(code, rows["at"].to_numpy(), last[np.unique(code)], self.window)]


def stream_dedupe(stream: DataFrame, key: str, ts: str, row: str, window_seconds: int, watermark: str, mode: str = "exact", buckets: int = BUCKETS) -> DataFrame:
    """(key, row, at): copies accepted at most once a window since the last accepted one.

    Copies that come in order from batch to batch give what ``dedupe_window``
    gives; one that comes late, but inside the watermark, is judged by the copies
    accepted before and after it.  Later ones are dropped and counted (``DropCounter``).
    ``settled`` gives each copy only when the watermark has passed it, and then
    exactly what ``dedupe_window`` gives, in whatever order copies inside the
    watermark come; a key's copies of that time wait in state, and the last ones
    of a stream until later events move the watermark past them.
    ``coarse`` uses Spark's own dropDuplicatesWithinWatermark, which may also
    drop later copies, as its state leaves only after the watermark passes.

    State is kept for ``buckets`` of keys; a task holds one bucket's rows of a
    batch and what state it has near their times, so more keys ask for more
    buckets.  A checkpoint goes with the number of buckets it was begun with.
    """
    marked = stream.withWatermark(ts, watermark)
    if mode == "coarse":
        return marked.dropDuplicatesWithinWatermark([key]).select(F.col(key).alias("key"), F.col(row).alias("row"), F.unix_micros(ts).alias("at"))
    dealt = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).alias("bucket")
    lean = marked.select(dealt, F.col(key).cast("string").alias("key"), F.col(row).alias("row"), F.unix_micros(ts).alias("at"), F.col(ts))
    kind, window = stream.schema[row].dataType.simpleString(), window_seconds * 1_000_000
    judge = (_Settled if mode == "settled" else _Dedupe)(window)
    return lean.groupBy("bucket").transformWithStateInPandas(judge, f"key string, row {kind}, at long", "Append", "EventTime")
