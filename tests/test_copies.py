"""De-duplication on streams: state belongs to buckets of keys, in parts of time."""

import datetime as dt
import random
from bisect import bisect_right

import numpy as np
import pandas as pd
import pytest

from outflow.operators.hops import NEVER, greedy
from outflow.streaming import copies as cs
from outflow.streaming import relay as rl
from tests.test_relay import drained, rocksdb  # noqa: F401

T0 = dt.datetime(2024, 1, 1)


class Value:
    def __init__(self):
        self.held = None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None


class Map:
    def __init__(self):
        self.held = {}
        self.read = 0

    def getValue(self, key):  # noqa: N802
        self.read += 1
        return self.held.get(key)

    def updateValue(self, key, value):  # noqa: N802
        self.held[key] = value

    def removeKey(self, key):  # noqa: N802
        del self.held[key]


class Handle:
    """State and timers of one bucket, in memory."""

    def __init__(self):
        self.timers, self.states = set(), {}

    def getMapState(self, name, *_):  # noqa: N802
        return self.states.setdefault(name, Map())

    def getValueState(self, name, *_):  # noqa: N802
        return self.states.setdefault(name, Value())

    def listTimers(self):  # noqa: N802
        return iter(sorted(self.timers))

    def deleteTimer(self, at):  # noqa: N802
        self.timers.discard(at)

    def registerTimer(self, at):  # noqa: N802
        self.timers.add(at)


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.ms


def run(judge, batches, delay_ms):
    """Rows that a bucket gives for batches of (key, row, micros); the watermark follows the batch before, and later rows are dropped."""
    handle, out, mark, seen = Handle(), [], 0, 0
    judge.init(handle)
    for batch in [*batches, [], []]:
        batch = [b for b in batch if b[2] > mark * 1000]
        if batch:
            frame = pd.DataFrame(batch, columns=["key", "row", "at"])
            # A group may come in several frames.
            out += [f for f in judge.handleInputRows((0,), iter([frame.iloc[:3], frame.iloc[3:]] if len(frame) > 3 else [frame]), Clock(mark))]
        for timer in sorted(t for t in handle.timers if t <= mark):
            handle.timers.discard(timer)
            out += [f for f in judge.handleExpiredTimer((0,), Clock(mark), None)]
        seen = max([seen, *(b[2] for b in batch)])
        mark = max(mark, seen // 1000 - delay_ms)
    return [(k, r) for f in out for k, r in zip(f["key"], f["row"], strict=True)], handle


def made(rng, keys, n, late):
    """Batches of copies in order of time, but for some that come up to ``late`` later."""
    rows = [(rng.choice(keys), i, rng.randrange(1, 400) * 1000) for i in range(n)]
    rows.sort(key=lambda r: r[2] + rng.uniform(0, late) * 1000)
    return [rows[k : k + n // 12] for k in range(0, n, n // 12)]


@pytest.mark.parametrize("seed", range(12))
def test_a_bucket_equals_a_loop_over_each_key(monkeypatch, seed):
    monkeypatch.setattr(cs, "PART_ROWS", 5)
    rng = random.Random(seed)
    batches = made(rng, ["a", "b", None, *map(str, range(seed * 9))], 240, 30 * (seed % 3))
    want, times = set(), {}
    for batch in batches:
        for k, r, at in sorted(batch, key=lambda b: (b[2], b[1])):
            mine = times.setdefault(k, [])
            n = bisect_right(mine, at)
            if (n == 0 or at - mine[n - 1] >= 10_000) and (n == len(mine) or mine[n] - at >= 10_000):
                mine.insert(n, at)
                want.add((k, r))
    got, _ = run(cs._Dedupe(10_000), batches, 100_000)
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("seed", range(12))
def test_a_settled_bucket_equals_the_fold(monkeypatch, seed):
    monkeypatch.setattr(cs, "PART_ROWS", 5)
    rng = random.Random(seed)
    batches = made(rng, ["a", "b", None, *map(str, range(seed * 9))], 240, 100)
    want, last = set(), {}
    for k, r, at in sorted((b for batch in batches for b in batch), key=lambda b: (b[2], b[1])):
        if k not in last or at - last[k] >= 10_000:
            want.add((k, r))
            last[k] = at
    # One far behind all lets the last ones out; nothing but itself stays in state.
    got, handle = run(cs._Settled(10_000), [*batches, [("end", 999, 10**9)]], 120)
    assert len(got) == len(set(got)) and set(got) == want
    assert len(handle.states["waiting"].held) == 1 and not handle.states["accepted"].held


def test_a_batch_reads_only_parts_near_its_times():
    handle, judge = Handle(), cs._Dedupe(1000)
    judge.init(handle)
    for k in range(50):
        # Long parts, each of a time of its own.
        frame = pd.DataFrame({"key": [f"{i}" for i in range(cs.PART_ROWS)], "row": range(cs.PART_ROWS), "at": k * 10_000})
        assert sum(len(f) for f in judge.handleInputRows((0,), iter([frame]), Clock(0))) == cs.PART_ROWS
    parts = handle.states["accepted"]
    parts.read = 0
    again = pd.DataFrame({"key": ["5", "new"], "row": [1, 2], "at": [200_500, 200_500]})
    assert [list(f["key"]) for f in judge.handleInputRows((0,), iter([again]), Clock(0))] == [["new"]]
    assert parts.read == 1
    # What the watermark has passed leaves without being read.
    late = pd.DataFrame({"key": ["x"], "row": [1], "at": [900_000]})
    list(judge.handleInputRows((0,), iter([late]), Clock(300)))
    assert len(parts.held) < 25


def test_lines_far_apart_are_followed_in_turns():
    # Times from one end of the range to the other leave room for few lines at once.
    far = 1 << 59
    line, times = np.repeat(np.arange(9), 3), np.tile([0, 5, far], 9)
    assert greedy(line, times, np.full(9, NEVER), 10).tolist() == [True, False, True] * 9


def test_a_stream_of_many_keys_has_state_and_calls_by_buckets(spark, rocksdb, tmp_path):  # noqa: F811
    n = 6000
    for k in range(2):
        rows = [(k * n + i, f"k{i}", T0 + dt.timedelta(seconds=7 * k)) for i in range(n)]
        spark.createDataFrame(rows, "row long, key string, ts timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    for mode in ("exact", "settled"):
        read = spark.readStream.schema("row long, key string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        stream = rl.stream_dedupe(read, "key", "ts", "row", 10, "1 hour", mode)
        query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/{mode}").option("checkpointLocation", f"{tmp_path}/{mode}-progress").trigger(availableNow=True).start()
        query.awaitTermination()
        assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 3 * cs.BUCKETS < n
        if mode == "exact":
            assert sorted(r["row"] for r in spark.read.parquet(f"{tmp_path}/{mode}").collect()) == list(range(n))
