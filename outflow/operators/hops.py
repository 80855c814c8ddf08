"""Greedy hops through lines of times: each kept time silences those less than a step later.

Which rows of a line are kept depends on all rows before, but only through one
number, the time kept last.  A line of up to ``ROWS`` rows is read by one task,
from end to end.  A longer one is cut into stretches of about so many rows,
whatever time they span, that tasks read apart from each other:

1. every stretch says, for each time kept last that may come in from before,
   which time it will hand on: a step function that only grows, with one step for
   each row inside the first ``step`` of time at most;
2. these functions are followed along each line, one after the other: a task
   reads them as a stream and holds one number;
3. every stretch, now knowing what comes in, marks the rows it keeps.

No task holds more than a stretch, however hot a key and however crowded its
rows; rows carry ids and times only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outflow.sources.tables import staged

#: Rows of one stretch.
ROWS = 1_000_000
#: A time kept last that silences nothing.
NEVER = -(1 << 62)
_ALWAYS = (1 << 63) - 1


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted batches joined and cut so that no (_line, _part) is torn."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = (batch.column("_line")[-1].as_py(), batch.column("_part")[-1].as_py())
        begins = (batch.column("_line")[0].as_py(), batch.column("_part")[0].as_py())
        if held and begins == last == ends:
            held.append(batch)
            continue
        table = pa.Table.from_batches([*held, batch])
        group, first = _groups(table)
        cut = int(first[-1])
        if cut:
            yield table.slice(0, cut)
        held, last = table.slice(cut).to_batches(), ends
    if held:
        yield pa.Table.from_batches(held)


def _groups(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Number of each row's (_line, _part), and where each begins."""
    line = np.asarray(table["_line"].combine_chunks().dictionary_encode(null_encoding="encode").indices)
    part = np.asarray(table["_part"])
    fresh = np.ones(len(part), bool)
    fresh[1:] = (line[1:] != line[:-1]) | (part[1:] != part[:-1])
    return np.cumsum(fresh) - 1, np.flatnonzero(fresh)


class _Rows:
    """Rows of whole groups in order, and where a hop from each lands."""

    def __init__(self, group: np.ndarray, first: np.ndarray, times: np.ndarray, forced: np.ndarray, step: int):
        n = len(times)
        self.group, self.first, self.times, self.step = group, first, times, step
        self.ends = np.append(first[1:], n)
        self.base = times[first] if n else times
        past = times - self.base[group]
        self.width = int(past.max()) + 2 if n else 2
        self.spread = group * self.width + past
        at = np.where(forced, np.arange(n), n)
        self.forced = np.minimum.accumulate(at[::-1])[::-1] if n else at  # the next forced row, this one included
        ahead = np.append(self.forced[1:], n)
        self.next = np.minimum(self.land(group, times + step), np.minimum(ahead, self.ends[group]))

    def land(self, group: np.ndarray, least: np.ndarray) -> np.ndarray:
        """First row of each group at ``least`` or later; its end if there is none."""
        # Compared before subtracting, as the least may be far below any time.
        past = np.where(least <= self.base[group], 0, np.minimum(np.maximum(least, self.base[group]) - self.base[group], self.width - 1))
        return np.minimum(np.searchsorted(self.spread, group * self.width + past), self.ends[group])

    def enter(self, group: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The row that each group keeps first when ``last`` was kept before."""
        forced = np.append(self.forced, len(self.times))[self.first[group]]
        return np.minimum(self.land(group, last + self.step), np.minimum(forced, self.ends[group]))


def _answers(step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            group, first = _groups(table)
            times, forced = np.asarray(table["_at"]), np.asarray(table["_forced"].combine_chunks().cast("int8")).astype(bool)
            rows = _Rows(group, first, times, forced, step)
            each = np.arange(len(first))
            # What comes in is no later than the first row, so what lies a step behind that decides nothing.
            upto = np.minimum(rows.land(each, times[first] + step), np.append(rows.forced, len(times))[first])
            upto = np.minimum(upto + 1, rows.ends)
            many = upto - first
            row = np.arange(int(many.sum())) + np.repeat(first - (np.cumsum(many) - many), many)
            final = np.where(rows.next < rows.ends[group], rows.next, np.arange(len(times)))
            while True:
                further = final[final]
                if (further == final).all():
                    break
                final = further
            leaves = times[final[row]]
            apart = np.ones(len(row), bool)
            apart[:-1] = (group[row][1:] != group[row][:-1]) | (leaves[1:] != leaves[:-1])
            row, leaves = row[apart], leaves[apart]
            bound = np.where(forced[row], _ALWAYS, times[row])
            yield pa.RecordBatch.from_arrays(
                [table["_line"].take(pa.array(row)).combine_chunks(), table["_part"].take(pa.array(row)).combine_chunks(), pa.array(times[first][group[row]]), table["_start"].take(pa.array(row)).combine_chunks(), pa.array(bound), pa.array(leaves)],
                names=["_line", "_part", "_first", "_start", "_upto", "_leaves"],
            )

    return run


def _chain(step: int):
    """What comes into each stretch; batches are sorted by line, stretch and _upto, and only one number is carried on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: tuple | None = None
        last, leaves, settled = 0, 0, False
        for batch in batches:
            if not batch.num_rows:
                continue
            _, first = _groups(pa.Table.from_batches([batch]))
            ends = np.append(first[1:], batch.num_rows)
            upto, out = np.asarray(batch.column("_upto")), np.asarray(batch.column("_leaves"))
            names = [batch.column(c).take(pa.array(first)).to_pylist() for c in ("_line", "_part", "_first", "_start")]
            lines, parts, enters = [], [], []
            for line, part, begin, start, a, z in zip(*names, first.tolist(), ends.tolist(), strict=True):
                if here != (line, part):
                    if here is None or here[0] != line:
                        last = begin if start is None else min(start, begin)
                    elif settled:
                        last = leaves
                    here, settled = (line, part), False
                    lines.append(line)
                    parts.append(part)
                    enters.append(last)
                if not settled:
                    k = a + int(np.searchsorted(upto[a:z], last + step))
                    if k < z:
                        leaves, settled = int(out[k]), True
            yield pa.RecordBatch.from_arrays([pa.array(lines, batch.schema.field("_line").type), pa.array(parts, pa.int64()), pa.array(enters, pa.int64())], names=["_line", "_part", "_at"])

    return run


def _kept(rows: _Rows, enters: np.ndarray, forced: np.ndarray) -> np.ndarray:
    """Which rows are kept when each group is entered with a time kept last."""
    kept = forced.copy()
    front = np.concatenate([rows.enter(np.arange(len(enters)), enters), np.where(forced, rows.next, len(kept))[forced]])
    owner = np.concatenate([np.arange(len(enters)), rows.group[forced]])
    while len(front):
        inside = front < rows.ends[owner]
        front, owner = front[inside], owner[inside]
        fresh = ~kept[front]
        front, owner = front[fresh], owner[fresh]
        kept[front] = True
        front = rows.next[front]
    return kept


def greedy(line: np.ndarray, times: np.ndarray, last: np.ndarray, step: int) -> np.ndarray:
    """Which rows of sorted lines are kept when each line is entered with a time kept last (``NEVER``: none)."""
    n = len(line)
    if not n:
        return np.zeros(0, bool)
    first = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
    ends = np.append(first[1:], n)
    kept = np.zeros(n, bool)
    # As many lines at once as leave room for their times side by side.
    most = max(1, (1 << 61) // (int((times[ends - 1] - times[first]).max()) + 2))
    for k in range(0, len(first), most):
        a, z = first[k], ends[min(k + most, len(first)) - 1]
        begins = first[k : k + most] - a
        rows = _Rows(np.repeat(np.arange(len(begins)), np.diff(np.append(begins, z - a))), begins, times[a:z], np.zeros(z - a, bool), step)
        kept[a:z] = _kept(rows, last[k : k + most], np.zeros(z - a, bool))
    return kept


def _marks(step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            group, _ = _groups(table)
            entry = np.asarray(table["_entry"].combine_chunks().cast("int8")).astype(bool)
            enters = np.asarray(table["_at"])[entry]  # one a group, its first row
            lean = table.filter(pa.array(~entry))
            group = group[~entry]
            times, forced = np.asarray(lean["_at"]), np.asarray(lean["_forced"].combine_chunks().cast("int8")).astype(bool)
            rows = _Rows(group, np.searchsorted(group, np.arange(len(enters))), times, forced, step)
            yield from lean.select(["_line", "_row"]).filter(pa.array(_kept(rows, enters, forced))).to_batches()

    return run


def _fold(step: int):
    """Marks sorted rows batch by batch: only the last line's last kept time is carried on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, last = None, 0  # the line read last, in a list as it may be null, and its time
        for batch in batches:
            if not batch.num_rows:
                continue
            line = batch.column("_line").dictionary_encode(null_encoding="encode").indices
            codes = np.asarray(line)
            first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
            group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(codes))))
            times, forced = np.asarray(batch.column("_at")), np.asarray(batch.column("_forced").cast("int8")).astype(bool)
            start = np.asarray(batch.column("_start").fill_null(_ALWAYS))[first]
            enters = np.minimum(start, times[first])
            if here == [batch.column("_line")[0].as_py()]:
                enters[0] = last
            rows = _Rows(group, first, times, forced, step)
            kept = _kept(rows, enters, forced)
            mine = np.flatnonzero(kept[first[-1] :])
            last = int(times[first[-1] + mine[-1]]) if len(mine) else int(enters[-1])
            here = [batch.column("_line")[-1].as_py()]
            yield batch.select(["_line", "_row"]).filter(pa.array(kept))

    return run


def folded(lines: DataFrame, step: int) -> DataFrame:
    """What ``hops`` gives, with each line read by one task from end to end in flat memory: for lines of bounded length, as those of one micro-batch."""
    kind = lambda c: lines.schema[c].dataType.simpleString()
    ordered = lines.select("_line", "_row", "_at", "_forced", "_start").repartition("_line").sortWithinPartitions("_line", "_at", "_row")
    return ordered.mapInArrow(_fold(step), f"_line {kind('_line')}, _row {kind('_row')}")


def hops(lines: DataFrame, step: int, rows: int = ROWS) -> DataFrame:
    """(_line, _row) of the rows kept: forced ones, and those a step or more after the last kept.

    ``lines``: _line, _row, _at (a whole number), _forced and _start, the time
    that counts as kept before a line's first row (null: that row's own time).
    Rows of a line go by (_at, _row).  ``lines`` is read twice, and what the few
    lines with more than ``rows`` rows hold is written once to the shared folder.
    """
    long = staged(lines.groupBy("_line").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows).withColumnRenamed("_line", "_hot"), "long-lines")
    total = long.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()["n"]
    if not total:
        return folded(lines, step)
    met = F.col("_line").eqNullSafe(F.col("_hot"))
    kind = lambda c: lines.schema[c].dataType.simpleString()
    hot = lines.select("_line", "_row", "_at", "_forced", "_start").join(long, met, "left_semi")
    # Ranges of (line, time, row), so that a stretch is one task's share.
    dealt = hot.repartitionByRange(max(2, -(-total // rows)), "_line", "_at", "_row").withColumn("_part", F.spark_partition_id().cast("long"))
    cut = staged(dealt, "stretches")
    stretches = cut.repartition("_line", "_part").sortWithinPartitions("_line", "_part", "_at", "_row")
    answers = stretches.select("_line", "_part", "_at", "_forced", "_start").mapInArrow(_answers(step), f"_line {kind('_line')}, _part long, _first long, _start long, _upto long, _leaves long")
    chained = answers.repartition("_line").sortWithinPartitions("_line", "_part", "_upto").mapInArrow(_chain(step), f"_line {kind('_line')}, _part long, _at long")
    entries = chained.select("_line", F.lit(None).cast(kind("_row")).alias("_row"), "_at", F.lit(False).alias("_forced"), "_part", F.lit(True).alias("_entry"))
    both = cut.select("_line", "_row", "_at", "_forced", "_part", F.lit(False).alias("_entry")).unionByName(entries)
    ordered = both.repartition("_line", "_part").sortWithinPartitions("_line", "_part", F.col("_entry").desc(), "_at", "_row")
    marked = ordered.mapInArrow(_marks(step), f"_line {kind('_line')}, _row {kind('_row')}")
    return folded(lines.join(long, met, "left_anti"), step).unionByName(marked)
