"""Sets of global transaction ids as interval tables (uuid, start, end), ends included."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Numbers in one first-phase stretch; a busy server's ids spread over many.
STRETCH = 1_000_000


def parse_gtid_set(text: Column) -> Column:
    """``uuid:1-7:9,uuid2:3`` to an array of (uuid, start, end)."""

    def of_server(part: Column) -> Column:
        cells = F.split(F.trim(part), ":")
        bounds = lambda c: F.split(F.trim(c), "-")
        return F.transform(
            F.slice(cells, F.lit(2), F.size(cells)),
            lambda c: F.struct(
                F.lower(F.trim(cells[0])).alias("uuid"), bounds(c)[0].cast("long").alias("start"), F.coalesce(F.get(bounds(c), F.lit(1)), bounds(c)[0]).cast("long").alias("end")
            ),
        )

    parts = F.filter(F.split(text, ","), lambda p: F.trim(p) != "")
    return F.coalesce(F.flatten(F.transform(parts, of_server)), F.array().cast("array<struct<uuid:string,start:bigint,end:bigint>>"))


def _islands(intervals: DataFrame, keys: list[str]) -> DataFrame:
    order = W.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    fresh = (reach.isNull() | (F.col("start") > reach + 1)).cast("long")
    marked = intervals.withColumn("_fresh", fresh).withColumn("_island", F.sum("_fresh").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def gtid_union(intervals: DataFrame, keys: tuple[str, ...] = (), stretch: int = STRETCH) -> DataFrame:
    """Fewest intervals that cover the same ids, per ``keys`` and uuid.

    First inside stretches of ids, so that one server's billions of ids spread;
    then over the few intervals that are left.
    """
    every = [*keys, "uuid"]
    first = _islands(intervals.select(*every, "start", "end").withColumn("_stretch", F.floor(F.col("start") / stretch)), [*every, "_stretch"]).drop("_stretch")
    return _islands(first, every)


def format_gtid_set(intervals: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, gtid_set): normalised intervals as text, servers and ids in order.  For small sets."""
    cell = F.when(F.col("start") == F.col("end"), F.col("start").cast("string")).otherwise(F.concat_ws("-", "start", "end"))
    cells = F.transform(F.array_sort(F.collect_list(F.struct("start", cell.alias("cell")))), lambda c: c["cell"])
    servers = gtid_union(intervals, keys).groupBy(*keys, "uuid").agg(F.concat_ws(":", F.first("uuid"), F.array_join(cells, ":")).alias("server"))
    listed = F.array_join(F.array_sort(F.collect_list("server")), ",").alias("gtid_set")
    return servers.groupBy(*keys).agg(listed)


def gtid_contains(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, contained): whether each set of ``b`` lies in the set of ``a`` with the same keys.

    Both are normalised first, so an interval of ``b`` must lie in the single
    interval of ``a`` that starts last at or before it: found by one ordered pass
    over both, not by pairing them.
    """
    every = [*keys, "uuid"]
    both = gtid_union(a, keys).select(*every, "start", "end", F.lit(0).alias("_b")).unionByName(gtid_union(b, keys).select(*every, "start", "end", F.lit(1).alias("_b")))
    order = W.partitionBy(*every).orderBy("start", "_b").rowsBetween(W.unboundedPreceding, 0)
    reach = F.max(F.when(F.col("_b") == 0, F.col("end"))).over(order)
    inside = F.coalesce(F.col("end") <= reach, F.lit(False))
    return both.withColumn("_in", inside).where("_b = 1").groupBy(*keys).agg(F.bool_and("_in").alias("contained"))


def _next_point(seen: DataFrame, points: DataFrame, keys: list[str], stride: int) -> DataFrame:
    """``seen`` with ``_from``, the first point at its line or later; what none follows is left out.

    Looked up inside stretches of lines, and from one row for each later stretch.
    """
    part = F.floor(F.col("line") / stride).cast("long")
    marks = points.select(*keys, F.col("row").alias("line"), F.lit(None).cast("string").alias("uuid"), F.lit(None).cast("long").alias("gno"), F.col("row").alias("_point"))
    both = seen.select(*keys, "line", "uuid", "gno", F.lit(None).cast("long").alias("_point")).unionByName(marks).withColumn("_part", part)
    ahead = W.partitionBy(*keys, "_part").orderBy("line").rangeBetween(W.currentRow, W.unboundedFollowing)
    later = W.partitionBy(*keys).orderBy("_part").rowsBetween(1, W.unboundedFollowing)
    firsts = both.groupBy(*keys, "_part").agg(F.min("_point").alias("_first"))
    firsts = firsts.select(*keys, "_part", F.min("_first").over(later).alias("_later"))
    found = both.withColumn("_here", F.min("_point").over(ahead)).where("gno is not null").join(firsts, [*keys, "_part"])
    return found.withColumn("_from", F.coalesce("_here", "_later")).where("_from is not null").select(*keys, "uuid", F.col("gno").alias("start"), F.col("gno").alias("end"), "_from")


def _lives(start: np.ndarray, end: np.ndarray, since: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(start, end, from, until) of every interval that is whole at some time, of spans that each hold from a time on."""
    edges = np.unique(np.concatenate([start, end + 1]))
    held = np.full(len(edges), _NEVER)
    for k in np.argsort(since, kind="stable")[::-1]:  # of several spans over an id the earliest counts
        held[np.searchsorted(edges, start[k]) : np.searchsorted(edges, end[k] + 1)] = since[k]
    # Cells of ids one after another; one that is never held parts its neighbours.  A cell is the
    # last to come into exactly one interval: as far as the cells on both sides came before it.
    out, stack = [], []
    n = len(edges) - 1
    left, right = np.zeros(n, np.int64), np.full(n, n)
    for k in range(n):
        while stack and held[stack[-1]] <= held[k]:
            stack.pop()
        left[k] = stack[-1] if stack else -1
        stack.append(k)
    stack = []
    for k in range(n - 1, -1, -1):
        while stack and held[stack[-1]] < held[k]:
            stack.pop()
        right[k] = stack[-1] if stack else n
        stack.append(k)
    for k in range(n):
        # Of equal neighbours inside one interval the last cell tells it.
        if held[k] == _NEVER or (right[k] < n and held[right[k]] == held[k]):
            continue
        a, z = int(left[k]), int(right[k])
        until = min(int(held[a]) if a >= 0 else _NEVER, int(held[z]) if z < n else _NEVER)
        out.append((int(edges[a + 1]), int(edges[z]) - 1, int(held[k]), until))
    return out


_NEVER = (1 << 63) - 1
_ALWAYS = -(1 << 63)


def gtid_sets_at(seen: DataFrame, points: DataFrame, begun: DataFrame, keys: tuple[str, ...] = (), stride: int = STRETCH) -> DataFrame:
    """(keys, row, uuid, start, end): the set as of every point, of all points at once.

    ``seen``: keys, line, uuid, gno; ``points``: keys and row, a line; ``begun``:
    keys, uuid, start, end.  A point's set is what was begun with and all seen up
    to its line.  Ids are first joined to intervals that come in between the same
    two points.  Of these, one sweep makes every interval that is ever whole,
    with the point from which it holds and the one that makes it part of a larger:
    as many as there were pieces, however many points there are.  Points then
    meet the intervals that hold at them; no set is made anew for a point.
    """
    every = list(keys)
    spans = gtid_union(_next_point(seen, points, every, stride), (*keys, "_from"), stride)
    whole = spans.unionByName(gtid_union(begun, keys, stride).withColumn("_from", F.lit(_ALWAYS)))
    kinds = ", ".join([f"{c} {whole.schema[c].dataType.simpleString()}" for c in every] + ["uuid string, start long, end long, _from long, _until long"])

    def sweep(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = _lives(pdf["start"].to_numpy(np.int64), pdf["end"].to_numpy(np.int64), pdf["_from"].to_numpy(np.int64))
        out = pd.DataFrame(rows, columns=["start", "end", "_from", "_until"])
        for c in [*every, "uuid"]:
            out[c] = pdf[c].iloc[0]
        return out[[*every, "uuid", "start", "end", "_from", "_until"]]

    lives = whole.groupBy(*every, "uuid").applyInPandas(sweep, kinds)
    asked = points.select(*[F.col(c).alias(f"_{c}") for c in every], "row").distinct()
    same = (F.col("row") >= F.col("_from")) & (F.col("row") < F.col("_until"))
    for c in every:
        same = (F.col(c) == F.col(f"_{c}")) & same
    return asked.join(lives, same).select(*every, "row", "uuid", "start", "end")
