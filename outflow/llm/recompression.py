"""Substring de-duplication by recompression (operator 1).

Each round names maximal runs of one symbol and then pairs whose left and right
members fall in opposite halves of the alphabet.  A name is a 64-bit hash of
what it stands for, so every document proposes the same name for the same
content.  A symbol's *context* is the stretch of words that decides how it was
formed: whoever sees those words sees the symbol.

Every window takes as anchor the least-named symbol, of the highest level that
has one, whose context lies inside it; equal windows therefore have equal
anchors.  Spark agrees on names level by level: one table holds all anchors
with their levels, a group-by over (level, name) finds the names that several
places share, and only windows behind a shared name go on:

* occurrences whose whole served stretch repeats are settled stretch by stretch
  (one record for about seven windows), the earliest staying;
* of stretches that share an anchor but differ, the earliest copy of each is
  compared window by window.

Neighbouring windows with neighbouring originals are then one run, and the
words of a run are verified against those of its original: a digest of the
original's words, taken once however many copies there are, is compared with
that of the copy's.  Only verified runs are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outflow.llm import bytewords as bw
from outflow.llm.shared import identified, staged, unstage

WINDOW = 20


def rounds_for(window: int) -> int:
    """Most rounds whose typical context still fits in half a window."""
    size, reach, rounds = 1.0, 0.0, 0
    while True:
        reach, size = reach + size, size * 4 / 3
        if size + 2 * reach > max(window * 0.55, 3.4):
            return max(rounds, 1)
        rounds += 1


class Symbols:
    """One round's symbols of all documents of a batch, in text order.

    ``begin``/``end``: words covered; ``left``/``right``: context, one word past
    the document's edge where the edge itself decided.
    """

    def __init__(self, name, begin, end, left, right, head, tail):
        self.name, self.begin, self.end = name, begin, end
        self.left, self.right, self.head, self.tail = left, right, head, tail

    @classmethod
    def of_words(cls, names: np.ndarray, word_offsets: np.ndarray) -> Symbols:
        n = len(names)
        at = np.arange(n)
        head, tail = np.zeros(n, bool), np.zeros(n, bool)
        full = word_offsets[1:] > word_offsets[:-1]
        head[word_offsets[:-1][full]] = True
        tail[word_offsets[1:][full] - 1] = True
        return cls(names, at, at + 1, at, at + 1, head, tail)

    def next_round(self, number: int) -> Symbols:
        n = len(self.name)
        same = np.zeros(n, bool)
        same[1:] = (self.name[1:] == self.name[:-1]) & ~self.head[1:]
        first = np.flatnonzero(~same)
        last = np.append(first[1:], n) - 1
        length = last - first + 1
        base = self.name[first]
        run = np.where(length > 1, bw.mix64(base ^ bw.mix64(length.astype(np.uint64))), base)
        # Pairs: the left half of the alphabet followed by the right half.
        side = (bw.mix64(base + np.uint64(number)) >> np.uint64(63)).astype(bool)
        joins = np.zeros(len(first), bool)
        joins[:-1] = ~side[:-1] & side[1:] & ~self.tail[last[:-1]]
        lead = np.ones(len(first), bool)
        lead[1:] = ~joins[:-1]
        lead_at = np.flatnonzero(lead)
        end_at = lead_at + joins[lead_at]
        pair = bw.mix64(run[lead_at] * np.uint64(0xC2B2AE3D27D4EB4F) + bw.mix64(run[end_at]))
        name = np.where(joins[lead_at], pair, run[lead_at])
        a, z = first[lead_at], last[end_at]
        head, tail = self.head[a], self.tail[z]
        left = np.where(head, self.begin[a] - 1, self.left[np.maximum(a - 1, 0)])
        right = np.where(tail, self.end[z] + 1, self.right[np.minimum(z + 1, n - 1)])
        return Symbols(name, self.begin[a], self.end[z], left, right, head, tail)


def _least(rank: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Leftmost index of the least rank in low..high, both included, for each pair."""
    span = high - low + 1
    step = np.floor(np.log2(span)).astype(np.int64)
    out = np.empty(len(low), np.int64)
    table = np.arange(len(rank))
    for j in range(int(step.max()) + 1 if len(step) else 0):
        if j:
            half = 1 << (j - 1)
            x, y = table[: len(table) - half], table[half:]
            table = np.where(rank[x] <= rank[y], x, y)
        mine = np.flatnonzero(step == j)
        if len(mine):
            x, y = table[low[mine]], table[high[mine] - (1 << j) + 1]
            out[mine] = np.where(rank[x] <= rank[y], x, y)
    return out


def window_anchors(names: np.ndarray, word_offsets: np.ndarray, window: int, rounds: int):
    """Stretches of consecutive windows with one anchor.

    Returns the document index, first window start (in the document), number of
    windows, anchor key, the hash of the whole stretch, and the anchor's level
    (0: no symbol is settled inside, the window is its own anchor).
    """
    n = len(names)
    docs = np.repeat(np.arange(len(word_offsets) - 1), np.diff(word_offsets))
    at = np.arange(n)
    starts = at[at + window <= word_offsets[1:][docs]] if n else at
    empty = np.zeros(0, np.int64)
    if not len(starts):
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64), empty
    prefix = bw.PrefixHash(names)
    levels = [Symbols.of_words(names, word_offsets)]
    for number in range(1, rounds + 1):
        levels.append(levels[-1].next_round(number))
    key = np.zeros(len(starts), np.uint64)
    spot = np.full(len(starts), -1)
    todo = np.arange(len(starts))
    for level in range(rounds, 0, -1):
        s = levels[level]
        # The symbols whose context is inside a window are consecutive.
        before = np.cumsum(np.bincount(s.left + 1, minlength=n + 2))  # before[a]: symbols with left < a
        until = np.cumsum(np.bincount(s.right, minlength=n + 2))  # until[e]: symbols with right <= e
        low, high = before[starts[todo]], until[starts[todo] + window] - 1
        has = high >= low
        mine = todo[has]
        if len(mine):
            context = prefix.slices(np.maximum(s.left, 0), np.minimum(s.right, n))
            rank = bw.mix64(context + np.uint64(level))
            chosen = _least(rank, low[has], high[has])
            key[mine] = rank[chosen]
            spot[mine] = s.begin[chosen] * (rounds + 1) + level
        todo = todo[~has]
        if not len(todo):
            break
    if len(todo):  # no symbol is settled inside it: the window is its own anchor
        key[todo] = bw.mix64(prefix.slices(starts[todo], starts[todo] + window))
        spot[todo] = -2 - starts[todo]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (spot[1:] != spot[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(fresh)
    count = np.diff(np.append(first, len(starts)))
    begin = starts[first]
    where = np.where(spot[first] >= 0, spot[first] // (rounds + 1) - begin, 0)
    whole = prefix.slices(begin, begin + count - 1 + window)
    whole = bw.mix64(whole ^ bw.mix64((where * 4096 + count).astype(np.uint64)))
    d = docs[begin]
    return d, begin - word_offsets[d], count, key[first], whole, np.where(spot[first] >= 0, spot[first] % (rounds + 1), 0)


def _words_of(batch: pa.RecordBatch) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    buf, offsets = bw.text_bytes(batch.column("text"))
    return buf, *bw.split_words(buf, offsets)


def anchor_rows(docs: DataFrame, window: int) -> DataFrame:
    """(rid, start, count, level, name, whole) for every stretch of windows of every document."""
    rounds = rounds_for(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for batch in bw.row_slices(whole_batch, "text"):
                rid = np.asarray(batch.column("_rid"))
                buf, starts, ends, words = _words_of(batch)
                names = bw.hash_spans(buf, starts, ends)
                d, begin, count, key, whole, level = window_anchors(names, words, window, rounds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid[d]), pa.array(begin.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(level.astype(np.int8)), pa.array(key.view(np.int64)), pa.array(whole.view(np.int64))],
                    names=["rid", "start", "count", "level", "name", "whole"],
                )

    return docs.select("_rid", "text").mapInArrow(run, "rid long, start int, count int, level byte, name long, whole long")


def shared_names(anchors: DataFrame) -> DataFrame:
    """(level, name): the names of every level that several places share."""
    return anchors.groupBy("level", "name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("level", "name")


def _window_rows(texts: DataFrame, stretches: DataFrame, window: int) -> DataFrame:
    """(rid, start, level, name, value): one row for each window of the given stretches."""
    lists = stretches.groupBy("rid").agg(F.collect_list(F.struct("start", "count", "level", "name")).alias("parts"))
    joined = texts.join(lists, texts["_rid"] == lists["rid"]).select("_rid", "text", "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for batch in bw.row_slices(whole_batch, "text"):
                buf, starts, ends, words = _words_of(batch)
                prefix = bw.PrefixHash(bw.hash_spans(buf, starts, ends, seed=7))
                parts = batch.column("parts")
                flat = parts.flatten()
                row = np.repeat(np.arange(batch.num_rows), np.asarray(pa.compute.list_value_length(parts)))
                start, count = np.asarray(flat.field("start")), np.asarray(flat.field("count"))
                which = np.repeat(np.arange(len(row)), count)
                step = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
                begin = words[row[which]] + start[which] + step
                at = pa.array(which)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.asarray(batch.column("_rid"))[row[which]]), pa.array((start[which] + step).astype(np.int32)), flat.field("level").take(at), flat.field("name").take(at), pa.array(prefix.slices(begin, begin + window).view(np.int64))],
                    names=["rid", "start", "level", "name", "value"],
                )

    return joined.mapInArrow(run, "rid long, start int, level byte, name long, value long")


def _earliest() -> Column:
    return F.min(F.struct("rid", "start")).alias("first")


def _original() -> tuple[Column, Column]:
    return F.col("first.rid").alias("src"), F.col("first.start").alias("src_start")


def repeated_stretches(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(rid, start, count, src, src_start): windows ``start .. start+count-1`` that also begin at an earlier place.

    ``docs`` has ``_rid`` (unique, ordering the documents) and ``text``.  Tables
    that meet are staged first: in plain joins Spark can split a hot name.
    """
    texts = docs.select("_rid", "text")
    anchors = staged(anchor_rows(texts, window), "anchors")
    names = staged(shared_names(anchors), "names")
    known = staged(anchors.join(names, ["level", "name"]), "repeats")
    unstage(anchors, names)
    groups = staged(known.groupBy("level", "name", "whole").agg(_earliest(), F.first("count").alias("count"), F.count(F.lit(1)).alias("n")), "stretches")
    of_group = ["level", "name", "whole"]
    later = known.join(groups.where("n > 1").select(*of_group, "first"), of_group).where(F.struct("rid", "start") != F.col("first"))
    later = staged(later.select("rid", "start", "count", *_original()), "later")
    unstage(known)
    differ = groups.groupBy("level", "name").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("level", "name")
    kept = staged(groups.join(staged(differ, "differ"), ["level", "name"]).select(F.col("first.rid").alias("rid"), F.col("first.start").alias("start"), "count", "level", "name"), "kept")
    unstage(groups)
    windows = staged(_window_rows(texts, kept, window), "windows")
    of_window = ["level", "name", "value"]
    earliest = staged(windows.groupBy(*of_window).agg(_earliest(), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "earliest")
    single = windows.join(earliest, of_window).where(F.struct("rid", "start") != F.col("first"))
    single = staged(single.select("rid", "start", F.lit(1).alias("count"), *_original()), "single")
    unstage(kept, windows, earliest)
    both = later.unionByName(single)
    both.staged_at = [*later.staged_at, *single.staged_at]
    return both


def joined_runs(cover: DataFrame) -> DataFrame:
    """(rid, start, count, src, src_start): neighbouring windows with neighbouring originals as one run."""
    lists = cover.groupBy("rid").agg(F.collect_list(F.struct("start", "count", "src", "src_start")).alias("parts"))
    kinds = {"rid": np.int64, "start": np.int32, "count": np.int32, "src": np.int64, "src_start": np.int32}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("parts")
            flat = parts.flatten()
            rid = np.repeat(np.asarray(batch.column("rid")), np.asarray(pa.compute.list_value_length(parts)))
            start, count, src, at = (np.asarray(flat.field(c)).astype(np.int64) for c in ("start", "count", "src", "src_start"))
            order = np.lexsort((start, at - start, src, rid))
            rid, start, count, src, at = (x[order] for x in (rid, start, count, src, at))
            fresh = np.ones(len(rid), bool)
            fresh[1:] = (rid[1:] != rid[:-1]) | (src[1:] != src[:-1]) | (at[1:] - start[1:] != at[:-1] - start[:-1]) | (start[1:] > start[:-1] + count[:-1])
            first = np.flatnonzero(fresh)
            many = np.maximum.reduceat(start + count, first) - start[first] if len(first) else start
            found = (rid[first], start[first], many, src[first], at[first])
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(t)) for x, t in zip(found, kinds.values(), strict=True)], names=list(kinds))

    return lists.mapInArrow(run, "rid long, start int, count int, src long, src_start int")


def _digest(data: bytes, starts: np.ndarray, ends: np.ndarray, begin: int, end: int) -> bytes:
    """Digest of words begin..end-1, one space between."""
    words = [data[x:y] for x, y in zip(starts[begin:end].tolist(), ends[begin:end].tolist(), strict=True)]
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def original_words(texts: DataFrame, spans: DataFrame, window: int) -> DataFrame:
    """(src, src_start, count, words): a digest of the words of each span of windows of an original."""
    lists = spans.groupBy("src").agg(F.collect_list(F.struct("src_start", "count")).alias("parts"))
    joined = texts.join(lists, texts["_rid"] == lists["src"]).select("src", "text", "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for batch in bw.row_slices(whole_batch, "text"):
                buf, starts, ends, words = _words_of(batch)
                data = buf.tobytes()
                parts = batch.column("parts")
                flat = parts.flatten()
                row = np.repeat(np.arange(batch.num_rows), np.asarray(pa.compute.list_value_length(parts)))
                begin = words[row] + np.asarray(flat.field("src_start"))
                end = begin + np.asarray(flat.field("count")) - 1 + window
                made = [_digest(data, starts, ends, a, z) for a, z in zip(begin.tolist(), end.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("src").take(pa.array(row)), flat.field("src_start"), flat.field("count"), pa.array(made, pa.binary())], names=["src", "src_start", "count", "words"])

    return joined.mapInArrow(run, "src long, src_start int, count int, words binary")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Remove every word covered by a window of words that also starts earlier.

    ``docs`` needs ``doc_id`` and ``text``; more columns are ignored, whatever
    their names.  A null or empty text has no words and keeps none.  Null ids
    come first; rows that share an id are separate documents, ordered by a hash
    of their text; of fully equal rows one counts as the earlier.  An empty
    table gives an empty result.  Texts are read whole, however long.

    Returns doc_id, n_words, n_removed, kept (the words left, joined by one
    space) and kept_sha256.
    """
    rows = identified(docs, "text")
    texts = rows.select("_rid", "text")
    cover = repeated_stretches(rows, window)
    runs = staged(joined_runs(cover), "runs")
    unstage(cover)
    spans = runs.select("src", "src_start", "count").distinct()
    words = staged(original_words(texts, spans, window), "words")
    checked = runs.join(words, ["src", "src_start", "count"]).select("rid", "start", "count", "words")
    lists = staged(checked.groupBy("rid").agg(F.collect_list(F.struct("start", "count", "words")).alias("parts")), "checked")
    unstage(runs, words)
    joined = rows.select("_rid", "text", "doc_id").join(lists, rows["_rid"] == lists["rid"], "left").select("doc_id", "text", "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for batch in bw.row_slices(whole_batch, "text"):
                buf, starts, ends, words = _words_of(batch)
                data = buf.tobytes()
                totals, removed, kept, digests = [], [], [], []
                for i, parts in enumerate(batch.column("parts").to_pylist()):
                    a, z = int(words[i]), int(words[i + 1])
                    gone = np.zeros(z - a + 1, np.int64)
                    for p in parts or []:
                        begin, end = p["start"], p["start"] + p["count"] - 1 + window
                        if _digest(data, starts, ends, a + begin, a + end) == p["words"]:
                            gone[begin] += 1
                            gone[end] -= 1
                    stay = np.cumsum(gone)[: z - a] == 0
                    left = b" ".join([data[x:y] for x, y in zip(starts[a:z][stay].tolist(), ends[a:z][stay].tolist(), strict=True)])
                    totals.append(z - a)
                    removed.append(z - a - int(stay.sum()))
                    kept.append(left.decode("utf-8"))
                    digests.append(hashlib.sha256(left).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), pa.array(digests, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"],
                )

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
