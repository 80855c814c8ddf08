"""Benchmark decontamination by edit-distance embedding (operator 5).

Texts are compared as words (letters and digits, A-Z lowered).  A random walk
(CGK) embeds a window of words: step j writes the current word and then moves on
or stays by a bit drawn from (j, word), so that few edits make few differing
positions.  Each of several independent repeats samples a few positions of the
embedding into a key; items are indexed by the same keys, and a window sharing
one is verified by exact word edit distance.

Windows have the sizes of the items, on a geometric grid.  They are placed
wherever they can matter: an item within ``similarity`` of a stretch shares a
whole run of ``run_length`` words with it (e edits cut an item into at most e+1
pieces), and its start lies within e words of where that run puts it.  Windows
that begin elsewhere can't hold an item and are skipped, losing none.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outflow.llm import bytewords as bw
from outflow.llm.shared import staged

SIMILARITY = 0.8
#: Repeats and samples of each, the samples among the first REACH x size steps.
REPEATS, SAMPLES, REACH = 48, 2, 1.2
GRID = 1.08
#: Items, and bytes of their texts, that are broadcast at a time and indexed by a worker; more are more passes over the text.
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 32 << 20
MIN_WORDS = 5

_FOLD = np.full(256, 32, np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def folded_words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and the word offsets of each row."""
    buf = _FOLD[buf]
    starts, ends, words = bw.split_words(buf, offsets)
    return bw.hash_spans(buf, starts, ends, seed=3), words


def allowed_edits(n_words: int, similarity: float = SIMILARITY) -> int:
    """Word edits an item of so many words may show; short items must be exact."""
    return int(math.floor((1 - similarity) * n_words + 1e-9)) if n_words >= MIN_WORDS else 0


def run_length(n_words: int, edits: int) -> int:
    """Words that some untouched run has at least."""
    return max(1, -(-(n_words - edits) // (edits + 1)))


def size_class(n_words: int) -> int:
    """The grid size that stands for an item size."""
    return max(1, round(GRID ** round(math.log(n_words, GRID))))


def embed_keys(names: np.ndarray, starts: np.ndarray, size: int, limits: np.ndarray) -> np.ndarray:
    """LSH keys (windows x REPEATS) of the windows ``names[start : start+size]``.

    A window ends at ``limits`` (its document's end) at the latest; past the end
    the walk writes a blank.
    """
    steps = max(SAMPLES, round(REACH * size))
    rng = np.random.default_rng(size)
    turn = rng.integers(1, 1 << 62, (steps, REPEATS), dtype=np.int64).astype(np.uint64) | np.uint64(1)
    picks = np.stack([rng.choice(steps, SAMPLES, replace=False) for _ in range(REPEATS)])
    taken = np.zeros((steps, REPEATS), bool)
    taken[picks, np.arange(REPEATS)[:, None]] = True
    end = np.minimum(starts + size, limits)[:, None]
    at = np.repeat(starts[:, None], REPEATS, axis=1)
    keys = np.repeat(np.arange(1, REPEATS + 1, dtype=np.uint64)[None, :], len(starts), axis=0)
    for j in range(steps):
        over = at >= end
        word = np.where(over, np.uint64(0), names[np.minimum(at, len(names) - 1)])
        here = taken[j]
        if here.any():
            keys[:, here] = bw.mix64(keys[:, here] ^ word[:, here])
        at += ((word * turn[j]) >> np.uint64(63)).astype(np.int64) & ~over
    return keys


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, begin, end): the stretch of ``text`` nearest to ``item`` by word edit distance."""
    n = len(text)
    cost, origin, at = np.zeros(n + 1, np.int64), np.arange(n + 1), np.arange(n + 1)
    for i, word in enumerate(item):
        swap = cost[:-1] + (text != word)
        drop = cost[1:] + 1
        new = np.concatenate([[i + 1], np.minimum(swap, drop)])
        begin = np.concatenate([[0], np.where(swap <= drop, origin[:-1], origin[1:])])
        # Words only in the text: the least of new[k] + (j - k) for k up to j.
        shifted = new - at
        best = np.minimum.accumulate(shifted)
        source = np.maximum.accumulate(np.where(shifted == best, at, 0))
        cost, origin = best + at, begin[source]
    end = int(cost.argmin())
    return int(cost[end]), int(origin[end]), end


def _spread(first: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, first[i] + 0 .. many[i]-1) for every i."""
    which = np.repeat(np.arange(len(many)), many)
    return which, np.repeat(first, many) + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)


class ItemIndex:
    """Keys and words of one block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], similarity: float = SIMILARITY):
        self.ids = [i for i, _ in items]
        names, at = folded_words(*bw.text_bytes(pa.array([t for _, t in items], pa.string())))
        self.words = [names[a:z] for a, z in zip(at, at[1:], strict=False)]
        self.edits = [allowed_edits(len(w), similarity) for w in self.words]
        runs: dict[int, list[int]] = {}
        by_size: dict[int, list[int]] = {}
        for k, (w, e) in enumerate(zip(self.words, self.edits, strict=True)):
            if len(w):
                runs.setdefault(run_length(len(w), e), []).append(k)
                by_size.setdefault(size_class(len(w)), []).append(k)
        self.runs = {}
        for q, members in runs.items():
            found = [self.run_hashes(self.words[k], q) for k in members]
            values = np.concatenate(found)
            order = np.argsort(values, kind="stable")
            item = np.repeat(np.array(members), [len(f) for f in found])[order]
            offset = np.concatenate([np.arange(len(f)) for f in found])[order]
            marks = np.zeros(1 << 22, bool)
            marks[(values >> np.uint64(42)).astype(np.int64)] = True
            self.runs[q] = (values[order], item, offset, marks)
        self.longest = max(map(len, self.words), default=0)
        self.tables = {}
        for size, members in by_size.items():
            flat = np.concatenate([self.words[k] for k in members])
            length = np.array([len(self.words[k]) for k in members])
            start = np.cumsum(length) - length
            keys = embed_keys(flat, start, size, start + length)
            order = np.argsort(keys.ravel(), kind="stable")
            self.tables[size] = (keys.ravel()[order], np.repeat(np.array(members), REPEATS)[order])

    @staticmethod
    def run_hashes(names: np.ndarray, q: int) -> np.ndarray:
        n = len(names) - q + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        h = np.zeros(n, np.uint64)
        for k in range(q):
            h = h * np.uint64(0x9E3779B97F4A7C15) + names[k : k + n]
            h ^= h >> np.uint64(29)
        return bw.mix64(h)

    def matches(self, buf: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, item, start, end, edits) of every verified match, best stretch of each row and item."""
        names, at = folded_words(buf, offsets)
        # Where runs of items stand: their place in the text, the item, their place in it.
        seen = []
        for q, (values, item, offset, marks) in self.runs.items():
            h = self.run_hashes(names, q)
            maybe = np.flatnonzero(marks[(h >> np.uint64(42)).astype(np.int64)])
            first, last = np.searchsorted(values, h[maybe], side="left"), np.searchsorted(values, h[maybe], side="right")
            which, spot = _spread(first, last - first)
            seen.append(np.stack([maybe[which], item[spot], offset[spot]]))
        place, item, offset = np.concatenate(seen, axis=1) if seen else np.zeros((3, 0), np.int64)
        if not len(place):
            return []
        row = np.searchsorted(at, place, side="right") - 1
        sizes, slack = np.array([size_class(len(w)) if len(w) else 0 for w in self.words]), np.array(self.edits)
        pairs: dict[tuple[int, int], list[int]] = {}
        for size, (keys, members) in self.tables.items():
            mine = np.flatnonzero(sizes[item] == size)
            which, step = _spread(np.zeros(len(mine), np.int64), 2 * slack[item[mine]] + 1)
            near = mine[which]
            starts = place[near] - offset[near] - slack[item[near]] + step
            starts = np.unique(starts[(starts >= at[row[near]]) & (starts < at[row[near] + 1])])
            doc = np.searchsorted(at, starts, side="right") - 1
            for part in range(0, len(starts), 10_000):
                s, d = starts[part : part + 10_000], doc[part : part + 10_000]
                found = embed_keys(names, s, size, at[d + 1]).ravel()
                first, last = np.searchsorted(keys, found, side="left"), np.searchsorted(keys, found, side="right")
                which, spot = _spread(first, last - first)
                which //= REPEATS
                hit = np.unique(np.stack([d[which], members[spot], s[which]], axis=1), axis=0)
                for d_, k, s_ in hit.tolist():
                    pairs.setdefault((d_, k), []).append(s_)
        out = []
        for (d, k), found in pairs.items():
            item, most = self.words[k], self.edits[k]
            best, done = None, -1
            for s in sorted(found):
                if s < done:  # the last stretch tried covers this window
                    continue
                begin = max(int(at[d]), s - most)
                done = s + len(item) + most
                stop = min(int(at[d + 1]), done + len(item) + most)
                edits, a, z = align(item, names[begin:stop])
                if edits <= most and (best is None or edits < best[2]):
                    best = (begin + a - int(at[d]), begin + z - int(at[d]), edits)
            if best:
                out.append((d, k, *best))
        return sorted(out)


def item_blocks(benchmark: DataFrame, block: int = BLOCK_ITEMS) -> tuple[int, Iterator[list[tuple[int, str]]]]:
    """How many blocks of about ``block`` items and ``BLOCK_BYTES`` there are, and the blocks; null and blank items match nothing.

    The driver holds one block at a time, of which a worker's index is built.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item")).where("item_id is not null and item is not null")
    size = items.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("item")), F.lit(0)).alias("b")).first()
    many = max(1, -(-size["n"] // block), -(-size["b"] // BLOCK_BYTES))
    each = (items.where(F.pmod(F.xxhash64("item_id"), F.lit(many)) == part) for part in range(many))
    return many, (sorted((r["item_id"], r["item"]) for r in mine.collect()) for mine in each)


#: The index that a worker built last, by the name of its block.
_KEPT: dict[str, ItemIndex] = {}


def kept_index(name: str, items: Callable[[], list[tuple[int, str]]], similarity: float) -> ItemIndex:
    """The worker's index of a block: built for its first task, found by the others."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = ItemIndex(items(), similarity)
    return _KEPT[name]


def _index_of(docs: DataFrame, items: list[tuple[int, str]], similarity: float) -> Callable[[], ItemIndex]:
    """Gives the block's index in a task; the items are broadcast once."""
    block, name = docs.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex
    return lambda: kept_index(name, lambda: block.value, similarity)


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK_ITEMS) -> DataFrame:
    """(doc_id, item_id, start, n_words, edits): documents that hold a benchmark item.

    One row for each document and item, with the nearest stretch of words (of
    equally near ones the first).  A null or empty text holds nothing; rows that
    share an id are scanned apiece; an empty table or benchmark gives no rows;
    other columns are ignored whatever their names.  Texts are read whole,
    however long, once for each block of items, and never shuffled.  Where there
    are several blocks, each one's result is staged before the next is fetched.
    """
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def found(items: list[tuple[int, str]]) -> DataFrame:
        make = _index_of(cut, items, similarity)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = make()
            for whole_batch in batches:
                for batch in bw.row_slices(whole_batch, "text"):
                    ids = batch.column("doc_id").to_pylist()
                    rows = [(ids[d], index.ids[k], a, z - a, e) for d, k, a, z, e in index.matches(*bw.text_bytes(batch.column("text")))]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=["doc_id", "item_id", "start", "n_words", "edits"])

        return cut.mapInArrow(run, "doc_id long, item_id long, start long, n_words long, edits long")

    many, blocks = item_blocks(benchmark, block)
    return reduce(DataFrame.unionByName, (found(items) if many == 1 else staged(found(items), "leaks") for items in blocks))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK_ITEMS) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; cases as in ``find_leaks``."""
    schema = docs.schema

    def clean(rows: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
        make = _index_of(rows, items, similarity)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = make()
            for whole_batch in batches:
                for batch in bw.row_slices(whole_batch, "text"):
                    stay = np.ones(batch.num_rows, bool)
                    stay[[m[0] for m in index.matches(*bw.text_bytes(batch.column("text")))]] = False
                    yield batch.filter(pa.array(stay))

        return rows.mapInArrow(run, schema)

    many, blocks = item_blocks(benchmark, block)
    for items in blocks:
        left = clean(docs, items)
        docs = left if many == 1 else staged(left, "clean")
    return docs


def op5_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
