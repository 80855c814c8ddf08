"""Document fingerprints from improbable features (operator 2).

The entropy of every 64-byte window is found by sliding counts.  How often each
entropy class occurs is counted over the whole corpus; a window is the more
improbable the rarer its class.  In every run of 64 neighbouring windows the
most improbable one gets a vote, and windows with 16 votes or more become
features.  A text too short for one such run is read in windows of 12 bytes, the
most improbable of every 8 neighbours being a feature, so that each part of it
gives some; one of fewer bytes is a feature as a whole.  Features go, in text order, into chained Bloom filters of 2,048 bits
and at most 160 features; two digests are compared by the overlap of their
filters' bits, normalised between chance and the possible most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outflow.llm import bytewords as bw
from outflow.llm.shared import identified

WINDOW, RUN, VOTES = 64, 64, 16
BITS, FEATURES, HASHES = 2048, 160, 5
CLASSES, WEAK = 1000, 100
#: Windows and runs of texts that are shorter than WINDOW + RUN - 1 bytes.
SHORT_WINDOW, SHORT_RUN = 12, 8
_UNIT = 1 << 16
_SLICE = 1 << 19


def entropy_classes(buf: np.ndarray) -> np.ndarray:
    """Entropy class (0 .. CLASSES) of the window starting at each byte; windows at the end are partial."""
    n = len(buf)
    if n < WINDOW:
        return np.zeros(0, np.int32)
    back, ahead = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    same = np.empty(n, bool)
    for lag in range(1, WINDOW):
        m = same[: n - lag]
        np.equal(buf[lag:], buf[:-lag], out=m)
        back[lag:] += m.view(np.uint8)
        ahead[: n - lag] += m.view(np.uint8)
    count = np.arange(WINDOW + 1)
    phi = np.round(count * np.log2(np.maximum(count, 1)) * _UNIT).astype(np.int64)
    step = phi[1:] - phi[:-1]
    change = step[back]
    change[WINDOW:] -= step[ahead[:-WINDOW]]
    total = np.cumsum(change)[WINDOW - 1 :]
    return (CLASSES - total * CLASSES // phi[WINDOW]).astype(np.int32)


def _window_starts(offsets: np.ndarray, n: int) -> np.ndarray:
    """Which bytes begin a window that ends in the same document."""
    good = np.zeros(n + 1, np.int64)
    size = np.diff(offsets)
    many = np.maximum(size - WINDOW + 1, 0)
    np.add.at(good, offsets[:-1], many > 0)
    np.add.at(good, offsets[:-1] + many, -(many > 0).astype(np.int64))
    return np.cumsum(good)[:n].astype(bool)


def class_counts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    classes = entropy_classes(buf)
    return np.bincount(classes[_window_starts(offsets, len(buf))[: len(classes)]], minlength=CLASSES + 1)


def short_features(data: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Where the chosen short windows of one text begin, in order; the leftmost of equals is chosen."""
    windows = np.lib.stride_tricks.sliding_window_view(data, SHORT_WINDOW)
    same = (windows[:, :, None] == windows[:, None, :]).sum(axis=2)
    share = np.log2(same).sum(axis=1) / (SHORT_WINDOW * np.log2(SHORT_WINDOW))
    rank = ranks[CLASSES - np.round(share * CLASSES).astype(np.int64)]
    runs = np.lib.stride_tricks.sliding_window_view(rank, min(SHORT_RUN, len(rank)))
    return np.unique(runs.argmin(axis=1) + np.arange(len(runs)))


class Digests:
    """The digests of a batch: each document's filters, in order."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, ranks: np.ndarray):
        n, docs = len(buf), len(offsets) - 1
        doc, hashes = self._features(buf, offsets, ranks)
        size = np.diff(offsets)
        brief = np.flatnonzero((size >= SHORT_WINDOW) & (size < WINDOW + RUN - 1))
        if len(brief):
            long = ~np.isin(doc, brief)
            spots = [offsets[d] + short_features(buf[offsets[d] : offsets[d + 1]], ranks) for d in brief.tolist()]
            spot = np.concatenate(spots)
            doc = np.concatenate([doc[long], np.repeat(brief, [len(x) for x in spots])])
            hashes = np.concatenate([hashes[long], bw.hash_spans(buf, spot, spot + SHORT_WINDOW, seed=9)])
            order = np.argsort(doc, kind="stable")
            doc, hashes = doc[order], hashes[order]
        bare = np.flatnonzero((np.bincount(doc, minlength=docs) == 0) & (size > 0))
        if len(bare):  # no window of interest: the whole text is the one feature
            doc = np.concatenate([doc, bare])
            hashes = np.concatenate([hashes, bw.hash_spans(buf, offsets[bare], offsets[bare + 1], seed=5)])
            order = np.argsort(doc, kind="stable")
            doc, hashes = doc[order], hashes[order]
        counts = np.bincount(doc, minlength=docs)
        chain = -(-counts // FEATURES)
        self.first = np.concatenate([[0], np.cumsum(chain)])
        rank = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        where = self.first[doc] + rank // FEATURES
        bits = np.zeros(int(self.first[-1]) * BITS, bool)
        for k in range(HASHES):
            bits[where * BITS + (hashes >> np.uint64(11 * k) & np.uint64(BITS - 1)).astype(np.int64)] = True
        self.filters = np.packbits(bits.reshape(-1, BITS), axis=1).view(np.uint64)
        self.size = np.bincount(where, minlength=int(self.first[-1]))
        self.ones = np.bitwise_count(self.filters).sum(axis=1).astype(np.int64)

    @staticmethod
    def _features(buf, offsets, ranks):
        n = len(buf)
        classes = entropy_classes(buf)
        if not len(classes):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        good = _window_starts(offsets, n)[: len(classes)]
        rank = np.where(good, ranks[classes], CLASSES + 1)
        shift = max(1, int(len(rank)).bit_length())
        kind = np.uint32 if shift <= 21 else np.uint64
        least = rank.astype(kind) << kind(shift) | np.arange(len(rank), dtype=kind)
        span = 1
        while span < RUN:
            np.minimum(least[:-span], least[span:], out=least[:-span]) if len(least) > span else None
            span *= 2
        size = np.diff(offsets)
        windows = np.maximum(size - WINDOW + 1, 0)
        runs = np.where(windows > 0, np.maximum(windows - RUN + 1, 1), 0)
        at = np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs) + np.repeat(offsets[:-1], runs)
        winner = (least[at] & kind((1 << shift) - 1)).astype(np.int64)
        short = np.repeat((windows > 0) & (windows < RUN), runs)
        if short.any():  # fewer windows than a run: the best of what there is
            own = np.repeat(np.arange(len(size)), runs)[short]
            winner[short] = [offsets[d] + int(np.argmin(rank[offsets[d] : offsets[d] + windows[d]])) for d in own]
        votes = np.bincount(winner, minlength=len(rank))
        lone = np.zeros(len(rank), bool)
        lone[winner[short]] = True
        spot = np.flatnonzero(((votes >= VOTES) | lone) & good & (rank < CLASSES))
        return np.searchsorted(offsets, spot, side="right") - 1, bw.hash_spans(buf, spot, spot + WINDOW)

    def text(self, doc: int) -> str:
        """Each filter as its feature count and bits in hexadecimal, chained with dots."""
        a, z = int(self.first[doc]), int(self.first[doc + 1])
        return ".".join(f"{self.size[k]:02x}{self.filters[k].tobytes().hex()}" for k in range(a, z))


def likeness(one: Digests, a: np.ndarray, two: Digests, b: np.ndarray) -> np.ndarray:
    """Likeness, 0 to 1, of digests ``a`` of one batch to digests ``b`` of another, pair by pair.

    Every filter of the shorter chain takes its best match in the longer one;
    filters weigh as many as their features.  Two empty digests are alike.
    """
    na, nb = one.first[a + 1] - one.first[a], two.first[b + 1] - two.first[b]
    turn = na > nb
    out = np.where((na == 0) & (nb == 0), 1.0, 0.0)
    weight_sum = np.zeros(len(a))
    score_sum = np.zeros(len(a))
    pairs = na * nb
    edges = [0, *(np.flatnonzero(np.diff(np.cumsum(pairs) // 200_000)) + 1).tolist(), len(a)]
    for begin, end in zip(edges, edges[1:], strict=False):
        many = pairs[begin:end]
        if not many.sum():
            continue
        pair = np.repeat(np.arange(begin, end), many)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many)
        flip = turn[pair]
        inner = np.where(flip, na[pair], nb[pair])  # length of the longer chain
        short, long = k // inner, k % inner
        x = one.first[a[pair]] + np.where(flip, long, short)
        y = two.first[b[pair]] + np.where(flip, short, long)
        shared = np.bitwise_count(one.filters[x] & two.filters[y]).sum(axis=1).astype(np.float64)
        chance = one.ones[x] * two.ones[y] / BITS
        most = np.minimum(one.ones[x], two.ones[y])
        value = np.clip((shared - chance) / np.maximum(most - chance, 1e-9), 0, 1)
        group = np.flatnonzero(long == 0)
        best = np.maximum.reduceat(value, group)
        weight = np.where(flip[group], two.size[y[group]], one.size[x[group]]).astype(np.float64)
        np.add.at(score_sum, pair[group], best * weight)
        np.add.at(weight_sum, pair[group], weight)
    some = weight_sum > 0
    out[some] = score_sum[some] / weight_sum[some]
    return out


def rarity_ranks(docs: DataFrame) -> np.ndarray:
    """Rank of each entropy class, the rarest in the whole corpus first; weak classes never rank.

    The driver gets one number a class.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES + 1, np.int64)
        for whole in batches:
            for batch in bw.row_slices(whole, "text", _SLICE):
                total += class_counts(*bw.text_bytes(batch.column("text")))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["class", "n"])

    rows = docs.select("text").mapInArrow(run, "class int, n long").groupBy("class").agg(F.sum("n").alias("n")).collect()
    count = np.zeros(CLASSES + 1, np.int64)
    for r in rows:
        count[r["class"]] = r["n"]
    strong = np.arange(WEAK, CLASSES + 1)
    order = strong[np.lexsort((strong, count[strong]))]
    ranks = np.full(CLASSES + 1, CLASSES, np.int64)
    ranks[order] = np.arange(len(order))
    return ranks


def _dealt(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows in ranges of ``_rid``, each range followed by the first row of the next.

    Range borders are ids of the table, so the row that begins a range is known
    without reading any text.  The last range is followed by the table's first row.
    """
    shares = [k / buckets for k in range(1, buckets)]
    found = rows.agg(F.min("_rid").alias("least"), F.percentile_approx("_rid", shares or [0.5], 20_000).alias("cuts")).first()
    if found["least"] is None:
        return rows.withColumns({"bucket": F.lit(0), "tail": F.lit(0)})
    heads = np.array(sorted({found["least"], *(found["cuts"] if shares else [])}), dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid = np.asarray(batch.column("_rid"))
            bucket = np.searchsorted(heads, rid, side="right") - 1
            yield _with(batch, bucket, 0)
            first = np.flatnonzero(heads[bucket] == rid)
            if len(first):
                yield _with(batch.take(pa.array(first)), (bucket[first] - 1) % len(heads), 1)

    def _with(batch: pa.RecordBatch, bucket: np.ndarray, tail: int) -> pa.RecordBatch:
        return batch.append_column("bucket", pa.array(bucket.astype(np.int32))).append_column("tail", pa.array(np.full(len(bucket), tail, np.int32)))

    return rows.select("_rid", "doc_id", "text").mapInArrow(run, "_rid long, doc_id long, text string, bucket int, tail int")


def edit(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    A null text is empty; an empty text has an empty fingerprint, and two of
    them are fully alike.  Null ids come first; rows that share an id follow
    each other in the order of a hash of their text.  A table of one row follows
    itself; an empty table gives no rows.  Texts are read whole, however long, and
    other columns are ignored whatever their names.  Windows of equal rarity go
    by their place.  The text moves through one shuffle.
    """
    rows = identified(docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")), "text")
    ranks = rarity_ranks(rows)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _dealt(rows, 4 * parts).repartition(parts, "bucket").sortWithinPartitions("bucket", "tail", "_rid")

    def emit(ids: list, texts: list[str]) -> pa.RecordBatch:
        """Results of all rows but the last, which only follows."""
        edited = [edit(x, y) for x, y in zip(texts, texts[1:], strict=False)]
        one = Digests(*bw.text_bytes(pa.array(texts, pa.string())), ranks)
        two = Digests(*bw.text_bytes(pa.array(edited, pa.string())), ranks)
        k = np.arange(len(edited))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids[:-1], pa.int64()),
                pa.array([len(x) for x in texts[:-1]], pa.int64()),
                pa.array([hashlib.sha256(x.encode("utf-8")).hexdigest() for x in edited], pa.string()),
                pa.array([one.text(i) for i in k], pa.string()),
                pa.array([two.text(i) for i in k], pa.string()),
                pa.array(likeness(one, k, two, k)),
                pa.array(likeness(one, k, one, k + 1)),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        held = 0
        for batch in batches:
            for doc_id, text, tail in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "tail")), strict=True):
                ids.append(doc_id)
                texts.append(text)
                held += len(text)
                if tail or held > _SLICE:
                    if len(ids) > 1:
                        yield emit(ids, texts)
                    ids, texts, held = ([], [], 0) if tail else (ids[-1:], texts[-1:], len(text))

    return dealt.select("doc_id", "text", "tail").mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )


def op2_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprint_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
