"""Collocations by passes over n-grams with hashed bucket counts (operator 11).

Pass k reads every text once.  It counts the phrases of k words that may still be
frequent, and counts all that may be frequent of k + 1 words into ``BUCKETS``
hashed buckets.  What may be frequent is known from two bitmaps of the pass
before, which are all that is broadcast and have a fixed size:

* the buckets whose count reached the least frequency: a phrase in another can't
  reach it, as a bucket counts its phrases together;
* the phrases of one word less that are frequent (their hashes' bits): a phrase
  is frequent only if both it begins and ends with are.

Both only let too much through, never too little; the exact counts that follow
decide.  Counts leave a task summed up: buckets as one count each (kept at the
least frequency once there, which changes no verdict), phrases as one row each.
Buckets are then summed in blocks, each in one task that holds its own block only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outflow.llm import bytewords as bw
from outflow.llm.shared import staged, unstage

#: Buckets of a pass; a bitmap has an eighth as many bytes.
BUCKETS = 1 << 26
#: Buckets of a block: their places fit 16 bits.
BLOCK = 1 << 16
#: Bytes of text between two sums of what a task has counted.
CHUNK = 2 << 20
MOST_WORDS, LEAST_COUNT, SHARE, TOP = 3, 10, 50, 2000
_PART = "kind string, lang string, phrase string, n long, block int, at binary, times binary"
_MULT = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def pieces(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, its row, and the number of its piece, of a batch of lower-cased texts."""
    if not len(buf):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    gap = (buf == 32) | (buf == 9)
    stop = np.isin(buf, np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8))
    word = ~(gap | stop)
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    begins = offsets[:-1][offsets[1:] > offsets[:-1]]
    first[begins] = word[begins]
    ends = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    last[ends] = word[ends]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, starts, side="right") - 1
    stop = stop.astype(np.int64)
    stop[begins[begins > 0]] += 1  # a new row is a new piece
    return starts, ends, row, np.cumsum(stop)[starts] if len(starts) else row


def grams(words: list[np.ndarray], piece: np.ndarray, salt: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, two 64-bit hashes) of every phrase of k words inside a piece.

    ``words``: two hashes of each word; ``salt``: a number for each word's language.
    """
    n = len(piece)
    at = np.flatnonzero(piece[: n - k + 1] == piece[k - 1 :]) if n >= k else np.zeros(0, np.int64)
    out = []
    for h, mult in zip(words, _MULT, strict=True):
        x = salt[at] + np.uint64(k)
        for j in range(k):
            x = bw.mix64(x * mult + h[at + j])
        out.append(x)
    return at, *out


def joined_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, k: int) -> pa.Array:
    """Texts of the phrases of k words that begin at words ``first``, one space between words."""
    word = (first[:, None] + np.arange(k)).ravel()
    size = ends[word] - starts[word]
    width = size + 1  # a space after each word but the phrase's last, which is cut off below
    width[k - 1 :: k] -= 1
    place = np.cumsum(width) - width
    out = np.full(int(width.sum()), 32, np.uint8)
    inside = np.repeat(place - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    out[inside] = buf[np.repeat(starts[word] - place, size) + inside]
    offsets = np.append(place[::k], len(out)).astype(np.int32)
    return pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes()))


class Bitmap:
    """A fixed number of bits, one for the hashes that fall on it."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, hashes: np.ndarray) -> np.ndarray:
        place = (hashes & np.uint64(len(self.bits) * 8 - 1)).astype(np.int64)
        return (self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


class _Buckets:
    """Counts of a task's buckets, none beyond ``most``."""

    def __init__(self, size: int, most: int):
        self.counts, self.most = np.zeros(size, np.uint8), most

    def add(self, hashes: np.ndarray) -> None:
        place, times = np.unique((hashes & np.uint64(len(self.counts) - 1)).astype(np.int64), return_counts=True)
        self.counts[place] = np.minimum(self.counts[place] + np.minimum(times, self.most), self.most)

    def blocks(self) -> Iterator[tuple[int, bytes, bytes]]:
        width = min(BLOCK, len(self.counts))
        for b, part in enumerate(self.counts.reshape(-1, width)):
            at = np.flatnonzero(part)
            if len(at):
                yield b, at.astype("<u2").tobytes(), part[at].tobytes()


def _rows(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    kinds = {"kind": pa.string(), "lang": pa.string(), "phrase": pa.string(), "n": pa.int64(), "block": pa.int32(), "at": pa.binary(), "times": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in kinds.items()], names=list(kinds))


def counted_pass(docs: DataFrame, k: int, most_words: int, least: int, buckets: int, allowed, shorter) -> DataFrame:
    """Partial counts of pass k: ``phrase`` rows of k words and ``bucket`` rows of k + 1.

    ``allowed`` and ``shorter``: broadcast bits of the buckets of k words, and of
    the frequent phrases of k - 1 words (k > 1).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Buckets(buckets, min(least, 255)) if k < most_words else None
        bits = Bitmap(np.frombuffer(allowed.value, np.uint8)) if k > 1 else None
        less = Bitmap(np.frombuffer(shorter.value, np.uint8)) if k > 1 else None
        for whole in batches:
            for batch in bw.row_slices(whole, "text", CHUNK):
                buf, offsets = bw.text_bytes(batch.column("text"))
                buf = bw.lower_ascii(buf)
                starts, ends, row, piece = pieces(buf, offsets)
                if not len(starts):
                    continue
                coded = batch.column("lang").dictionary_encode()
                langs, code = coded.dictionary, np.asarray(coded.indices)[row]
                salt = _salts(langs)[code]
                words = [bw.hash_spans(buf, starts, ends, seed) for seed in (0, 1)]
                at, h, g = grams(words, piece, salt, k)
                if k > 1:
                    # Both ends of a phrase must be frequent, and its bucket full enough.
                    s_at, s_h, _ = grams(words, piece, salt, k - 1)
                    good = np.zeros(len(starts), bool)
                    good[s_at] = less.has(s_h)
                    keep = good[at] & good[at + 1] & bits.has(h)
                    at, h, g = at[keep], h[keep], g[keep]
                if table is not None:
                    n_at, n_h, _ = grams(words, piece, salt, k + 1)
                    if k > 1:
                        may = np.zeros(len(starts), bool)
                        may[at] = True
                        n_h = n_h[may[n_at] & may[n_at + 1]]
                    table.add(n_h)
                if not len(at):
                    continue
                order = np.lexsort((g, h))
                fresh = np.ones(len(order), bool)
                fresh[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
                begin = np.flatnonzero(fresh)
                times = np.diff(np.append(begin, len(order)))
                first = at[order[begin]]
                texts = joined_words(buf, starts, ends, first, k)
                lang = langs.take(pa.array(code[first]))
                n = len(first)
                for a in range(0, n, 50_000):
                    m = min(50_000, n - a)
                    yield _rows(kind=pa.array(["phrase"] * m), lang=lang.slice(a, m), phrase=texts.slice(a, m), n=times[a : a + m])
        if table is not None:
            for b, at, times in table.blocks():
                yield _rows(kind=["bucket"], block=[b], at=[at], times=[times])

    return docs.mapInArrow(run, _PART)


def _summed(least: int, buckets: int):
    """Sums blocks of bucket counts as they come; gives the bits of the buckets that reach ``least``."""
    most = min(least, 255)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, at, times in zip(*(batch.column(c).to_pylist() for c in ("block", "at", "times")), strict=True):
                if b not in held:
                    held[b] = np.zeros(min(BLOCK, buckets), np.uint8)
                place = np.frombuffer(at, "<u2").astype(np.int64)
                held[b][place] = np.minimum(held[b][place].astype(np.int64) + np.frombuffer(times, np.uint8), most)
        for b in sorted(held):
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([np.packbits(held[b] >= most, bitorder="little").tobytes()], pa.binary())], names=["block", "bits"])

    return run


def _marked(buckets: int):
    """The buckets of phrases' hashes, in the form of counts of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Buckets(buckets, 1)
        for batch in batches:
            table.add(phrase_hashes(batch))
        for b, at, times in table.blocks():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([at], pa.binary()), pa.array([times], pa.binary())], names=["block", "at", "times"])

    return run


def _salts(langs: pa.Array) -> np.ndarray:
    buf, at = bw.text_bytes(langs)
    return bw.hash_spans(buf if len(buf) else np.zeros(1, np.uint8), at[:-1], at[1:])


def phrase_hashes(batch: pa.RecordBatch) -> np.ndarray:
    """The first hash of each (lang, phrase), as ``counted_pass`` makes it."""
    if not batch.num_rows:
        return np.zeros(0, np.uint64)
    buf, offsets = bw.text_bytes(batch.column("phrase"))
    salt = _salts(batch.column("lang"))
    space = np.flatnonzero(buf == 32)
    starts = np.sort(np.concatenate([offsets[:-1], space + 1]))
    ends = np.sort(np.concatenate([space, offsets[1:]]))
    row = np.searchsorted(offsets, starts, side="right") - 1
    k = int(np.bincount(row)[0])
    words = bw.hash_spans(buf, starts, ends, 0)
    x = salt + np.uint64(k)
    for j in range(k):
        x = bw.mix64(x * _MULT[0] + words[j::k])
    return x


def _bits(counts: DataFrame, least: int, buckets: int) -> bytes:
    """The bits of buckets that reach ``least``, in the driver: ``buckets`` / 8 bytes, whatever the input."""
    width = max(min(BLOCK, buckets) // 8, 1)
    bits = np.zeros(buckets // 8, np.uint8)
    for r in counts.repartition("block").mapInArrow(_summed(least, buckets), "block int, bits binary").collect():
        bits[r["block"] * width : (r["block"] + 1) * width] = np.frombuffer(r["bits"], np.uint8)
    return bits.tobytes()


def frequent_phrases(docs: DataFrame, most_words: int = MOST_WORDS, least: int = LEAST_COUNT, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """((lang, k, phrase, f) of every phrase of 1 to ``most_words`` words with f >= ``least``, (lang, total) words of each lang)."""
    spark = docs.sparkSession
    cut = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found, totals, allowed, shorter = [], None, None, None
    for k in range(1, most_words + 1):
        part = staged(counted_pass(cut, k, most_words, least, buckets, allowed, shorter), f"pass{k}")
        sums = part.where("kind = 'phrase'").groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
        if k == 1:
            totals = staged(part.where("kind = 'phrase'").groupBy("lang").agg(F.sum("n").alias("total")), "totals")
        often = staged(sums.where(F.col("f") >= least).select("lang", F.lit(k).alias("k"), "phrase", "f"), f"frequent{k}")
        found.append(often)
        for old in (allowed, shorter):
            if old is not None:
                old.unpersist()
        if k < most_words:
            marks = often.select("lang", "phrase").mapInArrow(_marked(buckets), "block int, at binary, times binary")
            allowed = spark.sparkContext.broadcast(_bits(part.where("kind = 'bucket'").select("block", "at", "times"), least, buckets))
            shorter = spark.sparkContext.broadcast(_bits(marks, 1, buckets))
        unstage(part)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every, totals


def _words(phrase: Column, a, b) -> Column:
    """Words a to b (from 1, both included) of a phrase."""
    return F.array_join(F.slice(F.split(phrase, " "), a, b - a + 1), " ")


def scored(every: DataFrame, share: int = SHARE) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of two words or more that no longer one holds too often."""
    many = every.where("k > 1")
    cuts = many.select("lang", "phrase", F.col("f").alias("a"), "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.withColumns({"one": _words(F.col("phrase"), F.lit(1), F.col("cut")), "two": _words(F.col("phrase"), F.col("cut") + 1, F.col("k"))})
    side = lambda i: every.select(F.col("lang").alias(f"lang{i}"), F.col("phrase").alias(f"part{i}"), F.col("f").alias(f"f{i}"))
    met = cuts.join(side(1), (F.col("lang") == F.col("lang1")) & (F.col("one") == F.col("part1"))).join(side(2), (F.col("lang") == F.col("lang2")) & (F.col("two") == F.col("part2")))
    # Exact in 38 digits: a * a * 10**6 for counts up to 10**15.
    score = F.expr("cast((cast(1000000 as decimal(7, 0)) * cast(a as decimal(15, 0)) * cast(a as decimal(15, 0))) div (cast(f1 as decimal(18, 0)) * cast(f2 as decimal(18, 0))) as bigint)")
    best = met.withColumn("score", score).groupBy("lang", "phrase", "a", "k").agg(F.min(F.struct("score", "cut", F.col("f1").alias("l"), F.col("f2").alias("r"))).alias("b"))
    inner = many.where("k > 2").select("lang", F.col("f").alias("longer"), "phrase", "k", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
    inner = inner.select("lang", "longer", "phrase", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("at"))
    inner = inner.groupBy(F.col("lang").alias("in_lang"), _words(F.col("phrase"), F.col("at"), F.col("at") + F.col("size") - 1).alias("held")).agg(F.max("longer").alias("longer"))
    kept = best.join(inner, (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("held")), "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share))
    return kept.select("lang", "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), F.col("b.score").alias("score"))


def collocations(docs: DataFrame, most_words: int = MOST_WORDS, least: int = LEAST_COUNT, share: int = SHARE, top: int = TOP, buckets: int = BUCKETS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each lang's ``top`` phrases.

    Null texts are empty; a null lang is ``und``, together with rows that say so.
    Repeated rows count as often as they stand; ties in score and count go by the
    phrase's bytes.  An empty table gives no rows, texts of any length are read
    whole, and columns besides lang and text are ignored.  The counts of ``least``
    above 255 are bounded in buckets at 255, which only prunes less.
    """
    if most_words < 2 or least < 1 or buckets < 8 or buckets & (buckets - 1):
        raise ValueError("needs two words, a count of 1 and a power of two of buckets at least")
    every, totals = frequent_phrases(docs, most_words, least, buckets)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of each share of a lang first, so that no task sorts a whole lang.
    kept = scored(every, share).withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    kept = kept.withColumn("rank", F.row_number().over(W.partitionBy("lang", "_share").orderBy(*order))).where(F.col("rank") <= top)
    kept = kept.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    named = totals.select(F.col("lang").alias("_lang"), F.col("total").alias("n"))
    return kept.join(named, F.col("lang") == F.col("_lang")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


COLLOCATIONS_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
s AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, unnest(ws) AS w1, unnest(ws[2:]) AS w2, unnest(ws[3:]) AS w3 FROM s),
c1 AS (SELECT lang, w1, count(*) AS f FROM g WHERE w1 IS NOT NULL GROUP BY ALL),
c2 AS (SELECT lang, w1, w2, count(*) AS f FROM g WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
c3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
t AS (SELECT lang, sum(f) AS n FROM c1 GROUP BY lang),
k AS (SELECT c2.lang, c2.w1 || ' ' || c2.w2 AS phrase, c2.f AS a, x.f AS l, y.f AS r, 1 AS cut FROM c2 JOIN c1 x ON x.lang = c2.lang AND x.w1 = c2.w1 JOIN c1 y ON y.lang = c2.lang AND y.w1 = c2.w2
  UNION ALL SELECT c3.lang, c3.w1 || ' ' || c3.w2 || ' ' || c3.w3, c3.f, x.f, y.f, 1 FROM c3 JOIN c1 x ON x.lang = c3.lang AND x.w1 = c3.w1 JOIN c2 y ON y.lang = c3.lang AND y.w1 = c3.w2 AND y.w2 = c3.w3
  UNION ALL SELECT c3.lang, c3.w1 || ' ' || c3.w2 || ' ' || c3.w3, c3.f, x.f, y.f, 2 FROM c3 JOIN c2 x ON x.lang = c3.lang AND x.w1 = c3.w1 AND x.w2 = c3.w2 JOIN c1 y ON y.lang = c3.lang AND y.w1 = c3.w3),
z AS (SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM k),
b AS (SELECT * FROM z QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (SELECT lang, held, max(f) AS longer FROM (SELECT lang, w1 || ' ' || w2 AS held, f FROM c3 UNION ALL SELECT lang, w2 || ' ' || w3, f FROM c3) GROUP BY ALL),
o AS (SELECT b.lang, b.phrase, b.a, b.l, b.r, b.score FROM b LEFT JOIN i ON i.lang = b.lang AND i.held = b.phrase WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a),
q AS (SELECT o.*, CAST(t.n AS BIGINT) AS n, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o JOIN t ON t.lang = o.lang)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, score FROM q WHERE rank <= 2000
"""
