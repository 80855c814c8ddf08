"""SimHash near-duplicates found with Golay-code fuzzy hashing (operator 4).

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits, each
padded to a word of the perfect binary Golay code [23, 12, 7].  Every 23-bit
word is within three bits of exactly one codeword; decoding a segment and all
its one-bit neighbours gives the few codeword indices (one or six) that any
segment at distance one or less decodes to.

Three differing bits over three segments leave only two cases:

* some segment is untouched and another has at most one error: keyed by the
  untouched segment's bits and the other's codeword index (six ordered pairs);
* each segment has exactly one error: keyed by three codeword indices.

Either case is a key of 33 bits or more, so buckets stay small as the corpus
grows.  The many indices of a segment are emitted by one side of the join only.
Candidates are verified by counting differing bits, inside the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outflow.llm import bytewords as bw
from outflow.llm.components import components
from outflow.llm.shared import identified, staged

SHINGLE = 3
SEED = 42
MAX_BITS = 3
#: (first bit, width) of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 generates the Golay code.
GENERATOR = 0b110001110101


def _syndrome(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


class Golay:
    """Decodes 23-bit words to the 12-bit index of their nearest codeword."""

    def __init__(self):
        single = np.array([_syndrome(1 << b) for b in range(23)])
        self.bytes = np.zeros((3, 256), np.int64)
        for part in range(3):
            for bit in range(8):
                if part * 8 + bit < 23:
                    has = (np.arange(256) >> bit & 1).astype(bool)
                    self.bytes[part][has] ^= single[part * 8 + bit]
        self.error = np.zeros(2048, np.int64)
        for a in range(23):
            for b in range(a, 23):
                for c in range(b, 23):
                    flips = (1 << a) | (1 << b) | (1 << c)
                    s = 0
                    for bit in {a, b, c}:
                        s ^= int(single[bit])
                    self.error[s] = flips

    def decode(self, words: np.ndarray) -> np.ndarray:
        syndrome = self.bytes[0][words & 255] ^ self.bytes[1][words >> 8 & 255] ^ self.bytes[2][words >> 16]
        return (words ^ self.error[syndrome]) >> 11

    def nearby(self, words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, index): the distinct codeword indices of each word and its one-bit neighbours."""
        flips = np.concatenate([[0], 1 << np.arange(width)])
        found = np.sort(self.decode(words[:, None] ^ flips[None, :]), axis=1)
        fresh = np.ones(found.shape, bool)
        fresh[:, 1:] = found[:, 1:] != found[:, :-1]
        row, col = np.nonzero(fresh)
        return row, found[row, col]


def simhash_batch(buf: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Fingerprints of a batch of texts as unsigned 64-bit numbers."""
    buf = bw.lower_ascii(buf)
    starts, ends, words = bw.split_words(buf, offsets)
    out = np.zeros(len(offsets) - 1, np.uint64)
    if not len(starts):
        return out
    # All words of the batch, one space after each, in one buffer.
    size = ends - starts
    place = np.cumsum(size + 1) - (size + 1)
    joined = np.full(int(size.sum()) + len(size), 32, np.uint8)
    inside = np.ones(len(joined), bool)
    inside[place + size] = False
    lengths = np.repeat(starts - (place - np.arange(len(place))), size)
    joined[inside] = buf[np.arange(len(lengths)) + lengths]
    data = joined.tobytes()
    counts = np.diff(words)
    many = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(counts)), many)
    first = words[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    last = np.minimum(first + shingle, words[row + 1]) - 1
    begin, end = place[first].tolist(), (place[last] + size[last]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(data[x:y], seed) for x, y in zip(begin, end, strict=True)), np.uint64, len(begin))
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    full = np.flatnonzero(many)
    ones = np.add.reduceat(bits, (np.cumsum(many) - many)[full], axis=0, dtype=np.int64)
    major = ones * 2 > many[full][:, None]
    out[full] = np.packbits(major, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp): the SimHash of every whole text; no words give zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for batch in bw.row_slices(whole_batch, "text"):
                fp = simhash_batch(*bw.text_bytes(batch.column("text")))
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fp.view(np.int64))], names=["id", "fp"])

    cut = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return cut.mapInArrow(run, "id long, fp long").withColumnRenamed("id", key)


def _keys(fps: DataFrame, left: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        golay = Golay()
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, 20_000):
                fp = np.asarray(whole_batch.column(0).slice(at, 20_000))
                if not len(fp):
                    continue
                bits = fp.view(np.uint64)
                part = [(bits >> np.uint64(a)).astype(np.int64) & ((1 << w) - 1) for a, w in SEGMENTS]
                one = [golay.decode(x) for x in part]
                near = [golay.nearby(x, w) for x, (_, w) in zip(part, SEGMENTS, strict=True)]
                rows, keys = [], []
                tag = 0
                for a in range(3):
                    for b in range(3):
                        if a == b:
                            continue
                        row, index = (np.arange(len(fp)), one[b]) if left else near[b]
                        rows.append(row)
                        keys.append(tag << 40 | part[a][row] << 12 | index)
                        tag += 1
                if left:
                    (r0, i0), (r1, i1) = near[0], near[1]
                    n1 = np.bincount(r1, minlength=len(fp))
                    s1 = np.cumsum(n1) - n1
                    times = n1[r0]
                    row = np.repeat(r0, times)
                    second = i1[s1[row] + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)]
                    keys.append(tag << 40 | np.repeat(i0, times) << 24 | second << 12 | one[2][row])
                else:
                    row, index = near[2]
                    keys.append(tag << 40 | one[0][row] << 24 | one[1][row] << 12 | index)
                rows.append(row)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(fp[np.concatenate(rows)])], names=["key", "fp"])

    return fps.select("fp").mapInArrow(run, "key long, fp long")


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) with a < b: every pair of distinct fingerprints within ``max_bits``, up to 3.

    ``fps`` holds each fingerprint once, so copies cost nothing here.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the keys cover at most 3 differing bits")
    one = _keys(fps, True).withColumnRenamed("fp", "a")
    two = _keys(fps, False).withColumnRenamed("fp", "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    # Sizes guessed from the fingerprints' files know nothing of the many keys each has: no broadcast.
    return one.join(two.hint("merge"), (one["key"] == two["key"]) & (F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def near_duplicate_groups(docs: DataFrame, key: str = "doc_id", max_bits: int = MAX_BITS) -> DataFrame:
    """(key, fp, component_id) of every row.

    component_id is the least key that links reach, the row's own included; null
    keys never name a component unless it has no other.  A null or empty text
    has fingerprint zero and links like any other.  Copies share a fingerprint
    and meet in a partial aggregate; only distinct fingerprints are joined.  An
    empty table gives no rows, texts are read whole, however long, and other
    columns are ignored whatever their names.
    """
    marked = staged(fingerprints(docs, key), "fingerprints")
    each = staged(marked.groupBy("fp").agg(F.min(key).alias("least")), "distinct")
    roots = components(links(each, max_bits)).withColumnRenamed("node", "fp")
    rooted = each.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = staged(rooted.join(named, "root").select(F.col("fp").alias("f"), "component_id"), "named")
    return marked.join(of_fp, marked["fp"] == of_fp["f"]).select(key, "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of every near-duplicate group: the one with the least doc_id.

    Columns stay as they are, whatever their names.
    """
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"]
    rows = identified(docs.select("doc_id", "text", F.struct(*others).alias("row")), "text", "row")
    groups = near_duplicate_groups(rows.select("_rid", "text"), "_rid")
    kept = groups.where("_rid = component_id").select(F.col("_rid").alias("k"))
    left = rows.join(kept, rows["_rid"] == kept["k"], "left_semi")
    return left.select(*[F.col("text") if c == "text" else F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])


def op4_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    groups = near_duplicate_groups(docs)
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
