"""Near copies by the exact likeness of their word shingles (a stage of the pipeline).

Two texts are linked where the Jaccard likeness of their sets of five-word
shingles is 0.8 or more; a text of fewer words is one shingle.

Texts with equal sets become one node.  Nodes first go through operator 4's
method: SimHash fingerprints (of five words), Golay-code keys, links of three
bits or fewer, star contraction; each node is then held against the least node of
its group, on the whole texts, and joined to it if they are alike.

Pairs at 0.8 differ in about ten of 64 bits, and some in twice as many, so no
radius with small buckets reaches them all.  What three bits leave apart meets in
28 bands of five minimum hashes, which a pair at 0.8 misses with probability
0.000015 (and one at 0.9 with less than 1e-10); what fingerprints have joined is
not compared again, and every other candidate is verified on the whole texts.

A band's bucket is compared as a star first: its centre, the member that lies in
the largest buckets, with each other member.  Two members that the stars leave
unconnected are compared only where what they share with the centre allows it.
With a(x) the shingles x shares with the centre and the rest of x besides, x and
y have at most min(a(x), a(y)) plus their common rest in common; so either both
a's reach what a likeness of 0.8 needs, or the rests share a shingle.  The first
is a matter of three numbers, the second a join on rare shingles: no pairs of a
large group are formed to be refused, and none that could be alike is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outflow.llm import bytewords as bw
from outflow.llm import simhash as sh
from outflow.llm.components import components
from outflow.llm.shared import identified, staged, unstage

SHINGLE = 5
#: Least likeness, as a fraction.
LEAST = (4, 5)
BANDS, ROWS = 28, 5
#: Bytes of text that are signed at a time: a fingerprint's votes take 64 numbers a shingle.
SLICE = 1 << 16
#: Words of 64 bits that mark rows by their ids' hashes, whatever the input.
WORDS = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_RNG = np.random.default_rng(20)
_TIMES = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_PLUS = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each distinct shingle of a batch of texts, in order of both."""
    buf = bw.lower_ascii(buf)
    starts, ends, words = bw.split_words(buf, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    each = bw.hash_spans(buf, starts, ends)
    counts = np.diff(words)
    many = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(counts)), many)
    first = words[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    size = np.minimum(counts[row], shingle)
    padded = np.concatenate([each, np.zeros(shingle, np.uint64)])
    mixed = size.astype(np.uint64)
    for k, weight in enumerate(bw.powers(shingle, _BASE)):
        mixed += np.where(k < size, padded[first + k] * weight, np.uint64(0))
    mixed = bw.mix64(mixed)
    order = np.lexsort((mixed, row))
    row, mixed = row[order], mixed[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (mixed[1:] != mixed[:-1])
    return row[fresh], mixed[fresh]


def _bands(row: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows that have shingles, and their bands' keys."""
    full, begin = np.unique(row, return_index=True)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    keys = np.zeros((len(full), BANDS), np.uint64)
    for k in range(BANDS * ROWS if len(full) else 0):
        least = np.minimum.reduceat(short * _TIMES[k] + _PLUS[k], begin)
        keys[:, k // ROWS] = bw.mix64(keys[:, k // ROWS] ^ least.astype(np.uint64)) + np.uint64(k // ROWS)
    return full, keys


def signatures(rows: DataFrame) -> DataFrame:
    """(_rid, fp, one, two, n, keys): every whole text's SimHash, its set as two sums and a count, and its bands' keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in bw.row_slices(whole, "text", SLICE):
                rows = batch.num_rows
                texts = bw.text_bytes(batch.column("text"))
                fp = sh.simhash_batch(*texts, SHINGLE)
                row, hashes = shingle_sets(*texts)
                full, keys = _bands(row, hashes, rows)
                begin = np.searchsorted(row, full)
                one, two = np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
                if len(full):
                    one[full] = np.add.reduceat(hashes, begin)
                    two[full] = np.add.reduceat(bw.mix64(hashes), begin)
                n = np.bincount(row, minlength=rows)
                ends = np.zeros(rows + 1, np.int32)
                ends[1:][full] = BANDS
                listed = pa.ListArray.from_arrays(pa.array(np.cumsum(ends, dtype=np.int32)), pa.array(keys.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("_rid"), pa.array(fp.view(np.int64)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(n, pa.int64()), listed], names=["_rid", "fp", "one", "two", "n", "keys"])

    return rows.select("_rid", F.col("text").cast("string").alias("text")).mapInArrow(run, "_rid long, fp long, one long, two long, n long, keys array<long>")


def _compared(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """(a, b, shared, alike, rest) of pairs of texts: common shingles, the verdict, and b's shingles that a lacks."""
    for whole in batches:
        for at in range(0, whole.num_rows, 100):
            batch = whole.slice(at, 100)
            n = batch.num_rows
            row_a, hash_a = shingle_sets(*bw.text_bytes(batch.column("text_a")), shingle)
            row_b, hash_b = shingle_sets(*bw.text_bytes(batch.column("text_b")), shingle)
            row, hashes = np.concatenate([row_a, row_b]), np.concatenate([hash_a, hash_b])
            second = np.arange(len(row)) >= len(row_a)
            order = np.lexsort((second, hashes, row))
            row, hashes, second = row[order], hashes[order], second[order]
            twin = np.zeros(len(row), bool)
            twin[1:] = (row[1:] == row[:-1]) & (hashes[1:] == hashes[:-1])
            shared = np.bincount(row[twin], minlength=n)
            either = np.bincount(row, minlength=n) - shared
            alone = second & ~twin
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[alone], minlength=n))]).astype(np.int32)
            rest = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[alone].view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(shared, pa.int64()), pa.array(shared * LEAST[1] >= either * LEAST[0]), rest], names=["a", "b", "shared", "alike", "rest"])


def told(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """``rows`` with ``_may``: true for all rows whose key is one of ``ids`` (one column) and for few others.

    Ids are bits in ``WORDS`` words at most, which are broadcast; so a join with
    a part of the rows moves the texts of that part only.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(64 * WORDS))
    bits = ids.select(place(ids.columns[0]).alias("place")).groupBy(F.shiftright("place", 6).alias("_word")).agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))").alias("_bits"))
    met = rows.join(F.broadcast(bits), F.shiftright(place(key), 6) == F.col("_word"), "left")
    return met.withColumn("_may", F.coalesce(F.getbit("_bits", place(key).bitwiseAND(63).cast("int")) == 1, F.lit(False))).drop("_word", "_bits")


def _verified(pairs: DataFrame, rows: DataFrame, name: str, shingle: int) -> DataFrame:
    """``_compared`` of pairs (a, b) of rows; only texts that they name move."""
    pairs = staged(pairs, f"{name}_pairs")
    text = lambda c: told(rows.select(F.col("_rid").alias(f"_{c}"), F.col("text").cast("string").alias(f"text_{c}")), f"_{c}", pairs.select(c)).where("_may")
    one = pairs.join(text("a"), F.col("a") == F.col("_a")).select("a", "b", "text_a")
    both = one.join(text("b"), F.col("b") == F.col("_b")).select("a", "b", "text_a", "text_b")
    out = staged(both.mapInArrow(lambda batches: _compared(batches, shingle), "a long, b long, shared long, alike boolean, rest array<long>"), name)
    unstage(pairs)
    return out


def fingerprint_links(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``_compared`` of each node with the least node of its SimHash group (operator 4); ``nodes``: node, fp.

    Groups are what links of three bits or fewer reach.  A group takes as many
    comparisons as it has nodes besides the least.
    """
    each = staged(nodes.groupBy("fp").agg(F.min("node").alias("first")), "distinct")
    roots = components(sh.links(each)).withColumnRenamed("node", "x")
    rooted = staged(each.join(roots, F.col("fp") == F.col("x"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("a")).withColumnRenamed("root", "r")
    of_fp = rooted.join(least, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "a")
    pairs = nodes.join(of_fp, F.col("fp") == F.col("f")).where("node <> a").select("a", F.col("node").alias("b"))
    out = _verified(pairs, rows, "fingerprint_links", SHINGLE)
    unstage(each, rooted)
    return out


def _needed(a: str, b: str):
    """Least common shingles, times nine, of sets of two sizes that are alike."""
    return (F.col(a) + F.col(b)) * LEAST[0]


def stars(keys: DataFrame) -> DataFrame:
    """(centre, node, n): every node with the centres of its buckets; ``keys``: key, node, n."""
    sizes = staged(keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").withColumnRenamed("key", "k"), "sizes")
    met = staged(keys.join(sizes, F.col("key") == F.col("k")).select("key", "node", "n", "size"), "buckets")
    score = staged(met.groupBy("node").agg(F.sum("size").alias("score")).withColumnRenamed("node", "x"), "scores")
    ranked = staged(met.join(score, F.col("node") == F.col("x")).select("key", "node", "n", "score"), "ranked")
    unstage(sizes, met, score)
    centres = staged(ranked.groupBy("key").agg(F.max_by("node", F.struct("score", -F.col("node"))).alias("centre")).withColumnRenamed("key", "k"), "centres")
    out = staged(ranked.join(centres, F.col("key") == F.col("k")).select("centre", "node", "n").distinct(), "stars")
    unstage(ranked, centres)
    return out


def links(rows: DataFrame, keys: DataFrame, shingle: int = SHINGLE, likely=None, before: DataFrame | None = None) -> DataFrame:
    """(a, b): links between nodes that connect all those that any pair of like texts connects.

    ``keys``: (key, node, n) of distinct texts, where like texts share a key;
    ``likely`` drops pairs (a, b) that can't be alike before their texts are compared.
    ``before`` holds pairs that have been compared, each b with one a that is no
    b itself; what they join is compared only where its star is split.
    """
    spokes = stars(keys)
    pairs = spokes.where("centre <> node").select(F.col("centre").alias("a"), F.col("node").alias("b"))
    if before is not None:
        home = lambda c: before.where("alike").select(F.col("b").alias(f"x_{c}"), F.col("a").alias(f"home_{c}"))
        met = pairs.join(home("a"), F.col("a") == F.col("x_a"), "left").join(home("b"), F.col("b") == F.col("x_b"), "left")
        pairs = met.where(F.coalesce("home_a", "a") != F.coalesce("home_b", "b")).select("a", "b").join(before.select("a", "b"), ["a", "b"], "left_anti")
    tried = _verified(likely(pairs) if likely else pairs, rows, "star_links", shingle)
    if before is not None:
        tried = tried.unionByName(before)
    near = tried.where("alike").select("a", "b")
    roots = staged(components(near).select(F.col("node").alias("x"), "root"), "roots")
    hubs = roots.select(F.col("x").alias("h"), F.col("root").alias("hub_root"))
    placed = spokes.where("centre <> node").join(roots, F.col("node") == F.col("x"), "left").join(hubs, F.col("centre") == F.col("h"), "left")
    placed = staged(placed.select("centre", "node", "n", F.coalesce("root", "node").alias("root"), F.coalesce("hub_root", "centre").alias("hub_root")), "placed")
    # Only stars whose members lie in several components have pairs left.
    split = placed.groupBy("centre").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.min("n").alias("least")).where("r0 < r1").select(F.col("centre").alias("c"), "least")
    apart = staged(placed.join(split, F.col("centre") == F.col("c")).drop("c"), "apart")
    unstage(spokes, placed, roots)
    if likely or before is not None:
        open_pairs = apart.select(F.col("centre").alias("a"), F.col("node").alias("b")).join(tried.select("a", "b"), ["a", "b"], "left_anti")
        more = _verified(open_pairs, rows, "star_rests", shingle)
        near, tried = near.unionByName(more.where("alike").select("a", "b")), tried.unionByName(more)
    # Each node with what it shares with its centre; the centre shares all it has.
    known = tried.select(F.col("a").alias("c"), F.col("b").alias("m"), "shared", "rest")
    bare, apart = apart, staged(apart.join(known, (F.col("centre") == F.col("c")) & (F.col("node") == F.col("m"))).drop("c", "m"), "apart")
    unstage(bare)
    side = lambda df, i: df.select(*[F.col(c).alias(f"{c}{i}") for c in ("centre", "node", "n", "shared", "root")], *[F.col(c).alias(f"{c}{i}") for c in df.columns if c in ("shingle", "lacks")])
    differ = (F.col("root1") != F.col("root2")) & (F.least("n1", "n2") * LEAST[1] >= F.greatest("n1", "n2") * LEAST[0])
    # Of two in different components one at least is not in the centre's: that one asks.
    other = F.col("root") != F.col("hub_root")
    # Both share enough with the centre.
    total = LEAST[0] + LEAST[1]
    able = apart.where(F.col("shared") * total >= (F.col("n") + F.greatest("least", F.ceil(F.col("n") * LEAST[0] / LEAST[1]))) * LEAST[0])
    enough = F.least("shared1", "shared2") * total >= _needed("n1", "n2")
    one = side(able.where(other), 1).join(side(able, 2), (F.col("centre1") == F.col("centre2")) & differ & enough).select("node1", "node2")
    # The rests share shingles; counted, these make up for what the centre lacks.
    rare = apart.select("centre", "node", "n", "shared", "root", "hub_root", "least", F.explode("rest").alias("shingle"))
    several = rare.groupBy("centre", "shingle").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count(F.lit(1)).alias("often")).where("r0 < r1")
    several = several.select(F.col("centre").alias("c"), F.col("shingle").alias("s"), "often")
    rare = rare.join(several, (F.col("centre") == F.col("c")) & (F.col("shingle") == F.col("s"))).drop("c", "s")
    # A node needs so many of its own shingles again in a partner's rest.  If it has fewer
    # that any other has, it has no partner; else one at least is among its rarest.
    smallest = F.greatest("least", F.ceil(F.col("n") * LEAST[0] / LEAST[1]))
    lacks = F.greatest(F.ceil((F.col("n") + smallest) * LEAST[0] / total) - F.col("shared"), F.lit(1))
    mine = W.partitionBy("centre", "node")
    rare = rare.withColumns({"lacks": lacks, "many": F.count(F.lit(1)).over(mine), "nth": F.row_number().over(mine.orderBy("often", "shingle"))})
    rare = staged(rare.where("many >= lacks").drop("often", "least"), "rare")
    asking = side(rare.where(other & (F.col("nth") <= F.col("many") - F.col("lacks") + 1)), 1)
    met = asking.join(side(rare, 2), (F.col("centre1") == F.col("centre2")) & (F.col("shingle1") == F.col("shingle2")) & differ)
    counted = met.groupBy("centre1", "node1", "node2").agg(F.count(F.lit(1)).alias("common"), *[F.first(c).alias(c) for c in ("n1", "n2", "shared1", "shared2", "lacks1")])
    two = counted.where((F.least("shared1", "shared2") + F.col("common") + F.col("lacks1") - 1) * total >= _needed("n1", "n2")).select("node1", "node2")
    done = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = one.unionByName(two).select(F.least("node1", "node2").alias("a"), F.greatest("node1", "node2").alias("b")).distinct().join(done, ["a", "b"], "left_anti")
    rest = staged(likely(rest) if likely else rest, "rest")
    more = _verified(rest, rows, "rest_links", shingle).where("alike").select("a", "b")
    unstage(apart, rare, rest)
    return near.unionByName(more)


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of every group of near copies: the one with the least doc_id.

    Groups are what links connect; texts without words are one group.  Columns
    stay as they are, whatever their names.
    """
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"]
    rows = identified(docs.select("doc_id", "text", F.struct(*others).alias("row")), "text", "row")
    marked = staged(signatures(rows), "signatures")
    nodes = staged(marked.groupBy("one", "two", "n").agg(F.min(F.struct("_rid", "fp")).alias("s")).select(F.col("s._rid").alias("node"), F.col("s.fp").alias("fp")), "nodes")
    keys = marked.join(nodes, F.col("_rid") == F.col("node"), "left_semi").select(F.explode("keys").alias("key"), F.col("_rid").alias("node"), "n")
    found = links(rows, keys, before=fingerprint_links(rows, nodes))
    moved = components(found).where("node <> root").select("node")
    kept = nodes.join(moved, "node", "left_anti").select("node")
    gone = staged(marked.select(F.col("_rid").alias("g")).join(kept, F.col("g") == F.col("node"), "left_anti"), "gone")
    unstage(marked, nodes)
    parts = told(rows, "_rid", gone)
    left = parts.where("not _may").unionByName(parts.where("_may").join(gone, F.col("_rid") == F.col("g"), "left_anti"))
    return left.select(*[F.col("text") if c == "text" else F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
