"""Near duplicates by an inverted join over signature coordinates (operator 13).

A text's set of four-word shingles has a signature of ``COORDINATES`` minimum
hashes; two texts with a Jaccard likeness of 0.8 agree in fewer than ``MATCHES``
of them with a probability of 3.3e-7.  Texts with equal sets are one node.

Nodes are posted under each (coordinate, value) pair and the collisions of two
nodes are the lists that both are on:

* lists with one node say nothing; a node on fewer than ``MATCHES`` others is done;
* prefix: with all lists ordered by length, two nodes that meet in ``MATCHES``
  lists meet in one of the shortest m - ``MATCHES`` + 1 of either's m lists, so
  only these are merged and the longest are skipped;
* a list is merged through its centre, the node on the longest lists: each other
  node's collisions with it are counted from the two signatures, and only pairs
  with ``MATCHES`` or more have their texts compared;
* pairs of nodes that this leaves apart are formed only where what both share
  with the centre allows a likeness of 0.8 (see ``nearcopies``), and they too
  need ``MATCHES`` collisions.

What is left is confirmed on the full sets and linked to components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outflow.llm import bytewords as bw
from outflow.llm import nearcopies as nc
from outflow.llm.components import components
from outflow.llm.shared import identified, staged, unstage

SHINGLE = 4
COORDINATES, MATCHES = 64, 34
_RNG = np.random.default_rng(13)
_TIMES = _RNG.integers(0, 1 << 32, COORDINATES, dtype=np.uint32) | np.uint32(1)
_PLUS = _RNG.integers(0, 1 << 32, COORDINATES, dtype=np.uint32)
_SIGNED = "_rid long, one long, two long, n long, signature binary"


def coordinates(row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that have shingles, and their signatures (one unsigned 32-bit number a coordinate)."""
    full, begin = np.unique(row, return_index=True)
    out = np.zeros((len(full), COORDINATES), "<u4")
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for k in range(COORDINATES if len(full) else 0):
        x = short * _TIMES[k] + _PLUS[k]
        out[:, k] = np.minimum.reduceat(x ^ (x >> np.uint32(15)), begin)
    return full, out


def signatures(rows: DataFrame) -> DataFrame:
    """(_rid, one, two, n, signature) of every whole text: its set as two sums and a size; null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in bw.row_slices(whole, "text"):
                many = batch.num_rows
                row, hashes = nc.shingle_sets(*bw.text_bytes(batch.column("text")), SHINGLE)
                full, signed = coordinates(row, hashes)
                begin = np.searchsorted(row, full)
                one, two = np.zeros(many, np.uint64), np.zeros(many, np.uint64)
                made: list[bytes | None] = [None] * many
                if len(full):
                    one[full] = np.add.reduceat(hashes, begin)
                    two[full] = np.add.reduceat(bw.mix64(hashes), begin)
                    for k, r in enumerate(full.tolist()):
                        made[r] = signed[k].tobytes()
                n = np.bincount(row, minlength=many)
                yield pa.RecordBatch.from_arrays([batch.column("_rid"), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(n, pa.int64()), pa.array(made, pa.binary())], names=["_rid", "one", "two", "n", "signature"])

    return rows.select("_rid", F.col("text").cast("string").alias("text")).mapInArrow(run, _SIGNED)


def _posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node under each of its (coordinate, value) pairs."""
    tag = np.arange(COORDINATES, dtype=np.int64) << 32
    for whole in batches:
        for at in range(0, whole.num_rows, 10_000):
            batch = whole.slice(at, 10_000)
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u4").reshape(-1, COORDINATES)
            keys = (values.astype(np.int64) | tag).reshape(-1)
            node, n = (np.repeat(np.asarray(batch.column(c)), COORDINATES) for c in ("node", "n"))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(node), pa.array(n)], names=["key", "node", "n"])


def prefixes(nodes: DataFrame) -> DataFrame:
    """(key, node, n): the shortest lists of each node, as many as any partner needs; ``nodes``: node, n, signature."""
    posts = staged(nodes.mapInArrow(_posted, "key long, node long, n long"), "posts")
    lists = staged(posts.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").withColumnRenamed("key", "k"), "lists")
    shared = posts.join(lists, F.col("key") == F.col("k")).drop("k")
    mine = W.partitionBy("node")  # one row a coordinate at most
    ranked = shared.withColumns({"m": F.count(F.lit(1)).over(mine), "nth": F.row_number().over(mine.orderBy("size", "key"))})
    found = staged(ranked.where(f"nth <= m - {MATCHES} + 1").select("key", "node", "n"), "prefixes")
    unstage(posts, lists)
    return found


def _collisions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 20_000):
            batch = whole.slice(at, 20_000)
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, COORDINATES) for c in ("signature_a", "signature_b"))
            keep = pa.array((one == two).sum(axis=1) >= MATCHES)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])


def colliding(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures agree in ``MATCHES`` coordinates or more."""
    side = lambda c: nodes.select(F.col("node").alias(f"_{c}"), F.col("signature").alias(f"signature_{c}"))
    met = pairs.join(side("a"), F.col("a") == F.col("_a")).drop("_a").join(side("b"), F.col("b") == F.col("_b")).drop("_b")
    return met.select("a", "b", "signature_a", "signature_b").mapInArrow(_collisions, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Rows link where 100 times the shared shingles is 80 times all of both or
    more; component_id is the least doc_id that links reach (null only where no
    row there has one), and kept marks the rows that bear it.  A text of fewer
    than four words is one shingle; a null or empty one, or one without words, has
    none and is alone.  Repeated rows and ids are rows of their own; an empty table gives no rows, texts of any
    length are read whole, and other columns are ignored.
    """
    rows = identified(docs.select("doc_id", "text"), "text")
    marked = staged(signatures(rows), "signatures")
    worded = marked.where("n > 0")
    nodes = staged(worded.groupBy("one", "two", "n").agg(F.min(F.struct("_rid", "signature")).alias("s")).select("one", "two", "n", F.col("s._rid").alias("node"), F.col("s.signature").alias("signature")), "nodes")
    sets = nodes.select("node", "n", "signature")
    found = nc.links(rows, prefixes(sets), SHINGLE, lambda pairs: colliding(pairs, sets))
    roots = components(found).withColumnRenamed("node", "x")
    of_set = nodes.join(roots, F.col("node") == F.col("x"), "left").select(F.col("one").alias("o"), F.col("two").alias("t"), F.col("n").alias("m"), F.coalesce("root", "node").alias("root"))
    placed = marked.drop("signature").join(of_set, (F.col("one") == F.col("o")) & (F.col("two") == F.col("t")) & (F.col("n") == F.col("m")), "left").select("_rid", "n", F.coalesce("root", "_rid").alias("root"))
    placed = staged(placed, "placed")
    unstage(marked, nodes)
    named = rows.select(F.col("_rid").alias("r"), "doc_id").join(placed, F.col("r") == F.col("_rid")).select("doc_id", "n", "root")
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id")).withColumnRenamed("root", "c")
    return named.join(least, F.col("root") == F.col("c")).select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op13_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * shared >= 80 * (na.n + nb.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN c ON c.node = w.doc_id
"""
