"""Toxicity by a bidirectional gated recurrent network (operator 7).

Every word enters as a learned word vector beside the mean of its learned
vectors for character runs of three and five.  Two gated recurrent passes read windows of words,
one from each side; attention pools their states; a document's score is that of
its highest window, over all windows, each overlapping the next by half.

The network is trained here, in numpy, on a bounded sample of labelled rows that
are not held out: the label belongs to the document, so the loss is taken on the
log-sum of its windows and the windows that carry the signal find themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outflow.llm import bytewords as bw

WINDOW, STRIDE = 32, 16
WORDS, GRAMS, WIDTH, HIDDEN = 1 << 14, 1 << 15, 8, 8
#: Bounds of the training sample: rows of each label, and bytes of a text.
SAMPLE_ROWS, SAMPLE_BYTES = 1500, 12_000
#: Text that a task scores at once.
SLICE_BYTES = 1 << 18
EPOCHS, BATCH, RATE, FLOOR, SEED = 3, 48, 0.02, 1e-6, 11


def word_inputs(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Distinct words of a batch: row of each word, word bucket, trigram buckets, trigram offsets."""
    names = bw.hash_spans(buf, starts, ends)
    _, first, row = np.unique(names, return_index=True, return_inverse=True)
    a, z = starts[first], ends[first]
    size = z - a
    # Each word between two marks: as many grams of three bytes as it has bytes,
    # and as many of five (shorter at its edges).
    offsets = np.cumsum(size) - size
    at = np.arange(int(size.sum())) - np.repeat(offsets, size) + np.repeat(a, size)
    low, high = np.repeat(a, size), np.repeat(z, size) - 1
    near = [np.where(at + k < low, 1, np.where(at + k > high, 2, buf[np.clip(at + k, 0, len(buf) - 1)])).astype(np.uint64) << np.uint64(8 * (k + 2)) for k in range(-2, 3)]
    three = near[1] | near[2] | near[3]
    both = np.stack([three, three | near[0] | near[4] | np.uint64(1 << 50)], axis=1).ravel()
    grams = (bw.mix64(both) % np.uint64(GRAMS)).astype(np.int64)
    offsets = offsets * 2
    return row, (names[first] % np.uint64(WORDS)).astype(np.int64), grams, offsets


def window_rows(counts: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, first word) of all windows; an empty document has one, of padding."""
    many = np.maximum(1, -(-(counts - WINDOW) // stride) + 1)
    doc = np.repeat(np.arange(len(counts)), many)
    return doc, (np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)) * stride


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + np.float32(0.5)


class Network:
    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        draw = lambda *s, scale=0.3: (rng.standard_normal(s) * scale).astype(np.float32)
        self.p = {"word": np.zeros((WORDS, WIDTH), np.float32), "gram": draw(GRAMS, WIDTH, scale=0.1), "look": draw(2 * HIDDEN), "out": draw(2 * HIDDEN, scale=0.6), "bias": np.full(1, -3.0, np.float32)}
        for d in "fb":
            self.p |= {f"in_{d}": draw(2 * WIDTH, 3 * HIDDEN), f"rec_{d}": draw(HIDDEN, 3 * HIDDEN), f"add_{d}": np.zeros(3 * HIDDEN, np.float32)}

    def embed(self, words, grams, offsets):
        """Inputs of distinct words, and their projections for both passes; the last row is padding."""
        p = self.p
        n = len(words)
        each = np.zeros((n, 2 * WIDTH), np.float32)
        if n:
            each[:, :WIDTH] = p["word"][words]
            size = np.diff(np.append(offsets, len(grams)))
            each[:, WIDTH:] = np.add.reduceat(p["gram"][grams], offsets, axis=0) / size[:, None]
        tables = {}
        for d in "fb":
            table = np.zeros((n + 1, 3 * HIDDEN), np.float32)
            table[:n] = each @ p[f"in_{d}"] + p[f"add_{d}"]
            table[n, :HIDDEN] = 30  # padding keeps the state
            tables[d] = table
        return each, tables

    def run(self, tables, index, keep: bool = False):
        """Logits of windows whose word rows are ``index`` (windows x WINDOW)."""
        p, h2 = self.p, HIDDEN
        n, steps = index.shape
        states = np.empty((steps, n, 2 * HIDDEN), np.float32)
        kept = {}
        for d in "fb":
            h = np.zeros((n, HIDDEN), np.float32)
            order = range(steps) if d == "f" else range(steps - 1, -1, -1)
            side = slice(0, HIDDEN) if d == "f" else slice(HIDDEN, None)
            log = []
            for t in order:
                x, v = tables[d][index[:, t]], h @ p[f"rec_{d}"]
                gates = _sigmoid(x[:, : 2 * h2] + v[:, : 2 * h2])
                z, r = gates[:, :h2], gates[:, h2:]
                c = np.tanh(x[:, 2 * h2 :] + r * v[:, 2 * h2 :])
                new = c + z * (h - c)
                if keep:
                    log.append((t, h, z, r, c, v[:, 2 * h2 :]))
                h = new
                states[t, :, side] = h
            kept[d] = log
        look = states @ p["look"]
        pad = tables["f"].shape[0] - 1
        look = np.where(index.T == pad, np.float32(-1e4), look)
        look -= look.max(axis=0)
        weight = np.exp(look)
        weight /= weight.sum(axis=0)
        pooled = (states * weight[:, :, None]).sum(axis=0)
        logit = pooled @ p["out"] + p["bias"]
        return (logit, pooled, weight, states, kept) if keep else logit

    def gradients(self, inputs, index, doc, labels):
        """Gradients of the summed loss over a batch of documents; ``doc`` is sorted."""
        words, grams, offsets = inputs
        each, tables = self.embed(words, grams, offsets)
        logit, pooled, weight, states, kept = self.run(tables, index, keep=True)
        p, g = self.p, {}
        first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        top = np.maximum.reduceat(logit, first)
        mass = np.exp(logit - top[doc])
        total = np.add.reduceat(mass, first)
        z = top + np.log(total)
        error = _sigmoid(z) - labels
        d_logit = (error[doc] * mass / total[doc]).astype(np.float32)
        g["out"], g["bias"] = d_logit @ pooled, d_logit.sum(keepdims=True)
        d_pooled = d_logit[:, None] * p["out"]
        d_weight = (states * d_pooled).sum(axis=2)
        d_look = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["look"] = np.tensordot(d_look, states, axes=([0, 1], [0, 1]))
        d_states = weight[:, :, None] * d_pooled + d_look[:, :, None] * p["look"]
        n, steps = index.shape
        d_each = np.zeros_like(each)
        for d in "fb":
            side = slice(0, HIDDEN) if d == "f" else slice(HIDDEN, None)
            rec = p[f"rec_{d}"]
            d_rec, d_table = np.zeros_like(rec), np.empty((steps, n, 3 * HIDDEN), np.float32)
            d_h = np.zeros((n, HIDDEN), np.float32)
            for t, h, z, r, c, v in reversed(kept[d]):
                d_h = d_h + d_states[t, :, side]
                d_z = d_h * (h - c) * z * (1 - z)
                d_c = d_h * (1 - z) * (1 - c * c)
                d_r = d_c * v * r * (1 - r)
                d_table[t] = np.concatenate([d_z, d_r, d_c], axis=1)
                d_v = np.concatenate([d_z, d_r, d_c * r], axis=1)
                d_rec += h.T @ d_v
                d_h = d_h * z + d_v @ rec.T
            g[f"rec_{d}"] = d_rec
            flat, grad = index.T.ravel(), d_table.reshape(-1, 3 * HIDDEN)
            order = np.argsort(flat, kind="stable")
            seen, begin = np.unique(flat[order], return_index=True)
            rows = np.add.reduceat(grad[order], begin, axis=0)
            real = seen < len(words)
            seen, rows = seen[real], rows[real]
            g[f"add_{d}"] = rows.sum(axis=0)
            g[f"in_{d}"] = each[seen].T @ rows
            d_each[seen] += rows @ p[f"in_{d}"].T
        g["word"], g["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
        np.add.at(g["word"], words, d_each[:, :WIDTH])
        size = np.diff(np.append(offsets, len(grams)))
        np.add.at(g["gram"], grams, np.repeat(d_each[:, WIDTH:] / np.maximum(size, 1)[:, None], size, axis=0))
        return g

    def prepare(self, texts: list[str | None], stride: int):
        """Inputs of a batch of texts: distinct words, windows, and the windows' documents."""
        buf, offsets = bw.text_bytes(pa.array(texts, pa.string()))
        return self.prepare_bytes(buf, offsets, stride)

    @staticmethod
    def prepare_bytes(buf, offsets, stride: int):
        buf = bw.lower_ascii(buf)
        starts, ends, at = bw.split_words(buf, offsets)
        if len(starts):
            row, words, grams, grams_at = word_inputs(buf, starts, ends)
        else:
            row = words = grams = grams_at = np.zeros(0, np.int64)
        doc, first = window_rows(np.diff(at), stride)
        spot = first[:, None] + np.arange(WINDOW)
        inside = spot < np.diff(at)[doc][:, None]
        index = np.full(spot.shape, len(words))
        index[inside] = row[(at[doc][:, None] + spot)[inside]]
        return (words, grams, grams_at), index, doc

    def fit(self, texts: list[str], labels: np.ndarray, epochs: int = EPOCHS) -> Network:
        rng = np.random.default_rng(SEED)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, rounds = 0, max(epochs, -(-epochs * 40 * BATCH // len(texts)))  # few rows: as many steps as 40 batches an epoch
        for epoch in range(rounds):
            order = rng.permutation(len(texts))
            for at in range(0, len(order), BATCH):
                batch = order[at : at + BATCH]
                inputs, index, doc = self.prepare([texts[i] for i in batch], WINDOW)
                g = self.gradients(inputs, index, doc, labels[batch].astype(np.float32))
                step += 1
                rate = RATE * min(1.0, 1.5 * (1 - epoch / rounds) + 0.05)
                for k, x in g.items():
                    x = x / len(batch)
                    mean[k] += 0.1 * (x - mean[k])
                    square[k] += 0.01 * (x * x - square[k])
                    up = mean[k] / (1 - 0.9**step)
                    self.p[k] -= (rate * up / (np.sqrt(square[k] / (1 - 0.99**step)) + FLOOR)).astype(np.float32)
        return self

    def score_bytes(self, buf, offsets) -> np.ndarray:
        """Scores of whole texts: the highest of all overlapping windows."""
        inputs, index, doc = self.prepare_bytes(buf, offsets, STRIDE)
        _, tables = self.embed(*inputs)
        logits = np.concatenate([self.run(tables, index[i : i + 1024]) for i in range(0, len(index), 1024)])
        first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        return 1 / (1 + np.exp(-np.maximum.reduceat(logits, first).astype(np.float64)))


def held_out(doc_id):
    """Rows that training never sees: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES) -> tuple[list[str], np.ndarray]:
    """Texts and labels: at most ``rows`` labelled ids of each class that aren't held out.

    Ids are drawn in hash order before any text is read, so the join's small
    side has 2 x ``rows`` rows at most whatever the tables hold.  An id gives one
    text, the least of those within the bound, so no more than that many texts of
    ``most_bytes`` reach the driver however often ids repeat.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select(F.col("doc_id").cast("long").alias("label_id"), F.col("toxic").cast("int").alias("label"))
    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length("text").alias("n_bytes")).where(F.col("n_bytes").between(1, most_bytes))
    able = known.join(lean, known["label_id"] == lean["doc_id"], "left_semi")
    drawn = [able.where(F.col("label") == y).orderBy(F.xxhash64("label_id"), "label_id").limit(rows) for y in (0, 1)]
    ids = drawn[0].unionByName(drawn[1]).distinct()
    able = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.octet_length("text").between(1, most_bytes))
    texts = able.join(F.broadcast(ids), F.col("doc_id") == F.col("label_id")).groupBy("label_id", "label").agg(F.min("text").alias("text"))
    found = sorted((r["label_id"], r["label"], r["text"]) for r in texts.collect())
    return [t for _, _, t in found], np.array([y for _, y, _ in found], dtype=np.int64)


def train(docs: DataFrame, labels: DataFrame) -> Network | float:
    """The fitted network, or where labels of one kind are missing their share of toxic ones (0.25 without labels)."""
    texts, y = training_sample(docs, labels)
    if len(set(y.tolist())) < 2:
        return float((y.sum() + 0.5) / (len(y) + 2))
    return Network().fit(texts, y)


def score_toxicity(docs: DataFrame, model: Network | float) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    A null or empty text scores as a window of padding.  Rows are scored one by
    one from their text alone: repeated and null ids keep their rows, an empty
    table gives none, and no other column is read, whatever its name.  All
    windows of a text count, however long it is.  Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for batch in bw.row_slices(whole_batch, "text", SLICE_BYTES):
                score = np.full(batch.num_rows, model) if isinstance(model, float) else model.score_bytes(*bw.text_bytes(batch.column("text")))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, pa.float64())], names=["doc_id", "score"])

    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = cut.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Network | float) -> DataFrame:
    """``docs`` without the rows the model calls toxic; columns and order of columns stay.

    Without a network nothing tells one text from another, and all rows stay.
    """
    if isinstance(model, float):
        return docs
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for batch in bw.row_slices(whole_batch, "text", SLICE_BYTES):
                score = model.score_bytes(*bw.text_bytes(batch.column("text")))
                yield batch.filter(pa.array(score < 0.5))

    return docs.mapInArrow(run, schema)


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_toxicity(docs, train(docs, labels))
