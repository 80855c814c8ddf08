import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from outflow.llm import phrases as ph


def plain(rows, most_words=3, least=10, share=50, top=2000):
    """The same by dictionaries of all phrases."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, most_words + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    often = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    longer = {}
    for (lang, words), a in often.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                key = lang, words[i : i + k]
                longer[key] = max(longer.get(key, 0), a)
    out = {}
    for (lang, words), a in often.items():
        if 100 * longer.get((lang, words), 0) >= share * a and (lang, words) in longer:
            continue
        cuts = [(10**6 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return {(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for lang, rows in out.items() for i, (s, a, p, x, y) in enumerate(sorted(rows)[:top])}


def corpus(seed=1, n=400):
    rng = random.Random(seed)
    vocab = ["alpha", "Beta", "gamma", "é", "日本", "the", "of", "the", "x", "\xa0y", "z-1", "NEW", "york", "😀"]
    rows = []
    for _ in range(n):
        words = rng.choices(vocab, k=rng.randrange(0, 40))
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words) + 1) : 0] = ["New", "York", "city"]
        rows.append((rng.choice(["en", "de", None, "und", ""]), "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "! "]) for w in words)))
    return rows + [("en", None), ("en", ""), (None, " "), ("en", "a a a " * 50), ("en", "New York city hall " * 4000)]


def found(spark, rows, **more):
    docs = spark.createDataFrame([(1, lang, text) for lang, text in rows], "phrase long, lang string, text string")
    got = ph.collocations(docs.repartition(3), **more)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("more", [{"buckets": 64}, {"most_words": 4, "least": 4, "buckets": 1 << 18}, {"top": 7, "share": 90}, {"most_words": 2, "least": 300}])
def test_against_all_phrases(spark, more):
    rows = corpus()
    want = {k: v for k, v in more.items() if k != "buckets"}
    assert found(spark, rows, **more) == plain(rows, **want)


def test_empty_table_and_bad_parameters(spark):
    assert found(spark, []) == set()
    assert found(spark, [("en", None)] * 3) == set()
    with pytest.raises(ValueError):
        ph.collocations(spark.createDataFrame([], "lang string, text string"), buckets=100)


def test_equal_scores_go_by_count_and_bytes(spark):
    rows = [("en", "é b. a b2. A b2. é b. ab c.") for _ in range(12)]
    got = sorted(found(spark, rows), key=lambda r: r[1])
    assert [(r[2], r[3]) for r in got] == [("a b2", 24), ("é b", 24), ("ab c", 12)]


def test_passes_agree_on_hashes():
    buf = np.frombuffer("zwei drei zwei".encode(), np.uint8)
    starts, ends, row, piece = ph.pieces(buf, np.array([0, len(buf)]))
    words = [ph.bw.hash_spans(buf, starts, ends, seed) for seed in (0, 1)]
    salt = np.repeat(ph._salts(pa.array(["de"])), 3)
    _, h, _ = ph.grams(words, piece, salt, 2)
    batch = pa.RecordBatch.from_arrays([pa.array(["de", "de"]), pa.array(["zwei drei", "drei zwei"])], names=["lang", "phrase"])
    assert ph.phrase_hashes(batch).tolist() == h.tolist()


def test_buckets_never_lose_a_frequent_phrase():
    counts = ph._Buckets(1 << 17, 10)
    for _ in range(4):
        counts.add(np.array([3, 3, 3, 70_000], np.uint64))
    got = {b: (np.frombuffer(at, "<u2").tolist(), list(times)) for b, at, times in counts.blocks()}
    assert got == {0: ([3], [10]), 1: ([70_000 - 65_536], [4])}
