import hashlib
import random
import re

import numpy as np

from outflow.llm import recompression as rc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, window):
    seen, out = set(), {}
    for key, text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for a in range(len(words) - window + 1):
            w = tuple(words[a : a + window])
            if w in seen:
                gone[a : a + window] = [True] * window
            seen.add(w)
        kept = " ".join(x for x, g in zip(words, gone) if not g)
        out[key] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def texts(seed, n):
    rng = random.Random(seed)
    passages = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.randrange(5, 70))) for _ in range(8)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(0, 6)):
            kind = rng.randrange(4)
            if kind == 0:
                parts.append(rng.choice(passages))
            elif kind == 1:
                parts.append("run " * rng.randrange(1, 80))
            elif kind == 2:
                parts.append("a b " * rng.randrange(1, 30))
            else:
                parts.append(" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(0, 60))))
        out.append(rng.choice([" ", "\n", "\t "]).join(parts))
    return out


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(1)
    for window in (3, 8, 20, 50):
        names = rng.integers(0, 3, 600).astype(np.uint64)
        at = np.array([0, 0, 5, 200, 410, 600])
        doc, begin, count, key, *_ = rc.window_anchors(names, at, window, rc.rounds_for(window))
        found = {}
        for d, b, c, k in zip(doc, begin, count, key):
            for s in range(b, b + c):
                w = tuple(names[at[d] + s : at[d] + s + window].tolist())
                assert found.setdefault(w, k) == k
        assert count.sum() == sum(max(0, z - a - window + 1) for a, z in zip(at, at[1:]))


def test_against_plain_windows(spark):
    for window in (6, 20):
        rows = [(i, t) for i, t in enumerate(texts(window, 120))]
        rows += [(500, None), (501, ""), (502, " \n "), (503, rows[3][1]), (504, "z " * 20000)]
        docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, key string").repartition(6)
        got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rc.remove_repeats(docs, window).collect()}
        assert got == plain(rows, window)


def test_only_verified_runs_go(spark, monkeypatch):
    """Were names and hashes to collide, the words would still be compared."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("pqrs") for _ in range(60))) for i in range(12)] + [(20, "p q r s " * 12), (21, "p q r s " * 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    covered = rc.repeated_stretches(docs.withColumn("_rid", docs.doc_id), 20)
    wrong = spark.createDataFrame([(5, 3, 10, 2, 8)], "rid long, start int, count int, src long, src_start int")
    monkeypatch.setattr(rc, "repeated_stretches", lambda *_: covered.unionByName(wrong))
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rc.remove_repeats(docs).collect()} == plain(rows, 20)


def test_repeated_and_null_ids(spark):
    text = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(None, text), (1, text), (1, text), (2, "short")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_removed"]) for r in rc.remove_repeats(docs).collect())
    assert got == [("1", 30), ("1", 30), ("2", 0), ("None", 0)]
    assert rc.remove_repeats(docs.limit(0)).count() == 0
