import random
import re

import numpy as np
import pytest
import xxhash

from outflow.llm import simhash as sh
from outflow.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1 if words else 0))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_golay_is_perfect():
    golay = sh.Golay()
    rng = np.random.default_rng(1)
    message = rng.integers(0, 1 << 12, 500)
    table = golay.decode(np.arange(1 << 23))
    assert (np.bincount(table, minlength=4096) == 2048).all()
    codeword = np.array([int(np.flatnonzero(table == m)[0]) for m in message[:5]])
    assert len(set(table[codeword].tolist())) == len(set(message[:5].tolist()))
    x = rng.integers(0, 1 << 22, 2000)
    row, index = golay.nearby(x, 22)
    sets = [set(index[row == k].tolist()) for k in range(200)]
    assert {len(s) for s in sets} <= {1, 2, 3, 4, 5, 6}
    for k in range(200):
        assert int(golay.decode(x[k : k + 1] ^ (1 << (k % 22)))[0]) in sets[k]


def test_every_link_within_three_bits_is_found(spark):
    rng = random.Random(7)
    base = [rng.getrandbits(64) for _ in range(700)] + [0]
    every = set(base)
    for f in base:
        g = f
        for b in rng.sample(range(64), rng.randrange(1, 5)):
            g ^= 1 << b
        every.add(g)
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in every)
    got = {tuple(r) for r in sh.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()}
    mask = (1 << 64) - 1
    want = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & mask).bit_count() <= 3}
    assert got == want and len(want) > 400


def test_groups_against_plain_python(spark):
    rng = random.Random(3)
    vocab = [f"Word{k}" for k in range(400)]
    texts = [" ".join(rng.choices(vocab, k=rng.randrange(1, 300))) for _ in range(60)]
    for t in texts[:30]:
        words = t.split()
        words[rng.randrange(len(words))] = "changed"
        texts.append("\n".join(words))
    texts += [None, "", "  ", "one", "one two", "ONE", texts[0]]
    rows = [(1000 - i, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    fps = {i: fingerprint(t) for i, t, _ in rows}
    root = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 3 and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    got = {r["doc_id"]: (r["fp"] & ((1 << 64) - 1), r["component_id"]) for r in sh.near_duplicate_groups(docs).collect()}
    assert got == {i: (fps[i], root[i]) for i in fps}
    kept = sh.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(root.values()))


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a b c"), (5, "a b c"), (5, "a b c"), (None, "zz yy xx ww")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["component_id"])) for r in sh.near_duplicate_groups(docs).collect())
    assert got == [("5", "5"), ("5", "5"), ("None", "5"), ("None", "None")]
    assert sh.keep_one(docs).count() == 2
    clash = docs.selectExpr("doc_id", "7 as _rid", "text", "8 as k", "9 as component_id", "doc_id + 1 as row")
    assert sh.keep_one(clash).columns == clash.columns and {(r["_rid"], r["k"], r["component_id"]) for r in sh.keep_one(clash).collect()} == {(7, 8, 9)}
    assert sh.near_duplicate_groups(docs.limit(0)).count() == 0


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components(spark, shape):
    rng = random.Random(1)
    edges = {"chain": [(i, i + 1) for i in range(200)], "star": [(0, i) for i in range(1, 200)] + [(500, 501)], "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(150)]}[shape]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
