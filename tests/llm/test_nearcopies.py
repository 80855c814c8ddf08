import random
import re

import xxhash
from pyspark.sql import functions as F

import corpus_pipeline as cp
from outflow.llm import nearcopies as nc
from outflow.llm import simhash as sh

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").lower())
    return {" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1 if words else 0))}


def edited(rng, words, n):
    words = list(words)
    for k in rng.sample(range(len(words)), n):
        words[k] = f"changed{rng.randrange(10**6)}"
    return words


def least_of_groups(texts):
    """Ids kept, by comparing all pairs."""
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    pairs = 0
    for a in texts:
        for b in texts:
            either = len(sets[a] | sets[b])
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * either:
                pairs += sets[a] != sets[b]
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i for i in texts if find(i) == i}, pairs


def test_stage_links_all_pairs_at_08(spark):
    rng = random.Random(4)
    vocab = [f"w{k}" for k in range(3000)]
    texts = []
    for size in (30, 60, 150, 400, 1500):
        for _ in range(8):
            words = rng.choices(vocab, k=size)
            texts.append(" ".join(words))
            for part in (0.01, 0.02, 0.022, 0.03, 0.06):
                texts.append("\n".join(edited(rng, words, max(1, int(part * size)))).title())
    base = rng.choices(vocab, k=300)  # a large group, and a chain whose ends are unlike
    texts += [" ".join(edited(rng, base, 2)) for _ in range(60)]
    for _ in range(12):
        base = edited(rng, base, 5)
        texts.append(" ".join(base))
    texts += [None, "", "  ", "one", "ONE", "one two", "one two three four", texts[0]]
    rng.shuffle(texts)
    rows = [(3 * i - 700, t, i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node long")
    kept = cp.near_duplicates(spark, docs, "")
    want, pairs = least_of_groups({i: t for i, t, _ in rows})
    assert kept.columns == docs.columns and pairs > 400
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a b c"), (5, "a b c"), (5, "a b c"), (None, "zz yy xx ww"), (7, None), (7, "")], "doc_id long, text string")
    assert sorted(str(r["text"]) for r in nc.keep_one(docs).collect()) in (["None", "a b c", "zz yy xx ww"], ["", "a b c", "zz yy xx ww"])
    assert nc.keep_one(docs.limit(0)).count() == 0


def golay_groups(texts):
    """Least id of each text's group of five-word SimHash fingerprints, by comparing all pairs."""
    fps = {}
    for i, t in texts.items():
        words = WORD.findall((t or "").lower())
        hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 5]).encode(), 42) for k in range(max(len(words) - 4, 1 if words else 0))]
        fps[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    root, changed = {i: i for i in fps}, True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 3 and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return root


def test_stage_takes_golay_links_of_fingerprints_first(spark, monkeypatch):
    rng = random.Random(12)
    vocab = [f"w{k}" for k in range(2000)]
    texts = []
    for _ in range(12):
        words = rng.choices(vocab, k=600)
        texts += [" ".join(edited(rng, words, n)) for n in (0, 1, 1, 2, 12)]
    texts += [" ".join(rng.choices(vocab, k=50)) for _ in range(20)] + ["", "one"]
    texts = dict(enumerate(texts))
    seen, links, compared = [], sh.links, nc._verified

    def spied(fps, *more):
        seen.append(("links", fps.count()))
        return links(fps, *more)

    def recorded(pairs, rows, name, shingle):
        out = compared(pairs, rows, name, shingle)
        seen.append((name, {(r["a"], r["b"]): r["alike"] for r in out.collect()}))
        return out

    monkeypatch.setattr(sh, "links", spied)
    monkeypatch.setattr(nc, "_verified", recorded)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in cp.near_duplicates(spark, docs, "").collect())
    root, sets = golay_groups(texts), {i: shingles(t) for i, t in texts.items()}
    want = {(r, i): 5 * len(sets[r] & sets[i]) >= 4 * len(sets[r] | sets[i]) for i, r in root.items() if r != i}
    assert [s[0] for s in seen[:3]] == ["links", "fingerprint_links", "star_links"] and seen[0][1] > 60
    assert seen[1][1] == want and sum(want.values()) > 15
    home = {i: r if want.get((r, i)) else i for i, r in root.items()}
    assert seen[2][1] and all(home[a] != home[b] for a, b in seen[2][1])
    assert kept == sorted(least_of_groups(texts)[0])


def test_told_marks_all_named_rows_and_few_others(spark):
    rows = spark.range(-20000, 20000).select("id", F.lit("text").alias("text"))
    ids = rows.where("id % 100 = 0 or id = 7").selectExpr("id as i")
    marked = {r["id"]: r["_may"] for r in nc.told(rows, "id", ids).select("id", "_may").collect()}
    named = {r["i"] for r in ids.collect()}
    assert len(marked) == 40000 and all(marked[i] for i in named) and sum(marked.values()) <= len(named) + 20
    assert nc.told(rows, "id", ids.limit(0)).where("_may").count() == 0


def test_pairs_of_named_texts_are_compared(spark):
    rows = spark.range(4000).selectExpr("id as _rid", "concat('w', id, ' ', 'a b c d e f g') as text")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (3999, 2)], "a long, b long")
    tried = nc._verified(pairs, rows, "some", 5)
    assert sorted((r["a"], r["b"], r["shared"]) for r in tried.collect()) == [(1, 2, 3), (1, 3, 3), (3999, 2, 3)]
