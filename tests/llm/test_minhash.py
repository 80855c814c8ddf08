import random
import re

import numpy as np

from outflow.llm import minhash as mh
from tests.llm.test_nearcopies import edited

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1 if words else 0))}


def plain(rows):
    """(doc_id, n, component, kept) by comparing all pairs of rows."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    different = 0
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                different += sets[a] != sets[b]
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted((str(i), len(sets[k]), str(least.get(find(k))), i == least.get(find(k))) for k, (i, _) in enumerate(rows)), different


def found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 as _rid", "2 as node", "3 as n", "4 as root", "5 as signature", "6 as key")
    got = mh.near_duplicates(docs.repartition(3))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in got.collect())


def test_against_all_pairs(spark):
    rng = random.Random(8)
    vocab = [f"w{k}" for k in range(3000)]
    texts = []
    for size in (6, 12, 30, 60, 150, 400, 1500):
        for _ in range(6):
            words = rng.choices(vocab, k=size)
            texts.append(" ".join(words))
            for part in (0.01, 0.02, 0.025, 0.03, 0.06):
                texts.append("\n".join(edited(rng, words, max(1, int(part * size)))).title())
    passage = rng.choices(vocab, k=120)  # many texts share it and little else
    texts += [" ".join(rng.choices(vocab, k=k) + passage) for k in (20, 28, 40, 60, 90) for _ in range(12)]
    base = rng.choices(vocab, k=300)  # a large group around a base, parts of it, and a chain whose ends are unlike
    texts += [" ".join(edited(rng, base, 3)) for _ in range(60)]
    texts += [" ".join(base[: 100 + 4 * k]) for k in range(20)]
    for _ in range(12):
        base = edited(rng, base, 5)
        texts.append(" ".join(base))
    texts += [None, "", "  ", "one", "ONE", "one two", "one two three four", texts[0], texts[0]]
    rng.shuffle(texts)
    rows = [(3 * i - 700, t) for i, t in enumerate(texts)]
    want, different = plain(rows)
    assert different > 400
    assert found(spark, rows) == want


def test_odd_rows(spark):
    rows = [(None, "a b c"), (5, "a b c"), (5, "a b c"), (None, "zz yy xx ww"), (7, None), (7, ""), (6, "x " * 30_000), (8, "X " * 20_000)]
    assert found(spark, rows) == plain(rows)[0]
    assert found(spark, []) == []


def test_matches_follow_the_likeness():
    rng = np.random.default_rng(3)
    for size in (10, 100, 2000):
        agree = []
        for _ in range(300):
            both = rng.integers(0, 1 << 64, size, dtype=np.uint64)
            cut = size // 10
            one, two = np.sort(both[cut:]), np.sort(both[: size - cut])
            sets = np.concatenate([one, two])
            _, signed = mh.coordinates(np.repeat([0, 1], [len(one), len(two)]), sets)
            agree.append(int((signed[0] == signed[1]).sum()))
        # The likeness is 0.8: the mean is near its share, and no pair falls below the threshold.
        assert abs(np.mean(agree) / mh.COORDINATES - 0.8) < 0.02 and min(agree) >= mh.MATCHES
