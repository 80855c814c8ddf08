import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from outflow.llm import bytewords as bw
from outflow.llm import digests as dg


def test_sliding_entropy_matches_plain_counts():
    rng = np.random.default_rng(1)
    buf = rng.integers(0, 7, 300).astype(np.uint8)
    buf[100:180] = 3
    got = dg.entropy_classes(buf)
    assert len(got) == 300 - 63
    for i in range(len(got)):
        h = -sum(c / 64 * math.log2(c / 64) for c in Counter(buf[i : i + 64].tolist()).values())
        assert abs(got[i] - h / 6 * 1000) <= 1.01


def digest(texts, ranks=None):
    ranks = np.arange(dg.CLASSES + 1) if ranks is None else ranks
    return dg.Digests(*bw.text_bytes(pa.array(texts)), ranks)


def test_digests_do_not_depend_on_the_batch():
    rng = random.Random(4)
    texts = ["", "short", "x" * 300] + ["".join(rng.choice("abcdefgh tion é.") for _ in range(n)) for n in (63, 64, 80, 127, 130, 2000, 30000)]
    together = digest(texts)
    for i, t in enumerate(texts):
        assert digest([t]).text(0) == together.text(i)
    k = np.arange(len(texts))
    assert dg.likeness(together, k, together, k).tolist() == [1.0] * len(texts)
    assert dg.likeness(together, k[1:2], together, k[:1]).tolist() == [0.0]


def plain_hash(data, seed=0):
    mask = (1 << 64) - 1

    def mix(x):
        x = (x + 0x9E3779B97F4A7C15) & mask
        x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ x >> 27) * 0x94D049BB133111EB) & mask
        return x ^ x >> 31

    h = mix(len(data) ^ seed)
    for k in range(0, max(len(data), 1), 8):
        h = mix(h ^ int.from_bytes(data[k : k + 8], "little"))
    return h


def plain_features(data, ranks):
    """Hashes of the chosen windows of one text, window by window."""
    n, out = len(data), []
    if n < 12:
        return [plain_hash(data, 5)] if n else []
    if n < 127:
        rank = []
        for i in range(n - 11):
            counts = Counter(data[i : i + 12])
            share = sum(c * math.log2(c) for c in counts.values()) / (12 * math.log2(12))
            rank.append(ranks[1000 - round(share * 1000)])
        run = min(8, len(rank))
        chosen = {min(range(r, r + run), key=lambda i: (rank[i], i)) for r in range(len(rank) - run + 1)}
        return [plain_hash(data[i : i + 12], 9) for i in sorted(chosen)]
    phi = [round(c * math.log2(c) * 65536) if c else 0 for c in range(65)]
    rank = [ranks[1000 - sum(phi[c] for c in Counter(data[i : i + 64]).values()) * 1000 // phi[64]] for i in range(n - 63)]
    votes = Counter(min(range(r, r + 64), key=lambda i: (rank[i], i)) for r in range(len(rank) - 63))
    chosen = sorted(i for i, v in votes.items() if v >= 16 and rank[i] < 1000)
    return [plain_hash(data[i : i + 64]) for i in chosen] or [plain_hash(data, 5)]


def plain_filters(features):
    """(number of features, set of bits) of each filter of the chain."""
    out = []
    for k in range(0, len(features), 160):
        part = features[k : k + 160]
        out.append((len(part), {h >> 11 * j & 2047 for h in part for j in range(5)}))
    return out


def plain_text(filters):
    show = lambda bits: sum(1 << (2047 - b) for b in bits).to_bytes(256, "big").hex()
    return ".".join(f"{n:02x}{show(bits)}" for n, bits in filters)


def plain_likeness(a, b):
    if not a or not b:
        return float(not a and not b)
    short, long = (b, a) if len(a) > len(b) else (a, b)
    score = weight = 0
    for n, x in short:
        best = 0
        for _, y in long:
            chance = len(x) * len(y) / 2048
            best = max(best, min(1, max(0, (len(x & y) - chance) / max(min(len(x), len(y)) - chance, 1e-9))))
        score, weight = score + best * n, weight + n
    return score / weight


def test_fingerprints_equal_plain_ones():
    rng = random.Random(11)
    ranks = np.random.default_rng(2).permutation(dg.CLASSES + 1)
    ranks[:100] = dg.CLASSES
    texts = ["", "x", "short", "twelve bytes", "a" * 100, "ab" * 90, *("".join(rng.choice("abcdefgh tion é.,THE 0189") for _ in range(n)) for n in (11, 13, 40, 63, 64, 90, 126, 127, 128, 190, 900, 9000))]
    got = digest(texts, ranks)
    want = [plain_filters(plain_features(t.encode(), ranks)) for t in texts]
    for i in range(len(texts)):
        assert got.text(i) == plain_text(want[i]), texts[i]
    for j, other in enumerate(texts[1:] + texts[:1]):
        near = texts[j][: len(texts[j]) // 2] + other[: len(texts[j]) // 2]
        two = digest([near], ranks)
        assert abs(dg.likeness(got, np.array([j]), two, np.array([0]))[0] - plain_likeness(want[j], plain_filters(plain_features(near.encode(), ranks)))) < 1e-9


def test_short_texts_keep_part_of_their_likeness():
    rng = random.Random(3)
    near, far = [], []
    for n in (40, 60, 90, 120):
        for _ in range(10):
            one, two = ("".join(rng.choice("abcdefghijklmnop qrst") for _ in range(n)) for _ in "ab")
            d = digest([one, dg.edit(one, two), two])
            near.append(dg.likeness(d, np.array([0]), d, np.array([1]))[0])
            far.append(dg.likeness(d, np.array([0]), d, np.array([2]))[0])
    assert min(near) > max(far) and max(far) < 0.2


def test_query_against_plain_python(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdefghij klmnop tion é.") for _ in range(rng.randrange(0, 3000))) for _ in range(60)]
    texts[10] = texts[11] = texts[12]
    texts[20], texts[21] = None, ""
    rows = [(i * 3 - 7, t, "x") for i, t in enumerate(texts)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").repartition(5)
    got = {r["doc_id"]: r for r in dg.fingerprint_documents(docs).collect()}
    order = sorted(rows)
    assert len(got) == len(rows)
    for (i, t, _), (j, u, _) in zip(order, order[1:] + order[:1]):
        t, u, r = t or "", u or "", got[i]
        edited = t[: len(t) - len(t) // 2] + u[: len(t) // 2]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if t == u:
            assert r["near_next"] == 1 and r["fingerprint"] == got[j]["fingerprint"]
        elif len(t) > 800 and len(u) > 800:
            assert r["near_next"] < 0.2 < r["near_edited"] < 0.9
    assert dg.fingerprint_documents(docs.limit(0)).count() == 0
    lone = dg.fingerprint_documents(spark.createDataFrame([(1, "abc")], "doc_id long, text string")).first()
    assert lone["near_next"] == 1 and lone["n_chars"] == 3
    twice = spark.createDataFrame([(1, "abc"), (1, "abd"), (None, "x")], "doc_id long, text string")
    assert dg.fingerprint_documents(twice).count() == 3
