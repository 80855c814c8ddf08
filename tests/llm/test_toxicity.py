import random
import zlib

import numpy as np
import pyarrow as pa

from outflow.llm import bytewords as bw
from outflow.llm import toxicity as tx


def corpus(seed, n):
    rng = random.Random(seed)
    vocab = [f"{a}{b}{c}" for a in ("th", "an", "er", "on") for b in ("ing", "tion", "es") for c in ("a", "le", "ou", "st")]
    texts, labels = [], []
    for i in range(n):
        words = rng.choices(vocab, k=rng.randrange(5, 200))
        bad = i % 3 == 0
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "SCUM", "loser,", "gargle" + rng.choice(vocab)]))
        texts.append(" ".join(words))
        labels.append(int(bad))
    return texts, np.array(labels)


def test_gradients_match_differences():
    net = tx.Network()
    inputs, index, doc = net.prepare(["a bad idiot here now", "all good and fine text " * 20], tx.WINDOW)
    y = np.array([1.0, 0.0], np.float32)

    def loss():
        _, tables = net.embed(*inputs)
        logit = net.run(tables, index).astype(np.float64)
        z = np.array([np.logaddexp.reduce(logit[doc == d]) for d in (0, 1)])
        return float(np.sum(np.logaddexp(0, z) - y * z))

    grads = net.gradients(inputs, index, doc, y)
    for k, g in grads.items():
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = net.p[k][i]
        net.p[k][i] = old + 1e-2
        up = loss()
        net.p[k][i] = old - 1e-2
        down = loss()
        net.p[k][i] = old
        assert abs((up - down) / 2e-2 - g[i]) < 2e-3 + 0.01 * abs(g[i]), k


def plain_score(net, text):
    """The highest window's score, word by word and gate by gate."""
    mask = (1 << 64) - 1
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words = [w.encode() for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))]

    def mix(x):
        return int(bw.mix64(np.array([x & mask], np.uint64))[0])

    def entered(word):
        name = int(bw.hash_spans(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))[0])
        byte = lambda i: 1 if i < 0 else 2 if i >= len(word) else word[i]
        grams = []
        for i in range(len(word)):
            three = byte(i - 1) << 8 | byte(i) << 16 | byte(i + 1) << 24
            grams += [mix(three) % tx.GRAMS, mix(three | byte(i - 2) | byte(i + 2) << 32 | 1 << 50) % tx.GRAMS]
        return np.concatenate([p["word"][name % tx.WORDS], np.mean([p["gram"][g] for g in grams], axis=0)])

    sig = lambda x: 1 / (1 + np.exp(-x))
    h2, best = tx.HIDDEN, -np.inf
    starts = range(0, max(1, -(-(len(words) - tx.WINDOW) // tx.STRIDE) * tx.STRIDE + 1) if len(words) > tx.WINDOW else 1, tx.STRIDE)
    for start in starts:
        inputs = [entered(w) for w in words[start : start + tx.WINDOW]]
        states = {}
        for d, order in (("f", inputs), ("b", inputs[::-1])):
            h, seen = np.zeros(h2), []
            for x in order:
                a, v = x @ p[f"in_{d}"] + p[f"add_{d}"], h @ p[f"rec_{d}"]
                z, r = sig(a[:h2] + v[:h2]), sig(a[h2 : 2 * h2] + v[h2 : 2 * h2])
                c = np.tanh(a[2 * h2 :] + r * v[2 * h2 :])
                h = (1 - z) * c + z * h
                seen.append(h)
            states[d] = seen if d == "f" else seen[::-1]
        both = [np.concatenate(s) for s in zip(states["f"], states["b"])]
        pooled = np.zeros(2 * h2)
        if both:
            look = np.array([s @ p["look"] for s in both])
            weight = np.exp(look - look.max())
            pooled = sum(w * s for w, s in zip(weight / weight.sum(), both))
        best = max(best, float(pooled @ p["out"] + p["bias"][0]))
    return 1 / (1 + np.exp(-best))


def test_scores_equal_a_plain_forward_pass():
    texts, y = corpus(5, 60)
    net = tx.Network().fit(texts, y, epochs=1)
    rng = random.Random(3)
    vocab = "idiot SCUM fine gargle thinga été 東京 x".split()
    odd = ["", "one", "a " * 32, "b " * 33, *(" ".join(rng.choices(vocab, k=n)) for n in (31, 48, 49, 64, 65, 500))]
    got = net.score_bytes(*bw.text_bytes(pa.array(odd)))
    for text, score in zip(odd, got, strict=True):
        assert abs(score - plain_score(net, text)) < 1e-4, text[:40]


def test_bounds_hold_for_repeated_ids_and_long_texts(spark):
    rows = [(1, f"bad idiot {k}") for k in range(50)] + [(2, "x" * 20000), (2, "short"), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 5)] * 2, "doc_id long, toxic int")
    found, y = tx.training_sample(docs, labels)
    assert set(found) <= {"bad idiot 0", "short"} and len(found) == len(y) <= 2
    long = spark.createDataFrame([(1, "fine words " * 30000 + "idiot"), (1, "fine words " * 30000 + "idiot")], "doc_id long, text string")
    assert len({r["score"] for r in tx.score_toxicity(long, tx.Network()).collect()}) == 1


def test_windows_cover_every_word_twice_inside():
    doc, first = tx.window_rows(np.array([0, 1, 32, 33, 100]), 16)
    assert np.bincount(doc).tolist() == [1, 1, 1, 2, 6]
    assert all(first[doc == d].max() + 32 >= n for d, n in enumerate([0, 1, 32, 33, 100]))


def test_query_learns_and_holds_out(spark):
    texts, y = corpus(1, 500)
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)] + [(900, None, "en"), (901, "", "en"), (None, "fine", "en")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1, int(v)) for i, v in enumerate(y)] + [(None, 1, 1), (7000, 1, None)], "doc_id long, quality int, toxic int")
    model = tx.train(docs, labels)
    got = {r["doc_id"]: r for r in tx.score_toxicity(docs, model).collect()}
    assert len(got) == 503 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    held = [i for i in range(500) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] == (i in set(held)) for i in range(500)) and not got[None]["held_out"]
    assert np.mean([got[i]["predicted"] == y[i] for i in held]) >= 0.95
    kept = tx.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] == 0 for r in got.values())
    assert got[900]["score"] == got[901]["score"]
    # A score does not depend on the batch it is read in.
    alone = model.score_bytes(*bw.text_bytes(pa.array([texts[0]])))[0]
    assert abs(alone - got[0]["score"]) < 1e-5


def test_training_never_sees_held_out_rows(spark):
    texts, y = corpus(2, 60)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "doc_id long, toxic int")
    found, _ = tx.training_sample(docs, labels)
    assert set(found) == {t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 5}
    assert isinstance(tx.train(docs, labels.where("toxic = 0")), float) and isinstance(tx.train(docs.limit(0), labels), float)
    assert tx.score_toxicity(docs.limit(0), 0.5).count() == 0
