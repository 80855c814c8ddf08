import random

import numpy as np
import pyarrow as pa
import pytest

from outflow.llm import bytewords as bw
from outflow.llm import decontamination as dc


def distance(item, text):
    best = list(range(len(text) + 1))
    best = [0] * (len(text) + 1)
    for i, w in enumerate(item):
        new = [i + 1]
        for j, v in enumerate(text):
            new.append(min(best[j] + (w != v), best[j + 1] + 1, new[j] + 1))
        best = new
    return min(best)


def test_align_matches_plain_edit_distance():
    rng = np.random.default_rng(3)
    for _ in range(200):
        item, text = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(0, 25))
        edits, a, z = dc.align(item, text)
        assert edits == distance(item.tolist(), text.tolist()) and 0 <= a <= z <= len(text)
        assert edits == distance(item.tolist(), text[a:z].tolist())


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        k = rng.randrange(len(words))
        how = rng.randrange(3)
        if how == 0:
            words[k] = f"zz{rng.getrandbits(40)}"
        elif how == 1:
            del words[k]
        else:
            words.insert(k, f"yy{rng.getrandbits(40)}")
    return words


@pytest.mark.parametrize("low,high", [(5, 15), (16, 60), (61, 200)])
@pytest.mark.parametrize("share", [0, 0.05, 0.1, 0.15, 0.2])
def test_recall_at_every_number_of_edits_and_size(low, high, share):
    rng = random.Random(f"{low} {share}")
    vocab = [f"w{k}" for k in range(3000)]
    items = [(k, " ".join(rng.choices(vocab, k=rng.randrange(low, high)))) for k in range(40)]
    index = dc.ItemIndex(items)
    found = 0
    for k, text in items:
        words = text.split()
        leak = edited(rng, words, int(share * len(words) + 1e-9))
        doc = rng.choices(vocab, k=50) + leak + rng.choices(vocab, k=50)
        hits = index.matches(*bw.text_bytes(pa.array([" ".join(doc).upper() + "!"])))
        found += any(h[1] == k for h in hits)
        assert all(h[1] == k for h in hits)
        if not share:
            assert (0, k, 50, 50 + len(words), 0) in hits
    assert found >= (40 if not share else 36)


def test_equally_near_stretches_give_the_first():
    item = " ".join(f"w{k}" for k in range(20))
    near = item.replace("w3 ", "zz ")
    index = dc.ItemIndex([(1, item)])
    text = f"pre {near} mid words here {near} {'x ' * 30000}{near}"
    assert index.matches(*bw.text_bytes(pa.array([text]))) == [(0, 0, 1, 21, 1)]


def test_blocks_give_what_one_pass_gives(spark):
    rng = random.Random(6)
    items = [(k, " ".join(f"w{rng.randrange(500)}" for _ in range(20))) for k in range(9)]
    docs = spark.createDataFrame([(k, f"a b {t} c d") for k, t in items] + [(99, "nothing here")], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, dc.find_leaks(docs, bench, block=2).collect())) == sorted(map(tuple, dc.find_leaks(docs, bench).collect()))
    assert [r["doc_id"] for r in dc.drop_leaks(docs, bench, block=2).collect()] == [99]


def test_rows(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    docs = spark.createDataFrame([(1, f"pre {item} post", 9), (None, item.title(), 9), (3, None, 9), (3, "", 9), (4, item[:40], 9), (5, "tiny", 9)], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(7, item), (8, None), (9, ""), (None, "x"), (10, "tiny")], "item_id long, text string")
    got = sorted(map(tuple, dc.find_leaks(docs, bench).collect()), key=str)
    assert got == [(1, 7, 1, 16, 0), (5, 10, 0, 1, 0), (None, 7, 0, 16, 0)]
    assert [r["doc_id"] for r in dc.drop_leaks(docs, bench).collect()] == [3, 3, 4]
    assert dc.find_leaks(docs, bench.limit(0)).count() == 0 and dc.drop_leaks(docs.limit(0), bench).count() == 0


def test_blocks_are_bounded_by_bytes_too(spark, monkeypatch):
    items = spark.createDataFrame([(k, f"item {k} " + "word " * 200) for k in range(12)], "item_id long, text string")
    monkeypatch.setattr(dc, "BLOCK_BYTES", 3000)
    many, blocks = dc.item_blocks(items)
    blocks = list(blocks)
    assert many > 2 and sorted(i for b in blocks for i, _ in b) == list(range(12))


def test_a_worker_keeps_one_index():
    calls = []
    one = dc.kept_index("a", lambda: calls.append(1) or [(1, "one two three four five six")], 0.8)
    assert dc.kept_index("a", lambda: calls.append(1) or [], 0.8) is one and calls == [1]
    dc.kept_index("b", lambda: [], 0.8)
    assert set(dc._KEPT) == {"b"}
