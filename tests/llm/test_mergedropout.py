import random

import numpy as np
import pytest
import sentencepiece

from outflow.llm import mergedropout as md

TEXTS = ["", " ", "   a  b ", "hello world", "naïve 東京 ½ 😀 x", "tabs\t\n\r x\n\n  y", "the▁mark ▁ ▁▁", "a" * 500, "\x00\x01 x", "Hetible th. the the the the the"]


def corpus(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdeéßthing tionTHE 's'll 012  \n.,😀東") for _ in range(rng.randrange(80))) for _ in range(n)]


@pytest.mark.parametrize("text", [t for t in TEXTS if md.BLANK not in t] + corpus(1, 80))
def test_no_dropout_matches_the_library(text):
    library = sentencepiece.SentencePieceProcessor(model_file=md.model_path())
    assert md.pieces(md.model_path(), 0.0).encode(text) == library.encode(text)


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_decoding_is_lossless(dropout):
    p = md.pieces(md.model_path(), dropout)
    for text in TEXTS + corpus(2, 60):
        assert p.decode(p.encode(text)) == text


def test_many_in_step_equal_one_by_one():
    rng = random.Random(9)
    parts = [rng.choice([" ", "", "  "]) + "".join(rng.choice("abceinorst  éh.,") for _ in range(rng.randrange(1, 31))) for _ in range(3000)]
    for dropout in (0.0, 0.1, 0.6):
        p = md.Pieces(md.model_path(), dropout)
        assert [np.frombuffer(x, "<i4").tolist() for x in p.segments(parts, 1)] == [list(p.segment(x, 1)) for x in parts]
    small = md.Pieces(md.model_path(), 0.1, kept=50)
    texts = TEXTS + corpus(5, 60)
    assert [small.encode(t) for t in texts] == [x.tolist() for x in md.Pieces(md.model_path(), 0.1).encode_many(texts)]


def test_seeds_vary_and_repeat():
    text = "the quick brown fox thinks about international relations " * 5
    one, same, other = (md.Pieces(md.model_path(), 0.2, s).encode(text) for s in (1, 1, 2))
    assert one == same != other
    plain = md.Pieces(md.model_path(), 0.0).encode(text)
    assert len(one) > len(plain) and len(md.Pieces(md.model_path(), 1.0).encode(text)) == len(text) + 1


def test_every_occurrence_is_dealt_anew():
    p = md.Pieces(md.model_path(), 0.1)
    texts = [" ".join(["international relations the thinking"] * 50) + f" {k}" for k in range(40)]
    found = p.encode_many(texts)
    ways, several = {}, 0
    for text, ids in zip(texts, found, strict=True):
        spelled = [p.spelled[i].decode() for i in ids.tolist()]
        words = "\0".join(spelled).replace("\0 ", "\n").strip().split("\n")
        assert "".join(spelled)[1:] == text
        for word in words:
            ways.setdefault(word.replace("\0", ""), set()).add(word)
    several = {w: len(v) for w, v in ways.items()}
    assert several["international"] > 10 and several["thinking"] > 5 and several["relations"] > 5
    occurrences = md.mix64(md.mix64(np.full(200, md.xxhash.xxh64_intdigest(texts[0].encode()), np.uint64)) + np.arange(200, dtype=np.uint64))
    one_by_one = [i for k, part in enumerate(p.SEGMENTS.findall(" " + texts[0])[:200]) for i in p.segment(part, int(occurrences[k]))]
    assert found[0][: len(one_by_one)].tolist() == one_by_one


def test_rows(spark):
    docs = spark.createDataFrame([(1, "a b", 5), (None, None, 5), (2, "", 5), (2, "", 5)], "doc_id long, text string, ids int")
    got = sorted((str(r["doc_id"]), r["n_chars"], r["n_tokens"], r["lossless"]) for r in md.encoded_documents(docs).collect())
    n = len(md.pieces(md.model_path(), md.DROPOUT, md.SEED, md.VARIANTS).encode("a b"))
    assert got == [("1", 3, n, True), ("2", 0, 0, True), ("2", 0, 0, True), ("None", 0, 0, True)]
    assert md.encode(docs).where("doc_id is null and ids is null").count() == 1 and md.encode(docs.limit(0)).count() == 0
