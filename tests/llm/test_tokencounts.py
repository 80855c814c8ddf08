import random

import pytest
from tokenizers import Tokenizer

from outflow.llm import tokencounts as tc


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tc.vocabulary_path())


@pytest.fixture(scope="module")
def counter():
    return tc.PrefixCounter(tc.vocabulary_path())


TEXTS = [
    "", " ", "  ", "a", "it's they're I'll we've x'r 'l ''", "tabs\t\t x\n\n  y  ", "naïve 東京 слово ½ ² Ⅻ 一",
    "x<|endoftext|>y!!<|endoftext|><|endoftext|> z", "a  <|endoftext|>  b", "1234567 3.14 $%^&*() ...", "\x1c\x1d\x85  ​ x", "😀😀 👍🏽", "supercalifragilistic " * 5,
]


def corpus(seed, n):
    rng = random.Random(seed)
    alphabet = "abcdeéßthing tionTHE 's'll 012  \n\t.,;!?<|>东 "
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("text", TEXTS + corpus(1, 60))
def test_counts_match_the_library(text, counter, library):
    assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("text", TEXTS + corpus(2, 80))
def test_every_prefix_is_exact(text, counter, library):
    want = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
    assert counter.prefixes(text).tolist() == want


@pytest.mark.parametrize("text", TEXTS + corpus(3, 80) + ["a" * 300 + " b", "internationalization " * 9])
def test_longest_fitting_prefix(text, counter):
    counts = counter.prefixes(text)
    for budget in range(0, int(counts[-1]), max(1, int(counts[-1]) // 7)):
        assert counter.fitting(text, budget) == max(k for k, n in enumerate(counts) if n <= budget), budget


def test_edge_rows(spark):
    rows = [(None, "a b", 1), (1, None, 1), (2, "", 1), (2, "", 1), (3, "word " * 3000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, tc.count_tokens(docs).collect()), key=str)
    assert got == sorted([(None, 3, 2, False, 3), (1, 0, 0, False, 0), (2, 0, 0, False, 0), (2, 0, 0, False, 0), (3, 15000, 3001, True, 5119)], key=str)
    assert tc.count_tokens(docs.limit(0)).count() == 0


def test_truncation(spark, library):
    docs = spark.createDataFrame([(1, "the cat sat on the mat"), (2, "")], "doc_id long, text string")
    got = dict(map(tuple, tc.truncation_points(tc.prefix_counts(docs), 3).collect()))
    text = "the cat sat on the mat"
    assert got[1] == max(k for k in range(len(text) + 1) if len(library.encode(text[:k]).ids) <= 3) and got[2] == 0


def test_one_walk_equals_counting_and_fitting():
    import random

    rng = random.Random(2)
    c = tc.counter(tc.vocabulary_path())
    bits = ["word ", "Another", "  ", "\n\n", "é", "日本語", " 12345", "don't", "'re", "<|endoftext|>", "😀", " x", "."]
    for _ in range(150):
        text = "".join(rng.choices(bits, k=rng.randrange(0, 60)))
        budget = rng.randrange(1, 40)
        n, fit = c.measure(text, budget)
        counts = c.prefixes(text)
        assert n == c.count(text) == counts[-1] and fit == max(k for k in range(len(text) + 1) if counts[k] <= budget)
