"""Exact token counts of every prefix by dynamic programming (operator 3).

In a byte-pair vocabulary whose ids follow merge order, the encoding of a byte
string is the only token sequence of which every neighbouring pair is itself
encoded as that pair.  So the encoding of each prefix ends in exactly one
token: the one whose start is a shorter prefix ending in a token it may follow.
One pass over a word's byte positions fills the token count of all its prefixes;
nothing is re-encoded to answer truncation or budget questions.

Words (pre-tokens) repeat, so tables are kept for recent words per worker.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: Words whose tables a worker keeps; older ones are computed again when met.
KEPT_WORDS = 400_000
#: Token pairs whose verdict a worker keeps (about 50 MB).
KEPT_PAIRS = 300_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    for n, b in enumerate(b for b in range(256) if b not in set(shown)):
        letters[chr(256 + n)] = b
    return letters


class PrefixCounter:
    """Prefix token counts under one byte-level BPE vocabulary file."""

    def __init__(self, path: str, kept_words: int = KEPT_WORDS):
        import public_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.token = {raw(t): i for t, i in vocab.items()}
        self.longest = max(map(len, self.token))
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            if z in self.parts or x >= z or y >= z:
                raise ValueError("the vocabulary's ids don't follow its merges")
            self.parts[z], self.rank[x, y] = (x, y), z
        self.special = special
        self.split_special = regex.compile("(" + "|".join(regex.escape(s) for s in special) + ")") if special else None
        # Oniguruma's \s is the White_Space property.
        self.words = regex.compile(public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.kept_words = kept_words
        self.fits: dict[tuple[int, int], bool] = {}
        self.totals: dict[str, int] = {}

    def may_follow(self, left: int, right: int) -> bool:
        """Whether encoding the two tokens' joined bytes gives just these two."""
        pair = (left, right)
        known = self.fits.get(pair)
        if known is None:
            known = self._may_follow(left, right)
            if len(self.fits) >= KEPT_PAIRS:
                self.fits.clear()
            self.fits[pair] = known
        return known

    def _may_follow(self, left: int, right: int) -> bool:
        # The symbols beside the border over time, each with the merge that ends it.
        never = 1 << 40
        edges, until = [], never
        while True:
            edges.append((left, until))
            if left not in self.parts:
                break
            until, left = left, self.parts[left][1]
        until = never
        while True:
            for x, x_until in edges:
                merge = self.rank.get((x, right))
                # At one rank the leftmost merge goes first.
                if merge is not None and merge < x_until and merge <= until:
                    return False
            if right not in self.parts:
                return True
            until, right = right, self.parts[right][0]

    def byte_table(self, word: bytes) -> list[int]:
        """Token counts of the word's byte prefixes, 0 .. len(word)."""
        token, fits, longest = self.token, self.fits, self.longest
        last, count = [-1], [0]
        for end in range(1, len(word) + 1):
            for begin in range(max(0, end - longest), end):
                t = token.get(word[begin:end])
                if t is None:
                    continue
                if begin:
                    ok = fits.get((last[begin], t))
                    if ok is None:
                        ok = self.may_follow(last[begin], t)
                    if not ok:
                        continue
                last.append(t)
                count.append(count[begin] + 1)
                break
            else:
                raise ValueError("the vocabulary lacks a byte")
        return count

    def total(self, word: str) -> int:
        n = self.totals.get(word)
        if n is None:
            n = self.byte_table(word.encode("utf-8"))[-1]
            if len(self.totals) >= self.kept_words:
                self.totals.clear()
            self.totals[word] = n
        return n

    def pieces(self, text: str) -> list[str]:
        """The text cut at special strings, which stay whole."""
        return [p for p in self.split_special.split(text) if p] if self.split_special else [text] * bool(text)

    def count(self, text: str) -> int:
        """Token count of a whole text."""
        known, total, n = self.totals, self.total, 0
        for piece in self.pieces(text):
            if piece in self.special:
                n += 1
                continue
            for word in self.words.findall(piece):
                c = known.get(word)
                n += c if c is not None else total(word)
        return n

    def measure(self, text: str, budget: int, slack: int = 8) -> tuple[int, int]:
        """Token count of a whole text, and the longest k for which text[:k] has at most ``budget`` tokens, in one walk over its words.

        A cut word can take back a few tokens, so prefixes are counted around the
        place where the budget runs out, from the last word that surely fits.
        """
        if self.split_special is not None and self.split_special.search(text):
            n = self.count(text)
            return n, len(text) if n <= budget else self.fitting(text, budget, slack)
        words = self.words.findall(text)
        each = list(map(self.totals.get, words))
        if None in each:
            each = [self.total(w) if c is None else c for w, c in zip(words, each, strict=True)]
        n = sum(each)
        if n <= budget:
            return n, len(text)
        # Every word has a token at least, so the budget runs out within so many words.
        upto = list(accumulate(each[: budget + slack + 1]))
        k = bisect_right(upto, budget + slack) + 1
        low = bisect_right(upto, budget - slack)
        while low and words[low - 1].isspace():
            low -= 1
        base = upto[low - 1] if low else 0  # what follows word low is cut into the same words alone
        safe = sum(map(len, words[:low]))
        counts = self.prefixes("".join(words[low:k])) + base
        return n, safe + int(np.flatnonzero(counts <= budget)[-1])

    def fitting(self, text: str, budget: int, slack: int = 8) -> int:
        """Longest k for which text[:k] has at most ``budget`` tokens; ``text`` as a whole has more.

        Whole words are added up until the budget is passed by more than a cut
        word can take back; prefixes are counted only from the last word that
        surely fits.
        """
        n, at, base, safe = 0, 0, 0, 0
        for piece in self.pieces(text):
            for word in [piece] if piece in self.special else (m[0] for m in self.words.finditer(piece)):
                n, at = n + (1 if word in self.special else self.total(word)), at + len(word)
                if n <= budget - slack and word not in self.special and not word.isspace():
                    base, safe = n, at  # what follows is cut into the same words alone
                if n > budget + slack:
                    break
            if n > budget + slack:
                break
        counts = self.prefixes(text[safe:at]) + base
        return safe + int(np.flatnonzero(counts <= budget)[-1])

    def _word_counts(self, word: str) -> list[int]:
        """Token counts of a pre-token's code point prefixes, each as a text of its own."""
        table = self.byte_table(word.encode("utf-8"))
        at, out = 0, [0]
        for c in word:
            at += len(c.encode("utf-8"))
            out.append(table[at])
        if word in ("'re", "'ve", "'ll"):  # cut short they are two words
            out[2] = self.total(word[0]) + self.total(word[1])
        return out

    def prefixes(self, text: str) -> np.ndarray:
        """Token count of text[:k] for k = 0 .. len(text)."""
        out, base = [0], 0  # base: tokens of all finished words
        tail = ""  # the last ordinary word, which a cut special string would prolong
        for piece in self.pieces(text):
            if piece in self.special:
                before = base - (self.total(tail) if tail else 0)
                out.extend(before + self.count(tail + piece[:k]) for k in range(1, len(piece)))
                base, tail = base + 1, ""
                out.append(base)
                continue
            run = ""  # blanks of which the next word takes the last
            for word in self.words.findall(piece):
                counts = self._word_counts(word)
                here = [base + n for n in counts[1:]]
                if run and word[0].isspace():
                    here[0] = base - self.total(run) + self.total(run + word[0])
                out.extend(here)
                base += counts[-1]
                run = word if word.isspace() else ""
                tail = word
        return np.array(out, dtype=np.int32)


_COUNTERS: dict[tuple[str, int], PrefixCounter] = {}


def counter(path: str, kept_words: int = KEPT_WORDS) -> PrefixCounter:
    """The worker's counter for a vocabulary file, loaded once."""
    if (path, kept_words) not in _COUNTERS:
        _COUNTERS[path, kept_words] = PrefixCounter(path, kept_words)
    return _COUNTERS[path, kept_words]


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fit_chars) of every row.

    fit_chars: code points of the longest prefix of at most ``limit`` tokens,
    read off the prefix counts.  A null or empty text has no bytes and no
    tokens.  Rows stay as they are: repeated and null ids keep their rows, an
    empty table gives none, extra columns are ignored whatever their names, and
    texts are read whole, however long.  Nothing is shuffled.
    """
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                texts = [x or "" for x in batch.column("text").to_pylist()]
                measured = [c.measure(x, limit) for x in texts]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *(pa.array([m[k] for m in measured], pa.int64()) for k in (0, 1))], names=["doc_id", "n_bytes", "n_tokens", "fit_chars"])

    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return cut.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, fit_chars long").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fit_chars")


def prefix_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, counts): counts[k] is the exact token count of the first k code points."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([c.prefixes(x or "") for x in part.column("text").to_pylist()], pa.list_(pa.int32()))], names=["doc_id", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, counts array<int>")


def truncation_points(counts: DataFrame, budget: int) -> DataFrame:
    """(doc_id, n_chars): the longest prefix of at most ``budget`` tokens, read off ``prefix_counts``."""
    fits = F.array_max(F.filter(F.transform("counts", lambda n, k: F.when(n <= budget, k)), lambda k: k.isNotNull()))
    return counts.select("doc_id", fits.cast("long").alias("n_chars"))


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs, vocabulary_path(VOCABULARY), LIMIT)
