import hashlib
import random
import re

from pyspark.sql import functions as F

from outflow.llm import infilling as fim


def plain(doc_id, text):
    """Prefix, middle, suffix, form and output, one text at a time."""
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    p, m, s = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, None)))
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def made(docs):
    out = fim.fill_in_middle(docs)
    return out.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()


def test_against_plain_python(spark):
    rng = random.Random(5)
    alphabet = ["a", "Zed", "word", " ", "\n", "\t", ".", "é", "日本", "😀", "é", "7", "<", "<S", "P>", ">", "\\", "\x00"]
    texts = ["".join(rng.choices(alphabet, k=rng.choice([1, 2, 31, 32, 33, 63, 64, 65, 200]))) for _ in range(300)]
    texts += [None, "", "a", ".", "has <P> in it", "<M>", "x" * 5000, "word " * 40_000, ". " * 3200]
    rows = list(enumerate(texts)) + [(1000 + k, texts[5]) for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in made(docs)}
    assert len(got) == len({i for i, _ in rows})
    for i, text in dict(rows).items():
        r = got[i]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain(i, text)
        assert r["back"] == (text or "")
    assert {r["form"] for r in got.values()} == {"plain", "psm", "spm"}


def test_odd_rows(spark):
    same = [(None, "one two"), (None, "one two"), (7, "x y z"), (7, "x y z"), (7, "other"), (8, None)]
    docs = spark.createDataFrame(same, "doc_id long, text string").selectExpr("doc_id", "text", "1 as n", "'x' as form", "2 as _rid", "3 as r", "4 as s", "5 as stretch")
    got = sorted((str(r["doc_id"]), r["output"]) for r in made(docs))
    assert got == sorted((str(i), plain(i, t)[4]) for i, t in same)
    assert made(docs.limit(0)) == []


def test_marks_and_shares_are_parameters(spark):
    docs = spark.createDataFrame([(k, "one two three four") for k in range(60)], "doc_id long, text string")
    out = fim.fill_in_middle(docs, ("[p]", "[s]", "[m]"), plain=0, spm=100)
    rows = out.withColumn("back", fim.restored(F.col("output"), F.col("form"), ("[p]", "[s]", "[m]"))).collect()
    assert {r["form"] for r in rows} == {"spm"} and {r["back"] for r in rows} == {"one two three four"} and all(r["output"].startswith("[s]") for r in rows)
