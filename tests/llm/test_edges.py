"""Very long texts, empty tables and null ids, where the operators' own tests have none."""

import random

from pyspark.sql import functions as F

from outflow.llm import digests, mergedropout, minhash, nearcopies, phrases, pii, simhash
from outflow.llm import spans as sp

NAMES = "doc_id long, text string"


def words(seed, n):
    rng = random.Random(seed)
    return [f"w{rng.randrange(50_000)}" for _ in range(n)]


def long_docs(spark):
    """A text of over a megabyte, a copy with a few words changed, a repeated row of it, and small ones."""
    one = words(1, 200_000)
    two = [w if k % 5000 else "changed" for k, w in enumerate(one)]
    rows = [(3, " ".join(one)), (5, " ".join(two)), (5, " ".join(two)), (None, " ".join(words(2, 30))), (7, None), (8, "")]
    return spark.createDataFrame(rows, NAMES)


def test_near_copies_of_very_long_texts(spark):
    docs = long_docs(spark)
    assert sorted(str(r["doc_id"]) for r in nearcopies.keep_one(docs).collect()) == ["3", "7", "None"] or sorted(str(r["doc_id"]) for r in nearcopies.keep_one(docs).collect()) == ["3", "8", "None"]
    got = sorted((str(r["doc_id"]), r["n_shingles"] > 190_000, str(r["component_id"]), r["kept"]) for r in minhash.near_duplicates(docs).collect())
    assert got == [("3", True, "3", True), ("5", True, "3", False), ("5", True, "3", False), ("7", False, "7", True), ("8", False, "8", True), ("None", False, "None", True)]


def test_fingerprints_of_very_long_texts(spark):
    docs = long_docs(spark)
    sim = simhash.near_duplicate_groups(docs).collect()
    assert len(sim) == 6 and len({r["fp"] for r in sim if r["doc_id"] == 5}) == 1
    made = [r for r in digests.fingerprint_documents(docs).collect() if r["doc_id"] in (3, 5)]
    assert len(made) == 3 and all(r["n_chars"] > 1_000_000 for r in made) and {r["near_next"] > 0.5 for r in made if r["doc_id"] == 3} == {True}


def test_encoding_and_phrases_of_very_long_texts(spark):
    docs = long_docs(spark)
    out = mergedropout.encoded_documents(docs).collect()
    assert len(out) == 6 and all(r["lossless"] for r in out) and max(r["n_tokens"] for r in out) > 200_000
    counted = phrases.collocations(docs.withColumn("lang", F.lit("en")), least=3).collect()
    assert counted and all(r["a"] >= 3 for r in counted)


def test_personal_data_of_empty_tables_null_ids_and_long_texts(spark):
    text = "x " * 400_000 + "a.b@c.de " + "1.2.3.4 " * 3
    docs = spark.createDataFrame([(None, text), (None, text), (1, None), (1, "")], NAMES)
    got = sorted((str(r["doc_id"]), r["b"]) for r in pii.find_pii(docs).select("doc_id", sp.as_text(F.col("base")).alias("b")).collect())
    want = ",".join(["email:800000:800008", "ip:800009:800016", "ip:800017:800024", "ip:800025:800032"])
    assert got == [("1", ""), ("1", ""), ("None", want), ("None", want)]
    assert pii.find_pii(docs.limit(0)).count() == 0 and pii.redact(docs.limit(0)).count() == 0
