"""A corpus cleaned and encoded in five stages, each written and read again.

Every stage works on all that its predecessor kept and returns the columns of
``documents``; the last returns the pieces.  Rows are never sampled or capped.
Null or empty texts pass every filter (near-duplicates: as one group), tables
with repeated ids or extra columns keep them, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from outflow.llm.decontamination import drop_leaks
from outflow.llm.mergedropout import encoded_documents
from outflow.llm.nearcopies import keep_one
from outflow.llm.pii import redact
from outflow.llm.shared import staged, unstage
from outflow.llm.toxicity import keep_clean, train


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, trained on this corpus's labels, rejects go."""
    return keep_clean(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word likeness of 0.8 or more) stays, the one with the least doc_id."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; no document goes."""
    return redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every text that is left."""
    return encoded_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]

#: A trained network decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage has read goes when its own result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        done = staged(stage(spark, docs, sf_dir), name)
        unstage(docs)
        docs = done
    return docs
