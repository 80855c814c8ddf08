"""Helpers that several corpus operators use: staged tables and row identities."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outflow.sources.tables import discard

#: What a null doc_id sorts and joins as.
NULL_ID = -(1 << 63)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; set here only where the session names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"
    return folder.rstrip("/")


#: Settings while a table is staged: batches of whole texts stay small, and its
#: shuffles are removed when it is written, as nothing reads them any more.
STAGING = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the time of a block; what was set before comes back."""
    old = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage and stops recomputation, and outlives any executor.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with settings(spark, STAGING):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = [path]
    return out


def unstage(*frames: DataFrame) -> None:
    """Remove staged tables that nothing reads any more; frames that were not staged stay as they are."""
    for df in frames:
        for path in getattr(df, "staged_at", []):
            discard(df.sparkSession, path)


def identified(docs: DataFrame, *columns: str) -> DataFrame:
    """``docs`` cut to ``columns`` plus ``_rid``, a long that orders rows as doc_id does.

    Where doc_id is unique and not null ``_rid`` is doc_id itself and nothing
    moves.  Otherwise rows are ordered by (doc_id with nulls first, the columns'
    hash, their place in the table) and numbered in that order, so that repeated ids stay separate
    rows; fully equal rows of one id spread over tasks, as their order says nothing.
    """
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c) for c in columns if c != "doc_id"])
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("i"))
    again = ids.groupBy("i").count().where("count > 1 or i = -9223372036854775808").limit(1)
    if not again.take(1):
        return cut.withColumn("_rid", F.col("doc_id"))
    tie = F.xxhash64(*[F.col(c) for c in columns if c != "doc_id"])
    numbered = (
        cut.withColumn("_k", F.coalesce(F.col("doc_id"), F.lit(NULL_ID)))
        .withColumn("_t", tie)
        .withColumn("_n", F.monotonically_increasing_id())
        .repartitionByRange("_k", "_t", "_n")
        .sortWithinPartitions("_k", "_t", "_n")
        .withColumn("_rid", F.monotonically_increasing_id())
        .drop("_k", "_t", "_n")
    )
    return staged(numbered, "rows")
