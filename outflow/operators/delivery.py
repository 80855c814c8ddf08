"""Publish attempts and what they do to the outbox."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outflow.functions.validate import validate_messages
from outflow.operators.routing import check_expected_stream, route_subjects

ERROR_BYTES = 4096


def attempt(messages: DataFrame, bindings: DataFrame, expected: str | None = None, keep: tuple[str, ...] = (), strict: bool = False, routes: DataFrame | None = None) -> DataFrame:
    """(id, subject, ok, error, was_retry, first_failure) of each message; a failed row stops nothing.

    ``keep``: more columns of the messages to carry along.  ``strict``: their headers are free text.
    ``routes``: as ``route_subjects`` takes them.
    """
    routed = check_expected_stream(route_subjects(validate_messages(messages, strict=strict), bindings, routes), expected)
    error = F.coalesce(F.col("error"), F.concat(F.lit("outbox row "), F.col("id").cast("string"), F.lit(": "), F.col("route_error")))
    retried = F.col("attempt_count") > 0
    return routed.select("id", "subject", error.isNull().alias("ok"), error.alias("error"), retried.alias("was_retry"), (error.isNotNull() & ~retried).alias("first_failure"), *keep)


def delete_acknowledged(outbox: DataFrame, attempts: DataFrame) -> DataFrame:
    """The outbox without the rows that were published."""
    return outbox.join(attempts.where("ok").select("id"), "id", "left_anti")


def cut_error(error: Column, most: int = ERROR_BYTES) -> Column:
    """The first ``most`` bytes of an error text; a character that the cut splits becomes a replacement mark."""
    return F.when(F.octet_length(error) <= most, error).otherwise(F.make_valid_utf8(F.substring(F.encode(error, "UTF-8"), 1, most).cast("string")))


def record_failures(outbox: DataFrame, attempts: DataFrame, now: Column) -> DataFrame:
    """The outbox with one attempt more, the time and the error on rows that failed."""
    failed = attempts.where("not ok").select(F.col("id").alias("_id"), F.col("error").alias("_error"))
    return _marked(outbox.join(failed, F.col("id") == F.col("_id"), "left"), F.col("_id").isNotNull(), now).select(*outbox.columns)


def _marked(joined: DataFrame, failed: Column, now: Column) -> DataFrame:
    return joined.withColumns(
        {
            "attempt_count": F.col("attempt_count") + F.when(failed, 1).otherwise(0),
            "last_attempt_at": F.when(failed, now).otherwise(F.col("last_attempt_at")),
            "last_error": F.when(failed, cut_error(F.col("_error"))).otherwise(F.col("last_error")),
        }
    )


def apply_results(outbox: DataFrame, attempts: DataFrame, now: Column) -> DataFrame:
    """Published rows removed and failed ones marked, in one join; attempts of absent rows do nothing."""
    result = attempts.select(F.col("id").alias("_id"), F.col("ok").alias("_ok"), F.col("error").alias("_error"))
    joined = outbox.join(result, F.col("id") == F.col("_id"), "left").where("_ok is null or not _ok")
    return _marked(joined, F.col("_id").isNotNull(), now).select(*outbox.columns)


def snapshot_page(outbox: DataFrame, after_id: int, n: int) -> DataFrame:
    """The next ``n`` rows after an id, by id."""
    return outbox.where(F.col("id") > F.lit(after_id)).orderBy("id").limit(n)


def snapshot_batches(outbox: DataFrame, n: int) -> DataFrame:
    """Adds ``batch``: which page of ``n`` rows, by id, each row is on.

    Ids are dealt into ranges; each range numbers its own rows and adds the
    count of the ranges before, so no task sees the whole table.
    """
    parts = max(2, int(outbox.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = outbox.agg(F.percentile_approx(F.col("id").cast("double"), [k / parts for k in range(1, parts)], 10_000).alias("c")).first()["c"] or []
    edges = F.array(*[F.lit(float(c)) for c in sorted(set(cuts))]) if cuts else F.array().cast("array<double>")
    dealt = outbox.withColumn("_part", F.size(F.filter(edges, lambda e: F.col("id").cast("double") > e)))
    before = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = before.select("_part", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    place = F.row_number().over(W.partitionBy("_part").orderBy("id")) - 1 + F.col("_before")
    return dealt.join(F.broadcast(before), "_part").withColumn("batch", F.floor(place / n).cast("long")).select(*outbox.columns, "batch")


def failed_rows(outbox: DataFrame) -> DataFrame:
    return outbox.where("attempt_count > 0")


def count_failed(outbox: DataFrame) -> DataFrame:
    return failed_rows(outbox).agg(F.count(F.lit(1)).alias("n_failed"))
