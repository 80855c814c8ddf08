"""Counters, gauges and alerts over publish attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: name, help, kind.
METRICS = (
    ("published_total", "Messages published.", "counter"),
    ("errors_total", "Errors of any kind.", "counter"),
    ("publish_errors_total", "Failed publish attempts.", "counter"),
    ("retry_successes_total", "Failed messages published later.", "counter"),
    ("failed_rows", "Rows kept after a failed publish.", "gauge"),
    ("last_published_seconds", "Time of the last publish.", "gauge"),
    ("last_checkpoint_seconds", "Time of the last checkpoint.", "gauge"),
)


def _counts() -> list[Column]:
    return [F.count_if("ok").alias("published"), F.count_if(~F.col("ok")).alias("publish_errors"), F.count_if(F.col("ok") & F.col("was_retry")).alias("retry_successes")]


def delivery_counters(attempts: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Counters and last times of each consumer."""
    last = checkpoints.groupBy(F.col("consumer_name").alias("consumer")).agg(F.max("updated_at").alias("last_checkpoint"))
    return attempts.groupBy("consumer").agg(*_counts(), F.max(F.when(F.col("ok"), F.col("ts"))).alias("last_published")).join(last, "consumer", "left")


def last_error(attempts: DataFrame, failed: DataFrame) -> DataFrame:
    """(consumer, last_error): the latest error, null once nothing is failed (``failed``: consumer, n_failed)."""
    latest = attempts.where("not ok").groupBy("consumer").agg(F.max_by("error", F.struct("ts", "id")).alias("error"))
    return latest.join(failed, "consumer", "left").select("consumer", F.when(F.coalesce("n_failed", F.lit(0)) > 0, F.col("error")).alias("last_error"))


def failed_rows_gauge(attempts: DataFrame, initial: DataFrame, stretch_seconds: int = 3600) -> DataFrame:
    """Adds ``gauge`` after every attempt: up on a first failure, down on a retry's success, never below 0.

    ``initial``: consumer, n_failed.  A walk held at zero is its free sum less
    the least that sum has been, where that is below zero.  Sums and leasts run
    inside stretches of time; what a stretch begins with comes from one row for
    each earlier stretch, so no task holds a consumer.
    """
    step = F.when(F.col("first_failure"), 1).when(F.col("ok") & F.col("was_retry"), -1).otherwise(0).cast("long")
    cut = attempts.withColumns({"_part": F.floor(F.unix_seconds("ts") / stretch_seconds).cast("long"), "_step": step})
    order = W.partitionBy("consumer", "_part").orderBy("ts", "id").rowsBetween(W.unboundedPreceding, 0)
    local = cut.withColumn("_sum", F.sum("_step").over(order)).withColumn("_low", F.min("_sum").over(order))
    parts = local.groupBy("consumer", "_part").agg(F.sum("_step").alias("_total"), F.min("_sum").alias("_least"))
    earlier = W.partitionBy("consumer").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    begun = parts.join(initial, "consumer", "left").withColumn("_begin", F.coalesce("n_failed", F.lit(0)) + F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
    begun = begun.withColumn("_before", F.coalesce(F.min(F.col("_begin") + F.col("_least")).over(earlier), F.lit(0))).select("consumer", "_part", "_begin", "_before")
    joined = local.join(begun, ["consumer", "_part"])
    least = F.least(F.lit(0), F.col("_before"), F.col("_begin") + F.col("_low"))
    return joined.withColumn("gauge", F.col("_begin") + F.col("_sum") - least).select(*attempts.columns, "gauge")


def metrics_long(counters: DataFrame, failed: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """(consumer, name, help, type, value): one row a metric; a missing time or count is 0.

    ``failed``: consumer and n_failed, the rows still failed.  ``errors``:
    consumer and n_errors, errors other than failed attempts; the total counts both.
    """
    seconds = lambda c: F.coalesce(F.unix_seconds(c), F.lit(0)).cast("long")
    known = counters.join(failed.select("consumer", "n_failed"), "consumer", "left")
    other = F.lit(0)
    if errors is not None:
        known, other = known.join(errors.select("consumer", "n_errors"), "consumer", "left"), F.coalesce("n_errors", F.lit(0))
    values = [F.col("published"), F.col("publish_errors") + other, F.col("publish_errors"), F.col("retry_successes"), F.coalesce("n_failed", F.lit(0)), seconds(F.col("last_published")), seconds(F.col("last_checkpoint"))]
    rows = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(h).alias("help"), F.lit(k).alias("type"), v.cast("long").alias("value")) for (n, h, k), v in zip(METRICS, values, strict=True)])
    return known.select("consumer", F.inline(rows))


def delivery_by_window(attempts: DataFrame, width: str, watermark: str | None = None) -> DataFrame:
    """Counters of each consumer in tumbling windows, for tables and streams alike."""
    if watermark:
        attempts = attempts.withWatermark("ts", watermark)
    return attempts.groupBy(F.window("ts", width).alias("w"), "consumer").agg(*_counts()).select("consumer", F.col("w.start").alias("window_start"), "published", "publish_errors", "retry_successes")


def alerts(windows: DataFrame, failed: DataFrame, checkpoints: DataFrame, now: Column, stale_seconds: int) -> DataFrame:
    """(consumer, alert, at, value): failed rows left, errors rising from window to window, stale checkpoints."""
    left = failed.where("n_failed > 0").select("consumer", F.lit("failed_rows").alias("alert"), now.alias("at"), F.col("n_failed").cast("long").alias("value"))
    before = F.lag("publish_errors").over(W.partitionBy("consumer").orderBy("window_start"))
    rising = windows.withColumn("_before", before).where("publish_errors > _before")
    rising = rising.select("consumer", F.lit("errors_rising").alias("alert"), F.col("window_start").alias("at"), (F.col("publish_errors") - F.col("_before")).cast("long").alias("value"))
    age = F.unix_seconds(now) - F.unix_seconds("updated_at")
    stale = checkpoints.where(age > stale_seconds).select(F.col("consumer_name").alias("consumer"), F.lit("checkpoint_stale").alias("alert"), now.alias("at"), age.cast("long").alias("value"))
    return left.unionByName(rising).unionByName(stale)


def failures_by_reason(attempts: DataFrame, at: Column | None = None) -> DataFrame:
    """Failed attempts by subject and error."""
    when = [F.max(at).alias("last_at")] if at is not None else []
    return attempts.where("not ok").groupBy("subject", "error").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last_id"), *when)
