"""Passes over the outbox: publish first, then commit what came of it.

A pass has a name and two phases.  The first writes the results of its attempts
and the messages of accepted rows under that name; the second puts removals,
failures and positions into the state as one delta, and with it the manifest
that makes the messages visible.  A pass that stopped between the two is run
again under the same name: it writes the same files anew and then commits.  One
that is committed does nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outflow import schemas
from outflow.functions.validate import parse_headers, parse_headers_strict, stable_message_id
from outflow.operators.checkpoints import plan_recovery, upsert_checkpoints
from outflow.operators.delivery import attempt, cut_error, failed_rows
from outflow.operators.routing import subject_routes
from outflow.sources import tables as tb

PLACE = ("source_id", "log_file", "commit_pos", "log_pos", "event_seq", "row_idx")
CONTENT = ("payload", "headers", "message_id", "ttl_seconds", "attempt_count")
#: (prefix of the stable ids, schema, table); a prefix for each source is an expression over source_id.
Names = tuple[str | Column, str, str]


def publish(spark: SparkSession, base: str, version: str, messages: DataFrame, names: Names, bindings: DataFrame, expected: str | None = None, strict: bool = False, carry: tuple[str, ...] = (), by: str = "commit", spent: str | None = None) -> DataFrame:
    """First phase: attempts of ``messages`` (source_id, id and content), written with the envelopes of the accepted ones; gives the attempts as written.

    ``spent``: a folder that the messages lie in and that goes when the attempts are written.
    """
    lacking = [F.lit(None).cast(kind).alias(c) for c, kind in (f.split(" ") for f in schemas.ENVELOPE.split(", ")[1:6]) if c not in messages.columns]
    placed = messages.select("*", *lacking)
    here = f"{base}/{version}"
    # The few routes first, so that they go to the messages and not all messages of a subject to one task.
    subject_routes(placed, bindings).write.mode("overwrite").parquet(f"{here}/routes")
    routes = spark.read.parquet(f"{here}/routes")
    attempt(placed, bindings, expected, keep=(*PLACE, *CONTENT, *carry), strict=strict, routes=routes).write.mode("overwrite").parquet(f"{here}/results")
    for folder in (f"{here}/routes", *([spent] if spent else [])):
        tb.discard(spark, folder)
    results = spark.read.parquet(f"{here}/results")
    headers = parse_headers_strict()(F.col("headers"))["headers"] if strict else parse_headers(F.col("headers"))
    accepted = results.where("ok").withColumns({"key": stable_message_id(*names), "topic": F.col("subject")})
    sent = lambda dealt: tb.to_envelope(dealt, F.col("key"), headers, expected, keep=PLACE)
    tb.write_messages(accepted.drop("ok", "error", "was_retry", "first_failure", "attempt_count", *carry), f"{base}/{tb.MESSAGES}/{version}", [*PLACE, "key"], by, sent)
    return results


def manifest(spark: SparkSession, base: str, version: str) -> DataFrame:
    """The manifest of what ``publish`` wrote under this name."""
    return tb.manifest_of(spark, f"{base}/{tb.MESSAGES}/{version}", (tb.read_pointer(spark, base) or {"count": 0})["count"])


def one_source(names: Names, sources: set) -> None:
    """Refuses ids that could mean rows of several sources."""
    if isinstance(names[0], str) and len(sources) > 1:
        raise ValueError(f"ids of {', '.join(sorted(map(str, sources)))} need a prefix for each source (source_prefix)")


def _pass(spark: SparkSession, base: str, kind: str, name: str, rows: DataFrame, names: Names, bindings: DataFrame, now: Column, expected: str | None, strict: bool, positions: DataFrame | None = None, vanished: DataFrame | None = None) -> DataFrame:
    version = f"{kind}-{name}"
    every = rows.select("source_id").unionByName(tb.read_state(spark, base)[0].select("source_id"))
    one_source(names, {r[0] for r in every.distinct().limit(2).collect()})
    results = publish(spark, base, version, rows, names, bindings, expected, strict, carry=("created_at",))
    failed = F.col("ok") == False  # noqa: E712
    now_of = {"attempt_count": F.col("attempt_count") + 1, "last_attempt_at": now, "last_error": cut_error(F.col("error")), "gone": ~failed}
    changes = results.withColumns(now_of).select(*[f.name for f in schemas.STATE], "gone")
    if vanished is not None:
        changes = changes.unionByName(vanished.withColumn("gone", F.lit(True)))
    saved = tb.read_state(spark, base)[1]
    points = saved if positions is None else upsert_checkpoints(saved, positions, now)
    totals = results.agg(F.count(F.lit(1)).alias("attempted"), F.count_if("ok").alias("succeeded"), F.count_if(failed).alias("failed"))
    tb.write_delta(changes, points, base, version, kind, {f"{kind}-totals": totals}, manifest(spark, base, version))
    tb.discard(spark, f"{base}/{version}/results")
    return tb.read_side(spark, base, f"{kind}-totals")


def retry_pass(spark: SparkSession, base: str, name: str, names: Names, bindings: DataFrame, now: Column, expected: str | None = None, strict: bool = False) -> DataFrame:
    """Tries each failed row of the state at ``base`` once; (attempted, succeeded, failed).

    Names of passes must rise, as a repeated or lower one is taken as done.
    """
    if tb.is_done(spark, base, "retry", f"retry-{name}"):
        return tb.read_side(spark, base, "retry-totals")
    outbox, _ = tb.read_state(spark, base)
    with tb.spending(spark):
        return _pass(spark, base, "retry", name, failed_rows(outbox), names, bindings, now, expected, strict)


def snapshot_pass(spark: SparkSession, base: str, name: str, rows: DataFrame, positions: DataFrame, names: Names, bindings: DataFrame, now: Column, expected: str | None = None, strict: bool = False) -> DataFrame:
    """Tries every row of some sources' tables once and saves their positions with the results; totals as ``retry_pass``.

    ``positions`` (consumer_name, binlog_name, binlog_position, gtid_set,
    write_seq, source_id) must have been read before ``rows``: what changes
    meanwhile is then published again, and its message id absorbs it.  Rows that
    the state still has but the sources' tables don't are gone.
    """
    if tb.is_done(spark, base, "snapshot", f"snapshot-{name}"):
        return tb.read_side(spark, base, "snapshot-totals")
    kept, _ = tb.read_state(spark, base)
    mine = tb.conform(rows, schemas.STATE)
    keys = ["source_id", "id"]
    sources = positions.select("source_id").distinct()
    vanished = kept.join(sources, "source_id", "left_semi").join(mine.select(*keys), keys, "left_anti").select(*kept.columns)
    with tb.spending(spark):
        return _pass(spark, base, "snapshot", name, mine.join(sources, "source_id", "left_semi"), names, bindings, now, expected, strict, positions, vanished)


def recover(spark: SparkSession, base: str, name: str, consumers: DataFrame, log_files: DataFrame, server_state: DataFrame, positions: DataFrame, read_rows, names: Names, bindings: DataFrame, now: Column, stream=None) -> DataFrame:
    """Carries out the plan of each consumer; (consumer_name, source_id, plan, reason), as planned.

    ``consumers``: consumer_name and source_id, one row a source.  In order: the
    plans are made and written (a repeated call takes them from there); sources
    to be read whole have the positions of now (``positions``: source_id,
    binlog_name, binlog_position, gtid_set) saved with a snapshot pass over
    ``read_rows()``; then ``stream(start)`` follows the log, from the saved
    checkpoints, of every source that had no error.  What has an error starts
    nothing; its plan says why.
    """
    path = f"{base}/{tb.PLANS}/{name}"
    if not tb.exists(spark, f"{path}/_SUCCESS"):
        saved = tb.read_state(spark, base)[1].join(consumers.select("consumer_name", "source_id"), "consumer_name")
        plans = plan_recovery(consumers, saved, log_files, server_state).join(consumers.select("consumer_name", "source_id"), "consumer_name")
        here = positions.select(F.col("source_id").alias("_s"), "binlog_name", "binlog_position", "gtid_set")
        plans.join(here, F.col("source_id") == F.col("_s"), "left").drop("_s").coalesce(1).write.mode("overwrite").parquet(path)
    plans = spark.read.parquet(path)
    fresh = plans.where("plan = 'snapshot'").select("consumer_name", "source_id", "binlog_name", "binlog_position", "gtid_set", F.lit(0).cast("long").alias("write_seq"))
    if fresh.take(1):
        snapshot_pass(spark, base, name, read_rows(), fresh, names, bindings, now)
    if stream is not None:
        points = tb.read_state(spark, base)[1]
        start = plans.where("plan <> 'error'").select("consumer_name", "source_id").join(points, "consumer_name").select("source_id", "binlog_name", "binlog_position", "gtid_set")
        if start.take(1):
            stream(start).awaitTermination()
    return plans.select("consumer_name", "source_id", "plan", "reason")
