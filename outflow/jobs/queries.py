"""One query for each operator, over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outflow.functions import validate as v
from outflow.jobs import fixtures as fx
from outflow.operators import checkpoints as cp
from outflow.operators import decode as dc
from outflow.operators import delivery as dl
from outflow.operators import gtid as gt
from outflow.operators import metrics as mt
from outflow.operators import passes as ps
from outflow.operators import routing as rt
from outflow.operators import transactions as tr
from outflow.sources import tables as tb
from outflow.streaming import alerts as al
from outflow.streaming import relay as rl

QUERIES = {}
BIG = "bigint"


def query(f):
    QUERIES[f.__name__] = f
    return f


def folder(spark: SparkSession, name: str) -> str:
    """A new folder where driver and executors both can write."""
    return tb.new_folder(spark, name)


def text(c: str):
    return F.decode(F.col(c), "UTF-8").alias(c)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Committed, decoded messages of the log."""
    log = dc.filter_inserts(dc.filter_table(fx.change_log(spark, sf_dir), fx.DB, fx.TABLE))
    return dc.quarantine(dc.decode_rows(dc.explode_inserts(tr.committed_rows(log), fx.DB, fx.TABLE)))


def shown(df: DataFrame) -> DataFrame:
    place = ["source_id", "log_file", "commit_pos", "log_pos", F.col("row_idx").cast(BIG).alias("row_idx")]
    return df.select(*place, F.col("id").cast(BIG).alias("id"), "subject", text("payload"), "headers", "message_id", "ttl_seconds")


# Change log


@query
def t4_committed_rows(spark, sf_dir):
    return shown(messages(spark, sf_dir))


@query
def s1_read_outbox(spark, sf_dir):
    path = folder(spark, "outbox")
    df = fx.outbox(spark, sf_dir)
    df.select(F.lit(1).alias("extra"), *[F.col(c).alias(c.upper()) for c in reversed(df.columns)]).write.parquet(path)
    return tb.read_outbox(spark, path).select(F.col("id").cast(BIG).alias("id"), "subject", text("payload"), "headers", "message_id", "ttl_seconds", "attempt_count")


@query
def s2_read_change_log(spark, sf_dir):
    path = folder(spark, "log")
    fx.change_log(spark, sf_dir).write.parquet(path)
    return _events(tb.read_change_log(spark, path))


@query
def s3_stream_change_log(spark, sf_dir):
    path = folder(spark, "log")
    fx.change_log(spark, sf_dir).write.parquet(path)
    return _events(_drained(spark, tb.stream_change_log(spark, path)))


@query
def s4_to_envelope(spark, sf_dir):
    stable = v.stable_message_id(fx.PREFIX, fx.DB, fx.TABLE)
    sent = tb.to_envelope(messages(spark, sf_dir), stable, v.parse_headers(F.col("headers")))
    pairs = F.array_join(F.transform("headers", lambda h: F.concat_ws("=", h["key"], F.decode(h["value"], "UTF-8"))), ";")
    return sent.select("topic", "key", text("value"), pairs.alias("headers"))


@query
def s5_write_messages(spark, sf_dir):
    path = folder(spark, "messages")
    stable = v.stable_message_id(fx.PREFIX, fx.DB, fx.TABLE).alias("key")
    tb.write_messages(messages(spark, sf_dir).select(*tr.COMMIT_ORDER, stable, F.col("subject").alias("topic")), path, list(tr.COMMIT_ORDER))
    return spark.read.parquet(path).select("source_id", "log_file", "commit_pos", "log_pos", F.col("row_idx").cast(BIG).alias("row_idx"), "key", "topic")


@query
def s5_message_manifest(spark, sf_dir):
    """Files as the manifest names them: in commit order, and in the order of each subject only; one batch is not named."""
    base = folder(spark, "state")
    stable = v.stable_message_id(fx.PREFIX, fx.DB, fx.TABLE)
    sent = tb.to_envelope(messages(spark, sf_dir), stable, keep=tr.COMMIT_ORDER)
    outbox, saved = fx.state(spark, sf_dir).limit(0), fx.checkpoints(spark, sf_dir).limit(0)
    for k, (name, rows, by) in enumerate((("one", sent.where("source_id in ('src0', 'src1')"), "commit"), ("two", sent.where("source_id = 'src2'"), "subject"), ("lost", sent.where("source_id = 'src3'"), "commit"))):
        path = f"{base}/{tb.MESSAGES}/{name}"
        tb.write_messages(rows, path, list(tr.COMMIT_ORDER), by)
        if name != "lost":  # a batch that stops before its pointer
            tb.write_delta(outbox.withColumn("gone", F.lit(False)), saved, base, name, manifest=tb.manifest_of(spark, path, k))
    named = tb.read_manifest(spark, base)
    seen = tb.read_messages(spark, base)
    totals = named.groupBy("source_id").agg(F.sum("n").cast(BIG).alias("n"), F.min("first").alias("a"), F.max("last").alias("z"))
    made = totals.select(F.lit("manifest").alias("part"), "source_id", F.concat_ws("-", "a.file_no", "a.pos", "z.file_no", "z.pos").alias("name"), "n")
    return made.unionByName(seen.select(F.lit("message").alias("part"), "source_id", F.col("key").alias("name"), F.col("commit_pos").alias("n")))


@query
def s6_write_state(spark, sf_dir):
    base = folder(spark, "state")
    outbox, saved = fx.state(spark, sf_dir), fx.checkpoints(spark, sf_dir)
    tb.write_state(outbox, saved.limit(0), base, "v1")
    # What an attempt of all failed rows changes, on top of the whole table.
    tried = dl.attempt(dl.failed_rows(outbox), fx.bindings(spark))
    failed = dl.apply_results(dl.failed_rows(outbox), tried, fx.now()).withColumn("gone", F.lit(False))
    gone = dl.failed_rows(outbox).join(tried.where("ok").select("id"), "id", "left_semi").withColumn("gone", F.lit(True))
    tb.write_delta(failed.unionByName(gone), saved, base, "v2")
    rows, points = tb.read_state(spark, base)
    kept = rows.select(F.lit("outbox").alias("part"), F.col("id").cast("string").alias("name"), F.col("attempt_count").alias("value"))
    return kept.unionByName(points.select(F.lit("checkpoint").alias("part"), F.col("consumer_name").alias("name"), F.col("binlog_position").alias("value")))


def _events(log: DataFrame) -> DataFrame:
    n = F.greatest(F.coalesce(F.size("rows"), F.lit(0)), F.lit(0)).cast(BIG)
    return log.select("source_id", "log_file", "log_pos", "event_seq", "event_type", "query", "table_name", n.alias("n_rows"))


def _drained(spark, stream: DataFrame) -> DataFrame:
    """All that a stream gives until its source is used up."""
    out = folder(spark, "drained")
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-progress").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@query
def s3_resume_point(spark, sf_dir):
    """Places of what a stream commits that begins in the middle of the log: sources 0 and 1 by GTID set, 2 by position, 3 not at all."""
    path = _in_slices(spark, dc.filter_inserts(dc.filter_table(fx.relay_log(spark, sf_dir), fx.DB, fx.TABLE)))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    last = orders.agg(F.coalesce(F.max("o_orderkey"), F.lit(0)).alias("m")).first()["m"]
    half, file = last // 8, last // 2000
    start = spark.createDataFrame(
        [("src0", "bin.000001", 4, f"src0:1-{half}"), ("src1", "bin.000001", 4, f"src1:1-{half // 2}:{half // 2 + 2}-{half}"), ("src2", f"bin.{file + 1:06d}", 49_903, None)], "source_id string, binlog_name string, binlog_position long, gtid_set string"
    )
    with _rocksdb(spark):
        places = _drained(spark, rl.stream_transactions(tb.stream_change_log(spark, path, 6, start), fx.DB, fx.TABLE, start=start))
    return places.where("kind = 'end' and outcome <> 'rotated'").select("source_id", "log_file", "commit_pos", "outcome", "n_rows")


@query
def d1_filter_table(spark, sf_dir):
    return _events(dc.filter_table(fx.change_log(spark, sf_dir), fx.DB, fx.TABLE))


@query
def d2_filter_inserts(spark, sf_dir):
    return _events(dc.filter_inserts(fx.change_log(spark, sf_dir)))


@query
def d3_explode_rows(spark, sf_dir):
    rows = dc.explode_rows(dc.filter_table(fx.change_log(spark, sf_dir), fx.DB, fx.TABLE))
    return rows.select("source_id", "log_file", "log_pos", F.col("row_idx").cast(BIG).alias("row_idx"), F.decode(F.get("row", F.lit(0)), "UTF-8").cast(BIG).alias("id"))


@query
def d4_explode_payload(spark, sf_dir):
    rows = dc.explode_payload(fx.payload_log(spark, sf_dir), fx.DB, fx.TABLE)
    return rows.select("source_id", "log_file", "log_pos", F.col("row_idx").cast(BIG).alias("row_idx"), F.decode(F.get("row", F.lit(0)), "UTF-8").cast(BIG).alias("id"))


def _raw_rows(spark, sf_dir) -> DataFrame:
    """Row images of the events, some of them bad; event 0 has id 0."""
    b = lambda e: F.encode(F.expr(e), "UTF-8")
    odd = F.unhex(F.lit("FFFE"))  # bytes that are no text
    image = F.array(
        F.when(F.expr("event_id % 89 = 11"), odd).otherwise(b("case when event_id % 71 = 0 and event_id > 0 then '-' || event_id when event_id % 73 = 1 then event_id || '.0' else cast(event_id as string) end")),
        F.when(F.expr("event_id % 83 = 7"), odd).otherwise(b("case when event_id % 61 <> 5 then 'events.' || event_type end")),
        b("case when event_id % 67 <> 5 then props end"),
        F.lit(None).cast("binary"),
        F.lit(None).cast("binary"),
        b("case when event_id % 53 = 0 then '4294967296' when event_id % 59 = 0 then '-1' when event_id % 4 > 0 then cast(event_id % 600 as string) end"),
    )
    image = F.when(F.expr("event_id % 79 = 3"), F.slice(image, 1, 4)).otherwise(image)
    # Exploded as rows of a log are, so that the image is made once and not in every use.
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.explode(F.array(image)).alias("row"))


@query
def d5_decode_rows(spark, sf_dir):
    rows = dc.decode_rows(_raw_rows(spark, sf_dir))
    return rows.select("event_id", "decode_error", F.col("id").cast(BIG).alias("id"), "subject", text("payload"), "ttl_seconds")


@query
def d6_quarantine(spark, sf_dir):
    good, bad = dc.quarantine(dc.decode_rows(_raw_rows(spark, sf_dir)), mode="split")
    return good.select("event_id", F.lit(None).cast("string").alias("decode_error")).unionByName(bad.select("event_id", "decode_error"))


@query
def d7_add_managed_columns(spark, sf_dir):
    old = fx.outbox(spark, sf_dir).drop("ttl_seconds", "attempt_count", "last_attempt_at", "last_error")
    return tb.conform(tb.add_managed_columns(old), fx.OUTBOX).select(F.col("id").cast(BIG).alias("id"), "subject", "ttl_seconds", "attempt_count", "last_error")


@query
def t1_carry_log_file(spark, sf_dir):
    named = tr.carry_log_file(fx.unnamed_log(spark, sf_dir), stride=250_000)
    return named.where("event_type <> 'ROTATE'").select("source_id", "event_seq", "event_type", "log_file")


@query
def t2_assign_transactions(spark, sf_dir):
    return tr.assign_transactions(fx.change_log(spark, sf_dir)).select("source_id", "log_file", "log_pos", "event_type", "table_name", "tx")


@query
def t3_transaction_outcomes(spark, sf_dir):
    return tr.transaction_outcomes(fx.rotated_log(spark, sf_dir), fx.DB, fx.TABLE)


@query
def t5_open_rows(spark, sf_dir):
    log = fx.rotated_log(spark, sf_dir).where("event_type <> 'ROTATE' or source_id in ('src0', 'src1')")
    rows = dc.explode_rows(tr.open_rows(dc.filter_table(log, fx.DB, fx.TABLE)))
    return rows.select("source_id", "log_file", "log_pos", "tx", F.decode(F.get("row", F.lit(0)), "UTF-8").cast(BIG).alias("id"))


@query
def t6_commit_order(spark, sf_dir):
    return tr.commit_order(messages(spark, sf_dir)).select("source_id", "log_file", F.col("id").cast(BIG).alias("id"), "publish_no")


@query
def t7_message_size(spark, sf_dir):
    size = tr.message_size(*[F.col(c) for c in ("subject", "payload", "headers", "message_id", "ttl_seconds")])
    return fx.outbox(spark, sf_dir).select(F.col("id").cast(BIG).alias("id"), size.cast(BIG).alias("n_bytes"))


@query
def t8_check_transaction_limits(spark, sf_dir):
    return tr.check_transaction_limits(fx.change_log(spark, sf_dir), fx.DB, fx.TABLE, max_rows=4, max_bytes=90)


@query
def t9_log_anomalies(spark, sf_dir):
    return tr.log_anomalies(fx.rotated_log(spark, sf_dir), fx.DB, fx.TABLE)


@query
def t10_stream_committed_rows(spark, sf_dir):
    log = fx.mixed_log(spark, sf_dir)
    path = _in_slices(spark, dc.filter_inserts(dc.filter_table(log, fx.DB, fx.TABLE)))
    out = folder(spark, "rows")
    with _rocksdb(spark):
        rl.stream_committed_rows(tb.stream_change_log(spark, path, 3), tb.indexed_log(path, f"{out}-index"), fx.DB, fx.TABLE, out, f"{out}-progress").awaitTermination()
    return shown(dc.quarantine(dc.decode_rows(spark.read.parquet(out).drop("batch"))))


def _in_slices(spark, log: DataFrame, slices: int = 3) -> str:
    """The log written in log order, slice after slice, each source in one file of a slice.

    Cuts lie between an order's rows and its terminal, so that a stream which
    reads few files a batch meets rows in an earlier batch than their commit.
    """
    path, whole = folder(spark, "log"), folder(spark, "whole")
    with tb.spending(spark):
        log.write.parquet(whole)
        log = tb.read_change_log(spark, whole)
        last = log.agg(F.coalesce(F.max("event_seq"), F.lit(0)).alias("m")).first()["m"]
        cuts = [last * k // slices // 100 * 100 + 50 for k in range(1, slices)]
        for low, high in zip((-(1 << 62), *cuts), (*cuts, 1 << 62), strict=True):
            log.where(F.col("event_seq").between(low + 1, high)).repartition(4, "source_id").write.mode("append").parquet(path)
    tb.discard(spark, whole)
    return path


class _rocksdb:
    """State in RocksDB while a stateful stream runs."""

    KEY = "spark.sql.streaming.stateStore.providerClass"

    def __init__(self, spark):
        self.spark = spark

    def __enter__(self):
        self.old = self.spark.conf.get(self.KEY)
        self.spark.conf.set(self.KEY, rl.ROCKSDB)

    def __exit__(self, *_):
        self.spark.conf.set(self.KEY, self.old)


# Checks


def _outbox(spark, sf_dir) -> DataFrame:
    return fx.outbox(spark, sf_dir)


def _id():
    return F.col("id").cast(BIG).alias("id")


@query
def v1_subject_error(spark, sf_dir):
    return _outbox(spark, sf_dir).select(_id(), v.subject_error(F.col("subject")).alias("error"))


@query
def v2_parse_headers(spark, sf_dir):
    each = _outbox(spark, sf_dir).select(_id(), F.explode(v.parse_headers(F.col("headers"))).alias("name", "values"))
    return each.select("id", "name", F.posexplode("values").alias("value_idx", "value")).withColumn("value_idx", F.col("value_idx").cast(BIG))


@query
def v3_header_error(spark, sf_dir):
    return _outbox(spark, sf_dir).select(_id(), v.header_error(F.col("headers")).alias("error"))


@query
def v4_parse_headers_strict(spark, sf_dir):
    return _outbox(spark, sf_dir).select(_id(), v.parse_headers_strict()(F.col("headers"))["error"].alias("error"))


@query
def v5_ttl(spark, sf_dir):
    ttl = F.col("ttl_seconds")
    return _outbox(spark, sf_dir).select(_id(), v.ttl_error(ttl).alias("error"), v.expires_at(F.col("created_at"), ttl).alias("expires_at"))


@query
def v6_stable_message_id(spark, sf_dir):
    return _outbox(spark, sf_dir).select(_id(), v.stable_message_id(fx.PREFIX, fx.DB, fx.TABLE).alias("stable_id"))


@query
def v7_validate_messages(spark, sf_dir):
    return v.validate_messages(_outbox(spark, sf_dir)).select(_id(), "error")


@query
def v8_contract_violations(spark, sf_dir):
    return v.contract_violations(_outbox(spark, sf_dir)).select(_id(), "rule")


@query
def v9_key_violations(spark, sf_dir):
    return v.key_violations(_outbox(spark, sf_dir))


# Routing and copies


@query
def r1_route_subjects(spark, sf_dir):
    return rt.route_subjects(_outbox(spark, sf_dir), fx.bindings(spark)).select(_id(), "subject", "stream")


@query
def r2_check_expected_stream(spark, sf_dir):
    routed = rt.route_subjects(_outbox(spark, sf_dir), fx.bindings(spark))
    return rt.check_expected_stream(routed, "EVENTS").select(_id(), "route_error")


@query
def r3_dedupe_window(spark, sf_dir):
    return rt.dedupe_window(_stable(spark, sf_dir), "message_id", "created_at", "id", 86_400)


def _stable(spark, sf_dir) -> DataFrame:
    """Every row under its stable id."""
    return _outbox(spark, sf_dir).select(_id(), v.stable_message_id(*NAMES).alias("message_id"), "created_at")


@query
def r4_stream_dedupe(spark, sf_dir):
    path = folder(spark, "messages")
    given = _stable(spark, sf_dir)
    # Slices of time, written one after the other and read in several batches.
    edges = given.agg(F.percentile_approx(F.unix_micros("created_at"), [0.25, 0.5, 0.75]).alias("e")).first()["e"] or []
    for low, high in zip((None, *edges), (*edges, None), strict=True):
        at = F.unix_micros("created_at")
        inside = (F.lit(True) if low is None else at > low) & (F.lit(True) if high is None else at <= high)
        given.where(inside).repartition("message_id").write.mode("append").parquet(path)
    stream = spark.readStream.schema(given.schema).option("maxFilesPerTrigger", 4).parquet(path)
    with _rocksdb(spark):
        kept = _drained(spark, rl.stream_dedupe(stream, "message_id", "created_at", "id", 86_400, "10 days"))
    return kept.select(F.col("row").alias("id"), F.col("key").alias("message_id"), F.timestamp_micros("at").alias("created_at"))


@query
def r4_settled_dedupe(spark, sf_dir):
    """The same of copies that come out of order, up to a quarter of their whole time late."""
    path = folder(spark, "messages")
    given = _stable(spark, sf_dir)
    at = F.unix_micros("created_at")
    low, high = given.agg(F.coalesce(F.min(at), F.lit(0)), F.coalesce(F.max(at), F.lit(0))).first()
    span, day = high - low, 86_400_000_000
    part = span // 8 + 1
    late = at + F.pmod(F.xxhash64("id"), F.lit(part))
    # Each slice holds an eighth of the time and what is up to an eighth late; an event after all lets the last ones out.
    given.withColumn("slice", F.floor((late - low) / part).cast("int")).repartition("slice").write.partitionBy("slice").parquet(path)
    stream = spark.readStream.schema("id bigint, message_id string, created_at timestamp").option("maxFilesPerTrigger", 1)
    for k in range(10):
        made = spark.read.schema("id bigint, message_id string, created_at timestamp, slice int").parquet(path).where(F.col("slice") == k).select("id", "message_id", "created_at")
        made.coalesce(1).write.mode("append").parquet(f"{path}-in")
    end = spark.range(1).select(F.lit(-1).cast(BIG).alias("id"), F.lit("").alias("message_id"), F.timestamp_micros(F.lit(high + 2 * span + 2 * day)).alias("created_at"))
    end.coalesce(1).write.mode("append").parquet(f"{path}-in")
    with _rocksdb(spark):
        kept = _drained(spark, rl.stream_dedupe(stream.parquet(f"{path}-in"), "message_id", "created_at", "id", 86_400, f"{span // 2_000_000 + 1} seconds", "settled"))
    return kept.select(F.col("row").alias("id"), F.col("key").alias("message_id"), F.timestamp_micros("at").alias("created_at"))


@query
def r5_live_messages(spark, sf_dir):
    stored = _outbox(spark, sf_dir).withColumn("expires_at", v.expires_at(F.col("created_at"), F.col("ttl_seconds") * 7200))
    return rt.live_messages(stored, F.lit("2024-01-20 00:00:00").cast("timestamp")).select(_id(), "expires_at")


# Delivery


def _attempted(spark, sf_dir) -> DataFrame:
    return dl.attempt(_outbox(spark, sf_dir), fx.bindings(spark))


def _state(df: DataFrame) -> DataFrame:
    return df.select(_id(), "attempt_count", "last_attempt_at", "last_error")


@query
def a1_attempt(spark, sf_dir):
    return _attempted(spark, sf_dir).select(_id(), "ok", "error", "was_retry", "first_failure")


@query
def a2_delete_acknowledged(spark, sf_dir):
    return _state(dl.delete_acknowledged(_outbox(spark, sf_dir), _attempted(spark, sf_dir)))


@query
def a3_record_failures(spark, sf_dir):
    return _state(dl.record_failures(_outbox(spark, sf_dir), _attempted(spark, sf_dir), fx.now()))


@query
def a4_apply_results(spark, sf_dir):
    return _state(dl.apply_results(_outbox(spark, sf_dir), _attempted(spark, sf_dir), fx.now()))


@query
def a5_snapshot_page(spark, sf_dir):
    return dl.snapshot_page(_outbox(spark, sf_dir), 200, 500).select(_id(), "subject", "attempt_count")


@query
def a6_snapshot_batches(spark, sf_dir):
    return dl.snapshot_batches(_outbox(spark, sf_dir), 500).select(_id(), "batch")


@query
def a7_failed_rows(spark, sf_dir):
    return dl.failed_rows(_outbox(spark, sf_dir)).select(_id(), "attempt_count")


@query
def a7_count_failed(spark, sf_dir):
    return dl.count_failed(_outbox(spark, sf_dir))


def _begun(spark, sf_dir) -> str:
    """A state with the whole outbox, of one source, and checkpoints."""
    base = folder(spark, "state")
    tb.write_state(fx.state(spark, sf_dir), fx.checkpoints(spark, sf_dir), base, "start")
    return base


def _published(spark, base: str) -> DataFrame:
    return tb.read_messages(spark, base).select(F.lit("message").alias("part"), F.col("key").alias("name"), F.octet_length("value").cast(BIG).alias("value"), F.col("topic").alias("note"))


NAMES = (fx.PREFIX, fx.DB, fx.TABLE)


@query
def a8_retry_pass(spark, sf_dir):
    """The outbox, the totals and the messages after a pass; it runs again and changes nothing."""
    base = _begun(spark, sf_dir)
    for _ in range(2):
        totals = ps.retry_pass(spark, base, "1", NAMES, fx.bindings(spark), fx.now())
    counts = totals.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in ("attempted", "succeeded", "failed")])).alias("t")).select(F.lit("total").alias("part"), "t.*", F.lit(None).cast("string").alias("note"))
    after = tb.read_state(spark, base)[0].select(F.lit("outbox").alias("part"), F.col("id").cast("string").alias("name"), F.col("attempt_count").alias("value"), F.col("last_error").alias("note"))
    return after.unionByName(counts).unionByName(_published(spark, base))


@query
def a9_snapshot_pass(spark, sf_dir):
    """The outbox, the checkpoints and the messages as the pass committed them; the source's table lacks some rows of the state."""
    base = _begun(spark, sf_dir)
    positions = spark.createDataFrame([("main", "app", "bin.000009", 120, "u:1-7", 0)], "consumer_name string, source_id string, binlog_name string, binlog_position long, gtid_set string, write_seq long")
    ps.snapshot_pass(spark, base, "1", fx.state(spark, sf_dir).where("subject not like 'other.%'"), positions, NAMES, fx.bindings(spark), fx.now())
    after, saved = tb.read_state(spark, base)
    points = saved.select(F.lit("checkpoint").alias("part"), F.col("consumer_name").alias("name"), F.col("binlog_position").alias("value"), F.concat_ws(" ", "binlog_name", "gtid_set").alias("note"))
    kept = after.select(F.lit("outbox").alias("part"), F.col("id").cast("string").alias("name"), F.col("attempt_count").alias("value"), F.col("last_error").alias("note"))
    return kept.unionByName(points).unionByName(_published(spark, base))


def _relayed(spark, base: str) -> DataFrame:
    rows, points = tb.read_state(spark, base)
    made = tb.read_messages(spark, base).select(F.lit("message").alias("part"), F.col("key").alias("name"), F.col("commit_pos").alias("value"), F.col("topic").alias("note"))
    made = made.unionByName(rows.select(F.lit("outbox").alias("part"), F.concat_ws(":", "source_id", F.col("id").cast("string")).alias("name"), F.col("attempt_count").alias("value"), F.col("last_error").alias("note")))
    return made.unionByName(points.select(F.lit("checkpoint").alias("part"), F.col("consumer_name").alias("name"), F.col("binlog_position").alias("value"), F.concat_ws(" ", "binlog_name", "gtid_set").alias("note")))


@query
def a10_relay_stream(spark, sf_dir):
    """Messages, outbox and checkpoints after the log of several sources, whose ids are the same, has been relayed in several batches."""
    base = folder(spark, "state")
    path = _in_slices(spark, fx.relay_log(spark, sf_dir))
    begun = [("main/src0", "bin.000001", 4, "src0:1-3"), ("main/src1", "bin.000001", 4, "other:5"), ("main/src2", "bin.000001", 4, None)]
    saved = spark.createDataFrame(begun, "consumer_name string, binlog_name string, binlog_position long, gtid_set string").withColumn("updated_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    tb.write_state(fx.state(spark, sf_dir).limit(0), saved, base, "start")
    rules = spark.createDataFrame([("ITEMS", "items.N.>")], "stream string, pattern string")
    names = (v.source_prefix(fx.PREFIX), fx.DB, fx.TABLE)
    with _rocksdb(spark):
        log = tb.stream_change_log(spark, path, 5)
        rl.relay_stream(log, base, tb.indexed_log(path, f"{base}-index"), names, rules, "main", fx.now(), f"{base}-progress", interval_seconds=10, compact_every=2).awaitTermination()
    tb.discard(spark, path)
    return _relayed(spark, base)


@query
def c8_recover(spark, sf_dir):
    """Recovery carried out: each source by its plan, over one state.

    Source 0 streams from its GTID set, 1 from its position, 2 has no checkpoint
    and is read whole first, 3 has lost its position and is read whole, 4 has a
    set that its server lacks and starts nothing.
    """
    base = folder(spark, "state")
    log = fx.relay_log(spark, sf_dir)
    path = _in_slices(spark, log)
    saved = spark.createDataFrame(
        [("main/src0", "bin.000001", 4, "src0:1-20"), ("main/src1", "bin.000001", 5003, None), ("main/src3", "bin.000001", 3, None), ("main/src4", "bin.000001", 4, "zz:1-9")], "consumer_name string, binlog_name string, binlog_position long, gtid_set string"
    ).withColumn("updated_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    tb.write_state(fx.state(spark, sf_dir).limit(0), saved, base, "start")
    sources = [f"src{k}" for k in range(5)]
    consumers = spark.createDataFrame([(f"main/{s}", s) for s in sources], "consumer_name string, source_id string")
    files = spark.createDataFrame([(s, "bin.000001", 1 << 31) for s in sources], "source_id string, name string, size long")
    server = spark.createDataFrame([(s, s in ("src0", "src4"), "src0:1-1000000000" if s == "src0" else "", "") for s in sources], "source_id string, gtid_on boolean, gtid_executed string, gtid_purged string")
    # Where the servers are when the tables are read: behind all that the log holds of source 2, in the first file of source 3.
    here = spark.createDataFrame([("src2", "bin.999999", 4, None), ("src3", "bin.000001", 50_003, None)], "source_id string, binlog_name string, binlog_position long, gtid_set string")
    table = fx.state(spark, sf_dir)
    dealt = {"source_id": F.when(F.col("id") % 2 == 0, "src2").otherwise("src3"), "id": (F.col("id") + 10_000_000_000).cast(fx.ID)}
    whole = lambda: table.withColumns(dealt)
    rules = spark.createDataFrame([("ITEMS", "items.N.>"), ("EVENTS", "events.>")], "stream string, pattern string")
    names = (v.source_prefix(fx.PREFIX), fx.DB, fx.TABLE)

    def stream(start):
        events = tb.stream_change_log(spark, path, 12, start)
        return rl.relay_stream(events, base, tb.indexed_log(path, f"{base}-index"), names, rules, "main", fx.now(), f"{base}-progress", start=start, interval_seconds=10)

    with _rocksdb(spark):
        plans = ps.recover(spark, base, "1", consumers, files, server, here, whole, names, rules, fx.now(), stream)
    tb.discard(spark, path)
    told = plans.select(F.lit("plan").alias("part"), F.col("consumer_name").alias("name"), F.lit(None).cast(BIG).alias("value"), F.concat_ws(": ", "plan", "reason").alias("note"))
    points = F.col("part") == "checkpoint"  # where a source came to is a10's matter
    return _relayed(spark, base).where(~points).unionByName(told)


# Checkpoints and GTID sets


@query
def c1_upsert_checkpoints(spark, sf_dir):
    state = fx.checkpoints(spark, sf_dir)
    done = cp.upsert_checkpoints(state, fx.checkpoint_writes(spark, sf_dir).where("consumer_name <> 'c3'"), fx.now())
    return done.select("consumer_name", "binlog_name", "binlog_position", "gtid_set", "updated_at")


@query
def c2_load_checkpoint(spark, sf_dir):
    last = cp.upsert_checkpoints(fx.checkpoints(spark, sf_dir), fx.checkpoint_writes(spark, sf_dir), fx.now())
    return cp.load_checkpoint(last, "c2").select("consumer_name", "binlog_position", "error")


@query
def c3_checkpoint_timeline(spark, sf_dir):
    return cp.checkpoint_timeline(fx.commits(spark, sf_dir), 6 * 3600)


def _user_sets(spark, sf_dir) -> DataFrame:
    cell = F.expr("'U' || (event_id % 3) || ':' || (event_id + 1) || '-' || (event_id + 40)")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", cell.alias("gtid_set"))


@query
def c4_parse_gtid_set(spark, sf_dir):
    spans = _user_sets(spark, sf_dir).select("user_id", F.explode(gt.parse_gtid_set(F.col("gtid_set"))).alias("g")).select("user_id", "g.*")
    return gt.format_gtid_set(spans, ("user_id",))


@query
def c5_gtid_union(spark, sf_dir):
    return gt.gtid_union(fx.gtids(spark, sf_dir), stretch=997)


@query
def c6_gtid_contains(spark, sf_dir):
    a = fx.gtids(spark, sf_dir)
    label = lambda df, name: df.withColumn("label", F.lit(name))
    both = label(a, "more").unionByName(label(a, "less"))
    asked = label(fx.gtids(spark, sf_dir, 50), "less").unionByName(label(fx.gtids(spark, sf_dir, 10), "more"))
    return gt.gtid_contains(both, asked, ("label",))


@query
def c7_position_available(spark, sf_dir):
    _, saved, files, state = fx.recovery_tables(spark, sf_dir)
    return cp.position_available(saved, files, state).select("consumer_name", "has_gtid", "available", "error")


@query
def c8_plan_recovery(spark, sf_dir):
    return cp.plan_recovery(*fx.recovery_tables(spark, sf_dir))


@query
def c9_attach_gtid(spark, sf_dir):
    """Sources 0 to 2 have a GTID set; source 3 is read by file position."""
    saved = spark.createDataFrame([("src0", "src0:1-3"), ("src1", "src1:1"), ("src2", "src2:1"), ("src3", None)], "source_id string, gtid_set string")
    marked = cp.attach_gtid(fx.gtid_log(spark, sf_dir), saved)
    start = saved.select(F.explode(gt.parse_gtid_set(F.col("gtid_set"))).alias("g")).select("g.*")
    total = cp.gtid_as_of(marked, start).select(F.col("uuid").alias("source_id"), F.lit("as of the end").alias("log_file"), F.col("start").alias("log_pos"), F.lit(None).cast("string").alias("gtid_uuid"), F.col("end").alias("gno"))
    return marked.select("source_id", "log_file", "log_pos", "gtid_uuid", "gno").unionByName(total)


@query
def c9_sets_at_checkpoints(spark, sf_dir):
    """The set of each source as of the last terminal of each of its files."""
    saved = spark.createDataFrame([("src0", "src0:1-3"), ("src1", "src1:1"), ("src2", "src2:1")], "source_id string, gtid_set string")
    marked = cp.attach_gtid(fx.gtid_log(spark, sf_dir), saved)
    line = tb.file_number(F.col("log_file")) * (1 << 32) + F.col("log_pos")
    placed = marked.withColumn("line", line)
    points = placed.groupBy("source_id", "log_file").agg(F.max("line").alias("row")).select("source_id", "row").join(saved.select("source_id"), "source_id")
    begun = saved.select("source_id", F.explode(gt.parse_gtid_set(F.col("gtid_set"))).alias("g")).select("source_id", "g.*")
    seen = placed.where("gtid_uuid is not null").select("source_id", "line", F.col("gtid_uuid").alias("uuid"), "gno")
    return gt.gtid_sets_at(seen, points, begun, ("source_id",), stride=1 << 32).select("source_id", F.expr("row div 4294967296").alias("file_no"), "start", "end")


# Metrics


def _failed(spark, sf_dir) -> DataFrame:
    """Failed rows left of each consumer; c0 has none."""
    attempts = fx.attempts(spark, sf_dir)
    return attempts.groupBy("consumer").agg((F.count_if("first_failure") - F.count_if(F.col("ok") & F.col("was_retry"))).alias("n")).select("consumer", F.when(F.col("consumer") == "c0", 0).otherwise(F.greatest("n", F.lit(1))).cast(BIG).alias("n_failed"))


@query
def h1_delivery_counters(spark, sf_dir):
    return mt.delivery_counters(fx.attempts(spark, sf_dir), fx.checkpoints(spark, sf_dir))


@query
def h2_last_error(spark, sf_dir):
    return mt.last_error(fx.attempts(spark, sf_dir), _failed(spark, sf_dir))


@query
def h3_failed_rows_gauge(spark, sf_dir):
    initial = spark.createDataFrame([("c0", 5), ("c1", 0)], "consumer string, n_failed long")
    return mt.failed_rows_gauge(fx.attempts(spark, sf_dir), initial).select("consumer", "id", "gauge")


@query
def h4_metrics_long(spark, sf_dir):
    stops = spark.createDataFrame([("c1", 4)], "consumer string, n_errors long")
    counters = mt.delivery_counters(fx.attempts(spark, sf_dir), fx.checkpoints(spark, sf_dir))
    return mt.metrics_long(counters, _failed(spark, sf_dir), stops).withColumnRenamed("type", "kind")


@query
def h5_delivery_by_window(spark, sf_dir):
    return mt.delivery_by_window(fx.attempts(spark, sf_dir), "6 hours")


@query
def h6_alerts(spark, sf_dir):
    windows = mt.delivery_by_window(fx.attempts(spark, sf_dir), "6 hours")
    return mt.alerts(windows, _failed(spark, sf_dir), fx.checkpoints(spark, sf_dir), fx.now(), 90_000)


def _attempt_stream(spark, sf_dir) -> DataFrame:
    """The attempts as a stream in order of time, closed by one of a consumer of its own far behind all others."""
    path = folder(spark, "attempts")
    attempts = fx.attempts(spark, sf_dir)
    edges = attempts.agg(F.percentile_approx(F.unix_micros("ts"), [0.3, 0.6]).alias("e")).first()["e"] or []
    at = F.unix_micros("ts")
    for low, high in zip((None, *edges), (*edges, None), strict=True):
        inside = (F.lit(True) if low is None else at > low) & (F.lit(True) if high is None else at <= high)
        attempts.where(inside).coalesce(1).write.mode("append").parquet(path)
    attempts.limit(1).withColumns({"consumer": F.lit("end"), "ts": F.lit("2100-01-01 00:00:00").cast("timestamp")}).write.mode("append").parquet(path)
    return spark.readStream.schema(attempts.schema).option("maxFilesPerTrigger", 1).parquet(path)


@query
def h5_stream_windows(spark, sf_dir):
    """The windows of a stream, each told once when the watermark has passed it."""
    return _drained(spark, mt.delivery_by_window(_attempt_stream(spark, sf_dir), "6 hours", "1 day")).where("consumer <> 'end'")


@query
def h6_stream_alerts(spark, sf_dir):
    path = folder(spark, "checkpoints")
    fx.checkpoints(spark, sf_dir).write.parquet(path)
    saved = spark.readStream.schema(fx.checkpoints(spark, sf_dir).schema).parquet(path)
    with _rocksdb(spark):
        found = _drained(spark, al.stream_alerts(_attempt_stream(spark, sf_dir), saved, 6 * 3600, 90_000, "300 days"))
    return found.where("consumer <> 'end'").select("consumer", "alert", F.timestamp_micros("at").alias("at"), F.when(F.col("alert") == "errors_rising", F.col("value")).alias("value"))


@query
def h7_failures_by_reason(spark, sf_dir):
    return mt.failures_by_reason(fx.attempts(spark, sf_dir), F.col("ts"))
