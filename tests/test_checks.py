import datetime as dt

import pytest
from pyspark.sql import functions as F

from outflow.functions import validate as v
from outflow.operators import delivery as dl
from outflow.operators import passes as ps
from outflow.operators import routing as rt
from outflow.schemas import OUTBOX
from outflow.sources import tables as tb

T0 = dt.datetime(2024, 1, 1)


def row(i, subject="events.a", headers=None, message_id=None, ttl=None, attempts=0):
    from decimal import Decimal

    return (Decimal(i), subject, bytearray(b"p"), headers, message_id, ttl, attempts, None, None, T0)


def outbox(spark, *rows):
    return spark.createDataFrame(list(rows), OUTBOX)


HEADERS = {
    None: None, "": None, "null": None, " null ": None, "  ": "headers are not a JSON object", "[1]": "headers are not a JSON object", '"x"': "headers are not a JSON object", "{": "headers are not a JSON object",
    '{"Content-Type":"application/json","X-Tag":["one","two"]}': None, '{"nats-msg-id":"other"}': "header is reserved: nats-msg-id", '{"NATS-x":"1"}': "header is reserved: NATS-x",
    '{"A":null}': None, '{"A":[null]}': None, '{"A":[]}': None, '{"A":1}': "header value is not text: A", '{"A":true}': "header value is not text: A", '{"A":{}}': "header value is not text: A", '{"A":["x",1]}': "header value is not text: A",
    '{"A":["x",null]}': None, '{"":"x"}': "header name is invalid: ", '{"a:b":"x"}': "header name is invalid: a:b", '{"A":"x\\ny"}': "header value has a line break: A", '{"B":1,"A":2}': "header value is not text: A", '{"A":1,"A":"x"}': None, '{"A":"x","A":1}': "header value is not text: A",
}


def test_headers(spark):
    df = spark.createDataFrame([(h,) for h in HEADERS], "h string")
    got = {r["h"]: r for r in df.select("h", v.header_error(F.col("h")).alias("e"), v.parse_headers(F.col("h")).alias("m"), v.parse_headers_strict()(F.col("h")).alias("s")).collect()}
    for h, error in HEADERS.items():
        assert got[h]["e"] == error, h
        assert got[h]["s"]["error"] == error, h
        assert (got[h]["m"] or {}) == (got[h]["s"]["headers"] or {}), h
    assert got['{"A":null}']["m"] == {"A": [""]} and got['{"A":[]}']["m"] == {} and got['{"A":1,"A":"x"}']["m"] == {"A": ["x"]}
    strict = spark.createDataFrame([('{"A":"x"} junk',), ("{'A':'x'}",)], "h string").select(v.parse_headers_strict()(F.col("h"))["error"].alias("e")).collect()
    assert [r["e"] for r in strict] == ["headers are not a JSON object"] * 2


@pytest.mark.parametrize("subject,error", [("events.record-changed", None), ("", "subject is empty"), ("records.*", "subject is not concrete"), ("a.>", "subject is not concrete"), ("records..changed", "subject has an empty token"), (".a", "subject has an empty token"), ("a.", "subject has an empty token"), ("records changed", "subject is not concrete"), ("a\x0bb", None)])
def test_subjects(spark, subject, error):
    assert spark.createDataFrame([(subject,)], "s string").select(v.subject_error(F.col("s"))).first()[0] == error


def test_order_of_checks_and_ids(spark):
    df = outbox(spark, row(1, "", "{", None, 0), row(2, "a", "{", None, 0), row(3, "a", None, None, 0), row(42, "a", None, "", 30), row(5, "a\x0bb", "[]", "provided-id"))
    got = [(int(r["id"]), r["error"]) for r in v.validate_messages(df).collect()]
    assert got == [(1, "outbox row 1: subject is empty"), (2, "outbox row 2: headers are not a JSON object"), (3, "outbox row 3: ttl must be above zero"), (42, None), (5, "outbox row 5: headers are not a JSON object")]
    assert [r[0] for r in df.where("id in (42, 5)").select(v.stable_message_id("p", "app", "t")).collect()] == ["p:app:t:42", "provided-id"]
    assert {(int(r["id"]), r["rule"]) for r in v.contract_violations(df).collect()} == {(1, "subject_not_empty"), (1, "ttl_positive"), (1, "headers_object"), (2, "headers_object"), (2, "ttl_positive"), (3, "ttl_positive"), (5, "subject_concrete"), (5, "headers_object")}
    twice = outbox(spark, row(1, message_id="m"), row(1, message_id="m"), row(2))
    assert {tuple(r) for r in v.key_violations(twice).collect()} == {("id", "1", 2), ("message_id", "m", 2)}


def test_routes(spark):
    rules = spark.createDataFrame([("B", "events.>"), ("A", "events.*.x"), ("C", "*.one"), ("D", "a.b+c"), ("E", ">")][:4], "stream string, pattern string")
    subjects = {"events.a": "B", "events.a.x": "A", "events": None, "q.one": "C", "a.b+c": "D", "a.bbc": None, "events.one": "B", None: None}
    got = {r["subject"]: r["stream"] for r in rt.route_subjects(spark.createDataFrame([(s,) for s in subjects], "subject string"), rules).collect()}
    assert got == subjects


def test_failures_stay_and_successes_go(spark, tmp_path):
    long_error = "é" * 3000
    df = outbox(spark, row(1, "bad.subject"), row(2), row(3, "x", attempts=4))
    rules = spark.createDataFrame([("S", "events.>")], "stream string, pattern string")
    tried = dl.attempt(df, rules)
    now = F.lit("2024-02-02 00:00:00").cast("timestamp")
    got = {int(r["id"]): r for r in dl.apply_results(df, tried, now).collect()}
    assert set(got) == {1, 3} and got[1]["attempt_count"] == 1 and got[3]["attempt_count"] == 5 and got[1]["last_error"] == "outbox row 1: no stream covers the subject"
    cut = spark.createDataFrame([(long_error,)], "e string").select(dl.cut_error(F.col("e")), dl.cut_error(F.col("e"), 4095)).first()
    assert cut[0] == "é" * 2048 and cut[1] == "é" * 2047 + "�"
    absent = tried.withColumn("id", F.col("id") + 100)
    assert dl.apply_results(df, absent.select("id", "ok", "error"), now).count() == 3
    base, names = f"{tmp_path}/state", ("p", "app", "t")
    points = spark.createDataFrame([("c", "f", 4, None, T0)], "consumer_name string, binlog_name string, binlog_position long, gtid_set string, updated_at timestamp")
    tb.write_state(df.select(F.lit("s").alias("source_id"), "*"), points, base)
    left = lambda: {int(r["id"]) for r in tb.read_state(spark, base)[0].collect()}
    assert tuple(ps.retry_pass(spark, base, "1", names, rules, now).first()) == (1, 0, 1) and left() == {1, 2, 3}
    more = spark.createDataFrame([("S", "events.>"), ("X", "x")], "stream string, pattern string")
    ps.retry_pass(spark, base, "2", names, more, now)
    # What has left the table has been published.
    assert left() == {1, 2} and [r["key"] for r in tb.read_messages(spark, base).collect()] == ["p:app:t:3"]


def test_pages(spark):
    df = outbox(spark, *[row(i * i + 1) for i in range(57)])
    got = {int(r["id"]): r["batch"] for r in dl.snapshot_batches(df.repartition(5), 10).collect()}
    assert got == {i * i + 1: i // 10 for i in range(57)}
    assert [int(r["id"]) for r in dl.snapshot_page(df, 10, 3).collect()] == [17, 26, 37]
    assert dl.snapshot_batches(df.limit(0), 10).count() == 0


def test_tables_conform_and_state_is_one_unit(spark, tmp_path):
    df = outbox(spark, row(1), row(2, attempts=1))
    shuffled = df.select(F.lit(1).alias("extra"), *[F.col(c).alias(c.upper()) for c in reversed(df.columns)])
    assert tb.conform(shuffled, OUTBOX).schema.names == OUTBOX.names
    with pytest.raises(ValueError, match="missing columns: subject"):
        tb.conform(df.drop("subject"), OUTBOX)
    with pytest.raises(ValueError, match="payload is string"):
        tb.conform(df.withColumn("payload", F.lit("x")), OUTBOX)
    base = f"file://{tmp_path}/state"
    points = spark.createDataFrame([("c", "f", 4, None, T0)], "consumer_name string, binlog_name string, binlog_position long, gtid_set string, updated_at timestamp")
    assert tb.read_state(spark, base) is None
    tb.write_state(df, points, base, "v1")
    df.limit(1).write.parquet(f"{base}/v2/outbox")  # a run that was stopped between table and pointer
    assert tb.read_state(spark, base)[0].count() == 2
    tb.write_state(df.limit(1), points, base, "v2")
    assert tb.read_state(spark, base)[0].count() == 1 and tb.current_version(spark, base) == "v2"
