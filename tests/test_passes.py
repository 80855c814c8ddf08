"""Passes over the outbox, recovery, and reading the table over a database connection."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from outflow import schemas
from outflow.functions.validate import source_prefix, validate_messages
from outflow.operators import passes as ps
from outflow.sources import tables as tb

T0 = dt.datetime(2024, 1, 1)
NAMES = ("relay", "app", "outbox")


def table(spark, *rows):
    """Rows (source, id, subject, attempts) of a state."""
    made = [(s, i, subject, b"p", None, None, None, n, None, None, T0) for s, i, subject, n in rows]
    types = "source_id string, id long, subject string, payload binary, headers string, message_id string, ttl_seconds long, attempt_count long, last_attempt_at timestamp, last_error string, created_at timestamp"
    return tb.conform(spark.createDataFrame(made, types), schemas.STATE)


def points(spark, *rows):
    return spark.createDataFrame([(*r, T0) for r in rows], "consumer_name string, binlog_name string, binlog_position long, gtid_set string, updated_at timestamp")


def rules(spark):
    return spark.createDataFrame([("A", "a.>")], "stream string, pattern string")


def now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def rows_of(spark, base):
    return sorted((r["source_id"], int(r["id"]), r["attempt_count"]) for r in tb.read_state(spark, base)[0].collect())


def keys_of(spark, base):
    return sorted(r["key"] for r in tb.read_messages(spark, base).collect())


@pytest.fixture
def stopping(monkeypatch):
    """The next pointer swap fails once."""
    swap, left = tb.swap_pointer, [0]

    def failing(*args):
        if left[0]:
            left[0] -= 1
            raise RuntimeError("stopped before the pointer")
        swap(*args)

    monkeypatch.setattr(tb, "swap_pointer", failing)
    return left


def test_retry_publishes_then_commits(spark, tmp_path, stopping):
    base = f"{tmp_path}/state"
    tb.write_state(table(spark, ("s", 1, "a.x", 2), ("s", 2, "b.x", 1), ("s", 3, "a.y", 0)), points(spark, ("c", "f", 4, None)), base, "start")
    stopping[0] = 1
    with pytest.raises(RuntimeError):
        ps.retry_pass(spark, base, "1", NAMES, rules(spark), now())
    # Messages are written, but nothing has left and no reader sees them.
    assert rows_of(spark, base) == [("s", 1, 2), ("s", 2, 1), ("s", 3, 0)] and keys_of(spark, base) == []
    for _ in range(2):
        totals = ps.retry_pass(spark, base, "1", NAMES, rules(spark), now()).first()
        assert tuple(totals) == (2, 1, 1)
        assert rows_of(spark, base) == [("s", 2, 2), ("s", 3, 0)] and keys_of(spark, base) == ["relay:app:outbox:1"]
    assert tuple(ps.retry_pass(spark, base, "2", NAMES, rules(spark), now()).first()) == (1, 0, 1)
    tb.compact(spark, base)
    assert rows_of(spark, base) == [("s", 2, 3), ("s", 3, 0)] and keys_of(spark, base) == ["relay:app:outbox:1"]
    assert tb.read_state(spark, base)[1].first()["binlog_position"] == 4


def test_snapshot_saves_its_position_with_the_results(spark, tmp_path, stopping):
    base = f"{tmp_path}/state"
    tb.write_state(table(spark, ("s", 1, "a.x", 2), ("s", 9, "b.x", 1), ("t", 1, "b.x", 4)), points(spark, ("c", "f", 4, None)), base, "start")
    here = spark.createDataFrame([("c", "s", "f", 90, "u:1-7", 0)], "consumer_name string, source_id string, binlog_name string, binlog_position long, gtid_set string, write_seq long")
    mine = lambda: table(spark, ("s", 1, "a.x", 2), ("s", 2, "b.x", 0), ("s", 3, "a.y", 0), ("u", 5, "a.y", 0))
    names = (source_prefix("relay"), *NAMES[1:])
    stopping[0] = 1
    with pytest.raises(RuntimeError):
        ps.snapshot_pass(spark, base, "1", mine(), here, names, rules(spark), now())
    assert tb.read_state(spark, base)[1].first()["binlog_position"] == 4
    for _ in range(2):
        assert tuple(ps.snapshot_pass(spark, base, "1", mine(), here, names, rules(spark), now()).first()) == (3, 2, 1)
        # Row 9 of the source has left its table; the other source's row stays, and u is no source of the pass.
        assert rows_of(spark, base) == [("s", 2, 1), ("t", 1, 4)] and keys_of(spark, base) == ["relay/s:app:outbox:1", "relay/s:app:outbox:3"]
        assert [(r["binlog_position"], r["gtid_set"]) for r in tb.read_state(spark, base)[1].collect()] == [(90, "u:1-7")]
    with pytest.raises(ValueError, match="a prefix for each source"):
        ps.retry_pass(spark, base, "1", NAMES, rules(spark), now())


def test_recovery_is_carried_out_once(spark, tmp_path):
    base = f"{tmp_path}/state"
    tb.write_state(table(spark, ("gone", 1, "b.x", 1)), points(spark, ("c/stay", "f1", 8, None), ("c/gone", "f0", 8, None), ("c/bad", "f1", 8, "u:1")), base, "start")
    consumers = spark.createDataFrame([(f"c/{s}", s) for s in ("stay", "gone", "new", "bad")], "consumer_name string, source_id string")
    files = spark.createDataFrame([(s, "f1", 100) for s in ("stay", "gone", "new", "bad")], "source_id string, name string, size long")
    server = spark.createDataFrame([(s, False, "", "") for s in ("stay", "gone", "new", "bad")], "source_id string, gtid_on boolean, gtid_executed string, gtid_purged string")
    here = spark.createDataFrame([("gone", "f1", 50, None), ("new", "f1", 60, None)], "source_id string, binlog_name string, binlog_position long, gtid_set string")
    started, read = [], []

    class Done:
        def awaitTermination(self):
            pass

    def stream(start):
        started.append(sorted((r["source_id"], r["binlog_name"], r["binlog_position"]) for r in start.collect()))
        return Done()

    def rows():
        read.append(1)
        return table(spark, ("gone", 1, "b.x", 1), ("gone", 2, "a.x", 0), ("new", 1, "a.x", 0), ("stay", 1, "a.x", 0))

    names = (source_prefix("relay"), *NAMES[1:])
    for _ in range(2):
        plans = ps.recover(spark, base, "1", consumers, files, server, here, rows, names, rules(spark), now(), stream)
        assert {r["source_id"]: r["plan"] for r in plans.collect()} == {"stay": "stream_file", "gone": "snapshot", "new": "snapshot", "bad": "error"}
        assert rows_of(spark, base) == [("gone", 1, 2)] and keys_of(spark, base) == ["relay/gone:app:outbox:2", "relay/new:app:outbox:1"]
    # Sources read whole follow the log from the position taken before; the one with an error doesn't start.
    assert started == [[("gone", "f1", 50), ("new", "f1", 60), ("stay", "f1", 8)]] * 2


def test_messages_of_a_subject_keep_their_order(spark, tmp_path):
    sent = spark.range(400).select(F.lit("s").alias("source_id"), F.lit("f1").alias("log_file"), F.col("id").alias("commit_pos"), F.lit(0).cast("long").alias("log_pos"), F.lit(0).cast("long").alias("event_seq"), F.lit(0).alias("row_idx"), F.concat(F.lit("t"), F.col("id") % 7).alias("topic"), F.lit("k").alias("key"), F.lit(b"v").alias("value"), F.array().cast("array<struct<key:string,value:binary>>").alias("headers"))
    order = list(ps.PLACE)
    for by in ("commit", "subject"):
        path = f"{tmp_path}/{by}"
        tb.write_messages(sent.repartition(5), path, order, by)
        named = tb.manifest_of(spark, path, 3).collect()
        assert sum(r["n"] for r in named) == 400 and min(r["first"]["pos"] for r in named) == 0 and max(r["last"]["pos"] for r in named) == 399
        for r in named:
            rows = [(x["topic"], x["commit_pos"]) for x in spark.read.parquet(r["file"]).collect()]
            topics = {t for t, _ in rows}
            assert all([p for u, p in rows if u == t] == sorted(p for u, p in rows if u == t) for t in topics)
            if by == "commit":  # ranges of commits don't meet
                assert r["last"]["pos"] - r["first"]["pos"] + 1 == r["n"]
            else:  # nor do subjects
                assert sum(p for _, p in rows) == sum(k for k in range(400) if f"t{k % 7}" in topics)
    with pytest.raises(ValueError):
        tb.write_messages(sent, f"{tmp_path}/x", order, "size")


def test_free_text_headers_are_read_strictly(spark):
    df = table(spark, ("s", 1, "a.x", 0)).withColumn("headers", F.explode(F.array(F.lit('{"A":"x"}'), F.lit('{"A":"x"} junk'), F.lit("{'A':'x'}"))))
    errors = lambda strict: [r["error"] is not None for r in validate_messages(df, strict=strict).collect()]
    assert errors(True) == [False, True, True] and errors(False) != errors(True)


@pytest.fixture
def database(spark, tmp_path):
    pytest.importorskip("py4j")
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    connect = spark._jvm.java.sql.DriverManager.getConnection
    try:
        spark._jvm.java.lang.Class.forName("org.apache.derby.iapi.jdbc.AutoloadedDriver")
        connection = connect(url)
    except Exception as e:
        pytest.skip(f"no database in Spark's jars: {type(e).__name__}")
    run = connection.createStatement()
    run.execute("create table outbox (ID decimal(20,0) primary key, SUBJECT varchar(255), PAYLOAD blob, HEADERS clob, MESSAGE_ID varchar(255), TTL_SECONDS bigint, ATTEMPT_COUNT integer, LAST_ATTEMPT_AT timestamp, LAST_ERROR clob, CREATED_AT timestamp, EXTRA integer)")
    yield url, run
    run.close()
    connection.close()


def test_a_database_table_is_read_in_ranges(spark, database):
    url, run = database
    # Ids crowd in two places with a wide gap between; the last is the largest unsigned one.
    ids = [k + 1 for k in range(60)] + [10**15 + k for k in range(39)] + [18446744073709551615]
    for i in ids:
        run.execute(f"insert into outbox values ({i}, 'a.b', cast(X'00ff' as blob), null, null, null, 0, null, null, timestamp('2024-01-01 00:00:00'), 7)")
    options = {"url": url, "dbtable": "outbox", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver", "ranges": "5"}
    ranges = tb.id_ranges(spark, options, "id", 5)
    rows = tb.read_outbox(spark, jdbc=options)
    assert len(ranges) > 2 and rows.rdd.getNumPartitions() == len(ranges)
    got = sorted(int(r["id"]) for r in rows.collect())
    assert got == sorted(ids)
    assert rows.schema["payload"].dataType.simpleString() == "binary" and bytes(rows.first()["payload"]) == b"\x00\xff"
    sizes = rows.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) <= 25  # the gap leaves no range with most of them


def test_an_empty_database_table_is_read(spark, database):
    url, _ = database
    options = {"url": url, "dbtable": "outbox", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver", "ranges": "5"}
    assert tb.read_outbox(spark, jdbc=options).count() == 0
