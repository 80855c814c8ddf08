"""The relay over several micro-batches: assembly, limits, state, restart."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from outflow.functions.validate import source_prefix
from outflow.operators import routing as rt
from outflow.sources import tables as tb
from outflow.streaming import relay as rl
from tests.test_transactions import DB, TABLE, event, image, log


@pytest.fixture
def rocksdb(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, rl.ROCKSDB)
    yield
    spark.conf.set(key, old)


T0 = dt.datetime(2024, 1, 1)


def feed(spark, path, *slices):
    for events in slices:
        log(spark, events).coalesce(1).write.mode("append").parquet(path)
    return path


def drained(spark, stream, path):
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}-progress").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def committed(spark, tmp_path, slices, **limits):
    path, out = feed(spark, f"{tmp_path}/log", *slices), f"{tmp_path}/out"
    rl.stream_committed_rows(tb.stream_change_log(spark, path, 1), tb.indexed_log(path, f"{tmp_path}/index"), DB, TABLE, out, f"{out}-progress", **limits).awaitTermination()
    rows = spark.read.parquet(out)
    return [(int(r["row"][0]), r["commit_pos"]) for r in rows.orderBy("commit_pos", "log_pos", "row_idx").collect()]


SLICES = [
    [event("GTID", 2, gtid_uuid="s", gno=1), event("WRITE_ROWS", 4, rows=[image(1), image(2, b"other.x")]), event("WRITE_ROWS", 6, rows=[image(9)], table="x")],
    [event("QUERY", 8, query="commit"), event("GTID", 9, gtid_uuid="s", gno=2), event("WRITE_ROWS", 10, rows=[image(3)]), event("QUERY", 12, query="ROLLBACK"), event("GTID", 13, gtid_uuid="s", gno=3), event("WRITE_ROWS", 14, rows=[image(4)])],
    [event("XID", 16), event("GTID", 18, gtid_uuid="s", gno=4), event("PAYLOAD", 20, nested=[("WRITE_ROWS", DB, TABLE, [image(5)]), ("WRITE_ROWS", DB, "x", [image(8)])]), event("WRITE_ROWS", 22, rows=[image(6)])],
]


def test_rows_meet_their_commit_batches_later(spark, rocksdb, tmp_path):
    assert committed(spark, tmp_path, SLICES) == [(1, 8), (2, 8), (4, 16), (5, 20)]


@pytest.mark.parametrize(
    "last,limits,error",
    [
        (event("ROTATE", 9, next_file="f2", next_pos=4), {}, "rotates at 9 with an open transaction"),
        (event("PAYLOAD", 9, nested=[("WRITE_ROWS", DB, TABLE, [image(7)])]), {}, "begins at 9 with rows waiting"),
        (event("WRITE_ROWS", 9, rows=[image(3)]), {"max_rows": 2}, "more than 2 rows"),
        (event("WRITE_ROWS", 9, rows=[image(3)]), {"max_bytes": 15}, "more than 15 bytes"),
    ],
)
def test_what_a_sequential_reader_stops_at(spark, rocksdb, tmp_path, last, limits, error):
    first = [event("WRITE_ROWS", 4, rows=[image(1, b"a.b", b"1234"), image(2, b"a.b", b"12")])]
    with pytest.raises(Exception, match=error):
        committed(spark, tmp_path, [first, [last]], **limits)


def test_limits_may_be_reached(spark, rocksdb, tmp_path):
    slices = [[event("WRITE_ROWS", 4, rows=[image(1, b"a.b", b"1234")])], [event("WRITE_ROWS", 9, rows=[image(2, b"a.b", b"12")]), event("XID", 11)]]
    assert committed(spark, tmp_path, slices, max_rows=2, max_bytes=12) == [(1, 11), (2, 11)]


def test_open_rows_expire_with_a_count(spark, rocksdb, tmp_path):
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    slices = [[event("WRITE_ROWS", 4, rows=[image(1), image(2)], event_ts=at(0))], [event("XID", 4, "f2", event_ts=at(600))], [event("XID", 8, "f2", event_ts=at(601))]]
    stream = rl.stream_transactions(tb.stream_change_log(spark, feed(spark, f"{tmp_path}/log", *slices), 1), DB, TABLE, watermark="1 hour")
    rows = drained(spark, stream, f"{tmp_path}/out").where("kind = 'expired'").collect()
    assert [(r["log_file"], r["log_pos"], r["n_rows"]) for r in rows] == [("f1", 4, 2)]


def relayed(spark, base, path, compact_every=2, prefix="relay", **more):
    rules = spark.createDataFrame([("A", "a.>")], "stream string, pattern string")
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    query = rl.relay_stream(tb.stream_change_log(spark, path, 1), base, tb.indexed_log(path, f"{base}-index"), (prefix, DB, TABLE), rules, "main", now, f"{base}-progress", compact_every=compact_every, **more)
    query.awaitTermination()


def state(spark, base):
    outbox, points = tb.read_state(spark, base)
    return (
        sorted((r["key"], r["commit_pos"]) for r in tb.read_messages(spark, base).collect()),
        sorted((r["source_id"], int(r["id"]), r["attempt_count"], r["last_error"]) for r in outbox.collect()),
        sorted((r["consumer_name"], r["binlog_name"], r["binlog_position"], r["gtid_set"]) for r in points.collect()),
    )


NO_STREAM = "outbox row {}: no stream covers the subject"


def test_relay_stops_between_write_and_pointer(spark, rocksdb, tmp_path, monkeypatch):
    base, path = f"{tmp_path}/state", feed(spark, f"{tmp_path}/log", *SLICES)
    saved = spark.createDataFrame([("main/s", "f1", 2, "s:9")], "consumer_name string, binlog_name string, binlog_position long, gtid_set string").withColumn("updated_at", F.lit("1970-01-01").cast("timestamp"))
    tb.write_state(spark.createDataFrame([], rl.schemas.STATE), saved, base, "start")
    swap, calls = tb.swap_pointer, []

    def failing(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("stopped before the pointer")
        swap(*args)

    monkeypatch.setattr(tb, "swap_pointer", failing)
    with pytest.raises(Exception, match="stopped before the pointer"):
        relayed(spark, base, path)
    assert tb.current_version(spark, base) == "batch-main-000000000000"
    assert tb.read_messages(spark, base).count() == 0  # none of a batch that isn't named
    relayed(spark, base, path)
    want = [("relay:app:outbox:1", 8), ("relay:app:outbox:4", 16), ("relay:app:outbox:5", 20)], [("s", 2, 1, NO_STREAM.format(2))]
    assert state(spark, base) == (*want, [("main/s", "f1", 20, "s:1-4:9")])
    # The pointer's own versions stay, older ones are gone.
    assert len(tb.read_pointer(spark, base)["deltas"]) < 2


def test_relay_begins_on_an_empty_base_without_gtids(spark, rocksdb, tmp_path):
    base, path = f"{tmp_path}/state", feed(spark, f"{tmp_path}/log", *SLICES)
    relayed(spark, base, path, compact_every=99)
    assert state(spark, base)[1:] == ([("s", 2, 1, NO_STREAM.format(2))], [("main/s", "f1", 20, None)])
    before = state(spark, base)
    tb.compact(spark, base)
    tb.compact(spark, base)
    tb.prune(spark, base)
    assert state(spark, base) == before
    assert tb.sweep(spark, base, 3600) == []


def test_of_an_ids_changes_the_last_counts(spark, tmp_path):
    base = f"{tmp_path}/state"
    rows = lambda *ids: spark.createDataFrame([(s, i, n, False) for s, i, n in ids], "source_id string, id long, n long, gone boolean")
    gone = lambda *ids: spark.createDataFrame([(s, i, 0, True) for s, i in ids], "source_id string, id long, n long, gone boolean")
    points = spark.createDataFrame([("c",)], "consumer_name string")
    tb.write_state(rows(("a", 1, 0), ("a", 2, 0), ("a", 3, 0), ("b", 1, 7)).drop("gone"), points, base, "a")
    tb.write_delta(rows(("a", 2, 1), ("a", 4, 1)).unionByName(gone(("a", 1))), points, base, "b")
    tb.write_delta(rows(("a", 1, 5)).unionByName(gone(("a", 4))), points, base, "c", "kind")
    want = {("a", 1, 5), ("a", 2, 1), ("a", 3, 0), ("b", 1, 7)}
    assert {tuple(r) for r in tb.read_state(spark, base)[0].collect()} == want
    tb.compact(spark, base)
    assert {tuple(r) for r in tb.read_state(spark, base)[0].collect()} == want
    assert tb.is_done(spark, base, "kind", "c") and not tb.is_done(spark, base, "kind", "d") and not tb.is_done(spark, base, "other", "a")


def insert(source, pos, *rows):
    return event("WRITE_ROWS", pos, source=source, rows=list(rows))


def commit(source, pos):
    return event("XID", pos, source=source)


BAD = b"other.x"


@pytest.mark.parametrize(
    "slices",
    [
        [[insert("s1", 4, image(5)), commit("s1", 6), insert("s2", 4, image(5, BAD)), commit("s2", 6)]],
        [[insert("s2", 4, image(5, BAD)), commit("s2", 6)], [insert("s1", 4, image(5)), commit("s1", 6)]],
        [[insert("s1", 4, image(5)), insert("s2", 4, image(5, BAD))], [commit("s2", 6)], [commit("s1", 6)]],
    ],
)
def test_equal_ids_of_two_sources_stay_apart(spark, rocksdb, tmp_path, slices):
    base, path = f"{tmp_path}/state", feed(spark, f"{tmp_path}/log", *slices)
    relayed(spark, base, path, prefix=source_prefix("relay"))
    messages, rows, points = state(spark, base)
    assert messages == [("relay/s1:app:outbox:5", 6)] and rows == [("s2", 5, 1, NO_STREAM.format(5))]
    assert points == [("main/s1", "f1", 6, None), ("main/s2", "f1", 6, None)]


def test_two_failing_rows_of_one_id_are_two_rows(spark, rocksdb, tmp_path):
    slices = [[insert(s, 4, image(5, BAD)), commit(s, 6)] for s in ("s1", "s2")]
    base, path = f"{tmp_path}/state", feed(spark, f"{tmp_path}/log", *slices)
    relayed(spark, base, path, prefix=source_prefix("relay"))
    assert state(spark, base)[1] == [("s1", 5, 1, NO_STREAM.format(5)), ("s2", 5, 1, NO_STREAM.format(5))]


@pytest.mark.parametrize("slices", [[[insert("s1", 4, image(5)), commit("s1", 6), insert("s2", 4, image(5)), commit("s2", 6)]], [[insert(s, 4, image(5)), commit(s, 6)] for s in ("s1", "s2")]])
def test_one_prefix_for_two_sources_is_refused(spark, rocksdb, tmp_path, slices):
    base, path = f"{tmp_path}/state", feed(spark, f"{tmp_path}/log", *slices)
    with pytest.raises(Exception, match="need a prefix for each source"):
        relayed(spark, base, path)


def test_a_rows_outcomes_count_in_commit_order(spark, rocksdb, tmp_path):
    one = [insert("s", 4, image(1, BAD)), commit("s", 6), insert("s", 8, image(1)), commit("s", 10), insert("s", 12, image(2)), commit("s", 14), insert("s", 16, image(2, BAD)), commit("s", 18), insert("s", 20, image(2, BAD)), commit("s", 22)]
    two = [insert("s", 24, image(2, BAD)), commit("s", 26), insert("s", 28, image(1, BAD)), commit("s", 30)]
    base, path = f"{tmp_path}/state", feed(spark, f"{tmp_path}/log", one, two)
    relayed(spark, base, path)
    assert state(spark, base)[1] == [("s", 1, 1, NO_STREAM.format(1)), ("s", 2, 3, NO_STREAM.format(2))]


def test_a_batch_reads_only_the_files_of_its_places(spark, rocksdb, tmp_path, monkeypatch):
    slices = [[insert("s", 100 * k + 4, image(k + 1)), commit("s", 100 * k + 6)] for k in range(6)]
    base, path = f"{tmp_path}/state", feed(spark, f"{tmp_path}/log", *slices)
    read, opened = tb.log_at, []

    def counted(*args):
        log = read(*args)
        opened.append(len(log.inputFiles()))
        return log

    monkeypatch.setattr(tb, "log_at", counted)
    relayed(spark, base, path)
    assert opened == [1] * 6
    assert tb.index_log(spark, path, f"{base}-index") == 0
    assert [k for k, _ in state(spark, base)[0]] == [f"relay:app:outbox:{k}" for k in range(1, 7)]


def test_files_of_one_name_in_two_folders_are_two(spark, tmp_path):
    index = f"{tmp_path}/index"
    for k, folder in enumerate(("a b", "c+d%")):
        log(spark, [insert("s", 100 * k + 4, image(k + 1)), commit("s", 100 * k + 6)]).coalesce(1).write.parquet(f"{tmp_path}/made{k}")
        made = next((tmp_path / f"made{k}").glob("*.parquet"))
        (tmp_path / "log" / folder).mkdir(parents=True)
        made.rename(tmp_path / "log" / folder / "x y.parquet")
    assert tb.index_log(spark, f"{tmp_path}/log", index) == 2 and tb.index_log(spark, f"{tmp_path}/log", index) == 0
    for k in (0, 1):
        found = tb.log_at(spark, index, [("s", "f1", 100 * k + 4, 100 * k + 5)])
        assert len(found.inputFiles()) == 1 and sorted(r["log_pos"] for r in found.collect()) == [100 * k + 4, 100 * k + 6]


def test_a_start_passes_over_what_is_consumed(spark, rocksdb, tmp_path):
    gtid = lambda pos, gno: event("GTID", pos, gtid_uuid="u", gno=gno, source="g")
    one = [e for k in range(4) for e in (gtid(10 * k + 4, k + 1), insert("g", 10 * k + 5, image(k + 1)), commit("g", 10 * k + 6))]
    two = [e for k in range(4) for e in (insert("f", 10 * k + 5, image(k + 1)), commit("f", 10 * k + 6))]
    start = spark.createDataFrame([("g", "f1", 4, "u:1:3"), ("f", "f1", 16, None)], "source_id string, binlog_name string, binlog_position long, gtid_set string")
    path = feed(spark, f"{tmp_path}/log", one, two, [insert("x", 4, image(9)), commit("x", 6)])
    places = drained(spark, rl.stream_transactions(tb.stream_change_log(spark, path, 1, start), DB, TABLE, start=start), f"{tmp_path}/out")
    assert sorted((r["source_id"], r["commit_pos"]) for r in places.where("kind = 'rows'").collect()) == [("f", 26), ("f", 36), ("g", 16), ("g", 36)]


def copies(spark, path, *slices):
    for rows in slices:
        spark.createDataFrame([(i, k, T0 + dt.timedelta(seconds=s)) for i, (k, s) in rows], "row long, key string, ts timestamp").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema("row long, key string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("seed", range(2))
def test_copies_in_order_equal_the_batch_fold(spark, rocksdb, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(i, (rng.choice("ab"), t)) for i, t in enumerate(sorted(rng.sample(range(400), 60)))]
    stream = rl.stream_dedupe(copies(spark, f"{tmp_path}/in", *(rows[k : k + 20] for k in (0, 20, 40))), "key", "ts", "row", 10, "1 hour")
    got = {r["row"] for r in drained(spark, stream, f"{tmp_path}/out").collect()}
    df = spark.createDataFrame([(i, k, T0 + dt.timedelta(seconds=s)) for i, (k, s) in rows], "row long, key string, ts timestamp")
    assert got == {r["row"] for r in rt.dedupe_window(df, "key", "ts", "row", 10).collect()}


def test_a_late_copy_is_judged_by_both_sides(spark, rocksdb, tmp_path):
    # Accepted at 0 and 100; late: 50 is free on both sides, 95 and 5 are not, then 58 is held by 50.
    stream = rl.stream_dedupe(copies(spark, f"{tmp_path}/in", [(0, ("a", 0))], [(1, ("a", 100))], [(2, ("a", 50)), (3, ("a", 95)), (4, ("a", 5))], [(5, ("a", 58)), (6, ("b", 58))]), "key", "ts", "row", 10, "1 hour")
    assert {r["row"] for r in drained(spark, stream, f"{tmp_path}/out").collect()} == {0, 1, 2, 6}


@pytest.mark.parametrize("seed", range(2))
def test_settled_copies_in_any_order_equal_the_batch_fold(spark, rocksdb, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(i, (rng.choice("ab"), rng.randrange(400))) for i in range(80)]
    came = sorted(rows, key=lambda r: r[1][1] + rng.uniform(0, 150))
    end = [(99, ("a", 100_000))]
    stream = rl.stream_dedupe(copies(spark, f"{tmp_path}/in", *(came[k : k + 20] for k in range(0, 80, 20)), end), "key", "ts", "row", 10, "200 seconds", "settled")
    got = {r["row"] for r in drained(spark, stream, f"{tmp_path}/out").collect()}
    df = spark.createDataFrame([(i, k, T0 + dt.timedelta(seconds=s)) for i, (k, s) in rows], "row long, key string, ts timestamp")
    assert got == {r["row"] for r in rt.dedupe_window(df, "key", "ts", "row", 10).collect()}


def test_what_a_watermark_drops_is_counted(spark, rocksdb, tmp_path):
    counter = rl.DropCounter()
    spark.streams.addListener(counter)
    try:
        stream = rl.stream_dedupe(copies(spark, f"{tmp_path}/in", [(0, ("a", 0))], [(1, ("a", 9000))], [(2, ("b", 9001))], [(3, ("b", 5)), (4, ("c", 6)), (5, ("c", 9002))]), "key", "ts", "row", 10, "1 minute")
        assert {r["row"] for r in drained(spark, stream, f"{tmp_path}/out").collect()} == {0, 1, 2, 5}
        end = time.time() + 30
        while sum(counter.dropped.values()) < 2 and time.time() < end:
            time.sleep(0.2)
        assert sum(counter.dropped.values()) == 2
    finally:
        spark.streams.removeListener(counter)
