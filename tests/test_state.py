import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from outflow.operators import checkpoints as cp
from outflow.operators import gtid as gt
from outflow.operators import metrics as mt
from outflow.operators import routing as rt
from outflow.operators.hops import NEVER, folded, hops

from outflow.schemas import CHANGE_LOG
from tests.test_transactions import event

T0 = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("seed", range(2))
def test_dedupe_equals_a_loop(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice("abcd"), T0 + dt.timedelta(seconds=rng.randrange(400))) for i in range(200)]
    want, last = set(), {}
    for i, k, t in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        if k not in last or (t - last[k]).total_seconds() >= 10:
            want.add(i)
            last[k] = t
    df = spark.createDataFrame(rows, "id long, k string, t timestamp")
    assert {r["id"] for r in rt.dedupe_window(df, "k", "t", "id", 10).collect()} == want


@pytest.mark.parametrize("seed", range(3))
def test_hops_across_stretches_equal_a_loop(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("ab"), i, rng.randrange(900), rng.random() < 0.05 * seed, rng.choice([None, -40]) and -40) for i in range(400)]
    rows += [("hot", 1000 + i, t, False, NEVER) for i, t in enumerate(range(0, 2000, 3))]
    rows = [(k, i, t, f, -40 if k == "a" else None if k == "b" else s) for k, i, t, f, s in rows]
    want = set()
    for line in ("a", "b", "hot"):
        mine = sorted((t, i, f, s) for k, i, t, f, s in rows if k == line)
        last = mine[0][0] if mine[0][3] is None else mine[0][3]
        for t, i, f, _ in mine:
            if f or t - last >= 10:
                want.add((line, i))
                last = t
    df = spark.createDataFrame(rows, "_line string, _row long, _at long, _forced boolean, _start long")
    for rows in (7, 100, 500):  # all lines are long, some are, only one is
        assert {tuple(r) for r in hops(df, 10, rows).collect()} == want
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, 7)
    try:
        assert {tuple(r) for r in folded(df, 10).collect()} == want
    finally:
        spark.conf.set(key, old)


@pytest.mark.parametrize("step", [5, 4000, 100_000])
def test_a_crowded_line_spreads_over_stretches(spark, step):
    # 20,000 rows of one key, many to an instant, far more than a stretch to a step.
    rng = random.Random(step)
    rows = [(None, i, rng.randrange(9000), False, NEVER) for i in range(20_000)]
    want, last = set(), NEVER
    for _, i, t, _, _ in sorted(rows, key=lambda r: (r[2], r[1])):
        if t - last >= step:
            want.add(i)
            last = t
    df = spark.createDataFrame(rows, "_line string, _row long, _at long, _forced boolean, _start long")
    assert {r["_row"] for r in hops(df, step, 1500).collect()} == want


def test_routes_equal_pairing_all(spark):
    patterns = [("S1", "a.>"), ("S2", "a.b.*"), ("S3", "*.b.>"), ("S4", ">"), ("S5", "*.*"), ("S6", r"x\E.y"), ("S7", "*.*.c"), ("S8", "a.b.c.d"), ("S9", "*.>"), ("S0", "*.*.*.*.>")]
    subjects = ["a", "a.b", "a.b.c", "x.b.c", r"x\E.y", "q", "q.r", "q.r.c", "a.b.c.d", "1.2.3.4.5", "", "a..b", None]
    for n in range(len(patterns)):
        rules = patterns[n:]
        got = rt.route_subjects(spark.createDataFrame([(x,) for x in subjects], "subject string"), spark.createDataFrame(rules, "stream string, pattern string"))
        for r in got.collect():
            fits = [s for s, p in rules if r["subject"] is not None and re.match(rt.pattern_regex(p).replace(r"\z", r"\Z"), r["subject"])]
            assert r["stream"] == min(fits, default=None), (r, rules)


@pytest.mark.parametrize("seed", range(2))
def test_timeline_equals_a_loop(spark, seed):
    rng = random.Random(seed)
    rows = [(c, T0 + dt.timedelta(seconds=s), i, rng.random() < 0.1) for i, (c, s) in enumerate((rng.choice("xy"), s) for s in rng.sample(range(5000), 300))]
    want = set()
    for c in "xy":
        mine = sorted((t, i, h) for k, t, i, h in rows if k == c)
        last = mine[0][0]
        for t, i, h in mine:
            if h or (t - last).total_seconds() >= 60:
                want.add(i)
                last = t
    df = spark.createDataFrame(rows, "consumer string, ts timestamp, row long, has_rows boolean")
    assert {r["row"] for r in cp.checkpoint_timeline(df, 60).collect()} == want


def test_a_long_run_is_read_in_batches(spark, capsys):
    rows = [(i, "a", T0 + dt.timedelta(seconds=3 * i), False) for i in range(300)]
    df = spark.createDataFrame(rows, "row long, consumer string, ts timestamp, has_rows boolean")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, 7)
    try:
        kept, line = rt.dedupe_window(df, "consumer", "ts", "row", 10), cp.checkpoint_timeline(df, 60)
        assert {r["row"] for r in kept.collect()} == set(range(0, 300, 4))
        assert {r["row"] for r in line.collect()} == set(range(20, 300, 20))
    finally:
        spark.conf.set(key, old)
    kept.explain()
    line.explain()
    assert "FlatMapGroupsInPandas" not in capsys.readouterr().out


def test_gtid_sets(spark):
    text = spark.createDataFrame([(1, "B:5, a:1-3:4-7:9,a:8"), (2, ""), (3, None), (4, "a:3")], "k long, g string")
    spans = text.select("k", F.explode(gt.parse_gtid_set(F.col("g"))).alias("s")).select("k", "s.*")
    assert {tuple(r) for r in gt.format_gtid_set(spans, ("k",)).collect()} == {(1, "a:1-9,b:5"), (4, "a:3")}
    rng = random.Random(3)
    ids = [(rng.choice("uv"), n := rng.randrange(300), n + rng.randrange(3)) for _ in range(200)]
    got = {(r["uuid"], k) for r in gt.gtid_union(spark.createDataFrame(ids, "uuid string, start long, end long"), stretch=17).collect() for k in range(r["start"], r["end"] + 1)}
    assert got == {(u, k) for u, a, z in ids for k in range(a, z + 1)}
    one = lambda *x: spark.createDataFrame(list(x), "uuid string, start long, end long")
    contained = lambda a, b: gt.gtid_contains(a, b).first()["contained"]
    assert contained(one(("a", 1, 3), ("a", 4, 9)), one(("a", 2, 8))) and not contained(one(("a", 1, 3), ("a", 5, 9)), one(("a", 2, 8))) and not contained(one(("a", 1, 9)), one(("b", 1, 1)))


def test_recovery_branches(spark):
    names = "consumer_name string, source_id string, binlog_name string, binlog_position long, gtid_set string"
    saved = [("gone", "on", "f", 4, "a:1-5"), ("ahead", "on", "f", 4, "a:1-50"), ("fine", "on", "f", 4, "a:2-9"), ("move", "on", "f", 4, None), ("off", "off", "f", 4, "a:1"), ("file", "off", "f", 100, ""), ("past", "off", "f", 101, None), ("early", "off", "f", 3, None), ("lost", "off", "g", 4, None)]
    consumers = spark.createDataFrame([(s[0],) for s in saved] + [("new",)], "consumer_name string")
    files = spark.createDataFrame([("on", "f", 100), ("off", "f", 100)], "source_id string, name string, size long")
    state = spark.createDataFrame([("on", True, "a:1-20", "a:6-7"), ("off", False, "", "")], "source_id string, gtid_on boolean, gtid_executed string, gtid_purged string")
    got = {r["consumer_name"]: r["plan"] for r in cp.plan_recovery(consumers, spark.createDataFrame(saved, names), files, state).collect()}
    assert got == {"gone": "snapshot", "ahead": "error", "fine": "stream_gtid", "move": "snapshot", "off": "error", "file": "stream_file", "past": "snapshot", "early": "snapshot", "lost": "snapshot", "new": "snapshot"}


def test_last_checkpoint_write_wins(spark):
    state = spark.createDataFrame([("a", "f9", 900, "x:1", T0), ("b", "f1", 4, None, T0)], "consumer_name string, binlog_name string, binlog_position long, gtid_set string, updated_at timestamp")
    writes = spark.createDataFrame([("a", "f1", 10, "", 1), ("a", "f1", 8, "", 2), ("c", "f1", 5000000000, "y:1", 1)], "consumer_name string, binlog_name string, binlog_position long, gtid_set string, write_seq long")
    done = cp.upsert_checkpoints(state, writes, F.lit("2024-02-01 00:00:00").cast("timestamp"))
    assert {(r["consumer_name"], r["binlog_position"], r["gtid_set"]) for r in done.collect()} == {("a", 8, None), ("b", 4, None), ("c", 5000000000, "y:1")}
    assert cp.load_checkpoint(done, "c").first()["error"] and cp.load_checkpoint(done, "a").first()["error"] is None and cp.load_checkpoint(done, "z").count() == 0


def test_gauge_never_goes_below_zero(spark):
    rng = random.Random(1)
    rows = [("c", i, T0 + dt.timedelta(seconds=i), *rng.choice([(True, True, False), (True, False, False), (False, False, True), (False, True, False)])) for i in range(200)]
    level, want = 2, []
    for *_, ok, retry, first in rows:
        level = level + 1 if first else max(0, level - 1) if ok and retry else level
        want.append(level)
    df = spark.createDataFrame(rows, "consumer string, id long, ts timestamp, ok boolean, was_retry boolean, first_failure boolean")
    initial = spark.createDataFrame([("c", 2)], "consumer string, n_failed long")
    for stretch in (7, 3600):
        got = mt.failed_rows_gauge(df, initial, stretch)
        assert [r["gauge"] for r in got.orderBy("id").collect()] == want


def test_metrics_hold_the_gauge_and_all_errors(spark):
    attempts = spark.createDataFrame([("c", 1, T0, True, False), ("c", 2, T0, False, False), ("c", 3, T0, True, False), ("c", 4, T0, False, True), ("d", 5, T0, True, True)], "consumer string, id long, ts timestamp, ok boolean, was_retry boolean")
    saved = spark.createDataFrame([("c", T0)], "consumer_name string, updated_at timestamp")
    failed = spark.createDataFrame([("c", 1)], "consumer string, n_failed long")
    got = {(r["consumer"], r["name"]): r["value"] for r in mt.metrics_long(mt.delivery_counters(attempts, saved), failed, spark.createDataFrame([("c", 3)], "consumer string, n_errors long")).collect()}
    assert (got["c", "published_total"], got["c", "publish_errors_total"], got["c", "errors_total"], got["c", "failed_rows"]) == (2, 2, 5, 1)
    assert (got["d", "retry_successes_total"], got["d", "errors_total"], got["d", "failed_rows"], got["d", "last_checkpoint_seconds"]) == (1, 0, 0, 0)


def test_gtids_carry_over_files_but_not_in_file_mode(spark):
    mark = lambda pos, gno, file, source: event("GTID", pos, file, gtid_uuid=source, gno=gno, source=source)
    events = [e for s in ("s", "t") for e in (mark(4, 8, "f9", s), event("XID", 8, "f9", source=s), event("XID", 12, "f9", source=s), event("XID", 4, "f10", source=s), mark(6, 9, "f10", s), event("XID", 8, "f10", source=s), event("XID", 4, "f11", source=s))]
    df = spark.createDataFrame(events, CHANGE_LOG)
    saved = spark.createDataFrame([("s", "s:1-7"), ("t", None)], "source_id string, gtid_set string")
    got = {(r["source_id"], r["log_file"], r["log_pos"]): r["gno"] for r in cp.attach_gtid(df, saved).collect()}
    assert got == {("s", "f9", 8): 8, ("s", "f9", 12): 8, ("s", "f10", 4): 8, ("s", "f10", 8): 9, ("s", "f11", 4): 9} | {("t", f, p): None for f, p in (("f9", 8), ("f9", 12), ("f10", 4), ("f10", 8), ("f11", 4))}
    start = spark.createDataFrame([("s", 1, 7)], "uuid string, start long, end long")
    assert [tuple(r) for r in gt.format_gtid_set(cp.gtid_as_of(cp.attach_gtid(df, saved), start)).collect()] == [("s:1-9",)]


@pytest.mark.parametrize("seed", range(3))
def test_sets_as_of_many_points_equal_a_loop(spark, seed):
    rng = random.Random(seed)
    seen = [(rng.choice("ab"), rng.randrange(300), rng.choice("uv"), rng.randrange(60)) for _ in range(150)]
    points = [(k, r) for k in "ab" for r in rng.sample(range(320), 12)]
    begun = [("a", "u", 5, 9), ("a", "u", 20, 22), ("b", "w", 1, 3)]
    want = set()
    for k, row in points:
        have = {(u, n) for j, line, u, n in seen if j == k and line <= row} | {(u, n) for j, u, x, y in begun if j == k for n in range(x, y + 1)}
        want |= {(k, row, u, n) for u, n in have}
    schema = "k string, line long, uuid string, gno long"
    got = gt.gtid_sets_at(spark.createDataFrame(seen, schema), spark.createDataFrame(points, "k string, row long"), spark.createDataFrame(begun, "k string, uuid string, start long, end long"), ("k",), stride=37).collect()
    assert {(r["k"], r["row"], r["uuid"], n) for r in got for n in range(r["start"], r["end"] + 1)} == want
    # As few intervals as can be: no two of a set touch.
    spans = {}
    for r in got:
        spans.setdefault((r["k"], r["row"], r["uuid"]), []).append((r["start"], r["end"]))
    for each in spans.values():
        each.sort()
        assert all(b[0] > a[1] + 1 for a, b in zip(each, each[1:]))
