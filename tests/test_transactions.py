import random

import pytest

from outflow.operators import decode as dc
from outflow.operators import transactions as tr
from outflow.schemas import CHANGE_LOG

DB, TABLE = "app", "outbox"


def event(kind, pos, file="f1", seq=None, rows=None, table=TABLE, source="s", **more):
    row = dict.fromkeys(CHANGE_LOG.names)
    row |= {"source_id": source, "log_file": file, "log_pos": pos, "event_seq": pos if seq is None else seq, "event_type": kind, "rows": rows}
    if rows is not None:
        row |= {"schema_name": DB, "table_name": table}
    return tuple((row | more).values())


def image(i, subject=b"a.b", payload=b"p", headers=None, message_id=None, ttl=None):
    return [str(i).encode() if isinstance(i, int) else i, subject, payload, headers, message_id, ttl]


def log(spark, events):
    return spark.createDataFrame(events, CHANGE_LOG)


def sequential(events):
    """What a reader of the log one event after the other publishes."""
    out, waiting = [], []
    for e in sorted(events, key=lambda e: (e[0], e[1], e[2], e[3])):
        e = dict(zip(CHANGE_LOG.names, e))
        if waiting and (waiting[0][0], waiting[0][1]) != (e["source_id"], e["log_file"]):
            waiting = []
        if e["event_type"] == "WRITE_ROWS":
            waiting += [(e["source_id"], e["log_file"], int(r[0])) for r in e["rows"]]
        elif e["event_type"] == "XID" or (e["query"] or "").strip().upper() == "COMMIT":
            out += [(*w, e["log_pos"]) for w in waiting]
            waiting = []
        elif (e["query"] or "").strip().upper() == "ROLLBACK":
            waiting = []
    return out


@pytest.mark.parametrize("seed", range(3))
def test_assembly_equals_a_sequential_reader(spark, seed):
    rng, events, n = random.Random(seed), [], 0
    for source in "ab":
        for file in ("f1", "f2"):
            for pos in range(4, 300, 4):
                kind = rng.choice(["WRITE_ROWS", "WRITE_ROWS", "XID", "COMMIT", " rollback\n", "BEGIN", "ALTER TABLE x"])
                if kind == "WRITE_ROWS":
                    events.append(event(kind, pos, file, rows=[image(n := n + 1) for _ in range(rng.randrange(1, 4))], source=source))
                else:
                    events.append(event("XID", pos, file, source=source) if kind == "XID" else event("QUERY", pos, file, query=kind, source=source))
    for stride in (tr.STRIDE, 40, 7):  # a file in one stretch, in several, and an event a stretch
        rows = dc.decode_rows(dc.explode_rows(tr.committed_rows(log(spark, events), stride)))
        got = tr.commit_order(rows, stride).orderBy(*tr.COMMIT_ORDER).collect()
        assert [(r["source_id"], r["log_file"], int(r["id"]), r["commit_pos"]) for r in got] == sequential(events)
        assert [r["publish_no"] for r in got] == [k + 1 for f in sorted({(r["source_id"], r["log_file"]) for r in got}) for k in range(sum((r["source_id"], r["log_file"]) == f for r in got))]
    done = {r["id"] for r in got}
    assert all(int(r["row"][0]) not in done for r in dc.explode_rows(tr.open_rows(log(spark, events))).collect())


def test_outcomes_limits_and_anomalies(spark):
    wide = image(1, b"events.example", b"payload", b"headers", b"message-id", b"3")
    events = [
        event("WRITE_ROWS", 4, rows=[wide, wide]), event("XID", 8),
        event("WRITE_ROWS", 12, rows=[image(2)]), event("QUERY", 16, query="ROLLBACK"),
        event("QUERY", 20, query=" commit "), event("WRITE_ROWS", 24, rows=[image(3)], table="other"), event("WRITE_ROWS", 28, rows=[image(4)]),
        event("ROTATE", 32, next_file="f2"), event("WRITE_ROWS", 0, "f3", seq=1, rows=[image(5)]), event("XID", 0, "f3", seq=2),
        event("WRITE_ROWS", 4, "f4", rows=[image(6)]), event("PAYLOAD", 8, "f4", nested=[("WRITE_ROWS", DB, TABLE, [image(7)]), ("WRITE_ROWS", DB, "x", [image(8)])]),
    ]
    df = log(spark, events)
    got = {(r["log_file"], r["tx"]): (r["outcome"], r["n_rows"], r["n_bytes"], r["end_pos"]) for r in tr.transaction_outcomes(df, DB, TABLE).collect()}
    assert got == {("f1", 0): ("committed", 2, 84, 8), ("f1", 1): ("rolled_back", 1, 4, 16), ("f1", 2): ("committed", 0, 0, 20), ("f1", 3): ("open", 1, 4, None), ("f3", 0): ("committed", 1, 4, 0), ("f4", 0): ("committed", 2, 8, 8)}
    limits = lambda r, b: {(x["log_file"], x["tx"], x["reason"]) for x in tr.check_transaction_limits(df, DB, TABLE, r, b).collect()}
    assert limits(2, 84) == set() and limits(1, 84) == {("f1", 0, "rows"), ("f4", 0, "rows")} and limits(2, 83) == {("f1", 0, "bytes")}
    assert {(r["log_file"], r["reason"]) for r in tr.log_anomalies(df, DB, TABLE).collect()} == {("f1", "rotate with open rows"), ("f3", "commit at position 0"), ("f4", "payload with open rows")}
    assert [int(r["row"][0]) for r in dc.explode_payload(df, DB, TABLE).collect()] == [7]


@pytest.mark.parametrize(
    "row,error",
    [
        (image(7, ttl=b"30"), None), (image(18446744073709551615), None), (image(18446744073709551616), "id is out of range"), (image(0), "id is zero"), (image(b"-1"), "id is not an unsigned number"),
        (image(b"12\n"), "id is not an unsigned number"), (image(b" 1"), "id is not an unsigned number"), (image(b"1e3"), "id is not an unsigned number"), (image(1, ttl=b"4294967295"), None), (image(1, ttl=b"4294967296"), "ttl is out of range"),
        (image(1, ttl=b"9" * 60), "ttl is out of range"), (image(b"9" * 60), "id is out of range"), (image(1, subject=None), "subject is null"), (image(1, payload=None), "payload is null"), (image(None), "id is null"), (image(1)[:5], "row has too few values"), (image(b"007"), None),
        (image(b"\xff\xfe"), "id is not an unsigned number"), (image(1, subject=b"\xff\xfe"), "subject is not UTF-8"), (image(1, headers=b"\xff"), "headers are not UTF-8"), (image(1, message_id=b"\xc3"), "message id is not UTF-8"), (image(1, payload=b"\xff\xfe"), None), (image(1, ttl=b"\xff"), "ttl is not an unsigned number"),
    ],
)
def test_decoding(spark, row, error):
    got = dc.decode_rows(spark.createDataFrame([(row,)], "row array<binary>")).first()
    assert got["decode_error"] == error and (error is not None or int(got["id"]) == int(row[0]))


def test_rotated_files_leave_nothing_open(spark):
    events = [event("WRITE_ROWS", 4, rows=[image(1)]), event("XID", 8), event("ROTATE", 12, next_file="f2"), event("WRITE_ROWS", 4, "f2", rows=[image(2)]), event("ROTATE", 8, "f2", next_file="f3"), event("QUERY", 4, "f3", query="BEGIN"), event("WRITE_ROWS", 8, "f3", rows=[image(3)])]
    df = log(spark, events)
    assert {(r["log_file"], r["tx"], r["outcome"], r["n_rows"]) for r in tr.transaction_outcomes(df, DB, TABLE).collect()} == {("f1", 0, "committed", 1), ("f2", 0, "open", 1), ("f3", 0, "open", 1)}
    assert [int(r["row"][0]) for r in dc.explode_rows(tr.open_rows(df)).collect()] == [3]
    assert [(r["log_file"], r["reason"]) for r in tr.log_anomalies(df, DB, TABLE).collect()] == [("f2", "rotate with open rows")]


def test_quarantine(spark):
    rows = dc.decode_rows(spark.createDataFrame([(image(1),), (image(0),)], "row array<binary>"))
    good, bad = dc.quarantine(rows, mode="split")
    assert (good.count(), bad.count()) == (1, 1)
    with pytest.raises(Exception, match="id is zero"):
        dc.quarantine(rows).collect()


def test_names_carry_across_stretches(spark):
    events = [event("ROTATE", 1, None, seq=1, next_file="f1"), *[event("XID", k, None, seq=k) for k in (2, 3, 60)], event("ROTATE", 1, None, seq=61, next_file="f2"), *[event("XID", k, None, seq=k) for k in (62, 99, 300)], event("XID", 1, None, seq=5, source="z")]
    got = {(r["source_id"], r["event_seq"]): r["log_file"] for r in tr.carry_log_file(log(spark, events), stride=10).collect() if r["event_type"] == "XID"}
    assert got == {("s", 2): "f1", ("s", 3): "f1", ("s", 60): "f1", ("s", 62): "f2", ("s", 99): "f2", ("s", 300): "f2", ("z", 5): None}
