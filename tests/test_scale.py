"""What must not grow with the number of log files, subjects' messages or finished steps."""

import os
import random

import pandas as pd
import pytest

from outflow.jobs import queries as q
from outflow.operators import routing as rt
from outflow.sources import tables as tb
from outflow.streaming import relay as rl
from tests.test_copies import Value
from tests.test_transactions import event, image, log


def test_an_index_has_few_folders_for_many_log_files(spark, tmp_path):
    events = [event("WRITE_ROWS", 4, rows=[image(k)], file=f"bin.{k:06d}") for k in range(1, 301)]
    log(spark, events).coalesce(1).write.parquet(f"{tmp_path}/log")
    assert tb.index_log(spark, f"{tmp_path}/log", f"{tmp_path}/index") == 1
    assert len([d for d in os.listdir(f"{tmp_path}/index") if "=" in d]) == 1
    assert tb.log_at(spark, f"{tmp_path}/index", [("s", "bin.000007", 1, 9), ("s", "bin.000300", 1, 9)]).count() == 300
    assert tb.log_at(spark, f"{tmp_path}/index", [("s", "bin.000007", 5, 9)]).count() == 0


def shuffle_files(spark):
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


def test_a_log_written_in_slices_leaves_no_shuffles(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, set_before = shuffle_files(spark), spark.conf.get(key, None)
    events = [event("WRITE_ROWS", 10 * k + 4, rows=[image(k)], source=f"s{k % 4}", seq=100 * k) for k in range(1, 400)]
    path = q._in_slices(spark, log(spark, events).repartition(4, "log_pos"))
    assert not {n for n in shuffle_files(spark) - before if n.endswith(".data")}
    assert spark.conf.get(key, None) == set_before
    assert spark.read.parquet(path).count() == 399


def test_messages_of_one_subject_are_not_dealt_to_one_task(spark, tmp_path, capsys):
    rows = spark.createDataFrame([(k, "a.b", 0) for k in range(50)], "id long, subject string, attempt_count long")
    rules = spark.createDataFrame([("S", "a.>")], "stream string, pattern string")
    rt.subject_routes(rows, rules).write.parquet(f"{tmp_path}/routes")
    routed = rt.route_subjects(rows, rules, spark.read.parquet(f"{tmp_path}/routes"))
    assert {r["stream"] for r in routed.collect()} == {"S"}
    routed.explain()
    assert "hashpartitioning(subject" not in capsys.readouterr().out
    assert rt.route_subjects(rows, rules).where("stream = 'S'").count() == 50


class List(Value):
    def exists(self):
        return self.held is not None

    def put(self, value):
        self.held = list(value)

    def appendList(self, value):  # noqa: N802
        self.held = [*(self.held or []), *value]


class Handle:
    def __init__(self):
        self.states = {}

    def getListState(self, name, *_):  # noqa: N802
        return self.states.setdefault(name, List())

    getValueState = getListState  # noqa: N815


def followed(events, max_rows, consumed):
    """(kind, position, commit, outcome, gno, n_rows) of what a reader of the events one by one tells; its error if it stops."""
    waiting, gno, out = [], None, []
    for pos, kind, number, n in events:
        if kind == rl.GTID:
            gno = number
            continue
        if kind in (rl.ROTATE, rl.PAYLOAD) and waiting:
            return "with"
        if kind != rl.ROTATE and gno in consumed:
            continue
        if kind in (rl.WRITE, rl.PAYLOAD) and n:
            waiting.append((pos, n))
        if kind in (rl.WRITE, rl.PAYLOAD) and sum(w[1] for w in waiting) > max_rows:
            return "more than"
        if kind == rl.ROTATE:
            out.append(("end", pos, 4, "rotated", gno, 0))
        elif kind in (rl.PAYLOAD, rl.COMMIT, rl.ROLLBACK):
            good = kind != rl.ROLLBACK
            out += [("rows", p, pos, "committed", gno, m) for p, m in waiting] if good else []
            out.append(("end", pos, pos, "committed" if good else "rolled_back", gno, sum(w[1] for w in waiting) if good else 0))
            waiting = []
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(40))
def test_assembly_in_any_cut_equals_reading_one_by_one(seed):
    rng = random.Random(seed)
    kinds = [rl.GTID, rl.WRITE, rl.WRITE, rl.COMMIT, rl.COMMIT, rl.ROLLBACK] + [rl.PAYLOAD, rl.ROTATE] * (seed % 4 == 0)
    events = [(4 + 3 * k, rng.choice(kinds), k, rng.randrange(1, 3)) for k in range(60)]
    events = [(p, k, g, n if k in (rl.WRITE, rl.PAYLOAD) else 0) for p, k, g, n in events]
    consumed = set(range(20, 30)) if seed % 2 else set()
    most = 8 if seed % 3 else 1000
    given = {"s": {"u": ([20], [29])}} if consumed else {}
    cuts = sorted(rng.sample(range(1, 60), 3)) + [60]
    handle, got = Handle(), []
    judge = rl._Assembly(most, 1 << 30, False, given)
    judge.init(handle)
    try:
        for a, z in zip([0, *cuts], cuts, strict=False):
            part = events[a:z]
            rng.shuffle(part)
            frame = pd.DataFrame(
                [(p, p, k, None if k != rl.ROTATE else "f2", "u" if k == rl.GTID else None, n, n, 4, g if k == rl.GTID else 0, p) for p, k, g, n in part],
                columns=["log_pos", "event_seq", "kind", "next_file", "gtid_uuid", "n_rows", "n_bytes", "next_pos", "gno", "at"],
            )
            for f in judge.handleInputRows(("s", "f1"), iter([frame]), None):
                got += [(r.kind, r.log_pos, r.commit_pos, r.outcome, None if r.gno is pd.NA else int(r.gno), r.n_rows) for r in f.itertuples()]
            # A rotate ends what the file's state knows of GTIDs, and no event of it follows.
            if any(e[1] == rl.ROTATE for e in part):
                events = events[:z]
                break
        got = sorted(got, key=str)
    except ValueError as e:
        got = "with" if "with" in str(e) else "more than"
    want = followed(events, most, consumed)
    assert got == want if isinstance(want, str) else [tuple(map(str, r)) for r in got] == [tuple(map(str, r)) for r in want]
