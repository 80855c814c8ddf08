"""The relay on streams: transaction assembly, and the whole loop."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from outflow import schemas
from outflow.operators.checkpoints import checkpoint_timeline, gtid_as_of, upsert_checkpoints
from outflow.operators.decode import decode_rows, explode_inserts, quarantine
from outflow.operators.delivery import cut_error
from outflow.operators.gtid import format_gtid_set, gtid_union, parse_gtid_set
from outflow.operators.passes import Names, manifest, one_source, publish
from outflow.operators.transactions import COMMIT_ORDER, FILE, MAX_BYTES, MAX_ROWS, ending, event_weight
from outflow.sources import tables as tb
from outflow.sources.tables import file_number
from outflow.streaming.copies import stream_dedupe  # noqa: F401

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PLACES = "source_id string, log_file string, kind string, log_pos long, event_seq long, commit_pos long, end_file string, outcome string, gtid_uuid string, gno long, n_rows long, n_bytes long, at long"

#: What an event means to the assembly; a payload brings rows and commits them.
GTID, WRITE, PAYLOAD, ROTATE, COMMIT, ROLLBACK = range(6)


class _Assembly(StatefulProcessor):
    """Places of the inserts of one (source, file) wait in state for the terminal that decides them."""

    def __init__(self, max_rows: int, max_bytes: int, timed: bool, consumed: dict | None = None):
        self.max_rows, self.max_bytes, self.timed, self.consumed = max_rows, max_bytes, timed, consumed or {}

    def known(self, source: str, uuids: np.ndarray, gnos: np.ndarray) -> np.ndarray:
        """Which of these transactions the source's set of consumed ones holds: looked up in sorted lists of intervals."""
        found = np.zeros(len(uuids), bool)
        for uuid, (starts, ends) in self.consumed.get(source, {}).items():
            mine = np.flatnonzero(uuids == uuid)
            at = np.searchsorted(starts, gnos[mine], "right") - 1
            found[mine] = (at >= 0) & (gnos[mine] <= np.asarray(ends)[at])
        return found

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "log_pos long, event_seq long, n_rows long, n_bytes long, at long")
        self.gtid = handle.getValueState("gtid", "uuid string, gno long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # The batch's events of a key may come in any order.
        new = pd.concat(list(rows), ignore_index=True)
        new = new.iloc[np.lexsort((new["event_seq"], new["log_pos"]))]
        kind, pos, seq, at, n_rows, n_bytes = (new[c].to_numpy() for c in ("kind", "log_pos", "event_seq", "at", "n_rows", "n_bytes"))
        waiting = list(self.waiting.get()) if self.waiting.exists() else []
        first_pair = tuple(self.gtid.get()) if self.gtid.exists() else (None, None)
        # Each event's GTID is the one before it.
        names = np.append(new["gtid_uuid"].to_numpy(object), first_pair[0])
        numbers = np.append(new["gno"].to_numpy(), first_pair[1] or 0)
        told = np.maximum.accumulate(np.where(kind == GTID, np.arange(len(kind)), -1))
        names, numbers = names[told], numbers[told]
        active = kind != GTID
        if self.consumed.get(key[0]):
            active &= (kind == ROTATE) | ~self.known(key[0], names, numbers)
        brings = active & np.isin(kind, (WRITE, PAYLOAD))
        ends = active & np.isin(kind, (PAYLOAD, COMMIT, ROLLBACK))
        tx = np.cumsum(ends) - ends  # terminals before

        def before(values: np.ndarray, held: int) -> np.ndarray:
            """What the transaction had before each event; the first one has what waited."""
            total = np.cumsum(values) - values + held
            begun = np.append(0, total[ends] + values[ends])
            return total - begun[tx]

        open_rows = before((brings & (n_rows > 0)).astype(np.int64), len(waiting))
        all_rows = before(np.where(brings, n_rows, 0), sum(w[2] for w in waiting)) + np.where(brings, n_rows, 0)
        all_bytes = before(np.where(brings, n_bytes, 0), sum(w[3] for w in waiting)) + np.where(brings, n_bytes, 0)
        wrong = (
            ((kind == ROTATE) & (open_rows > 0), "the log of {key} rotates at {pos} with an open transaction"),
            ((kind == PAYLOAD) & (open_rows > 0), "a self-contained transaction of {key} begins at {pos} with rows waiting"),
            (brings & (all_rows > self.max_rows), f"transaction of {{key}} has more than {self.max_rows} rows"),
            (brings & (all_bytes > self.max_bytes), f"transaction of {{key}} has more than {self.max_bytes} bytes"),
            (ends & (kind != ROLLBACK) & (pos == 0), "a commit of {key} is at position 0"),
        )
        stops = [(int(np.argmax(where)), n, text) for n, (where, text) in enumerate(wrong) if where.any()]
        if stops:
            at_event, _, text = min(stops)
            raise ValueError(text.format(key=key, pos=int(pos[at_event])))

        row = np.flatnonzero(brings & (n_rows > 0))
        each = np.array([w[:4] for w in waiting], np.int64).reshape(-1, 4)
        each = np.concatenate([each, np.stack([pos[row], seq[row], n_rows[row], n_bytes[row]], axis=1).astype(np.int64)])
        mine = np.append(np.zeros(len(waiting), np.int64), tx[row])
        end = np.flatnonzero(ends)
        good = np.append(kind[end] != ROLLBACK, False)[mine]  # the last one may still be open
        by = end[mine[good]]
        out = [_placed(key, "rows", each[good, 0], each[good, 1], pos[by], key[1], "committed", names[by], numbers[by], each[good, 2], each[good, 3], at[by])]
        committed = kind[end] != ROLLBACK
        told_end = np.where(committed, "committed", "rolled_back").astype(object)
        out.append(_placed(key, "end", pos[end], seq[end], pos[end], key[1], told_end, names[end], numbers[end], np.where(committed, all_rows[end], 0), np.where(committed, all_bytes[end], 0), at[end]))
        turn = np.flatnonzero(kind == ROTATE)
        zero = np.zeros(len(turn), np.int64)
        out.append(_placed(key, "end", pos[turn], seq[turn], new["next_pos"].to_numpy()[turn], new["next_file"].to_numpy(object)[turn], "rotated", names[turn], numbers[turn], zero, zero, at[turn]))

        fresh = [tuple(map(int, r)) for r in zip(*(c[row[tx[row] == len(end)]] for c in (pos, seq, n_rows, n_bytes, at)), strict=True)]
        if len(end) and (fresh or waiting):
            self.waiting.put(fresh) if fresh else self.waiting.clear()
        elif fresh:
            self.waiting.appendList(fresh)
        waiting = fresh if len(end) else waiting + fresh
        pair = (names[-1], int(numbers[-1])) if names[-1] is not None else (None, None)
        turned = len(turn) > 0
        # A file that is rotated away gets no more events: nothing of it stays.
        if turned:
            self.gtid.clear()
        elif pair != first_pair:
            self.gtid.update(pair)
        if self.timed:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            last = max((w[4] for w in waiting), default=None)
            if last is not None:
                self.handle.registerTimer(last // 1000 + 1)
        yield from (frame for frame in out if len(frame))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        waiting = list(self.waiting.get()) if self.waiting.exists() else []
        self.waiting.clear()
        if waiting:
            one = lambda n: np.array([n], np.int64)
            frame = _placed(key, "expired", one(waiting[0][0]), one(waiting[0][1]), one(0), key[1], None, np.array([None]), one(0), one(sum(w[2] for w in waiting)), one(sum(w[3] for w in waiting)), one(waiting[-1][4]))
            yield frame.assign(commit_pos=pd.array([None], dtype="Int64"))

    def close(self) -> None:
        pass


def _placed(key, kind, log_pos, event_seq, commit_pos, end_file, outcome, gtid_uuid, gno, n_rows, n_bytes, at) -> pd.DataFrame:
    """Columns of ``PLACES``; a number without its GTID is null."""
    text = lambda v: v if isinstance(v, np.ndarray) else np.full(len(log_pos), v, object)
    whole = lambda v: np.asarray(v, np.int64)
    numbered = pd.arrays.IntegerArray(whole(gno), pd.isna(gtid_uuid))
    columns = (text(key[0]), text(key[1]), text(kind), whole(log_pos), whole(event_seq), whole(commit_pos), text(end_file), text(outcome), text(gtid_uuid), numbered, whole(n_rows), whole(n_bytes), whole(at))
    return pd.DataFrame(dict(zip((c.split(" ")[0] for c in PLACES.split(", ")), columns, strict=True)))


def consumed_sets(start: DataFrame) -> dict:
    """{source: {server: (starts, ends)}} of the GTID sets in a table of starts (see ``after_start``)."""
    spans = gtid_as_of_text(start)
    out: dict = {}
    for r in spans.orderBy("source_id", "uuid", "start").collect():
        starts, ends = out.setdefault(r["source_id"], {}).setdefault(r["uuid"], ([], []))
        starts.append(r["start"])
        ends.append(r["end"])
    return out


def gtid_as_of_text(start: DataFrame) -> DataFrame:
    """The intervals of each source's set, as few as they can be."""
    given = start.where("coalesce(gtid_set, '') <> ''").select("source_id", F.explode(parse_gtid_set(F.col("gtid_set"))).alias("g")).select("source_id", "g.*")
    return gtid_union(given, ("source_id",))


def stream_transactions(events: DataFrame, schema: str, table: str, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES, watermark: str | None = None, start: DataFrame | None = None) -> DataFrame:
    """Places of committed inserts, and terminals, of a change-log stream.

    Rows may come in an earlier batch than their commit: only their events'
    places, counts and sizes wait in state.  ``kind`` tells ``rows`` (an event
    whose inserts are committed at commit_pos) from ``end`` (a terminal, with the
    last GTID and its transaction's size) and ``expired``.  As a reader of the log does, it stops
    at a transaction beyond a limit, a rotate or self-contained transaction while rows wait, and a
    commit at position 0.  A key's (source, file) events must arrive in log
    order from batch to batch; a rotate ends its state.

    With a ``watermark`` on event_ts, rows whose terminal has not come when it
    passes them leave state as one ``expired`` row with their counts.  Spark then
    also drops events that come later than it, so size it from the longest open
    transaction; without one nothing expires and nothing is dropped.  What is
    dropped is counted by ``DropCounter``.

    ``start``: transactions in a source's GTID set there are passed over, rows
    and terminal; the sets' intervals, not their numbers, go to the tasks.
    """
    weighed = event_weight(events.withWatermark("event_ts", watermark) if watermark else events, schema, table)
    wanted = (F.col("n_rows") > 0) | F.col("outcome").isNotNull() | F.col("event_type").isin("ROTATE", "GTID")
    lean = weighed.withColumn("outcome", ending()).where(wanted)
    # Never null, as pandas would make floats of them.
    whole = [F.coalesce(c, F.lit(0).cast("long")).alias(n) for n, c in (("next_pos", F.col("next_pos")), ("gno", F.col("gno")), ("at", F.unix_micros("event_ts")))]
    kind = F.when(F.col("outcome") == "rolled_back", ROLLBACK)
    for name, code in (("GTID", GTID), ("WRITE_ROWS", WRITE), ("PAYLOAD", PAYLOAD), ("ROTATE", ROTATE)):
        kind = kind.when(F.col("event_type") == name, code)
    lean = lean.select(*FILE, "log_pos", "event_seq", kind.otherwise(COMMIT).alias("kind"), "next_file", "gtid_uuid", "n_rows", "n_bytes", *whole, *(["event_ts"] if watermark else []))
    return lean.groupBy(*FILE).transformWithStateInPandas(_Assembly(max_rows, max_bytes, bool(watermark), consumed_sets(start) if start is not None else None), PLACES, "Append", "EventTime" if watermark else "None")


def rows_at(places: DataFrame, log: DataFrame) -> DataFrame:
    """The log's events at the committed places, with commit_pos: payloads join only now."""
    committed = places.where("kind = 'rows'").select(*FILE, "log_pos", "event_seq", "commit_pos")
    return log.join(committed, [*FILE, "log_pos", "event_seq"])


def spans_of(places: DataFrame) -> list[tuple[str, str, int, int]]:
    """(source, log file, least and largest position) of the committed rows' events: one row a log file of the batch."""
    return [tuple(r) for r in places.where("kind = 'rows'").groupBy(*FILE).agg(F.min("log_pos"), F.max("log_pos")).collect()]


def stream_committed_rows(events: DataFrame, read_log: Callable[[SparkSession, list], DataFrame], schema: str, table: str, path: str, checkpoint: str, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES, watermark: str | None = None, start: DataFrame | None = None, available_now: bool = True):
    """Start writing the committed rows (positional images in ``row``) of a change-log stream, a folder of ``path`` for each batch.

    ``read_log`` gives the events of spans of the same log (see ``indexed_log``),
    so that a batch reads only the data files that hold its committed places.
    A batch that is run again writes its folder again.
    """

    def run(places: DataFrame, batch_id: int) -> None:
        placed = places.where("kind = 'rows'").persist()
        try:
            found = explode_inserts(rows_at(placed, read_log(placed.sparkSession, spans_of(placed))), schema, table)
            found.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            placed.unpersist()

    places = stream_transactions(events, schema, table, max_rows, max_bytes, watermark, start)
    writer = places.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


class DropCounter(StreamingQueryListener):
    """Counts the rows that stateful operators of streams drop as later than their watermark, by query id."""

    def __init__(self):
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        late = sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)
        self.dropped[str(event.progress.id)] = self.dropped.get(str(event.progress.id), 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def relay_batch(
    base: str,
    read_log: Callable[[SparkSession, list], DataFrame],
    names: Names,
    bindings: DataFrame,
    consumer: str,
    now: Column,
    expected: str | None = None,
    interval_seconds: int = 5,
    compact_every: int = 16,
    strict: bool = False,
    by: str = "commit",
):
    """A foreachBatch function over ``stream_transactions``: publish, apply results, move the checkpoints.

    ``names``: prefix, schema and table of the stable ids.  In order: the
    batch's places are written; their rows are read from the log (``read_log``
    gets the spans of positions they lie in), checked and routed; envelopes of
    accepted rows are written to ``base/messages`` in commit order; then
    published ids, failed rows, checkpoints and the messages' manifest appear as
    one unit, a delta named after the batch.  A batch that is run again publishes
    the same files again or, if it is part of the state already, does nothing.

    Rows are known by (source, id).  With a plain text as prefix a relay serves
    one source, and a batch that names another is refused, as equal ids of two
    sources would get one stable id; ``source_prefix`` gives each its own.  Of a
    row that comes several times the outcomes count in commit order.

    Each source has a checkpoint, ``consumer/source``, at the last terminal that
    writes one (see ``checkpoint_timeline``; the log's own clock), with the GTID
    set up to there if it had one; a checkpoint never goes back.  Rows that come
    again are published again, under the same message ids.  A source's events
    must come in log order from batch to batch.  A base without state is empty.
    """
    _, schema, table = names
    kind = f"relay/{consumer}"

    def run(places: DataFrame, batch_id: int) -> None:
        with tb.spending(places.sparkSession):
            relay(places, batch_id)

    def relay(places: DataFrame, batch_id: int) -> None:
        spark = places.sparkSession
        version = f"batch-{consumer}-{batch_id:012d}"
        if tb.is_done(spark, base, kind, version):
            return
        state = tb.read_state(spark, base)
        outbox, saved = state or (spark.createDataFrame([], schemas.STATE), spark.createDataFrame([], schemas.CHECKPOINT))
        outbox = tb.conform(outbox, schemas.STATE)
        here = f"{base}/{version}"
        mine = F.concat_ws("/", F.lit(consumer), "source_id")
        known = saved.select(F.col("consumer_name").alias("_c"), file_number(F.col("binlog_name")).alias("_f"), F.col("binlog_position").alias("_p"), F.col("updated_at").alias("since"))
        number = F.coalesce(file_number(F.col("end_file")), F.lit(0))
        fresh = F.col("_f").isNull() | (number > F.col("_f")) | ((number == F.col("_f")) & (F.col("commit_pos") > F.col("_p")))
        placed = places.where("commit_pos is not null").withColumns({"consumer": mine, "line": number * (1 << 32) + F.col("commit_pos")})
        placed.join(known, F.col("consumer") == F.col("_c"), "left").withColumn("fresh", fresh).drop("_c", "_f", "_p").write.mode("overwrite").parquet(f"{here}/places")
        placed = spark.read.parquet(f"{here}/places")

        spans = spans_of(placed)
        before = {r[0] for r in saved.where(F.col("consumer_name").startswith(f"{consumer}/")).select(F.substr("consumer_name", F.lit(len(consumer) + 2))).collect()} if isinstance(names[0], str) else set()
        one_source(names, before | {s[0] for s in spans})
        def publish_rows() -> DataFrame:
            # Read and decoded once: their subjects are asked for first, then they are tried.
            quarantine(decode_rows(explode_inserts(rows_at(placed, read_log(spark, spans)), schema, table))).write.mode("overwrite").parquet(f"{here}/rows")
            decoded = spark.read.parquet(f"{here}/rows")
            return publish(spark, base, version, decoded.withColumn("attempt_count", F.lit(0).cast("long")), names, bindings, expected, strict, carry=("event_ts",), by=by, spent=f"{here}/rows")

        # The checkpoints' times don't wait for the messages.
        mark = lambda: written(placed).write.mode("overwrite").parquet(f"{here}/last")
        if spans:
            changes = changed(tb.together(publish_rows, mark)[0], outbox)
        else:
            mark()
            changes = outbox.limit(0).withColumn("gone", F.lit(False))
        last = spark.read.parquet(f"{here}/last")
        seen = placed.where("kind = 'end' and fresh and gtid_uuid is not null").select("consumer", "line", "gtid_uuid", "gno")
        waiting = tb.read_side(spark, base, f"ahead-{consumer}")
        seen = seen if waiting is None else seen.unionByName(waiting)
        ahead = seen.join(last.select(F.col("consumer").alias("_c"), "row"), F.col("consumer") == F.col("_c"), "left").where("row is null or line > row").select("consumer", "line", "gtid_uuid", "gno")
        points = upsert_checkpoints(saved, moved(placed, last, seen, saved), F.col("at"))
        tb.write_delta(changes, points, base, version, kind, {f"ahead-{consumer}": ahead}, manifest(spark, base, version) if spans else None)
        for step in ("results", "places", "last"):
            tb.discard(spark, f"{here}/{step}")
        if len(tb.read_pointer(spark, base)["deltas"]) >= compact_every:
            tb.compact(spark, base)

    def changed(results: DataFrame, outbox: DataFrame) -> DataFrame:
        """Each tried row as it is after the batch: gone if published last, else kept with its failures since then."""
        keys = ["source_id", "id"]
        at = F.struct(F.coalesce(file_number(F.col("log_file")), F.lit(0)), *COMMIT_ORDER[1:])
        content = F.struct("subject", "payload", "headers", "message_id", "ttl_seconds", F.col("event_ts").alias("created_at"), "error")
        tried = results.withColumn("_at", at)
        ends = tried.groupBy(*keys).agg(F.max(F.when(F.col("ok"), F.col("_at"))).alias("_ok"))
        failed = tried.where("not ok").join(ends, keys).where("_ok is null or _at > _ok").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max_by(content, "_at").alias("_new"))
        old = outbox.join(ends.where("_ok is null").select(*keys), keys, "left_semi").select(*keys, F.struct(*[c for c in outbox.columns if c not in keys]).alias("_old"))
        joined = ends.select(*keys).join(failed, keys, "left").join(old, keys, "left")
        kept = lambda c: F.when(F.col("_old").isNotNull(), F.col(f"_old.{c}")).otherwise(F.col(f"_new.{c}"))
        made = {c: kept(c) for c in ("subject", "payload", "headers", "message_id", "ttl_seconds", "created_at")}
        made |= {"attempt_count": F.coalesce("_old.attempt_count", F.lit(0)) + F.coalesce("_n", F.lit(0)), "last_attempt_at": now, "last_error": cut_error(F.col("_new.error")), "gone": F.col("_n").isNull()}
        row = joined.withColumns(made)
        return row.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.STATE], "gone")

    def written(placed: DataFrame) -> DataFrame:
        """(consumer, row, written): the terminal of each consumer that writes a checkpoint last in the batch."""
        ends = placed.where("kind = 'end' and fresh").withColumn("ts", F.timestamp_micros("at"))
        terminals = ends.select("consumer", "ts", F.col("line").alias("row"), (F.col("n_rows") > 0).alias("has_rows"), "since")
        timeline = checkpoint_timeline(terminals, interval_seconds, F.col("since"), short=True)
        return timeline.groupBy("consumer").agg(F.max("row").alias("row"), F.max("ts").alias("written"))

    def moved(placed: DataFrame, last: DataFrame, seen: DataFrame, saved: DataFrame) -> DataFrame:
        """The checkpoints at these terminals, with the GTIDs up to there for consumers that had a set.

        ``seen``: GTIDs of this batch's terminals, and of earlier ones' that no checkpoint took up yet.
        """
        begun = saved.where("coalesce(gtid_set, '') <> ''").select(F.col("consumer_name").alias("consumer"), F.explode(parse_gtid_set(F.col("gtid_set"))).alias("g")).select("consumer", "g.*")
        taken = seen.join(last, "consumer").where(F.col("line") <= F.col("row")).join(begun.select("consumer"), "consumer", "left_semi")
        texts = format_gtid_set(gtid_as_of(taken, begun, ("consumer",)), ("consumer",))
        ends = placed.where("kind = 'end'").join(last, "consumer").where(F.col("line") == F.col("row"))
        point = ends.groupBy("consumer", "row", "written").agg(F.min("end_file").alias("binlog_name"), F.min("commit_pos").alias("binlog_position"))
        return point.join(texts, "consumer", "left").select(F.col("consumer").alias("consumer_name"), "binlog_name", "binlog_position", "gtid_set", F.col("row").alias("write_seq"), F.col("written").alias("at"))

    return run


def relay_stream(events: DataFrame, base: str, read_log: Callable[[SparkSession, list], DataFrame], names: Names, bindings: DataFrame, consumer: str, now: Column, checkpoint: str, available_now: bool = True, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES, start: DataFrame | None = None, **more):
    """Start the relay over a change-log stream; ``start`` as ``stream_transactions`` takes it, ``more`` goes to ``relay_batch``."""
    places = stream_transactions(events, names[1], names[2], max_rows, max_bytes, start=start)
    writer = places.writeStream.foreachBatch(relay_batch(base, read_log, names, bindings, consumer, now, **more)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
