"""Per-consumer checkpoints: writing, thinning, and planning a recovery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outflow.operators.gtid import gtid_contains, gtid_union, parse_gtid_set
from outflow.operators.hops import folded, hops
from outflow.operators.transactions import FILE, ending
from outflow.schemas import UINT32
from outflow.sources.tables import file_number


def upsert_checkpoints(state: DataFrame, updates: DataFrame, now: Column, order: str = "write_seq") -> DataFrame:
    """The last write of each consumer wins, even if it goes back; an empty GTID set is none."""
    names = ["consumer_name", "binlog_name", "binlog_position", "gtid_set"]
    old = state.select(*names, "updated_at", F.lit(None).cast("long").alias("_seq"))
    new = updates.select(*names[:3], F.nullif(F.col("gtid_set"), F.lit("")).alias("gtid_set"), now.alias("updated_at"), F.col(order).cast("long").alias("_seq"))
    row = F.struct(*names[1:], "updated_at")
    last = old.unionByName(new).groupBy("consumer_name").agg(F.max_by(row, F.coalesce("_seq", F.lit(-(1 << 63)))).alias("r"))
    return last.select("consumer_name", "r.*")


def load_checkpoint(state: DataFrame, consumer: str) -> DataFrame:
    """A consumer's row, if it has one, with ``error`` where its position can't be right."""
    error = F.when(~F.col("binlog_position").between(0, UINT32), "checkpoint position is out of range")
    return state.where(F.col("consumer_name") == consumer).withColumn("error", error)


def checkpoint_timeline(terminals: DataFrame, interval_seconds: int, start_ts: Column | None = None, short: bool = False) -> DataFrame:
    """(consumer, ts, row): the terminals that write a checkpoint.

    ``terminals``: consumer, ts, row, has_rows.  A commit with rows always
    writes and restarts the clock; any other terminal writes if ``interval`` has
    passed since the last write, or since the consumer's start (``start_ts``,
    else its first terminal).  Consumers are read in stretches of time, or each
    by one task where the table is ``short``.
    """
    start = F.unix_micros(start_ts) if start_ts is not None else F.lit(None).cast("long")
    lean = terminals.select(F.col("consumer").alias("_line"), F.col("row").alias("_row"), F.unix_micros("ts").alias("_at"), F.col("has_rows").alias("_forced"), start.alias("_start"))
    kept = (folded if short else hops)(lean, interval_seconds * 1_000_000)
    return terminals.join(kept, F.col("consumer").eqNullSafe(F.col("_line")) & (F.col("row") == F.col("_row")), "left_semi").select("consumer", "ts", "row")


def position_available(checkpoints: DataFrame, log_files: DataFrame, server_state: DataFrame) -> DataFrame:
    """Adds gtid_on, has_gtid, available and error to each checkpoint (source_id, consumer_name, …).

    A file position needs its file listed, at least 4 and at most its size.  A
    GTID set must be in what the server has executed (else an error) and hold
    what it has purged.
    """
    files = log_files.select(F.col("source_id").alias("_s"), F.col("name").alias("_n"), "size")
    found = checkpoints.join(files, (F.col("source_id") == F.col("_s")) & (F.col("binlog_name") == F.col("_n")), "left").drop("_s", "_n")
    server = server_state.select(F.col("source_id").alias("_s"), "gtid_on", "gtid_executed", "gtid_purged")
    found = found.join(server, F.col("source_id") == F.col("_s"), "left").drop("_s")
    spans = lambda c: found.select("consumer_name", F.explode(parse_gtid_set(F.col(c))).alias("g")).select("consumer_name", "g.*")
    keys = ("consumer_name",)
    executed = gtid_contains(spans("gtid_executed"), spans("gtid_set"), keys).withColumnRenamed("contained", "_known")
    purged = gtid_contains(spans("gtid_set"), spans("gtid_purged"), keys).withColumnRenamed("contained", "_whole")
    out = found.join(executed, "consumer_name", "left").join(purged, "consumer_name", "left")
    has = F.coalesce(F.col("gtid_set"), F.lit("")) != ""
    by_file = F.coalesce((F.col("binlog_position") >= 4) & (F.col("binlog_position") <= F.col("size")), F.lit(False))
    known, whole = F.coalesce("_known", F.lit(True)), F.coalesce("_whole", F.lit(True))
    out = out.withColumn("has_gtid", has).withColumn("available", F.when(has, known & whole).otherwise(by_file))
    return out.withColumn("error", F.when(has & F.col("gtid_on") & ~known, "checkpoint holds transactions the server has not executed")).drop("_known", "_whole")


def plan_recovery(consumers: DataFrame, checkpoints: DataFrame, log_files: DataFrame, server_state: DataFrame) -> DataFrame:
    """(consumer_name, plan, reason): stream_gtid, stream_file, snapshot or error for each consumer."""
    judged = position_available(checkpoints, log_files, server_state).withColumn("_have", F.lit(True))
    rows = consumers.select("consumer_name").join(judged, "consumer_name", "left")
    none, gtid, on = F.col("_have").isNull(), F.col("has_gtid"), F.col("gtid_on")
    plan = (
        F.when(none, "snapshot")
        .when(F.col("error").isNotNull() | (gtid & ~on), "error")
        .when(~gtid & on, "snapshot")
        .when(~F.col("available"), "snapshot")
        .when(gtid, "stream_gtid")
        .otherwise("stream_file")
    )
    reason = (
        F.when(none, "no checkpoint")
        .when(gtid & ~on, "checkpoint has a GTID set but the server has GTIDs off")
        .when(F.col("error").isNotNull(), F.col("error"))
        .when(~gtid & on, "move from file position to GTIDs")
        .when(~F.col("available"), "position is no longer available")
        .otherwise("position is available")
    )
    return rows.select("consumer_name", plan.alias("plan"), reason.alias("reason"))


def attach_gtid(log: DataFrame, checkpoint: DataFrame | None = None) -> DataFrame:
    """Adds gtid_uuid and gno to terminals: the last GTID event's, carried forward over files too.

    ``checkpoint``: source_id and gtid_set.  A source whose checkpoint has no
    set is read by file position, and nothing is attached (without a
    ``checkpoint`` argument all sources carry).  The set as of a commit is
    ``gtid_as_of``; keeping one pair a commit avoids writing a growing set a
    commit.  A file begins with what one row for each earlier file says.
    """
    order = W.partitionBy(*FILE).orderBy("log_pos", "event_seq").rowsBetween(W.unboundedPreceding, 0)
    pair = F.when(F.col("gtid_uuid").isNotNull(), F.struct("gtid_uuid", "gno"))
    ends = log.groupBy(*FILE).agg(F.max_by(F.struct("gtid_uuid", "gno"), F.when(F.col("gtid_uuid").isNotNull(), F.struct("log_pos", "event_seq"))).alias("_end"))
    earlier = W.partitionBy("source_id").orderBy(file_number(F.col("log_file")), "log_file").rowsBetween(W.unboundedPreceding, -1)
    begins = ends.select(*FILE, F.last("_end", ignorenulls=True).over(earlier).alias("_begin"))
    marked = log.withColumn("_g", F.last(pair, ignorenulls=True).over(order)).where(ending().isNotNull()).join(begins, [*FILE], "left")
    found = F.coalesce("_g", "_begin")
    if checkpoint is not None:
        sets = checkpoint.where("coalesce(gtid_set, '') <> ''").select(F.col("source_id").alias("_s")).distinct()
        marked = marked.join(sets, F.col("source_id") == F.col("_s"), "left")
        found = F.when(F.col("_s").isNotNull(), found)
    marked = marked.withColumn("_g", found)
    return marked.withColumns({"gtid_uuid": F.col("_g.gtid_uuid"), "gno": F.col("_g.gno")}).select(*log.columns)


def gtid_as_of(terminals: DataFrame, checkpoint: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, uuid, start, end): the checkpoint's set joined by all GTIDs of the given terminals."""
    seen = terminals.where("gtid_uuid is not null").select(*keys, F.col("gtid_uuid").alias("uuid"), F.col("gno").alias("start"), F.col("gno").alias("end"))
    return gtid_union(seen.unionByName(checkpoint.select(*keys, "uuid", "start", "end")), keys)
