"""From an ordered log to committed rows.

A transaction never spans a log file, and a file is cut further, in stretches of
positions: events are numbered inside their stretch, and what a stretch begins
with comes from one row for each earlier stretch.  So a huge file spreads over
all tasks.  Everything is decided on the events' places, without their rows;
committed rows join back once, still packed in their events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outflow.operators.decode import inserted

FILE = ("source_id", "log_file")
MAX_ROWS, MAX_BYTES = 10_000, 67_108_864
#: Positions (bytes of a log file) in one stretch.
STRIDE = 1 << 24


def statement() -> Column:
    return F.upper(F.regexp_replace("query", r"\A\s+|\s+\z", ""))


def ending() -> Column:
    """``committed`` or ``rolled_back`` at a terminal event, null elsewhere."""
    query = F.col("event_type") == "QUERY"
    return F.when(F.col("event_type").isin("XID", "PAYLOAD") | (query & (statement() == "COMMIT")), "committed").when(query & (statement() == "ROLLBACK"), "rolled_back")


def carry_log_file(log: DataFrame, stride: int = 1_000_000) -> DataFrame:
    """Gives each event the file named by the latest rotate event of its source.

    In two steps, so that no task holds a whole source: events look back inside
    their stretch of ``stride`` sequence numbers, and what a stretch begins with
    comes from one row for each earlier stretch.
    """
    part = F.floor(F.col("event_seq") / stride).cast("long")
    named = F.when(F.col("event_type") == "ROTATE", F.col("next_file"))
    cut = log.withColumn("_part", part)
    inside = W.partitionBy("source_id", "_part").orderBy("event_seq").rowsBetween(W.unboundedPreceding, 0)
    ends = cut.groupBy("source_id", "_part").agg(F.max_by("next_file", F.when(named.isNotNull(), F.col("event_seq"))).alias("_end"))
    earlier = W.partitionBy("source_id").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    begins = ends.select("source_id", "_part", F.last("_end", ignorenulls=True).over(earlier).alias("_begin"))
    joined = cut.join(begins, ["source_id", "_part"], "left")
    carried = F.coalesce(F.last(named, ignorenulls=True).over(inside), F.col("_begin"), F.col("log_file"))
    return joined.withColumn("log_file", carried).select(*log.columns)


def _stretch(position: str, stride: int) -> Column:
    return F.floor(F.coalesce(F.col(position), F.lit(0)) / stride).cast("long")


def _before(each: DataFrame) -> DataFrame:
    """(source_id, log_file, _part, _before): what all earlier stretches of a file count; ``each``: source_id, log_file, _part, _n."""
    earlier = W.partitionBy(*FILE).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    return each.select(*FILE, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))


def assign_transactions(log: DataFrame, stride: int = STRIDE) -> DataFrame:
    """Adds ``tx``: how many terminals came before in the same source and file."""
    inside = W.partitionBy(*FILE, "_part").orderBy("log_pos", "event_seq").rowsBetween(W.unboundedPreceding, 0)
    numbered = log.withColumn("_part", _stretch("log_pos", stride)).withColumn("_here", F.sum(ending().isNotNull().cast("long")).over(inside))
    # Counted on the numbered events, so that both sides come from one shuffle.
    joined = numbered.join(_before(numbered.groupBy(*FILE, "_part").agg(F.max("_here").alias("_n"))), [*FILE, "_part"])
    return joined.withColumn("tx", F.col("_here") - ending().isNotNull().cast("long") + F.col("_before")).select(*log.columns, "tx")


def message_size(subject: Column, payload: Column, headers: Column, message_id: Column, ttl: Column) -> Column:
    """Bytes that count against a transaction's limit; a derived message id does not."""
    parts = [F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in (subject, payload, headers, message_id)]
    return sum(parts[1:], parts[0]) + F.when(ttl.isNotNull(), 4).otherwise(0)


def _row_bytes(row: Column) -> Column:
    return message_size(*(F.get(row, F.lit(i)) for i in range(1, 6)))


def event_weight(log: DataFrame, schema: str, table: str) -> DataFrame:
    """Adds ``n_rows`` and ``n_bytes``: the event's outbox inserts, without exploding them."""
    mine = inserted(schema, table)
    zero = F.lit(0).cast("long")
    size = F.aggregate(mine, zero, lambda acc, r: acc + _row_bytes(r))
    return log.withColumns({"n_rows": F.greatest(F.coalesce(F.size(mine).cast("long"), zero), zero), "n_bytes": F.coalesce(size, zero)})


def transaction_outcomes(log: DataFrame, schema: str, table: str) -> DataFrame:
    """(source_id, log_file, tx, outcome, n_rows, n_bytes, end_pos); outcome ``open`` has no terminal yet.

    Events that neither end a transaction nor bring rows (rotates, BEGIN) make none.
    """
    lean = event_weight(log, schema, table).select(*FILE, "log_pos", "event_seq", "event_type", "query", "n_rows", "n_bytes")
    grouped = assign_transactions(lean).groupBy(*FILE, "tx")
    return grouped.agg(
        F.coalesce(F.max(ending()), F.lit("open")).alias("outcome"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_bytes").alias("n_bytes"),
        F.max(F.when(ending().isNotNull(), F.col("log_pos"))).alias("end_pos"),
    ).where("outcome <> 'open' or n_rows > 0")


#: What names an event, and what its part in a transaction is told from.
PLACE = (*FILE, "log_pos", "event_seq")


def _places(log: DataFrame, stride: int) -> DataFrame:
    """Events that bring rows or end something, with ``tx`` and without their rows."""
    telling = ending().isNotNull() | F.col("event_type").isin("WRITE_ROWS", "PAYLOAD", "ROTATE")
    return assign_transactions(log.where(telling).select(*PLACE, "event_type", "query"), stride)


def _with_rows(log: DataFrame, places: DataFrame) -> DataFrame:
    """The log's insert events at these places."""
    return log.where(F.col("event_type").isin("WRITE_ROWS", "PAYLOAD")).join(places, list(PLACE)).select(*log.columns, *[c for c in places.columns if c not in log.columns])


def committed_rows(log: DataFrame, stride: int = STRIDE) -> DataFrame:
    """Insert events of committed transactions, with tx, outcome and commit_pos; rolled-back and open ones are left out."""
    tx = W.partitionBy(*FILE, "tx")
    told = {"outcome": F.max(ending()).over(tx), "commit_pos": F.max(F.when(ending().isNotNull(), F.col("log_pos"))).over(tx)}
    places = _places(log, stride).withColumns(told).where("outcome = 'committed' and event_type in ('WRITE_ROWS', 'PAYLOAD')")
    return _with_rows(log, places.select(*PLACE, "tx", "outcome", "commit_pos"))


def open_rows(log: DataFrame, stride: int = STRIDE) -> DataFrame:
    """Insert events with no terminal yet: input of the next run.

    In a file that was already rotated away they are not open but an anomaly
    (see ``log_anomalies``), and are left out.
    """
    closed = F.max((ending().isNotNull() | (F.col("event_type") == "ROTATE")).cast("int")).over(W.partitionBy(*FILE, "tx"))
    places = _places(log, stride).withColumn("_closed", closed).where("event_type = 'WRITE_ROWS' and _closed = 0")
    return _with_rows(log, places.select(*PLACE, "tx"))


#: Total publish order of committed rows.
COMMIT_ORDER = ("source_id", "log_file", "commit_pos", "log_pos", "event_seq", "row_idx")


def commit_order(rows: DataFrame, stride: int = STRIDE) -> DataFrame:
    """Adds ``publish_no`` within each source and file: by commit, then row event, then row."""
    part = _stretch("commit_pos", stride)
    inside = W.partitionBy(*FILE, "_part").orderBy(*COMMIT_ORDER[2:])
    numbered = rows.withColumn("_part", part).withColumn("_here", F.row_number().over(inside))
    joined = numbered.join(_before(numbered.groupBy(*FILE, "_part").agg(F.max("_here").alias("_n"))), [*FILE, "_part"])
    return joined.withColumn("publish_no", (F.col("_here") + F.col("_before")).cast("long")).select(*rows.columns, "publish_no")


def check_transaction_limits(log: DataFrame, schema: str, table: str, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Transactions beyond a limit, whether they commit or not; reaching a limit exactly is fine."""
    reason = F.when(F.col("n_rows") > max_rows, "rows").when(F.col("n_bytes") > max_bytes, "bytes")
    return transaction_outcomes(log, schema, table).withColumn("reason", reason).where("reason is not null")


def log_anomalies(log: DataFrame, schema: str, table: str) -> DataFrame:
    """(source_id, log_file, log_pos, reason): what a sequential reader would stop at.

    A rotate or a self-contained payload while rows are open; a commit at
    position 0, with rows or without.
    """
    lean = event_weight(log, schema, table).select(*PLACE, "event_type", "query", "n_rows")
    numbered = assign_transactions(lean)
    tx = W.partitionBy(*FILE, "tx").orderBy("log_pos", "event_seq").rowsBetween(W.unboundedPreceding, -1)
    pending = F.coalesce(F.sum(F.when(F.col("event_type") == "WRITE_ROWS", F.col("n_rows")).otherwise(0)).over(tx), F.lit(0))
    reason = (
        F.when((F.col("event_type") == "ROTATE") & (pending > 0), "rotate with open rows")
        .when((F.col("event_type") == "PAYLOAD") & (pending > 0), "payload with open rows")
        .when((ending() == "committed") & (F.col("log_pos") == 0), "commit at position 0")
    )
    return numbered.withColumn("reason", reason).where("reason is not null").select(*FILE, "log_pos", "reason")
