"""Star-schema and event tables seen as change logs, outboxes, attempts and GTIDs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outflow.schemas import CHANGE_LOG, CHECKPOINT, ID, OUTBOX

DB, TABLE, PREFIX = "app", "outbox", "relay"
NOW = "2024-06-01 00:00:00"
BINDINGS = (("EVENTS", "events.>"), ("AUDIT", "events.error.*"), ("SHOP", "*.purchase.>"))
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def now():
    return F.lit(NOW).cast("timestamp")


def bindings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BINDINGS, "stream string, pattern string")


def row_events(spark: SparkSession, sf_dir: str, keys: DataFrame | None = None, how: str = "left_semi") -> DataFrame:
    """One event for the lines of an order that share a kind and a table; with ``keys`` of the orders among them only, or (``left_anti``) of all others."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    if keys is not None:
        lines = lines.join(keys, F.col("l_orderkey") == F.col("packed_key"), how)
    lines = lines.withColumn("rn", F.row_number().over(W.partitionBy("l_orderkey").orderBy(*LINE_ORDER)))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderdate")
    binary = lambda e: F.encode(F.expr(e), "UTF-8")
    image = F.array(
        binary("cast(l_orderkey * 100 + rn as string)"),
        binary("concat('items.', l_returnflag, '.', l_linestatus)"),
        binary("concat('p', l_partkey, ':s', l_suppkey)"),
        binary("case when rn % 2 = 0 then concat('{\"X-Line\":\"', rn, '\"}') end"),
        binary("case when rn % 5 = 0 then concat('m', l_orderkey, '-', rn) end"),
        binary("case when rn % 3 > 0 then cast(rn * 10 as string) end"),
    )
    kind = F.when(F.col("l_returnflag") == "A", "UPDATE_ROWS").otherwise("WRITE_ROWS")
    table = F.when(F.col("l_linestatus") == "O", TABLE).otherwise("order_items")
    grouped = (
        lines.select("l_orderkey", kind.alias("event_type"), table.alias("table_name"), "rn", image.alias("image"))
        .groupBy("l_orderkey", "event_type", "table_name")
        .agg(F.min("rn").alias("first_rn"), F.transform(F.sort_array(F.collect_list(F.struct("rn", "image"))), lambda s: s["image"]).alias("rows"))
    )
    return grouped.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("okey"), (F.col("o_orderkey") * 100 + F.col("first_rn")).alias("event_seq"), F.col("o_orderdate").alias("event_ts"),
        "event_type", F.lit(DB).alias("schema_name"), "table_name", "rows", F.col("first_rn").cast("long").alias("place"),
    )


def terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The end of each order's transaction; the last order of a full file has none."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderkey % 1000 < 996")
    status = F.col("o_orderstatus")
    return orders.select(
        F.col("o_orderkey").alias("okey"), (F.col("o_orderkey") * 100 + 99).alias("event_seq"), F.col("o_orderdate").alias("event_ts"),
        F.when(status == "F", "XID").otherwise("QUERY").alias("event_type"), F.when(status == "P", " commit ").when(status == "O", "ROLLBACK").alias("query"),
        F.lit(99).cast("long").alias("place"),
    )


def _canonical(events: DataFrame) -> DataFrame:
    """Placed events (okey, place) in change-log columns."""
    placed = events.withColumns(
        {
            "source_id": F.concat(F.lit("src"), F.col("okey") % 4),
            "log_file": F.concat(F.lit("bin."), F.lpad((F.expr("okey div 1000") + 1).cast("string"), 6, "0")),
            "log_pos": F.col("okey") % 1000 * 100 + 4 + F.col("place"),
        }
    )
    return placed.select(*[(F.col(f.name) if f.name in placed.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in CHANGE_LOG])


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _canonical(row_events(spark, sf_dir).unionByName(terminals(spark, sf_dir), allowMissingColumns=True))


def _gtid_marks(orders: DataFrame) -> DataFrame:
    marks = orders.select(
        F.col("o_orderkey").alias("okey"), (F.col("o_orderkey") * 100).alias("event_seq"), F.lit("GTID").alias("event_type"), F.lit(0).cast("long").alias("place"),
        F.concat(F.lit("src"), F.col("o_orderkey") % 4).alias("gtid_uuid"), (F.expr("o_orderkey div 4") + 1).alias("gno"),
    )
    return _canonical(marks)


def gtid_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with a GTID event before each order's rows, but for the first orders of every file."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderkey % 1000 >= 20")
    return change_log(spark, sf_dir).unionByName(_gtid_marks(orders))


def mixed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with some transactions as self-contained payloads: orders of status F whose number divides by three."""
    keys = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderstatus = 'F' and o_orderkey % 3 = 0 and o_orderkey % 1000 < 996").select(F.col("o_orderkey").alias("packed_key"))
    # Lines are parted before they are numbered and gathered, so that each is gathered once.
    ends = terminals(spark, sf_dir).join(keys, F.col("okey") == F.col("packed_key"), "left_anti")
    plain = _canonical(row_events(spark, sf_dir, keys, "left_anti").unionByName(ends, allowMissingColumns=True))
    return plain.unionByName(payload_log(spark, sf_dir, keys))


def relay_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed log with GTIDs, on a clock of one second an order; sources 0 and 1 leave nothing open and rotate.

    Ids are numbered in each source by itself, so that all sources have the same.
    """
    marks = _gtid_marks(spark.read.parquet(f"{sf_dir}/orders.parquet"))
    whole = mixed_log(spark, sf_dir).unionByName(marks)
    turning, closed = F.col("source_id").isin("src0", "src1"), F.expr("event_seq div 100 % 1000") < 996
    whole = whole.where(~turning | closed)
    # Every order has its mark, so the marks tell the files without making the log again.
    whole = whole.unionByName(rotated(marks.where(turning & closed)))
    number = lambda r: F.encode((F.decode(r[0], "UTF-8").cast("long") % 100 + F.expr("event_seq div 400") * 100).cast("string"), "UTF-8")
    renumbered = lambda rows: F.transform(rows, lambda r: F.concat(F.array(number(r)), F.slice(r, F.lit(2), F.size(r))))
    nested = F.transform("nested", lambda e: F.struct(e["event_type"].alias("event_type"), e["schema_name"].alias("schema_name"), e["table_name"].alias("table_name"), renumbered(e["rows"]).alias("rows")))
    return whole.withColumns({"rows": renumbered(F.col("rows")), "nested": nested, "event_ts": F.timestamp_seconds(F.lit(1704067200) + F.expr("event_seq div 100"))})


def rotated_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with a rotate event at the end of every file of every source."""
    log = change_log(spark, sf_dir)
    return log.unionByName(rotated(log))


def rotated(log: DataFrame) -> DataFrame:
    """The rotate events that end the log's files."""
    files = log.select("source_id", "log_file").distinct().withColumn("n", F.substring("log_file", 5, 6).cast("long"))
    ends = files.select(
        "source_id", "log_file", F.lit(100_003).cast("long").alias("log_pos"), (F.col("n") * 100_000 - 1).alias("event_seq"), F.lit("ROTATE").alias("event_type"),
        F.concat(F.lit("bin."), F.lpad((F.col("n") + 1).cast("string"), 6, "0")).alias("next_file"), F.lit(4).cast("long").alias("next_pos"),
    )
    return ends.select(*[(F.col(f.name) if f.name in ends.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in CHANGE_LOG])


def unnamed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that don't say their file, with a rotate event before each file."""
    log = change_log(spark, sf_dir)
    files = log.select("source_id", F.col("log_file").alias("next_file")).distinct()
    begins = files.select("source_id", "next_file", ((F.substring("next_file", 5, 6).cast("long") - 1) * 100_000 - 1).alias("event_seq"), F.lit("ROTATE").alias("event_type"))
    return log.withColumn("log_file", F.lit(None).cast("string")).unionByName(begins, allowMissingColumns=True)


def payload_log(spark: SparkSession, sf_dir: str, keys: DataFrame | None = None) -> DataFrame:
    """Orders of status F (with ``keys`` those among them), each packed into one self-contained payload event."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderstatus = 'F' and o_orderkey % 1000 < 996").select(F.col("o_orderkey").alias("okey"))
    if keys is not None:
        orders = orders.join(keys, F.col("okey") == F.col("packed_key"), "left_semi")
    nested = F.transform(F.sort_array(F.collect_list(F.struct("event_seq", "event_type", "schema_name", "table_name", "rows"))), lambda s: F.struct(s["event_type"].alias("event_type"), s["schema_name"].alias("schema_name"), s["table_name"].alias("table_name"), s["rows"].alias("rows")))
    # An order without lines is an empty transaction.
    packed = orders.join(row_events(spark, sf_dir, keys), "okey", "left").groupBy("okey").agg(F.filter(nested, lambda e: e["event_type"].isNotNull()).alias("nested"))
    return _canonical(packed.withColumns({"event_seq": F.col("okey") * 100 + 99, "event_type": F.lit("PAYLOAD"), "place": F.lit(99).cast("long")}))


OUTBOX_EXPRESSIONS = {
    "subject": """case when event_id % 97 = 0 then '' when event_id % 89 = 0 then 'events..' || event_type when event_id % 83 = 0 then 'events.' || event_type || '.*'
        when event_id % 79 = 0 then 'other.' || event_type else 'events.' || event_type || '.u' || (user_id % 10) end""",
    "headers": """case when event_id % 35 = 3 then props when event_id % 41 = 7 then '{"nats-msg-id":"x"}' when event_id % 43 = 5 then '{"B":["x",1],"A:":"y"}' when event_id % 47 = 9 then 'null'
        when event_id % 5 = 0 then null when event_id % 5 = 1 then '{"X-Tag":["a","b"],"X-User":"' || user_id || '"}' else '{"Content-Type":"application/json"}' end""",
    "message_id": "case event_id % 3 when 0 then null when 1 then 'm' || event_id else 'u' || user_id || ':' || event_type end",
    "ttl_seconds": "case when event_id % 4 = 0 then null when event_id % 53 = 0 then 0 else event_id % 600 + 1 end",
    "attempt_count": "case when event_type = 'error' then event_id % 3 + 1 else 0 end",
}


def outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    made = events.select(
        (F.col("event_id") + 1).cast(ID).alias("id"), *[F.expr(e).alias(n) for n, e in OUTBOX_EXPRESSIONS.items()], F.encode("props", "UTF-8").alias("payload"),
        F.lit(None).cast("timestamp").alias("last_attempt_at"), F.lit(None).cast("string").alias("last_error"), F.col("ts").cast("timestamp").alias("created_at"),
    )
    return made.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in OUTBOX])


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outbox as the relay keeps it, of one source."""
    return outbox(spark, sf_dir).select(F.lit("app").alias("source_id"), "*")


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, retry = F.col("event_type") != "error", F.col("event_id") % 7 == 0
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.concat(F.lit("c"), F.col("user_id") % 5).alias("consumer"), (F.col("event_id") + 1).alias("id"), F.col("ts").cast("timestamp").alias("ts"), ok.alias("ok"),
        F.when(~ok, F.when(F.col("event_id") % 2 == 0, "no stream covers subject").otherwise("timeout")).alias("error"),
        retry.alias("was_retry"), (~ok & ~retry).alias("first_failure"), F.concat(F.lit("events."), F.col("event_type")).alias("subject"),
    )


def gtids(spark: SparkSession, sf_dir: str, above: float = 20) -> DataFrame:
    number = F.col("event_id") + 1
    return spark.read.parquet(f"{sf_dir}/events.parquet").where(F.col("value") > above).select(F.concat(F.lit("u"), F.col("user_id") % 3).alias("uuid"), number.alias("start"), number.alias("end"))


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.concat(F.lit("c"), F.col("user_id") % 5).alias("consumer"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("row"), (F.col("event_type") == "purchase").alias("has_rows")
    )


def checkpoint_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.concat(F.lit("c"), F.col("user_id") % 5).alias("consumer_name"), F.lit("bin.000001").alias("binlog_name"), (F.col("event_id") * 10 + 4).alias("binlog_position"),
        F.when(F.col("event_id") % 2 == 0, "").otherwise(F.concat(F.lit("u:1-"), F.col("event_id"))).alias("gtid_set"), F.col("event_id").alias("write_seq"),
    )


def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A checkpoint of every consumer that the events name, and one that has written nothing since."""
    users = spark.read.parquet(f"{sf_dir}/events.parquet").select((F.col("user_id") % 5).alias("u")).distinct()
    rows = users.select(
        F.concat(F.lit("c"), "u").alias("consumer_name"), F.lit("bin.000001").alias("binlog_name"), F.lit(4).cast("long").alias("binlog_position"), F.lit(None).cast("string").alias("gtid_set"),
        F.timestamp_add("HOUR", -F.col("u") * 10, now()).alias("updated_at"),
    )
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in CHECKPOINT])


def recovery_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(consumers, checkpoints, log files, server state): consumers spread over all branches of recovery.

    Every user is a consumer of the server ``user % 4``; servers 0 and 1 use
    GTIDs.  Which branch a user takes follows from its id.
    """
    users = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").alias("u")).distinct()
    consumers = users.select(F.concat(F.lit("k"), "u").alias("consumer_name"), F.concat(F.lit("s"), F.col("u") % 4).alias("source_id"), "u")
    gtid = F.expr("case u % 7 when 0 then null when 1 then '' when 2 then 'a:1-50' when 3 then 'a:1-150' when 4 then 'a:3-90,b:2' when 5 then 'a:1-100,b:1-9:11' else null end")
    saved = consumers.where("u % 11 <> 0").select(
        "consumer_name", "source_id", F.concat(F.lit("bin."), F.col("u") % 3).alias("binlog_name"), F.expr("cast(u * 13 % 400 as bigint)").alias("binlog_position"), gtid.alias("gtid_set")
    )
    servers = users.select((F.col("u") % 4).alias("s")).distinct()
    files = servers.select(F.concat(F.lit("s"), "s").alias("source_id"), F.explode(F.array(F.struct(F.lit("bin.0").alias("name"), F.lit(200).cast("long").alias("size")), F.struct(F.lit("bin.1").alias("name"), F.lit(300).cast("long").alias("size")))).alias("f")).select("source_id", "f.*")
    state = servers.select(F.concat(F.lit("s"), "s").alias("source_id"), (F.col("s") < 2).alias("gtid_on"), F.lit("a:1-100,b:1-20").alias("gtid_executed"), F.expr("case when s = 0 then 'a:1-2' else '' end").alias("gtid_purged"))
    return consumers.select("consumer_name"), saved, files, state
