"""Schemas of the relay's tables.  Ids are decimal(20,0): they are unsigned 64-bit."""

from __future__ import annotations

from pyspark.sql import types as T

ID = T.DecimalType(20, 0)

#: Managed columns an older table may lack, with their defaults.
OUTBOX_MANAGED = {"ttl_seconds": None, "attempt_count": 0, "last_attempt_at": None, "last_error": None}
CHECKPOINT_MANAGED = {"gtid_set": None}

OUTBOX = T.StructType(
    [
        T.StructField("id", ID, False),
        T.StructField("subject", T.StringType(), False),
        T.StructField("payload", T.BinaryType(), False),
        T.StructField("headers", T.StringType()),
        T.StructField("message_id", T.StringType()),
        T.StructField("ttl_seconds", T.LongType()),
        T.StructField("attempt_count", T.LongType(), False),
        T.StructField("last_attempt_at", T.TimestampType()),
        T.StructField("last_error", T.StringType()),
        T.StructField("created_at", T.TimestampType(), False),
    ]
)

#: The relay's own outbox: an id is unique inside its source only.
STATE = T.StructType([T.StructField("source_id", T.StringType(), False), *OUTBOX])

#: A published message, after its place in the log (null where a pass over the table published it).
ENVELOPE = "source_id string, log_file string, commit_pos long, log_pos long, event_seq long, row_idx int, topic string, key string, value binary, headers array<struct<key:string,value:binary>>"

CHECKPOINT = T.StructType(
    [
        T.StructField("consumer_name", T.StringType(), False),
        T.StructField("binlog_name", T.StringType(), False),
        T.StructField("binlog_position", T.LongType(), False),
        T.StructField("gtid_set", T.StringType()),
        T.StructField("updated_at", T.TimestampType(), False),
    ]
)

ROWS = T.ArrayType(T.ArrayType(T.BinaryType()))
NESTED = T.ArrayType(
    T.StructType(
        [
            T.StructField("event_type", T.StringType()),
            T.StructField("schema_name", T.StringType()),
            T.StructField("table_name", T.StringType()),
            T.StructField("rows", ROWS),
        ]
    )
)

CHANGE_LOG = T.StructType(
    [
        T.StructField("source_id", T.StringType()),
        T.StructField("log_file", T.StringType()),
        T.StructField("log_pos", T.LongType()),
        T.StructField("event_seq", T.LongType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("query", T.StringType()),
        T.StructField("next_file", T.StringType()),
        T.StructField("next_pos", T.LongType()),
        T.StructField("gtid_uuid", T.StringType()),
        T.StructField("gno", T.LongType()),
        T.StructField("schema_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("rows", ROWS),
        T.StructField("nested", NESTED),
    ]
)

#: Order of the values of an outbox row image.
ROW_COLUMNS = ("id", "subject", "payload", "headers", "message_id", "ttl_seconds")
UINT32 = 4294967295
