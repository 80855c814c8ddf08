"""From change-log events to typed outbox messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outflow.schemas import ID, ROW_COLUMNS, UINT32

ROW_EVENTS = ("WRITE_ROWS", "UPDATE_ROWS", "DELETE_ROWS")


def filter_table(log: DataFrame, schema: str, table: str) -> DataFrame:
    """Row events of one table; events that carry no rows stay, they delimit."""
    ours = (F.col("schema_name") == schema) & (F.col("table_name") == table)
    return log.where(~F.col("event_type").isin(*ROW_EVENTS) | ours)


def filter_inserts(log: DataFrame) -> DataFrame:
    """Without update and delete row events."""
    return log.where(~F.col("event_type").isin("UPDATE_ROWS", "DELETE_ROWS"))


def explode_rows(log: DataFrame) -> DataFrame:
    """One row for each inserted row, with its place in the event."""
    keep = [c for c in log.columns if c not in ("rows", "nested")]
    return log.where("event_type = 'WRITE_ROWS'").select(*keep, F.posexplode("rows").alias("row_idx", "row"))


def _ours(event: Column, schema: str, table: str) -> Column:
    return (event["event_type"] == "WRITE_ROWS") & (event["schema_name"] == schema) & (event["table_name"] == table)


def inserted(schema: str, table: str) -> Column:
    """Rows of the table that an event inserts, by itself or in the events nested in it; null if none."""
    nested = F.flatten(F.transform(F.filter("nested", lambda e: _ours(e, schema, table)), lambda e: e["rows"]))
    ours = (F.col("event_type") == "WRITE_ROWS") & (F.col("schema_name") == schema) & (F.col("table_name") == table)
    return F.when(F.col("event_type") == "PAYLOAD", nested).when(ours, F.col("rows"))


def explode_payload(log: DataFrame, schema: str, table: str) -> DataFrame:
    """Rows of the table inserted by each self-contained payload event, in order.

    Its nested events are filtered and flattened inside the event, before any
    row is made.
    """
    return explode_inserts(log.where("event_type = 'PAYLOAD'"), schema, table)


def explode_inserts(log: DataFrame, schema: str, table: str) -> DataFrame:
    """One row for each row of the table that plain and self-contained events insert."""
    keep = [c for c in log.columns if c not in ("rows", "nested")]
    return log.select(*keep, F.posexplode(inserted(schema, table)).alias("row_idx", "row"))


def _text(value: Column) -> Column:
    """Text of a binary value; null where its bytes are not UTF-8."""
    return F.try_validate_utf8(value.cast("string"))


def _whole(value: Column) -> Column:
    """Text of a binary value if it is digits only, else null."""
    text = _text(value)
    return F.when(text.rlike(r"\A[0-9]+\z"), text)


def decode_rows(rows: DataFrame, columns: tuple[str, ...] = ROW_COLUMNS) -> DataFrame:
    """Positional values to typed message columns, and ``decode_error`` (null if good).

    ``columns`` names the row image's values in order; more values than columns
    are ignored, fewer are an error, as are texts whose bytes are not UTF-8
    (a payload may hold any bytes).
    """
    at = {c: F.get("row", F.lit(i)) for i, c in enumerate(columns)}
    size = F.size("row")
    odd = lambda c: at[c].isNotNull() & _text(at[c]).isNull()
    raw_id, raw_ttl = _whole(at["id"]), _whole(at["ttl_seconds"])
    # Digits only by now; a number too long for the type casts to null.
    big_id, big_ttl = raw_id.try_cast("decimal(38,0)"), raw_ttl.try_cast("decimal(38,0)")
    error = (
        F.when(size < len(columns), "row has too few values")
        .when(at["id"].isNull(), "id is null")
        .when(raw_id.isNull(), "id is not an unsigned number")
        .when(big_id.isNull() | (big_id > F.lit("18446744073709551615").cast("decimal(38,0)")), "id is out of range")
        .when(big_id == 0, "id is zero")
        .when(at["subject"].isNull(), "subject is null")
        .when(at["payload"].isNull(), "payload is null")
        .when(odd("subject"), "subject is not UTF-8")
        .when(odd("headers"), "headers are not UTF-8")
        .when(odd("message_id"), "message id is not UTF-8")
        .when(at["ttl_seconds"].isNotNull() & raw_ttl.isNull(), "ttl is not an unsigned number")
        .when(at["ttl_seconds"].isNotNull() & (big_ttl.isNull() | (big_ttl > UINT32)), "ttl is out of range")
    )
    good = error.isNull()
    text = lambda c: F.when(good, _text(at[c]))
    return rows.withColumn("decode_error", error).withColumns(
        {
            "id": F.when(good, big_id.cast(ID)),
            "subject": text("subject"),
            "payload": F.when(good, at["payload"]),
            "headers": text("headers"),
            "message_id": text("message_id"),
            "ttl_seconds": F.when(good, big_ttl.cast("long")),
        }
    ).drop("row")


def quarantine(df: DataFrame, error: str = "decode_error", mode: str = "fail") -> DataFrame | tuple[DataFrame, DataFrame]:
    """``fail``: reading a bad row stops the job.  ``split``: good rows and bad rows apart."""
    if mode == "split":
        return df.where(F.col(error).isNull()).drop(error), df.where(F.col(error).isNotNull())
    if mode != "fail":
        raise ValueError("mode is fail or split")
    kept = F.when(F.col(error).isNotNull(), F.raise_error(F.col(error)).cast("boolean")).otherwise(F.lit(True))
    return df.where(kept).drop(error)
