"""Publish checks and derived columns of messages, as column expressions."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESERVED = "nats-"
STRICT_RESULT = "headers map<string,array<string>>, error string"


def subject_error(subject: Column) -> Column:
    """Why a subject can't be published, or null."""
    return (
        F.when(subject.isNull() | (subject == ""), "subject is empty")
        .when(subject.rlike(r"[ \t\r\n*>]"), "subject is not concrete")
        .when(subject.startswith(".") | subject.endswith(".") | subject.contains(".."), "subject has an empty token")
    )


def _variants(headers: Column) -> Column:
    return F.from_json(headers, "map<string,variant>", {"allowSingleQuotes": "false"})


def _blank(headers: Column) -> Column:
    """No headers at all: null, no bytes, or JSON null."""
    return headers.isNull() | (headers == "") | (F.regexp_replace(headers, r"\A[ \t\r\n]+|[ \t\r\n]+\z", "") == "null")


def _last_wins(entries: Column) -> Column:
    """Entries without those whose key comes again later."""
    return F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]))


def _values(value: Column) -> Column:
    """Header values of one JSON value; null where it is neither text nor a list of texts."""
    kind = F.schema_of_variant(value)
    listed = F.transform(F.try_variant_get(value, "$", "array<string>"), lambda v: F.coalesce(v, F.lit("")))
    return (
        F.when(value.isNull() | (kind == "VOID"), F.array(F.lit("")))
        .when(kind == "STRING", F.array(F.try_variant_get(value, "$", "string")))
        .when(kind.isin("ARRAY<STRING>", "ARRAY<VOID>"), listed)
    )


def _entries(headers: Column) -> Column:
    """(key, values) of each header, the last of a repeated name."""
    kept = _last_wins(F.map_entries(_variants(headers)))
    return F.transform(kept, lambda e: F.struct(e["key"].alias("key"), _values(e["value"]).alias("value")))


def header_error(headers: Column, reserved_prefix: str = RESERVED) -> Column:
    """Why headers can't be published, or null; of several bad headers the least name is told."""

    def of(e: Column) -> Column:
        name, values = e["key"], e["value"]
        return (
            F.when((name == "") | name.rlike(r"[:\r\n]"), F.concat(F.lit("header name is invalid: "), name))
            .when(F.lower(name).startswith(reserved_prefix.lower()), F.concat(F.lit("header is reserved: "), name))
            .when(values.isNull(), F.concat(F.lit("header value is not text: "), name))
            .when(F.exists(values, lambda v: v.rlike(r"[\r\n]")), F.concat(F.lit("header value has a line break: "), name))
        )

    told = F.transform(_entries(headers), lambda e: F.struct(e["key"].alias("key"), of(e).alias("error")))
    worst = F.array_min(F.filter(told, lambda t: t["error"].isNotNull()))["error"]
    return F.when(~_blank(headers), F.when(_variants(headers).isNull(), "headers are not a JSON object").otherwise(worst))


def parse_headers(headers: Column, reserved_prefix: str = RESERVED) -> Column:
    """Map of header name to its values; empty where there are none or they are bad."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<string>>"))
    entries = F.filter(_entries(headers), lambda e: F.size(e["value"]) > 0)
    good = ~_blank(headers) & header_error(headers, reserved_prefix).isNull()
    return F.when(good, F.map_from_entries(entries)).otherwise(empty)


def _strict(raw: str | None, reserved: str) -> tuple[dict[str, list[str]], str | None]:
    if raw is None or raw == "":
        return {}, None
    try:
        found = json.loads(raw, parse_constant=lambda c: 1 / 0)
    except (ValueError, ZeroDivisionError, RecursionError):
        return {}, "headers are not a JSON object"
    if found is None:
        return {}, None
    if not isinstance(found, dict):
        return {}, "headers are not a JSON object"
    out = {}
    for name in sorted(found):
        value = found[name]
        values = [value] if value is None or isinstance(value, str) else value
        if name == "" or any(c in name for c in ":\r\n"):
            return {}, f"header name is invalid: {name}"
        if name.lower().startswith(reserved.lower()):
            return {}, f"header is reserved: {name}"
        if not isinstance(values, list) or not all(v is None or isinstance(v, str) for v in values):
            return {}, f"header value is not text: {name}"
        if any("\r" in (v or "") or "\n" in (v or "") for v in values):
            return {}, f"header value has a line break: {name}"
        if values:
            out[name] = [v or "" for v in values]
    return out, None


def parse_headers_strict(reserved_prefix: str = RESERVED):
    """Arrow function for headers held as free text: also refuses trailing data and single quotes."""

    @F.pandas_udf(STRICT_RESULT)
    def run(raw: pd.Series) -> pd.DataFrame:
        pairs = [_strict(x, reserved_prefix) for x in raw]
        return pd.DataFrame({"headers": [p[0] for p in pairs], "error": [p[1] for p in pairs]})

    return run


def ttl_error(ttl: Column) -> Column:
    return F.when(ttl == 0, "ttl must be above zero")


def expires_at(stored_at: Column, ttl: Column) -> Column:
    """When a message lapses; null for one that doesn't."""
    return F.when(ttl.isNotNull(), F.timestamp_add("SECOND", ttl, stored_at))


def stable_message_id(prefix: str | Column, db: str, table: str) -> Column:
    """The given message id, or one derived from where the row lives.

    Ids are unique inside one source only, so a table of several needs a
    ``prefix`` for each: an expression over source_id (see ``source_prefix``).
    """
    first = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.coalesce(F.nullif(F.col("message_id"), F.lit("")), F.concat_ws(":", first, F.lit(db), F.lit(table), F.col("id").cast("string")))


def source_prefix(prefix: str) -> Column:
    """A prefix for each source."""
    return F.concat_ws("/", F.lit(prefix), F.col("source_id"))


def validate_messages(messages: DataFrame, reserved_prefix: str = RESERVED, strict: bool = False) -> DataFrame:
    """Adds ``error``: the first failed check, in the order subject, headers, ttl.

    ``strict``: headers are free text, and are read as ``parse_headers_strict`` does.
    """
    headers = parse_headers_strict(reserved_prefix)(F.col("headers"))["error"] if strict else header_error(F.col("headers"), reserved_prefix)
    first = F.coalesce(subject_error(F.col("subject")), headers, ttl_error(F.col("ttl_seconds")))
    return messages.withColumn("error", F.concat(F.lit("outbox row "), F.col("id").cast("string"), F.lit(": "), first))


def contract_violations(outbox: DataFrame) -> DataFrame:
    """(id, rule): every table rule that a row breaks."""
    subject, headers = F.col("subject"), F.col("headers")
    rules = {
        "subject_required": subject.isNull(),
        "subject_not_empty": subject == "",
        "subject_concrete": subject.rlike(r"[*>]|\s"),
        "subject_tokens": subject.startswith(".") | subject.endswith(".") | subject.contains(".."),
        "payload_required": F.col("payload").isNull(),
        "headers_object": headers.isNotNull() & F.coalesce(F.schema_of_variant(F.try_parse_json(headers)).startswith("OBJECT") == F.lit(False), F.lit(True)),
        "ttl_positive": F.col("ttl_seconds") == 0,
    }
    broken = F.array(*[F.when(F.coalesce(hit, F.lit(False)), F.lit(name)) for name, hit in rules.items()])
    return outbox.select("id", F.explode(F.filter(broken, lambda r: r.isNotNull())).alias("rule"))


def key_violations(outbox: DataFrame) -> DataFrame:
    """(key, value, n): repeated ids and repeated given message ids."""
    ids = outbox.groupBy(F.col("id").cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("id").alias("key"), "value", "n")
    given = outbox.where("message_id is not null").groupBy(F.col("message_id").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return ids.unionByName(given.select(F.lit("message_id").alias("key"), "value", "n")).where("n > 1")
