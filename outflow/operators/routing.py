"""Which stream takes a message, and which copies of a message are kept."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outflow.operators.hops import NEVER, hops


def pattern_regex(pattern: str) -> str:
    """Anchored regular expression of a subject pattern: ``*`` is one token, ``>`` one or more."""
    return r"\A" + r"\.".join({"*": "[^.]+", ">": ".+"}.get(t, re.escape(t)) for t in pattern.split(".")) + r"\z"


def _regex(pattern: Column) -> Column:
    quoted = lambda t: F.concat(F.lit(r"\Q"), F.replace(t, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    token = lambda t: F.when(t == "*", "[^.]+").when(t == ">", ".+").otherwise(quoted(t))
    return F.concat(F.lit(r"\A"), F.array_join(F.transform(F.split(pattern, r"\."), token), r"\."), F.lit(r"\z"))


def _wild(token: Column) -> Column:
    return token.isin("*", ">")


def _pattern_key(pattern: Column) -> Column:
    """Where a pattern is looked up: its plain prefix, else its first plain token and that token's place, else its length."""
    tokens = F.split(pattern, r"\.")
    first_wild = F.array_position(F.transform(tokens, _wild), True)  # from 1; 0: none
    prefix = F.slice(tokens, F.lit(1), F.when(first_wild == 0, F.size(tokens)).otherwise(first_wild.cast("int") - 1))
    first_plain = F.array_position(F.transform(tokens, _wild), False)
    place = F.concat_ws(":", first_plain - 1, F.get(tokens, first_plain.cast("int") - 1))
    length = F.concat(F.when(F.array_contains(tokens, ">"), "more:").otherwise("size:"), F.size(tokens).cast("string"))
    return F.when(F.size(prefix) > 0, F.concat(F.lit("begins:"), F.array_join(prefix, "."))).when((first_plain > 0) & ~F.array_contains(F.slice(tokens, 1, first_plain.cast("int")), ">"), F.concat(F.lit("at:"), place)).otherwise(length)


def _subject_keys(subject: Column) -> Column:
    """All keys under which a pattern that covers the subject may stand."""
    tokens = F.split(subject, r"\.")
    n = F.size(tokens)
    begins = F.transform(tokens, lambda _, i: F.concat(F.lit("begins:"), F.array_join(F.slice(tokens, F.lit(1), i + 1), ".")))
    places = F.transform(tokens, lambda t, i: F.concat(F.lit("at:"), F.concat_ws(":", i, t)))
    longer = F.transform(F.sequence(F.lit(1), n), lambda k: F.concat(F.lit("more:"), k.cast("string")))
    return F.concat(begins, places, longer, F.array(F.concat(F.lit("size:"), n.cast("string"))))


def subject_routes(messages: DataFrame, bindings: DataFrame) -> DataFrame:
    """(subject, stream): the least-named stream that covers each of the messages' subjects; uncovered ones are left out.

    Patterns meet distinct subjects only, and by equality: a pattern stands under
    one key (its longest plain prefix where it has one), a subject asks under the
    few keys that could cover it, and the expression confirms.  No side is
    broadcast by hand, and no pairing is made however many patterns begin with a
    wildcard.
    """
    rules = bindings.groupBy("pattern").agg(F.min("stream").alias("stream"))
    rules = rules.select("stream", _regex(F.col("pattern")).alias("_re"), _pattern_key(F.col("pattern")).alias("_k"))
    subjects = messages.select("subject").where("subject is not null").distinct()
    asked = subjects.select("subject", F.explode(F.array_distinct(_subject_keys(F.col("subject")))).alias("_key"))
    covered = asked.join(rules, (F.col("_key") == F.col("_k")) & F.expr("subject rlike _re"))
    return covered.groupBy("subject").agg(F.min("stream").alias("stream"))


def route_subjects(messages: DataFrame, bindings: DataFrame, routes: DataFrame | None = None) -> DataFrame:
    """Adds ``stream``: the least-named stream with a pattern that covers the subject, or null.

    ``routes``: what ``subject_routes`` gave, where it was written before; Spark
    then knows how few they are, and messages of one subject need not meet in one task.
    """
    # Dealt anew, the few routes let Spark split a subject that many messages share.
    routes = subject_routes(messages, bindings).repartition("subject") if routes is None else routes
    return messages.join(routes.withColumnRenamed("subject", "_s"), F.col("subject") == F.col("_s"), "left").drop("_s")


def check_expected_stream(routed: DataFrame, expected: str | None) -> DataFrame:
    """Adds ``route_error``: no stream covers the subject, or another than the expected one does."""
    error = F.when(F.col("stream").isNull(), "no stream covers the subject")
    if expected:
        error = error.when(F.col("stream") != expected, F.concat(F.lit("expected stream "), F.lit(expected), F.lit(", got "), F.col("stream")))
    return routed.withColumn("route_error", error)


def dedupe_window(messages: DataFrame, key: str, ts: str, row: str, window_seconds: int) -> DataFrame:
    """Rows kept when a key is accepted at most once in any ``window_seconds`` since its last accepted row.

    Ties go by ``row``.  Keys are read in stretches of time (see ``hops``), so a
    hot key's copies spread over many tasks; copies without a key are one key.
    """
    lean = messages.select(F.col(key).alias("_line"), F.col(row).alias("_row"), F.unix_micros(F.col(ts)).alias("_at"), F.lit(False).alias("_forced"), F.lit(NEVER).alias("_start"))
    kept = hops(lean, window_seconds * 1_000_000)
    return messages.join(kept, F.col(key).eqNullSafe(F.col("_line")) & (F.col(row) == F.col("_row")), "left_semi")


def live_messages(stored: DataFrame, as_of: Column) -> DataFrame:
    """Messages whose time to live has not lapsed; one is gone at exactly its end."""
    return stored.where(F.col("expires_at").isNull() | (F.col("expires_at") > as_of))
