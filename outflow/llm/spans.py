"""Places of pattern matches inside a text, in DataFrame expressions only.

A text split at a pattern's matches and the matches themselves interleave, so
running lengths give every match's place in code points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,kind:string,value:string>>"


def none() -> Column:
    return F.array().cast(SPAN)


def matches(text: Column, pattern: str, hint: Column | None = None) -> Column:
    """All leftmost non-overlapping matches; a row whose ``hint`` is false is not searched."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return found if hint is None else F.when(hint, found).otherwise(F.array().cast("array<string>"))


def placed(text: Column, hits: Column, pattern: str, kind: str) -> Column:
    """``hits`` of ``pattern`` in ``text`` with start, end (code points, end exclusive)."""
    start = (F.lit(0).alias("at"), none().alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        a = acc["at"] + F.length(pair["gap"])
        z = a + F.length(pair["hit"])
        span = F.struct(a.alias("start"), z.alias("end"), F.lit(kind).alias("kind"), pair["hit"].alias("value"))
        return F.struct(z.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
    pairs = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"))
    return F.when(F.size(hits) > 0, F.aggregate(pairs, F.struct(*start), step)["out"]).otherwise(none())


def ordered(spans: Column, kinds: tuple[str, ...]) -> Column:
    """Spans by start, then by the kinds' order, then by end."""
    rank = F.create_map(*[x for i, k in enumerate(kinds) for x in (F.lit(k), F.lit(i))])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s.alias("span")))
    return F.transform(F.array_sort(keyed), lambda k: k["span"])


def as_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def of_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
