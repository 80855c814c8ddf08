"""Personal data: patterns propose, checksums confirm, context scores (operator 8).

DataFrame expressions only.  The patterns are written so that every search is
linear in the text: a run of letters is entered at its start or where the last
match ended, and repeats give nothing back where giving back can't help.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outflow.llm import spans as sp

EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])"
NATIONAL = r"(?<![0-9-])(?!000|666|9[0-9]{2})[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national")
#: Words that raise a span's score when they stand within CONTEXT characters before it.
CONTEXT_WORDS = {
    "email": "mail|contact|write|reach",
    "ip": "ip|address|host|server|login",
    "card": "card|visa|credit|debit|payment|pay",
    "phone": "phone|call|tel|mobile|cell|fax",
    "iban": "iban|account|bank|transfer",
    "national": "ssn|social|security|insurance|tax|id",
}
#: Score of a confirmed pattern, and what a context word adds.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "national": 0.3}
CONTEXT, BONUS, ACCEPT = 40, 0.3, 0.5


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.struct(d.cast("int").alias("d"), i.alias("i")))
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    total = F.aggregate(each, F.lit(0), lambda acc, x: acc + F.when(x["i"] % 2 == 1, doubled(x["d"])).otherwise(x["d"]))
    return total % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an account number passes the mod-97 check (letters count 10 to 35)."""
    bare = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(bare, 5, 100), F.substring(bare, 1, 4))
    number = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda acc, c: F.when(number(c) > 9, (acc * 100 + number(c)) % 97).otherwise((acc * 10 + number(c)) % 97).cast("int"),
    )
    return rest == 1


def _confirmed(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "ip":
        return value.rlike(r"\A(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.|\z)){4}\z")
    if kind == "card":
        return F.when(n.between(12, 19), luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    if kind == "iban":
        return F.length(F.regexp_replace(value, " ", "")).between(15, 34) & mod97(value)
    return F.lit(True)


def _keep_confirmed(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: _confirmed(kind, s["value"]))


PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "iban": IBAN, "national": NATIONAL}
#: A cheap test that every match of a kind passes.
HINTS = {"email": lambda t: F.contains(t, F.lit("@")), "phone": lambda t: F.contains(t, F.lit("+"))}


def find_pii(docs: DataFrame) -> DataFrame:
    """Adds ``base`` and ``pii`` to the rows: spans (start, end, kind, value[, score]).

    ``base``: confirmed e-mail, IP, card and phone spans.  ``pii``: these plus
    account numbers that pass mod-97 and national ids that a context word
    supports, with a score from 0 to 1.  A null text has no spans; every other
    column stays as it is (but columns named base or pii, which these replace),
    and rows are neither merged nor dropped: repeated rows and null ids stay, an
    empty table gives none, and texts are searched whole, however long.
    """
    taken = set(docs.columns)
    name = lambda x: x if x not in taken else name("_" + x)
    text = name("_text")
    out = docs.withColumn(text, F.coalesce(F.col("text"), F.lit("")))
    has_digit = name("_digit")
    out = out.withColumn(has_digit, F.col(text).rlike("[0-9]"))
    hit = {k: name(f"_hit_{k}") for k in KINDS}
    for kind in KINDS:
        hint = HINTS[kind](F.col(text)) if kind in HINTS else F.col(has_digit)
        out = out.withColumn(hit[kind], sp.matches(F.col(text), PATTERNS[kind], hint))
    found = {k: name(f"_span_{k}") for k in KINDS}
    for kind in KINDS:
        placed = sp.placed(F.col(text), F.col(hit[kind]), PATTERNS[kind], kind)
        out = out.withColumn(found[kind], _keep_confirmed(placed, kind))
    out = out.withColumn("base", sp.ordered(F.concat(*[F.col(found[k]) for k in BASE_KINDS]), KINDS))
    every = sp.ordered(F.concat(*[F.col(found[k]) for k in KINDS]), KINDS)

    def scored(s: Column) -> Column:
        before = F.lower(F.substring(F.col(text), F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT))))
        score = F.lit(0.0)
        for kind in KINDS:
            near = F.when(before.rlike(rf"(?:\A|[^a-z])(?:{CONTEXT_WORDS[kind]})"), BONUS).otherwise(0.0)
            score = F.when(s["kind"] == kind, F.least(F.lit(1.0), F.lit(SCORES[kind]) + near)).otherwise(score)
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value"), score.alias("score"))

    keep = lambda s: s["kind"].isin(*BASE_KINDS) | (s["score"] >= ACCEPT)
    out = out.withColumn("pii", F.filter(F.transform(every, scored), keep))
    return out.drop(text, has_digit, *hit.values(), *found.values())


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets, n_chars following.

    Overlapping spans become one mark, of the first.  Null texts stay null.
    Columns stay as they are, whatever their names.
    """
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"]
    marked = find_pii(docs.select("text", F.struct(*others).alias("row")))

    def step(acc: Column, s: Column) -> Column:
        text = F.col("text")
        fresh = s["start"] >= acc["at"]
        piece = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("<"), s["kind"], F.lit(">")))
        return F.struct(F.when(fresh, s["end"]).otherwise(F.greatest(acc["at"], s["end"])).alias("at"), F.when(fresh, piece).otherwise(acc["out"]).alias("out"))

    done = F.aggregate("pii", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    tail = lambda d: F.concat(d["out"], F.substring(F.col("text"), d["at"] + 1, F.length("text")))
    out = marked.withColumn("_done", F.when(F.size("pii") > 0, done)).withColumn("text", F.when(F.col("_done").isNull(), F.col("text")).otherwise(tail(F.col("_done"))))
    shown = {"text": F.col("text")} | {c: F.col(f"row.c{i}") for i, c in enumerate(docs.columns) if c != "text"}
    if "n_chars" in shown:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        shown["n_chars"] = F.when(F.col("_done").isNull(), shown["n_chars"]).otherwise(counted)
    return out.select(*[shown[c].alias(c) for c in docs.columns])


def op8_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_pii(docs)
    counts = [sp.of_kind(F.col("base"), k).alias(f"n_{k}") for k in BASE_KINDS]
    likely = F.size(F.filter("pii", lambda s: s["score"] >= 0.9)).cast("long").alias("n_certain")
    return found.select("doc_id", *counts, sp.digest(sp.as_text(F.col("base"))).alias("base_sha256"), sp.as_text(F.col("pii")).alias("spans"), likely)
