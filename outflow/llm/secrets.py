"""Secret scans weighed by who owns each candidate across the corpus (operator 9).

DataFrame expressions only.  Candidates found by pattern are grouped by a hash
of their value, and the distinct owners and repositories that hold it are
counted over the whole corpus.  Every span gets a class:

* ``example``: three owners or more have the value, or two in four repositories
  or more: it was copied widely;
* ``live``: one owner alone has it, in at most two repositories, and it looks
  random: a credential of that owner;
* ``spread``: one owner alone has it, but in three repositories or more: the
  owner's own template or shared fixture, or a credential used in many places;
* ``plain``: the rest (too plain to be a secret, or between the bounds).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outflow.llm import spans as sp
from outflow.llm.shared import identified, staged

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
JWT = r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"
KEY = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
FORGE = r"(?<![A-Za-z0-9_])gh[opsru]_[A-Za-z0-9]{30,}+"

BASE_KINDS = ("assign", "access", "hex")
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "jwt": JWT, "key": KEY, "forge": FORGE}
KINDS = tuple(PATTERNS)
HINTS = {
    "assign": lambda t: F.contains(t, F.lit("=")) | F.contains(t, F.lit(":")),
    "access": lambda t: F.contains(t, F.lit("AKIA")),
    "jwt": lambda t: F.contains(t, F.lit("eyJ")),
    "key": lambda t: F.contains(t, F.lit("PRIVATE KEY")),
    "forge": lambda t: F.contains(t, F.lit("gh")),
}
#: A value under this many owners or more is a copied example; under two, this many repositories make it one.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 3, 4
#: A live value is in this many repositories of its one owner at most.
LIVE_REPOSITORIES = 2
CLASSES = ("example", "live", "spread", "plain")
#: Distinct characters that a live-looking value has at least.
VARIED = 8


def _value(span: Column) -> Column:
    """The secret itself: for an assignment, what is assigned."""
    return F.when(span["kind"] == "assign", F.regexp_extract(span["value"], ASSIGN, 2)).otherwise(span["value"])


def find_secrets(rows: DataFrame) -> DataFrame:
    """(all columns but text, base, found): spans by pattern, base ones apart."""
    out = rows.withColumn("text", F.coalesce(F.col("text"), F.lit("")))
    for kind in KINDS:
        hint = HINTS[kind](F.col("text")) if kind in HINTS else None
        out = out.withColumn(f"_hit_{kind}", sp.matches(F.col("text"), PATTERNS[kind], hint))
    for kind in KINDS:
        placed = sp.placed(F.col("text"), F.col(f"_hit_{kind}"), PATTERNS[kind], kind)
        if kind == "assign":
            placed = F.filter(placed, lambda s: F.length(_value(s)) >= 6)
        out = out.withColumn(f"_span_{kind}", placed)
    out = out.withColumn("base", sp.ordered(F.concat(*[F.col(f"_span_{k}") for k in BASE_KINDS]), KINDS))
    out = out.withColumn("found", sp.ordered(F.concat(*[F.col(f"_span_{k}") for k in KINDS]), KINDS))
    return out.drop("text", *[f"_hit_{k}" for k in KINDS], *[f"_span_{k}" for k in KINDS])


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, n_repositories, n_owners): both distinct counts in two partial aggregates.

    A value copied a million times shrinks to one row per owner and repository
    before anything meets on its hash alone.
    """
    pairs = candidates.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    owners = pairs.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("r"), F.sum("n").alias("n"))
    return owners.groupBy("hash").agg(F.sum("r").alias("n_repositories"), F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_places"))


def value_class(varied: Column, example_owners: int = EXAMPLE_OWNERS) -> Column:
    """Class of a value from ``n_owners`` and ``n_repositories``."""
    owners, repositories = F.col("n_owners"), F.col("n_repositories")
    copied = (owners >= example_owners) | ((owners == 2) & (repositories >= EXAMPLE_REPOSITORIES))
    return F.when(copied, "example").when((owners == 1) & (repositories > LIVE_REPOSITORIES), "spread").when((owners == 1) & varied, "live").otherwise("plain")


def scan_secrets(docs: DataFrame, owner: str = "source", repository: tuple[str, ...] = ("source", "lang"), example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """(doc_id, base, found, classes, n_live, n_example, n_spread) of every row.

    ``owner`` and ``repository`` name the columns that say whose a document is;
    nulls there are one unknown owner.  ``classes`` holds the class of each
    span of ``found``, in its order.  A null or empty text has no spans;
    repeated and null ids keep their rows, an empty table gives none, other
    columns are ignored whatever their names, and texts of any length are read
    whole.
    """
    rows = identified(docs, "text", *dict.fromkeys([owner, *repository]))
    missing = F.lit("?")
    name = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), missing) for c in repository])
    scanned = staged(
        find_secrets(rows.select("_rid", "doc_id", "text", F.coalesce(F.col(owner).cast("string"), missing).alias("owner"), name.alias("repository"))), "secrets"
    )
    each = scanned.select("_rid", "owner", "repository", F.posexplode("found").alias("place", "span")).withColumn("value", _value(F.col("span")))
    varied = F.size(F.array_distinct(F.split("value", ""))) >= VARIED
    candidates = each.select("_rid", "owner", "repository", "place", F.xxhash64("value").alias("hash"), varied.alias("varied"))
    # Staged, the counts meet the candidates in a plain join, whose hot values Spark can split.
    owned = staged(ownership(candidates), "owners").withColumnRenamed("hash", "h")
    judged = candidates.join(owned, candidates["hash"] == owned["h"]).select("_rid", F.struct("place", value_class(F.col("varied"), example_owners).alias("class")).alias("c"))
    per_doc = judged.groupBy("_rid").agg(F.transform(F.array_sort(F.collect_list("c")), lambda c: c["class"]).alias("classes")).withColumnRenamed("_rid", "r")
    joined = scanned.join(per_doc, scanned["_rid"] == per_doc["r"], "left").withColumn("classes", F.coalesce("classes", F.array().cast("array<string>")))
    count = lambda k: F.size(F.filter("classes", lambda c: c == k)).cast("long").alias(f"n_{k}")
    return joined.select("doc_id", "base", "found", "classes", count("live"), count("example"), count("spread"))


def op9_secrets(spark, sf_dir: str) -> DataFrame:
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    counts = [sp.of_kind(F.col("base"), k).alias(f"n_{k}") for k in BASE_KINDS]
    text = sp.as_text(F.col("found")).alias("spans")
    return found.select("doc_id", *counts, sp.digest(sp.as_text(F.col("base"))).alias("base_sha256"), text, F.array_join("classes", ",").alias("classes"), "n_live", "n_example", "n_spread")
