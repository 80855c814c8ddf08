"""Fill-in-the-middle texts by relational units (operator 12).

A text is a row of units: a run of ASCII letters, or any other single code
point.  Where a text is cut is asked as "after so many units", and answered by
relations:

1. every text's stretches (``STRETCH`` units each) are exploded with their place,
   and a running sum of their lengths says where each begins;
2. cut requests join the stretch that holds their unit; its units are exploded,
   a running sum of their lengths says where each ends, and the request picks the
   unit of its ordinal;
3. offsets are aggregated to one row a document, which joins the text once more,
   and three substrings make the output.

Only lengths and the two asked stretches move between tasks in steps 1 and 2,
a few bytes for each ``STRETCH`` units; whole texts move once, in step 3.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outflow.llm.shared import identified

#: Units summed before they move.
STRETCH = 32
UNIT = "[A-Za-z]++|[^A-Za-z]"
#: Marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Of 100 texts: so many stay plain, and so many of the others put the suffix first.
PLAIN, SPM = 10, 20


def n_units(text: Column) -> Column:
    """How many units a text has: its code points once every run of letters is one."""
    return F.length(F.regexp_replace(text, "[A-Za-z]+", "a")).cast("long")


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four 32-bit numbers of a document, from the hash of ``seed:doc_id`` (a null id: of ``seed:``)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def requested(docs: DataFrame, marks: tuple[str, ...] = MARKS, plain: int = PLAIN, spm: int = SPM, seed: int = 1) -> DataFrame:
    """``docs`` with n, form, and the units after which prefix and middle end (null if plain)."""
    counted = docs.withColumn("n", n_units(F.col("text")))
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    bare = F.col("n") == 0
    for mark in marks:
        bare = bare | F.contains(F.col("text"), F.lit(mark))
    form = F.when(bare | (h3 % 100 >= 100 - plain), "plain").when(h4 % 100 < spm, "spm").otherwise("psm")
    counted = counted.withColumns({"form": form, "_one": h1 % (F.col("n") + 1), "_two": h2 % (F.col("n") + 1)})
    cut = lambda pick: F.when(F.col("form") != "plain", pick("_one", "_two"))
    return counted.withColumns({"prefix_units": cut(F.least), "middle_units": cut(F.greatest)}).drop("_one", "_two")


def offsets(cuts: DataFrame) -> DataFrame:
    """(_rid, prefix_end, middle_end) in code points; ``cuts``: _rid, text, prefix_units, middle_units."""
    cuts = cuts.where("middle_units is not null").select("_rid", "text", "prefix_units", "middle_units")
    # A cut after unit k lies in the stretch of unit k; stretches after the last cut aren't asked for.
    stretch_of = lambda k: F.floor((F.col(k) - 1) / STRETCH).cast("long")
    found = F.regexp_extract_all("text", F.lit(f"(?:{UNIT}){{1,{STRETCH}}}+"), F.lit(0))
    cut = cuts.select("_rid", stretch_of("prefix_units").alias("s1"), stretch_of("middle_units").alias("s2"), F.posexplode(found).alias("s", "stretch"))
    cut = cut.where("s <= s2").select("_rid", F.col("s").cast("long").alias("s"), F.length("stretch").cast("long").alias("chars"), F.when(F.col("s").isin(F.col("s1"), F.col("s2")), F.col("stretch")).alias("stretch"))
    before = F.sum("chars").over(W.partitionBy("_rid").orderBy("s").rowsBetween(W.unboundedPreceding, -1))
    running = cut.withColumn("before", F.coalesce(before, F.lit(0))).where("stretch is not null")
    asked = cuts.select(F.col("_rid").alias("r"), F.posexplode(F.array("prefix_units", "middle_units")).alias("which", "ordinal")).where("ordinal > 0")
    # By document alone and then by place, so that what lies dealt by document stays where it is.
    inside = (F.col("ordinal") > F.col("s") * STRETCH) & (F.col("ordinal") <= (F.col("s") + 1) * STRETCH)
    met = running.join(asked, (F.col("_rid") == F.col("r")) & inside)
    units = met.select("_rid", "which", "ordinal", "s", "before", F.posexplode(F.regexp_extract_all("stretch", F.lit(UNIT), F.lit(0))).alias("i", "unit"))
    end = F.col("before") + F.sum(F.length("unit")).over(W.partitionBy("_rid", "which").orderBy("i").rowsBetween(W.unboundedPreceding, 0))
    ends = units.withColumn("end", end).where(F.col("s") * STRETCH + F.col("i") + 1 == F.col("ordinal"))
    return ends.groupBy("_rid").agg(*[F.max(F.when(F.col("which") == k, F.col("end"))).alias(name) for k, name in enumerate(("prefix_end", "middle_end"))])


def _after(text: Column, mark: str) -> tuple[Column, Column]:
    """What stands before and after the first ``mark``."""
    place = F.instr(text, F.lit(mark))
    return F.substring(text, F.lit(1), place - 1), F.substring(text, place + len(mark), F.length(text))


def restored(output: Column, form: Column, marks: tuple[str, ...] = MARKS) -> Column:
    """The exact text again, read from an output and its form alone.

    Parts hold no mark and no mark begins inside another's end, so the first
    mark of each kind is the one that was put there.
    """
    p, s, m = marks
    prefix, rest = _after(F.substring(output, F.lit(len(p) + 1), F.length(output)), s)
    suffix, middle = _after(rest, m)
    psm = F.concat(prefix, middle, suffix)
    suffix, rest = _after(F.substring(output, F.lit(len(s) + 1), F.length(output)), p)
    prefix, middle = _after(rest, m)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)


def fill_in_middle(docs: DataFrame, marks: tuple[str, ...] = MARKS, plain: int = PLAIN, spm: int = SPM, seed: int = 1) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row.

    A null or empty text is plain with no units; so is a text that already holds
    a mark.  Repeated ids and rows stay, each cut alike; a null id draws as the
    empty id does.  An empty table gives no rows, other columns are ignored, and
    a text of any length is cut as a whole.  Marks must not overlap one another.
    """
    rows = identified(docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")), "text")
    cuts = requested(rows, marks, plain, spm, seed)
    found = offsets(cuts).withColumnRenamed("_rid", "r")
    joined = cuts.join(found, F.col("_rid") == F.col("r"), "left").drop("r", "_rid")
    text, form = F.col("text"), F.col("form")
    one, two = F.coalesce("prefix_end", F.lit(0)), F.coalesce("middle_end", F.lit(0))
    part = lambda a, b: F.substring(text, a.cast("int") + 1, (b - a).cast("int"))
    prefix, middle, suffix = part(F.lit(0), one), part(one, two), part(two, F.length(text))
    p, s, m = (F.lit(x) for x in marks)
    output = F.when(form == "psm", F.concat(p, prefix, s, suffix, m, middle)).when(form == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(text)
    length = lambda c: F.when(form != "plain", c.cast("long"))
    return joined.select("doc_id", "n", "form", length(one).alias("prefix_chars"), length(two - one).alias("middle_chars"), output.alias("output"))


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    made = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    sha = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


FILL_IN_MIDDLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || CAST(doc_id AS VARCHAR)) AS s FROM documents),
h AS (SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || s[1:8] AS BIGINT) AS h1, CAST('0x' || s[9:16] AS BIGINT) AS h2, CAST('0x' || s[17:24] AS BIGINT) AS h3, CAST('0x' || s[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END AS out FROM p)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(out) AS output_sha256, sha256(t) AS restored_sha256
FROM o
"""
