"""Licence scan by canonical digests, in DataFrame operations only.

A text is normalised: lower case, copyright lines dropped, punctuation runs to
one space, equivalent spellings to one. Its SHA-256 is then joined with those
of known licences, normalised in the same way. Both units are entire texts: the
whole document, and each of its lines (notices that stand on a line of their
own).

Scale: one pass for the digests; the known table is broadcast only if small.
Line digests are joined before anything is grouped, so only matching lines are
shuffled, and at most one row per (document, licence) reaches a group.

A copyright line starts with "copyright", "(c)" or the sign, or is "all rights
reserved" alone. Null text and texts with nothing left have a null digest and no
licence. Repeated rows each get a row; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recsignals.llm.common import id_back, keyed, small_side, stage
from recsignals.llm.licence_texts import LICENCES, SPELLINGS

COPYRIGHT_LINE = r"(^|\n)[^\p{L}\p{N}\n]*(copyright|\(c\) |©|all rights reserved[^\p{L}\p{N}\n]*(\n|$))[^\n]*"


def canonical(rows: DataFrame, text_col: str, out: str) -> DataFrame:
    """Adds the normalised text; line ends stay. Each step is a column of its own, so no pattern runs twice."""
    rows = rows.withColumn(out, F.concat(F.lit("\n"), F.lower(text_col)))
    t = F.col(out)
    marked = t.contains("copyright") | t.contains("(c) ") | t.contains("©") | t.contains("all rights reserved")
    rows = rows.withColumn(out, F.when(marked, F.regexp_replace(t, COPYRIGHT_LINE, "$1")).otherwise(t))
    rows = rows.withColumn(out, F.regexp_replace(t, r"[^\p{L}\p{N}\n]+", " "))
    respelt = t
    for a, b in SPELLINGS:
        respelt = F.regexp_replace(respelt, rf"(?<![\p{{L}}\p{{N}}]){a}(?![\p{{L}}\p{{N}}])", b)
    first = F.array(*[F.lit(x) for x in sorted({a.split()[0] for a, _ in SPELLINGS})])
    return rows.withColumn(out, F.when(F.arrays_overlap(F.split(t, "[ \n]"), first), respelt).otherwise(t))


def whole(lines: Column) -> Column:
    """A normalised text on one line."""
    return F.trim(F.regexp_replace(lines, "[ \n]+", " "))


def digest(text: Column) -> Column:
    return F.when(text != "", F.sha2(text, 256))


def known_digests(spark: SparkSession, licences=LICENCES) -> DataFrame:
    known = canonical(spark.createDataFrame(licences, "licence string, body string"), "body", "lines").select(whole(F.col("lines")).alias("body"), "licence")
    return known.filter("body != ''").groupBy("body").agg(F.min("licence").alias("licence")).select(digest(F.col("body")).alias("digest"), "licence", F.length("body").alias("n"))


def scan(docs: DataFrame, licences=LICENCES, id_col="doc_id", text_col="text") -> DataFrame:
    """id, digest of the whole text, licence (of the whole text) and notices (sorted licences of single lines)."""
    known = stage(known_digests(docs.sparkSession, licences), "op8-known")
    lengths = [r["n"] for r in known.select("n").distinct().collect()]  # at most one per known licence
    known = small_side(known.drop("n"), 200)
    rows = canonical(keyed(docs, id_col, text_col), "text", "lines")
    # Equal digests mean equal texts, so a line of a length that no known text has needs no digest.
    lines = F.array_distinct(F.filter(F.transform(F.split("lines", "\n"), lambda x: F.trim(x)), lambda x: F.length(x).isin(lengths)))
    body = stage(rows.select("kid", "th", digest(whole(F.col("lines"))).alias("digest"), lines.alias("lines")), "op8-digests")
    single = body.select("kid", "th", F.explode("lines").alias("line")).select("kid", "th", digest(F.col("line")).alias("digest"))
    notices = single.join(known, "digest").groupBy("kid", "th").agg(F.array_sort(F.collect_set("licence")).alias("notices"))
    out = body.select("kid", "th", "digest").join(known, "digest", "left").join(notices, ["kid", "th"], "left")
    return out.select(id_back().alias(id_col), "digest", "licence", F.coalesce("notices", F.expr("cast(array() as array<string>)")).alias("notices"))
