"""Quality rules: base counts and Jensen-Shannon divergence from language references, in DataFrame operations only.

A document's character classes (letters and digits, capitals, white space,
punctuation, symbols) and its common words (the eight most common words of each
reference language, and all others) make two histograms. Each is compared with
every language's reference by Jensen-Shannon divergence (base 2, 0 to 1), and
the nearest language counts. Length guards keep chance out: below
``min_words_chars`` or ``min_words_words`` words a histogram is not judged, and
the limits are wider by ``short`` / words and ``short_words`` / words. A text
without any common word has the divergence ``NO_COMMON_WORD``; the limit for
words is below it at every judged length, so word salad, keyword lists and texts
in no reference language fail. Digits count as letters: numbers, dates and
identifiers in good prose are no sign of junk.

Scale: one pass, no shuffle, no Python. All array work inside a row is by
hashing or sorting, so very long texts stay n log n.

Null text has no words and fails the base rule. Repeated rows each get a row;
extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Shares of letters with digits, capitals, white space, punctuation and symbols in running prose.
CHAR_CLASSES = [0.798, 0.014, 0.164, 0.0235, 0.0005]
# Common words of each reference language in order of frequency, and the share of all words at each rank.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "a", "in", "is", "that"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se"],
}
RANK_SHARES = [0.055, 0.029, 0.023, 0.017, 0.014, 0.0115, 0.0105, 0.009]
# Word divergence of a text that holds none of a language's common words.
NO_COMMON_WORD = 0.5 * (sum(RANK_SHARES) + math.log2(2 / (2 - sum(RANK_SHARES))) + (1 - sum(RANK_SHARES)) * math.log2(2 * (1 - sum(RANK_SHARES)) / (2 - sum(RANK_SHARES))))
SPACE = " \t\n\u000b\f\r"


def _divergence(counts: list[Column], total: Column, shares: list[float]) -> Column:
    """Jensen-Shannon divergence of a histogram from fixed shares."""
    out = F.lit(0.0)
    for c, q in zip(counts, shares):
        p = c / total
        out = out + F.when(p > 0, 0.5 * p * F.log2(2 * p / (p + F.lit(q)))).otherwise(0.0) + 0.5 * q * F.log2(F.lit(2 * q) / (p + F.lit(q)))
    return out


def measures(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """id, the base counts and both divergences (null below the length guards' one word)."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    kept = lambda chars: F.octet_length(F.regexp_replace("text", f"[^{chars}]+", "")).cast("long")
    known = sorted({w for words in COMMON_WORDS.values() for w in words})
    long_word = max(map(len, known))
    split = docs.select(docs[id_col].alias(id_col), text.alias("text")).select(id_col, "text", F.filter(F.split("text", r"[ \t-\r]+"), lambda w: w != "").alias("words"), F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^ \t-\r]")).alias("lines"))
    n = F.size("words")
    counted = split.select(
        id_col,
        n.cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda acc, w: acc + F.length(w)).alias("word_chars"),
        F.length("text").cast("long").alias("n_chars"),
        kept(r"#*$%&|<>").alias("n_symbols"),
        kept("A-Z").alias("n_capitals"),
        kept(r"!-/:-@\[-`{-~").alias("n_marks"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.concat(F.lit(" "), F.array_join(F.filter("words", lambda w: (F.length(w) <= long_word) & F.lower(w).isin(known)), "  "), F.lit(" ")).alias("common"),
        F.when(n >= 5, F.transform(F.sequence(F.lit(0), n - 5), lambda i: F.xxhash64(*[F.get("words", i + j) for j in range(5)]))).otherwise(F.expr("cast(array() as array<bigint>)")).alias("windows"),
    )
    # Only texts with a repeated window sort theirs: equal ones become neighbours, then their places in order tell the words covered.
    ordered = counted.withColumn("common", F.lower("common")).withColumn(
        "ordered",
        F.when(F.size("windows") > F.size(F.array_distinct("windows")), F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(F.expr("cast(array() as array<struct<h:bigint,i:int>>)")),
    ).drop("windows")
    found = F.filter("ordered", lambda x, j: (x["h"] == F.get("ordered", j - 1)["h"]) | (x["h"] == F.get("ordered", j + 1)["h"]))
    placed = ordered.withColumn("places", F.sort_array(F.transform(found, lambda x: x["i"]))).drop("ordered")
    covered = F.aggregate("places", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-5).alias("last")), lambda a, i: F.struct((a["n"] + F.least(F.lit(5), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])
    count = lambda w: ((F.octet_length("common") - F.octet_length(F.replace(F.col("common"), F.lit(f" {w} "), F.lit("")))) / (len(w.encode()) + 2))
    base = placed.select("*", covered.alias("n_repeat_words"), *[count(w).alias(f"w_{w}") for w in known])
    total = F.nullif(F.col("n_chars"), F.lit(0)).cast("double")
    classes = [F.col("word_chars") - F.col("n_capitals") - F.col("n_marks"), F.col("n_capitals"), F.col("n_chars") - F.col("word_chars"), F.col("n_marks") - F.col("n_symbols"), F.col("n_symbols")]
    words = F.nullif(F.col("n_words"), F.lit(0)).cast("double")
    by_language = []
    for own in COMMON_WORDS.values():
        cols = [F.col(f"w_{w}") for w in own]
        by_language.append(_divergence([*cols, F.col("n_words") - sum(cols[1:], cols[0])], words, [*RANK_SHARES, 1 - sum(RANK_SHARES)]))
    return base.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", _divergence(classes, total, CHAR_CLASSES).alias("char_divergence"), F.least(*by_language).alias("word_divergence"))


def judge(measured: DataFrame, max_chars=0.025, max_words=NO_COMMON_WORD / 2, min_words_chars=10, min_words_words=60, short=0.3, short_words=25 * NO_COMMON_WORD) -> DataFrame:
    """Adds base_failed and kept."""
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    words = F.nullif(F.col("n_words"), F.lit(0))
    odd = (F.col("n_words") >= min_words_chars) & (F.col("char_divergence") > max_chars + short / words) | (F.col("n_words") >= min_words_words) & (F.col("word_divergence") > max_words + short_words / words)
    return measured.withColumn("base_failed", base).withColumn("kept", ~base & ~F.coalesce(odd, F.lit(False)))
