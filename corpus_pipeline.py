"""Corpus clean-up over ``documents`` in five stages, each on all that the one before it kept.

1. toxicity: documents that the nearest labelled examples call toxic go.
2. jaccard_join: of texts linked by a shingle similarity of 0.75, one stays.
3. suffix_dedup: bytes that repeated strings of 200 bytes cover are cut out;
   a character of which only some bytes were cut goes whole. No document goes.
4. decontaminate: documents that hold a benchmark window of ten words go.
5. packing: what is left, as pieces in sequences of at most 2048 ids.

All but the last return the columns of their input, whatever their names. A null
text counts as empty, has no toxic neighbour, links with nothing, holds no benchmark
words and is packed as its end id alone; a null id is an id like any other. Of rows
that repeat id and text one stays. An empty table gives empty stages. No stage can be written in
SQL as a whole (nearest neighbours, byte-wise repeats, tokenizer), so there is
no ORACLE_SQL; tests/llm holds each stage against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsignals.llm import op01_packing, op04_suffix_dedup, op05_decontaminate, op06_toxicity, op09_jaccard_join
from recsignals.llm.common import stage, table, without
from recsignals.llm.tokens import default_vocabulary


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = op06_toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~op06_toxicity.held_out()))
    scored = op06_toxicity.score(docs, model)
    return without(docs, scored.filter("score >= 0.5"), "doc_id", "text")


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    members, _ = op09_jaccard_join.join(docs)
    return op09_jaccard_join.one_of_each(docs, members)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    inner = {c: f"__other{i}" for i, c in enumerate(c for c in docs.columns if c not in ("doc_id", "text"))}  # no clash with the operator's names
    found = op04_suffix_dedup.dedup(docs.select("doc_id", "text", *[docs[c].alias(n) for c, n in inner.items()]), extra=tuple(inner.values()), as_text=True)
    out = found.select("doc_id", F.col("kept").alias("text"), *[F.col(n).alias(c) for c, n in inner.items()])
    if "n_chars" in inner:
        out = out.withColumn("n_chars", F.length("text").cast(kinds["n_chars"]))
    return out.select([F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = op05_decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, found.filter(F.size("items") > 0), "doc_id", "text")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op01_packing.pack_documents(docs, default_vocabulary(), capacity=2048, end_id=0)


STAGES = [("toxicity", toxicity), ("jaccard_join", jaccard_join), ("suffix_dedup", suffix_dedup), ("decontaminate", decontaminate), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
