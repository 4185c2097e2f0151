"""The registered queries of the training-data operators and their SQL, as far as SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsignals.llm import op01_packing, op02_url_filter, op03_html, op04_suffix_dedup, op05_decontaminate, op06_toxicity, op07_quality, op08_licences, op09_jaccard_join, op10_repair, op11_vector_codes, op12_phrases, op13_bpe, oracles
from recsignals.llm.common import table
from recsignals.llm.tokens import default_vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_best_fit_packing(spark, sf_dir):
    """Every document in sequences of at most 2048 ids."""
    return op01_packing.pack_documents(table(spark, sf_dir, "documents"), default_vocabulary(), capacity=2048, end_id=0)


@query
def op10_token_store(spark, sf_dir):
    """Every document's ids, written as grammar shards and read back."""
    return op10_repair.store(table(spark, sf_dir, "documents"), default_vocabulary(), end_id=2)


# Host, path and verdict of the rules.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query
def op2_url_filter(spark, sf_dir):
    """The verdict on every page's url."""
    return op02_url_filter.apply_rules(table(spark, sf_dir, "pages"), URL_RULES, default="allow")


@query
def op5_decontaminate(spark, sf_dir):
    """Benchmark windows of ten words found in every document."""
    return op05_decontaminate.summary(op05_decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@query
def op7_quality_rules(spark, sf_dir):
    """Base counts and the divergence verdict of every document."""
    judged = op07_quality.judge(op07_quality.measures(table(spark, sf_dir, "documents")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op8_licence_scan(spark, sf_dir):
    """Whole-text digest, licence and licence notices of every document; notices comma-joined."""
    found = op08_licences.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "digest", "licence", F.array_join("notices", ",").alias("notices"))


@query
def op9_jaccard_join(spark, sf_dir):
    """The component of every document among texts with a shingle similarity of 0.75 or more."""
    members, _ = op09_jaccard_join.join(table(spark, sf_dir, "documents"))
    return op09_jaccard_join.summary(members)


@query
def op4_suffix_dedup(spark, sf_dir):
    """Bytes that repeated strings of 200 bytes cover, removed from every document."""
    return op04_suffix_dedup.summary(op04_suffix_dedup.dedup(table(spark, sf_dir, "documents")))


@query
def op6_toxicity(spark, sf_dir):
    """A toxicity score for every document, learnt from the labelled rows that aren't held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = op06_toxicity.fit(docs, labels.filter(~op06_toxicity.held_out()))
    scored = op06_toxicity.score(docs, model)
    return scored.select("doc_id", op06_toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op3_html_extraction(spark, sf_dir):
    """The main text of every page."""
    return op03_html.extract(table(spark, sf_dir, "pages"))


@query
def op11_vector_compression(spark, sf_dir):
    """Codes of every vector in eight parts, against codebooks of sixteen entries from six rounds."""
    return op11_vector_codes.codes(table(spark, sf_dir, "embeddings"))


@query
def op12_phrase_mining(spark, sf_dir):
    """The 2,000 strongest phrases of each language."""
    return op12_phrases.collocations(table(spark, sf_dir, "documents"))


@query
def op13_bpe_codec(spark, sf_dir):
    """Ids of every document and the text decoded from them, as digests."""
    return op13_bpe.round_trip(table(spark, sf_dir, "documents"), op13_bpe.default_vocabulary())


ORACLES |= {
    "op11_vector_compression": oracles.vector_codes(),
    "op12_phrase_mining": oracles.phrases(),
    "op2_url_filter": oracles.url_filter(URL_RULES, "allow"),
    "op5_decontaminate": oracles.DECONTAMINATE,
    "op7_quality_rules": oracles.quality(),
    "op9_jaccard_join": oracles.JACCARD,
}
