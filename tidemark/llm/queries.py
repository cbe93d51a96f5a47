"""Registered queries of the text operators: (function, SQL text or None) by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment,
    ann,
    embedding_dedup,
    html_text,
    language,
    mixing,
    packing,
    simhash,
    spelling,
    sql,
    token_counts,
    toxicity,
    url_rules,
    warc,
)
from tidemark.llm.common import is_split, split_of, table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate group of every vector."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = table(spark, sf_dir, "pages").select("page_id", "url", html_text.extract(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    counts = language.fit(docs, split_of("doc_id", 4) != 2)
    told = docs.select(
        "doc_id", is_split("doc_id", 4, 2).alias("held_out"), language.predict(F.col("text"), counts).alias("told")
    )
    return told.select("doc_id", "held_out", "told.lang_pred", "told.score")


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, longest fitting rule and verdict of every page."""
    rules = url_rules.rule_table(spark, url_rules.RULES)
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back."""
    records = warc.read(warc.write(table(spark, sf_dir, "pages")), keep_payload=False)
    return records.select(
        F.col("row_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from four fifths of the labels."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), split_of("doc_id", 5) != 0)
    scored = docs.select(
        "doc_id", is_split("doc_id", 5, 0).alias("held_out"), toxicity.score(F.col("text"), model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, target and words taken of every document in the mix."""
    taken = mixing.taken_words(mixing.mix(table(spark, sf_dir, "documents")))
    return taken.select(F.col("row_id").alias("doc_id"), "size", "source_size", "target", "taken")


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of at most 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, root and near words of every longer word of the documents."""
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it exceeds 1024 tokens."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op13_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tokenizers' tokens of every document, aligned, with corpus-wide counts of the links."""
    return alignment.align_tokens(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_simhash": (op1_simhash, None),
    "op2_embedding_dedup": (op2_embedding_dedup, None),
    "op3_ann": (op3_ann, None),
    "op4_html_text": (op4_html_text, None),
    "op5_language": (op5_language, None),
    "op6_url_rules": (op6_url_rules, sql.URL_RULES),
    "op7_warc": (op7_warc, sql.WARC),
    "op8_toxicity": (op8_toxicity, None),
    "op9_mix": (op9_mix, sql.MIX),
    "op10_pack": (op10_pack, None),
    "op11_spelling_variants": (op11_spelling_variants, None),
    "op12_token_counts": (op12_token_counts, None),
    "op13_align_tokens": (op13_align_tokens, None),
}
