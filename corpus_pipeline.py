"""The corpus pipeline: filters, near-duplicates, mixing and packing, one stage after the other.

The stages share their Python workers. Each sends few texts at a time to them (a setting of the
session that stays), and a worker drops the model of one stage when the next one uses it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import language, mixing, packing, simhash, toxicity
from tidemark.llm.common import few_rows_a_batch, split_of, table
from tidemark.session import pinned


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half stay.

    The model learns from the labels of the given tables, leaving out the held-out fifth. Null and
    empty texts trigger nothing and stay; without labels every document stays.
    """
    few_rows_a_batch(spark)
    labels = table(spark, sf_dir, "labels")
    return toxicity.clean(docs, toxicity.fit(docs, labels, split_of("doc_id", 5) != 0))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages stay.

    Languages are learned from the documents given, leaving out the held-out quarter. Texts that
    are null or have no letter go, and texts that no language codes better than chance.
    """
    few_rows_a_batch(spark)
    return language.recognised(docs, language.fit(docs, split_of("doc_id", 4) != 2))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each SimHash group stays.

    Rows that repeat an id are one document if they are in one group; rows without an id stay.
    """
    few_rows_a_batch(spark)
    return simhash.without_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of its source takes it.

    Sources share half again as many words as there are, so a document comes once, twice or not
    at all. Documents without words have no place in the mix.
    """
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document given; repeats are packed as often as they come."""
    few_rows_a_batch(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", known_language),
    ("near_duplicates", near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# SQL has no trained models, no XXH64 and no tokenizer; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in order; each reads what the one before it has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = pinned(stage(spark, docs, sf_dir), name)
    return docs
