"""A corpus from documents to token ids: five stages, each an operator of faregauge.llm.

Every stage takes what the one before kept, from Parquet, and all but the last return the
columns of documents. Each stage's module says what it does with nulls, empty and very long
texts, repeated rows and empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faregauge.llm import bpe, mixing, near_dedup, pii, toxicity
from faregauge.llm.common import prepare, stored, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, doesn't call toxic."""
    prepare(spark)
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near copies."""
    prepare(spark)
    return near_dedup.keep_one(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked."""
    prepare(spark)
    return pii.redacted(docs, pii.trained(docs))


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics meet their target shares."""
    prepare(spark)
    return mixing.sampled(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text): the ids of every text and what they decode to."""
    prepare(spark)
    decoded = bpe.encode_decode(docs)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "text")


STAGES = [
    ("toxicity", without_toxic),
    ("near_dedup", one_of_each),
    ("pii", without_personal_data),
    ("mixing", to_target_weights),
    ("bpe", to_tokens),
]

# Classifiers, signatures and merges aren't SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
