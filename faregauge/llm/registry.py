"""Queries of the operators of this folder, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faregauge.llm import bpe, host_rules, html_text, manifest, merkle, mixing, near_dedup, pii, prefix_trie, quality
from faregauge.llm import sharding, token_files, toxicity
from faregauge.llm.common import scratch, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category, probability and decision of every document after raking."""
    chosen = mixing.mixed(table(spark, sf_dir, "documents"))
    return chosen.withColumn("probability", F.round("probability", 6))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every text by sizes under a dictionary of good and one of bad text."""
    docs = table(spark, sf_dir, "documents")
    return quality.quality(docs, quality.trained(docs, table(spark, sf_dir, "labels")))


def op3_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle fingerprint of every text and of its edited form, with likenesses."""
    return merkle.fingerprints(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every text by sizes under a toxic and an ordinary dictionary."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.trained(docs, table(spark, sf_dir, "labels")))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents written as Parquet in doc_id order and read back."""
    path = scratch(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_files.token_digests(token_files.read_tokens(spark, path))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page, laid out."""
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and verdict of the host for every document."""
    return host_rules.host_rules(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded by speculation and decoded again."""
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every text: base rules, and candidates the trees accept."""
    docs = table(spark, sf_dir, "documents")
    return pii.personal_data(docs, pii.trained(docs))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near copies of every document, and which row of the class stays."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root, proof and check of every document."""
    return manifest.manifest(table(spark, sf_dir, "documents"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt into eight shards of equal counts, written and read back."""
    return sharding.shard_digests(sharding.sharded(table(spark, sf_dir, "documents")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Query]:
    return {name: call for name, call in globals().items() if name.startswith("op") and name[2].isdigit()}
