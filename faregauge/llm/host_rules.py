"""Quality rules per host: failure rates, shrunk, decide on all documents of a host.

A document fails a rule by its own counts. Rates of failure per host are shrunk towards
the mean of all hosts by a beta prior whose strength is fitted to the spread of the hosts,
so a host with three documents isn't condemned by two. A host whose shrunk rate exceeds
the limit of a rule loses all its documents.

Null and empty texts have no words and fail. A null host is a host of its own. Repeated
rows count as often as they occur and each gets its row. An empty table gives no rows.
Further columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregauge.llm.common import by_batch, prepare, stored, text_or_empty

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class HostLimits:
    """Least words and largest share of repeated words; per rule the largest host rate."""

    min_words: int = 50
    repeat_share: float = 0.5
    symbol_share: float = 0.1
    host_rates: dict[str, float] = field(
        default_factory=lambda: {"base": 0.5, "symbols": 0.5, "duplicate_lines": 0.9}
    )


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice in the text."""
    if len(words) < 4:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(names) + ids[1:], return_inverse=True)[1]
    _, group, sizes = np.unique(pairs[:-1] * len(names) + ids[2:], return_inverse=True, return_counts=True)
    again = sizes[group] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : len(words) - 2 + shift] |= again
    return int(covered.sum())


def text_counts(text: str) -> tuple[int, int, int, int, int]:
    """The five counts of one text, in the order of ``COUNTS``."""
    words = text.encode().split()  # bytes split at the six ASCII spaces and nothing else
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def _count_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = [text_counts(t) for t in batch.column("text").to_pylist()]
    counts = np.array(rows, np.int64).reshape(len(rows), len(COUNTS))
    columns = [pa.array(counts[:, i]) for i in range(len(COUNTS))]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("host"), *columns], ["doc_id", "host", *COUNTS]
    )


def document_counts(docs: DataFrame, host: str = "source") -> DataFrame:
    """(doc_id, host, counts) of every row; whole texts, no shuffle."""
    prepare(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long"), F.col(host).cast("string").alias("host"), text_or_empty().alias("text")
    )
    schema = "doc_id long, host string, " + ", ".join(f"{c} long" for c in COUNTS)
    return by_batch(rows, lambda: _count_batch, schema)


def rule_failures(limits: HostLimits) -> dict[str, Column]:
    """Per rule whether a document fails it."""
    return {
        "base": (F.col("n_words") < limits.min_words)
        | (F.col("n_repeat_words") > limits.repeat_share * F.col("n_words")),
        "symbols": F.col("n_symbols") > limits.symbol_share * F.col("n_words"),
        "duplicate_lines": F.col("n_dup_lines") > 0,
    }


def beta_prior(hosts: DataFrame, rules: list[str]) -> dict[str, tuple[float, float]]:
    """(alpha, beta) per rule by moments over hosts, each host weighted by its documents.

    The spread of host rates beyond what binomial noise explains sets the strength; hosts
    that don't differ get the strongest prior. One row of sums comes to the driver.
    """
    base = hosts.agg(F.sum("n").alias("n"), F.count("*").alias("hosts"), *[F.sum(r).alias(r) for r in rules]).first()
    if not base["n"]:
        return {r: (1.0, 1.0) for r in rules}
    means = {r: base[r] / base["n"] for r in rules}
    spread = hosts.agg(
        *[F.sum(F.col("n") * F.pow(F.col(r) / F.col("n") - F.lit(means[r]), 2)).alias(r) for r in rules]
    ).first()
    priors = {}
    for rule in rules:
        mean = min(max(means[rule], 1e-6), 1 - 1e-6)
        noise = mean * (1 - mean) * base["hosts"] / base["n"]
        between = max(spread[rule] / base["n"] - noise, 0.0)
        strength = min(max(mean * (1 - mean) / between - 1, 1.0), 1e4) if between > 0 else 1e4
        priors[rule] = (mean * strength, (1 - mean) * strength)
    return priors


def host_verdicts(counts: DataFrame, limits: HostLimits) -> DataFrame:
    """One row per host: documents, failures, shrunk rates and whether it is rejected.

    Documents are summed per host before the shuffle, so a host with a third of all rows
    sends one row from each task.
    """
    rules = list(limits.host_rates)
    failed = rule_failures(limits)
    hosts = counts.groupBy("host").agg(
        F.count("*").alias("n"), *[F.sum(failed[r].cast("long")).alias(r) for r in rules]
    )
    hosts = stored(hosts, "hosts")
    priors = beta_prior(hosts, rules)
    rates = {r: (F.col(r) + priors[r][0]) / (F.col("n") + sum(priors[r])) for r in rules}
    rejected = F.lit(False)
    for rule in rules:
        rejected = rejected | (rates[rule] > limits.host_rates[rule])
    return hosts.select("host", "n", *[rates[r].alias(f"{r}_rate") for r in rules], rejected.alias("rejected"))


def host_rules(docs: DataFrame, host: str = "source", limits: HostLimits | None = None) -> DataFrame:
    """Counts, own failure and the host's verdict for every document.

    The counts are stored, as the rates and the answer both read them: texts are parsed
    once. The join takes one row per host.
    """
    limits = limits or HostLimits()
    counts = stored(document_counts(docs, host), "counts")
    hosts = host_verdicts(counts, limits).select(F.col("host").alias("_host"), "rejected")
    joined = counts.join(hosts, F.col("host").eqNullSafe(F.col("_host")), "left").drop("_host")
    failed = rule_failures(limits)["base"]
    return joined.select(
        "doc_id",
        *COUNTS,
        failed.alias("base_failed"),
        (~failed & ~F.coalesce("rejected", F.lit(False))).alias("kept"),
        "host",
        F.coalesce("rejected", F.lit(False)).alias("host_rejected"),
    )
