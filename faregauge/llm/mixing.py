"""Mixing sources to target weights: iterative proportional fitting and sampling.

Documents are summed to cells of source, language and topic. Raking multiplies the cells'
token weights in turn so that the sums per source, per language and per topic meet their
targets; after some sweeps all three hold at once. A cell's weight against its tokens gives
the probability with which its documents are kept, and a hash of the id decides.

Targets are tables of shares. ``tempered`` makes them from the corpus itself: share in
proportion to tokens to a power below one, which lifts what is rare. A category without a
target keeps its tokens' share, and targets of absent categories are spread over the rest.

A topic is a vocabulary bucket: the word with the least md5 stands for a text, so texts
that share most words mostly share the topic. Texts without words have topic 'none', no
tokens and the probability of their cell. A null source, language or id counts as ''. Rows
with equal ids are kept or dropped together. An empty table gives no rows. ``sampled``
returns all columns as they are, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregauge.llm.common import prepare, stored, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
TOPICS = 4
DIMENSIONS = ("source", "lang", "topic")
_OWN = "_mix_"


@dataclass(frozen=True)
class MixRule:
    """Powers of the tempered targets, sweeps, share of tokens to keep, seed of the draw.

    ``whole_targets`` lowers the share until no cell needs its documents more than once.
    """

    powers: dict[str, float] = field(default_factory=lambda: {"source": 0.7, "lang": 0.8, "topic": 0.5})
    sweeps: int = 8
    share: float = 0.8
    seed: int = 7
    whole_targets: bool = False


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def topic(words: Column) -> Column:
    """Bucket of the word with the least md5."""
    least = F.array_min(F.transform(words, lambda w: F.md5(w)))
    bucket = (F.instr(F.lit("0123456789abcdef"), F.substring(least, 32, 1)) - 1) % TOPICS
    return F.coalesce(F.concat(F.lit("t"), bucket.cast("string")), F.lit("none"))


def draw(seed: int, name: str = "doc_id") -> Column:
    """Uniform in [0, 1) from the id: the first 48 bits of an md5."""
    key = F.concat(F.coalesce(F.col(name).cast("string"), F.lit("")), F.lit(f"|{seed}"))
    return F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def described(docs: DataFrame) -> DataFrame:
    """``docs`` with source, language, topic and tokens under names of their own."""
    words = docs.withColumn(f"{_OWN}words", _words(text_or_empty()))
    made = {f"{_OWN}{c}": F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("source", "lang")}
    made[f"{_OWN}topic"] = topic(F.col(f"{_OWN}words"))
    made[f"{_OWN}tokens"] = F.size(f"{_OWN}words").cast("long")
    return words.withColumns(made).drop(f"{_OWN}words")


def cells_of(rows: DataFrame) -> DataFrame:
    """Tokens per cell; a source with a third of all rows sends one row per task and cell."""
    keys = [F.col(f"{_OWN}{d}").alias(d) for d in DIMENSIONS]
    return rows.groupBy(*keys).agg(F.count("*").alias("docs"), F.sum(f"{_OWN}tokens").cast("double").alias("tokens"))


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """(category, share) with shares in proportion to tokens to ``power``."""
    sums = cells.groupBy(dimension).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("mass")).where("mass > 0")
    total = sums.agg(F.sum("mass")).first()[0] or 1.0
    return sums.select(F.col(dimension), (F.col("mass") / total).alias("share"))


def raked(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int) -> DataFrame:
    """Cells with ``weight``: tokens fitted to the targets of every dimension in turn.

    Each step sums the weights per category, which is partial before its shuffle, and joins
    the factors back. Every sweep is stored, so plans stay short. Only cells move here, and
    their number doesn't grow with the documents of a cell.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0.0
    now = stored(cells.withColumn("weight", F.col("tokens")), "cells")
    factors = {}
    for dimension, target in targets.items():
        present = now.where("tokens > 0").select(dimension).distinct()
        known = stored(present.join(target, dimension, "left"), "targets")
        # Shares of categories that are there, with or without a target, add up to one.
        own = now.groupBy(dimension).agg((F.sum("tokens") / F.lit(max(total, 1.0))).alias("own"))
        filled = known.join(own, dimension).select(dimension, F.coalesce("share", "own").alias("share"))
        mass = filled.agg(F.sum("share")).first()[0] or 1.0
        factors[dimension] = stored(filled.select(dimension, (F.col("share") * total / mass).alias("goal")), "targets")
    for _ in range(sweeps):
        for dimension, goals in factors.items():
            sums = now.groupBy(dimension).agg(F.sum("weight").alias("sum"))
            ratio = sums.join(goals, dimension).where("sum > 0").select(dimension, (F.col("goal") / F.col("sum")).alias("ratio"))
            now = now.join(ratio, dimension, "left").withColumn(
                "weight", F.col("weight") * F.coalesce("ratio", F.lit(1.0))
            ).drop("ratio")
        now = stored(now, "cells")
    return now


def probabilities(rows: DataFrame, rule: MixRule, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """(source, lang, topic, probability) per cell of described rows.

    The probability is the weight per token times the share to keep, at most 1: cells that
    would need their documents more than once are taken whole, and what they lack is missing
    from the targets. With ``rule.whole_targets`` the share is lowered to what the hottest
    cell can give, so that the kept tokens meet the targets as the weights do.
    """
    cells = stored(cells_of(rows), "cells")
    targets = targets or {d: tempered(cells, d, p) for d, p in rule.powers.items()}
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(F.lit(1.0))
    fitted = raked(cells, targets, rule.sweeps)
    share = rule.share
    if rule.whole_targets:
        hottest = fitted.where("tokens > 0").agg(F.max(F.col("weight") / F.col("tokens"))).first()[0]
        share = min(share, 1 / hottest) if hottest else share
    return fitted.select(*DIMENSIONS, F.least(ratio * F.lit(share), F.lit(1.0)).alias("probability"))


def _joined(rows: DataFrame, cells: DataFrame) -> DataFrame:
    renamed = cells.select(*[F.col(d).alias(f"{_OWN}{d}") for d in DIMENSIONS], F.col("probability").alias(f"{_OWN}p"))
    return rows.join(renamed, [f"{_OWN}{d}" for d in DIMENSIONS])


def mixed(docs: DataFrame, rule: MixRule | None = None, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """Category, tokens, probability and decision of every document."""
    rule = rule or MixRule()
    prepare(docs.sparkSession)
    rows = described(docs.select("doc_id", "text", "source", "lang")).drop("text", "source", "lang")
    rows = stored(rows, "described")
    chosen = _joined(rows, probabilities(rows, rule, targets))
    return chosen.select(
        "doc_id",
        *[F.col(f"{_OWN}{c}").alias(c) for c in (*DIMENSIONS, "tokens")],
        F.col(f"{_OWN}p").alias("probability"),
        (draw(rule.seed) < F.col(f"{_OWN}p")).alias("kept"),
    )


def sampled(docs: DataFrame, rule: MixRule | None = None, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """The documents that the draw keeps, all columns as they are.

    Categories are computed a second time instead of carrying texts through a shuffle.
    """
    rule = rule or MixRule()
    prepare(docs.sparkSession)
    cells = probabilities(described(docs.select("doc_id", "text", "source", "lang")), rule, targets)
    chosen = _joined(described(docs), cells).where(draw(rule.seed) < F.col(f"{_OWN}p"))
    return chosen.select(*docs.columns)
