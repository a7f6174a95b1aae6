"""Documents dealt into shards as by one uniform permutation, with exact shard sizes.

The input's files are the partitions of the sender. A hypergeometric draw with fixed
margins says how many rows of each file go to each shard (the communication matrix): what a
uniform permutation of all rows would give. Inside a file the matrix row is drawn further
into segments, and the labels of a segment are permuted, so a row knows its shard from its
file and its place there alone. Rows are then exchanged once and permuted again by a keyed
hash inside their shard. A shard is exchanged in chunks of the hash's range, so none of its
tasks has to hold it. Shard sizes differ by one at most (the law ``rows``).

Labels and keys depend on the seed, the order of the files' names and places in files, never
on tasks, so lost executors repeat the same deal. Frames that aren't read from Parquet files
are stored first. Null text is kept as null and has size 1 and checksum 0; long texts move
whole, once. Null or repeated doc_ids and equal texts are rows like any other: copies
aren't kept together. An empty table gives no rows; other columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faregauge.llm.common import anchored, prepare, scratch, stored
from faregauge.operators.keys import broadcast_if_small, range_counts

COLUMNS = ("doc_id", "text")
# numpy draws hypergeometric numbers below this sum.
_SMALL = 10**9


@dataclass(frozen=True)
class Deal:
    """Number of shards, seed, rows whose labels are permuted at once, rows per chunk of a shard."""

    shards: int = 8
    seed: int = 11
    segment: int = 1 << 16
    chunk_rows: int = 4096


def sizes(rows: int, shards: int) -> np.ndarray:
    """Rows of each shard: equal but for one."""
    return rows // shards + (np.arange(shards) < rows % shards)


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """Good ones among ``drawn`` out of good and bad, for sums of any size.

    Beyond numpy's range the law is tabulated around its mode by ratios of neighbours,
    as far as double precision goes, and inverted.
    """
    total = good + bad
    if total < _SMALL:
        return int(rng.hypergeometric(good, bad, drawn)) if drawn and total else 0
    low, high = max(0, drawn - bad), min(drawn, good)
    mode = min(max((drawn + 1) * (good + 1) // (total + 2), low), high)
    spread = (drawn * (good / total) * (bad / total) * ((total - drawn) / (total - 1))) ** 0.5
    reach = int(12 * spread) + 30
    k = np.arange(max(low, mode - reach), min(high, mode + reach) + 1, dtype=float)
    up = np.log((good - k[:-1]) * (drawn - k[:-1])) - np.log((k[1:]) * (bad - drawn + k[1:]))
    logs = np.concatenate([[0.0], np.cumsum(up)])
    ends = np.cumsum(np.exp(logs - logs.max()))
    return int(k[np.searchsorted(ends, rng.random() * ends[-1], side="right").clip(0, len(k) - 1)])


def split(rng: np.random.Generator, left: np.ndarray, drawn: int) -> np.ndarray:
    """How many of ``drawn`` rows take each label when ``left`` of each are there."""
    taken, rest = np.zeros(len(left), np.int64), int(left.sum())
    for j, there in enumerate(left):
        rest -= int(there)
        taken[j] = hypergeometric(rng, int(there), rest, drawn)
        drawn -= int(taken[j])
    return taken


def matrix(rows: list[int], deal: Deal) -> list[list[int]]:
    """Rows of each file for each shard: one uniform deal with both margins exact."""
    left, out = sizes(sum(rows), deal.shards), []
    for number, n in enumerate(rows):
        taken = split(np.random.default_rng([deal.seed, 0, number]), left, n)
        left = left - taken
        out.append(taken.tolist())
    return out


def segment_labels(deal: Deal, file_no: int, rows: int, counts: np.ndarray, segment: int, memory: dict) -> np.ndarray:
    """The shards of the rows of one segment of a file, in their order.

    Segments of a file are drawn one after another; ``memory`` keeps what is left of the last
    file's row, so that a task going through a file draws each segment once.
    """
    if memory.get("file") != file_no or memory["next"] > segment:
        memory.clear()
        memory.update(file=file_no, next=0, left=np.asarray(counts, np.int64))
    while memory["next"] <= segment:
        number = memory["next"]
        rng = np.random.default_rng([deal.seed, 1, file_no, number])
        taken = split(rng, memory["left"], min(deal.segment, rows - number * deal.segment))
        memory.update(next=number + 1, left=memory["left"] - taken, labels=(number, taken, rng))
    _, taken, rng = memory["labels"]
    if memory.get("dealt") != (file_no, segment):
        memory["dealt"] = (file_no, segment)
        memory["shards"] = rng.permutation(np.repeat(np.arange(deal.shards, dtype=np.int32), taken))
    return memory["shards"]


def _labels_of(deal: Deal, file_no: np.ndarray, rows: np.ndarray, counts: list, place: np.ndarray, memory: dict) -> np.ndarray:
    out = np.zeros(len(place), np.int32)
    number = place // deal.segment
    cuts = np.flatnonzero((np.diff(file_no) != 0) | (np.diff(number) != 0)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(place)], strict=True):
        if b > a:
            labels = segment_labels(deal, int(file_no[a]), int(rows[a]), counts[a], int(number[a]), memory)
            out[a:b] = labels[place[a:b] - number[a] * deal.segment]
    return out


def dealt(docs: DataFrame, deal: Deal | None = None) -> DataFrame:
    """(doc_id, text, shard, chunk, key): the shard of every row and its order inside.

    The matrix has a row per file, like the planner's own list of files; it goes to the rows by
    a broadcast of checked size, else by a join on the file. Only ids of places go to Python.
    """
    deal = deal or Deal()
    spark = prepare(docs.sparkSession)
    kept = docs.select(*COLUMNS)
    from_parquet = kept._jdf.queryExecution().optimizedPlan().toString().rstrip().endswith(" parquet")
    rows = (anchored(kept) if from_parquet else stored(kept, "rows")).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_place"),
    )
    files = sorted((r["_file"], r["n"]) for r in rows.groupBy("_file").agg(F.count("*").alias("n")).collect())
    table = [(f, i, n, c) for i, ((f, n), c) in enumerate(zip(files, matrix([n for _, n in files], deal), strict=True))]
    sent = stored(spark.createDataFrame(table, "_file string, _file_no long, _rows long, _counts array<long>"), "matrix")

    @F.pandas_udf("int")
    def shard(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        memory: dict = {}
        for file_no, n, counts, place in batches:
            yield pd.Series(_labels_of(deal, file_no.to_numpy(), n.to_numpy(), counts.tolist(), place.to_numpy(), memory))

    most = max(sizes(sum(n for _, n in files), deal.shards))
    chunks = max(1, -(-int(most) // deal.chunk_rows))
    key = F.xxhash64(F.lit(deal.seed), "_file_no", "_place")
    return rows.join(broadcast_if_small(sent), "_file").select(
        *COLUMNS,
        shard.asNondeterministic()("_file_no", "_rows", "_counts", "_place").alias("shard"),
        F.pmod(F.shiftright(key, 32), F.lit(chunks)).cast("int").alias("chunk"),
        F.struct(key, "_file_no", "_place").alias("key"),
    )


def write_shards(docs: DataFrame, path: str, deal: Deal | None = None) -> None:
    """Files of every shard under ``path``, rows in their new order, one exchange."""
    placed = dealt(docs, deal).repartition("shard", "chunk").sortWithinPartitions("shard", "chunk", "key")
    numbered = placed.drop("key").withColumn("row_no", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    numbered.write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, text, shard, slot) of written shards; slots are gapless from 0 in each shard."""
    schema = "doc_id long, text string, chunk int, row_no long, shard int"
    rows = spark.read.schema(schema).parquet(path)
    counts = range_counts(rows, ["shard", "chunk"])
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    starts = stored(counts.select("shard", "chunk", start.alias("_start")), "starts")
    joined = rows.join(broadcast_if_small(starts), ["shard", "chunk"])
    return joined.select("doc_id", "text", "shard", (F.col("row_no") + F.col("_start")).alias("slot"))


def sharded(docs: DataFrame, deal: Deal | None = None, path: str | None = None) -> DataFrame:
    """Documents dealt, written and read back from their shards."""
    path = path or scratch(docs.sparkSession, "shards")
    write_shards(docs, path, deal)
    return read_shards(docs.sparkSession, path)


def shard_digests(rows: DataFrame) -> DataFrame:
    """Size, checksum and place of every document, from the shards' files."""
    text = F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id",
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
