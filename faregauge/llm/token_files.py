"""Token ids in Parquet: dictionary-coded id lists, delta-coded metadata, page indexes.

Documents are dealt into ranges of doc_id and sorted, then encoded, so a file holds a
contiguous run of the corpus. Each row has its document's ids and where they start within
the file; what the files before hold is one number per file, added on reading. Ids take a
dictionary (a vocabulary fits a dictionary page, so an id costs its bit width before
compression), ids of documents and starts take delta coding. Row groups and pages are
small enough that a reader fetches a span of documents, or the metadata columns alone,
without the rest; column and offset indexes let it skip pages.

Null text counts as empty and gets the end id alone. Rows with equal doc_id follow each
other in the order of their files, null ids come first. An empty table writes no rows.
Further columns of the input are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faregauge.llm.chunks import ArrayEncoder, id_lists
from faregauge.llm.common import by_batch, prepare, text_or_empty

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
# Chunks per call of the library, and the letter that vocabulary files use for a space.
JOINED = 500
SPACE = "\u0120"
FILE_SCHEMA = "part_no int, doc_id long, first long, n_tokens long, ids array<int>"


@lru_cache(maxsize=2)
def library_encoder(path: str) -> ArrayEncoder:
    """The tokenizers library behind the chunk memory; one per worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()

    def encode(texts: list[str]) -> list[bytes]:
        found = library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    special = tuple(t.content for t in library.get_added_tokens_decoder().values())
    spaced = np.array([(library.id_to_token(i) or "").startswith(SPACE) for i in range(library.get_vocab_size() + 1)])

    def encode_chunks(spaced_chunks: pa.Array, others: pa.Array) -> pa.ListArray:
        """Chunks with a space in front are encoded many at a time, as one text: exactly
        the tokens that start with a space start a chunk."""
        count = len(spaced_chunks)
        groups = pa.array(np.append(np.arange(0, count, JOINED), count).astype(np.int32))
        joined = pc.binary_join(pa.ListArray.from_arrays(groups, spaced_chunks), "").to_pylist()
        ids = np.frombuffer(b"".join(encode(joined)), "<u4")
        starts = np.append(np.flatnonzero(spaced[ids]), len(ids))
        if len(starts) != count + 1:
            raise ValueError("the vocabulary doesn't start a token at every space")
        lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids))
        return pa.concat_arrays([lists, id_lists(encode(others.to_pylist()))])

    return ArrayEncoder(encode_chunks, encode, special)


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each document, and the new offsets."""
    return np.insert(ids, bounds[1:], end_id), bounds + np.arange(len(bounds))


def write_tokens(docs: DataFrame, path: str, vocabulary: str = BYTE_BPE, end_id: int = 0) -> None:
    """Encode every text and write it under ``path`` in ascending doc_id order."""
    prepare(docs.sparkSession)
    tied = docs.select(
        F.col("doc_id").cast("long"), text_or_empty().alias("text"), F.monotonically_increasing_id().alias("tie")
    )
    # Dealt before encoding: the sample of the ranges reads texts but encodes nothing.
    dealt = (
        tied.repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select(F.spark_partition_id().alias("part_no"), "doc_id", "text")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(vocabulary)
        seen = 0
        for batch in batches:
            ids, bounds = with_end(*encoder.encode(batch.column("text")), end_id)
            columns = [
                batch.column("part_no"),
                batch.column("doc_id"),
                pa.array(bounds[:-1] + seen),
                pa.array(np.diff(bounds)),
                pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32))),
            ]
            seen += int(bounds[-1])
            yield pa.RecordBatch.from_arrays(columns, ["part_no", "doc_id", "first", "n_tokens", "ids"])

    rows = dealt.mapInArrow(encode, FILE_SCHEMA)
    (
        rows.write.option("compression", "zstd")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary", "true")
        .option("parquet.enable.dictionary#doc_id", "false")
        .option("parquet.enable.dictionary#first", "false")
        .option("parquet.enable.dictionary#n_tokens", "false")
        .parquet(path)
    )


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(part_no, doc_id, start, n_tokens) without touching the ids."""
    return read_tokens(spark, path).drop("ids")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files with ``start``, the number of ids of all documents before.

    The sum runs over one row per file, which a broadcast takes back to the rows.
    """
    rows = spark.read.schema(FILE_SCHEMA).parquet(path)
    files = rows.groupBy("part_no").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part_no").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part_no", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(files), "part_no").select(
        "part_no", "doc_id", (F.col("first") + F.col("_before")).alias("start"), "n_tokens", "ids"
    )


def _digest_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    lists = batch.column("ids")
    bounds = lists.offsets.to_numpy()
    ids = lists.values.to_numpy().astype("<u4")
    sums = [zlib.crc32(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(bounds).astype(np.int64)), pa.array(sums, pa.int64())],
        ["doc_id", "start", "n_tokens", "ids_crc32"],
    )


def token_digests(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows read back from the files."""
    rows = tokens.select("doc_id", "start", "ids")
    return by_batch(rows, lambda: _digest_batch, "doc_id long, start long, n_tokens long, ids_crc32 long")
