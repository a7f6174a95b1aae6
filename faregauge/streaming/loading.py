"""Loads trip files exactly once, as a stream or as a batch with a ledger."""

from __future__ import annotations

import hashlib
import re
import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from faregauge.operators.keys import broadcast_if_small
from faregauge.schemas import FILE_LEDGER, TRIPS_RAW
from faregauge.sources.files import empty_table, hadoop_path, path_exists, scan_trips

SOURCE = "source_file"


def stream_new_files(
    spark: SparkSession,
    pattern: str,
    target: str,
    checkpoint: str,
    schema: StructType = TRIPS_RAW,
    max_files: int | None = None,
) -> DataFrame:
    """Append all files not seen before to ``target`` and return the whole table.

    The checkpoint remembers the files and the file sink commits each micro-batch
    once, so a rerun adds nothing and a failed run is resumed. ``availableNow``
    drains what is there and stops; ``max_files`` bounds one micro-batch.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        reader.parquet(pattern)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(schema).parquet(target)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """Files loaded so far."""
    if not path_exists(spark, ledger):
        return empty_table(spark, FILE_LEDGER)
    return spark.read.schema(FILE_LEDGER).parquet(ledger)


def ledger_guard(spark: SparkSession, staging: str, ledger: str) -> None:
    """Refuse to add to a staging table of unknown content."""
    if path_exists(spark, staging) and not path_exists(spark, ledger):
        raise RuntimeError(
            f"{staging} holds trips but {ledger} does not say which files they came from;"
            " start from an empty folder"
        )


def unloaded(candidates: DataFrame, ledger: DataFrame) -> DataFrame:
    """Candidate files without an entry in the ledger."""
    return candidates.join(ledger, "file_path", "left_anti")


def load_new_files(spark: SparkSession, paths: Sequence[str], staging: str, ledger: str) -> DataFrame:
    """Batch twin of the stream: add the given files that the ledger does not list.

    Returns the files added by this call. Rows are stored by source file and the
    write replaces only the partitions it brings, so that repeating a load that
    died before its ledger entry does not double the rows. A partition is named by
    a digest of the whole path: equal file names in two folders stay apart.
    """
    ledger_guard(spark, staging, ledger)
    present = [p for p in paths if path_exists(spark, p)]
    for path in sorted(set(paths) - set(present)):
        warnings.warn(f"trip file not found: {path}", stacklevel=2)
    candidates = spark.createDataFrame([(p,) for p in present], "file_path string")
    new = [r["file_path"] for r in unloaded(candidates, read_ledger(spark, ledger)).collect()]
    if not new:
        if not path_exists(spark, ledger):
            raise ValueError("no trip file could be loaded")
        return empty_table(spark, FILE_LEDGER)
    rows = with_source(scan_trips(spark, sorted(new)), new)
    # No shuffle: a task reads few files and so writes few partitions.
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(SOURCE)
        .parquet(staging)
    )
    entries = spark.createDataFrame([(p,) for p in sorted(new)], "file_path string").withColumn(
        "loaded_at", F.current_timestamp()
    )
    entries.coalesce(1).write.mode("append").parquet(ledger)
    return spark.createDataFrame([(p,) for p in sorted(new)], "file_path string")


def full_path(spark: SparkSession, path: str) -> str:
    """``path`` with scheme and folder, escaped the way file metadata shows it."""
    store, target = hadoop_path(spark, path)
    return _one_slash(store.makeQualified(target).toUri().toString())


def _one_slash(path: str) -> str:
    return re.sub(r"^([A-Za-z][\w+.-]*):/+", r"\1:/", path.rstrip("/"))


def source_id(spark: SparkSession, path: str) -> str:
    """Name of the staging partition that holds the rows of a file or folder."""
    return hashlib.md5(full_path(spark, path).encode()).hexdigest()


def listed_files(spark: SparkSession, files: Sequence[str], paths: Sequence[str]) -> list[tuple[str, str]]:
    """(file, source id) of every file that lies in or is one of the listed paths.

    A file belongs to the nearest listed folder above it. Paths are compared segment by
    segment, never as patterns.
    """
    listed = {full_path(spark, p): source_id(spark, p) for p in paths}
    found = []
    for file in files:
        at = _one_slash(file)
        while at not in listed and "/" in at:
            at = at.rpartition("/")[0]
        if at in listed:
            found.append((_one_slash(file), listed[at]))
    return found


def with_source(rows: DataFrame, paths: Sequence[str]) -> DataFrame:
    """``rows`` as read from the listed paths, with the ``source_id`` of the path each came from.

    The reader's own list of files becomes a table that is joined to the path of every row: by
    a broadcast of checked size, else by a shuffle. A row from nowhere is an error: its
    partition would be lost with the next load.
    """
    spark = rows.sparkSession
    table = listed_files(spark, rows.inputFiles(), paths)
    files = broadcast_if_small(spark.createDataFrame(table, f"_file string, {SOURCE} string"))
    read_from = F.regexp_replace("_metadata.file_path", r"^([A-Za-z][\w+.-]*):/+", "$1:/")
    unknown = F.raise_error(F.concat(F.lit("row from a file that was not listed: "), F.col("_file"))).cast("string")
    joined = rows.withColumn("_file", read_from).join(files, "_file", "left")
    return joined.select(*rows.columns, F.coalesce(SOURCE, unknown).alias(SOURCE))


def read_staging(spark: SparkSession, staging: str, source: str | None = None) -> DataFrame:
    """Trips loaded so far, or those of one source path, whose partition alone is read."""
    schema = StructType([*TRIPS_RAW, StructField(SOURCE, StringType())])
    trips = spark.read.schema(schema).parquet(staging)
    if source is not None:
        trips = trips.where(F.col(SOURCE) == source_id(spark, source))
    return trips.drop(SOURCE)
