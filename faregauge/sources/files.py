"""Finding, checking and reading files."""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faregauge.schemas import TRIPS_RAW

TRIP_FILES = "yellow_tripdata_*.parquet"
WEATHER_FILES = "weather_daily_*.parquet"


def spread_small(table: DataFrame, size: int, bytes_per_task: int = 1 << 20) -> DataFrame:
    """Deals a table of ``size`` bytes out to all cores if it fits into one input split.

    A small file is read by a single task, which would then do all the work up to
    the next shuffle and write one file again. Larger inputs have splits enough and
    are left alone, so nothing big is shuffled for this.
    """
    spark = table.sparkSession
    split = spark.conf.get("spark.sql.files.maxPartitionBytes").lower().rstrip("b")
    limit = int(split) if split.isdigit() else 128 << 20
    parts = min(spark.sparkContext.defaultParallelism, size // bytes_per_task)
    return table.repartition(parts) if parts > 1 and size < limit else table


def path_size(spark: SparkSession, path: str) -> int:
    """Bytes under a path, from the store's own summary."""
    files, target = hadoop_path(spark, path)
    return files.getContentSummary(target).getLength()


def _entry(root: str, path: Column) -> Column:
    """The file or directory right under ``root`` that ``path`` belongs to."""
    folder = root.rstrip("/").split("/")[-1]
    return F.regexp_extract(path, f"/{folder}/([^/]+)", 1)


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Path, size and time of all files a glob matches; empty when there are none.

    Only the listing is read: the content column of the reader is pruned.
    """
    try:
        files = spark.read.format("binaryFile").load(pattern)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
    return files.select("path", "length", "modificationTime")


def hadoop_path(spark: SparkSession, path: str):
    """File system and path object of ``path``, whatever store it is on."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or directory; one call to the store, no job."""
    files, target = hadoop_path(spark, path)
    return files.exists(target)


def discover_files(
    spark: SparkSession, root: str, pattern: str = TRIP_FILES, subfolder: str | None = None
) -> DataFrame:
    """Data sets under ``root`` whose name matches, with their size.

    A data set is a file or a directory of part files. ``subfolder`` is searched
    only when ``root`` itself has no match.
    """
    root = root.rstrip("/")
    files = list_files(spark, f"{root}/{pattern}")
    if subfolder and files.isEmpty():
        root = f"{root}/{subfolder}"
        files = list_files(spark, f"{root}/{pattern}")
    return (
        files.groupBy(_entry(root, F.col("path")).alias("file_name"))
        .agg(F.count("*").alias("part_files"), F.sum("length").alias("bytes"))
        .withColumn("file_path", F.concat(F.lit(f"{root}/"), "file_name"))
        .orderBy("file_name")
    )


def scan_trips(
    spark: SparkSession, paths: Sequence[str], schema: StructType = TRIPS_RAW
) -> DataFrame:
    """All trip files as one table, matched by column name against the declared schema.

    Reordered columns land where they belong, missing ones become NULL and
    unknown ones are left out, so an added column in a later month shifts nothing.
    Files whose *types* differ go through :func:`append_files`.
    """
    return spark.read.schema(schema).parquet(*paths)


def _fitted(frame: DataFrame, schema: StructType) -> list[Column]:
    """The declared columns, matched by name whatever the case, NULL where missing."""
    present = {name.lower(): name for name in frame.columns}
    return [
        (F.col(present[field.name.lower()]) if field.name.lower() in present else F.lit(None))
        .cast(field.dataType)
        .alias(field.name)
        for field in schema
    ]


def append_files(frames: Sequence[DataFrame], schema: StructType = TRIPS_RAW) -> DataFrame:
    """Rows of several files by name, each column cast to its declared type."""
    return reduce(DataFrame.unionByName, [f.select(*_fitted(f, schema)) for f in frames])


# Files up to this size are read whole to see their schema, when schemas differ.
SMALL_FILE = 16 << 20


def _schemas_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(path, schema) from whole files; a schema is text that is equal for equal columns."""
    for batch in batches:
        shown = [pq.read_schema(io.BytesIO(content)).remove_metadata().to_string() for content in batch["content"]]
        yield pd.DataFrame({"path": batch["path"], "schema": shown})


def same_schema(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    """The given paths or their files in groups that one scan can read.

    Usually all footers agree, which one distributed job finds out, whatever the number of
    files. If types differ, small files are told apart by one more job and only larger ones
    each by a call of its own.
    """
    try:
        spark.read.option("mergeSchema", "true").parquet(*paths)
        return [list(paths)]
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" not in str(error):
            raise
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(list(paths))
    small = found.where(F.col("length") <= SMALL_FILE).select("path", "content")
    groups: dict[str, list[str]] = {}
    for row in small.mapInPandas(_schemas_of, "path string, schema string").collect():
        groups.setdefault(row["schema"], []).append(row["path"])
    for row in found.where(F.col("length") > SMALL_FILE).select("path").collect():
        groups.setdefault(spark.read.parquet(row["path"]).schema.json(), []).append(row["path"])
    return [sorted(same) for same in groups.values()]


def scan_mixed(
    spark: SparkSession, paths: Sequence[str], schema: StructType = TRIPS_RAW, **extra: Column
) -> DataFrame:
    """Files whose column types differ, such as whole numbers in some and fractions in others.

    Files of one schema share a scan, so the plan grows with the number of schemas and not
    of files. ``extra`` columns are read from each file's metadata.
    """
    fitted = []
    for same in same_schema(spark, paths):
        rows = spark.read.option("mergeSchema", "true").parquet(*same)
        fitted.append(rows.select(*_fitted(rows, schema), *[c.alias(name) for name, c in extra.items()]))
    return reduce(DataFrame.unionByName, fitted)


def audit_files(
    spark: SparkSession, pattern: str, schema: StructType = TRIPS_RAW
) -> DataFrame:
    """Row count of each file a glob matches, and whether any row could be read.

    Broken files are skipped by the reader instead of failing the scan; they
    stay in the result because the listing is the left side of the join.
    """
    listing = list_files(spark, pattern)
    rows = (
        spark.read.schema(schema)
        .option("ignoreCorruptFiles", "true")
        .parquet(pattern)
        .select(F.col("_metadata.file_path").alias("path"))
        .groupBy("path")
        .agg(F.count("*").alias("row_count"))
    )
    return listing.join(rows, "path", "left").select(
        "path",
        "length",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.col("row_count").isNotNull().alias("is_readable"),
    )


def describe_table(table: DataFrame, name: str) -> DataFrame:
    """One row per column: position and type, next to the row count of the table."""
    spark = table.sparkSession
    columns = spark.createDataFrame(
        [(name, i, field.name, field.dataType.simpleString()) for i, field in enumerate(table.schema, 1)],
        "table_name string, position int, column_name string, data_type string",
    )
    size = table.agg(F.count("*").alias("row_count")).withColumn("table_name", F.lit(name))
    return columns.join(size, "table_name")


def find_column(table: DataFrame, *spellings: str) -> str:
    """The column of ``table`` that matches one of the spellings, whatever its case."""
    present = {name.lower(): name for name in table.columns}
    for spelling in spellings:
        if spelling.lower() in present:
            return present[spelling.lower()]
    raise ValueError(f"none of {spellings} among the columns {table.columns}")


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """Stand-in for a missing input: joins on it give NULL instead of failing."""
    return spark.createDataFrame([], schema)
