"""Dense integer keys 1..N in a given order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# monotonically_increasing_id keeps the partition number above this many bits.
_ROW_BITS = 33


def dimension_key(rows: DataFrame, order: str, name: str) -> DataFrame:
    """``row_number`` over the whole table, NULLs last.

    One task numbers all rows, so this is only for tables with a proven bound,
    such as one row per calendar date. Everything else takes the staged way.
    """
    key = F.row_number().over(Window.orderBy(F.col(order).asc_nulls_last()))
    return rows.select(key.cast("long").alias(name), "*")


def stage_ordered(
    rows: DataFrame,
    order: Sequence[str],
    path: str,
    partition_by: str | None = None,
    touched_only: bool = False,
) -> DataFrame:
    """Write ``rows`` range-partitioned and sorted, each with its place; returns the table.

    ``part_no`` is the range a row fell into and ``row_no`` its position there.
    A running id breaks ties, so that equal rows, however many, spread over
    several ranges. ``rows`` should come from a stored table: then a rerun of a
    lost task sees the same ids again. Writing here fixes the ranges, which a
    recomputed sample could otherwise move between numbering and use.

    ``partition_by`` must not decrease along ``order``. With ``touched_only`` the
    partitions that ``rows`` does not contain stay as they are.
    """
    write_staged(placed(rows, order, partition_by), path, partition_by, touched_only)
    return rows.sparkSession.read.schema(placed(rows, order, partition_by).schema).parquet(path)


def placed(rows: DataFrame, order: Sequence[str], partition_by: str | None = None) -> DataFrame:
    """``rows`` range-partitioned and sorted, with their range and place.

    Joins that keep rows where they are, such as broadcast joins, may follow before the
    table is written; sampling and shuffle then see the narrow rows only.
    """
    keys = [F.col(c).asc_nulls_last() for c in ([partition_by] if partition_by else []) + list(order)]
    tie = F.col("_tie").asc()
    return (
        rows.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*keys, tie)
        .sortWithinPartitions(*keys, tie)
        .drop("_tie")
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("part_no", F.shiftright("_place", _ROW_BITS).cast("int"))
        .withColumn("row_no", F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1))
        .drop("_place")
    )


def write_staged(
    rows: DataFrame, path: str, partition_by: str | None = None, touched_only: bool = False
) -> None:
    """Write placed rows. A range spans few partitions, so a task keeps their files open
    side by side (``spark.sql.maxConcurrentOutputFileWriters``) instead of sorting again."""
    write = rows.write.mode("overwrite")
    if touched_only:
        write = write.option("partitionOverwriteMode", "dynamic")
    (write.partitionBy(partition_by) if partition_by else write).parquet(path)


def sorted_evenly(rows: DataFrame, *keys: Column) -> DataFrame:
    """Global sort whose ranges stay even when many rows share a key.

    A sort on the keys alone puts all rows of one key into one task; the running
    id lets it end in the middle of them.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    return tied.orderBy(*keys, "_tie").drop("_tie")


def broadcast_if_small(table: DataFrame, rows: int = 100_000) -> DataFrame:
    """``table`` with a broadcast hint if it has at most ``rows`` rows.

    Counts no further than the limit. A larger table is left to the planner,
    which shuffles both sides and splits hot keys.
    """
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def key_offsets(staged: DataFrame, by: Sequence[str]) -> DataFrame:
    """What to add to ``row_no`` in every range to number all rows through.

    One row per written range, so the window is as small as the number of tasks
    that wrote the table. Replacing one month changes only this table.
    """
    return offsets_of(range_counts(staged, by), by)


def range_counts(staged: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows and first place of every written range."""
    return staged.groupBy(*by).agg(F.count("*").alias("_n"), F.min("row_no").alias("_first"))


def offsets_of(ranges: DataFrame, by: Sequence[str]) -> DataFrame:
    """Offsets from range counts, however the counts were put together."""
    before = Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_n").over(before), F.lit(0))
    return ranges.select(
        *by, "_n", "_first", (start + 1 - F.col("_first")).alias("key_offset"), (start + 1).alias("first_key")
    )


def _beside(staged: DataFrame, offsets: DataFrame, files: int = 100_000) -> DataFrame:
    """``offsets`` to be broadcast if ``staged`` has at most so many files.

    A range is written by one task into a file of its own, so the list of files, which the
    planner has anyway, bounds the offsets. Beyond it the planner shuffles.
    """
    return F.broadcast(offsets) if len(staged.inputFiles()) <= files else offsets


def _with_key(joined: DataFrame, staged: DataFrame, name: str, offset: Column) -> DataFrame:
    rest = [c for c in staged.columns if c not in ("part_no", "row_no")]
    return joined.select((F.col("row_no") + offset).alias(name), *rest)


def numbered(staged: DataFrame, offsets: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Staged rows with their dense key in front and the placing columns removed.

    A range without an offset is an error: its rows would be lost without a trace.
    """
    joined = staged.join(_beside(staged, offsets.select(*by, "key_offset")), list(by), "left")
    missing = F.raise_error(F.lit(f"a written range has no offset for {name}")).cast("long")
    return _with_key(joined, staged, name, F.coalesce("key_offset", missing))


def first_numbered(
    staged: DataFrame, offsets: DataFrame, by: Sequence[str], name: str, rows: int
) -> DataFrame:
    """The rows with keys 1 to ``rows``.

    Ranges whose first key is higher are dropped from the offsets, which prunes their
    partitions. A place within a range says nothing once ranges before it shrink.
    """
    near = offsets.where(F.col("first_key") <= rows)
    joined = staged.join(_beside(staged, near.select(*by, "key_offset")), list(by))
    return _with_key(joined, staged, name, F.col("key_offset")).where(F.col(name) <= rows)


def dense_key(rows: DataFrame, order: Sequence[str], name: str, path: str) -> DataFrame:
    """Rows numbered 1..N along ``order`` without a single-task window.

    ``path`` takes the staged table, which the result reads.
    """
    staged = stage_ordered(rows, order, path)
    return numbered(staged, key_offsets(staged, ["part_no"]), ["part_no"], name)
