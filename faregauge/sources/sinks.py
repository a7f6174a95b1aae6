"""Writers. Each takes a frame and a path and replaces what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregauge.operators.keys import sorted_evenly


def write_mart(table: DataFrame, path: str, partition_by: str | None = None, laid_out: bool = False) -> None:
    """Replace a stored table with the rows of ``table``.

    With ``partition_by`` rows are gathered per partition first. The rebalance
    hint lets adaptive execution cut an oversized partition value into several
    files, so one month with a third of all rows does not end up in one task.
    A table that is read from files by that partition already is ``laid_out``: its tasks
    see few values each, keep their files open side by side, and nothing is shuffled.
    """
    writer = table
    if partition_by and not laid_out:
        writer = table.hint("rebalance", partition_by)
    write = writer.write.mode("overwrite")
    (write.partitionBy(partition_by) if partition_by else write).parquet(path)


def write_parquet(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").option("compression", "snappy").parquet(path)


def weather_file_name(interval: str, start: str, end: str) -> str:
    """Name of a stored weather file, e.g. ``weather_daily_2025-01-01_to_2025-01-31.parquet``."""
    return f"weather_{interval}_{start}_to_{end}.parquet"


def write_zone_csv(zones: DataFrame, path: str) -> None:
    """Zone table as CSV with header, sorted by id; one file while it is small.

    The sort partitions by range and adaptive execution merges small ranges, so
    a usual zone table is one file and a huge one never passes through one task.
    """
    sorted_evenly(zones, F.col("location_id")).write.mode("overwrite").csv(path, header=True)


def write_csv(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").csv(path, header=True)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Model metrics, one JSON document per model."""
    metrics.write.mode("overwrite").json(path)
