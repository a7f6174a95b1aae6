"""Weather files and API responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faregauge.functions.labels import weather_label
from faregauge.schemas import WEATHER_DAILY, WEATHER_HOURLY, WEATHER_PAYLOAD
from faregauge.operators.weather import first_file_per_day
from faregauge.sources.files import scan_mixed


def file_interval(paths: DataFrame) -> DataFrame:
    """Marks every weather file as 'hourly' or 'daily' from its name, whatever the case.

    ``paths`` has a column ``path``; only the last path segment counts.
    """
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    return paths.withColumn(
        "interval", F.when(name.contains("hourly"), "hourly").otherwise("daily")
    )


def scan_weather_daily(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Daily observations, the ten declared columns only, in their declared types.

    Of several files that hold a date the first in order of their paths counts, and rows
    without a date are left out.
    """
    if not paths:
        raise ValueError("no daily weather file to read")
    rank = F.col("_metadata.file_path")
    return first_file_per_day(scan_mixed(spark, paths, WEATHER_DAILY, file_rank=rank))


def scan_weather_hourly(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Hourly observations of all given files; weather codes may be whole numbers."""
    return scan_mixed(spark, paths, WEATHER_HOURLY)


def scan_payloads(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """API responses, one document per line, or one per file with ``multi_line``."""
    return spark.read.schema(WEATHER_PAYLOAD).option("multiLine", multi_line).json(path)


def flatten_payload(documents: DataFrame) -> DataFrame:
    """Parallel arrays of hourly values to one row per hour.

    Variables a response lacks are NULL. A response without times is an error,
    raised when the plan runs.
    """
    fields = documents.schema["hourly"].dataType.fieldNames()
    checked = documents.withColumn(
        "hourly",
        F.when(F.size("hourly.time") > 0, F.col("hourly")).otherwise(
            F.raise_error(F.lit("weather response without hourly times"))
        ),
    )
    # A missing array would make the whole zip NULL; an empty one is padded.
    arrays = [F.coalesce(f"hourly.{name}", F.array()).alias(name) for name in fields]
    rows = checked.select(*arrays).select(F.inline(F.arrays_zip(*fields)))
    code = F.col("weather_code")
    return rows.select(
        F.to_timestamp_ntz("time", F.lit("yyyy-MM-dd'T'HH:mm")).alias("datetime"),
        "temperature_2m",
        "relative_humidity_2m",
        "precipitation",
        code.alias("weathercode"),
        "wind_speed_10m",
        "wind_direction_10m",
        weather_label(code).alias("weather_category"),
    )
