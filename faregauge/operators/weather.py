"""Hourly observations to one filled, labelled row per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faregauge.functions import calendar, labels

FILLED = (
    "temperature_2m_mean",
    "temperature_2m_max",
    "temperature_2m_min",
    "precipitation_sum",
    "relative_humidity_2m_mean",
    "wind_speed_10m_mean",
    "wind_direction_10m_mean",
    "weathercode",
)


def daily_weather(hourly: DataFrame) -> DataFrame:
    """Daily means, extremes and precipitation sum, and the most frequent label.

    Everything in one aggregation with map-side partials. Ties between labels go
    to the first in the alphabet; a day whose precipitation is all NULL sums to 0.
    """
    return hourly.groupBy(F.to_date("datetime").alias("date")).agg(
        F.avg("temperature_2m").alias("temperature_2m_mean"),
        F.min("temperature_2m").alias("temperature_2m_min"),
        F.max("temperature_2m").alias("temperature_2m_max"),
        F.avg("relative_humidity_2m").alias("relative_humidity_2m_mean"),
        F.coalesce(F.sum("precipitation"), F.lit(0.0)).alias("precipitation_sum"),
        F.avg("wind_speed_10m").alias("wind_speed_10m_mean"),
        F.avg("wind_direction_10m").alias("wind_direction_10m_mean"),
        F.avg("weathercode").alias("weathercode"),
        F.mode("weather_category", True).alias("weather_category"),
    )


def first_file_per_day(days: DataFrame, rank: str = "file_rank") -> DataFrame:
    """Of several files that hold a date, keep the rows of the lowest-ranked file.

    Repeated dates inside that file all stay; rows without a date are dropped.
    The winner per date is aggregated first instead of ranked in a window, so a
    date with very many rows is never gathered in one task. One row per calendar
    date bounds the broadcast side.
    """
    dated = days.where(F.col("date").isNotNull())
    winner = dated.groupBy("date").agg(F.min(rank).alias(rank))
    return dated.join(F.broadcast(winner), ["date", rank], "left_semi").drop(rank)


def one_per_day(days: DataFrame, key: str = "date") -> DataFrame:
    """One row per date, for a dimension; of several the least in the order of its columns.

    A trip joins at most one weather day then, so days that a source repeats don't
    repeat trips. Partial aggregation leaves one row per date and task.
    """
    columns = [c for c in days.columns if c != key]
    dated = days.where(F.col(key).isNotNull())
    least = dated.groupBy(key).agg(F.min(F.struct(*columns)).alias("_day"))
    return least.select(key, "_day.*").select(*days.columns)


def forward_fill(days: DataFrame, order: str = "date", columns=FILLED) -> DataFrame:
    """Replace NULL by the last known value of an earlier or the same day.

    Rows of one date share a value (the greatest, where they differ), and leading
    NULLs stay. The window runs over one row per calendar date, which bounds
    both it and the broadcast side whatever the number of input rows; the
    fill is then joined back to the rows.
    """
    per_day = days.where(F.col(order).isNotNull()).groupBy(order).agg(*[F.max(c).alias(c) for c in columns])
    so_far = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = per_day.select(order, *[F.last(c, ignorenulls=True).over(so_far).alias(c) for c in columns])
    rest = [c for c in days.columns if c not in columns and c != order]
    return days.select(order, *rest).join(F.broadcast(filled), order)


def transform_weather(filled: DataFrame) -> DataFrame:
    """Clip, rename and label filled days; rows without a date are dropped."""
    day = F.col("date").cast("date")
    mean = F.col("temperature_2m_mean")
    return filled.where(F.col("date").isNotNull()).select(
        day.alias("date_actual"),
        labels.clip(mean, -40, 50).alias("avg_temperature"),
        F.col("temperature_2m_min").alias("min_temperature"),
        F.col("temperature_2m_max").alias("max_temperature"),
        labels.clip(F.col("precipitation_sum"), 0, 500).alias("total_precipitation"),
        F.col("relative_humidity_2m_mean").alias("avg_humidity"),
        F.col("wind_speed_10m_mean").alias("wind_speed"),
        F.col("wind_direction_10m_mean").alias("wind_direction"),
        F.col("weathercode").alias("weather_code"),
        "weather_category",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        calendar.day_name(day).alias("day_of_week"),
        calendar.is_late_week(day).alias("is_weekend"),
        labels.feel_label(mean).alias("temperature_category"),
    )
