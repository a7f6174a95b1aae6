"""From raw trips to cleaned trips."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregauge.functions import calendar, labels
from faregauge.settings import CleanRules

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"


def raw_minutes() -> Column:
    """Duration of a raw trip in minutes."""
    return calendar.elapsed_minutes(F.col(PICKUP), F.col(DROPOFF))


def ntz(moment: datetime) -> Column:
    """Zone-free timestamp literal."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def in_year(moment: Column, year: int) -> Column:
    """Year test as a half-open range, which file statistics can answer."""
    return (moment >= ntz(datetime(year, 1, 1))) & (moment < ntz(datetime(year + 1, 1, 1)))


def is_clean(rules: CleanRules = CleanRules()) -> Column:
    """True for raw trips to keep. NULL fares and passenger counts are rejected."""
    return (
        (F.col("fare_amount") >= rules.min_fare)
        & raw_minutes().between(0, rules.max_minutes)
        & (F.col("passenger_count") > 0)
        & in_year(F.col(PICKUP), rules.year)
    )


def temporal_columns(pickup: Column) -> list[Column]:
    """The five time-of-pickup features."""
    return [
        F.hour(pickup).alias("hour_of_day"),
        calendar.day_name(pickup).alias("day_of_week"),
        calendar.day_number(pickup).alias("dow_numeric"),
        calendar.is_late_week(pickup).alias("is_weekend"),
        calendar.is_peak(F.hour(pickup)).alias("is_peak_hour"),
    ]


def money_columns() -> list[Column]:
    """Amounts as 32-bit floats."""
    names = ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "total_amount")
    return [F.col(name).cast("float").alias(name) for name in names]


def coordinate_columns() -> list[Column]:
    """Placeholders: the input has zone numbers instead of coordinates."""
    names = ("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")
    return [F.lit(None).cast("float").alias(name) for name in names]


def zone_columns() -> list[Column]:
    return [
        F.col("PULocationID").cast("int").alias("pickup_location_id"),
        F.col("DOLocationID").cast("int").alias("dropoff_location_id"),
        F.col("RatecodeID").cast("int").alias("rate_code_id"),
        F.col("store_and_fwd_flag"),
    ]


def shape_trips(raw: DataFrame) -> DataFrame:
    """The 25 columns of a cleaned trip, without any filter."""
    pickup = F.col(PICKUP).cast("timestamp_ntz")
    return raw.select(
        pickup.alias("pickup_datetime"),
        F.col(DROPOFF).cast("timestamp_ntz").alias("dropoff_datetime"),
        raw_minutes().alias("trip_duration_min"),
        *money_columns(),
        labels.tip_percentage(F.col("tip_amount"), F.col("fare_amount")).alias("tip_percentage"),
        F.col("passenger_count").cast("int").alias("passenger_count"),
        F.col("trip_distance").cast("float").alias("trip_distance"),
        *temporal_columns(pickup),
        *coordinate_columns(),
        *zone_columns(),
    )


def clean_trips(raw: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    """Keep plausible trips and derive their features; one narrow stage."""
    return shape_trips(raw.where(is_clean(rules)))


def whole_minutes(cleaned: DataFrame) -> DataFrame:
    """Trip times with the number of minute boundaries crossed."""
    both = F.col("pickup_datetime").isNotNull() & F.col("dropoff_datetime").isNotNull()
    minutes = calendar.crossed_minutes(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return cleaned.where(both).select(
        "pickup_datetime", "dropoff_datetime", minutes.alias("trip_duration_min")
    )
