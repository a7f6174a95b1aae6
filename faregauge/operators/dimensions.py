"""Time, location and weather dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregauge.functions import calendar, labels
from faregauge.operators.keys import dense_key, dimension_key
from faregauge.operators.weather import one_per_day
from faregauge.settings import UNKNOWN


def distinct_dates(cleaned: DataFrame) -> DataFrame:
    """Pickup dates. Truncated before the aggregation, so partials are tiny."""
    return cleaned.select(F.to_date("pickup_datetime").alias("date_key")).distinct()


def calendar_columns(dates: DataFrame) -> DataFrame:
    """Date parts, names, weekend flag and season of every date."""
    day = F.col("date_key")
    return dates.select(
        "date_key",
        day.alias("date_actual"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.quarter(day).alias("quarter"),
        F.weekofyear(day).alias("week_of_year"),
        calendar.day_number(day).alias("day_of_week_number"),
        calendar.day_name(day).alias("day_of_week_name"),
        calendar.is_calendar_weekend(day).alias("is_weekend"),
        calendar.season(F.month(day)).alias("season"),
    )


def dim_time(cleaned: DataFrame) -> DataFrame:
    """One row per pickup date, keyed in date order."""
    return dimension_key(calendar_columns(distinct_dates(cleaned)), "date_key", "time_key")


def union_locations(cleaned: DataFrame) -> DataFrame:
    """Distinct pickup and dropoff zones in a single scan of two columns."""
    both = F.explode(F.array("pickup_location_id", "dropoff_location_id")).alias("location_id")
    return cleaned.select(both).where(F.col("location_id").isNotNull()).distinct()


def zone_attributes(location_ids: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone ids with what the zone table knows about them; unknown zones get NULLs."""
    return location_ids.join(zones, "location_id", "left").select(
        "location_id",
        "latitude",
        "longitude",
        F.round("latitude", 4).alias("latitude_rounded"),
        F.round("longitude", 4).alias("longitude_rounded"),
        F.col("zone").alias("zone_name"),
        "borough",
        "service_zone",
    )


def dim_location(cleaned: DataFrame, zones: DataFrame, staging: str) -> DataFrame:
    """One row per zone in use, keyed in id order."""
    rows = zone_attributes(union_locations(cleaned), zones)
    return dense_key(rows, ["location_id"], "location_key", staging).withColumn(
        "created_at", F.current_timestamp()
    )


def weather_attributes(transformed: DataFrame) -> DataFrame:
    """Columns of the weather dimension. The code is rounded half to even."""
    mean = F.col("avg_temperature").cast("float")
    return transformed.select(
        F.col("date_actual").cast("date").alias("date_key"),
        mean.alias("temperature_2m"),
        F.col("avg_humidity").cast("float").alias("relative_humidity_2m"),
        F.col("total_precipitation").cast("float").alias("precipitation"),
        F.col("wind_speed").cast("float").alias("wind_speed_10m"),
        F.col("wind_direction").cast("float").alias("wind_direction_10m"),
        F.rint("weather_code").cast("int").alias("weather_code"),
        F.coalesce("weather_category", F.lit(UNKNOWN)).alias("weather_description"),
        F.coalesce("temperature_category", F.lit(UNKNOWN)).alias("temperature_description"),
        labels.band_label(mean).alias("temperature_category"),
    )


def dim_weather(transformed: DataFrame, staging: str) -> DataFrame:
    """One row per observed day, keyed in date order."""
    rows = one_per_day(weather_attributes(transformed), "date_key")
    order = ["date_key"] + [c for c in rows.columns if c != "date_key"]
    return dense_key(rows, order, "weather_key", staging).withColumn(
        "loaded_at", F.current_timestamp()
    )
