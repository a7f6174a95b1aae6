"""The trip fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregauge.functions import labels
from faregauge.operators.filters import MONTH_PARTITION, has_zones
from faregauge.operators.ranges import RANGE_ROWS, counted_ranges
from faregauge.settings import NO_WEATHER, NO_WEATHER_KEY, UNKNOWN

# Total order of cleaned trips: equal rows under it are equal in every column of the fact,
# as zones and days determine the rest.
TRIP_ORDER = (
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_location_id",
    "dropoff_location_id",
    "rate_code_id",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "tip_percentage",
    "store_and_fwd_flag",
)


_TRIP_COLUMNS = (
    *TRIP_ORDER,
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "is_peak_hour",
    "trip_duration_min",
)


def weather_or_default(keep_null: bool = False) -> list[Column]:
    """Weather of the trip's day, with stand-ins where there is none.

    The stand-ins are part of the stored values and so enter averages such as
    the mean temperature of a report. ``keep_null`` leaves them out.
    """
    if keep_null:
        numbers = [F.col(name) for name in NO_WEATHER]
    else:
        numbers = [
            F.coalesce(name, F.lit(value).cast("float")).alias(name)
            for name, value in NO_WEATHER.items()
        ]
    texts = [
        F.coalesce(name, F.lit(UNKNOWN)).alias(name)
        for name in ("weather_description", "temperature_category")
    ]
    return numbers + texts


def _role(locations: DataFrame, role: str) -> DataFrame:
    """The location dimension renamed for one end of a trip."""
    return locations.select(
        F.col("location_id").alias(f"{role}_location_id"),
        F.col("location_key").alias(f"{role}_location_key"),
        F.col("longitude").alias(f"{role}_longitude"),
        F.col("latitude").alias(f"{role}_latitude"),
    )


def build_fact(
    cleaned: DataFrame,
    times: DataFrame,
    locations: DataFrame,
    weather: DataFrame,
    keep_null_weather: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Trips with both zones, joined to all dimensions. ``keep`` passes columns through.

    All columns of the fact but its key and load time, which reading it adds.

    The dimensions are stored tables, so their file sizes decide about the
    broadcast: as long as they are below ``spark.sql.autoBroadcastJoinThreshold``
    the trips are not shuffled. A larger dimension turns into a shuffle join
    whose hot keys adaptive execution splits.
    """
    trips = (
        has_zones(cleaned)
        .drop("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")
        .withColumn("date_key", F.to_date("pickup_datetime"))
    )
    observed = weather.select(
        "date_key",
        "weather_key",
        *NO_WEATHER,
        "weather_description",
        "temperature_category",
    )
    joined = (
        trips.join(times.select("date_key", "time_key"), "date_key", "left")
        .join(_role(locations, "pickup"), "pickup_location_id", "left")
        .join(_role(locations, "dropoff"), "dropoff_location_id", "left")
        .join(observed, "date_key", "left")
    )
    return joined.select(
        "time_key",
        "pickup_location_key",
        "dropoff_location_key",
        F.coalesce("weather_key", F.lit(NO_WEATHER_KEY).cast("long")).alias("weather_key"),
        "rate_code_id",
        "store_and_fwd_flag",
        "pickup_datetime",
        "dropoff_datetime",
        "hour_of_day",
        "day_of_week",
        "is_weekend",
        "is_peak_hour",
        "trip_distance",
        "trip_duration_min",
        "passenger_count",
        "fare_amount",
        "extra",
        "mta_tax",
        "tip_amount",
        "tolls_amount",
        "total_amount",
        "tip_percentage",
        "pickup_longitude",
        "pickup_latitude",
        "dropoff_longitude",
        "dropoff_latitude",
        *weather_or_default(keep_null_weather),
        labels.duration_label(F.col("trip_duration_min")).alias("trip_duration_category"),
        labels.tip_label(F.col("fare_amount"), F.col("tip_percentage")).alias("tip_category"),
        *keep,
    )


def ordered_fact(
    cleaned: DataFrame,
    times: DataFrame,
    locations: DataFrame,
    weather: DataFrame,
    scratch: str,
    range_rows: int = RANGE_ROWS,
) -> tuple[DataFrame, DataFrame | None]:
    """Fact rows in trip order with month, range and place, and the offsets of their ranges.

    Cleaned trips are cut to the columns of the fact, dealt to counted ranges and sorted
    before the joins: trips move once, and broadcast joins keep the order. The offsets are
    None when single minutes had to be cut; then written ranges are counted.
    """
    spark = cleaned.sparkSession
    narrow = has_zones(cleaned).select(*_TRIP_COLUMNS)
    wanted = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    wanted = int(wanted or spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = counted_ranges(narrow, TRIP_ORDER, MONTH_PARTITION, scratch, wanted, range_rows)
    keep = (MONTH_PARTITION, "part_no", "row_no")
    return build_fact(ranges.placed(narrow), times, locations, weather, keep=keep), ranges.offsets


def with_load_time(stored: DataFrame) -> DataFrame:
    """Adds ``loaded_at``: when the file a row is in was written.

    Kept by the file system already, so it is neither stored per row nor a literal
    that makes every run of the build compile anew.
    """
    return stored.select("*", F.col("_metadata.file_modification_time").alias("loaded_at"))
