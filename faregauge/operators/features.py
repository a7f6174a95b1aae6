"""Feature matrix for the regression models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregauge.operators.keys import broadcast_if_small, dense_key
from faregauge.operators.medians import exact_medians
from faregauge.sources.files import find_column

WEATHER_FEATURES = ("temperature_c", "precipitation_mm", "wind_speed", "weathercode")
NUMERIC = WEATHER_FEATURES + ("trip_distance", "passenger_count", "hour")
NO_BOROUGH = "UNKNOWN"

# Name and type of each column of the matrix.
FEATURE_TYPES = {
    "temperature_c": "double",
    "precipitation_mm": "double",
    "wind_speed": "double",
    "weathercode": "double",
    "hour": "bigint",
    "is_weekend": "int",
    "is_peak_hour": "int",
    "trip_distance": "float",
    "passenger_count": "int",
    "borough_enc": "int",
    "tip_percentage": "float",
    "trip_duration_min": "float",
}


def join_features(
    cleaned: DataFrame, weather: DataFrame | None = None, zones: DataFrame | None = None
) -> DataFrame:
    """Cleaned trips with the weather of the day and the pickup borough.

    Either side may be missing; its features are NULL then. Wind speed and
    weather code are NULL in any case, as the models are defined without them.
    """
    empty = {name: F.lit(None).cast("double").alias(name) for name in WEATHER_FEATURES}
    rows = cleaned.withColumn("date_actual", F.to_date("pickup_datetime"))
    if weather is not None:
        rows = rows.join(
            weather.select(
                "date_actual",
                F.col("avg_temperature").alias("temperature_c"),
                F.col("total_precipitation").alias("precipitation_mm"),
            ),
            "date_actual",
            "left",
        )
        empty["temperature_c"], empty["precipitation_mm"] = map(F.col, WEATHER_FEATURES[:2])
    borough = F.lit(None).cast("string").alias("borough")
    if zones is not None:
        place = zones.select(
            F.col(find_column(zones, "LocationID", "location_id")).alias("pickup_location_id"),
            F.col(find_column(zones, "borough")).cast("string").alias("borough"),
        )
        rows = rows.join(place, "pickup_location_id", "left")
        borough = F.col("borough")
    return rows.select(
        "pickup_datetime",
        "trip_duration_min",
        "tip_percentage",
        F.coalesce("hour_of_day", F.hour("pickup_datetime")).cast("bigint").alias("hour"),
        F.coalesce("is_weekend", F.lit(False)).alias("is_weekend"),
        F.coalesce("is_peak_hour", F.lit(False)).alias("is_peak_hour"),
        "trip_distance",
        "passenger_count",
        *empty.values(),
        borough,
    )


def as_numbers(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as doubles; what is no number becomes NULL."""
    return rows.withColumns({c: F.col(c).try_cast("double") for c in columns})


def fill_numbers(rows: DataFrame, values: Mapping[str, float | None]) -> DataFrame:
    """NULLs replaced by the given value of their column; None leaves them."""
    known = {c: v for c, v in values.items() if v is not None}
    return rows.fillna(known) if known else rows


def impute_median(rows: DataFrame, columns: Sequence[str] = NUMERIC) -> DataFrame:
    """NULLs replaced by the exact median of their column.

    Like fitting an imputer: the medians are computed here, a handful of numbers,
    and the replacement itself stays lazy. A column without values stays NULL.
    """
    numbers = as_numbers(rows, columns)
    return fill_numbers(numbers, exact_medians(numbers, columns, only_gappy=True))


def encode_borough(rows: DataFrame, staging: str) -> DataFrame:
    """Adds ``borough_enc``: codes from 0 in alphabetical order of the names present."""
    named = rows.withColumn("borough", F.coalesce("borough", F.lit(NO_BOROUGH)))
    codes = dense_key(named.select("borough").distinct(), ["borough"], "_code", staging)
    code: Column = (F.col("_code") - 1).cast("int").alias("borough_enc")
    return named.join(broadcast_if_small(codes.select("borough", code)), "borough")


def flags_to_int(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.col(c).cast("int") for c in ("is_weekend", "is_peak_hour")})


def build_features(
    cleaned: DataFrame, weather: DataFrame | None, zones: DataFrame | None, staging: str
) -> DataFrame:
    """The full matrix: joined, imputed, encoded, with declared types."""
    rows = impute_median(join_features(cleaned, weather, zones))
    rows = flags_to_int(encode_borough(rows, staging))
    return rows.select([F.col(c).cast(kind).alias(c) for c, kind in FEATURE_TYPES.items()])


def keyed_features(features: DataFrame, staging: str) -> DataFrame:
    """Features numbered in a total order, so that samples and splits are repeatable."""
    return dense_key(features, features.columns, "feature_id", staging)


def drop_empty_columns(features: DataFrame, target: str) -> DataFrame:
    """Leave out columns without any value and rows without a target.

    One pass counts the values of all columns. The columns are judged before the
    rows are dropped.
    """
    counts = features.agg(*[F.count(c).alias(c) for c in features.columns]).first()
    present = [c for c in features.columns if counts[c]]
    return features.select(present).where(F.col(target).isNotNull())


def draw(key: str, seed: int) -> Column:
    """32 hexadecimal digits that look random and depend on key and seed only."""
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))


def draw_number(digest: Column, first: int = 1) -> Column:
    """Eight digits of a draw as a number below 2**32."""
    return F.conv(F.substring(digest, first, 8), 16, 10).cast("bigint")


def sample_cap(features: DataFrame, rows: int = 150_000, key: str = "feature_id", seed: int = 42) -> DataFrame:
    """At most ``rows`` rows: those with the lowest draws.

    A threshold on the draw lets through slightly more than needed, so only
    about ``rows`` rows take part in the final top-k, however large the input.
    It is widened until enough pass, which keeps the result exact.
    """
    total = features.count()
    if total <= rows:
        return features
    share = 1.05 * rows / total
    while True:
        near = features.where(draw_number(draw(key, seed)) < int(share * 2**32))
        if share >= 1 or near.count() >= rows:
            break
        share *= 2
    return near.orderBy(draw(key, seed), key).limit(rows)


def is_training(key: str = "feature_id", seed: int = 42, tenths: int = 8) -> Column:
    """True for the share of rows that a model is fitted on."""
    return draw_number(draw(key, seed)) % 10 < tenths


def fold(key: str = "feature_id", seed: int = 42, folds: int = 5) -> Column:
    """Cross-validation fold of a row, independent of the train/test split."""
    return (draw_number(draw(key, seed), 9) % folds).cast("int")


def split_train_test(features: DataFrame, key: str = "feature_id", seed: int = 42) -> DataFrame:
    """Adds ``is_training`` and ``fold``."""
    return features.withColumns({"is_training": is_training(key, seed), "fold": fold(key, seed)})
