"""Reports on the fact table: analysis (a), quick looks (q) and dashboard (d)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregauge.functions.calendar import weekday_rank
from faregauge.functions.labels import flag_count, peak_label
from faregauge.operators.filters import (
    TripFilter,
    in_dates,
    in_window,
    known_temperature,
    plottable,
    with_pickup_location,
)
from faregauge.settings import Window

def mean(*columns: str) -> list[Column]:
    return [F.avg(column).alias(f"avg_{column}") for column in columns]


TIP, DURATION, DISTANCE, TOTAL = (
    "tip_percentage",
    "trip_duration_min",
    "trip_distance",
    "total_amount",
)


def descending(column: str) -> Column:
    return F.col(column).desc_nulls_last()


def ascending(column: str) -> Column:
    return F.col(column).asc_nulls_last()


def grouped(trips: DataFrame, keys: Sequence[str], *means: str) -> DataFrame:
    """Trip count and mean values per key; partial aggregation before the shuffle."""
    return trips.groupBy(*keys).agg(F.count("*").alias("total_trips"), *mean(*means))


# --- analysis reports -----------------------------------------------------------


def overview(trips: DataFrame, *extra: Column) -> DataFrame:
    """Size, period and mean values of the selected trips in one row."""
    return trips.agg(
        F.count("*").alias("total_trips"),
        F.min("pickup_datetime").alias("start_date"),
        F.max("pickup_datetime").alias("end_date"),
        *mean(TIP, DURATION, DISTANCE),
        *extra,
    )


def a01_overview(fact: DataFrame, window: Window = Window()) -> DataFrame:
    return overview(in_window(fact, window), F.sum("total_amount").alias("total_revenue"))


def a02_weather(fact: DataFrame, window: Window = Window()) -> DataFrame:
    rows = grouped(
        in_window(fact, window), ["weather_description"], TIP, DURATION, DISTANCE, TOTAL
    )
    return rows.orderBy(descending("avg_tip_percentage"))


def a03_temperature(fact: DataFrame, window: Window = Window()) -> DataFrame:
    """The mean temperature of trips without weather is the stand-in value."""
    rows = grouped(
        in_window(fact, window), ["temperature_category"], "temperature_2m", TIP, DURATION
    ).withColumnRenamed("avg_temperature_2m", "avg_temperature")
    return rows.orderBy(ascending("avg_temperature"))


def _hour_by_weather(fact: DataFrame, window: Window, measure: str) -> DataFrame:
    keys = ["hour_of_day", "weather_description"]
    return grouped(in_window(fact, window), keys, measure).orderBy(*map(ascending, keys))


def a04_tip_hour_weather(fact: DataFrame, window: Window = Window()) -> DataFrame:
    return _hour_by_weather(fact, window, TIP)


def a05_duration_hour_weather(fact: DataFrame, window: Window = Window()) -> DataFrame:
    return _hour_by_weather(fact, window, DURATION)


def a06_peak_weather(fact: DataFrame, window: Window = Window()) -> DataFrame:
    keys = ["is_peak_hour", "weather_description"]
    rows = grouped(in_window(fact, window), keys, TIP, DURATION, DISTANCE)
    return rows.orderBy(*map(ascending, keys))


def a07_tip_category(fact: DataFrame, window: Window = Window()) -> DataFrame:
    rows = grouped(in_window(fact, window), ["tip_category"], TIP, "fare_amount", TOTAL)
    return rows.orderBy(descending("total_trips"))


def a08_duration_category(fact: DataFrame, window: Window = Window()) -> DataFrame:
    rows = grouped(in_window(fact, window), ["trip_duration_category"], DURATION, TIP)
    return rows.orderBy(ascending("avg_trip_duration_min"))


def a09_quality(fact: DataFrame, window: Window = Window()) -> DataFrame:
    return in_window(fact, window).agg(
        F.count("*").alias("total_rows"),
        flag_count(F.col("tip_percentage").isNull()).alias("null_tip_percentage"),
        flag_count(F.col("trip_duration_min").isNull()).alias("null_trip_duration"),
        flag_count(F.col("weather_description").isNull()).alias("null_weather_description"),
        F.min("tip_percentage").alias("min_tip_percentage"),
        F.max("tip_percentage").alias("max_tip_percentage"),
        F.min("trip_duration_min").alias("min_trip_duration"),
        F.max("trip_duration_min").alias("max_trip_duration"),
    )


def a10_outliers(fact: DataFrame, window: Window = Window(), limits=(100, 200, 500, 1000)) -> DataFrame:
    """Tips far above the fare, before the tip range is applied."""
    tip = F.col("tip_percentage")
    return in_dates(fact, window).agg(
        F.count("*").alias("total_rows"),
        *[flag_count(tip > limit).alias(f"tip_above_{limit}") for limit in limits],
        F.max(tip).alias("max_tip_percentage"),
    )


def _at_pickup(fact: DataFrame, locations: DataFrame, window: Window) -> DataFrame:
    return with_pickup_location(in_window(fact, window), locations)


def a11_borough_weather(fact: DataFrame, locations: DataFrame, window: Window = Window()) -> DataFrame:
    keys = ["borough", "weather_description"]
    rows = grouped(_at_pickup(fact, locations, window), keys, TIP, DURATION, DISTANCE, TOTAL)
    return rows.orderBy(ascending("borough"), descending("avg_tip_percentage"))


def busiest_zones(trips: DataFrame, *means: str, top: int = 25) -> DataFrame:
    """Zones with most trips; names break ties, so that the cut is repeatable."""
    keys = ["borough", "zone_name"]
    rows = grouped(trips, keys, TIP, DURATION, *means)
    return rows.orderBy(descending("total_trips"), *map(ascending, keys)).limit(top)


def a12_top_zones(fact: DataFrame, locations: DataFrame, window: Window = Window()) -> DataFrame:
    return busiest_zones(_at_pickup(fact, locations, window), DISTANCE)


def a13_borough(fact: DataFrame, locations: DataFrame, window: Window = Window()) -> DataFrame:
    trips = _at_pickup(fact, locations, window)
    rows = grouped(trips, ["borough"], TIP, DURATION, DISTANCE, TOTAL)
    return rows.orderBy(descending("total_trips"))


def map_points(trips: DataFrame) -> DataFrame:
    """One point per zone whose centre lies on the map."""
    keys = ["borough", "zone_name", "latitude", "longitude"]
    return grouped(trips.where(plottable()), keys, TIP, DURATION).orderBy(descending("total_trips"))


def a14_map(fact: DataFrame, locations: DataFrame, window: Window = Window()) -> DataFrame:
    return map_points(_at_pickup(fact, locations, window))


# --- quick looks: whole fact table, values rounded to cents ----------------------


def _round_mean(column: str, name: str) -> Column:
    return F.round(F.avg(column), 2).alias(name)


def _trip_count() -> Column:
    return F.count("*").alias("trip_count")


def _avg_fare() -> Column:
    return _round_mean("total_amount", "avg_fare")


def _avg_tip() -> Column:
    return _round_mean("tip_percentage", "avg_tip_pct")


def with_time(fact: DataFrame, times: DataFrame, *columns: str) -> DataFrame:
    return fact.join(times.select("time_key", *columns), "time_key")


def with_weather(fact: DataFrame, weather: DataFrame, *columns: str) -> DataFrame:
    """Trips with columns of their weather day; trips without weather are left out."""
    return fact.drop(*columns).join(weather.select("weather_key", *columns), "weather_key")


WEEKDAY = ("day_of_week_name", "day_of_week_number")


def q_day_of_week(fact: DataFrame, times: DataFrame) -> DataFrame:
    """Monday first. The day number is grouped too, which makes the order well defined."""
    rows = with_time(fact, times, *WEEKDAY).groupBy(*WEEKDAY).agg(_trip_count(), _avg_fare(), _avg_tip())
    return rows.orderBy(weekday_rank(F.col("day_of_week_number"))).drop("day_of_week_number")


def q_peak(fact: DataFrame) -> DataFrame:
    period = F.coalesce(
        peak_label(F.col("is_peak_hour"), "Peak (7-9, 17-19)", "Off-peak"), F.lit("Off-peak")
    )
    return fact.groupBy(period.alias("time_period")).agg(
        _trip_count(),
        _avg_fare(),
        _round_mean("trip_duration_min", "avg_duration_min"),
        _round_mean("trip_distance", "avg_distance_miles"),
    )


def q_weather_top10(fact: DataFrame, weather: DataFrame, top: int = 10) -> DataFrame:
    keys = ["temperature_category", "weather_description"]
    trips = with_weather(fact, weather.where(known_temperature()), *keys)
    rows = trips.groupBy(*keys).agg(_trip_count(), _avg_fare(), _avg_tip())
    return rows.orderBy(descending("trip_count"), *map(ascending, keys)).limit(top)


def q_top_locations(fact: DataFrame, locations: DataFrame, top: int = 10) -> DataFrame:
    trips = with_pickup_location(fact, locations)
    rows = trips.groupBy(
        "location_id", F.round("latitude", 4).alias("lat"), F.round("longitude", 4).alias("lon")
    ).agg(F.count("*").alias("pickup_count"), _avg_fare())
    return rows.orderBy(descending("pickup_count"), ascending("location_id")).limit(top)


def q_revenue(fact: DataFrame, times: DataFrame) -> DataFrame:
    trips = with_time(fact, times, *WEEKDAY)
    rows = trips.groupBy(F.month("pickup_datetime").alias("month"), *WEEKDAY).agg(
        F.count("*").alias("trips"),
        F.round(F.sum("total_amount"), 2).alias("total_revenue"),
        _avg_fare(),
        F.round(F.sum("tip_amount"), 2).alias("total_tips"),
    )
    order = weekday_rank(F.col("day_of_week_number"))
    return rows.orderBy("month", order).drop("day_of_week_number")


def q_daily_stats(fact: DataFrame, times: DataFrame) -> DataFrame:
    rows = with_time(fact, times, "date_actual").groupBy("date_actual").agg(
        _trip_count(),
        _avg_fare(),
        F.round(F.sum("total_amount"), 2).alias("total_revenue"),
        _round_mean("trip_distance", "avg_distance"),
    )
    return rows.orderBy("date_actual")


def q_weekday_temperature(fact: DataFrame, times: DataFrame, weather: DataFrame) -> DataFrame:
    keys = ["day_of_week_name", "temperature_category"]
    trips = with_time(with_weather(fact, weather, "temperature_category"), times, keys[0])
    rows = trips.groupBy(*keys).agg(
        _trip_count(),
        F.avg("total_amount").alias("avg_fare"),
        F.avg("tip_percentage").alias("avg_tip_pct"),
    )
    return rows.orderBy(*map(ascending, keys))


# --- dashboard reports ------------------------------------------------------------


def options(table: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values to choose from."""
    return table.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def d_filters(fact: DataFrame, locations: DataFrame, window: Window = Window()) -> DataFrame:
    """All choices of the three selections, as (filter, option) rows.

    Weather and temperature come from one scan of the window.
    """
    trips = in_window(fact, window)
    both = trips.select("weather_description", "temperature_category").distinct()
    chosen = both.unpivot([], both.columns, "filter", "option")
    places = locations.select(F.lit("borough").alias("filter"), F.col("borough").alias("option"))
    return (
        chosen.unionByName(places)
        .where(F.col("option").isNotNull())
        .distinct()
        .orderBy("filter", "option")
    )


def d_overview(fact: DataFrame, locations: DataFrame, chosen: TripFilter = TripFilter()) -> DataFrame:
    return overview(chosen.apply(fact, locations))


def d_weather_dist(fact: DataFrame, locations: DataFrame, chosen: TripFilter = TripFilter()) -> DataFrame:
    rows = grouped(chosen.apply(fact, locations), ["weather_description"], TIP, DURATION)
    return rows.orderBy(descending("total_trips"))


def d_map(fact: DataFrame, locations: DataFrame, chosen: TripFilter = TripFilter()) -> DataFrame:
    return map_points(chosen.apply_joined(fact, locations))


def d_map_kpis(points: DataFrame) -> DataFrame:
    """Number of zones and boroughs on the map and the zone with most trips."""
    place = F.struct(-F.col("total_trips"), "borough", "zone_name", "latitude", "longitude")
    return points.agg(
        F.count("*").alias("active_zones"),
        F.count_distinct("borough").alias("active_boroughs"),
        F.min_by("zone_name", place).alias("busiest_zone"),
    )


def d_borough(fact: DataFrame, locations: DataFrame, chosen: TripFilter = TripFilter()) -> DataFrame:
    rows = grouped(chosen.apply_joined(fact, locations), ["borough"], TIP, DURATION)
    return rows.orderBy(descending("total_trips"))


def d_top_zones(fact: DataFrame, locations: DataFrame, chosen: TripFilter = TripFilter()) -> DataFrame:
    return busiest_zones(chosen.apply_joined(fact, locations))


def d_weather_summary(
    fact: DataFrame,
    locations: DataFrame,
    chosen: TripFilter = TripFilter(),
    sort_by: str = "avg_tip_percentage",
) -> DataFrame:
    trips = chosen.apply(fact, locations)
    rows = grouped(trips, ["weather_description"], TIP, DURATION, DISTANCE, TOTAL)
    return rows.orderBy(descending(sort_by))


METRICS = {"Tip": "tip_percentage", "Duration": "trip_duration_min"}


def d_hourly(
    fact: DataFrame, locations: DataFrame, chosen: TripFilter = TripFilter(), metric: str = "Tip"
) -> DataFrame:
    """Hourly trend of the chosen metric."""
    trips = chosen.apply(fact, locations)
    value = F.avg(METRICS[metric]).alias("metric_value")
    return trips.groupBy("hour_of_day").agg(value).orderBy("hour_of_day")


def d_peak(fact: DataFrame, locations: DataFrame, chosen: TripFilter = TripFilter()) -> DataFrame:
    rows = grouped(chosen.apply(fact, locations), ["is_peak_hour"], TIP, DURATION)
    return rows.withColumn("period", peak_label(F.col("is_peak_hour"))).orderBy("is_peak_hour")
