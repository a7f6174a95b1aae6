"""Data-quality audits and stage summaries. Every count of a table shares one scan."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregauge.functions.labels import anomaly_label, flag_count
from faregauge.operators.clean import PICKUP, is_clean
from faregauge.operators.filters import outside_dates, positive_total
from faregauge.operators.keys import sorted_evenly
from faregauge.settings import ZONE_ID_RANGE, CleanRules, Window


def exact_minutes() -> Column:
    """Duration in minutes without the rounding to 32 bits."""
    return F.timestamp_diff("MICROSECOND", F.col(PICKUP), F.col("tpep_dropoff_datetime")) / 1e6 / 60


def count_conditions(table: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One wide row: all rows, and the rows that meet each condition."""
    counts = [flag_count(test).alias(name) for name, test in conditions.items()]
    return table.agg(F.count("*").alias("total_rows"), *counts)


def unpivot_counts(wide: DataFrame, kind: str = "anomaly_type", count: str = "anomaly_count") -> DataFrame:
    """A wide row of counts to one row per count, the total beside each."""
    names = [c for c in wide.columns if c != "total_rows"]
    return wide.unpivot("total_rows", names, kind, count)


def percent(part: str, whole: str) -> Column:
    """Share in percent; 0 of an empty table."""
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole) * 100).otherwise(F.lit(0.0))


def dq_anomalies(raw: DataFrame) -> DataFrame:
    """Six kinds of bad trips with their share; a trip may count more than once."""
    minutes = exact_minutes()
    kinds = {
        "Negative Fare (Fare < 0)": F.col("fare_amount") < 0,
        "Missing Passenger (NULL)": F.col("passenger_count").isNull(),
        "Zero Passenger (Count = 0)": F.col("passenger_count") == 0,
        "Negative Duration": minutes < 0,
        "Too Long Duration (> 5hr)": minutes > 300,
        "Invalid Location ID": F.col("PULocationID").isNull() | F.col("DOLocationID").isNull(),
    }
    rows = unpivot_counts(count_conditions(raw, kinds))
    return rows.select(
        "anomaly_type", "anomaly_count", percent("anomaly_count", "total_rows").alias("pct_of_raw")
    )


def dq_null_rates(
    raw: DataFrame, columns=("PULocationID", "DOLocationID", PICKUP)
) -> DataFrame:
    """NULL count and rate of the columns no trip can do without."""
    counts = count_conditions(raw, {c: F.col(c).isNull() for c in columns})
    return unpivot_counts(counts, "column", "null_rows").select(
        "column",
        "null_rows",
        F.when(F.col("total_rows") > 0, F.col("null_rows") / F.col("total_rows"))
        .otherwise(F.lit(0.0))
        .alias("null_rate"),
    )


def fk_integrity(raw: DataFrame, locations: DataFrame) -> DataFrame:
    """How many zone numbers of either end have no row in the location dimension.

    Trips are first counted per zone number, so the join sees one row per number
    and end, and a busy zone is a single pre-aggregated row.
    """
    ends = F.explode(
        F.array(
            *[
                F.struct(F.lit(end).alias("join_key"), F.col(end).alias("location_id"))
                for end in ("PULocationID", "DOLocationID")
            ]
        )
    ).alias("end")
    per_zone = raw.select(ends).groupBy("end").agg(F.count("*").alias("trips"))
    known = locations.select("location_id", F.lit(True).alias("known"))
    return (
        per_zone.select("end.*", "trips")
        .join(known, "location_id", "left")
        .groupBy("join_key")
        .agg(
            F.sum("trips").alias("total_rows"),
            F.sum(F.when(F.col("known").isNull(), F.col("trips")).otherwise(0)).alias("unmatched_rows"),
        )
        .withColumn("match_rate", 1 - F.col("unmatched_rows") / F.col("total_rows"))
    )


def dq_temporal(raw: DataFrame, window: Window = Window()) -> DataFrame:
    """Number of pickups outside the reporting window."""
    return outside_dates(raw, window, PICKUP).agg(F.count("*").alias("out_of_range_rows"))


def dq_temporal_rows(raw: DataFrame, window: Window = Window()) -> DataFrame:
    """All pickups outside the reporting window in time order."""
    columns = ("passenger_count", "fare_amount", "trip_distance", "PULocationID", "DOLocationID")
    rows = outside_dates(raw, window, PICKUP).select(PICKUP, *columns)
    return sorted_evenly(rows, F.col(PICKUP))


def money_tests() -> dict[str, tuple[Column, str]]:
    """Test and description of each kind of implausible amount; the texts are fixed values."""
    fare, total = F.col("fare_amount"), F.col("total_amount")
    return {
        "negative_fare": (fare < 0, "fare_amount < 0 (refund/koreksi)"),
        "zero_fare": (fare == 0, "fare_amount = 0"),
        "non_positive_fare": (fare <= 0, "fare_amount <= 0"),
        "negative_total": (total < 0, "total_amount < 0"),
        "zero_total": (total == 0, "total_amount = 0"),
        "non_positive_total": (total <= 0, "total_amount <= 0"),
    }


def dq_financial(raw: DataFrame) -> DataFrame:
    tests = money_tests()
    names = ("non_positive_fare", "non_positive_total")
    return raw.agg(*[flag_count(tests[name][0]).alias(name) for name in names])


def dq_money_summary(raw: DataFrame) -> DataFrame:
    """Implausible amounts by kind with rate and description, most frequent first."""
    tests = money_tests()
    described = F.create_map(
        *[F.lit(text) for name, (_, about) in tests.items() for text in (name, about)]
    )
    rows = unpivot_counts(count_conditions(raw, {name: test for name, (test, _) in tests.items()}))
    return rows.select(
        "anomaly_type",
        "anomaly_count",
        F.round(percent("anomaly_count", "total_rows"), 4).alias("anomaly_rate_pct"),
        described[F.col("anomaly_type")].alias("description"),
    ).orderBy(F.desc("anomaly_count"), "anomaly_type")


def dq_logic(raw: DataFrame) -> DataFrame:
    """Trips that did not move, trips without passengers, and trips with both."""
    still, empty = F.col("trip_distance") == 0, F.col("passenger_count") == 0
    return raw.agg(
        flag_count(still).alias("zero_distance_rows"),
        flag_count(empty).alias("zero_passenger_rows"),
        flag_count(still & empty).alias("both_conditions_rows"),
    )


EVIDENCE = (
    PICKUP,
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "PULocationID",
    "DOLocationID",
)


def dq_logic_evidence(raw: DataFrame, top: int = 20) -> DataFrame:
    """Example trips, the worst kind first; all columns take part in the order."""
    distance, passengers = F.col("trip_distance"), F.col("passenger_count")
    label = anomaly_label(distance, passengers)
    severity = F.when(label == "zero_distance_and_zero_passenger", 1).when(
        label == "zero_distance", 2
    ).otherwise(3)
    ties = [F.col(c).asc_nulls_last() for c in EVIDENCE]
    return (
        raw.where((distance == 0) | (passengers == 0))
        .select(*EVIDENCE, label.alias("anomaly_type"), severity.alias("_severity"))
        .orderBy("_severity", *ties)
        .limit(top)
        .drop("_severity")
    )


def dq_location_range(raw: DataFrame) -> DataFrame:
    """Zone numbers outside the valid range; a missing number is not invalid."""
    low, high = ZONE_ID_RANGE
    return raw.agg(
        flag_count(~F.col("PULocationID").between(low, high)).alias("invalid_pickup_id"),
        flag_count(~F.col("DOLocationID").between(low, high)).alias("invalid_dropoff_id"),
    )


def labelled_counts(tables: Mapping[str, DataFrame], label: str = "stage") -> DataFrame:
    """Row count of each named table, one row each."""
    counts = [
        table.agg(F.count("*").alias("row_count")).select(F.lit(name).alias(label), "row_count")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def dq_retention(raw: DataFrame, cleaned: DataFrame, fact: DataFrame) -> DataFrame:
    return labelled_counts({"tlc_raw": raw, "tlc_cleaned": cleaned, "fact_trips": fact})


def _clean_tests(rules: CleanRules) -> dict[str, Column]:
    minutes = exact_minutes()
    return {
        "fare_negative": F.col("fare_amount") < 0,
        "duration_negative": minutes < 0,
        "duration_too_long": minutes > rules.max_minutes,
        "passenger_zero": F.col("passenger_count") == 0,
    }


def s_clean_report(raw: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    """Rows before and after cleaning, retention, and the kinds of anomaly that occur.

    One scan of the raw trips; rows (metric, value).
    """
    wide = count_conditions(raw, {"rows_after": is_clean(rules), **_clean_tests(rules)})
    before, after = F.col("total_rows"), F.coalesce("rows_after", F.lit(0))
    rows = wide.select(
        before.cast("double").alias("rows_before"),
        after.cast("double").alias("rows_after"),
        (before - after).cast("double").alias("rows_removed"),
        F.when(before > 0, after / before * 100).otherwise(F.lit(0.0)).alias("retention_rate"),
        *[F.col(name).cast("double").alias(name) for name in _clean_tests(rules)],
    ).unpivot([], None, "metric", "value")
    return rows.where((F.col("value") > 0) | ~F.col("metric").isin(*_clean_tests(rules)))


def s_weather_report(days: DataFrame, transformed: DataFrame) -> DataFrame:
    """Weather rows before and after the transformation, and how many were dropped."""
    sides = labelled_counts({"before": days, "after": transformed}, "side")
    size = {s: F.sum(F.when(F.col("side") == s, F.col("row_count"))) for s in ("before", "after")}
    return sides.agg(
        size["before"].alias("rows_before"),
        size["after"].alias("rows_after"),
        (size["before"] - size["after"]).alias("anomalies_found"),
    )


def s_schema_summary(
    fact: DataFrame, times: DataFrame, locations: DataFrame, weather: DataFrame
) -> DataFrame:
    """Totals, period, revenue, averages and dimension sizes in one row.

    Revenue figures skip trips without a positive total. Each table is reduced to
    one row and the rows are merged by taking the only value of every column, so
    no join is needed.
    """
    paid = positive_total()
    facts = fact.agg(
        F.count("*").alias("total_trips"),
        F.min("pickup_datetime").alias("min_date"),
        F.max("pickup_datetime").alias("max_date"),
        F.sum(F.when(paid, F.col("total_amount"))).alias("total_revenue"),
        F.avg(F.when(paid, F.col("total_amount"))).alias("avg_fare"),
        F.avg(F.when(paid, F.col("tip_percentage"))).alias("avg_tip_pct"),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("trip_duration_min").alias("avg_duration"),
        F.avg("passenger_count").alias("avg_passengers"),
    )
    sizes = [
        table.agg(F.count("*").alias(name))
        for name, table in (
            ("dim_time_rows", times),
            ("dim_location_rows", locations),
            ("dim_weather_rows", weather),
        )
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [facts, *sizes])
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])
