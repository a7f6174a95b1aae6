"""Fact table, reports and audits on hand-made rows."""

from datetime import date, datetime

import pytest
from conftest import values
from pyspark.sql import functions as F

from faregauge.operators import dimensions, fact, features
from faregauge.operators.filters import TripFilter
from faregauge.plans import models, quality, reports
from faregauge.plans.star import StarSchema, TableStore
from faregauge.schemas import ML_RESULTS, TRIPS_RAW, WEATHER_DAILY, ZONE_LOOKUP
from faregauge.settings import Window
from faregauge.sources.files import empty_table
from test_clean_and_labels import trip


def at(month, day, hour=12, **changes):
    start = datetime(2025, month, day, hour)
    return trip(tpep_pickup_datetime=start, tpep_dropoff_datetime=start.replace(minute=20), **changes)


ROWS = [
    at(1, 1),
    at(1, 1, 8, PULocationID=2, tip_amount=30.0),
    at(1, 2, PULocationID=99),
    at(1, 3, PULocationID=None),
    at(2, 1, fare_amount=0.0, tip_amount=0.0),
    at(7, 1),
    at(8, 1, passenger_count=0),
]
DAYS = [(date(2025, 1, 1), 12.0, 10.0, 14.0, 50.0, 1.0, 3.0, 4.0, 61.0, "Rain")]
ZONES = [(1, "A", "One", "s", 40.7, -74.0), (2, "B", "Two", "s", 10.0, -74.0)]


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    frame = spark.createDataFrame
    return StarSchema(
        TableStore(spark, str(tmp_path_factory.mktemp("star"))),
        lambda: frame(ROWS, TRIPS_RAW),
        lambda: frame(DAYS, WEATHER_DAILY),
        lambda: frame(ZONES, ZONE_LOOKUP),
    )


def test_sizes(star):
    assert star.cleaned().count() == 6
    assert star.fact().count() == 5
    assert values(star.dim_time(), "time_key", "date_key")[0] == (1, date(2025, 1, 1))
    assert values(star.dim_location().orderBy("location_key"), "location_key", "location_id", "borough") == [
        (1, 1, "A"), (2, 2, "B"), (3, 99, None),
    ]


def test_fact_columns(star):
    columns = [c for c in star.fact().columns if c != "pickup_month"]
    assert len(columns) == 36 and columns[0] == "trip_id"


def test_every_key_resolves_or_is_unknown(star):
    trips = star.fact()
    for key, table in (("time_key", star.dim_time()), ("weather_key", star.dim_weather())):
        lost = trips.join(table.select(key), key, "left_anti").where(F.col(key) != -1)
        assert lost.isEmpty()
    ids = values(trips.orderBy("trip_id"), "trip_id", "weather_key")
    assert ids == [(1, 1), (2, 1), (3, -1), (4, -1), (5, -1)]


def test_missing_weather_and_zone(star):
    row = star.fact().where(F.col("trip_id") == 3).first()
    assert (row["temperature_2m"], row["relative_humidity_2m"], row["precipitation"]) == (-999.0, -1.0, 0.0)
    assert (row["weather_description"], row["temperature_category"]) == ("Unknown", "Unknown")
    assert row["pickup_latitude"] is None


def test_null_weather_variant(star):
    rows = fact.build_fact(
        star.cleaned(), star.dim_time(), star.dim_location(), star.dim_weather(), keep_null_weather=True
    )
    assert rows.where(F.col("temperature_2m") < -100).isEmpty()
    assert rows.where(F.col("temperature_2m").isNull()).count() == 3


def test_without_zones_and_weather(spark, star, tmp_path):
    bare = StarSchema(
        TableStore(spark, str(tmp_path)),
        lambda: spark.createDataFrame(ROWS, TRIPS_RAW),
        lambda: empty_table(spark, WEATHER_DAILY),
        lambda: empty_table(spark, ZONE_LOOKUP),
    )
    assert bare.fact().count() == 5
    assert values(bare.fact().select("weather_key").distinct()) == [(-1,)]
    assert bare.dim_location().where(F.col("latitude").isNotNull()).isEmpty()


def test_window_and_reports(star):
    rows = star.fact_rows()
    assert values(reports.a01_overview(rows), "total_trips") == [(3,)]
    assert values(reports.a10_outliers(rows), "total_rows", "tip_above_200") == [(4, 1)]
    places = star.dim_location()
    assert values(reports.a13_borough(rows, places), "borough", "total_trips") == [("A", 2), (None, 1)]
    assert values(reports.a14_map(rows, places), "zone_name", "total_trips") == [("One", 2)]
    assert values(reports.a12_top_zones(rows, places), "zone_name", "total_trips") == [("One", 2), (None, 1)]


def test_empty_choices(star):
    rows, places = star.fact_rows(), star.dim_location()
    count = lambda **kind: TripFilter(**kind).apply(rows, places).count()
    assert count() == 3
    assert count(weather=[]) == count(temperature=[]) == 0
    assert count(boroughs=[]) == 3
    assert count(boroughs=["A"]) == 2
    assert count(weather=["it's"]) == 0
    joined = TripFilter(boroughs=["A"]).apply_joined(rows, places)
    assert joined.count() == 2


def test_weekdays_start_on_monday(star):
    names = [n for (n,) in values(reports.q_day_of_week(star.fact_rows(), star.dim_time()), "day_of_week_name")]
    week = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    assert names == sorted(names, key=week.index)


def test_inner_weather_join_drops_unknown(star):
    assert values(reports.q_weather_top10(star.fact_rows(), star.dim_weather()), "trip_count") == [(2,)]


def test_dashboard_rows(star):
    rows, places = star.fact_rows(), star.dim_location()
    assert values(reports.d_map_kpis(reports.d_map(rows, places))) == [(1, 1, "One")]
    assert values(reports.d_hourly(rows, places, metric="Duration")) == [(12, 20.0)]
    assert ("borough", "B") in values(reports.d_filters(rows, places))
    assert values(reports.d_peak(rows, places), "period", "total_trips") == [("Non-Peak Hour", 3)]


def test_one_row_counts_in_two_anomalies(make):
    raw = make([trip(fare_amount=-1.0, passenger_count=0)], TRIPS_RAW)
    found = dict(values(quality.dq_anomalies(raw), "anomaly_type", "anomaly_count"))
    assert found["Negative Fare (Fare < 0)"] == found["Zero Passenger (Count = 0)"] == 1
    assert sum(found.values()) == 2


def test_audits(make):
    raw = make(
        [
            trip(trip_distance=0.0, passenger_count=0, PULocationID=300),
            trip(trip_distance=0.0, PULocationID=None),
            trip(tpep_pickup_datetime=datetime(2024, 1, 1), total_amount=0.0),
        ],
        TRIPS_RAW,
    )
    assert values(quality.dq_logic(raw)) == [(2, 1, 1)]
    assert values(quality.dq_location_range(raw)) == [(1, 0)]
    assert values(quality.dq_temporal(raw)) == [(1,)]
    kinds = [k for (k,) in values(quality.dq_logic_evidence(raw), "anomaly_type")]
    assert kinds == ["zero_distance_and_zero_passenger", "zero_distance"]
    assert dict(values(quality.dq_null_rates(raw), "column", "null_rows"))["PULocationID"] == 1
    places = make([(1,), (2,)], "location_id int")
    got = {k: (n, m) for k, n, m, _ in values(quality.fk_integrity(raw, places))}
    assert got == {"PULocationID": (3, 2), "DOLocationID": (3, 0)}


def test_clean_report(make):
    raw = make([trip(), trip(fare_amount=-1.0)], TRIPS_RAW)
    assert dict(values(quality.s_clean_report(raw))) == {
        "rows_before": 2.0, "rows_after": 1.0, "rows_removed": 1.0, "retention_rate": 50.0, "fare_negative": 1.0,
    }


def test_summary_counts_all_dimensions(star):
    summary = quality.s_schema_summary(
        star.fact_rows(), star.dim_time(), star.dim_location(), star.dim_weather()
    ).first()
    assert (summary["total_trips"], summary["dim_time_rows"], summary["dim_location_rows"]) == (5, 5, 3)
    assert summary["dim_weather_rows"] == 1


def test_features(star):
    rows = star.features()
    assert [c for c in rows.columns if c != "feature_id"] == list(features.FEATURE_TYPES)
    assert values(rows.agg(F.count("*"), F.count("wind_speed"), F.min("temperature_c"))) == [(6, 0, 12.0)]
    assert {c for (c,) in values(rows.select("borough_enc").distinct())} == {0, 1, 2}
    usable = features.drop_empty_columns(rows, "tip_percentage")
    assert "wind_speed" not in usable.columns and "temperature_c" in usable.columns


def test_features_find_their_columns(star, make):
    zones = make([(1, "A")], "LocationID int, BOROUGH string")
    rows = features.join_features(star.cleaned(), None, zones)
    assert values(rows.agg(F.count("borough"), F.count("temperature_c"))) == [(3, 0)]
    with pytest.raises(ValueError, match="none of"):
        features.join_features(star.cleaned(), None, zones.drop("BOROUGH"))


def test_forest_beats_the_mean(spark, tmp_path):
    """A target that depends on the features is learned; the saved model predicts the same."""
    rows = spark.range(1, 801).select(
        F.col("id").alias("feature_id"),
        (F.col("id") % 7).cast("double").alias("trip_distance"),
        (F.col("id") % 5).cast("int").alias("passenger_count"),
        F.lit(None).cast("double").alias("wind_speed"),
        (F.col("id") % 7 * 3).cast("float").alias("tip_percentage"),
        (F.col("id") % 11).cast("float").alias("trip_duration_min"),
    )
    small = models.Forest("tip_model", "tip_percentage", "trip_duration_min", depth=5, trees=5)
    metrics = models.train(rows, small, str(tmp_path / "m")).first()
    assert metrics["test_r2"] > 0.9 and metrics["cv_rmse"] < 3
    assert metrics["n_train"] + metrics["n_test"] == 800
    model = models.load_model(spark, str(tmp_path / "m"))
    assert model.inputs == ["trip_distance", "passenger_count"]
    scores = dict(values(models.importances(model, "importance_tip")))
    assert sum(scores.values()) == pytest.approx(1)
    assert scores["trip_distance"] > scores["passenger_count"]


def test_weather_impact(make):
    rows = [("temperature_c", 0.2, 0.1, 0.15, True), ("hour", 0.6, 0.9, 0.75, False), ("wind_speed", 0.2, 0.0, 0.1, True)]
    results = make(rows, ML_RESULTS)
    impact = models.weather_impact(results).first()
    assert (impact["weather_impact_tip_pct"], impact["weather_impact_duration_pct"]) == (40.0, 10.0)
    assert (impact["is_tip_significant"], impact["is_duration_significant"]) == (True, False)
    assert values(models.top_weather_features(results, 1), "feature_name") == [("temperature_c",)]


def test_window_defaults():
    assert Window() == Window(date(2025, 1, 1), date(2025, 7, 1), 0.0, 100.0)


def test_dim_location_projection_rounds(make):
    rows = dimensions.zone_attributes(make([(1,)], "location_id int"), make(ZONES, ZONE_LOOKUP))
    assert values(rows, "latitude_rounded", "zone_name") == [(pytest.approx(40.7), "One")]
