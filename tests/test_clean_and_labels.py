"""Boundary cases of cleaning rules and labels."""

from datetime import date, datetime

import pytest
from conftest import values
from pyspark.sql import functions as F

from faregauge.functions import calendar, labels
from faregauge.operators import clean, filters
from faregauge.schemas import TRIPS_RAW
from faregauge.settings import Window

NOON = datetime(2025, 3, 5, 12, 0)


def trip(**changes):
    base = {
        "tpep_pickup_datetime": NOON,
        "tpep_dropoff_datetime": datetime(2025, 3, 5, 12, 10),
        "passenger_count": 1,
        "trip_distance": 2.0,
        "fare_amount": 10.0,
        "tip_amount": 2.0,
        "PULocationID": 1,
        "DOLocationID": 2,
    } | changes
    return tuple(base.get(name) for name in TRIPS_RAW.fieldNames())


def kept(make, **changes):
    return make([trip(**changes)], TRIPS_RAW).where(clean.is_clean()).count() == 1


@pytest.mark.parametrize(
    ("changes", "expected"),
    [
        ({"fare_amount": -0.01}, False),
        ({"fare_amount": 0.0}, True),
        ({"fare_amount": None}, False),
        ({"tpep_dropoff_datetime": datetime(2025, 3, 5, 11, 59, 59)}, False),
        ({"tpep_dropoff_datetime": NOON}, True),
        ({"tpep_dropoff_datetime": datetime(2025, 3, 5, 17, 0, 0)}, True),
        ({"tpep_dropoff_datetime": datetime(2025, 3, 5, 17, 0, 1)}, False),
        ({"passenger_count": 0}, False),
        ({"passenger_count": None}, False),
    ],
)
def test_clean_rules(make, changes, expected):
    assert kept(make, **changes) is expected


@pytest.mark.parametrize(
    ("pickup", "expected"),
    [
        (datetime(2024, 12, 31, 23, 59, 59), False),
        (datetime(2025, 1, 1), True),
        (datetime(2025, 12, 31, 23, 59, 59), True),
        (datetime(2026, 1, 1), False),
    ],
)
def test_year_is_half_open(make, pickup, expected):
    assert kept(make, tpep_pickup_datetime=pickup, tpep_dropoff_datetime=pickup) is expected


def test_cleaned_columns(make):
    cleaned = clean.clean_trips(make([trip(), trip(fare_amount=0.0, tip_amount=5.0)], TRIPS_RAW))
    assert len(cleaned.columns) == 25
    assert values(cleaned, "tip_percentage", "trip_duration_min", "dow_numeric", "pickup_latitude") == [
        (20.0, 10.0, 3, None),
        (0.0, 10.0, 3, None),
    ]
    kinds = dict(cleaned.dtypes)
    assert kinds["tip_percentage"] == kinds["fare_amount"] == kinds["trip_duration_min"] == "float"
    assert kinds["pickup_datetime"] == "timestamp_ntz"


def label_of(make, column, cases, kind):
    rows = make([(v,) for v in cases], f"v {kind}")
    return [x for (x,) in values(rows.select(column.alias("x")))]


def test_tip_percentage_of_missing_fare(make):
    rows = make([(2.0, None), (5.0, 0.0), (None, 4.0), (1.0, -3.0)], "tip double, fare double")
    share = labels.tip_percentage(F.col("tip"), F.col("fare"))
    assert [x for (x,) in values(rows.select(share.alias("x")))] == [0.0, 0.0, None, 0.0]


def test_weekends_differ(make):
    days = [date(2025, 1, 3), date(2025, 1, 4), date(2025, 1, 5)]  # Friday to Sunday
    assert label_of(make, calendar.is_late_week(F.col("v")), days, "date") == [True, True, False]
    assert label_of(make, calendar.is_calendar_weekend(F.col("v")), days, "date") == [False, True, True]
    assert label_of(make, calendar.day_name(F.col("v")), days, "date") == ["Friday", "Saturday", "Sunday"]


def test_peak_hours(make):
    hours = [6, 7, 9, 10, 16, 17, 19, 20]
    expected = [False, True, True, False, False, True, True, False]
    assert label_of(make, calendar.is_peak(F.col("v")), hours, "int") == expected


def test_seasons(make):
    got = label_of(make, calendar.season(F.col("v")), list(range(1, 13)), "int")
    expected = ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"]
    assert got == expected


def test_minutes_by_boundary(make):
    rows = make(
        [(datetime(2025, 1, 1, 10, 30, 50), datetime(2025, 1, 1, 10, 41, 10, 500000))],
        "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz",
    )
    assert values(clean.whole_minutes(rows), "trip_duration_min") == [(11,)]
    exact = calendar.elapsed_minutes(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    assert values(rows.select(exact))[0][0] == pytest.approx(10.341667)


def test_duration_label(make):
    got = label_of(make, labels.duration_label(F.col("v")), [0.99, 1.0, 4.99, 5.0, 15.0, 30.0, None], "float")
    assert got == ["Very short", "Short", "Short", "Medium", "Long", "Very long", "Very long"]


def test_tip_label(make):
    rows = make(
        [(0.0, 5.0), (1.0, None), (1.0, 0.0), (1.0, 9.9), (1.0, 10.0), (1.0, 20.0)],
        "fare float, pct float",
    )
    got = [x for (x,) in values(rows.select(labels.tip_label(F.col("fare"), F.col("pct"))))]
    assert got == ["No charge", "No tip", "No tip", "Low tip", "Standard tip", "High tip"]


def test_temperature_scales(make):
    first = [-0.1, 0.0, 15.0, 15.1, 25.0, 25.1, 35.0, 35.1, None]
    assert label_of(make, labels.feel_label(F.col("v")), first, "double") == [
        "Cold", "Cool", "Cool", "Mild", "Mild", "Warm", "Warm", "Hot", "Hot",
    ]
    second = [-0.1, 0.0, 10.0, 20.0, 30.0, None]
    assert label_of(make, labels.band_label(F.col("v")), second, "double") == [
        "Freezing", "Cold", "Cool", "Warm", "Hot", "Hot",
    ]


def test_weather_label(make):
    got = label_of(make, labels.weather_label(F.col("v")), [None, 45.0, 61.9, 0.0, 99.0], "double")
    assert got == ["Unknown", "Other", "Rain", "Clear", "Thunderstorm"]


def test_clip_keeps_null(make):
    clipped = labels.clip(F.col("v"), -40, 50)
    assert label_of(make, clipped, [-42.0, 52.0, 7.0, None], "double") == [-40.0, 50.0, 7.0, None]


def test_labels_of_flags(make):
    assert label_of(make, labels.peak_label(F.col("v")), [True, False, None], "boolean") == [
        "Peak Hour", "Non-Peak Hour", None,
    ]


def test_month_partitions_of_a_window(make):
    rows = make(
        [(datetime(2025, m, 1), 10.0, f"2025-{m:02}") for m in (1, 2, 3, 4)],
        "pickup_datetime timestamp_ntz, tip_percentage double, pickup_month string",
    )
    window = Window(date(2025, 2, 1), date(2025, 4, 1))
    assert filters.in_window(rows, window).count() == 2
    assert filters.outside_dates(rows, window, "pickup_datetime").count() == 2
