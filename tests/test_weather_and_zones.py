"""Weather chain, zone readers and zone centres."""

import json
from datetime import date, datetime

import pytest
from conftest import values
from pyspark.sql import functions as F

from faregauge.operators import dimensions, weather, zones
from faregauge.schemas import WEATHER_DAILY, WEATHER_HOURLY, WEATHER_TRANSFORMED, ZONE_VERTICES
from faregauge.sources import weather as source
from faregauge.sources import zones as zone_source


def day(d, mean=None, rain=None, category=None):
    return (date(2025, 1, d) if d else None, mean, mean, mean, None, rain, None, None, None, category)


def test_daily_weather(make):
    hour = lambda h, t, rain, cat: (datetime(2025, 1, 1, h), t, 50.0, rain, 1.0, 2.0, 3.0, cat)
    rows = make([hour(0, 1.0, None, "Rain"), hour(1, None, None, "Clear"), hour(2, 4.0, None, None)], WEATHER_HOURLY)
    result = weather.daily_weather(rows)
    assert result.columns == WEATHER_DAILY.fieldNames()
    assert values(result, "temperature_2m_mean", "precipitation_sum", "weather_category") == [
        (2.5, 0.0, "Clear")
    ]


def test_forward_fill(make):
    rows = make(
        [day(1), day(2, 5.0, category="Rain"), day(3), day(4, 7.0), day(4), day(5), day(None, 99.0)],
        WEATHER_DAILY,
    )
    filled = weather.forward_fill(rows).orderBy("date")
    got = values(filled, "date", "temperature_2m_mean", "weather_category")
    assert [(d.day, t, c) for d, t, c in got] == [
        (1, None, None), (2, 5.0, "Rain"), (3, 5.0, None), (4, 7.0, None), (4, 7.0, None), (5, 7.0, None),
    ]


def test_transform_clips_but_labels_before(make):
    rows = make([day(1, -42.0, -10.0), day(2, 52.0, 590.0), day(3), day(None, 1.0)], WEATHER_DAILY)
    result = weather.transform_weather(rows).orderBy("date_actual")
    assert values(result, "avg_temperature", "total_precipitation", "temperature_category") == [
        (-40.0, 0.0, "Cold"), (50.0, 500.0, "Hot"), (None, None, "Hot"),
    ]
    assert result.schema == WEATHER_TRANSFORMED or result.columns == WEATHER_TRANSFORMED.fieldNames()


def test_first_file_per_day(make):
    rows = make(
        [(date(2025, 1, 1), 1, "a"), (date(2025, 1, 1), 1, "b"), (date(2025, 1, 1), 2, "c"),
         (date(2025, 1, 2), 2, "d"), (None, 1, "e")],
        "date date, file_rank int, x string",
    )
    assert sorted(values(weather.first_file_per_day(rows), "x")) == [("a",), ("b",), ("d",)]


def test_weather_code_rounds_half_to_even(make):
    rows = make([(date(2025, 1, i + 1), c) for i, c in enumerate((2.5, 2.7, 3.5))], "date_actual date, weather_code double")
    for name in set(WEATHER_TRANSFORMED.fieldNames()) - {"date_actual", "weather_code"}:
        rows = rows.withColumn(name, F.lit(None).cast(WEATHER_TRANSFORMED[name].dataType))
    result = dimensions.weather_attributes(rows).orderBy("date_key")
    assert values(result, "weather_code", "weather_description", "temperature_category") == [
        (2, "Unknown", "Hot"), (3, "Unknown", "Hot"), (4, "Unknown", "Hot"),
    ]


def test_iso_week(make):
    rows = dimensions.calendar_columns(make([(date(2024, 12, 30),)], "date_key date"))
    assert values(rows, "week_of_year", "quarter", "season", "is_weekend") == [(1, 4, "Winter", False)]


def test_payload(spark, tmp_path):
    document = {"hourly": {"time": ["2025-01-01T00:00", "2025-01-01T01:00"], "temperature_2m": [1.5, None], "weather_code": [0, 61]}}
    (tmp_path / "a.json").write_text(json.dumps(document, indent=1))
    rows = source.flatten_payload(source.scan_payloads(spark, str(tmp_path), multi_line=True))
    assert values(rows, "datetime", "temperature_2m", "weathercode", "weather_category", "precipitation") == [
        (datetime(2025, 1, 1, 0), 1.5, 0.0, "Clear", None),
        (datetime(2025, 1, 1, 1), None, 61.0, "Rain", None),
    ]
    assert rows.columns == WEATHER_HOURLY.fieldNames()


def test_payload_without_times(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"hourly": {"time": []}}')
    with pytest.raises(Exception, match="without hourly times"):
        source.flatten_payload(source.scan_payloads(spark, str(tmp_path))).collect()


def test_no_daily_file(spark):
    with pytest.raises(ValueError, match="no daily"):
        source.scan_weather_daily(spark, [])


def test_raw_zone_csv(spark, tmp_path):
    (tmp_path / "z.csv").write_text(
        'LocationID,Borough,Zone,service_zone\n" 7 ",Queens , Astoria,Boro\nx,a,b,c\n"",a,b,c\n'
    )
    assert values(zone_source.scan_zone_lookup_raw(spark, str(tmp_path / "z.csv"))) == [
        (7, "Queens", "Astoria", "Boro")
    ]


def test_geojson(spark, tmp_path):
    ring = [[0.0, 1.0], [2.0, 3.0]]
    features = [
        {"properties": {name: str(i)}, "geometry": {"type": "Polygon", "coordinates": [ring]}}
        for i, name in enumerate(zone_source.ID_SPELLINGS, 1)
    ]
    (tmp_path / "z.json").write_text(json.dumps({"features": features}))
    got = values(zone_source.scan_zone_geojson(spark, str(tmp_path / "z.json")))
    assert got == [(i, i - 1, v, *ring[v]) for i in (1, 2, 3) for v in (0, 1)]


def test_later_shape_wins(make):
    rows = make([(1, 0, 0, 0.0, 0.0), (1, 1, 0, 10.0, 20.0), (1, 1, 1, 30.0, 40.0)], ZONE_VERTICES)
    assert values(zones.mean_vertices(rows)) == [(1, 20.0, 30.0)]


@pytest.mark.parametrize(
    ("x", "y", "latitude", "longitude"),
    [
        # The projection's own origin: false easting 984,250 ft at 40° 10' N, 74° W.
        (984250.0, 0.0, 40 + 10 / 60, -74.0),
        # City Hall Park, Manhattan, about 982,000 ft E and 198,500 ft N in the state grid.
        (982000.0, 198500.0, 40.7115, -74.0081),
    ],
)
def test_projection_control_points(make, x, y, latitude, longitude):
    rows = make([(1, 0, 0, x, y)], ZONE_VERTICES)
    ((_, lat, lon),) = values(zones.zone_centroid(rows))
    assert lat == pytest.approx(latitude, abs=1e-3)
    assert lon == pytest.approx(longitude, abs=1e-3)


def test_projection_inverts_the_forward_formula(make):
    """Forward equations 15-1 to 15-4 and 15-7 to 15-10 as a brute-force check."""
    import math

    from faregauge.functions.geo import Conic

    conic = Conic()
    n, factor, origin = conic.parameters()
    e = conic.eccentricity
    cases = {}
    for i, (lat, lon) in enumerate([(40.5, -74.2), (40.7, -73.9), (40.91, -73.71), (41.2, -72.1)]):
        phi = math.radians(lat)
        t = math.tan(math.pi / 4 - phi / 2) / ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)
        rho, theta = factor * t**n, n * math.radians(lon + 74)
        x = (rho * math.sin(theta) + conic.false_easting_m) / conic.unit_m
        y = (origin - rho * math.cos(theta)) / conic.unit_m
        cases[i] = (x, y, lat, lon)
    rows = make([(i, 0, 0, x, y) for i, (x, y, _, _) in cases.items()], ZONE_VERTICES)
    for i, lat, lon in values(zones.zone_centroid(rows)):
        assert (lat, lon) == (pytest.approx(cases[i][2], abs=1e-6), pytest.approx(cases[i][3], abs=1e-6))
