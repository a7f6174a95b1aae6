"""Incremental loading, month cursor and the monthly job."""

from datetime import date, datetime

import pytest
from conftest import values
from pyspark.sql import functions as F

from faregauge.plans.job import MonthlyJob
from faregauge.schemas import BATCH_LEDGER, TRIPS_RAW, WEATHER_DAILY, ZONE_LOOKUP
from faregauge.sources import files, sinks
from faregauge.streaming import loading, months
from test_clean_and_labels import trip


def land(make, folder, month, count=3, day=10, **changes):
    """One monthly file; returns its path."""
    path = f"{folder}/yellow_tripdata_2025-{month:02}.parquet"
    rows = [
        trip(
            tpep_pickup_datetime=datetime(2025, month, day, 8, i),
            tpep_dropoff_datetime=datetime(2025, month, day, 9, i),
            **changes,
        )
        for i in range(count)
    ]
    make(rows, TRIPS_RAW).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def test_load_twice_is_once(spark, make, tmp_path):
    staging, ledger = str(tmp_path / "staging"), str(tmp_path / "ledger")
    first, second = land(make, tmp_path, 1), land(make, tmp_path, 2)
    assert values(loading.load_new_files(spark, [first], staging, ledger)) == [(first,)]
    assert values(loading.load_new_files(spark, [first, second], staging, ledger)) == [(second,)]
    assert loading.load_new_files(spark, [first, second], staging, ledger).isEmpty()
    assert loading.read_staging(spark, staging).count() == 6
    assert loading.read_staging(spark, staging, second).count() == 3


@pytest.mark.parametrize("folders", [("2024", "2025"), ("landing/x/landing", "landing"), ("a b+(c)", "a%20b")])
def test_equal_names_in_two_folders(spark, make, tmp_path, folders):
    staging, ledger = str(tmp_path / "staging"), str(tmp_path / "ledger")
    paths = [land(make, tmp_path / folder, 1, count=n) for folder, n in zip(folders, (5, 3))]
    loading.load_new_files(spark, paths[:1], staging, ledger)
    loading.load_new_files(spark, paths, staging, ledger)
    assert loading.read_staging(spark, staging).count() == 8
    assert [loading.read_staging(spark, staging, p).count() for p in paths] == [5, 3]


def test_a_load_that_died_before_its_ledger_entry(spark, make, tmp_path):
    staging, ledger = str(tmp_path / "staging"), str(tmp_path / "ledger")
    first, second = land(make, tmp_path, 1), land(make, tmp_path, 2)
    loading.load_new_files(spark, [first], staging, ledger)
    other = str(tmp_path / "other")
    loading.load_new_files(spark, [first, second], staging + "2", other)
    # The rows of the second file arrive, but no ledger entry is written.
    rows = loading.scan_trips(spark, [second]).withColumn(loading.SOURCE, F.lit(loading.source_id(spark, second)))
    rows.write.mode("append").partitionBy(loading.SOURCE).parquet(staging)
    loading.load_new_files(spark, [first, second], staging, ledger)
    assert loading.read_staging(spark, staging).count() == 6


def test_missing_files(spark, make, tmp_path):
    staging, ledger = str(tmp_path / "staging"), str(tmp_path / "ledger")
    gone = str(tmp_path / "gone.parquet")
    with pytest.raises(ValueError, match="no trip file"), pytest.warns(UserWarning, match="gone"):
        loading.load_new_files(spark, [gone], staging, ledger)
    loading.load_new_files(spark, [land(make, tmp_path, 1)], staging, ledger)
    with pytest.warns(UserWarning, match="gone"):
        assert loading.load_new_files(spark, [gone], staging, ledger).isEmpty()


def test_guard(spark, make, tmp_path):
    staging = land(make, tmp_path, 1)
    with pytest.raises(RuntimeError, match="which files"):
        loading.load_new_files(spark, [staging], staging, str(tmp_path / "ledger"))


def test_stream_twice_is_once(spark, make, tmp_path):
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    pattern = f"{tmp_path}/yellow_tripdata_*.parquet"
    land(make, tmp_path, 1)
    for expected in (3, 3):
        assert loading.stream_new_files(spark, pattern, target, checkpoint).count() == expected
    land(make, tmp_path, 2)
    assert loading.stream_new_files(spark, pattern, target, checkpoint, max_files=1).count() == 6


def test_discover_with_subfolder(spark, make, tmp_path):
    land(make, tmp_path / "tlc", 1)
    assert files.discover_files(spark, str(tmp_path)).isEmpty()
    found = files.discover_files(spark, str(tmp_path), subfolder="tlc")
    assert values(found, "file_name") == [("yellow_tripdata_2025-01.parquet",)]
    land(make, tmp_path, 2)
    found = files.discover_files(spark, str(tmp_path), subfolder="tlc")
    assert values(found, "file_name") == [("yellow_tripdata_2025-02.parquet",)]


def test_audit_reports_broken_files(spark, make, tmp_path):
    land(make, tmp_path, 1)
    (tmp_path / "yellow_tripdata_2025-02.parquet").write_text("not a table")
    audit = files.audit_files(spark, f"{tmp_path}/yellow_tripdata_*.parquet")
    got = sorted(values(audit.where(~F.col("path").contains("crc")), "row_count", "is_readable"))
    assert (0, False) in got and (3, True) in got


def test_scan_by_name(spark, make, tmp_path):
    """Columns in another order, one missing and one new."""
    rows = make([trip()], TRIPS_RAW)
    odd = rows.select(*reversed(rows.columns)).drop("Airport_fee").withColumn("new", F.lit(1))
    odd.write.parquet(str(tmp_path / "a"))
    rows.write.parquet(str(tmp_path / "b"))
    scanned = files.scan_trips(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert scanned.columns == TRIPS_RAW.fieldNames()
    assert values(scanned, "fare_amount", "PULocationID") == [(10.0, 1), (10.0, 1)]


def test_scan_of_mixed_types(spark, make, tmp_path):
    rows = make([trip()], TRIPS_RAW)
    paths = [str(tmp_path / name) for name in "abc"]
    rows.write.parquet(paths[0])
    rows.withColumn("passenger_count", F.col("passenger_count").cast("double")).write.parquet(paths[1])
    rows.drop("extra").write.parquet(paths[2])
    scanned = files.scan_mixed(spark, paths)
    assert scanned.schema.simpleString() == TRIPS_RAW.simpleString()
    assert values(scanned, "passenger_count") == [(1,)] * 3


@pytest.mark.parametrize(
    ("done", "last", "expected"),
    [
        ([], date(2025, 6, 1), (1, 2025, True, 0)),
        ([1, 2], date(2025, 6, 1), (3, 2025, True, 2)),
        ([6], date(2025, 6, 1), (None, None, False, 1)),
        ([12], date(2026, 6, 1), (1, 2026, True, 1)),
    ],
)
def test_next_month(make, done, last, expected):
    ledger = make([(date(2025, m, 1), None) for m in done], BATCH_LEDGER)
    row = months.next_batch_month(ledger, last=last)
    assert values(row, "month", "year", "is_valid", "total_processed") == [expected]


def test_cursor_runs_six_months_then_stops(spark, tmp_path):
    ledger = str(tmp_path / "months")
    seen = []
    for _ in range(8):
        step = months.next_batch_month(months.read_months(spark, ledger)).first()
        seen.append(step["month"])
        if step["is_valid"]:
            months.mark_batch_complete(spark, ledger, date(step["year"], step["month"], 1))
    assert seen == [1, 2, 3, 4, 5, 6, None, None]
    months.reset_batches(spark, ledger)
    assert months.next_batch_month(months.read_months(spark, ledger)).first()["month"] == 1


def test_date_range(make):
    rows = months.batch_date_range(make([(2024, 2)], "year int, month int"))
    assert values(rows) == [(2024, 2, date(2024, 2, 1), date(2024, 2, 29))]


def test_monthly_job(spark, make, tmp_path):
    """Three months with a new zone in the second and a trip that belongs to the first."""
    land(make, tmp_path, 1, day=31)
    land(make, tmp_path, 2, PULocationID=9)
    late = make([trip(tpep_pickup_datetime=datetime(2025, 1, 31, 7), tpep_dropoff_datetime=datetime(2025, 1, 31, 8))], TRIPS_RAW)
    late.coalesce(1).write.mode("append").parquet(f"{tmp_path}/yellow_tripdata_2025-02.parquet")
    weather = make([(date(2025, 1, 31), 5.0, 5.0, 5.0, 1.0, 1.0, 1.0, 1.0, 1.0, "Rain")], WEATHER_DAILY)
    zones = make([(1, "A", "a", "s", 40.5, -74.0), (9, "B", "b", "s", 40.6, -74.0)], ZONE_LOOKUP)
    job = MonthlyJob(
        spark,
        str(tmp_path / "out"),
        lambda m: f"{tmp_path}/yellow_tripdata_{m:%Y-%m}.parquet",
        lambda: weather,
        lambda: zones,
        last=date(2025, 2, 1),
    )
    assert job.run_next().first()["month"] == 1
    before = dict(values(job.read("dim_location"), "location_id", "location_key"))
    assert job.fact().count() == 3
    assert job.run_next().first()["month"] == 2
    after = dict(values(job.read("dim_location"), "location_id", "location_key"))
    assert before.items() <= after.items() and set(after) == {1, 2, 9}
    fact = job.fact().orderBy("trip_id")
    got = values(fact, "trip_id", "pickup_datetime", "weather_description")
    assert [(k, t.month, w) for k, t, w in got] == [
        (i, 1, "Rain") for i in range(1, 5)
    ] + [(i, 2, "Unknown") for i in range(5, 8)]
    assert got[0][1] == datetime(2025, 1, 31, 7)
    assert job.run_next().first()["is_valid"] is False
    assert sorted(values(job.fact(), "trip_id")) == [(i,) for i in range(1, 8)]


def test_sinks_replace(spark, make, tmp_path):
    path = str(tmp_path / "mart")
    for n in (5, 2):
        sinks.write_mart(spark.range(n).withColumn("m", F.lit("x")), path, "m")
    assert spark.read.parquet(path).count() == 2
