"""Tables that change together: broken runs, late inputs, sources that fail."""

from datetime import date, datetime

import pytest
from conftest import values
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from test_clean_and_labels import trip

from faregauge.operators import keys
from faregauge.plans.job import FACT_OFFSETS, MonthlyJob
from faregauge.plans.star import StarSchema, TableStore
from faregauge.schemas import TRIPS_RAW, WEATHER_DAILY, ZONE_LOOKUP
from faregauge.sources import snapshots
from faregauge.sources.weather import scan_weather_daily
from faregauge.sources.zones import scan_zone_lookup

ZONES = [(1, "A", "a", "s", 40.5, -74.0), (9, "B", "b", "s", 40.6, -74.0)]


def at(month, day, hour=8, minute=0):
    return datetime(2025, month, day, hour, minute)


def land(make, folder, month, starts, **changes):
    rows = [trip(tpep_pickup_datetime=t, tpep_dropoff_datetime=t.replace(hour=t.hour + 1), **changes) for t in starts]
    make(rows, TRIPS_RAW).coalesce(1).write.mode("append").parquet(f"{folder}/yellow_tripdata_2025-{month:02}.parquet")


def observed(month, day, mean, label="Rain"):
    return (date(2025, month, day), mean, mean, mean, 1.0, 1.0, 1.0, 1.0, 1.0, label)


def job_of(spark, folder, weather, zones, last=3, out="out"):
    return MonthlyJob(
        spark, f"{folder}/{out}", lambda m: f"{folder}/yellow_tripdata_{m:%Y-%m}.parquet", weather, zones, last=date(2025, last, 1)
    )


def seen(fact):
    """What a reader of the marts sees: keys, times, zones as keys, weather."""
    return sorted(values(fact, "trip_id", "pickup_datetime", "pickup_location_key", "temperature_2m", "weather_description"))


def rebuilt(spark, folder, paths, weather, zones):
    """The same rows from scratch."""
    raw = lambda: spark.read.schema(TRIPS_RAW).parquet(*paths)
    star = StarSchema(TableStore(spark, str(folder)), raw, weather, zones)
    return star.fact(), star.dim_location()


@pytest.fixture
def two_months(spark, make, tmp_path):
    land(make, tmp_path, 1, [at(1, d, minute=m) for d in (3, 31) for m in range(3)])
    land(make, tmp_path, 2, [at(2, 5), at(2, 6)], PULocationID=9)
    land(make, tmp_path, 2, [at(1, 31, 7)])
    weather = make([observed(1, 31, 5.0)], WEATHER_DAILY)
    job = job_of(spark, tmp_path, lambda: weather, lambda: make(ZONES, ZONE_LOOKUP), last=2)
    job.run_next()
    return job


def test_a_run_that_breaks_at_any_write_shows_nothing(two_months, monkeypatch):
    """After the trips, the dimensions, the fact or its offsets are written: readers keep the
    old tables, and the next run is whole."""
    job = two_months
    before, number = seen(job.fact()), job.snapshot().number
    held = job.fact()
    plain, plain_parts, commit = snapshots.Change.write, snapshots.Change.write_parts, snapshots.Change.commit
    for broken in (4, 6, 7, 8):
        done = [0]

        def step(self, call, done=done, broken=broken):
            done[0] += 1
            result = call()
            if done[0] == broken:
                raise OSError(f"broke after write {broken}")
            return result

        monkeypatch.setattr(snapshots.Change, "write", lambda self, *a: step(self, lambda: plain(self, *a)))
        monkeypatch.setattr(snapshots.Change, "write_parts", lambda self, *a, **k: step(self, lambda: plain_parts(self, *a, **k)))
        monkeypatch.setattr(snapshots.Change, "commit", lambda self: commit(self) if done[0] < broken else pytest.fail("went on"))
        # What breaks inside a source is forgiven there and leaves the run whole, so those writes are left out.
        monkeypatch.setattr(MonthlyJob, "_source", lambda self, change, name, read: (read(), (name, "fresh", 0, None)))
        try:
            job.run_next()
        except OSError:
            assert job.snapshot().number == number and seen(job.fact()) == before
            continue
        break
    assert broken == 8  # cleaned, three dimensions, sources, fact, offsets: seven writes
    assert seen(held) == before
    after = seen(job.fact())
    assert [k for k, *_ in after] == list(range(1, 10)) and job.snapshot().number == number + 1
    assert [t.month for _, t, *_ in after] == [1] * 7 + [2] * 2


def test_a_commit_that_was_begun_is_not_read(two_months):
    job = two_months
    number = job.snapshot().number
    begun = job.spark.createDataFrame([("fact", None, None, "none")], snapshots.COMMIT)
    path = f"{job.path(snapshots.LOG)}/{number + 1:08}"
    begun.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    assert job.snapshot().number == number and len(seen(job.fact())) == 6
    job.run_next()
    assert job.snapshot().number == number + 1 and len(seen(job.fact())) == 9


def test_two_changes_from_one_commit(spark, make, tmp_path):
    first, second = (snapshots.begin(spark, str(tmp_path)) for _ in range(2))
    first.write("t", spark.range(3))
    second.write("t", spark.range(4))
    first.commit()
    with pytest.raises(RuntimeError, match="after this change began"):
        second.commit()
    assert snapshots.snapshot(spark, str(tmp_path)).read("t").count() == 3


def test_parts_and_vacuum(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame([("2025-01", 1), ("2025-02", 2), ("2025-03", 3)], "m string, v int")
    change = snapshots.begin(spark, root)
    assert change.write_parts("t", rows, "m") == ["2025-01", "2025-02", "2025-03"]
    first = change.commit()
    change = snapshots.begin(spark, root)
    change.write("lost", spark.range(1))
    change = snapshots.begin(spark, root)
    change.write_parts("t", rows.where("m = '2025-02'").withColumn("v", F.lit(9)), "m", replaces=["2025-02", "2025-03"])
    second = change.commit()
    assert sorted(values(first.read("t"), "m", "v")) == [("2025-01", 1), ("2025-02", 2), ("2025-03", 3)]
    assert sorted(values(second.read("t"), "m", "v")) == [("2025-01", 1), ("2025-02", 9)]
    assert snapshots.vacuum(spark, root, keep=2) and snapshots.vacuum(spark, root, keep=2) == []
    assert first.read("t").count() == 3
    assert len(snapshots.vacuum(spark, root, keep=1)) == 2
    assert sorted(values(snapshots.snapshot(spark, root).read("t"), "m", "v")) == [("2025-01", 1), ("2025-02", 9)]
    with pytest.raises(ValueError, match="no complete commit"):
        snapshots.snapshot(spark, root, first.number)
    with pytest.raises(ValueError, match="no table"):
        second.read("nothing")


def test_vacuum_keeps_what_readers_need(two_months):
    job = two_months
    job.run_next()
    before = seen(job.fact())
    assert snapshots.vacuum(job.spark, job.root, keep=1)
    assert seen(job.fact()) == before
    job.run_next()
    assert [r[1:3] for r in seen(job.fact())] == [r[1:3] for r in before]


def test_a_range_without_offset_is_an_error(two_months):
    job = two_months
    state = job.snapshot()
    short = state.read(FACT_OFFSETS).limit(1)
    with pytest.raises(PySparkException, match="no offset"):
        keys.numbered(state.read("fact"), short, StarSchema.FACT_RANGES, "trip_id").collect()


def test_late_weather_and_zones_equal_a_rebuild(spark, make, tmp_path):
    """Neither is there in the first month; both come later and change in between."""
    land(make, tmp_path, 1, [at(1, 3), at(1, 31)])
    land(make, tmp_path, 2, [at(2, 5)], PULocationID=9)
    land(make, tmp_path, 3, [at(3, 1)], DOLocationID=1)
    days, zones = [], []

    def weather():
        if not days:
            raise FileNotFoundError("no weather yet")
        return make(days, WEATHER_DAILY)

    def zone_table():
        return make(zones, ZONE_LOOKUP) if zones else scan_zone_lookup(spark, f"{tmp_path}/gone.csv")

    job = job_of(spark, tmp_path, weather, zone_table)
    with pytest.warns(UserWarning, match="no weather yet"):
        job.run_next()
    assert dict(values(job.read("sources"), "source_name", "state"))["weather"] == "empty"
    assert {w for *_, w in seen(job.fact())} == {"Unknown"}
    days += [observed(1, 3, 5.0)]
    zones += ZONES[:1]
    job.run_next()
    assert [w for *_, w in seen(job.fact())] == ["Rain", "Unknown", "Unknown"]
    days[:] = [observed(1, 3, 7.0, "Fog"), observed(2, 5, -1.0, "Snow")]
    zones[:] = [(1, "C", "moved", "s", 41.0, -75.0), ZONES[1]]
    job.run_next()
    assert dict(values(job.read("sources"), "source_name", "state")) == {"weather": "fresh", "zones": "fresh"}
    paths = [f"{tmp_path}/yellow_tripdata_2025-{m:02}.parquet" for m in (1, 2, 3)]
    fact, places = rebuilt(spark, tmp_path / "again", paths, weather, zone_table)
    look = ("trip_id", "pickup_datetime", "temperature_2m", "weather_description", "pickup_latitude", "pickup_longitude")
    assert sorted(map(str, values(job.fact(), *look))) == sorted(map(str, values(fact, *look)))
    known = ("location_id", "borough", "zone_name", "latitude")
    assert sorted(map(str, values(job.read("dim_location"), *known))) == sorted(map(str, values(places, *known)))


def test_a_source_that_breaks_while_it_is_read(spark, make, tmp_path):
    """The file can be named and listed, its rows can't be read: the run goes on."""
    for month in (1, 2):
        land(make, tmp_path, month, [at(month, 3)])
    broken = [True]

    def weather():
        days = make([observed(1, 3, 5.0), observed(2, 3, 6.0)], WEATHER_DAILY)
        stop = F.raise_error(F.lit("bad block")).cast("double")
        return days.withColumn("precipitation_sum", stop) if broken[0] else days

    job = job_of(spark, tmp_path, weather, lambda: make(ZONES, ZONE_LOOKUP))
    with pytest.warns(UserWarning, match="weather not refreshed"):
        job.run_next()
    rows = {r["source_name"]: r for r in job.read("sources").collect()}
    assert rows["weather"]["state"] == "empty" and "bad block" in rows["weather"]["detail"]
    assert rows["zones"]["state"] == "fresh" and rows["zones"]["row_count"] == 2
    broken[0] = False
    job.run_next()
    assert [w for *_, w in seen(job.fact())] == ["Rain", "Rain"]
    broken[0] = True
    with pytest.warns(UserWarning, match="bad block"):
        land(make, tmp_path, 3, [at(3, 3)])
        job.run_next()
    assert dict(values(job.read("sources"), "source_name", "state"))["weather"] == "stale"
    assert [w for *_, w in seen(job.fact())] == ["Rain", "Rain", "Unknown"]


@pytest.mark.parametrize("folder", ["plain", "a b+(c) é%20", "x=1"])
def test_overlapping_weather_files_in_odd_folders(spark, make, tmp_path, folder):
    """The first file wins a day, in the job and in a rebuild, wherever the files are."""
    home = tmp_path / folder
    land(make, home, 1, [at(1, 3), at(1, 4)])
    for name, days in (("a", [observed(1, 3, 1.0, "First")]), ("b", [observed(1, 3, 2.0, "Second"), observed(1, 4, 3.0, "Only")])):
        make(days, WEATHER_DAILY).coalesce(1).write.parquet(f"{home}/weather_daily_{name}.parquet")
    weather = lambda: scan_weather_daily(spark, [f"{home}/weather_daily_{n}.parquet" for n in "ba"])
    zones = lambda: make(ZONES, ZONE_LOOKUP)
    job = job_of(spark, home, weather, zones)
    job.run_next()
    assert [(t.day, w) for _, t, _, _, w in seen(job.fact())] == [(3, "First"), (4, "Only")]
    fact, _ = rebuilt(spark, home / "again", [f"{home}/yellow_tripdata_2025-01.parquet"], weather, zones)
    assert seen(fact) == seen(job.fact())


def test_a_dimension_that_starts_empty(spark, make, tmp_path):
    """No weather day in the first month, and keys from one in the second."""
    land(make, tmp_path, 1, [at(1, 3)])
    land(make, tmp_path, 2, [at(2, 3)])
    days = []
    job = job_of(spark, tmp_path, lambda: make(days, WEATHER_DAILY), lambda: make([], ZONE_LOOKUP))
    job.run_next()
    assert job.read("dim_weather").count() == 0 and seen(job.fact())[0][-1] == "Unknown"
    days.append(observed(2, 3, 4.0))
    job.run_next()
    assert values(job.read("dim_weather"), "weather_key", "date_key") == [(1, date(2025, 2, 3))]
    assert [w for *_, w in seen(job.fact())] == ["Unknown", "Rain"]


def test_a_month_without_valid_trips(spark, make, tmp_path):
    land(make, tmp_path, 1, [at(1, 3)])
    land(make, tmp_path, 2, [at(2, 3)], fare_amount=-1.0)
    job = job_of(spark, tmp_path, lambda: make([], WEATHER_DAILY), lambda: make(ZONES, ZONE_LOOKUP))
    job.run_next(), job.run_next()
    assert len(seen(job.fact())) == 1
