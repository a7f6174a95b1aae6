"""Ranges counted beforehand: dense keys, even ranges, hot minutes, and the plans."""

import io
import random
import shutil
from contextlib import redirect_stdout
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from faregauge.operators import keys
from faregauge.operators.fact import ordered_fact
from faregauge.operators.ranges import counted_ranges
from faregauge.sources import files, sinks
from faregauge.streaming import loading
from faregauge.testbed.workspace import Workspace

SCHEMA = "t timestamp_ntz, a int, b double"
START = datetime(2024, 12, 30, 23, 50)


def numbered(spark, rows, path, ranges, range_rows=10**6):
    stored = spark.createDataFrame(rows, SCHEMA).repartition(6)
    stored.write.parquet(f"{path}/rows")
    stored = spark.read.parquet(f"{path}/rows")
    plan = counted_ranges(stored, ["t", "a", "b"], "m", f"{path}/ranges", ranges, range_rows)
    plan.placed(stored).write.partitionBy("m").parquet(f"{path}/out")
    out = spark.read.parquet(f"{path}/out")
    offsets = plan.offsets if plan.offsets is not None else keys.key_offsets(out, ["m", "part_no"])
    found = keys.numbered(out, offsets, ["m", "part_no"], "k").orderBy("k").select("k", "t", "a", "b").collect()
    return plan, out, [tuple(r) for r in found]


def in_order(rows):
    last = lambda v: (v is None, v if v is not None else 0)
    return [(i, *r) for i, r in enumerate(sorted(rows, key=lambda r: (r[0], last(r[1]), last(r[2]))), 1)]


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_dense_keys_over_months(spark, tmp_path, ranges):
    draw = random.Random(ranges)
    rows = [(START + timedelta(seconds=draw.randrange(90 * 86400)), draw.choice([None, 1, 2]), draw.choice([None, 0.5])) for _ in range(3000)]
    plan, out, found = numbered(spark, rows, tmp_path, ranges)
    assert [r[:3] for r in found] == [r[:3] for r in in_order(rows)] and found == in_order(rows)
    assert plan.offsets is not None and plan.count >= ranges
    sizes = [r["n"] for r in out.groupBy("part_no").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 2 * -(-3000 // ranges) + 5
    assert out.groupBy("part_no").agg(F.countDistinct("m").alias("n")).where("n > 1").isEmpty()


def test_a_minute_with_most_rows_is_cut(spark, tmp_path):
    """Two of three rows in one minute, half of them equal in every column."""
    draw = random.Random(5)
    hot = datetime(2025, 1, 7, 8, 30)
    rows = [(hot + timedelta(seconds=draw.randrange(60)), draw.choice([None, 1, 2, 3]), draw.random()) for _ in range(2000)]
    rows += [(hot + timedelta(seconds=30), 2, 0.5)] * 2000
    rows += [(START + timedelta(minutes=draw.randrange(60 * 24 * 20)), 1, None) for _ in range(2000)]
    plan, out, found = numbered(spark, rows, tmp_path, 12)
    assert plan.offsets is None and found == in_order(rows)
    sizes = [r["n"] for r in out.groupBy("part_no").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 1500


def test_no_rows(spark, tmp_path):
    _, _, found = numbered(spark, [(START, 1, 1.0)], tmp_path, 4)
    assert found == [(1, START, 1, 1.0)]
    empty = spark.createDataFrame([], SCHEMA)
    plan = counted_ranges(empty, ["t", "a"], "m", f"{tmp_path}/none", 4)
    assert plan.placed(empty).collect() == [] and plan.count == 0


def text_of(frame):
    text = io.StringIO()
    with redirect_stdout(text):
        frame.explain("simple")
    return text.getvalue()


@pytest.fixture(scope="module")
def space(spark):
    return Workspace.open(spark, "/root/testdata/sf0.001")


def test_fact_is_moved_once_and_sorted_once(space, tmp_path):
    star = space.star
    rows, offsets = ordered_fact(star.cleaned(), star.dim_time(), star.dim_location(), star.dim_weather(), str(tmp_path / "r"))
    text = text_of(rows)
    assert text.count(" Exchange ") == 1 and text.count(" Sort ") == 1 and "rangepartitioning" not in text
    assert offsets is not None and "SinglePartition" not in text


def test_mart_by_month_is_written_without_a_shuffle(space, tmp_path):
    """Input that is laid out by month goes straight to its months; other input is gathered."""
    fact = space.star.fact()
    assert " Exchange " not in text_of(fact)
    sinks.write_mart(fact, str(tmp_path / "mart"), "pickup_month", laid_out=True)
    again = space.spark.read.parquet(str(tmp_path / "mart"))
    assert again.count() == fact.count() and again.select("trip_id").distinct().count() == fact.count()


def copies(folder, count):
    """Files of one row each."""
    folder.mkdir()
    pq.write_table(pa.table({"id": [1]}), folder / "0.parquet")
    for i in range(1, count):
        shutil.copy(folder / "0.parquet", folder / f"{i}.parquet")
    return [f"{folder}/{i}.parquet" for i in range(count)]


def test_plan_does_not_grow_with_the_files(spark, tmp_path):
    names = copies(tmp_path / "many", 2000)
    small = loading.with_source(spark.read.parquet(*names[:2]), names[:2])
    large = loading.with_source(spark.read.parquet(*names), names)
    assert large.select(loading.SOURCE).distinct().count() == len(names)
    steps = [[line.strip(" :+-").split(" ")[0] for line in text_of(frame).splitlines()] for frame in (small, large)]
    assert steps[0] == steps[1] and "CASE" not in text_of(large)
    whole = loading.with_source(spark.read.parquet(f"{tmp_path}/many"), [f"{tmp_path}/many"])
    assert {r[0] for r in whole.select(loading.SOURCE).distinct().collect()} == {loading.source_id(spark, f"{tmp_path}/many")}


def test_nearest_listed_folder_wins(spark, make, tmp_path):
    for name in ("x", "x/y", "xy"):
        spark.range(2).write.mode("append").parquet(f"{tmp_path}/{name}")
    paths = [f"{tmp_path}/{name}" for name in ("x", "x/y", "xy")]
    found = loading.listed_files(spark, spark.read.option("recursiveFileLookup", "true").parquet(*paths).inputFiles(), paths)
    assert {source for _, source in found} == {loading.source_id(spark, p) for p in paths}
    other = spark.read.parquet(paths[0])
    with pytest.raises(Exception, match="not listed"):
        loading.with_source(other, paths[2:]).collect()


def test_footers_of_many_files_take_one_job(spark, tmp_path, monkeypatch):
    names = copies(tmp_path / "many", 1000)
    calls = []
    plain = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *paths, **k: calls.append(len(paths)) or plain(self, *paths, **k))
    assert files.same_schema(spark, names) == [names] and len(calls) == 1
    spark.range(3).selectExpr("cast(id as double) AS id").coalesce(1).write.parquet(f"{tmp_path}/other")
    calls.clear()
    groups = files.same_schema(spark, [*names, f"{tmp_path}/other"])
    assert sorted(map(len, groups)) == [1, len(names)] and len(calls) == 1
