"""Physical plans: what is pushed down, what is broadcast, what is shuffled."""

import io
from contextlib import redirect_stdout
from datetime import date

import pytest

from faregauge.operators import clean, fact, filters
from faregauge.plans import quality, reports
from faregauge.settings import Window
from faregauge.testbed.tables import RULES, WINDOW
from faregauge.testbed.workspace import Workspace

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def space(spark):
    return Workspace.open(spark, SF_DIR)


def plan(frame):
    text = io.StringIO()
    with redirect_stdout(text):
        frame.explain("formatted")
    return text.getvalue()


def test_month_partitions_are_pruned(space):
    text = plan(reports.a02_weather(space.star.fact_rows(), WINDOW))
    assert "pickup_month" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "1997-07" not in text.split("PartitionFilters: [")[1].split("]")[0]
    march = Window(date(1997, 3, 1), date(1997, 4, 1))
    assert filters.in_window(space.star.fact_rows(), march).rdd.getNumPartitions() <= 8


def test_report_reads_few_columns(space):
    text = plan(reports.a04_tip_hour_weather(space.star.fact_rows(), WINDOW))
    schema = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert sorted(c.split(":")[0] for c in schema.split(",")) == [
        "hour_of_day", "pickup_datetime", "tip_percentage", "weather_description",
    ]
    assert "GreaterThanOrEqual(tip_percentage" in text


def test_clean_is_one_stage_with_pushed_range(space):
    text = plan(clean.clean_trips(space.trips(), RULES))
    assert "Exchange" not in text and "Python" not in text
    for pushed in ("GreaterThanOrEqual(tpep_pickup_datetime", "LessThan(tpep_pickup_datetime", "GreaterThan(passenger_count"):
        assert pushed in text


def test_fact_is_not_shuffled(space):
    star = space.star
    rows = fact.build_fact(star.cleaned(), star.dim_time(), star.dim_location(), star.dim_weather())
    text = plan(rows)
    assert text.count("BroadcastHashJoin") >= 4
    assert "SortMergeJoin" not in text and "hashpartitioning" not in text


def test_large_dimension_is_not_broadcast(space):
    spark = space.spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        text = plan(reports.a13_borough(space.star.fact_rows(), space.star.dim_location(), WINDOW))
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_numbered_fact_needs_no_single_task(space):
    assert "SinglePartition" not in plan(space.star.fact())


def test_first_trips_prune_later_months(space):
    first = space.star.fact(first=10)
    text = plan(first)
    assert "dynamicpruning" in text
    assert "Sort" not in text
    assert sorted(row["trip_id"] for row in first.collect()) == list(range(1, 11))


def test_borough_filter_is_a_semi_join(space):
    text = plan(filters.pickup_in_boroughs(space.star.fact_rows(), space.star.dim_location(), ["ASIA"]))
    assert "LeftSemi" in text


@pytest.mark.parametrize("audit", [quality.dq_anomalies, quality.s_clean_report, quality.dq_money_summary])
def test_audits_scan_once(space, audit):
    text = plan(audit(space.trips()))
    assert text.count("Scan parquet") == 2  # once in the tree, once in the details


def test_top_k_is_not_a_full_sort(space):
    text = plan(reports.a12_top_zones(space.star.fact_rows(), space.star.dim_location(), WINDOW))
    assert "TakeOrderedAndProject" in text
