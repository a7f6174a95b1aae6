"""Stand-in importances where a feature or a target is the same in all rows."""

import math
from datetime import datetime, timedelta

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as checked
from faregauge.testbed.workspace import squared_correlation


def r2_of(frame):
    return frame.agg(squared_correlation(F.col("x"), F.col("y")).alias("r2")).first().r2


def plain(table):
    """Rows of named values that compare equal where neither is a number."""
    odd = lambda v: isinstance(v, float) and math.isnan(v)
    return [{k: "nan" if odd(v) else v for k, v in row.items()} for row in table.to_pylist()]


@pytest.fixture(scope="module")
def wet_tables(tmp_path_factory):
    """Orders of a month of 1997, each with so much rain that every day's sum is cut to the bound."""
    path = tmp_path_factory.mktemp("wet")
    n = 120
    orders = [13 * i + 12 for i in range(n)]
    days = [datetime(1997, 3, 1) + timedelta(days=i % 28) for i in range(n)]
    lines = range(4 * n)
    tables = {
        "region": {"r_regionkey": pa.array(range(5), pa.int32()), "r_name": [f"R{i}" for i in range(5)]},
        "nation": {
            "n_nationkey": pa.array(range(25), pa.int32()),
            "n_name": [f"N{i}" for i in range(25)],
            "n_regionkey": pa.array([i % 5 for i in range(25)], pa.int32()),
        },
        "customer": {
            "c_custkey": pa.array(range(1, 41), pa.int64()),
            "c_name": [f"C{i}" for i in range(40)],
            "c_nationkey": pa.array([i % 25 for i in range(40)], pa.int32()),
            "c_acctbal": [1.0] * 40,
            "c_mktsegment": ["M"] * 40,
        },
        "orders": {
            "o_orderkey": pa.array(orders, pa.int64()),
            "o_custkey": pa.array([i * 7 % 40 + 1 for i in range(n)], pa.int64()),
            "o_orderstatus": ["O"] * n,
            "o_totalprice": [1.0] * n,
            "o_orderdate": pa.array(days, pa.timestamp("us")),
            "o_orderpriority": ["1"] * n,
        },
        "lineitem": {
            "l_orderkey": pa.array([orders[i // 4] for i in lines], pa.int64()),
            "l_partkey": pa.array([i * 17 % 200 + 1 for i in lines], pa.int64()),
            "l_suppkey": pa.array([i * 5 % 30 + 1 for i in lines], pa.int64()),
            "l_linenumber": pa.array([i % 4 + 1 for i in lines], pa.int32()),
            "l_quantity": [float(i * 3 % 50 + 1) for i in lines],
            "l_extendedprice": [900.0 + i * 37 % 5000 for i in lines],
            "l_discount": [i % 11 / 100 for i in lines],
            "l_tax": [i % 9 / 100 for i in lines],
            "l_returnflag": ["N"] * len(lines),
            "l_linestatus": ["O"] * len(lines),
            "l_shipdate": pa.array([days[i // 4] for i in lines], pa.timestamp("us")),
        },
    }
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), path / f"{name}.parquet")
    return str(path)


def by_sql(name, sf_dir):
    connection = duckdb.connect()
    for table in ("region", "nation", "customer", "orders", "lineitem"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return plain(connection.sql(checked.oracle_sql()[name]).to_arrow_table())


@pytest.mark.parametrize("x, y", [("500.0D", "id % 7"), ("0.1D", "id % 7"), ("id % 7", "0.1D"), ("0.1D", "0.3D")])
def test_what_is_constant_has_no_correlation(spark, x, y):
    """However many parts, empty ones too, the rows are in."""
    rows = spark.range(0, 1000, 1, 7).where("id < 700").selectExpr(f"double({x}) x", f"double({y}) y")
    assert math.isnan(r2_of(rows))


def test_squared_correlation_of_pairs(make):
    def r2(*rows):
        return r2_of(make(rows, "x double, y double"))

    pairs = [(1.0, 2.0), (2.0, 1.0), (4.0, 7.0), (5.0, 3.0)]
    wanted = np.corrcoef(*zip(*pairs))[0, 1] ** 2
    assert r2(*pairs, (None, 9.0), (8.0, None)) == pytest.approx(wanted)
    assert r2((1.0, 2.0), (2.0, 4.0)) == pytest.approx(1.0)
    assert math.isnan(r2((1.0, 2.0), (1.0, 3.0), (9.0, None)))
    assert math.isnan(r2((1.0, 2.0), (3.0, 2.0), (None, 9.0)))
    assert r2((1.0, 2.0), (3.0, None)) is None
    assert r2((None, 2.0), (3.0, None)) is None


def test_importance_of_a_constant_feature(spark, wet_tables):
    got = plain(checked.queries()["feature_importance"](spark, wet_tables).toArrow())
    wanted = by_sql("feature_importance", wet_tables)
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert [r["feature_name"] for r in got if r["importance_avg"] == "nan"] == ["precipitation_mm"]


def test_largest_of_weather_with_a_constant_feature(spark, wet_tables):
    """What is not a number ranks first, in Spark and in SQL."""
    got = plain(checked.queries()["n_largest"](spark, wet_tables).toArrow())
    assert got == by_sql("n_largest", wet_tables)
    assert [(r["feature_name"], r["importance_avg"] == "nan") for r in got] == [("precipitation_mm", True), ("temperature_c", False)]
