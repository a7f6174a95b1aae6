"""The same SQL twins on tables where single values hold a third of all rows."""

import shutil
from pathlib import Path

import duckdb
import pytest
from compare import TABLES, differences, oracle_connection

import __spark_entry__ as checked

SOURCE = "/root/testdata/sf0.001"
ORACLE = checked.oracle_sql()
NAMES = (
    "scan_trips clean_trips build_fact surrogate_key_fact mart_sort sink_fact_export_csv limit_preview"
    " load_new_files process_one_batch upsert_weather_days daily_weather forward_fill dim_weather"
    " union_locations fk_integrity zone_centroid mean_vertices impute_median encode_borough scan_features"
    " split_train_test sample_cap evaluate a01_overview a11_borough_weather a12_top_zones a13_borough"
    " q_daily_stats d_map_kpis dq_anomalies dq_temporal_rows dq_logic_evidence s_clean_report"
).split()


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """Copies of one line item, one crowded order date and one crowded nation."""
    folder = tmp_path_factory.mktemp("skewed")
    for name in TABLES:
        shutil.copyfile(f"{SOURCE}/{name}.parquet", folder / f"{name}.parquet")
    line = f"SELECT * FROM '{SOURCE}/lineitem.parquet'"
    orders = f"SELECT * FROM '{SOURCE}/orders.parquet'"
    customers = f"SELECT * FROM '{SOURCE}/customer.parquet'"
    changed = {
        "lineitem": f"""
            WITH hot AS ({line} JOIN '{SOURCE}/orders.parquet' ON o_orderkey = l_orderkey
              WHERE year(o_orderdate) = 1997 AND l_orderkey % 50 <> 0 AND l_orderkey % 97 <> 0
                AND l_linenumber % 7 > 0 AND l_partkey % 29 <> 0
                AND (l_partkey * 13 + l_linenumber * 7 + l_suppkey) % 360 BETWEEN 20 AND 320
              ORDER BY l_orderkey, l_partkey LIMIT 1)
            {line} UNION ALL SELECT hot.* EXCLUDE (o_orderkey, o_custkey, o_orderstatus, o_totalprice,
              o_orderdate, o_orderpriority) FROM hot, range(3000)""",
        "orders": f"""
            SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '1997-03-05' ELSE o_orderdate END
              AS o_orderdate) FROM ({orders})""",
        "customer": f"""
            SELECT * REPLACE (CASE WHEN c_custkey % 3 = 0 THEN 7 ELSE c_nationkey END AS c_nationkey)
            FROM ({customers})""",
    }
    for name, query in changed.items():
        Path(folder / f"{name}.parquet").unlink()
        duckdb.sql(query).write_parquet(str(folder / f"{name}.parquet"))
    return str(folder)


@pytest.fixture(scope="module")
def database(skewed):
    return oracle_connection(skewed)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, skewed, database, name):
    result = checked.queries()[name](spark, skewed).toArrow()
    assert differences(result, database.sql(ORACLE[name]).to_arrow_table()) is None
