"""Runs queries against their SQL twins the way the check does: schema and value multiset."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _kind(kind: pa.DataType) -> str:
    name = str(kind)
    return {"large_string": "string", "string_view": "string"}.get(name, name)


def _rows(table: pa.Table) -> tuple[list[tuple[str, str]], Counter]:
    table = table.select(sorted(table.column_names))
    schema = [(field.name, _kind(field.type)) for field in table.schema]
    columns = [column.to_pylist() for column in table.columns]
    return schema, Counter(zip(*columns, strict=True)) if columns else Counter()


def differences(result: pa.Table, expected: pa.Table) -> str | None:
    """None when equal, else what differs."""
    schema, rows = _rows(result)
    wanted_schema, wanted = _rows(expected)
    if schema != wanted_schema:
        return f"schema {sorted(set(schema) ^ set(wanted_schema))}"
    if rows != wanted:
        return (
            f"{result.num_rows} rows, {expected.num_rows} expected;"
            f" extra {list((rows - wanted).items())[:2]}; missing {list((wanted - rows).items())[:2]}"
        )
    return None


def main(sf_dir: str, names: list[str]) -> None:
    import __spark_entry__ as checked
    from faregauge.session import local_session

    spark = local_session()
    connection = oracle_connection(sf_dir)
    queries, oracle = checked.queries(), checked.oracle_sql()
    assert not set(oracle) - set(queries), set(oracle) - set(queries)
    failed = 0
    for name in names or list(queries):
        start = time.time()
        try:
            result = queries[name](spark, sf_dir).toArrow()
            took = time.time() - start
            if name not in oracle:
                verdict = "rows only"
            else:
                expected = connection.sql(oracle[name]).to_arrow_table()
                verdict = differences(result, expected) or "equal"
            if result.num_rows == 0:
                verdict += " EMPTY"
        except Exception as error:
            verdict, took, result = f"ERROR {str(error)[:600]}", time.time() - start, None
        failed += verdict not in ("equal", "rows only")
        print(f"{name:28s} {took:6.2f}s {result.num_rows if result else 0:7d} {verdict}", flush=True)
    print(f"{failed} failed; without SQL: {sorted(set(queries) - set(oracle))}")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
