"""Compare a Spark result with a DuckDB result, whatever their row order."""

from __future__ import annotations

from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with every table of a folder as a view."""
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        path = f"{file}/*.parquet" if file.is_dir() else str(file)
        con.execute(f"create view {file.stem} as select * from read_parquet('{path}')")
    return con


def _kind(type_name: str) -> str:
    return {"string": "varchar", "int": "integer"}.get(type_name, type_name)


def differences(spark_rows, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between the two results, or None."""
    result = con.execute(sql)
    duck_types = {c[0]: str(c[1]).lower() for c in result.description}
    spark_types = {name: _kind(kind) for name, kind in spark_rows.dtypes}
    if spark_types != duck_types:
        return f"schema: {spark_types} / {duck_types}"
    columns = sorted(spark_types)
    order = [[c[0] for c in result.description].index(name) for name in columns]
    expected = sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=repr)
    actual = sorted((tuple(r) for r in spark_rows.select(*columns).collect()), key=repr)
    if len(actual) != len(expected):
        return f"rows: {len(actual)} / {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(wrong)} rows, first {wrong[0]}" if wrong else None
