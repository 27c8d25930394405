"""Comparison of a Spark result with DuckDB SQL on the same tables."""

from __future__ import annotations

import re

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# Queries of this part of the library; the others are tested beside their operators.
OWN = [name for name in contract.queries() if not re.match(r"op\d+_|pipeline$", name)]

# Arrow types that count as the same on both sides.
SAME_TYPE = {
    "large_string": "string",
    "timestamp[us, tz=UTC]": "timestamp[us]",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def types(table: pa.Table) -> dict[str, str]:
    return {field.name: SAME_TYPE.get(str(field.type), str(field.type)) for field in table.schema}


def rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    return sorted(zip(*columns), key=lambda row: [(v is None, str(v)) for v in row])


def assert_same(spark_df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    got, want = spark_df.toArrow(), con.sql(sql).to_arrow_table()
    assert types(got) == types(want), (types(got), types(want))
    got_rows, want_rows = rows(got), rows(want)
    assert len(got_rows) == len(want_rows), (len(got_rows), len(want_rows))
    for g, w in zip(got_rows, want_rows):
        assert g == w, (g, w)
    return len(got_rows)
