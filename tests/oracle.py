"""Compare registered queries with their SQL on DuckDB, as multisets of rows with equal types."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb
import pyarrow as pa

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
          " labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _kind(t: pa.DataType) -> str:
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp"
    return str(t)


def _rows(table: pa.Table) -> list[str]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(repr(tuple(_value(v) for v in row)) for row in zip(*columns))


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs."""
    got, want = df.toArrow(), con.sql(sql).to_arrow_table()
    got_types = {f.name: _kind(f.type) for f in got.schema}
    want_types = {f.name: _kind(f.type) for f in want.schema}
    if got_types != want_types:
        diff = {k: (got_types.get(k), want_types.get(k)) for k in got_types.keys() | want_types.keys()
                if got_types.get(k) != want_types.get(k)}
        return f"types differ (got, want): {diff}"
    a, b = _rows(got), _rows(want)
    if a != b:
        extra, lacking = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        return f"{len(a)} rows, want {len(b)}; extra {extra}; lacking {lacking}"
    return None
