"""Inline rows, one-row relations, logs, JSON documents and catalogue relations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import ntz
from tidemark.operators.ordered import cap as newest


def full_scan(spark: SparkSession, name: str) -> DataFrame:
    """Every row of a catalogue table or view."""
    return spark.table(name)


def inline_rows(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def lit_row(spark: SparkSession, cols: Mapping[str, Column], pred: Column | None = None) -> DataFrame:
    """One row of constants, or none when the predicate is not true."""
    row = spark.range(1).select([c.alias(n) for n, c in cols.items()])
    return row if pred is None else row.filter(pred)


def active_only(df: DataFrame, col: str = "deleted") -> DataFrame:
    """Rows not soft-deleted."""
    return df.filter(F.col(col).isNull())


def log_range(df: DataFrame, ts: str, start: datetime | str, end: datetime | str, cap: int | None = None,
              ties: Sequence[str] = ()) -> DataFrame:
    """Log rows with start <= ts <= end; `cap` keeps the newest rows."""
    ranged = df.filter((F.col(ts) >= ntz(start)) & (F.col(ts) <= ntz(end)))
    return ranged if cap is None else newest(ranged, ts, cap, ties)


def read_json_variant(spark: SparkSession, path: str | Sequence[str], column: str = "doc", lines: bool = False) -> DataFrame:
    """One VARIANT per file, or per line with `lines`; a text that is no JSON raises."""
    text = spark.read.text(path, wholetext=not lines)
    return text.select(F.parse_json("value").alias(column))


def catalog_columns(spark: SparkSession, table: str, exclude: Sequence[str] = ()) -> DataFrame:
    """Columns of a table in ordinal order without the excluded ones (names compare case-insensitively)."""
    hidden = {e.lower() for e in exclude}
    rows = [(i + 1, c.name, c.dataType) for i, c in enumerate(spark.catalog.listColumns(table))
            if c.name.lower() not in hidden]
    return spark.createDataFrame(rows, "ordinal_position int, column_name string, data_type string").orderBy("ordinal_position")


def catalog_tables(spark: SparkSession, db: str | None = None, types: Sequence[str] | None = None,
                   pattern: str | None = None) -> DataFrame:
    """Tables of a database by type (MANAGED, EXTERNAL, VIEW, TEMPORARY) and name pattern."""
    rows = [(t.catalog, ".".join(t.namespace or []), t.name, t.tableType)
            for t in spark.catalog.listTables(db, pattern) if types is None or t.tableType in types]
    return spark.createDataFrame(rows, "catalog string, database string, table_name string, table_type string")
