"""Caller-supplied functions, SQL functions and parameterised queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Extractor = Callable[[int, object], str]


def external_function(fn: Extractor) -> Callable[[Column, Column], Column]:
    """Wrap `(n, value) -> JSON text` as an Arrow-batched scalar function."""

    @F.pandas_udf("string")
    def call(n: pd.Series, v: pd.Series) -> pd.Series:
        return pd.Series([fn(int(i), x) for i, x in zip(n, v)], index=n.index)

    return call


def enrich_files(df: DataFrame, fn: Extractor, schema: str | None = None, n: int = 0, source: str = "content",
                 alias: str = "data") -> DataFrame:
    """Apply an extractor to each file row and parse its JSON: a VARIANT, or a typed struct with `schema`.

    The text returned is all that leaves the Python worker; `source` is dropped.
    """
    text = external_function(fn)(F.lit(n), F.col(source))
    parsed = F.from_json(text, schema) if schema else F.parse_json(text)
    return df.select(*[c for c in df.columns if c != source], parsed.alias(alias))


def create_table_function(spark: SparkSession, name: str, schema: str, query: str, args: str = "") -> DataFrame | None:
    """Create a SQL table function, called as `SELECT ... FROM name()`; returns its rows when it takes no arguments."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS TABLE ({schema}) RETURN {query}")
    return None if args else spark.sql(f"SELECT * FROM {name}()")


def run_query(spark: SparkSession, query: str, args: Mapping[str, object] | list | None = None) -> DataFrame:
    """Parameterised query: `:name` or `?` values, IDENTIFIER(:name) for names."""
    return spark.sql(query, args=args)


def as_relation(df: DataFrame, name: str) -> DataFrame:
    """Give a result a name further SQL can select from."""
    df.createOrReplaceTempView(name)
    return df
