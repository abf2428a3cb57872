"""Small frames and row sets for tests."""

from __future__ import annotations


def rows(df, *cols):
    """Rows as a sorted list of tuples."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def typed(spark, data, ddl, **casts):
    """A frame with the named columns cast afterwards (times are given as text)."""
    df = spark.createDataFrame(data, ddl)
    for name, kind in casts.items():
        df = df.withColumn(name, df[name].cast(kind))
    return df
