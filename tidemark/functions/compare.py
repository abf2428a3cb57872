"""Comparisons and typed conversion of loosely typed input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def differs_ci(a: Column, b: Column) -> Column:
    """Case-insensitive inequality; NULL when either side is NULL."""
    return F.upper(a) != F.upper(b)


def differs_num(text: Column, number: Column) -> Column:
    """Text compared with a number; NULL when the text is not a number."""
    return text.try_cast("decimal(38,10)") != number.try_cast("decimal(38,10)")


def null_safe_equal(left: str, right: str, columns: Sequence[str]) -> Column:
    """Conjunction of `left.c <=> right.c`."""
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return condition


def equal_on(left: str, right: str, columns: Sequence[str], null_safe: bool = False) -> Column:
    """Join condition over the named columns of two aliased relations."""
    parts = []
    for name in columns:
        a, b = F.col(f"{left}.{name}"), F.col(f"{right}.{name}")
        parts.append(a.eqNullSafe(b) if null_safe else a == b)
    condition = parts[0]
    for part in parts[1:]:
        condition = condition & part
    return condition


def to_schema(df: DataFrame, schema: T.StructType, on_error: str = "abort") -> DataFrame:
    """Cast text columns to `schema` by name.

    on_error: "abort" raises on the first value that does not convert, "null" leaves NULL, and
    "reject" keeps the row and adds `_rejected`, the array of column names that failed.
    """
    if on_error not in ("abort", "null", "reject"):
        raise ValueError(f"unknown on_error: {on_error}")
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema}
    failed = {name: F.col(name).isNotNull() & value.isNull() for name, value in typed.items()}
    if on_error == "null":
        return df.select([value.alias(name) for name, value in typed.items()])
    if on_error == "abort":
        return df.select([
            F.when(failed[name], F.raise_error(F.concat(F.lit(f"{name} does not convert: "), F.col(name).cast("string"))))
            .otherwise(value).alias(name) for name, value in typed.items()])
    names = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in failed.items()]))
    return df.select(*[value.alias(name) for name, value in typed.items()], names.alias("_rejected"))


def rescale(value: Column, precision: int, scale: int, reference_rounding: bool = False) -> Column:
    """Decimal rescale; `reference_rounding` lands the value in a scale-0 column afterwards."""
    scaled = value.cast(T.DecimalType(precision, scale))
    return scaled.cast(T.DecimalType(38, 0)) if reference_rounding else scaled
