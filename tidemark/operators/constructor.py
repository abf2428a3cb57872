"""Staging schemas described by metadata rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Labels of constructor rows.
STAGING_TABLE = "STAGING_TABLE"
COLUMN_LABELS = ("PRIMARY_KEY", "ATTRIBUTE", "DATE_MASTER_KEY")

_TEXT = {"varchar", "string", "text", "char"}
_NUMBER = {"number", "decimal", "numeric"}


@dataclass(frozen=True)
class StagingSchema:
    """Names and types derived from a dataset's constructor rows."""

    table: str
    sequence: str
    feed: str
    source: T.StructType
    target: T.StructType
    primary_key: tuple[str, ...]
    attributes: tuple[str, ...]
    date_keys: tuple[str, ...]

    def ddl(self) -> str:
        return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.source)


def _type(name: str | None, precision: str | None) -> T.DataType:
    kind = (name or "varchar").lower()
    if kind in _TEXT:
        return T.StringType()
    if kind in _NUMBER:
        digits = [int(p) for p in precision.split(",")] if precision else [38]
        return T.DecimalType(digits[0], digits[1] if len(digits) > 1 else 0)
    return T._parse_datatype_string(kind)


def schema_from_metadata(constructor: DataFrame, dataset: str) -> StagingSchema:
    """Read the few rows of one dataset: a STAGING_TABLE row (name, schema) and its columns by position."""
    rows = constructor.filter(F.col("dataset") == dataset)
    table = rows.filter(F.col("label") == STAGING_TABLE).select(
        F.lower("source_attribute").alias("name"), F.lower("source_datatype").alias("schema")).collect()
    if len(table) != 1:
        raise ValueError(f"dataset {dataset} has {len(table)} staging tables")
    lowered = [F.lower(c).alias(c) for c in (
        "source_attribute", "source_datatype", "source_precision",
        "target_attribute", "target_datatype", "target_precision")]
    columns = (
        rows.filter(F.col("label").isin(list(COLUMN_LABELS)))
        .orderBy(F.col("position").cast("decimal(38,0)")).select("label", *lowered).collect()
    )
    name, schema = table[0]["name"], table[0]["schema"]
    labelled = lambda label: tuple(c["source_attribute"] for c in columns if c["label"] == label)
    return StagingSchema(
        table=f"{schema}.{name}", sequence=f"{schema}.seq_{name}_id", feed=f"{schema}.strm_{name}",
        source=T.StructType([
            T.StructField(c["source_attribute"], _type(c["source_datatype"], c["source_precision"])) for c in columns]),
        target=T.StructType([
            T.StructField(c["target_attribute"] or c["source_attribute"],
                          _type(c["target_datatype"] or c["source_datatype"], c["target_precision"])) for c in columns]),
        primary_key=labelled("PRIMARY_KEY"), attributes=labelled("ATTRIBUTE"), date_keys=labelled("DATE_MASTER_KEY"),
    )
