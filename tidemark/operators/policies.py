"""Column masks and row filters by role. The role is an argument, never session state."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: text shown in place of a masked value.
MASKED = "*********"


def masked(value: Column, role: str, allowed: Sequence[str], public: Column | None = None) -> Column:
    """The value for an allowed role, or where `public` is true; the mask otherwise."""
    shown = F.lit(role).isin(list(allowed))
    if public is not None:
        shown = shown | F.coalesce(public, F.lit(False))
    return F.when(shown, value.cast("string")).otherwise(F.lit(MASKED))


def mask(df: DataFrame, col: str, role: str, allowed: Sequence[str]) -> DataFrame:
    return df.withColumn(col, masked(F.col(col), role, allowed))


def mask_when(df: DataFrame, col: str, role: str, allowed: Sequence[str], cond: Column) -> DataFrame:
    """Mask unless the role is allowed or the condition on other columns holds."""
    return df.withColumn(col, masked(F.col(col), role, allowed, cond))


def row_filter(df: DataFrame, pred: Column) -> DataFrame:
    """Rows the policy shows; a predicate on the role alone hides all or nothing."""
    return df.filter(F.coalesce(pred, F.lit(False)))


ColumnPolicy = Callable[[str, DataFrame], Column]
RowPolicy = Callable[[str, DataFrame], Column]


@dataclass
class PolicySet:
    """Policies by table. `apply` runs before any view or change feed is built on the table, so the
    policies hold in everything derived from it; dropping one shows the data again."""

    columns: dict[tuple[str, str], tuple[str, ColumnPolicy]] = field(default_factory=dict)
    rows: dict[str, tuple[str, RowPolicy]] = field(default_factory=dict)

    def set_mask(self, table: str, column: str, policy_name: str, policy: ColumnPolicy) -> None:
        self.columns[(table.lower(), column.lower())] = (policy_name, policy)

    def unset_mask(self, table: str, column: str) -> None:
        self.columns.pop((table.lower(), column.lower()), None)

    def add_row_policy(self, table: str, policy_name: str, policy: RowPolicy) -> None:
        self.rows[table.lower()] = (policy_name, policy)

    def drop_row_policy(self, table: str) -> None:
        self.rows.pop(table.lower(), None)

    def apply(self, table: str, df: DataFrame, role: str) -> DataFrame:
        """Row policy first, on unmasked values, then all masks in one projection."""
        name = table.lower()
        if name in self.rows:
            df = row_filter(df, self.rows[name][1](role, df))
        shown = [
            self.columns[(name, c.lower())][1](role, df).alias(c) if (name, c.lower()) in self.columns else F.col(c)
            for c in df.columns
        ]
        return df.select(shown)

    def references(self, spark: SparkSession) -> DataFrame:
        """Rows (policy_name, policy_kind, object_name, column_name)."""
        found = [(p, "MASKING_POLICY", t, c) for (t, c), (p, _) in self.columns.items()]
        found += [(p, "ROW_ACCESS_POLICY", t, None) for t, (p, _) in self.rows.items()]
        return spark.createDataFrame(
            found, "policy_name string, policy_kind string, object_name string, column_name string")


def policy(spark: SparkSession, name: str, args: str, returns: str, expression: str) -> Callable[..., Column]:
    """Create a SQL scalar function (inlined by the optimiser) and return a caller for it."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {returns} RETURN {expression}")
    return lambda *columns: F.call_function(name, *columns)
