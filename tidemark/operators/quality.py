"""Data-quality checks and verification of declared keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import ntz
from tidemark.operators.joins import lookup_code, union_all
from tidemark.operators.ordered import assign_ids

# Name of the NULL rule and first exception id.
ATTRIBUTE_IS_NULL = "ATTRIBUTE_IS_NULL"
FIRST_ID = 10000


@dataclass(frozen=True)
class Check:
    """One rule on one attribute; without a predicate the attribute must not be NULL."""

    attribute: str
    pk: str
    object_name: str
    routine: str = "Test"
    code: str = ATTRIBUTE_IS_NULL
    fails: Column | None = None

    def failure(self) -> Column:
        return F.col(self.attribute).isNull() if self.fails is None else F.coalesce(self.fails, F.lit(False))


def run_checks(df: DataFrame, checks: Sequence[Check], codes: DataFrame, now: datetime | str,
               start: int = FIRST_ID, current_only: bool = True) -> DataFrame:
    """Exception rows of several checks in a single scan.

    `codes` has data_quality_exception_code_id and data_quality_exception_code_name.
    source_record_pk_info holds the key column's name, source_record_pk_value its value.
    """
    if current_only:
        df = df.filter(F.col("current_flag") == "Y")
    found = [
        F.when(c.failure(), F.struct(
            F.lit(c.routine).alias("validation_routine"),
            F.lit(c.code).alias("_code"),
            F.lit(c.object_name).alias("source_object_name"),
            F.lit(c.attribute).alias("source_attribute_name"),
            F.lit(c.pk).alias("source_record_pk_info"),
            F.col(c.pk).cast("string").alias("source_record_pk_value"),
        ))
        for c in checks
    ]
    rows = df.select(F.explode(F.array_compact(F.array(*found))).alias("e")).select("e.*")
    coded = lookup_code(rows, codes, "_code", "data_quality_exception_code_name", "data_quality_exception_code_id")
    order = ["source_object_name", "source_attribute_name", "source_record_pk_value", "validation_routine", "_code"]
    numbered = assign_ids(coded, start, order, "data_quality_exception_id")
    return numbered.select(
        "data_quality_exception_id", "validation_routine", "data_quality_exception_code_id", "source_object_name",
        "source_attribute_name", "source_record_pk_info", "source_record_pk_value",
        ntz(now).alias("insert_timestamp"),
    )


def dq_not_null(df: DataFrame, attr: str, pk: str, codes: DataFrame, now: datetime | str, object_name: str = "",
                routine: str = "Test", start: int = FIRST_ID) -> DataFrame:
    """Exception rows for current rows whose attribute is NULL."""
    return run_checks(df, [Check(attr, pk, object_name, routine)], codes, now, start)


def rule_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row a check, from a single scan: validation_routine, code, source_object_name, source_attribute_name, rows, failed.

    Counts of loads add up, so a total is kept by a maintained view over them. Checks are told apart by
    these names; none may occur twice.
    """
    names = [(c.routine, c.code, c.object_name, c.attribute) for c in checks]
    if len(set(names)) < len(names):
        raise ValueError("a check occurs twice")
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.when(c.failure(), 1)).alias(f"_{i}") for i, c in enumerate(checks)])
    columns = ("validation_routine", "code", "source_object_name", "source_attribute_name")
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(columns, name)], F.col("_rows").alias("rows"), F.col(f"_{i}").alias("failed"))
            for i, name in enumerate(names)]
    return counts.select(F.explode(F.array(*rows)).alias("e")).select("e.*")


def check_keys(df: DataFrame, primary: Sequence[str] = (), unique: Sequence[Sequence[str]] = (),
               foreign: Sequence[tuple[Sequence[str], DataFrame, Sequence[str]]] = (),
               not_null: Sequence[str] = ()) -> DataFrame:
    """Violations of declared keys: rule, columns, key (text), row_count.

    Duplicate counts combine before the shuffle; NULLs violate primary keys and not-null rules and
    are exempt from unique and foreign keys.
    """
    def keyed(cols: Sequence[str]) -> Column:
        return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in cols])

    def report(rule: str, cols: Sequence[str], bad: DataFrame) -> DataFrame:
        # `bad` has one row for each key already.
        return bad.select(F.lit(rule).alias("rule"), F.lit(",".join(cols)).alias("columns"),
                          keyed(cols).alias("key"), F.col("_n").alias("row_count"))

    def present(cols: Sequence[str]) -> Column:
        test = F.lit(True)
        for c in cols:
            test = test & F.col(c).isNotNull()
        return test

    def copies(cols: Sequence[str]) -> DataFrame:
        return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))

    found = []
    if primary:
        found.append(report("primary", primary, copies(primary).filter((F.col("_n") > 1) | ~present(primary))))
    for cols in unique:
        found.append(report("unique", cols, copies(cols).filter((F.col("_n") > 1) & present(cols))))
    for cols, parent, parent_cols in foreign:
        keys = parent.select([F.col(p).alias(c) for p, c in zip(parent_cols, cols)]).distinct()
        found.append(report("foreign", cols, copies(cols).filter(present(cols)).join(keys, list(cols), "left_anti")))
    for col in not_null:
        found.append(report("not_null", [col], copies([col]).filter(F.col(col).isNull())))
    if not found:
        raise ValueError("no key declared")
    return union_all(found)
