"""Grouped sums, distinct counts, ordered string and array aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import assign_ids, row_numbers
from tidemark.session import cut_lineage

# Items one aggregated value may hold; a larger group continues in its next part.
PART_ROWS = 10_000


def sum_by(df: DataFrame, keys: Sequence[str] | Mapping[str, Column], col: str, alias: str | None = None) -> DataFrame:
    """SUM(col) per key; a mapping groups by derived columns. Partial sums precede the shuffle."""
    if isinstance(keys, Mapping):
        df = df.withColumns(dict(keys))
    return df.groupBy(*list(keys)).agg(F.sum(col).alias(alias or col))


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """One COUNT(DISTINCT) per column in one pass: columns `count_<name>`."""
    count = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(f"count_{c}") for c in cols])


def _in_parts(df: DataFrame, keys: Sequence[str], order: Sequence[str], part_rows: int,
              rows_per_slice: int | None = None) -> DataFrame:
    """Add `_rn` (position) and `part_no`; every (key, part) holds at most part_rows rows."""
    if keys:
        placed = row_numbers(df, keys, order, "_rn", rows_per_slice)
    else:
        placed = assign_ids(df, 1, list(order), "_rn")
    return placed.withColumn("part_no", F.floor((F.col("_rn") - 1) / part_rows).cast("int"))


def string_agg(df: DataFrame, keys: Sequence[str], col: str, sep: str, order: Sequence[str],
               alias: str = "text", part_rows: int = PART_ROWS, rows_per_slice: int | None = None) -> DataFrame:
    """Ordered LISTAGG: keys, part_no, text. `order` must be total.

    A group of up to part_rows rows is one part (part_no 0). A larger one continues in further
    parts, whose texts joined by `sep` in part order are the whole; nothing is cut.
    """
    placed = _in_parts(df, keys, order, part_rows, rows_per_slice)
    items = F.array_sort(F.collect_list(F.struct("_rn", F.col(col).alias("_v"))))
    return (
        placed.groupBy(*keys, "part_no").agg(items.alias("_items"))
        .select(*keys, "part_no", F.array_join(F.col("_items._v"), sep).alias(alias))
    )


def rows_to_array(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), alias: str = "rows",
                  part_rows: int = PART_ROWS, rows_per_slice: int | None = None) -> DataFrame:
    """Whole-row objects as arrays: keys, part_no, rows; parts as in `string_agg`."""
    columns = [c for c in df.columns if c not in set(keys)]
    placed = _in_parts(df, keys, order, part_rows, rows_per_slice)
    items = F.array_sort(F.collect_list(F.struct("_rn", F.struct(*columns).alias("_row"))))
    return (
        placed.groupBy(*keys, "part_no").agg(items.alias("_items"))
        .select(*keys, "part_no", F.col("_items._row").alias(alias))
    )


def json_per_group(df: DataFrame, keys: Sequence[str], k: str, v: Column | str, alias: str = "json",
                   part_rows: int = PART_ROWS, rows_per_slice: int | None = None) -> DataFrame:
    """JSON objects from (k, v) rows, names in order: keys, part_no, json; parts as in `string_agg`.

    Every part is an object of its own. Rows with a NULL name are left out, as an object has no place
    for them; a group without any name gives no row. Names repeated in a group are combined before the
    shuffle, the largest value wins; the combined rows are written once, as they are counted and collected.
    """
    value = v if isinstance(v, Column) else F.col(v)
    pairs = cut_lineage(df.filter(F.col(k).isNotNull()).groupBy(*keys, F.col(k).alias("_k")).agg(F.max(value).alias("_v")), "pairs")
    placed = _in_parts(pairs, keys, ["_k"], part_rows, rows_per_slice)
    entries = F.array_sort(F.collect_list(F.struct("_k", "_v")))
    return placed.groupBy(*keys, "part_no").agg(F.to_json(F.map_from_entries(entries)).alias(alias))
