"""Ordered operators: next value, running sum, row number, ids, effective dates, top-n.

A plain `Window.partitionBy(key)` puts a whole key into one task. Here, when a key has too many
rows, all rows are cut into slices by range of (key, order); the window runs per (key, slice) and
a second, small step carries the value across slice borders. When no key is hot the plan is the
plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.compare import null_safe_equal
from tidemark.functions.dates import open_end
from tidemark.session import cut_lineage

SLICE, HOT = "_slice", "_hot"
ROWS_PER_SLICE = 5_000_000


def scan_identity(df: DataFrame) -> DataFrame:
    """Adds the identity of a row of a file scan: a hash of the file's path, which is shorter, and the row's number there."""
    return df.select("*", F.xxhash64("_metadata.file_path").alias("_f"), F.col("_metadata.row_index").alias("_r"))


def _identified(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and give every row a fixed identity, so that equal rows can be told apart."""
    return scan_identity(cut_lineage(df, label))


IDENTITY = ["_f", "_r"]


def more_rows_than(df: DataFrame, n: int) -> bool:
    """Whether `df` has more than `n` rows; a bare scan answers from file footers."""
    return df.count() > n


def _has_hot_key(df: DataFrame, keys: list[str], rows_per_slice: int) -> bool:
    """Whether a key has more than `rows_per_slice` rows; counts combine before the shuffle."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return not counted.filter(F.col("_n") > rows_per_slice).isEmpty()


def with_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_slice: int | None = None,
                probe: DataFrame | None = None) -> tuple[DataFrame, list[str], bool]:
    """(rows, order to use, whether rows are cut); cut rows have a `_slice`, those of a key in several
    slices are `_hot`.

    A relation of no more than `rows_per_slice` rows cannot hold a hot key, so its keys are not
    counted; rows decide, since compressed bytes say nothing about them. When a key is hot the rows
    are written once and their identity ends the order, so that even a third of all rows being
    copies of one row is spread; there are as many slices as the rows ask for. `probe` is a cheaper
    relation to count keys in, with at least as many rows per key as `df`.
    """
    keys, order = list(keys), list(order)
    probe = df if probe is None else probe
    rows_per_slice = rows_per_slice or ROWS_PER_SLICE
    if not more_rows_than(probe, rows_per_slice) or not _has_hot_key(probe, keys, rows_per_slice):
        return df, order, False
    fixed, order = _identified(df, "hot-rows"), [*order, *IDENTITY]
    slices = -(-fixed.count() // rows_per_slice)
    # Written, so that the borders, which are sampled, stay the same for every later step.
    ranged = cut_lineage(fixed.repartitionByRange(max(2, slices), *keys, *order).withColumn(SLICE, F.spark_partition_id()), "slices")
    border = ranged.groupBy(*keys).agg(F.min(SLICE).alias("_from"), F.max(SLICE).alias("_to")).filter("_from != _to")
    # At most one key for each border between slices.
    border = cut_lineage(border, "border-keys")
    sliced = ranged.alias("l").join(border.alias("r"), null_safe_equal("l", "r", keys), "left").select(
        "l.*", F.col("r._from").isNotNull().alias(HOT))
    return sliced, order, True


HELPERS = [SLICE, HOT, "_carry", *IDENTITY]


def _carry_join(rows: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    """Attach the per-(key, slice) value `_carry` of hot keys."""
    small = cut_lineage(carried.select(*keys, SLICE, "_carry"), "carry")
    condition = null_safe_equal("l", "r", [*keys, SLICE]) & F.col(f"l.{HOT}")
    return rows.alias("l").join(small.alias("r"), condition, "left").select("l.*", "r._carry")


def next_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, alias: str,
               rows_per_slice: int | None = None) -> DataFrame:
    """`value` of the following row of the same key in ascending `order` (a total order)."""
    keys = list(keys)
    rows, order, cut = with_slices(df, keys, order, rows_per_slice)
    if not cut:
        return df.withColumn(alias, F.lead(value).over(Window.partitionBy(*keys).orderBy(*order)))
    window = Window.partitionBy(*keys, SLICE).orderBy(*order)
    ahead = rows.withColumn(alias, F.lead(value).over(window))
    ahead = ahead.withColumn("_last", F.lead(F.lit(True)).over(window).isNull())
    heads = (
        rows.filter(HOT).groupBy(*keys, SLICE)
        .agg(F.min(F.struct(*order, F.col(value).alias("_v"))).alias("_head"))
        .withColumn("_carry", F.lead("_head._v").over(Window.partitionBy(*keys).orderBy(SLICE)))
    )
    filled = F.when(F.col("_last") & F.col(HOT), F.col("_carry")).otherwise(F.col(alias))
    return _carry_join(ahead, heads, keys).withColumn(alias, filled).drop("_last", *HELPERS)


def _running(df: DataFrame, keys: list[str], order: Sequence[str], total: Column, alias: str,
             rows_per_slice: int | None, probe: DataFrame | None = None) -> DataFrame:
    """Running aggregate of an additive expression, current row included."""
    rows, order, cut = with_slices(df, keys, order, rows_per_slice, probe=probe)
    by = Window.partitionBy(*keys, *([SLICE] if cut else [])).orderBy(*order)
    within = rows.withColumn(alias, total.over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    if not cut:
        return within
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.filter(HOT).groupBy(*keys, SLICE).agg(total.alias("_total"))
        .withColumn("_carry", F.sum("_total").over(before))
    )
    # A slice without any value so far keeps NULL, as one window over the key would.
    summed = F.when(F.col("_carry").isNull(), F.col(alias)).when(
        F.col(alias).isNull(), F.col("_carry")).otherwise(F.col(alias) + F.col("_carry"))
    return _carry_join(within, carried, keys).withColumn(alias, summed).drop(*HELPERS)


def running_sum(df: DataFrame, part: Sequence[str], order: Sequence[str], col: str, alias: str = "running_sum",
                rows_per_slice: int | None = None, probe: DataFrame | None = None) -> DataFrame:
    """SUM(col) over rows up to the current one; `order` should be total (add tie-breakers)."""
    return _running(df, list(part), list(order), F.sum(col), alias, rows_per_slice, probe)


def row_numbers(df: DataFrame, part: Sequence[str], order: Sequence[str], alias: str = "rn",
                rows_per_slice: int | None = None) -> DataFrame:
    """1-based position of the row within its key."""
    return _running(df, list(part), list(order), F.count(F.lit(1)), alias, rows_per_slice)


def next_time(df: DataFrame, key: Sequence[str], ts: str, alias: str = "next_time",
              ties: Sequence[str] = (), rows_per_slice: int | None = None) -> DataFrame:
    """Next newer `ts` of the same key: LAG over descending time."""
    return next_value(df, key, [ts, *ties], ts, alias, rows_per_slice)


def dated(next_ts: Column) -> tuple[Column, Column]:
    """(valid_to, current_flag) from the next newer time."""
    return F.coalesce(next_ts, open_end()), F.when(next_ts.isNull(), "Y").otherwise("N")


def effective_dates(df: DataFrame, key: Sequence[str], ts: str, ties: Sequence[str] = (),
                    rows_per_slice: int | None = None) -> DataFrame:
    """History rows: valid_from = ts, valid_to = next newer ts or the open end, current_flag Y/N."""
    ahead = next_time(df, key, ts, "_next", ties, rows_per_slice)
    valid_to, flag = dated(F.col("_next"))
    return ahead.select(
        *[c for c in df.columns if c != ts],
        F.col(ts).alias("valid_from"), valid_to.alias("valid_to"), flag.alias("current_flag"),
    )


# monotonically_increasing_id packs (partition number, row in partition) into one long.
_ROW_BITS = 33


def sorted_by_range(df: DataFrame, order: Sequence[str | Column], partitions: int | None = None,
                    spread: bool | None = None) -> DataFrame:
    """Range partitions in `order`, sorted within.

    Range partitioning reads its input twice (sample, shuffle), so a large input is written first;
    the identity of the written rows then ends the order, which spreads a hot order value, and
    copies of one row, over several partitions. `spread` forces or forbids that.
    """
    if spread is None:
        spread = more_rows_than(df, ROWS_PER_SLICE)
    by = list(order)
    if spread:
        df, by = _identified(df, "spread"), [*by, *IDENTITY]
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*by).drop(*IDENTITY)


def assign_ids(df: DataFrame, start: int = 1, order_by: Sequence[str | Column] | None = None,
               id_col: str = "id", spread: bool | None = None) -> DataFrame:
    """Dense surrogate keys `start, start + 1, ...` in `order_by` order (any order when None).

    Rows are range-partitioned and sorted once and written to the shared folder, so that row
    positions stay fixed; the per-partition offsets are one row per partition. No task ever holds
    more than one range.
    """
    placed = sorted_by_range(df, order_by, spread=spread) if order_by else df
    fixed = cut_lineage(placed.withColumn("_pos", F.monotonically_increasing_id()), "ids")
    part = F.shiftright("_pos", _ROW_BITS)
    row = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        fixed.groupBy(part.alias("_part")).agg((F.max(row) + 1).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    # offsets: one row per partition of the write above, hence the safe broadcast.
    numbered = fixed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    identity = (F.lit(start).cast("long") + F.col("_offset") + row).alias(id_col)
    return numbered.select(identity, *[c for c in df.columns if c != id_col])


def top_n(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """First n rows of an order; plans as TakeOrderedAndProject, n rows per task."""
    return df.orderBy(*order).limit(n)


def cap(df: DataFrame, ts: str, n: int = 1000, ties: Sequence[str] = ()) -> DataFrame:
    """Newest n rows of a log."""
    return top_n(df, [F.col(ts).desc(), *[F.col(t).asc() for t in ties]], n)
