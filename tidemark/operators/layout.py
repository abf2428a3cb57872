"""Clustered file layout and a report of how well a layout is clustered."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ordered import IDENTITY, running_sum, scan_identity, sorted_by_range
from tidemark.session import cut_lineage, new_folder
from tidemark.sources.files import folder_names
from tidemark.sources.footers import EXACT, footer_spans, footers_reachable

# Bits of a column's place in a Z-order: at most 255 borders a column.
Z_BITS = 8
# Rows one task sorts, however many a file gets.
ROWS_PER_SORT = 2_500_000


def _write_sorted(df: DataFrame, by: Sequence[Column], n_files: int, path: str, names: Sequence[str], scanned: bool) -> None:
    """Write `names` of rows sorted by `by` as `n_files` files of disjoint ranges.

    A file of more than ROWS_PER_SORT rows is sorted as several ranges, each by a task and written to
    the shared folder; one task then copies them, in order, into the file. What a task sorts so stays
    the same as files grow, and the plan has one scan for each ROWS_PER_SORT rows.
    """
    order = list(by)
    if scanned:
        df, order = scan_identity(df), [*order, *IDENTITY]
    ranges = -(-df.count() // (n_files * ROWS_PER_SORT))
    spread = False if scanned else None
    if ranges <= 1:
        sorted_by_range(df, order, n_files, spread).select(*names).write.parquet(path)
        return
    spark, folder = df.sparkSession, new_folder(df.sparkSession, "ranges")
    ranged = sorted_by_range(df, order, n_files * ranges, spread).select(*names)
    ranged.write.option("maxRecordsPerFile", 0).parquet(folder)
    files = [[] for _ in range(n_files)]
    for name in folder_names(spark, folder):
        if name.startswith("part-"):
            files[int(name.split("-")[1]) // ranges].append(spark.read.schema(ranged.schema).parquet(f"{folder}/{name}"))
    union = lambda frames: reduce(DataFrame.unionAll, frames)
    # Frames of one partition each would be laid over each other by the union; one of another partitioning prevents that.
    apart = spark.createDataFrame([], ranged.schema)
    union([*[union(parts).coalesce(1) for parts in files if parts], apart]).write.parquet(path)


def write_clustered(df: DataFrame, exprs: Sequence[str | Column], n_files: int, path: str, scanned: bool = False) -> None:
    """Write range-partitioned, sorted files, so that file and row-group statistics prune scans.

    A hash of the row ends the order: a key with few values (a boolean, a hot day) still fills all
    files instead of one per value. `scanned` says that `df` is a file scan, whose rows need not be
    written to tell copies apart.
    """
    columns = [F.expr(e) if isinstance(e, str) else e for e in exprs]
    _write_sorted(df, [*columns, F.xxhash64(*df.columns)], n_files, path, df.columns, scanned)


def write_by_value(df: DataFrame, part: Column, path: str) -> None:
    """Write one file for each value of `part`, NULL included; there should be few.

    Rows are dealt by the place of their value, so no task gets two values and none sorts.
    """
    values = sorted((r[0] for r in df.select(part.alias("v")).distinct().collect()), key=lambda v: (v is not None, v))
    if not values:
        df.write.parquet(path)
        return
    known = [v for v in values if v is not None]
    place = F.lit(0) if not known else F.coalesce(F.array_position(F.array(*[F.lit(v) for v in known]), part), F.lit(0)).cast("int")
    df.repartitionById(len(known) + 1, place).write.parquet(path)


def _scaled(column: str, kind: T.DataType) -> Column:
    """A column as something quantiles exist of: texts by their first seven bytes, in order."""
    if isinstance(kind, T.BooleanType):
        return F.col(column).cast("int")
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("long")
    return F.col(column)


def quantile_borders(df: DataFrame, columns: Sequence[str], bits: int = Z_BITS) -> list[list[Any]]:
    """For each column, 2^bits - 1 values that cut its rows into parts of like size: one pass, partial sketches.

    A value with many rows fills several borders. Without any value there are none.
    """
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(_scaled(c, df.schema[c].dataType), shares).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    return [row[i] or [] for i in range(len(columns))]


def _place(value: Column, borders: Sequence[Any], bits: int) -> Column:
    """Number of ascending borders not above the value, by bisection: one bit of it a step."""
    if not borders:
        return F.lit(0)
    cuts = F.array(*[F.lit(b) for b in borders])
    # Past the last border `get` is NULL, so the place stays.
    further = lambda at, step: F.when(F.get(cuts, at + step - 1) <= value, at + step).otherwise(at)
    return F.aggregate(F.array(*[F.lit(1 << k) for k in reversed(range(bits))]), F.lit(0), further)


def with_z_rank(df: DataFrame, columns: Sequence[str], borders: Sequence[Sequence[Any]], alias: str, bits: int = Z_BITS) -> DataFrame:
    """Adds the Z-order rank of a row: the bits of each column's place among its borders, in turn.

    The place is the number of borders not above the value (at most 2^bits - 1 ascending borders a
    column; fewer are as good), found by bisection in `bits` steps; NULL has place 0. The first
    column gives the higher bit of each turn.
    """
    n = len(columns)
    if n * bits > 62:
        raise ValueError(f"{n} columns of {bits} bits do not fit a 64-bit rank")
    places = []
    for column, ends in zip(columns, borders):
        if len(ends) >= 1 << bits:
            raise ValueError(f"{len(ends)} borders do not fit {bits} bits")
        places.append(_place(_scaled(column, df.schema[column].dataType), ends, bits))
    placed = df.withColumns({f"_place_{j}": place.cast("long") for j, place in enumerate(places)})
    rank = F.lit(0).cast("long")
    for k in range(bits):
        for j in range(n):
            bit = F.shiftright(f"_place_{j}", k).bitwiseAND(F.lit(1))
            rank = rank.bitwiseOR(F.shiftleft(bit, k * n + (n - 1 - j)))
    return placed.select(*[F.col(c) for c in df.columns], rank.alias(alias))


def write_z_ordered(df: DataFrame, columns: Sequence[str], n_files: int, path: str, bits: int = Z_BITS,
                    scanned: bool = False) -> None:
    """Write files by ranges of a Z-order, so that statistics prune scans on each of the columns.

    With k columns a file spans about the k-th root of `n_files`-th part of each column's values, where
    files sorted by one column span all values of the others. Places come from quantiles, so skewed
    columns are cut by rows and not by value; a hash of the row ends the order. `scanned` is as for
    `write_clustered`.
    """
    ranked = with_z_rank(df, columns, quantile_borders(df, columns, bits), "_z_rank", bits)
    _write_sorted(ranked, [F.col("_z_rank"), F.xxhash64(*df.columns)], n_files, path, df.columns, scanned)


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str, mode: str = "overwrite") -> None:
    """Catalogue table bucketed and sorted by unique keys: snapshots written alike join without a shuffle."""
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).mode(mode).saveAsTable(name))


def clustering_report(df: DataFrame, exprs: Sequence[str | Column], rows_per_slice: int | None = None) -> DataFrame:
    """One row: total_files, constant_files, average_overlaps, average_depth for the key `exprs`.

    `df` is a file scan. Each file is the interval [min, max] of its key. average_overlaps is the
    mean number of other files a file overlaps, average_depth the mean number of files that hold a
    file's smallest key. Both come from one sweep over interval ends, not from pairs of files.
    """
    columns = [F.expr(e) if isinstance(e, str) else e for e in exprs]
    spans = (
        df.select(F.col("_metadata.file_path").alias("file"), F.struct(*columns).alias("k"))
        .groupBy("file").agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    )
    return span_report(spans, rows_per_slice)


# Two counts in one long: files begun above, files ended below.
_BEGUN = 1 << 32


def span_report(spans: DataFrame, rows_per_slice: int | None = None) -> DataFrame:
    """The report of intervals (file, lo, hi)."""
    # Kinds order the ends at one key value: starts, then the probe of a start, then stops.
    end = lambda at, kind, step: F.struct(F.col(at).alias("at"), F.lit(kind).alias("kind"), F.lit(step).cast("long").alias("step"))
    same = F.when(F.col("lo") == F.col("hi"), 1)
    ends = spans.select("file", same.alias("same"), F.explode(F.array(
        end("lo", 0, _BEGUN), end("lo", 1, 0), end("hi", 2, 1))).alias("e")).select("file", "same", "e.*")
    swept = running_sum(ends.withColumn("_all", F.lit(1)), ["_all"], ["at", "kind", "file"], "step", "so_far", rows_per_slice)
    begun, ended = F.shiftright("so_far", 32), F.col("so_far").bitwiseAND(F.lit(_BEGUN - 1))
    # At a probe: files begun minus files ended before it. At a stop: files begun by then.
    return swept.agg(
        F.count(F.when(F.col("kind") == 2, 1)).alias("total_files"),
        F.count(F.when(F.col("kind") == 2, F.col("same"))).alias("constant_files"),
        F.sum(F.when(F.col("kind") == 1, begun - ended)).alias("_depth"),
        F.sum(F.when(F.col("kind") == 2, begun)).alias("_begun"),
        F.sum(F.when(F.col("kind") == 1, ended)).alias("_ended"),
    ).select(
        "total_files", "constant_files",
        F.round((F.col("_begun") - F.col("_ended")) / F.col("total_files") - 1, 4).alias("average_overlaps"),
        F.round(F.col("_depth") / F.col("total_files"), 4).alias("average_depth"),
    )


def stored(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files below a folder, with the columns they hold: none from folder names."""
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


def file_spans(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """file, rows, lo_<column>, hi_<column> for each Parquet file below `path` that has rows; NULL sorts first.

    From the footers, read once by tasks and written, where Arrow can open the files, the columns'
    types have exact ends there and every file has them; from one pass over the rows otherwise.
    """
    scan = stored(spark, path)
    if footers_reachable(path) and all(isinstance(scan.schema[c].dataType, EXACT) for c in columns):
        read = cut_lineage(footer_spans(spark, path, columns), "footers")
        if read.filter(~F.col("whole")).isEmpty():
            return read.filter("rows > 0").drop("whole")
    ends = [f(F.struct(c))[c].alias(f"{end}_{c}") for c in columns for end, f in (("lo", F.min), ("hi", F.max))]
    return scan.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ends)


def column_reports(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One clustering report a column, `key` naming it, without reading column data where footers have the ends."""
    spans = file_spans(spark, path, columns)
    # As structs, since files whose smallest value is NULL take part too.
    of = lambda c: spans.select("file", F.struct(F.col(f"lo_{c}").alias("k")).alias("lo"), F.struct(F.col(f"hi_{c}").alias("k")).alias("hi"))
    reports = [span_report(of(c)).select(F.lit(c).alias("key"), "*") for c in columns]
    whole = reports[0]
    for report in reports[1:]:
        whole = whole.unionByName(report)
    return whole


def report_path(spark: SparkSession, path: str, exprs: Sequence[str | Column]) -> DataFrame:
    """Clustering report of a Parquet folder; of one plain column by its footers."""
    if len(exprs) == 1 and isinstance(exprs[0], str) and exprs[0] in stored(spark, path).columns:
        return column_reports(spark, path, exprs).drop("key")
    return clustering_report(spark.read.parquet(path), exprs)


def ctas(df: DataFrame, name: str, mode: str = "errorifexists", path: str | None = None) -> None:
    """CREATE TABLE AS SELECT, in the warehouse or at `path`."""
    writer = df.write.mode(mode)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Store a query result as a fresh Parquet folder and read it back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
