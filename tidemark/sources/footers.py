"""Statistics of Parquet files, read from their footers by tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.sources.files import read_binary

# Types whose smallest and largest value a footer holds as they are. Texts may be left out or cut
# there, floating numbers leave NaN out, and zoned times are often stored without statistics.
EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampNTZType, T.BooleanType, T.DecimalType)


def _opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path in it; a listed path is not percent-encoded."""
    local = re.fullmatch(r"file:/+(.*)", path)
    if local or path.startswith("/"):
        return pyarrow.fs.LocalFileSystem(), "/" + local[1] if local else path
    return pyarrow.fs.FileSystem.from_uri(quote(path, safe=":/@"))


def footers_reachable(path: str) -> bool:
    """Whether Arrow, which reads the footers, knows the file system of `path`; Spark may know more."""
    try:
        _opened(path)
    except (pa.ArrowException, OSError):
        return False
    return True


def footer_spans(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One row for each Parquet file below `path` and column: file, rows, lo_<column> and hi_<column>, and whole.

    Each footer is opened once, by a task; no column data is read, and the driver sees no path. NULL
    sorts first: `lo` is NULL if the file has a NULL, or lacks the column, and `hi` if it has nothing
    else. `whole` is false for a file that lacks statistics of a column, whose ends then mean nothing.
    Columns must be of the types in `EXACT`.
    """
    schema = spark.read.option("recursiveFileLookup", "true").parquet(path).schema
    odd = [c for c in columns if not isinstance(schema[c].dataType, EXACT)]
    if odd:
        raise TypeError(f"footers hold no exact ends of {odd}")
    ends = [T.StructField(f"{end}_{c}", schema[c].dataType) for c in columns for end in ("lo", "hi")]
    shape = T.StructType([T.StructField("file", T.StringType()), T.StructField("rows", T.LongType()),
                          *ends, T.StructField("whole", T.BooleanType())])
    arrow, names = to_arrow_schema(shape), list(columns)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_file_ends(file, names) for file in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[i] for row in found], field.type) for i, field in enumerate(arrow)], schema=arrow)

    return read_binary(spark, path, "*.parquet", recursive=True).select("path").mapInArrow(read, shape)


def _file_ends(file: str, columns: Sequence[str]) -> tuple:
    """(file, rows, lo and hi of each column, whole) from one footer."""
    system, place = _opened(file)
    with system.open_input_file(place) as stream:
        footer = pq.ParquetFile(stream).metadata
    at = {footer.schema.column(i).path: i for i in range(footer.num_columns)}
    ends, whole = [], True
    for name in columns:
        low = high = None
        nulls = name not in at
        for group in range(footer.num_row_groups if name in at else 0):
            chunk = footer.row_group(group).column(at[name])
            stats = chunk.statistics if chunk.is_stats_set else None
            if stats is None or not stats.has_null_count:
                whole = False
                continue
            nulls = nulls or stats.null_count > 0
            if stats.has_min_max:
                low = stats.min if low is None else min(low, stats.min)
                high = stats.max if high is None else max(high, stats.max)
            elif stats.null_count < chunk.num_values:
                whole = False
        ends += [None if nulls else low, high]
    return (file, footer.num_rows, *ends, whole)
