"""Delimited files: typed and positional scans, schema inference, load and unload."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.compare import to_schema
from tidemark.sources.files import delete_files, file_columns
from tidemark.sources.records import QUOTE, read_records

_BAD = "_bad_line"


@dataclass(frozen=True)
class DelimitedFormat:
    """Reusable reader and writer options. Blank lines are always skipped, quotes within quotes are doubled.

    `line_breaks`: quoted fields may hold line breaks. Batch reads then find records by quote parity,
    in two passes over the files, and still split files; streams read each file in one task. Without
    it a line is a record, and `unload` refuses texts with line breaks.
    """

    sep: str = "|"
    skip_header: bool = True
    # Texts read as NULL.
    null_tokens: tuple[str, ...] = ("NULL", "null")
    empty_as_null: bool = True
    compression: str = "none"
    line_breaks: bool = False

    def override(self, **options) -> DelimitedFormat:
        return replace(self, **options)

    def reader_options(self) -> dict[str, str]:
        return {"sep": self.sep, "header": str(self.skip_header).lower(), "enforceSchema": "true", "quote": QUOTE, "escape": QUOTE,
                "multiLine": str(self.line_breaks).lower()}


PIPE = DelimitedFormat()
COMMA = DelimitedFormat(sep=",")


def _nulls(name: str, fmt: DelimitedFormat) -> Column:
    """The reader takes one NULL token, the empty field; the others are mapped here."""
    column = F.col(name) if fmt.empty_as_null else F.coalesce(name, F.lit(""))
    tokens = [*fmt.null_tokens, ""] if fmt.empty_as_null else list(fmt.null_tokens)
    return F.when(column.isin(tokens), F.lit(None)).otherwise(column).alias(name)


def text_reader(reader, schema: T.StructType, fmt: DelimitedFormat):
    """Batch or stream reader of text columns, keeping the line of records with a wrong field count."""
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*schema.names, _BAD]])
    return (
        reader.schema(text).options(**fmt.reader_options())
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD).option("columnPruning", "false")
    )


def check_records(scan: DataFrame, schema: T.StructType, fmt: DelimitedFormat, file: Sequence[Column] | None = None) -> DataFrame:
    """Typed columns of a `text_reader` scan plus `_rejected` (names of bad columns, `line` for a
    wrong field count), `_file_path` and `_file_name`. One pass; nothing is dropped."""
    text = scan.select(*[_nulls(n, fmt) for n in schema.names], _BAD, *(file_columns() if file is None else file))
    kept = [_BAD, "_file_path", "_file_name"]
    widened = T.StructType([*schema.fields, *[T.StructField(n, T.StringType()) for n in kept]])
    typed = to_schema(text, widened, "reject")
    bad_line = F.when(F.col(_BAD).isNotNull(), F.array(F.lit("line"))).otherwise(F.array().cast("array<string>"))
    return typed.withColumn("_rejected", F.concat(bad_line, "_rejected")).drop(_BAD)


def read_checked(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                 fmt: DelimitedFormat = COMMA) -> DataFrame:
    """Every record of the files with what is wrong with it, see `check_records`."""
    if fmt.line_breaks:
        found = read_records(spark, path).filter(~F.col("value").rlike(r"\A[\x00-\x20]*\z"))
        if fmt.skip_header:
            found = found.filter(~F.col("head"))
        # The carriage return of a line end is not part of the last field.
        value = F.regexp_replace("value", r"\r\z", "")
        text = ", ".join(f"`{n}` string" for n in [*schema.names, _BAD])
        options = {"sep": fmt.sep, "quote": QUOTE, "escape": QUOTE, "multiLine": "true", "lineSep": "\n", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
        parsed = found.select(F.from_csv(value, text, options).alias("_record"), F.col("file").alias("_file_path"))
        name = F.element_at(F.split("_file_path", "/"), -1).alias("_file_name")
        return check_records(parsed.select("_record.*", "_file_path", name), schema, fmt, [F.col("_file_path"), F.col("_file_name")])
    return check_records(text_reader(spark.read, schema, fmt).csv(path), schema, fmt)


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                   fmt: DelimitedFormat = COMMA, on_error: str = "abort", with_file: bool = False) -> DataFrame:
    """Typed scan. on_error: "abort" raises on the first bad record, "skip" leaves bad records out,
    "null" keeps them with NULL in place of what did not convert."""
    if on_error not in ("abort", "skip", "null"):
        raise ValueError(f"unknown on_error: {on_error}")
    rows = read_checked(spark, path, schema, fmt)
    if on_error != "null":
        bad = F.size("_rejected") > 0
        if on_error == "abort":
            message = F.concat(F.lit("bad record in "), "_file_name", F.lit(": "), F.array_join("_rejected", ","))
            bad = F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(False))
        rows = rows.filter(~bad)
    return rows.select(*schema.names, *(["_file_path", "_file_name"] if with_file else []))


def read_positional(spark: SparkSession, path: str | Sequence[str], sep: str = "|", n: int | None = None,
                    with_file: bool = False, skip_header: bool = False, pattern: str | None = None) -> DataFrame:
    """Schemaless scan: text columns c1..cN by position; a line without the separator comes back
    whole in c1. N is unset: the widest line of all files sets it, found in one more pass that counts
    separators (quoted ones too, so quotes can only add columns of NULLs). With N set only the first N fields are read."""
    options = {"sep": sep, "header": str(skip_header).lower(), "enforceSchema": "true"}
    if pattern:
        options["pathGlobFilter"] = pattern
    if n is None:
        globbed = {"pathGlobFilter": pattern} if pattern else {}
        lines = spark.read.options(**globbed).text(path)
        widest = lines.agg(F.max(F.size(F.split("value", re.escape(sep), -1)))).first()[0]
        n = widest or 1
    schema = T.StructType([T.StructField(f"c{i + 1}", T.StringType()) for i in range(n)])
    scan = spark.read.schema(schema).options(**options).csv(path)
    return scan.select(*schema.names, *file_columns()) if with_file else scan


def external_table(spark: SparkSession, folder: str, cols: Mapping[str, tuple[int, str]], pattern: str | None = None,
                   fmt: DelimitedFormat = COMMA, width: int | None = None, on_error: str = "abort") -> DataFrame:
    """Typed virtual columns {name: (1-based position, type)} over the files matching `pattern`.
    Each call lists the folder anew. A value that is not of its type: "abort" raises, "skip" leaves
    the row out, "null" gives NULL."""
    if on_error not in ("abort", "skip", "null"):
        raise ValueError(f"unknown on_error: {on_error}")
    n = max(width or 0, max(position for position, _ in cols.values()))
    scan = read_positional(spark, folder, fmt.sep, n, skip_header=fmt.skip_header, pattern=pattern)
    typed, bad = [], F.lit(False)
    for name, (position, kind) in cols.items():
        value = _nulls(f"c{position}", fmt)
        cast, wrong = value.try_cast(kind), value.isNotNull() & value.try_cast(kind).isNull()
        if on_error == "abort":
            message = F.concat(F.lit(f"bad {kind} in column {name}: "), value)
            cast = F.when(wrong, F.raise_error(message).cast(kind)).otherwise(cast)
        bad = bad | wrong
        typed.append(cast.alias(name))
    return (scan.filter(~bad) if on_error == "skip" else scan).select(typed)


def refresh(spark: SparkSession, folder: str) -> None:
    """Forget cached listings of a folder."""
    spark.catalog.refreshByPath(folder)


def infer_columns(spark: SparkSession, path: str, fmt: DelimitedFormat = COMMA) -> DataFrame:
    """Rows (position, column_name, data_type, ddl) inferred from the whole input."""
    schema = spark.read.options(**fmt.reader_options()).option("inferSchema", "true").csv(path).schema
    rows = [(i + 1, f.name, f.dataType.simpleString(), f"{f.name} {f.dataType.simpleString()}")
            for i, f in enumerate(schema)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string, ddl string")


def infer_ddl(spark: SparkSession, path: str, fmt: DelimitedFormat = COMMA) -> str:
    """Column list for a CREATE TABLE over the files."""
    return ", ".join(r["ddl"] for r in infer_columns(spark, path, fmt).orderBy("position").toLocalIterator())


def unload(df: DataFrame, path: str, fmt: DelimitedFormat = PIPE, mode: str = "errorifexists") -> None:
    """Write delimited files, one per task, each with a header line when the format skips one.

    Reading them with the same format gives the same texts, but for those the format reads as NULL
    (its tokens, and the empty text unless that is turned off). A text with a line break raises unless
    the format has `line_breaks`, in which case every field is quoted.
    """
    texts = [f.name for f in df.schema if f.dataType == T.StringType()]
    if not fmt.line_breaks and texts:
        message = F.lit(f"a text with a line break, unloaded to {path} in a format without line_breaks")
        broken = {c: F.when(F.contains(c, F.lit("\n")) | F.contains(c, F.lit("\r")), F.raise_error(message).cast("string")).otherwise(F.col(c)) for c in texts}
        df = df.select([broken[c].alias(c) if c in broken else F.col(c) for c in df.columns])
    (df.write.mode(mode).option("sep", fmt.sep).option("header", str(fmt.skip_header).lower()).option("quote", QUOTE).option("escape", QUOTE)
     .option("quoteAll", str(fmt.line_breaks).lower()).option("lineSep", "\n")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .option("compression", fmt.compression).option("nullValue", fmt.null_tokens[0] if fmt.null_tokens else "")
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(path))


def copy_into(spark: SparkSession, path: str | Sequence[str], target: str, schema: T.StructType,
              fmt: DelimitedFormat = COMMA, on_error: str = "abort", purge: bool = False) -> int:
    """Append files to a Parquet folder and return the rows loaded.

    `purge` removes exactly the files that were read, after the append has committed, one by one;
    for very many files use `ingest_stream` with `clean_source`.
    """
    from tidemark.operators.dml import run_counted

    rows = read_delimited(spark, path, schema, fmt, on_error)
    loaded = rows.inputFiles()
    counted, count = run_counted(rows, "copy_into")
    counted.write.mode("append").parquet(target)
    if purge:
        delete_files(spark, loaded)
    return count()
