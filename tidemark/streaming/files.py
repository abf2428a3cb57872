"""File feeds, routing by name, continuous ingest, load reports."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.dates import ntz
from tidemark.functions.text import absolute_path, entity_of, file_stamp, relative_path
from tidemark.sources.delimited import COMMA, DelimitedFormat, check_records, read_checked, text_reader
from tidemark.sources.files import list_files, path_exists
from tidemark.sources.relations import log_range

_LISTING = "path string, modificationTime timestamp, length long, content binary"


def file_feed(spark: SparkSession, folder: str, glob: str = "*", max_files: int | None = None,
              recursive: bool = False) -> DataFrame:
    """Streaming relation with one row per new file: path, size, last_modified. Contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(_LISTING).option("pathGlobFilter", glob)
    reader = reader.option("recursiveFileLookup", str(recursive).lower())
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder).select(
        "path", F.col("length").alias("size"), F.col("modificationTime").cast("timestamp_ntz").alias("last_modified"))


def new_files(spark: SparkSession, folder: str, seen: DataFrame, glob: str = "*", recursive: bool = False) -> DataFrame:
    """Batch form: listed files whose name is not in `seen.file`."""
    listed = list_files(spark, folder, glob, recursive=recursive)
    return listed.join(seen.select(F.col("file").alias("relative_path")).distinct(), "relative_path", "left_anti")


def route_files(feed: DataFrame, folder: str) -> DataFrame:
    """Where each new file goes: path_to_file, relative_path, entity, stamp, size, last_modified, action."""
    name = relative_path(folder, F.col("path"))
    return feed.select(
        absolute_path(folder, name).alias("path_to_file"), name.alias("relative_path"), entity_of(name).alias("entity"),
        file_stamp(name).alias("stamp"), "size", "last_modified", F.lit("INSERT").alias("action"))


def ingest_stream(spark: SparkSession, folder: str, schema: T.StructType, sink: str, checkpoint: str,
                  fmt: DelimitedFormat = COMMA, glob: str = "*", max_files: int | None = None,
                  interval: str | None = None, clean_source: dict[str, str] | None = None) -> StreamingQuery:
    """Append arriving files to a Parquet folder, each file once.

    Without `interval` it loads what is there and ends; with one it keeps running. Records keep
    their source file, load time and rejected columns, so `load_report` needs no second scan of
    the input. `clean_source` takes the reader's cleanSource options.
    """
    reader = text_reader(spark.readStream, schema, fmt).option("pathGlobFilter", glob).options(**(clean_source or {}))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = check_records(reader.csv(folder), schema, fmt).withColumn(
        "_loaded_at", F.current_timestamp().cast("timestamp_ntz"))
    writer = rows.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def accepted(loaded: DataFrame) -> DataFrame:
    """Good records of an ingest sink, without bookkeeping columns."""
    kept = [c for c in loaded.columns if c not in ("_rejected", "_file_path", "_file_name", "_loaded_at")]
    return loaded.filter(F.size("_rejected") == 0).select(*kept)


def load_report(loaded: DataFrame, since: datetime | str | None = None, until: datetime | str | None = None) -> DataFrame:
    """Load history per file: file_name, row_count, reject_count, status. Files of one name in several
    folders have a row each."""
    if since is not None:
        loaded = log_range(loaded, "_loaded_at", since, until or "9999-12-31")
    bad = F.size("_rejected") > 0
    return loaded.groupBy("_file_path", F.col("_file_name").alias("file_name")).agg(
        F.count(F.when(~bad, 1)).alias("row_count"), F.count(F.when(bad, 1)).alias("reject_count"),
    ).drop("_file_path").withColumn("status", F.when(F.col("reject_count") == 0, "LOADED").when(F.col("row_count") == 0, "LOAD_FAILED")
                 .otherwise("PARTIALLY_LOADED"))


def validate_load(spark: SparkSession, path: str, schema: T.StructType, fmt: DelimitedFormat = COMMA) -> DataFrame:
    """Rejected records of files, with the columns that failed; nothing is loaded."""
    return read_checked(spark, path, schema, fmt).filter(F.size("_rejected") > 0)


def snapshot_append(df: DataFrame, path: str, now: datetime | str) -> bool:
    """Append one periodic report, stamped `last_updated`, to a folder partitioned by date.

    A date that is complete is left alone, one left unfinished is written anew. Returns whether
    rows were written.
    """
    target = f"{path}/snapshot_date={str(now)[:10]}"
    if path_exists(df.sparkSession, f"{target}/_SUCCESS"):
        return False
    df.withColumn("last_updated", ntz(now)).write.mode("overwrite").parquet(target)
    return True


def on_change(feed: DataFrame, action: Callable[[DataFrame], None]) -> bool:
    """Run a job step only when the feed has rows."""
    if feed.isEmpty():
        return False
    action(feed)
    return True


def on_new_file(spark: SparkSession, folder: str, loader: Callable[[list[str], int], None], checkpoint: str,
                glob: str = "*", max_files: int | None = None, recursive: bool = False) -> None:
    """Call `loader(paths in path order, batch id)` for files not seen under this checkpoint, then end.

    A run without new files starts no batch. Only file paths reach the driver, at most `max_files`
    per batch; batches then follow modification time, paths are ordered within each.
    """
    def batch(df: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in df.select("path").orderBy("path").toLocalIterator()]
        if paths:
            loader(paths, batch_id)

    query = (
        file_feed(spark, folder, glob, max_files, recursive).writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
