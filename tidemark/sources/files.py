"""File listings and binary scans."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import relative_path


def file_columns() -> list[Column]:
    """Path and name of the file a row came from, as listings have them."""
    return [decoded(F.col("_metadata.file_path")).alias("_file_path"), decoded(F.col("_metadata.file_name")).alias("_file_name")]


def literal_path(path: str) -> str:
    """A listed path for a reader, which takes some characters for patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def decoded(path: Column) -> Column:
    """A path of a scan as listings show it: scans percent-encode what a URI may not hold, listings do not."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def read_binary(spark: SparkSession, folder: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """path, modificationTime, length, content; content is read only when selected."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower()).load(folder)
    )


def list_files(spark: SparkSession, folder: str, glob: str = "*", checksum: bool = False,
               recursive: bool = False) -> DataFrame:
    """One row per file: relative_path, path, size, last_modified and, on request, md5."""
    scan = read_binary(spark, folder, glob, recursive)
    columns = [
        relative_path(folder, F.col("path")).alias("relative_path"), "path",
        F.col("length").alias("size"), F.col("modificationTime").cast("timestamp_ntz").alias("last_modified"),
    ]
    if checksum:
        columns.append(F.md5("content").alias("md5"))
    return scan.select(*columns)


def ordered_files(spark: SparkSession, folder: str, glob: str = "*", recursive: bool = False) -> list[str]:
    """Paths in path order: the driver's work list of one run."""
    listed = list_files(spark, folder, glob, recursive=recursive).select("path").orderBy("path")
    return [r["path"] for r in listed.toLocalIterator()]


def delete_files(spark: SparkSession, paths: Sequence[str]) -> None:
    """Remove files through Hadoop's file system API."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, False)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder or file with all below it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder whose size is bounded, such as the buckets of one version."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return sorted(f.getPath().getName() for f in target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target))


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _is(error: Py4JJavaError, name: str) -> bool:
    return name in error.java_exception.getClass().getName()


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of one small file, None if it is not there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    except Py4JJavaError as error:
        if _is(error, "FileNotFound"):
            return None
        raise
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str, replace: bool = False) -> bool:
    """Create one small file in a single step; False if it is there already and not to be replaced.

    The text is written apart and renamed, so no reader sees half of it. Whether two writers can
    both succeed is up to the file system: its rename without overwrite must be atomic, as HDFS's is.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target, apart = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.{uuid.uuid4().hex}.tmp"))
    system = target.getFileSystem(conf)
    stream = system.create(apart, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    how = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark._sc._gateway.new_array(how, 1)
    options[0] = how.OVERWRITE if replace else how.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.makeQualified(target).toUri(), conf).rename(apart, target, options)
        return True
    except Py4JJavaError as error:
        if not _is(error, "FileAlreadyExists"):
            raise
        system.delete(apart, False)
        return False
