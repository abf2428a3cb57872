"""Helpers shared by the operators: inputs, folds, batches, written intermediates."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ordered import assign_ids
from tidemark.session import cut_lineage

FOLDS = 5

__all__ = ["FOLDS", "cut_lineage", "fold", "free_name", "fresh", "lean", "load", "lower_words", "sized_batches", "told_apart"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id's text modulo 5; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % FOLDS


def free_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, with underscores put before it until no column of `df` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def fresh(df: DataFrame, key: str, text: str) -> DataFrame:
    """Key and text alone, under names of our own, so that extra columns cannot clash."""
    return df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))


def told_apart(df: DataFrame, key: str) -> tuple[DataFrame, str]:
    """`df` and the name of a column that numbers its rows apart, in key order; null where the key is.

    That is the key itself unless a key is repeated, for which the keys alone are counted. Else the
    rows are written and get dense numbers, in key order and among equal keys in the order written.
    """
    keys = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"))
    if keys.filter("n > 1").isEmpty():
        return df, key
    at, number = free_name(df, "row_place"), free_name(df, "row_number")
    fixed = cut_lineage(df.withColumn(at, F.monotonically_increasing_id()), "rows")
    numbers = assign_ids(fixed.filter(F.col(key).isNotNull()).select(F.col(at), F.col(key).alias("k")), 1, ["k", at], number)
    return cut_lineage(fixed.join(numbers.select(at, number), at, "left").drop(at), "numbered"), number


def lower_words(text: str | None) -> list[bytes]:
    """UTF-8 words between ASCII white space, with A-Z lower-cased; none for null."""
    return text.encode().lower().split() if text else []


def sized_batches(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of at most `max_bytes` of `column` (one row at least), so that memory follows bytes and not rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // max_bytes
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], batch.num_rows]):
            yield batch.slice(a, b - a)


Batches = Iterator[pa.RecordBatch]


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """`run` for a worker that stays small: buffers come from malloc, and what a task has freed goes back at its end.

    Workers are used again by later stages, so memory that a task leaves in a pool adds up.
    """

    def task(batches: Batches) -> Batches:
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from run(batches)
        finally:
            gc.collect()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):
                pass  # another C library; nothing to hand back

    return task
