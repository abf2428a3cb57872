"""Declared keys checked load by load against a stored index, without reading earlier loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.compare import equal_on
from tidemark.operators.changes import present
from tidemark.session import cut_lineage
from tidemark.streaming.buckets import BucketedTable

# Rows of a key so far, rows the last load with this key brought, and the version that load made.
COUNT, LAST, AT = "_count", "_last", "_at"


class KeyIndex:
    """The keys of a table and how many rows have each, below `path` in buckets of the key.

    `schema` names the key columns. A load is counted by key, with counts combined before the shuffle,
    and merged into the buckets its keys lie in: others are neither read nor written, and no row of
    an earlier load is. Every version stays readable, so what a load violated can be told later, and a
    step that died is run again. NULLs are kept: a primary key must not have them, a unique or foreign
    key with one is exempt. An empty load makes a version that refers to the one before. Choose
    `buckets` as for any bucketed table; a load of many scattered keys touches them all.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, buckets: int = 8):
        self.keys = schema.names
        stored = T.StructType([*schema])
        for name in (COUNT, LAST, AT):
            stored = stored.add(name, T.LongType())
        self.table = BucketedTable(spark, path, stored, self.keys, buckets)

    def _counted(self, rows: DataFrame) -> DataFrame:
        keys = [F.col(k).cast(self.table.schema[k].dataType).alias(k) for k in self.keys]
        return cut_lineage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(COUNT)), "load-keys")

    def step(self, load: DataFrame, version: int) -> list[int]:
        """Version `version + 1`: the index with the keys of `load`; returns the buckets written."""
        came, after = self._counted(load), version + 1
        touched = self.table.touched(came)
        fresh = came.select(*self.keys, COUNT, F.col(COUNT).alias(LAST), F.lit(after).cast("long").alias(AT))
        both = self.table.read(version, touched).unionByName(fresh)
        # A key has at most its old row and a fresh one; longs alone, so it stays a hash aggregation.
        newest = F.coalesce(F.max(F.when(F.col(AT) == after, F.col(LAST))), F.max(LAST)).alias(LAST)
        merged = both.groupBy(*self.keys).agg(F.sum(COUNT).alias(COUNT), newest, F.max(AT).alias(AT))
        self.table.write(merged, after, version, touched)
        return touched

    def violations(self, version: int, primary: bool = True) -> DataFrame:
        """Keys of the load that made `version` which it has broken: the key, rows `before` it and rows `added` by it.

        A key in more than one row, and for a primary key one with a NULL. Only buckets which that load wrote are read.
        """
        written = [b for b, v in self.table.manifest(version).items() if v == version]
        rows = self.table.read(version, written).filter(F.col(AT) == version)
        known = present(self.keys)
        bad = (F.col(COUNT) > 1) | ~known if primary else (F.col(COUNT) > 1) & known
        return rows.filter(bad).select(*self.keys, (F.col(COUNT) - F.col(LAST)).alias("before"), F.col(LAST).alias("added"))

    def missing(self, load: DataFrame, version: int) -> DataFrame:
        """Keys of `load` without NULLs that the index lacks at `version`, with the number of rows: a foreign key's violations.

        `load` has the columns of the index by name. Only buckets that its keys lie in are read.
        """
        came = self._counted(load.filter(present(self.keys)))
        held = self.table.read(version, self.table.touched(came))
        lacking = came.alias("l").join(held.alias("h"), equal_on("l", "h", self.keys), "left_anti")
        return lacking.select(*self.keys, F.col(COUNT).alias("added"))
