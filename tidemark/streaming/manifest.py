"""Stored listings of a folder, and what changed from one to the next."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import cut_lineage
from tidemark.sources.files import list_files
from tidemark.streaming.state import Ledger, State

LISTING = (
    T.StructType().add("relative_path", T.StringType()).add("size", T.LongType())
    .add("last_modified", T.TimestampNTZType()).add("md5", T.StringType())
)
NEW, CHANGED, REMOVED = "new", "changed", "removed"


def diff_listings(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files that differ: relative_path, change, and size, last_modified, md5 and old_size, old_last_modified, old_md5.

    A file changed if its size did, or its checksum where both listings have one, or else its time:
    a file that was only touched is the same. Paths are unique in a listing, so that both sides
    meet in one shuffle and no key is hot.
    """
    old = before.select("relative_path", *[F.col(c).alias(f"old_{c}") for c in LISTING.names[1:]], F.lit(True).alias("_old"))
    both = after.select(*LISTING.names, F.lit(True).alias("_new")).join(old, "relative_path", "full_outer")
    same_text = F.when(F.col("md5").isNotNull() & F.col("old_md5").isNotNull(), F.col("md5") == F.col("old_md5")).otherwise(
        F.col("last_modified").eqNullSafe(F.col("old_last_modified")))
    change = (F.when(F.col("_old").isNull(), NEW).when(F.col("_new").isNull(), REMOVED)
              .when(~F.col("size").eqNullSafe(F.col("old_size")) | ~same_text, CHANGED))
    found = both.withColumn("change", change).filter("change IS NOT NULL")
    return found.select("relative_path", "change", *LISTING.names[1:], *[f"old_{c}" for c in LISTING.names[1:]])


class Manifest:
    """Listings of `folder` kept below `path`, one for each refresh that found a change.

    A refresh lists the folder, compares it with the last listing and commits both listing and
    changes; a refresh that dies before its commit leaves nothing behind that is read, and of two at a
    time one starts anew. With `checksum` contents are read for their md5, which tells replaced files of
    equal size and time, and touched ones, apart. Spark's listings leave empty files out,
    so a file that has become empty counts as removed. Listings stay in tables; only counts reach the driver.
    """

    def __init__(self, spark: SparkSession, path: str, folder: str, glob: str = "[!._]*", checksum: bool = False):
        self.spark, self.path, self.folder, self.glob, self.checksum = spark, path.rstrip("/"), folder, glob, checksum
        self.ledger = Ledger(spark, f"{self.path}/_ledger")

    def scan(self) -> DataFrame:
        """The folder as it is now."""
        listed = list_files(self.spark, self.folder, self.glob, self.checksum, recursive=True)
        return (listed if self.checksum else listed.withColumn("md5", F.lit(None).cast("string"))).select(*LISTING.names)

    def version(self) -> int:
        return self.ledger.latest().of("listing").version

    def _read(self, kind: str, first: int, last: int, schema: T.StructType, state: State | None = None) -> DataFrame:
        """Committed rows of a kind from version `first` to `last`."""
        made = self.ledger.rows(state).filter(F.col("version").between(first, last)).select("version", "attempt")
        if last < 1 or first > last:
            return self.spark.createDataFrame([], T.StructType([*schema, T.StructField("version", T.LongType())]))
        own = T.StructType([*schema, T.StructField("version", T.LongType()), T.StructField("attempt", T.StringType())])
        return self.spark.read.schema(own).parquet(f"{self.path}/{kind}").join(made, ["version", "attempt"], "left_semi").select(*schema.names, "version")

    def listing(self, version: int | None = None, state: State | None = None) -> DataFrame:
        """The listing of a version, the last one unless given; empty before the first."""
        version = self.version() if version is None else version
        return self._read("listing", version, version, LISTING, state).drop("version")

    def changes(self, since: int = 0) -> DataFrame:
        """All changes behind version `since`, with the version that found them."""
        schema = diff_listings(*[self.spark.createDataFrame([], LISTING)] * 2).schema
        return self._read("changes", since + 1, self.version(), schema)

    def refresh(self, now: datetime | str) -> int:
        """Commit the folder as it is, if it has changed; returns the number of files that did."""
        while True:
            state = self.ledger.latest()
            last = state.of("listing").version
            listed = cut_lineage(self.scan(), "listing")
            changed = cut_lineage(diff_listings(self.listing(last, state), listed), "changes")
            count = changed.count()
            if not count:
                return 0
            attempt = f"t{uuid.uuid4().hex}"
            for kind, rows in (("listing", listed), ("changes", changed)):
                rows.write.parquet(f"{self.path}/{kind}/version={last + 1}/attempt={attempt}")
            entry = Ledger.entry("listing", None, last + 1, last + 1, count, 0, None, now, attempt=attempt)
            if self.ledger.put(state, entry):
                return count
