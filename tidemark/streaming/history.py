"""Files to history: each new snapshot file updates the current table and its type 2 history."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.compare import to_schema
from tidemark.functions.text import ENTITY_MARK
from tidemark.operators.changes import apply_feed
from tidemark.operators.dml import unmatched
from tidemark.operators.ordered import assign_ids
from tidemark.operators.scd import open_rows, scd1_changes, scd1_feed, scd2_apply, scd2_classify, split_stale
from tidemark.session import cut_lineage
from tidemark.sources.delimited import COMMA, DelimitedFormat, read_checked
from tidemark.sources.files import path_exists
from tidemark.streaming.appends import AppendLog
from tidemark.streaming.buckets import BUCKET, BucketedTable, key_bucket
from tidemark.streaming.files import on_new_file
from tidemark.streaming.state import EMPTY, LATE, UNKNOWN, Ledger

_STAMP = re.compile(r"_(20\d{6})_(\d{6})")


@dataclass(frozen=True)
class Entity:
    """A table fed by files named `<name>_<yyyymmdd>_<hhmiss>.<ext>`.

    on_error: "abort" fails a delivery with a line that cannot be read, and its batch is replayed;
    "skip" applies the other lines and keeps the bad ones as rejects.
    buckets: hash buckets of the key that its tables are kept in, see `BucketedTable`.
    """

    name: str
    schema: T.StructType
    key: str
    match_col: str = "last_updated"
    close: str = "now"
    valid_from: str = "now"
    fmt: DelimitedFormat = COMMA
    on_error: str = "abort"
    buckets: int = 8

    def content(self) -> list[str]:
        return [n for n in self.schema.names if n not in (self.key, self.match_col)]

    def history_schema(self) -> T.StructType:
        fields = [f for f in self.schema if f.name != self.match_col]
        extra = (
            T.StructType().add("valid_from", T.TimestampNTZType()).add("valid_to", T.TimestampNTZType())
            .add("current_flag", T.StringType()).add("decision", T.StringType())
        )
        return T.StructType([*fields, *extra])


class HistoryStore:
    """Tables of one entity: current rows, open history, closed history, rejects.

    Current and open rows are kept in buckets of the key, of which a delivery writes those that hold a
    changed key; closed rows are only appended, by version and bucket. So a delivery reads its
    snapshot and the current rows to compare them, and all else it reads or writes are the buckets
    of changed keys.
    """

    def __init__(self, spark: SparkSession, root: str, entity: Entity):
        base = f"{root}/{entity.name}"
        self.spark, self.entity = spark, entity
        bucketed = lambda name, schema: BucketedTable(spark, f"{base}/{name}", schema, [entity.key], entity.buckets)
        self.current_table = bucketed("current", entity.schema)
        self.open_table = bucketed("open", entity.history_schema())
        self.closed_path, self.reject_path = f"{base}/closed", f"{base}/rejects"

    def closed(self, upto: int, only: Sequence[int] | None = None) -> DataFrame:
        """Closed rows of applied versions, or of the buckets `only` of them."""
        schema = self.entity.history_schema()
        if upto == 0 or not path_exists(self.spark, self.closed_path):
            return self.spark.createDataFrame([], schema)
        own = [T.StructField("v", T.LongType()), T.StructField(BUCKET, T.IntegerType())]
        stored = self.spark.read.schema(T.StructType([*schema, *own])).parquet(self.closed_path).filter(F.col("v") <= upto)
        if only is not None:
            stored = stored.filter(F.col(BUCKET).isin(list(only)))
        return stored.select(*schema.names)

    def append_closed(self, rows: DataFrame, version: int) -> None:
        """A leftover of a failed try of the same version is replaced."""
        bucket = key_bucket([self.entity.key], self.entity.history_schema(), self.entity.buckets)
        (rows.withColumn(BUCKET, bucket).repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(BUCKET).parquet(f"{self.closed_path}/v={version}"))

    def history(self, version: int) -> DataFrame:
        return self.open_table.read(version).unionByName(self.closed(version))

    def sweep(self, ledger: Ledger, readers: Sequence[str] = ()) -> list[str]:
        """Remove versions that neither the ledger's last one nor the feed `readers` of it still need.

        A reader is the name of a `FeedState` in the same ledger; its position is read first, so one
        that moves on meanwhile only keeps more than it needs.
        """
        state = ledger.latest()
        keep = {state.of(name).version for name in (self.entity.name, *readers)}
        return self.current_table.sweep(keep) + self.open_table.sweep({state.of(self.entity.name).version})


def apply_delivery(spark: SparkSession, root: str, entity: Entity, name: str, paths: Sequence[str], batch_id: int,
                   now: datetime | str, ledger: Ledger) -> bool:
    """Apply one snapshot and record it; False when it was seen before, is older than the last
    applied one, or has no usable row.

    A line that cannot be read is still a delivery of its key, so that key is not missing; a line
    whose key cannot be read may be any key, so nothing is deleted by its delivery.
    """
    found = _STAMP.search(name)
    stamp = datetime.strptime("".join(found.groups()), "%Y%m%d%H%M%S") if found else None
    if ledger.seen(entity.name, name):
        return False
    version, last = ledger.version(entity.name), ledger.stamp(entity.name)
    if stamp and last and stamp < last:
        ledger.add(entity.name, name, batch_id, version, 0, 0, stamp, now, LATE)
        return False
    store = HistoryStore(spark, root, entity)

    checked = cut_lineage(read_checked(spark, list(paths), entity.schema, entity.fmt), "stage")
    usable = (F.size("_rejected") == 0) & F.col(entity.key).isNotNull()
    staged = checked.filter(usable).select(*entity.schema.names)
    unknown_key = F.col(entity.key).isNull() | F.array_contains("_rejected", "line")
    counts = checked.agg(F.count(F.when(usable, 1)).alias("good"), F.count(F.when(~usable, 1)).alias("bad"),
                         F.count(F.when(unknown_key, 1)).alias("keyless")).first()
    if counts["bad"] and entity.on_error != "skip":
        raise ValueError(f"delivery {name} has {counts['bad']} lines that cannot be read")
    if counts["good"] == 0:
        ledger.add(entity.name, name, batch_id, version, 0, counts["bad"], stamp, now, EMPTY)
        return False

    next_version = version + 1
    prev = store.current_table.read(version)
    unreadable = checked.filter(~usable & ~unknown_key).select(entity.key) if counts["bad"] else None
    feed = cut_lineage(scd1_feed(
        scd1_changes(prev, staged, entity.key, entity.match_col, unreadable, deletes=not counts["keyless"])), "feed")
    touched = store.current_table.touched(feed)
    store.current_table.write(apply_feed(store.current_table.read(version, touched), feed, entity.key), next_version, version, touched)
    _extend_history(store, feed, version, touched, now)
    rejected = checked.filter(~usable)
    rejected.write.mode("overwrite").parquet(f"{store.reject_path}/lines/v={next_version}")
    ledger.add(entity.name, name, batch_id, next_version, counts["good"], counts["bad"], stamp, now)
    return True


def _extend_history(store: HistoryStore, feed: DataFrame, version: int, touched: Sequence[int], now: datetime | str) -> None:
    """Open and closed rows of the version after `version`, from a written feed whose keys lie in the buckets `touched`."""
    entity, next_version = store.entity, version + 1
    if not touched:
        store.open_table.write(feed, next_version, version, touched)
        return
    opened = store.open_table.read(version, touched)
    if entity.valid_from == "source" or entity.close == "successor":
        feed, stale = split_stale(feed, opened, entity.key, entity.match_col)
        stale.write.mode("overwrite").parquet(f"{store.reject_path}/stale/v={next_version}")
    classified = cut_lineage(
        scd2_classify(feed, opened, entity.key, entity.close, now, entity.match_col), "classified")
    on = [entity.key, *entity.content()]
    if entity.valid_from == "source":
        # An opening row that is closed history already is matched, hence not inserted again.
        opens = F.col("dml_type") == "I"
        fresh = unmatched(classified.filter(opens), store.closed(version, touched), [*on, "valid_from"], null_safe=True)
        classified = fresh.unionByName(classified.filter(~opens))
    merged = cut_lineage(scd2_apply(opened, classified, on, entity.valid_from, now, null_safe=True), "history")
    store.open_table.write(open_rows(merged), next_version, version, touched)
    store.append_closed(merged.filter(F.col("current_flag") == "N"), next_version)


def _deliveries(folder: str, paths: Sequence[str]) -> dict[str, list[str]]:
    """Files by delivery, in name order: a file below `folder`, or a folder of part files."""
    base = _plain(folder).rstrip("/") + "/"
    found: dict[str, list[str]] = {}
    for path in paths:
        found.setdefault(_plain(path).removeprefix(base).split("/", 1)[0], []).append(path)
    return dict(sorted(found.items()))


def _plain(path: str) -> str:
    return re.sub(r"^file:/+", "/", path)


def run_pipeline(spark: SparkSession, folder: str, registry: Sequence[Entity], root: str, now: datetime | str,
                 glob: str = "[!._]*", max_files: int | None = None) -> Ledger:
    """Apply every new delivery below `folder`, in name order, to the entity its name starts with.

    A delivery is one file, or a folder of part files closed by `_SUCCESS`, so that a snapshot of
    any size is read by many tasks. A file stream finds new files; its checkpoint and the ledger
    below `root` make reruns harmless. A delivery of an unknown entity is recorded and applied by the
    first run that knows it. An unfinished folder or a failing delivery fails the batch, which the
    next run replays.
    """
    by_name = {e.name: e for e in registry}
    ledger = Ledger(spark, f"{root}/ledger")

    def load(paths: list[str], batch_id: int) -> None:
        for name, parts in _deliveries(folder, paths).items():
            label = name.split(ENTITY_MARK)[0]
            entity = by_name.get(label)
            if entity is None:
                if (label, name) not in ledger.waiting([label]):
                    ledger.add(label, name, batch_id, 0, 0, 0, None, now, UNKNOWN)
                continue
            if not parts[0].endswith(name):
                if not path_exists(spark, f"{folder}/{name}/_SUCCESS"):
                    raise RuntimeError(f"delivery {name} is not complete")
                # The whole folder, whatever share of it this batch listed.
                parts = [f"{folder}/{name}"]
            apply_delivery(spark, root, entity, name, parts, batch_id, now, ledger)

    for label, name in ledger.waiting(list(by_name)):
        apply_delivery(spark, root, by_name[label], name, [f"{folder}/{name}"], -1, now, ledger)
    on_new_file(spark, folder, load, f"{root}/checkpoint", glob, max_files, recursive=True)
    return ledger


def append_typed(feed: DataFrame, schema: T.StructType, start: int, order_by: Sequence[str], id_col: str,
                 path: str | None = None, now: datetime | str | None = None) -> DataFrame:
    """Text rows of a feed as typed rows with a surrogate key from `start`.

    With a `path` they are appended there as a load of an `AppendLog`: ids go on where the last load
    ended, and a load that died half-way is written anew.
    """
    typed = to_schema(feed, schema)
    if path is None:
        return assign_ids(typed, start, list(order_by), id_col)
    log = AppendLog(feed.sparkSession, path)
    log.append(lambda first: assign_ids(typed, first, list(order_by), id_col), now or datetime.now(), start)
    return log.read()
