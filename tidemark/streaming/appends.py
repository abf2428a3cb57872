"""Appended loads with one ledger row each: the rows, the ids and the source position become visible together."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import plain_path
from tidemark.operators.dml import run_counted
from tidemark.session import cut_lineage
from tidemark.sources.delimited import COMMA, DelimitedFormat, read_checked
from tidemark.sources.files import list_files, literal_path, path_exists
from tidemark.streaming.state import FeedState, Ledger, State, Totals

FILES = (
    T.StructType().add("file", T.StringType()).add("row_count", T.LongType()).add("reject_count", T.LongType())
    .add("size", T.LongType()).add("last_modified", T.TimestampNTZType())
)
MAX_TRIES = 20


@dataclass(frozen=True)
class Load:
    """Rows to append, with the source position they end at and the files they came from."""

    rows: DataFrame
    position: int | None = None
    files: DataFrame | None = None


class AppendLog:
    """A table of loads below `path/load=<n>/try=<name>`, with its ledger beside them.

    Any number of jobs may append at once. Each writes its load under a name of its own and then
    commits the load's number; a job that finds the number taken starts anew from what the other has
    committed. A load counts once its commit is there, so what a dead or beaten try has left is never
    read. Ids go on from the rows of all earlier loads: dense, unique and never reused by a rerun.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = "load"):
        self.spark, self.path, self.name = spark, path.rstrip("/"), name
        self.ledger = Ledger(spark, f"{self.path}/_ledger")

    def totals(self) -> Totals:
        return self.ledger.latest().of(self.name)

    def version(self) -> int:
        return self.totals().version

    def position(self) -> int:
        """Source position of the last load, 0 before the first."""
        return self.totals().position

    def next_id(self, start: int = 1) -> int:
        """The sequence's next value: `start` and the rows of all loads so far."""
        return start + self.totals().rows

    def _committed(self, folder: str, schema: T.StructType | None, state: State | None = None) -> DataFrame:
        own = T.StructType().add("load", T.LongType()).add("try", T.StringType())
        reader = self.spark.read if schema is None else self.spark.read.schema(T.StructType([*schema, *own]))
        made = self.ledger.rows(state).filter(F.col("entity") == self.name).select(F.col("version").alias("load"), F.col("attempt").alias("try"))
        stored = reader.parquet(folder).withColumn("load", F.col("load").cast("long"))
        # One row for each load, hence the broadcast; a shuffle would bring all rows of a load to one task.
        return stored.join(F.broadcast(made), ["load", "try"], "left_semi").drop("load", "try")

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """Rows of all loads that count."""
        return self._committed(self.path, schema)

    def files(self, state: State | None = None) -> DataFrame:
        """Load history: one row for every time a file was loaded by `copy_new`, with the file's size and time then."""
        folder = f"{self.path}/_files"
        if not path_exists(self.spark, folder):
            return self.spark.createDataFrame([], FILES)
        return self._committed(folder, FILES, state)

    def load(self, build: Callable[[Totals, State], Load | None], now: datetime | str) -> int:
        """Append what `build` makes of the log's state, as one load; returns the rows written, 0 if there is nothing.

        `build` runs again if another job has appended meanwhile, so ids and positions it takes from
        the state hold when the load counts.
        """
        for _ in range(MAX_TRIES):
            state = self.ledger.latest()
            mine = state.of(self.name)
            made = build(mine, state)
            if made is None:
                return 0
            number, attempt = mine.version + 1, f"t{uuid.uuid4().hex}"
            counted, count = run_counted(made.rows, f"{self.name}-{attempt}")
            counted.write.parquet(f"{self.path}/load={number}/try={attempt}")
            if made.files is not None:
                made.files.select(*FILES.names).write.parquet(f"{self.path}/_files/load={number}/try={attempt}")
            written = count()
            entry = Ledger.entry(self.name, None, number if made.position is None else made.position, number, written, 0, None, now, attempt=attempt)
            while state.of(self.name) == mine:
                if self.ledger.put(state, entry):
                    return written
                # Another entity of the ledger may have taken the commit; only a load of this log asks for new rows.
                state = self.ledger.latest()
        raise RuntimeError(f"other jobs appended to {self.path} {MAX_TRIES} times meanwhile")

    def append(self, rows: Callable[[int], DataFrame], now: datetime | str, start: int = 1, position: int | None = None,
               files: DataFrame | None = None) -> int:
        """Write `rows(next id)` as the next load and record it; returns the rows written."""
        return self.load(lambda mine, _: Load(rows(start + mine.rows), position, files), now)


def consume_into(log: AppendLog, state: FeedState, latest: int, rows: Callable[[DataFrame, int], DataFrame], now: datetime | str,
                 start: int = 1) -> int:
    """Append what a feed holds between the log's position and version `latest`, as one step.

    `rows(feed, next id)` shapes the feed. Position and rows share a commit, so a step that dies
    before it is repeated in full, one that has ended is not repeated, and of two jobs that consume
    the same changes one finds nothing left.
    """

    def build(mine: Totals, _: State) -> Load | None:
        if mine.position >= latest:
            return None
        return Load(rows(state.between(mine.position, latest), start + mine.rows), latest)

    return log.load(build, now)


def copy_new(log: AppendLog, folder: str, schema: T.StructType, now: datetime | str, fmt: DelimitedFormat = COMMA,
             on_error: str = "abort", glob: str = "[!._]*") -> int:
    """Load the files below `folder` that no earlier load has taken; returns the rows loaded.

    A file counts as taken if the history has its path with the same size and time of change: one
    that was replaced under its name is loaded again, as rows of their own. "abort" raises on a bad
    record, "skip" leaves bad records out and counts them per file. Only the names of new files come
    to the driver.
    """
    if on_error not in ("abort", "skip"):
        raise ValueError(f"unknown on_error: {on_error}")

    def build(_: Totals, state: State) -> Load | None:
        listed = list_files(log.spark, folder, glob, recursive=True)
        taken = log.files(state).select(F.col("file").alias("relative_path"), "size", "last_modified").distinct()
        new = cut_lineage(listed.join(taken, ["relative_path", "size", "last_modified"], "left_anti"), "new-files")
        paths = [r["path"] for r in new.orderBy("path").toLocalIterator()]
        if not paths:
            return None
        stage = cut_lineage(read_checked(log.spark, [literal_path(p) for p in paths], schema, fmt), "copy")
        bad = F.size("_rejected") > 0
        report = stage.groupBy("_file_path").agg(F.count(F.when(~bad, 1)).alias("row_count"), F.count(F.when(bad, 1)).alias("reject_count"))
        if on_error == "abort" and not stage.filter(bad).isEmpty():
            raise ValueError(f"bad records below {folder}")
        # Files without any record are taken too.
        history = new.select("relative_path", "size", "last_modified", plain_path(F.col("path")).alias("p")).join(
            report.select(plain_path(F.col("_file_path")).alias("p"), "row_count", "reject_count"), "p", "left").select(
            F.col("relative_path").alias("file"), F.coalesce("row_count", F.lit(0)).alias("row_count"),
            F.coalesce("reject_count", F.lit(0)).alias("reject_count"), "size", "last_modified")
        return Load(stage.filter(~bad).select(*schema.names), files=cut_lineage(history, "files"))

    return log.load(build, now)
