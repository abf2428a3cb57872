"""Versioned table state and the ledger that makes job steps repeatable.

Every step writes a new version folder and then one ledger row. A version without a ledger row is
ignored, so a step that died half-way is simply run again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.changes import change_feed
from tidemark.operators.dml import truncate
from tidemark.sources.files import put_text, read_text
from tidemark.streaming.buckets import BucketedTable

LEDGER = (
    T.StructType()
    .add("entity", T.StringType()).add("file", T.StringType()).add("status", T.StringType())
    .add("batch_id", T.LongType()).add("version", T.LongType())
    .add("row_count", T.LongType()).add("reject_count", T.LongType())
    .add("stamp", T.TimestampNTZType()).add("loaded_at", T.TimestampNTZType())
    .add("attempt", T.StringType())
)
APPLIED, LATE, EMPTY, UNKNOWN = "applied", "late", "empty", "unknown"
# Commits from which a new checkpoint is written.
CHECKPOINT_EVERY = 32


@dataclass(frozen=True)
class Totals:
    """What an entity's commits add up to."""

    version: int = 0
    rows: int = 0
    position: int = 0
    stamp: datetime | None = None

    def plus(self, entry: dict) -> Totals:
        applied = entry["status"] == APPLIED
        stamps = [s for s in (self.stamp, entry["stamp"] if applied else None) if s is not None]
        return Totals(max(self.version, entry["version"]), self.rows + entry["row_count"],
                      max(self.position, entry["batch_id"]) if applied else self.position, max(stamps, default=None))


@dataclass(frozen=True)
class State:
    """The ledger as of commit `number`: totals by entity, and the commits since the last checkpoint."""

    number: int = 0
    entities: dict[str, Totals] = field(default_factory=dict)
    tail: tuple[dict, ...] = ()
    checkpoint: str | None = None

    def of(self, entity: str) -> Totals:
        return self.entities.get(entity, Totals())

    def plus(self, entry: dict) -> State:
        entities = {**self.entities, entry["entity"]: self.of(entry["entity"]).plus(entry)}
        return replace(self, number=self.number + 1, entities=entities, tail=(*self.tail, entry))


def _moment(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)


def _decoded(entry: dict) -> dict:
    return {**entry, "stamp": _moment(entry["stamp"]), "loaded_at": _moment(entry["loaded_at"])}


class Ledger:
    """Load history of numbered commits: one per applied file or consumed version.

    A commit is a small file named by its number and made only if that name is free, so of two writers
    that saw the same state one is told and looks again. Every CHECKPOINT_EVERY commits the totals and
    all rows so far are written as a checkpoint; a reader takes the last one and the few commits
    behind it, however long the history is.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def latest(self) -> State:
        """The state now. The note of the last checkpoint may be old; commits behind it are looked up by number."""
        found = read_text(self.spark, f"{self.path}/last.json")
        state = State()
        if found:
            note = json.loads(found)
            totals = {k: Totals(**{**v, "stamp": _moment(v["stamp"])}) for k, v in note["entities"].items()}
            state = State(note["number"], totals, (), note["checkpoint"])
        while (text := read_text(self.spark, self._commit(state.number + 1))) is not None:
            state = state.plus(_decoded(json.loads(text)))
        return state

    def _commit(self, number: int) -> str:
        return f"{self.path}/{number:020d}.json"

    def put(self, state: State, entry: dict) -> bool:
        """Record `entry` as the commit after `state`; False if another writer has made that commit."""
        if not put_text(self.spark, self._commit(state.number + 1), json.dumps(entry, default=lambda t: t.isoformat())):
            return False
        after = state.plus(entry)
        if len(after.tail) >= CHECKPOINT_EVERY:
            self._write_checkpoint(after)
        return True

    def _write_checkpoint(self, state: State) -> None:
        folder = f"{self.path}/checkpoint/{state.number:020d}-{uuid.uuid4().hex}"
        self._rows(state).coalesce(1).write.parquet(folder)
        note = {"number": state.number, "checkpoint": folder, "entities": {k: vars(t) for k, t in state.entities.items()}}
        put_text(self.spark, f"{self.path}/last.json", json.dumps(note, default=lambda t: t.isoformat()), replace=True)

    def _rows(self, state: State) -> DataFrame:
        tail = self.spark.createDataFrame([tuple(e[n] for n in LEDGER.names) for e in state.tail], LEDGER)
        return tail if state.checkpoint is None else self.spark.read.schema(LEDGER).parquet(state.checkpoint).unionByName(tail)

    def rows(self, state: State | None = None) -> DataFrame:
        return self._rows(state or self.latest())

    @staticmethod
    def entry(entity: str, file: str | None, batch_id: int, version: int, row_count: int, reject_count: int,
              stamp: datetime | None, now: datetime | str, status: str = APPLIED, attempt: str | None = None) -> dict:
        loaded = datetime.fromisoformat(now) if isinstance(now, str) else now
        return dict(zip(LEDGER.names, (entity, file, status, batch_id, version, row_count, reject_count, stamp, loaded, attempt)))

    def add(self, entity: str, file: str | None, batch_id: int, version: int, row_count: int, reject_count: int,
            stamp: datetime | None, now: datetime | str, status: str = APPLIED) -> None:
        """Record a row whatever other writers record."""
        entry = self.entry(entity, file, batch_id, version, row_count, reject_count, stamp, now, status)
        while not self.put(self.latest(), entry):
            pass

    def version(self, entity: str) -> int:
        """Last applied version, 0 before the first."""
        return self.latest().of(entity).version

    def stamp(self, entity: str) -> datetime | None:
        """Time stamp of the newest applied file."""
        return self.latest().of(entity).stamp

    def seen(self, entity: str, file: str) -> bool:
        """Whether the file was dealt with; one that only waits for its entity was not."""
        state = self.latest()
        if any(e["entity"] == entity and e["file"] == file and e["status"] != UNKNOWN for e in state.tail):
            return True
        if state.checkpoint is None:
            return False
        mine = (F.col("entity") == entity) & (F.col("file") == file) & (F.col("status") != UNKNOWN)
        return not self.rows(state).filter(mine).isEmpty()

    def waiting(self, entities: Sequence[str]) -> list[tuple[str, str]]:
        """(entity, file) of deliveries that came before their entity was known, in name order."""
        state = self.latest()
        if state.checkpoint is None and all(e["status"] != UNKNOWN for e in state.tail):
            return []
        mine = self.rows(state).filter(F.col("entity").isin(list(entities)))
        known = mine.filter(F.col("status") != UNKNOWN).select("entity", "file")
        open_ = mine.filter(F.col("status") == UNKNOWN).select("entity", "file").distinct()
        return [tuple(r) for r in open_.join(known, ["entity", "file"], "left_anti").orderBy("file").toLocalIterator()]


class VersionedTable:
    """Snapshots of a table below `path/v=<n>`."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema

    def read(self, version: int) -> DataFrame:
        if version == 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v={version}")

    def write(self, df: DataFrame, version: int) -> None:
        """A leftover of a failed try of the same version is replaced."""
        df.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/v={version}")

    def pair(self, before: int, after: int) -> tuple[DataFrame, DataFrame]:
        """Both versions, for a comparison."""
        return self.read(before), self.read(after)


class FeedState:
    """Change feed of a versioned table with a position.

    `pending` may be read any number of times; only `consume` moves the position. Of a table in
    buckets only those that differ between the two versions are read.
    """

    def __init__(self, spark: SparkSession, table: VersionedTable | BucketedTable, ledger: Ledger, key: str, name: str = "feed"):
        self.spark, self.table, self.ledger, self.key, self.name = spark, table, ledger, key, name

    def position(self) -> int:
        return self.ledger.version(self.name)

    def pending(self, latest: int) -> DataFrame:
        """Net changes between the position and version `latest`."""
        return self.between(self.position(), latest)

    def between(self, position: int, latest: int) -> DataFrame:
        """Net changes between two versions."""
        prev, curr = self.table.pair(position, latest)
        if position == latest:
            return truncate(change_feed(prev, prev, self.key, check=False))
        return change_feed(prev, curr, self.key)

    def consume(self, latest: int, now: datetime | str, row_count: int = 0) -> None:
        self.ledger.add(self.name, None, latest, latest, row_count, 0, None, now)
