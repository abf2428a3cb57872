"""Records of delimited files whose quoted fields may hold line breaks, read by many tasks a file."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import cut_lineage
from tidemark.sources.files import decoded

QUOTE = '"'
# Where records start is sent to the tasks for about so many splits at a time.
SENT_SPLITS = 100_000


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, block, odd, value): lines in file order within each split of a file; `odd` tells whether quotes are."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit(QUOTE)))
    return spark.read.option("lineSep", "\n").text(path).select(
        decoded(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.file_block_start").alias("block"),
        (quotes % 2 == 1).alias("odd"), "value")


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Batches cut where file or split changes, with (file, block)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks = batch.column("file").dictionary_encode().indices.to_numpy(), batch.column("block").to_numpy()
        edges = np.flatnonzero(np.r_[True, (files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])])
        for a, b in zip(edges, [*edges[1:], batch.num_rows]):
            yield (batch.column("file")[a].as_py(), int(blocks[a])), batch.slice(a, b - a)


def split_parities(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, block, odd, inside) of every split: its quote parity, and both candidates for its first record.

    A split that begins between records has its first record at line 0, one that begins inside quotes
    at line `inside`: the one behind the first line with an odd number of quotes, null if there is none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, odd, first, seen = None, False, None, 0
        for split, batch in _by_split(batches):
            if split != now:
                yield from done(now, odd, first, seen)
                now, odd, first, seen = split, False, None, 0
            flags = batch.column("odd").to_numpy(zero_copy_only=False)
            hits = np.flatnonzero(flags)
            if first is None and len(hits):
                first = seen + int(hits[0]) + 1
            odd ^= bool(len(hits) % 2)
            seen += len(flags)
        yield from done(now, odd, first, seen)

    def done(split, odd, first, seen) -> Iterator[pa.RecordBatch]:
        if split is not None:
            inside = first if first is not None and first < seen else None
            yield pa.RecordBatch.from_arrays([pa.array([split[0]]), pa.array([split[1]]), pa.array([odd]), pa.array([inside], pa.int64())],
                                             ["file", "block", "odd", "inside"])

    return _lines(spark, path).select("file", "block", "odd").mapInArrow(run, "file string, block long, odd boolean, inside long")


def split_starts(parities: DataFrame) -> DataFrame:
    """(file, block, first, owner): line of the split's first record, and the split whose last record reaches into it.

    A prefix sum over a file's splits tells which of the two candidates holds.
    """
    by = Window.partitionBy("file").orderBy("block")
    ahead = by.rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum(F.col("odd").cast("long")).over(ahead), F.lit(0)) % 2 == 1
    placed = parities.withColumn("first", F.when(within, F.col("inside")).otherwise(F.lit(0)))
    owner = F.last(F.when(F.col("first").isNotNull(), F.col("block")), ignorenulls=True).over(ahead)
    return placed.select("file", "block", "first", owner.alias("owner"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records of splits, and the pieces of those that lie across splits: one from each split.

    Columns: file, value, head (whether it is the file's first record), owner (null for whole records), part.
    """
    now, line, first, owner, inside, lead, held, out = None, 0, None, None, False, [], [], []

    def leave() -> None:
        """What is open when a split ends: lines of an earlier record, or the start of one that goes on."""
        if lead:
            out.append((now[0], "\n".join(lead), False, owner, now[1]))
        if held:
            own = now[1] if inside else None
            out.append((now[0], "\n".join(held), now[1] == 0 and line == len(held), own, own))
        lead.clear()
        held.clear()

    for split, batch in _by_split(batches):
        if split != now:
            leave()
            now, line, inside = split, 0, False
            first, owner = (batch.column(n)[0].as_py() for n in ("first", "owner"))
        flags = batch.column("odd").to_numpy(zero_copy_only=False)
        begun = first is not None and line >= first
        if begun and not inside and not flags.any() and now[1] + line:
            # The common case: every line is a record.
            none = pa.nulls(len(flags), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("value"), pa.array(np.zeros(len(flags), bool)), none, none], _COLUMNS)
            line += len(flags)
            continue
        for value, odd in zip(batch.column("value").to_pylist(), flags.tolist()):
            if first is None or line < first:
                lead.append(value)
                line += 1
                continue
            held.append(value)
            inside ^= odd
            line += 1
            if not inside:
                out.append((now[0], "\n".join(held), now[1] == 0 and line == len(held), None, None))
                held.clear()
        if out:
            yield _batch(out)
            out.clear()
    leave()
    if out:
        yield _batch(out)


_COLUMNS = ["file", "value", "head", "owner", "part"]
_KINDS = [pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], _COLUMNS)


def read_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, value, head): every record as written, line breaks within quotes included; `head` is a file's first.

    Files are split at any byte and read twice: once to count quotes, once for the records. Quotes
    inside quotes are doubled, so the parity of all quotes ahead tells whether a line starts a record.
    A record across splits is put together from its pieces, which alone are shuffled. A quote that is
    never closed takes the rest of its file into one record.
    """
    starts = cut_lineage(split_starts(split_parities(spark, path)), "record-starts")
    slices = -(-2 * starts.count() // SENT_SPLITS) or 1
    found = None
    for i in range(slices):
        lines, own = _lines(spark, path), starts
        if slices > 1:
            lines, own = (x.filter(F.pmod(F.xxhash64("file"), F.lit(slices)) == i) for x in (lines, own))
        # At most about SENT_SPLITS rows are sent at a time.
        rows = lines.join(F.broadcast(own), ["file", "block"]).mapInArrow(_joined, "file string, value string, head boolean, owner long, part long")
        found = rows if found is None else found.unionByName(rows)
    crossing = starts.groupBy("file").agg(F.count("*").alias("n")).filter("n > 1")
    if crossing.isEmpty():
        return found.select("file", "value", "head")
    found = cut_lineage(found, "records")

    def assembled(table: pa.Table) -> pa.Table:
        rows = table.sort_by("part")
        return pa.table({"file": rows.column("file")[:1], "value": ["\n".join(rows.column("value").to_pylist())], "head": rows.column("head")[:1]})

    pieces = found.filter("owner IS NOT NULL").groupBy("file", "owner").applyInArrow(assembled, "file string, value string, head boolean")
    return found.filter("owner IS NULL").select("file", "value", "head").unionByName(pieces)
