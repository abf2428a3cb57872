"""WARC archives: records written as text, and read back by verified chains of record boundaries."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import cut_lineage, lean

# Fixed values of the format.
END = "\r\n"
MAGIC = "WARC/"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SEPARATOR = END + MAGIC
_VERSION = r"^(WARC/)?\d\.\d+\r\n"
_LENGTH = r"(?i)\r\nContent-Length:[ \t]*(\d+)[ \t]*(?:\r\n|$)"
_AFTER = len(MAGIC)

# Where each split's chain starts is sent to the tasks for so many splits at a time.
SENT_SPLITS = 100_000
MAX_ROUNDS = 60
NULL_KEY, KEY = "urn:null", "urn:key:"


def base32_sha1(text: Column) -> Column:
    """SHA-1 of a text's UTF-8 in upper-case base32: every five hexadecimal digits are four of base 32."""
    hexed = F.sha1(text)
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(key: Column) -> Column:
    return F.coalesce(F.concat(F.lit(KEY), F.url_encode(key.cast("string"))), F.lit(NULL_KEY))


def key_of(record_id: str | Column) -> Column:
    """The key, as text, that `write_warc` made a record's id of."""
    column = F.col(record_id) if isinstance(record_id, str) else record_id
    return F.when(F.startswith(column, F.lit(KEY)), F.url_decode(F.substr(column, F.lit(len(KEY) + 1))))


def write_warc(pages: DataFrame, path: str, date: str, key: str = "page_id", url: str = "url", payload: str = "html",
               min_bytes: int = 0) -> None:
    """Write one WARC/1.1 record per row below `path`, as files of whole records.

    Of rows with equal payloads (SHA-1 and length) of at least `min_bytes` bytes, those with the
    smallest key are `response` records; the others are `revisit` records that name it and carry
    the payload's digest and length but not the payload. Shorter payloads are all responses. A null payload
    counts as empty, a null url leaves its field out, line ends in a url are percent-encoded. Null
    keys are larger than all others: such a row is a response only if all rows of its payload have no
    key. Rows that repeat the smallest key of a payload are all responses. Columns other than these
    three are not read, so their names cannot clash. `date` is the records' WARC-Date.

    Digests combine before the shuffle; only groups of more than one row are joined back, without
    a shuffle of payloads where these groups are few, else by a join that adaptive execution may split where one payload is hot. Files are written by Spark's text
    writer, so a lost task leaves no half file.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"))
    rows = rows.select("*", base32_sha1(F.col("payload")).alias("digest"), F.octet_length("payload").cast("long").alias("bytes"))
    groups = rows.filter(F.col("bytes") >= min_bytes).groupBy("digest", "bytes").agg(F.count("*").alias("n"), F.min("key").alias("first"))
    # Written first, so that its true size decides whether payloads must move to meet it.
    groups = cut_lineage(groups.filter((F.col("n") > 1) & F.col("first").isNotNull()).drop("n"), "copies")
    joined = rows.join(groups, ["digest", "bytes"], "left")
    again = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    block = F.concat(F.lit(END.join(("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "))),
                     F.col("bytes").cast("string"), F.lit(2 * END), F.when(again, "").otherwise(F.col("payload")))
    joined = joined.select("key", "url", "digest", "first", again.alias("again"), block.alias("block"))
    uri = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    fields = F.concat_ws(
        END, F.lit(MAGIC + "1.1"), F.concat(F.lit("WARC-Type: "), F.when(F.col("again"), "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <"), _record_id(F.col("key")), F.lit(">")), F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), uri), F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
        F.when(F.col("again"), F.concat(F.lit(f"WARC-Profile: {PROFILE}{END}WARC-Refers-To: <"), _record_id(F.col("first")), F.lit(">"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string")))
    # The writer ends every row with the second of the two line ends behind a record.
    joined.select(F.concat(fields, F.lit(2 * END), "block", F.lit(END)).alias("value")).write.option("lineSep", END).text(path)


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): what lies between magics, in file order within each split of a file.

    Magics count only at the start of a line, as header fields cannot hold them there. Spark cuts
    files into splits at bytes; a chunk belongs to the split in which the magic before it begins.
    """
    return spark.read.option("lineSep", SEPARATOR).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def follow(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(last record, where it ends) of the chain from every candidate, by pointer jumping; `starts` ascend."""
    at = np.searchsorted(starts, stops)
    hit = (at < len(starts)) & (starts[np.minimum(at, len(starts) - 1)] == stops)
    jump = np.where(hit, at, np.arange(len(starts)))
    while (jump[jump] != jump).any():
        jump = jump[jump]
    return starts[jump], stops[jump]


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Batches cut where file or split changes, with (file, block)."""
    for batch in batches:
        files, blocks = batch.column("file").dictionary_encode().indices.to_numpy(), batch.column("block").to_numpy()
        edges = np.flatnonzero(np.r_[True, (files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])]) if batch.num_rows else []
        for a, b in zip(edges, [*edges[1:], batch.num_rows]):
            yield (batch.column("file")[a].as_py(), int(blocks[a])), batch.slice(a, b - a)


def split_chains(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, total, starts, lasts, stops) of every split of the files below `path`.

    A candidate is a magic with a version, a whole header and a length behind it; its successor is
    where the record would end. Within the split all chains are followed at once, so that of each
    candidate only the last record of its chain there and the place behind that leave the task.
    Places are counted behind the magic, from the split's first chunk; `total` is the split's bytes.
    """
    head = F.substring_index("value", 2 * END, 1)
    size = F.octet_length("value").cast("long")
    length = F.regexp_extract(head, _LENGTH, 1)
    whole = (F.octet_length(head) < size) & head.rlike(_VERSION) & (length != "")
    rows = _chunks(spark, path).select(
        "file", "block", size.alias("size"), F.startswith("value", F.lit(MAGIC)).alias("named"),
        F.when(whole, F.octet_length(head) + len(2 * END) + length.cast("long")).alias("bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total, parts = None, 0, []
        for split, batch in _by_split(batches):
            if split != now:
                yield from done(now, total, parts)
                now, total, parts = split, 0, []
            size = batch.column("size").to_numpy() + len(SEPARATOR)
            length = batch.column("bytes").fill_null(-1).to_numpy().copy()
            named = batch.column("named").to_numpy(zero_copy_only=False)
            start = total + np.cumsum(size) - size
            # The file's first chunk has its magic in it, all others have it before them.
            lead = np.zeros(len(size), bool)
            lead[0] = total == 0 and split[1] == 0
            start[lead] += _AFTER
            length[lead] -= _AFTER
            ok = (length >= 0) & (named == lead)
            parts.append((start[ok], (start + length + len(2 * END) + _AFTER)[ok]))
            total += int(size.sum())
        yield from done(now, total, parts)

    def done(split, total, parts) -> Iterator[pa.RecordBatch]:
        if split is None:
            return
        starts, stops = (np.concatenate(x) for x in zip(*parts))
        lasts, ends = follow(starts, stops) if len(starts) else (starts, stops)
        yield pa.RecordBatch.from_pydict({
            "file": [split[0]], "block": [split[1]], "total": [total],
            **{n: pa.array([v], pa.list_(pa.int64())) for n, v in (("starts", starts), ("lasts", lasts), ("stops", ends))}})

    return rows.mapInArrow(lean(run), "file string, block long, total long, starts array<long>, lasts array<long>, stops array<long>")


def split_entries(splits: DataFrame) -> DataFrame:
    """(file, block, base, entry, owner) of every split of `split_chains`.

    `entry` is the place of the first true record that starts in the split, from the split's first
    chunk, null if none does; `owner` is the place in the file of the record that lies across its
    start. Chains of splits are followed from every file's start by pointer jumping: what is reached
    grows by the jumps' targets while jumps double, so rounds are the logarithm of the splits of a
    file. Only candidates at which another chain ends take part. Raises if a file's chain does not
    end where the file ends.
    """
    by = Window.partitionBy("file").orderBy("block")
    ahead = F.coalesce(F.sum("total").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = splits.withColumn("base", ahead)
    chains = placed.select("file", "block", "base", F.explode(F.arrays_zip("starts", "lasts", "stops")).alias("c")).select(
        "file", "block", "base", *[(F.col(f"c.{n}") + F.col("base")).alias(m) for n, m in (("starts", "at"), ("lasts", "last"), ("stops", "to"))])
    first = splits.select("file", F.lit(_AFTER).cast("long").alias("at")).distinct()
    met = placed.select("file", F.explode(F.array_distinct("stops")).alias("stop"), "base").select("file", (F.col("stop") + F.col("base")).alias("at"))
    edges = cut_lineage(chains.join(met.unionByName(first).distinct(), ["file", "at"], "left_semi"), "chains")

    jumps, reached = edges.select("file", "at", "to"), edges.select("file", "at").join(first, ["file", "at"], "left_semi")
    count = reached.count()
    for _ in range(MAX_ROUNDS):
        onward = reached.join(jumps, ["file", "at"]).select("file", F.col("to").alias("at"))
        wider = reached.unionByName(onward.join(edges.select("file", "at"), ["file", "at"], "left_semi")).distinct()
        wider = cut_lineage(wider, "reached")
        now = wider.count()
        if now == count:
            break
        reached, count = wider, now
        far = jumps.select("file", F.col("at").alias("from"), F.col("to").alias("at")).join(jumps, ["file", "at"])
        jumps = cut_lineage(far.select("file", F.col("from").alias("at"), "to"), "jumps")
    else:
        raise RuntimeError("chains of records did not settle")

    true = edges.join(reached, ["file", "at"], "left_semi").select("file", "block", "at", "last", "to")
    every = placed.select("file", "block", "base", "total").join(true, ["file", "block"], "left")
    ends = every.groupBy("file").agg(F.sum("total").alias("bytes"), F.max("to").alias("end"))
    broken = ends.filter(~F.col("end").eqNullSafe(F.col("bytes") - len(SEPARATOR) + _AFTER)).orderBy("file").first()
    if broken:
        raise ValueError(f"records of {broken['file']} end at byte {(broken['end'] or _AFTER) - _AFTER} of {broken['bytes'] - len(SEPARATOR)}")
    owner = F.last("last", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1))
    return every.select("file", "block", "base", (F.col("at") - F.col("base")).alias("entry"), owner.alias("owner"))


class Record:
    """Header and payload of one record's bytes, from behind the magic on."""

    def __init__(self, data: bytes):
        head, _, rest = data.partition(b"\r\n\r\n")
        self.fields = {}
        for line in head.decode("utf-8", "replace").split(END)[1:]:
            name, _, value = line.partition(":")
            self.fields[name.strip().lower()] = value.strip()
        self.length = int(self.fields["content-length"])
        self.size = len(head) + 4 + self.length
        self.payload, self.http = rest[:self.length], {}
        if self.fields.get("content-type", "").startswith("application/http"):
            head, _, self.payload = self.payload.partition(b"\r\n\r\n")
            self.http = dict(re.findall(r"(?m)^([^:\r\n]+):[ \t]*([^\r\n]*)", head.decode("latin-1").lower()))

    def row(self) -> tuple:
        """(id, type, uri, refers_to, payload_bytes, payload_digest, payload); a revisit's digest and length are the ones it states."""
        name, kind = self.fields.get("warc-record-id", "").strip("<>"), self.fields.get("warc-type")
        stated = self.fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        refers, uri = self.fields.get("warc-refers-to"), self.fields.get("warc-target-uri")
        if kind == "revisit":
            return name, kind, uri, refers and refers.strip("<>"), int(self.http.get("content-length", 0)), stated, None
        digest = base64.b32encode(hashlib.sha1(self.payload).digest()).decode()
        if stated and stated != digest:
            raise ValueError(f"payload of {name} is damaged: digest {digest}, stated {stated}")
        return name, kind, uri, refers and refers.strip("<>"), len(self.payload), digest, self.payload


_ROW = "record_id string, record_type string, target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary"
_NAMES = [x.split()[0] for x in _ROW.split(", ")]
_TYPES = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
_BATCH = 4 << 20


def _true_records(with_payload: bool):
    """Whole records of splits, and the pieces of those that lie across splits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at, due, owner, base, held, size, out = None, 0, None, None, 0, [], 0, []

        def flush() -> None:
            nonlocal held
            if not held:
                return
            start, data = held[0], b"".join(held[1:])
            record, held = Record(data), []
            if len(data) < record.size:
                out.append((split_file, base + start, base + start, data, *[None] * len(_NAMES)))
            else:
                row = record.row()
                out.append((None, None, None, None, *row[:-1], row[-1] if with_payload else None))

        split_file = None
        for split, batch in _by_split(batches):
            if split != now:
                flush()
                now, at, split_file = split, 0, split[0]
                due, owner, base = (batch.column(n)[0].as_py() for n in ("entry", "owner", "base"))
            for value in batch.column("value"):
                data = value.as_buffer().to_pybytes()
                lead = at == 0 and split[1] == 0
                place, chunk = (_AFTER, data[_AFTER:]) if lead else (at, data)
                if place == due:
                    flush()
                    held = [place, chunk]
                    head = chunk.index(b"\r\n\r\n") + 4
                    due = place + head + Record(chunk[:head]).length + 4 + _AFTER
                elif held:
                    held += [SEPARATOR.encode(), chunk]
                else:
                    out.append((split_file, owner, base + place, SEPARATOR.encode() + chunk, *[None] * len(_NAMES)))
                at += len(data) + len(SEPARATOR)
                size += len(data)
                if size > _BATCH and out:
                    yield batch_of(out)
                    out, size = [], 0
        flush()
        if out:
            yield batch_of(out)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), *_TYPES]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["file", "owner", "place", "piece", *_NAMES])

    return run


def _assembled(with_payload: bool):
    """The record of all its pieces."""

    def run(table: pa.Table) -> pa.Table:
        pieces = table.sort_by("place").column("piece")
        row = Record(b"".join(p.as_py() for p in pieces)).row()
        return pa.table([pa.array([v], t) for v, t in zip((*row[:-1], row[-1] if with_payload else None), _TYPES)], names=_NAMES)

    return run


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """(record_id, record_type, target_uri, refers_to, payload_bytes, payload_digest, payload) of every record below `path`.

    Boundary-chain verification: every magic that starts a line is a candidate with a successor, and
    a candidate is a record only if it is reached from the file's start. What looks like a record
    inside a payload is thus part of that payload. Files are read by splits, in two passes: one for
    offsets alone, one for the records; a record that lies across splits is put together from its
    pieces. Digests of payloads are verified. Payloads of revisits are null (see `with_payloads`).
    An empty file has no records; a folder without files raises as Spark's reader does. Version 1.0 and
    1.1 are read alike, also gzipped, where one file is one split.
    """
    entries = cut_lineage(split_entries(cut_lineage(split_chains(spark, path), "splits")), "entries")
    # Slices of whole files, of at most about SENT_SPLITS splits each, are sent to the tasks in turn.
    slices = -(-2 * entries.count() // SENT_SPLITS) or 1
    found = None
    for i in range(slices):
        chunks, own = _chunks(spark, path), entries
        if slices > 1:
            chunks, own = (x.filter(F.pmod(F.xxhash64("file"), F.lit(slices)) == i) for x in (chunks, own))
        rows = chunks.select("file", "block", F.col("value").cast("binary").alias("value")).join(F.broadcast(own), ["file", "block"])
        rows = rows.mapInArrow(lean(_true_records(with_payload)), f"file string, owner long, place long, piece binary, {_ROW}")
        found = rows if found is None else found.unionByName(rows)
    found = cut_lineage(found, "records")
    pieces = found.filter("piece IS NOT NULL").select("file", "owner", "place", "piece")
    whole = found.filter("piece IS NULL").select(*_NAMES)
    return whole.unionByName(pieces.groupBy("file", "owner").applyInArrow(_assembled(with_payload), _ROW))


def with_payloads(records: DataFrame) -> DataFrame:
    """Records of `read_warc` with revisits carrying the payload of the response they refer to (null if it is not there)."""
    responses = records.filter("record_type <> 'revisit'").groupBy(F.col("record_id").alias("refers_to"), "payload_digest").agg(
        F.first("payload").alias("found"))
    again = records.filter("record_type = 'revisit'").join(responses, ["refers_to", "payload_digest"], "left")
    again = again.withColumn("payload", F.col("found")).select(*_NAMES)
    return records.filter("record_type IS NULL OR record_type <> 'revisit'").select(*_NAMES).unionByName(again)
