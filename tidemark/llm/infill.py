"""Fill-in-the-middle: texts cut at two token boundaries, which a compressed set of boundaries selects by rank."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lean, sized_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = "<[PSM]>"
RATE, SPM_RATE = 50, 80
SEED = 42
# A container covers 2^16 offsets; an array of more than 4,096 is larger than a bitmap.
SPAN_BITS = 16
ARRAY_MAX = 4096
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Container:
    """Offsets below 2^16 in the smallest of three forms: `array`, `bitmap` or `run`."""

    kind: str
    data: np.ndarray
    before: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @classmethod
    def of(cls, low: np.ndarray) -> Container:
        first = np.flatnonzero(np.r_[True, np.diff(low) != 1])
        length = np.diff(np.r_[first, len(low)])
        if 4 * len(first) < min(2 * len(low), 8192):
            return cls("run", low[first].astype(np.uint16), np.r_[0, np.cumsum(length)])
        if len(low) <= ARRAY_MAX:
            return cls("array", low.astype(np.uint16))
        bits = np.zeros(1 << SPAN_BITS, np.uint8)
        bits[low] = 1
        words = np.packbits(bits, bitorder="little").view("<u8")
        return cls("bitmap", words, np.r_[0, np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    def select(self, k: int) -> int:
        """The k-th smallest offset, counted from 0."""
        if self.kind == "array":
            return int(self.data[k])
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        left = k - int(self.before[at])
        if self.kind == "run":
            return int(self.data[at]) + left
        word = int(self.data[at])
        for _ in range(left):
            word &= word - 1
        return 64 * at + (word & -word).bit_length() - 1


class BoundarySet:
    """A set of offsets cut into spans of 2^16; a search in the cumulative counts finds the span of a rank."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> SPAN_BITS
        edges = np.flatnonzero(np.r_[True, high[1:] != high[:-1]]) if len(offsets) else np.zeros(0, np.int64)
        self.upto = np.r_[edges, len(offsets)][1:]
        self.high = high[edges]
        low = offsets & ((1 << SPAN_BITS) - 1)
        self.containers = [Container.of(low[a:b]) for a, b in zip(edges, self.upto)]

    def __len__(self) -> int:
        return int(self.upto[-1]) if len(self.upto) else 0

    def select(self, k: int) -> int:
        """The k-th smallest offset, counted from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.upto, k, side="right"))
        before = int(self.upto[at - 1]) if at else 0
        return (int(self.high[at]) << SPAN_BITS) + self.containers[at].select(k - before)


def token_ends(data: np.ndarray) -> np.ndarray:
    """Byte offsets at which tokens of a UTF-8 text may be cut: 0 and the end of every token.

    A token is a run of non-white characters with the white space before it; white space at the end
    is one of its own. White space is ASCII, so that bytes and code points agree on it.
    """
    white = _WHITE[data]
    ends = np.flatnonzero(white[1:] & ~white[:-1]) + 1
    return np.concatenate(([0], ends, [len(data)])) if len(data) else np.zeros(1, np.int64)


def characters(data: np.ndarray) -> int:
    """Code points of UTF-8 bytes: all bytes but continuations."""
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def draws(key: int | str | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers of a key; a null key counts as the empty text."""
    found = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(found[i:i + 4], "big") for i in (0, 4, 8, 12))


def transform(data: bytes, key: int | str | None, rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED):
    """(number of tokens, form, output, characters of prefix, of middle) of one UTF-8 text; see `infill`."""
    view = np.frombuffer(data, np.uint8)
    ends = token_ends(view)
    n = len(ends) - 1
    h1, h2, h3, h4 = draws(key, seed)
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    if not data or h3 % 100 >= rate or any(mark in data for mark in (p, s, m)):
        return n, "plain", data, None, None
    bounds = BoundarySet(ends)
    a, b = (bounds.select(k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    counts = characters(view[:a]), characters(view[a:b])
    if h4 % 100 < spm_rate:
        return n, "spm", s + suffix + p + prefix + m + middle, *counts
    return n, "psm", p + prefix + s + suffix + m + middle, *counts


def infill(docs: DataFrame, key: str = "doc_id", text: str = "text", rate: int = RATE, spm_rate: int = SPM_RATE,
           seed: int = SEED) -> DataFrame:
    """One row per document: (key, n, form, prefix_chars, middle_chars, output).

    A text of `n` tokens is cut at two token boundaries drawn from a hash of seed and key. `form` is
    `psm` (marked prefix, suffix, middle), `spm` (suffix first) or `plain`; `rate` of 100 texts are
    transformed, of these `spm_rate` of 100 into spm. Texts that hold a mark stay plain, so that
    `restored` is exact. Null texts count as empty; empty texts stay plain with no tokens. A null key
    counts as the empty text; repeated rows are cut alike, and equal keys with other texts share
    their draws. Columns other than key and text are not read, so their names cannot clash. Rows stay
    where they are: no shuffle, memory follows slices of bytes.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    rows = rows.select("key", F.col("key").cast("string").alias("name"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches, "text"):
            found = [transform(t.as_buffer().to_pybytes(), k, rate, spm_rate, seed)
                     for k, t in zip(batch.column("name").to_pylist(), batch.column("text"))]
            n, form, output, prefix, middle = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                 pa.array(output, pa.binary()).cast(pa.string())],
                ["key", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(lean(run), f"key {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text that `infill` made `output` of."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    part = F.split(output, MARKS, -1)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1]))
            .otherwise(output))
