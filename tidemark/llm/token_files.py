"""Token ids in files of word-aligned blocks: several ids in each 64-bit word, as many as their size allows."""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.bpe import Pieces, read_spec, worker_tokenizer
from tidemark.llm.common import fresh, lean, sized_batches

# Ids and bits an id of each selector; 60 bits of a word hold ids, the top 4 the selector.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 15
CACHE_PIECES = 500_000
LEARNED = 20
BLOCK = 1024
MAGIC = b"TW8B"
_HEADER = struct.Struct("<4sIIIQQ")
_COUNT = np.ones(16, np.int64)
_COUNT[:14] = COUNTS


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of each block, escaped values) of unsigned integers.

    Every block of BLOCK ids starts a word of its own. A word takes as many ids as fit at one width;
    an id of more than 60 bits is written apart and the word holds its number there.
    """
    values = np.asarray(values, np.uint64)
    n_blocks = -(-len(values) // BLOCK)
    padded = np.zeros((n_blocks, BLOCK + COUNTS[0]), np.uint64)
    block = np.zeros(n_blocks * BLOCK, np.uint64)
    block[:len(values)] = values
    padded[:, :BLOCK] = block.reshape(n_blocks, BLOCK)
    # Beyond 53 bits rounding may give one bit too many, which is only a wider word.
    bits = np.frexp(padded.astype(np.float64))[1].astype(np.uint8)
    # The widest id among the next 1, 2, 3, ... ids, and from it the selector with the most ids that fit.
    widest, choice = {1: bits}, np.full(bits.shape, ESCAPE, np.uint8)
    for count, width in zip(reversed(COUNTS), reversed(WIDTHS)):
        if count not in widest:
            half = max(c for c in widest if c < count and 2 * c >= count)
            a, shift = widest[half], count - half
            widest[count] = a.copy()
            np.maximum(a[:, :-shift], a[:, shift:], out=widest[count][:, :-shift])
        choice[widest[count] <= width] = COUNTS.index(count)
    sizes = np.full(n_blocks, BLOCK)
    if n_blocks:
        sizes[-1] = len(values) - (n_blocks - 1) * BLOCK
    row = choice.shape[1]
    choice, taken = choice.ravel(), _COUNT[choice.ravel()].astype(np.uint8)
    live, found = np.arange(n_blocks), []
    at = live * row
    stop = at + sizes
    while len(live):
        found.append((live, at, choice[at]))
        at = at + taken[at]
        more = at < stop
        if not more.all():
            live, at, stop = live[more], at[more], stop[more]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint64)
    step = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
    owner, place, chosen = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((step, owner))
    owner, place, chosen = owner[order], place[order], chosen[order]
    place = place - owner * row
    words, flat = chosen.astype(np.uint64) << np.uint64(60), padded.ravel()
    for number, (count, width) in enumerate(zip(COUNTS, WIDTHS)):
        rows = np.flatnonzero(chosen == number)
        spot = owner[rows] * padded.shape[1] + place[rows]
        packed = words[rows]
        for j in range(count):
            packed |= flat[spot + j] << np.uint64(j * width)
        words[rows] = packed
    rows = np.flatnonzero(chosen == ESCAPE)
    words[rows] |= np.arange(len(rows), dtype=np.uint64)
    escaped = padded[owner[rows], place[rows]]
    return words, np.searchsorted(owner, np.arange(n_blocks)).astype(np.uint32), escaped


def unpack(words: np.ndarray, firsts: np.ndarray, escaped: np.ndarray, n: int) -> np.ndarray:
    """All `n` values; every selector's words are decoded at once."""
    out = np.zeros(len(firsts) * BLOCK + COUNTS[0], np.uint64)
    selector = (words >> np.uint64(60)).astype(np.uint8)
    count = _COUNT[selector]
    before = np.cumsum(count) - count
    block = np.zeros(len(words), np.int64)
    block[firsts[1:]] = 1
    block = np.cumsum(block)
    place = before - before[firsts.astype(np.int64)][block] if len(words) else before
    start, stop = block * BLOCK + place, (block + 1) * BLOCK
    for number, (ids, width) in enumerate(zip(COUNTS, WIDTHS)):
        rows = np.flatnonzero(selector == number)
        low = np.uint64((1 << width) - 1)
        for j in range(ids):
            spot = start[rows] + j
            inside = spot < stop[rows]
            out[spot[inside]] = (words[rows[inside]] >> np.uint64(j * width)) & low
    rows = selector == ESCAPE
    out[start[rows]] = escaped[(words[rows] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out[:n]


def write_segment(keys: list[int | None], lengths: np.ndarray, ids: np.ndarray, before: int) -> bytes:
    """One segment: header, document table (keys, lengths), block offsets, escapes, words; little-endian."""
    words, firsts, escaped = pack(ids)
    null = np.array([k is None for k in keys], np.uint8)
    table = np.array([0 if k is None else k for k in keys], "<i8")
    return b"".join((
        _HEADER.pack(MAGIC, len(keys), len(firsts), len(escaped), len(ids), before),
        null.tobytes(), table.tobytes(), lengths.astype("<u4").tobytes(), firsts.astype("<u4").tobytes(),
        escaped.astype("<u8").tobytes(), words.astype("<u8").tobytes()))


def read_segment(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray, int]:
    """(keys, lengths, ids, ids of the part before this segment)."""
    magic, n_docs, n_blocks, n_escaped, n_ids, before = _HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a segment of token words")
    at, parts = _HEADER.size, []
    for kind, n in (("u1", n_docs), ("<i8", n_docs), ("<u4", n_docs), ("<u4", n_blocks), ("<u8", n_escaped)):
        parts.append(np.frombuffer(data, kind, n, at))
        at += parts[-1].nbytes
    null, table, lengths, firsts, escaped = parts
    words = np.frombuffer(data, "<u8", offset=at)
    keys = [None if gone else k for gone, k in zip(null.tolist(), table.tolist())]
    return keys, lengths.astype(np.int64), unpack(words, firsts, escaped, n_ids), before


# Classes of characters as the byte-level tokenizer's pattern has them; 0: not asked for yet.
_LETTER, _DIGIT, _OTHER, _WHITE = 1, 2, 3, 4
_SUFFIXES = ("s", "t", "m", "d", "re", "ve", "ll")


class ByteWords(Pieces):
    """Ids of the words that a byte-level tokenizer cuts texts into, as UTF-8.

    New words go to the tokenizer's own model, their bytes already written as its alphabet, so that
    it need not search for words again. The lengths of the tokens tell whose they are.
    """

    def __init__(self, tokenizer, spec: dict, limit: int):
        from tokenizers import Tokenizer

        super().__init__(tokenizer, "\n", limit)
        bare = {**spec, "added_tokens": [], "post_processor": None, "decoder": None, "truncation": None, "padding": None,
                "pre_tokenizer": {"type": "CharDelimiterSplit", "delimiter": "\n"}}
        self.bare = Tokenizer.from_str(json.dumps(bare))
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.alphabet = np.arange(256, dtype="<u2")
        self.alphabet[[b for b in range(256) if b not in shown]] = np.arange(256, 512 - len(shown))
        self.alphabet[255] = ord("\n")  # In no UTF-8.
        vocab = self.bare.get_vocab()
        self.n_bytes = np.zeros(max(vocab.values(), default=0) + 1, np.int64)
        self.n_bytes[list(vocab.values())] = [len(t) for t in vocab]

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        text = self.alphabet[np.frombuffer(b"\xff".join(words), np.uint8)].tobytes().decode("utf-16-le")
        cuts = [0, *(ends + np.arange(1, len(words) + 1))[LEARNED - 1:-1:LEARNED].tolist(), len(text) + 1]
        coded = self.bare.encode_batch_fast([text[a:b - 1] for a, b in zip(cuts, cuts[1:])], add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(c.ids for c in coded), np.int32)
        reached = np.cumsum(self.n_bytes[ids])
        last = np.searchsorted(reached, ends)
        if not len(ids) or reached[-1] != ends[-1] or (reached[last] != ends).any():
            # A byte the model does not know.
            coded = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
            sizes = np.fromiter((len(c.ids) for c in coded), np.int64, len(coded))
            return np.fromiter(chain.from_iterable(c.ids for c in coded), np.int32), sizes
        return ids, np.diff(last, prepend=-1)


class PieceEncoder:
    """Byte-level ids of whole texts; words met again are not encoded again.

    Texts that hold an added token, and all texts of a tokenizer that cuts words otherwise, are
    encoded whole.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        spec = json.loads(tokenizer.to_str())
        cutter, model = spec["pre_tokenizer"] or {}, spec["model"]
        known = (spec["normalizer"] is None and cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True)
                 and not cutter["add_prefix_space"] and model["type"] == "BPE" and not model["dropout"]
                 and not model["continuing_subword_prefix"] and not model["end_of_word_suffix"])
        self.words = ByteWords(tokenizer, spec, CACHE_PIECES) if known else None
        self.classes = np.zeros(0x110000, np.uint8)  # By code point.

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, number of ids of each)."""
        whole = [i for i, t in enumerate(texts) if t and (self.words is None or any(s in t for s in self.special))]
        rest = [t or "" for t in texts]
        for i in whole:
            rest[i] = ""
        words, counts = self._cut(rest)
        if len(words):
            found = words.dictionary_encode()
            numbers = self.words.look_up(found.dictionary.to_numpy(zero_copy_only=False).tolist())
            ids, sizes = self.words.gather(numbers[found.indices.to_numpy()])
            self.words.trim()
        else:
            ids, sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)
        ends = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(counts)]]
        lengths = np.diff(ends)
        if whole:
            coded = self.tokenizer.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False)
            parts = np.split(ids, ends[1:-1])
            for i, c in zip(whole, coded):
                parts[i] = np.array(c.ids, np.int32)
                lengths[i] = len(parts[i])
            ids = np.concatenate(parts)
        return ids, lengths

    def _cut(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """(words of all texts, number of words of each), cut where the tokenizer's own pattern cuts.

        That is 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+ from left to right:
        runs of a class, with one space before; of longer white space the last character is apart.
        """
        joined = "".join(texts)
        if not joined:
            return pa.array([], pa.binary()), np.zeros(len(texts), np.int64)
        borders = np.r_[0, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))]
        chars = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        kind = self._kinds(chars)
        edge = np.zeros(len(chars) + 1, bool)
        edge[borders] = True
        change = edge[:-1].copy()
        change[1:] |= kind[1:] != kind[:-1]
        white = kind == _WHITE
        # The last white character before another one, and the characters that take a space in.
        before = white[:-1] & ~white[1:] & ~edge[1:-1]
        start = change
        start[:-1] |= before
        start[1:] &= ~(before & (chars[:-1] == ord(" ")))
        self._contract(chars, start, edge)
        at = np.flatnonzero(start)
        data = joined.encode()
        offsets = np.r_[at, len(chars)]
        if len(data) > len(chars):
            width = np.ones(len(chars), np.uint8)
            for least in (0x80, 0x800, 0x10000):
                width += chars >= least
            offsets = np.r_[0, np.cumsum(width, dtype=np.int32)][offsets]
        words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])
        return words, np.diff(np.searchsorted(at, borders))

    def _contract(self, chars: np.ndarray, start: np.ndarray, edge: np.ndarray) -> None:
        """Keep an apostrophe that starts a word with the letters of a suffix, and cut behind these."""
        marks = np.flatnonzero(start & (chars == ord("'")))
        for suffix in _SUFFIXES:
            found = marks[marks + len(suffix) < len(chars)]
            for j, letter in enumerate(suffix, 1):
                found = found[(chars[found + j] == ord(letter)) & ~edge[found + j]]
            start[found + 1] = False
            behind = found + len(suffix) + 1
            start[behind[behind < len(chars)]] = True

    def _kinds(self, chars: np.ndarray) -> np.ndarray:
        """Each character's class; the tokenizer itself is asked once for each character, by what it joins."""
        kind = self.classes[chars]
        if not kind.all():
            cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
            for char in np.unique(chars[kind == 0]).tolist():
                joins = (k for k, other in ((_LETTER, "a"), (_DIGIT, "1"), (_OTHER, ".")) if len(cut(other + chr(char))) == 1)
                self.classes[char] = next(joins, _WHITE)
            kind = self.classes[chars]
        return kind


_ENCODERS: dict[str, PieceEncoder] = {}


def _encoder(spec: str) -> PieceEncoder:
    if spec not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[spec] = PieceEncoder(worker_tokenizer(spec))
    return _ENCODERS[spec]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, key: str = "doc_id", text: str = "text") -> None:
    """Write all texts' ids with `end_id` after each, in ascending key order, as segments under `path`.

    Rows are dealt by ranges of the key and sorted, so part after part and segment after segment
    ascend; a row of the written table is a segment with its part and number. Null keys come first,
    equal keys stay together in the order of their texts' hashes, null texts count as empty.
    """
    spec = read_spec(tokenizer)
    rows = fresh(docs, key, text).withColumn("key", F.col("key").cast("long"))
    rows = rows.repartitionByRange("key").sortWithinPartitions("key", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before, number = _encoder(spec), TaskContext.get().partitionId(), 0, 0
        for batch in sized_batches(batches, "text"):
            ids, lengths = encoder.encode_batch(batch.column("text").to_pylist())
            ids = np.insert(ids, np.cumsum(lengths), end_id)
            data = write_segment(batch.column("key").to_pylist(), lengths + 1, ids, before)
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()),
                                              "n_ids": pa.array([len(ids)], pa.int64()), "data": pa.array([data], pa.binary())})
            before, number = before + len(ids), number + 1

    rows.mapInArrow(run, "part int, number int, n_ids long, data binary").write.option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(key, start, n_tokens, ids_crc32, ids) of every document of written segments.

    `start` counts the ids of all documents before it; only one number for each part is sent to the
    tasks. `ids_crc32` is taken over the ids as little-endian unsigned 32-bit integers.
    """
    segments = spark.read.parquet(path)
    ahead = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    # One row for each part of the written table.
    placed = segments.select("part", "data").join(F.broadcast(parts), "part").select("ahead", "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ahead, data in zip(batch.column("ahead").to_pylist(), batch.column("data")):
                keys, lengths, ids, before = read_segment(data.as_buffer().to_pybytes())
                ids = ids.astype("<u4")
                ends = np.cumsum(lengths)
                view, starts = memoryview(ids).cast("B"), (ends - lengths).tolist()
                sums = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(starts, ends.tolist())]
                columns = [pa.array(keys, pa.int64()), pa.array(ends - lengths + before + ahead, pa.int64()),
                           pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())]
                names = ["key", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return placed.mapInArrow(lean(run), "key long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)
