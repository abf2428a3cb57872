"""BPE encoding and decoding that encodes content-defined chunks once and repairs their joins."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import free_name, lean, sized_batches

CHUNK_BITS = 10
CHUNK_MAX = 8192
ROLL = 16
CACHE_BYTES = 16 << 20
CACHE_WORDS = 400_000
REST_WORDS = 50_000
JOINED = 500
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True
# One 32-bit number for each byte value, from a multiplicative rule.
_GEAR = ((np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(29)).astype(np.uint32)


def chunk_ends(texts: list[bytes]) -> list[list[int]]:
    """Ends of the content-defined chunks of every text, the text's own end included.

    A rolling hash over the last ROLL bytes of the text cuts where its top CHUNK_BITS bits are zero,
    so equal passages are cut alike wherever they stand. Bytes inside a character are never cut; a
    stretch without a cut is cut every CHUNK_MAX bytes.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    rolled, width = _GEAR[data], 1
    while width < ROLL:
        # The hash of 2w bytes: that of the last w, and that of the w before, shifted.
        rolled[width:] += rolled[:-width].copy() << np.uint32(width)
        width *= 2
    hits = np.flatnonzero(rolled >> np.uint32(32 - CHUNK_BITS) == 0) + 1
    stops = np.cumsum([len(t) for t in texts])
    found = []
    for text, stop, last in zip(texts, stops.tolist(), np.searchsorted(hits, stops).tolist()):
        start = stop - len(text)
        first = np.searchsorted(hits, start + ROLL)
        ends, at = [], 0
        for end in [*(hits[first:last] - start).tolist(), len(text)]:
            while end - at > CHUNK_MAX:
                at = _between(text, at + CHUNK_MAX)
                ends.append(at)
            end = _between(text, end)
            if end > at:
                ends.append(end)
                at = end
        found.append(ends)
    return found


def _between(text: bytes, at: int) -> int:
    """The first place from `at` on that is not inside a character."""
    while at < len(text) and text[at] & 0xC0 == 0x80:
        at += 1
    return at


class _Numbers(dict):
    """Numbers words in the order in which they are first looked up, and lists those not seen before."""

    def __init__(self, *known):
        super().__init__(*known)
        self.new: list[bytes | str] = []

    def __missing__(self, word):
        self[word] = number = len(self)
        self.new.append(word)
        return number


class Pieces:
    """Ids of words, each encoded once by the tokenizer while it is held.

    New words are encoded many to a text, with `joiner` between them; the tokenizer gives the joiner
    the same single id everywhere and joins nothing over it. Words that hold its mark, and all words
    of a tokenizer for which that does not hold, are encoded one by one. Beyond `limit` words (CACHE_WORDS unless given) those
    unused for longest are let go, in `trim`.
    """

    def __init__(self, tokenizer, joiner: str, limit: int | None = None):
        self.limit = limit
        self.tokenizer, self.joiner, self.mark = tokenizer, joiner, joiner.strip(" ")
        one, both = (tokenizer.encode(t, add_special_tokens=False).ids for t in ("a", f"a{joiner}a"))
        self.between = both[len(one)] if len(both) == 2 * len(one) + 1 and both[:len(one)] == one == both[len(one) + 1:] else None
        self.number = _Numbers()
        self.size, self.start = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.used = np.zeros(0, np.int32)
        self.flat, self.filled, self.clock = np.zeros(1 << 14, np.int32), 0, 0

    def _encode(self, words: list[bytes | str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, number of ids of each word), from the tokenizer."""
        plain = [w.decode() if isinstance(w, bytes) else w for w in words]
        easy = [w for w in plain if self.mark not in w] if self.between is not None else []
        texts = [self.joiner.join(easy[i:i + JOINED]) for i in range(0, len(easy), JOINED)]
        hard = plain if not easy else [w for w in plain if self.mark in w]
        coded = self.tokenizer.encode_batch_fast([*texts, *hard], add_special_tokens=False)
        parts: dict[str, np.ndarray] = {}
        for i, c in enumerate(coded[:len(texts)]):
            ids = np.array(c.ids, np.int32)
            cuts = np.flatnonzero(ids == self.between)
            own = easy[i * JOINED:(i + 1) * JOINED]
            if len(cuts) != len(own) - 1:
                parts.update((w, np.array(x.ids, np.int32)) for w, x in zip(own, self.tokenizer.encode_batch_fast(own, add_special_tokens=False)))
                continue
            parts.update(zip(own, [ids[a:b] for a, b in zip([0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)])]))
        parts.update((w, np.array(c.ids, np.int32)) for w, c in zip(hard, coded[len(texts):]))
        ids = [parts[w] for w in plain]
        return np.concatenate(ids), np.fromiter(map(len, ids), np.int32, len(ids))

    def _learn(self) -> None:
        new, self.number.new = self.number.new, []
        ids, sizes = self._encode(new)
        at, total = len(self.number) - len(new), len(ids)
        if len(self.number) > len(self.size):
            more = max(len(self.number) - len(self.size), len(self.size) // 2, 1 << 12)
            self.size, self.start, self.used = (np.r_[x, np.zeros(more, x.dtype)] for x in (self.size, self.start, self.used))
        if self.filled + total > len(self.flat):
            self.flat = np.r_[self.flat, np.zeros(max(total, len(self.flat) // 2), np.int32)]
        self.size[at:at + len(new)] = sizes
        self.start[at:at + len(new)] = self.filled + np.cumsum(sizes) - sizes
        self.flat[self.filled:self.filled + total] = ids
        self.filled += total

    def look_up(self, words: list[bytes | str]) -> np.ndarray:
        """Number of each word until the next `trim`; new words are encoded."""
        number = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        if self.number.new:
            self._learn()
        self.used[number] = self.clock
        return number

    def gather(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, number of ids of each word) of words looked up."""
        sizes = self.size[number].astype(np.int64)
        shift = self.start[number] - (np.cumsum(sizes) - sizes)
        return self.flat[np.repeat(shift, sizes) + np.arange(sizes.sum())], sizes

    def ids(self, words: list[bytes | str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, number of ids of each word)."""
        return self.gather(self.look_up(words))

    def trim(self, most: int | None = None) -> None:
        """Between batches: keep the more recently used half once there are too many words, or the `most` used last."""
        self.clock += 1
        n, limit = len(self.number), self.limit or CACHE_WORDS
        if n <= (most or limit):
            return
        keep = np.zeros(n, bool)
        keep[np.argsort(-self.used[:n], kind="stable")[:most or limit // 2]] = True
        sizes = self.size[:n][keep].astype(np.int64)
        shift = self.start[:n][keep] - (np.cumsum(sizes) - sizes)
        flat = self.flat[np.repeat(shift, sizes) + np.arange(sizes.sum())]
        # A dict keeps the order of its numbers.
        self.number = _Numbers({w: i for i, w in enumerate(w for w, k in zip(self.number, keep.tolist()) if k)})
        self.size, self.used = self.size[:n][keep], self.used[:n][keep]
        self.start, self.flat, self.filled = np.cumsum(sizes) - sizes, flat, len(flat)


class Chunk:
    """A chunk's ids on its own, and its words at either end, which a neighbour may change."""

    __slots__ = ("ids", "n", "head", "tail", "head_sizes", "tail_sizes", "opens", "closes")

    def __init__(self, data: bytes, words: list[bytes], ids: np.ndarray, sizes: np.ndarray):
        self.ids, self.n = ids, len(words)
        self.head, self.tail = words[:2], words[-2:]
        self.head_sizes, self.tail_sizes = sizes[:2].tolist(), sizes[-2:].tolist()
        self.opens, self.closes = not _SPACE[data[0]], not _SPACE[data[-1]]


class ChunkEncoder:
    """Encodes texts chunk by chunk; a chunk met again is not encoded again.

    The unit of a chunk is the word between ASCII white space, since the tokenizer drops white
    space. A join of two chunks inside a word is repaired: the word is put together and encoded
    anew, then encoded once more between its neighbours, and that must agree exactly with the ids
    the chunks have for these neighbours. Where it does not, the whole text is encoded at once.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.pieces = Pieces(tokenizer, " \x01 ")
        self.chunks: dict[bytes, Chunk] = {}
        self.held = self.reused = self.repaired = self.whole = 0

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        data = [(text or "").encode() for text in texts]
        cut = [[d[a:b] for a, b in zip([0, *ends], ends)] for d, ends in zip(data, chunk_ends(data))]
        split: dict[bytes, list[bytes]] = {}
        for own in cut:
            for c in own:
                if c in self.chunks or c in split:
                    self.reused += 1
                else:
                    split[c] = c.split()
        ids, sizes = self.pieces.ids([w for words in split.values() for w in words])
        ends = np.r_[0, np.cumsum(sizes)]
        at = 0
        for c, words in split.items():
            to = at + len(words)
            self.chunks[c] = Chunk(c, words, ids[ends[at]:ends[to]], sizes[at:to])
            self.held += len(c) + int(ends[to] - ends[at]) * 4 + 600
            at = to
        plans = [self._plan(own) for own in cut]
        joints, sizes = self.pieces.ids([word for plan in plans for word, _, _ in plan])
        joints = iter(np.split(joints, np.cumsum(sizes)[:-1]) if len(sizes) else [])
        repairs = [[next(joints) for _ in plan] for plan in plans]
        out = [self._joined([self.chunks[c] for c in own], plan, fixed) for own, plan, fixed in zip(cut, plans, repairs)]
        self._verify(texts, cut, plans, repairs, out)
        if self.held > CACHE_BYTES:
            self.chunks, self.held = {}, 0
        self.pieces.trim()
        return out

    def rest(self) -> None:
        """Let go of the chunks and of all but the REST_WORDS words used last."""
        self.chunks, self.held = {}, 0
        self.pieces.trim(REST_WORDS)

    def _plan(self, own: list[bytes]) -> list[tuple[bytes, int, int]]:
        """(word, first chunk, last chunk) of every word that lies in more than one chunk."""
        found, i = [], 0
        while i + 1 < len(own):
            if _SPACE[own[i][-1]] or _SPACE[own[i + 1][0]]:
                i += 1
                continue
            parts, j = [own[i].split()[-1]], i + 1
            while True:
                words = own[j].split()
                parts.append(words[0])
                if len(words) > 1 or _SPACE[own[j][-1]] or j + 1 == len(own) or _SPACE[own[j + 1][0]]:
                    break
                j += 1
            found.append((b"".join(parts), i, j))
            i = j
        return found

    def _joined(self, chunks: list[Chunk], plan: list[tuple[bytes, int, int]], fixed: list[np.ndarray]) -> np.ndarray:
        if not chunks:
            return np.zeros(0, np.int32)
        low, high = [0] * len(chunks), [len(c.ids) for c in chunks]
        at: dict[int, np.ndarray] = {}
        for (_, i, j), ids in zip(plan, fixed):
            high[i] -= chunks[i].tail_sizes[-1]
            for k in range(i + 1, j):
                low[k] = high[k]
            low[j] = chunks[j].head_sizes[0]
            at[i] = ids
        parts = []
        for k, c in enumerate(chunks):
            if low[k] < high[k]:
                parts.append(c.ids[low[k]:high[k]])
            if k in at:
                parts.append(at[k])
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def _verify(self, texts, cut, plans, repairs, out) -> None:
        """Compare every repaired word, seen between its neighbours, with the ids put together."""
        windows, expected, owner = [], [], []
        for number, (own, plan, fixed) in enumerate(zip(cut, plans, repairs)):
            for (word, i, j), ids in zip(plan, fixed):
                a, b = self.chunks[own[i]], self.chunks[own[j]]
                words = [word]
                want = ids.tolist()
                if a.n > 1:
                    words.insert(0, a.tail[0])
                    want = [*a.ids[len(a.ids) - sum(a.tail_sizes):len(a.ids) - a.tail_sizes[-1]].tolist(), *want]
                if b.n > 1:
                    words.append(b.head[1])
                    want += b.ids[b.head_sizes[0]:sum(b.head_sizes)].tolist()
                windows.append(b" ".join(words).decode())
                expected.append(want)
                owner.append(number)
        self.repaired += len(windows)
        coded = self.tokenizer.encode_batch_fast(windows, add_special_tokens=False)
        for number in {n for n, c, want in zip(owner, coded, expected) if c.ids != want}:
            self.whole += 1
            out[number] = np.array(self.tokenizer.encode(texts[number] or "", add_special_tokens=False).ids, np.int32)


_LOADED: dict[str, object] = {}


def worker_tokenizer(spec: str):
    """The tokenizer of a JSON text, built once a worker and run on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if spec not in _LOADED:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(spec)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _LOADED.clear()
        _LOADED[spec] = tokenizer
    return _LOADED[spec]


_ENCODERS: dict[str, ChunkEncoder] = {}


def _encoder(spec: str) -> ChunkEncoder:
    if spec not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[spec] = ChunkEncoder(worker_tokenizer(spec))
    return _ENCODERS[spec]


def read_spec(path: str) -> str:
    """The tokenizer's JSON text; it travels to the tasks, so only the driver needs the file."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def int_lists(lists: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(lists) + 1, np.int32)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    flat = np.concatenate(lists) if lists else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def roundtrip(docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """`docs` with the token ids of each text and the text decoded from them; one pass, no shuffle.

    Ids are those of the tokenizer on the whole text without special tokens added; decoding keeps
    special tokens. Null counts as empty: no ids, empty text. Chunks and words are kept from text to
    text in each task, up to CACHE_BYTES and CACHE_WORDS; chunks beyond that are all let go, and between
    tasks the last REST_WORDS words stay. New columns whose names are taken get underscores in front.
    """
    spec = read_spec(tokenizer)
    hidden, ids = free_name(docs, "source_text"), free_name(docs, ids)
    decoded = free_name(docs, decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(spec)
        for batch in sized_batches(batches, hidden, 1 << 20):
            lists = encoder.encode_batch(batch.column(hidden).to_pylist())
            back = encoder.tokenizer.decode_batch([x.tolist() for x in lists], skip_special_tokens=False)
            rest = batch.select(range(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, int_lists(lists), pa.array(back, pa.string())], [*rest.schema.names, ids, decoded])
        # Workers live on in other stages, so only the words used last stay from task to task.
        encoder.rest()

    tagged = docs.withColumn(hidden, F.col(text).cast("string"))
    schema = T.StructType([*docs.schema, T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())])
    return tagged.mapInArrow(lean(run), schema)
