"""Line dedup within one word of difference, by joining lines on their deletion neighbourhoods."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage, free_name, lean, sized_batches, told_apart

MIN_WORDS = 5
# More lines than a text can have.
LINES = 1 << 31
FILTER_BITS = 1 << 26
BLOCK_BITS = 1 << 15
BLOCK_WORDS = BLOCK_BITS // 32
FILTER_BLOCKS = FILTER_BITS // BLOCK_BITS
# Bytes of text that a task takes apart at a time.
SLICE = 1 << 20
_NO_HALVES = bytes(32)


def line_words(line: str) -> list[bytes]:
    """Words of a line between ASCII white space, A-Z lower-cased."""
    return line.encode().lower().split()


def half_digests(words: list[bytes]) -> bytes:
    """Four 8-byte keys of which two lines within one word share at least one: front and back halves.

    With h half the words of the shorter line, rounded down, two such lines have their first h words
    in common if they differ at word h or behind it, and else their last h words. A line of n words
    has both halves for h = n // 2 and, where that differs, for a partner that is a word shorter;
    where it does not, the last two keys are empty (`_numbers` leaves them out by the words' number).
    """
    n, digest, found = len(words), xxhash.xxh3_64_digest, b""
    for h in (n // 2, (n - 1) // 2)[:2 - n % 2]:
        found += digest(b"f%d " % h + b" ".join(words[:h])) + digest(b"b%d " % h + b" ".join(words[n - h:]))
    return found.ljust(32, b"\0")


def _numbers(digests: bytes | bytearray, width: int) -> np.ndarray:
    """Digests as rows of `width` signed numbers."""
    return np.frombuffer(bytes(digests), ">u8").astype(np.uint64).view(np.int64).reshape(-1, width)


def places_to_drop(n: int, shared: list[int]) -> list[int]:
    """Words of a line of `n` words at which a line that shares the halves `shared` (numbers as in `half_keys`) may differ."""
    first = min((h for i, h in enumerate((n // 2, n // 2, (n - 1) // 2, (n - 1) // 2)) if i in shared and i % 2 == 0), default=n)
    last = max((h for i, h in enumerate((n // 2, n // 2, (n - 1) // 2, (n - 1) // 2)) if i in shared and i % 2), default=0)
    return [p for p in range(n) if p >= first or p < last]


def within_one_word(a: list[bytes], b: list[bytes]) -> bool:
    """Whether one insertion, deletion or substitution of a word at most turns `a` into `b`."""
    if abs(len(a) - len(b)) > 1:
        return False
    short, long = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(short, long)) if x != y), len(short))
    return short[i + (len(a) == len(b)):] == long[i + 1:]


HALVES = ["h0", "h1", "h2", "h3"]


def _lines(rows: DataFrame, least: int) -> DataFrame:
    """(place, hi, lo, h0 ... h3) of every line of at least `least` words; hi, lo hash its words.

    Lines under MIN_WORDS words have no halves, so they meet only their copies.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches, "text", SLICE):
            counts, numbers, sizes, hashes, halves = [], array("i"), array("q"), bytearray(), bytearray()
            for text in batch.column("text").to_pylist():
                before = len(numbers)
                for number, line in enumerate(text.split("\n")):
                    words = line_words(line)
                    if len(words) >= least:
                        numbers.append(number)
                        sizes.append(len(words))
                        hashes += xxhash.xxh3_128_digest(b" ".join(words))
                        halves += half_digests(words) if len(words) >= MIN_WORDS else _NO_HALVES
                counts.append(len(numbers) - before)
            n, whole, half = np.array(sizes, np.int64), _numbers(hashes, 2), _numbers(halves, 4)
            owner = pa.array(np.repeat(np.arange(batch.num_rows), counts))
            yield pa.RecordBatch.from_arrays([
                batch.column("key").take(owner), pa.array(np.array(numbers, np.int32)), *[pa.array(whole[:, i]) for i in range(2)],
                *[pa.array(half[:, i], mask=(n < MIN_WORDS) | (i > 1) & (n % 2 == 1)) for i in range(4)]], ["key", "line", "hi", "lo", *HALVES])

    found = rows.mapInArrow(lean(run), "key long, line int, hi long, lo long, " + ", ".join(f"{h} long" for h in HALVES))
    return found.select(_place().alias("place"), "hi", "lo", *HALVES)


def _place(key: str = "key", line: str = "line") -> Column:
    """Key and line number as one number in the same order, which hash aggregates take."""
    return (F.col(key).cast("decimal(20,0)") * F.lit(LINES).cast("decimal(10,0)") + F.col(line)).cast("decimal(30,0)")


def _unplaced(place: str = "place") -> list[Column]:
    """Key and line number of a place."""
    line = F.pmod(F.col(place), F.lit(LINES).cast("decimal(30,0)"))
    return [((F.col(place) - line) / F.lit(LINES).cast("decimal(10,0)")).cast("decimal(20,0)").cast("long").alias("key"), line.cast("int").alias("line")]


def _picked_lines(rows: DataFrame) -> DataFrame:
    """(place, text, shared) of the lines named in `lines`, with the halves they share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches, "text", SLICE):
            keys, numbers, shared, texts = [], [], [], []
            for key, text, lines in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "lines"))):
                own = text.split("\n")
                for x in lines:
                    keys.append(key)
                    numbers.append(x["line"])
                    shared.append(x["shared"])
                    texts.append(own[x["line"]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(numbers, pa.int32()), pa.array(texts, pa.string()), pa.array(shared, pa.list_(pa.int32()))],
                ["key", "line", "text", "shared"])

    found = rows.select("key", "text", "lines").mapInArrow(lean(run), "key long, line int, text string, shared array<int>")
    return found.select(_place().alias("place"), "text", "shared")


def _variants(lines: DataFrame) -> DataFrame:
    """(place, hi, lo, at): hash of the line (at -1), and of the line without the word at each place that may differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches, "text", 1 << 18):
            hashes, places, counts = [], [], []
            for text, shared in zip(batch.column("text").to_pylist(), batch.column("shared").to_pylist()):
                words = line_words(text)
                drop = places_to_drop(len(words), shared)
                line, digest = b" ".join(words), xxhash.xxh3_128_digest
                starts = np.cumsum([0, *(len(w) + 1 for w in words)]).tolist()
                hashes.append(digest(line))
                for p in drop:
                    hashes.append(digest(line[:starts[p]] + line[starts[p + 1]:] if p + 1 < len(words) else line[:max(starts[p] - 1, 0)]))
                places += [-1, *drop]
                counts.append(len(drop) + 1)
            both = _numbers(b"".join(hashes), 2)
            owner = pa.array(np.repeat(np.arange(batch.num_rows), counts))
            yield pa.RecordBatch.from_arrays([batch.column("place").take(owner), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(places, pa.int32())],
                                             ["place", "hi", "lo", "at"])

    return lines.select("place", "text", "shared").mapInArrow(lean(run), "place decimal(30,0), hi long, lo long, at int")


def _verified(pairs: DataFrame) -> DataFrame:
    """Places of pairs whose texts are within one word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches, "text", SLICE):
            near = [within_one_word(line_words(a), line_words(b)) for a, b in zip(batch.column("text").to_pylist(), batch.column("other").to_pylist())]
            yield batch.select(["place"]).filter(pa.array(near, pa.bool_()))

    return pairs.select("place", "text", "other").mapInArrow(lean(run), "place decimal(30,0)")


def _filter_bits(key: Column) -> tuple[Column, list[Column]]:
    """Block of a key in the bit table, and its two bits within the block."""
    first, second = (F.xxhash64(F.lit(i), key) for i in range(2))
    return F.pmod(first, F.lit(FILTER_BLOCKS)), [F.pmod(h, F.lit(BLOCK_BITS)).cast("int") for h in (F.shiftright(first, 32), second)]


class KeyFilter:
    """A bit table of at most 8 MB that holds a set of keys; a key not in the set passes only rarely.

    It lets documents without any entry skip a shuffle. It may hold so many keys that all pass; then
    nothing is skipped and the result is the same. Tasks fill the table, block by block, and it is
    joined by a broadcast: the rows, texts included, stay in Spark, none goes through Python.
    """

    def __init__(self, keys: DataFrame, key: str = "key"):
        block, bits = _filter_bits(F.col(key))
        marked = keys.select(F.explode(F.array(*[block * BLOCK_BITS + b for b in bits])).alias("bit")).select(
            F.floor(F.col("bit") / 32).cast("int").alias("word"), F.expr("shiftleft(1L, cast(bit % 32 as int))").alias("mask"))
        # One row at most for each of FILTER_BITS / 32 words.
        rows = marked.groupBy("word").agg(F.bit_or("mask").alias("mask")).withColumn("block", F.floor(F.col("word") / BLOCK_WORDS).cast("int"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table, held = np.zeros((FILTER_BLOCKS, BLOCK_WORDS), np.int32), np.zeros(FILTER_BLOCKS, bool)
            for batch in batches:
                word, mask, block = (batch.column(c).to_numpy() for c in ("word", "mask", "block"))
                table.reshape(-1)[word] = mask.astype(np.uint32).view(np.int32)
                held[block] = True
            blocks = np.flatnonzero(held)
            starts = np.arange(len(blocks) + 1, dtype=np.int32) * BLOCK_WORDS
            yield pa.RecordBatch.from_arrays([pa.array(blocks), pa.ListArray.from_arrays(starts, table[blocks].reshape(-1))], ["block", "words"])

        self.table = cut_lineage(rows.repartition("block").mapInArrow(lean(run), "block long, words array<int>"), "bits")

    def passing(self, df: DataFrame, key: Column) -> DataFrame:
        """Rows of `df` with a new last column that tells whether the key may be in the set; no shuffle."""
        block, words, flag = (free_name(df, c) for c in ("filter_block", "filter_words", "may_hold"))
        at, bits = _filter_bits(key)
        held = [F.getbit(F.get(words, F.shiftright(b, 5)), b.bitwiseAND(31)) == 1 for b in bits]
        found = df.join(F.broadcast(self.table.toDF(block, words)), (F.col(block) == at) & held[0] & held[1], "left")
        return found.select(*(F.col(f"`{c}`") for c in df.columns), F.col(block).isNotNull().alias(flag))


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", short_copies: bool = False) -> DataFrame:
    """(key, line) of every line that has an earlier line within one word of it.

    Lines count in the order of key and line number. The unit of an edit is a word, the bound is one
    insertion, deletion or substitution whatever the length, so lines of MIN_WORDS words are alike
    to at least four fifths and long ones almost wholly; long lines with more edits stay. Shorter lines are never near: with `short_copies` each that has a word goes if an earlier
    line has the same words, else they are neither removed nor a reason to remove. The key must be a
    64-bit integer and tell the rows apart (see `drop_repeated_lines`).
    """
    rows = docs.filter(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    lines = cut_lineage(_lines(rows, 1 if short_copies else MIN_WORDS), "lines")

    # Copies first: only the earliest of equal lines goes on, the others are repeated.
    distinct = cut_lineage(lines.groupBy("hi", "lo").agg(
        F.min("place").alias("place"), F.count("*").alias("copies"), *[F.first(h).alias(h) for h in HALVES]), "distinct")
    copied = distinct.filter("copies > 1").select("hi", "lo", F.col("place").alias("first"))
    copies = lines.select("place", "hi", "lo").join(copied, ["hi", "lo"]).filter("place != first").select("place")

    # Lines that share a half with another one; no other line can have a near one.
    halves = distinct.select("place", F.posexplode(F.array(*HALVES)).alias("number", "half")).filter("half IS NOT NULL")
    shared = cut_lineage(halves.groupBy("half").agg(F.count("*").alias("n")).filter("n > 1").select("half"), "halves")
    halves = KeyFilter(shared, "half").passing(halves, F.col("half")).filter("may_hold")
    maybe = halves.join(shared, "half", "left_semi").groupBy("place").agg(F.collect_set("number").alias("shared"))
    maybe = maybe.select(*_unplaced(), "shared").groupBy("key").agg(F.collect_list(F.struct("line", "shared")).alias("lines"))
    maybe = cut_lineage(maybe, "maybe")
    near = KeyFilter(maybe, "key").passing(rows, F.col("key")).filter("may_hold").drop("may_hold")
    # The lists grow with the documents, so they are never sent whole: the same join at every size.
    texts = cut_lineage(_picked_lines(near.join(maybe.hint("merge"), "key")), "texts")

    # Deletion neighbourhoods. Hashes that only one line has, and hashes that no whole line has, go no further.
    variants = _variants(texts)
    at_place, whole_line = F.xxhash64("hi", "lo", "at"), F.xxhash64("hi", "lo")
    met = variants.filter("at >= 0").groupBy(at_place.alias("k")).agg(F.count("*").alias("n")).filter("n > 1").select("k")
    met = met.unionByName(variants.filter("at < 0").select(whole_line.alias("k")))
    held = KeyFilter(cut_lineage(met, "met"), "k")
    placed = held.passing(held.passing(variants, at_place), whole_line).filter("at < 0 OR may_hold OR _may_hold")
    variants = cut_lineage(placed.select("place", "hi", "lo", "at"), "variants")

    # Lines that are equal without the word at one place differ there only: each is near the earliest.
    # A line and one that is equal to it without a word are near each other.
    cut = variants.filter("at >= 0")
    by_place = cut.groupBy("hi", "lo", "at").agg(F.min("place").alias("low"), F.count("*").alias("n")).filter("n > 1").drop("n")
    swapped = cut.join(by_place, ["hi", "lo", "at"]).select("place", "low")
    whole = variants.filter("at < 0").select("hi", "lo", F.col("place").alias("low"))
    longer = cut.join(whole, ["hi", "lo"]).select("place", "low")
    shorter = longer.groupBy("low").agg(F.min("place").alias("first")).select(F.col("low").alias("place"), F.col("first").alias("low"))
    pairs = swapped.unionByName(longer).unionByName(shorter).filter("place > low").distinct()
    other = texts.select(F.col("place").alias("low"), F.col("text").alias("other"))
    found = _verified(pairs.join(texts.select("place", "text"), "place").join(other, "low"))
    return copies.unionByName(found).distinct().select(*_unplaced())


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", n_chars: str | None = None,
                        short_copies: bool = False, keep_emptied: bool = True) -> DataFrame:
    """`docs` without the lines of `repeated_lines`; all columns stay, `n_chars` is counted anew.

    A document that loses all its lines has an empty text, or blank lines alone; without
    `keep_emptied` it goes, all other rows stay. Null keys and null texts stay as they are.
    Documents without repeated lines are passed on without a shuffle. The key must be a 64-bit
    integer. Rows with one key are rows of their own, in the order in which they are stored: the
    second of two equal rows loses its lines as it would under another key.
    """
    before = docs
    docs, key = told_apart(docs, key)
    hidden, lines = free_name(docs, "line_key"), free_name(docs, "gone_lines")
    gone = cut_lineage(repeated_lines(docs, key, text, short_copies).groupBy("key").agg(F.collect_list("line").alias("lines")), "gone")
    gone = gone.select(F.col("key").alias(hidden), F.col("lines").alias(lines))
    tagged = KeyFilter(gone, hidden).passing(docs, F.col(key).cast("long"))
    flag = tagged.columns[-1]
    touched = tagged.filter(F.col(flag)).join(gone.hint("merge"), F.col(key).cast("long") == F.col(hidden), "left").drop(flag, hidden)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches, text, SLICE):
            kept, stays = [], []
            for body, drop in zip(batch.column(text).to_pylist(), batch.column(lines).to_pylist()):
                if drop and body is not None:
                    drop = set(drop)
                    body = "\n".join(x for i, x in enumerate(body.split("\n")) if i not in drop)
                kept.append(body)
                stays.append(keep_emptied or not drop or body is None or bool(line_words(body)))
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(kept, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1]).filter(pa.array(stays, pa.bool_()))

    changed = touched.mapInArrow(lean(run), docs.schema)
    if n_chars:
        changed = changed.withColumn(n_chars, F.char_length(text).cast(docs.schema[n_chars].dataType))
    return tagged.filter(~F.col(flag)).drop(flag).unionByName(changed).select(*before.columns)
