"""Hidden Markov language model over whole corpora: Baum-Welch across partitions, exact scaled scoring."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage, lean, lower_words, sized_batches
from tidemark.llm.ragged import by_step

STATES = 8
CLASS_BITS = 14
MIN_SHARDS = 4
# Rounds end when one adds less than SETTLED to the mean log10 likelihood of a training token; ROUNDS only guards the loop.
SETTLED, ROUNDS = 0.001, 100
BLOCK_BYTES = 6 << 20
STICKY = 0.95
SMOOTH = 0.1
END = 0


class Hmm:
    """Start, transition and emission chances; a symbol is a class of words, symbol 0 the end."""

    def __init__(self, start: np.ndarray, trans: np.ndarray, emit: np.ndarray):
        self.start, self.trans, self.emit = start, trans, emit

    @classmethod
    def initial(cls, totals: np.ndarray, states: int = STATES, seed: int = 11) -> Hmm:
        """Sticky states whose emissions are the symbols' shares, each pushed at random."""
        rng = np.random.default_rng(seed)
        emit = (totals + SMOOTH)[:, None] * rng.gamma(2.0, 1.0, (len(totals), states))
        trans = np.full((states, states), (1 - STICKY) / max(states - 1, 1))
        np.fill_diagonal(trans, STICKY if states > 1 else 1.0)
        return cls(np.full(states, 1 / states), trans, emit / emit.sum(axis=0))

    @classmethod
    def estimated(cls, start: np.ndarray, trans: np.ndarray, emit: np.ndarray) -> Hmm:
        """From expected counts, smoothed by SMOOTH."""
        start, trans, emit = start + SMOOTH, trans + SMOOTH, emit + SMOOTH
        return cls(start / start.sum(), trans / trans.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))

    def forward(self, symbols: np.ndarray, borders: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(emission, scaled forward chances, scale) of every position, ordered by step.

        A sequence's likelihood is the product of its scales.
        """
        chance = self.emit[symbols]
        alpha, scale = chance.copy(), np.ones(len(symbols), chance.dtype)
        last = 0
        for first, stop in zip(borders, borders[1:]):
            now = alpha[first:stop]
            now *= alpha[last:last + stop - first] @ self.trans if first else self.start
            total = np.add.reduce(now, axis=1, out=scale[first:stop])
            now /= total[:, None]
            last = first
        return chance, alpha, scale

    def log10(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """log10 likelihood of every sequence; sequences lie one after the other, none is empty."""
        rows, borders = by_step(lengths)
        _, _, scale = self.forward(symbols[rows], borders.tolist())
        logs = np.empty(len(symbols))
        logs[rows] = np.log10(scale)
        return np.add.reduceat(logs, np.cumsum(lengths) - lengths)

    def expected(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts of starts, transitions and emissions."""
        return self.counted(symbols, lengths)[:3]

    def counted(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected counts as in `expected` and the log10 likelihood of all sequences; chances in single precision, sums in double."""
        rows, borders = by_step(lengths)
        symbols, borders = symbols[rows], borders.tolist()
        single = Hmm(*(x.astype(np.float32) for x in (self.start, self.trans, self.emit)))
        chance, alpha, scale = single.forward(symbols, borders)
        fit = float(np.log10(scale).sum(dtype=np.float64))
        # Emission times backward chance over scale: one step of it gives the backward chance before.
        chance /= scale[:, None]
        beta, trans, back = np.ones_like(alpha), np.zeros_like(self.trans), single.trans.T.copy()
        for last, first, stop in reversed(list(zip(borders, borders[1:], borders[2:]))):
            n = stop - first
            ahead = chance[first:stop]
            ahead *= beta[first:stop]
            np.matmul(ahead, back, out=beta[last:last + n])
            trans += alpha[last:last + n].T @ ahead
        alpha *= beta
        alpha /= alpha.sum(axis=1, keepdims=True)
        emit = np.stack([np.bincount(symbols, alpha[:, k], len(self.emit)) for k in range(alpha.shape[1])], axis=1)
        return alpha[:borders[1]].sum(axis=0, dtype=np.float64), self.trans * trans, emit, fit


def word_hash(word: bytes) -> int:
    return zlib.crc32(word)


def class_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Symbol of every word by the top bits of its hash; symbol 0 is the end."""
    return 1 + (hashes.astype(np.uint32) >> np.uint32(32 - bits)).astype(np.int64)


def _blocks(rows: DataFrame, block_bytes: int) -> DataFrame:
    """Tokenised blocks of some `block_bytes` of text: distinct words, their hashes and counts in training texts, word numbers.

    Word numbers start at 1 in the order in which the words are met; number 0 is the end.
    """
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in sized_batches(batches, "text", block_bytes):
            known: dict[bytes, int] = {}
            ids, lengths = [], []
            for text in batch.column("text").to_pylist():
                words = lower_words(text)
                ids += [known.setdefault(w, len(known) + 1) for w in words]
                ids.append(END)
                lengths.append(len(words) + 1)
            ids, lengths = np.array(ids, np.uint32), np.array(lengths, np.int32)
            train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
            counts = np.bincount(ids[np.repeat(train, lengths)], minlength=len(known) + 1)[1:].astype(np.uint32)
            hashes = np.fromiter(map(word_hash, known), np.uint32, len(known))
            one = {
                "block": pa.array([(part << 32) | number], pa.int64()), "words": pa.array([b" ".join(known)], pa.binary()),
                "keys": pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("key")),
            } | {name: pa.array([x.tobytes()], pa.binary()) for name, x in
                 (("counts", counts), ("hashes", hashes), ("ids", ids), ("lengths", lengths), ("train", train))}
            yield pa.RecordBatch.from_arrays(list(one.values()), list(one))
            number += 1

    return rows.select("key", "text", "train").mapInArrow(lean(run), f"block long, words binary, keys array<{kind}>, counts binary, hashes binary, ids binary, lengths binary, train binary")


def _raw(batch: pa.RecordBatch, row: int, column: str, kind) -> np.ndarray:
    return np.frombuffer(batch.column(column)[row].as_buffer(), kind)


def _symbols(batch: pa.RecordBatch, row: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word numbers, symbol of each word number, lengths) of a block."""
    symbols = np.r_[END, class_of(_raw(batch, row, "hashes", np.uint32), bits)]
    return _raw(batch, row, "ids", np.uint32), symbols, _raw(batch, row, "lengths", np.int32).astype(np.int64)


def _by_hash(hashes: np.ndarray) -> np.ndarray:
    """Words of a block in the order of their hashes; equal hashes stay in the block's order."""
    return np.argsort(hashes, kind="stable")


def _word_counts(blocks: DataFrame, shards: int, bits: int) -> DataFrame:
    """Counts of words over all blocks: for every block and shard, and the totals of each symbol.

    A shard is a range of hashes. Every block sends each shard its words there, packed, with its own
    counts; the shard adds them up and answers with the sums in the order it was sent them. A row
    without a block holds the shard's symbols with their tokens and distinct words.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                hashes, counts = _raw(batch, row, "hashes", np.uint32), _raw(batch, row, "counts", np.uint32)
                order = _by_hash(hashes)
                words = batch.column("words")[row].as_py().split()
                shard = (hashes[order].astype(np.uint64) * np.uint64(shards)) >> np.uint64(32)
                starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(order) else np.zeros(0, np.int64)
                cuts = [order[a:b] for a, b in zip(starts, [*starts[1:], len(order)])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(shard[starts].astype(np.int64)), pa.array(np.full(len(starts), batch.column("block")[row].as_py())),
                    pa.array([b" ".join([words[i] for i in c.tolist()]) for c in cuts], pa.binary()),
                    pa.array([counts[c].tobytes() for c in cuts], pa.binary())], ["shard", "block", "words", "counts"])

    def add(table: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {}
        ids = [[number.setdefault(w, len(number)) for w in words.as_py().split()] for words in table.column("words")]
        total = np.zeros(len(number), np.int64)
        for own, counts in zip(ids, table.column("counts")):
            total[own] += np.frombuffer(counts.as_buffer(), np.uint32)
        met = total > 0
        symbols = class_of(np.fromiter(map(word_hash, number), np.uint32, len(number)), bits)[met]
        classes, which = np.unique(symbols, return_inverse=True)
        tokens, distinct = np.bincount(which, total[met], len(classes)), np.bincount(which, minlength=len(classes))
        n = table.num_rows
        own = lambda x: pa.array([None] * n + [x.astype(np.int64).tolist()], pa.list_(pa.int64()))
        return pa.table({
            "block": pa.array([*table.column("block").to_pylist(), None], pa.int64()),
            "shard": pa.array([table.column("shard")[0].as_py()] * (n + 1), pa.int64()),
            "sums": pa.array([*[total[x].tobytes() for x in ids], None], pa.binary()),
            "classes": own(classes), "tokens": own(tokens), "distinct": own(distinct)})

    sent = blocks.select("block", "words", "counts", "hashes").mapInArrow(lean(send), "shard long, block long, words binary, counts binary")
    return sent.groupBy("shard").applyInArrow(
        add, "block long, shard long, sums binary, classes array<bigint>, tokens array<bigint>, distinct array<bigint>")


def _baum_welch_round(blocks: DataFrame, model: Hmm, bits: int) -> tuple[Hmm, float]:
    """One round over all training texts, with their log10 likelihood before it; counts are summed in each task, then by symbol across tasks."""
    states, size = model.trans.shape[0], len(model.emit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, trans, emit, fit = np.zeros(states), np.zeros((states, states)), np.zeros((size, states)), np.zeros(states)
        for batch in batches:
            for row in range(batch.num_rows):
                ids, symbols, lengths = _symbols(batch, row, bits)
                train = _raw(batch, row, "train", bool)
                if train.any():
                    found = model.counted(symbols[ids[np.repeat(train, lengths)]], lengths[train])
                    for total, part in zip((start, trans, emit, fit[:1]), found):
                        total += part
        table = np.concatenate([emit, trans, start[None], fit[None]])
        used = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(table[used, k]) for k in range(states)]],
                                         ["row", *[f"s{k}" for k in range(states)]])

    names = [f"s{k}" for k in range(states)]
    counts = blocks.select("hashes", "ids", "lengths", "train").mapInArrow(lean(run), "row long, " + ", ".join(f"{n} double" for n in names))
    # At most one row for each symbol and state and two more come to the driver.
    rows = counts.groupBy("row").agg(*[F.sum(n).alias(n) for n in names]).orderBy("row").toArrow()
    table = np.zeros((size + states + 2, states))
    table[rows.column("row").to_numpy()] = np.stack([rows.column(n).to_numpy() for n in names], axis=1) if rows.num_rows else 0
    return Hmm.estimated(table[-2], table[size:-2], table[:size]), float(table[-1, 0])


def score_corpus(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS,
                 bits: int = CLASS_BITS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) of every row; `train` marks the rows to learn from.

    Tokens are the words of the lower-cased text and one end. A state emits a class of words (the top
    `bits` of the word's hash, so the model's size does not grow) and the class its word, by the
    word's smoothed share of the class's training tokens; the end is a class of its own. `score` is
    the exact log10 likelihood of the sequence by the scaled forward recursion. `base_score` is the
    smoothed unigram score. All counts and all rounds cover all training texts. Null, empty and blank texts are a
    lone end; repeated rows count and are scored each; without training rows all counts are 0.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                       F.coalesce(train, F.lit(False)).alias("train"))
    # Texts of like length share blocks, so that a block has few steps with hardly a sequence in them.
    blocks = cut_lineage(_blocks(rows.sortWithinPartitions(F.octet_length("text")), block_bytes), "blocks")
    # A shard takes the words of some eight blocks' worth, whatever the size of the corpus.
    shards = max(MIN_SHARDS, blocks.select("block").count() // 8)
    counted = cut_lineage(_word_counts(blocks, shards, bits), "counts")
    sizes = counted.filter("block IS NULL").select(F.explode(F.arrays_zip("classes", "tokens", "distinct")).alias("c")).groupBy(
        "c.classes").agg(F.sum("c.tokens").alias("c"), F.sum("c.distinct").alias("v")).toArrow()
    ends = rows.filter("train").count()
    total, distinct = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    if sizes.num_rows:
        at = sizes.column("classes").to_numpy()
        total[at], distinct[at] = sizes.column("c").to_numpy(), sizes.column("v").to_numpy()
    n_train, n_words = int(total.sum()) + ends, int(distinct.sum()) + (ends > 0)
    model, last = Hmm.initial(np.r_[ends, total[1:]]), -np.inf
    for _ in range(rounds):
        model, fit = _baum_welch_round(blocks, model, bits)
        if fit - last < SETTLED * n_train or not n_train:
            break
        last = fit

    known = counted.filter("block IS NOT NULL").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("shard", "sums"))).alias("known"))
    joined = blocks.select("block", "hashes", "ids", "lengths", "keys").join(known, "block", "left")
    in_class = np.log10(total + 0.5 * (distinct + 1))
    base = np.log10(n_train + 0.5 * (n_words + 1))
    kind = rows.schema["key"].dataType.simpleString()
    names = ["key", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, symbols, lengths = _symbols(batch, row, bits)
                count = np.zeros(len(symbols))
                count[END] = ends
                sums = batch.column("known")[row].values
                if sums is not None and len(sums):
                    order = _by_hash(_raw(batch, row, "hashes", np.uint32))
                    count[1 + order] = np.frombuffer(b"".join(sums.field("sums").to_pylist()), np.int64)
                heads = np.cumsum(lengths) - lengths
                share = np.log10(count + 0.5)
                within = share - in_class[symbols]
                within[END] = 0
                score = model.log10(symbols[ids], lengths) + np.add.reduceat(within[ids], heads)
                n_known = np.add.reduceat((count > 0)[ids], heads, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column("keys")[row].values, pa.array(lengths), pa.array(n_known), pa.array(np.full(len(lengths), n_train)),
                    pa.array(np.add.reduceat((share - base)[ids], heads)), pa.array(score)], names)

    return joined.mapInArrow(lean(run), f"key {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
