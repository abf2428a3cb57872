"""SimHash near-duplicates found with a Gray-ordered hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage, free_name, fresh, lean, lower_words, sized_batches, told_apart
from tidemark.llm.components import connected_components

WORDS = 4
SEED = 42
MAX_BITS = 4
FAN_OUT = 8
QUERIES_AT_ONCE = 8192


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64-bit fingerprint: a bit is set if it is set in over half of the shingle hashes; 0 without words."""
    tokens = lower_words(text)
    if not tokens:
        return 0
    line = b" ".join(tokens)
    if len(tokens) <= words:
        hashes = np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    else:
        ends = np.cumsum([len(t) + 1 for t in tokens]).tolist()
        digest = xxhash.xxh64_intdigest
        starts = [0, *ends]
        hashes = np.array([digest(line[a:b - 1], SEED) for a, b in zip(starts, ends[words - 1:])], np.uint64)
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_bits = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def with_fingerprint(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp) with the fingerprint as a signed 64-bit integer; one pass over whole texts, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches, "text"):
            fps = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(fps)], ["key", "fp"])

    rows = fresh(df, key, text)
    return rows.mapInArrow(lean(run), f"key {rows.schema['key'].dataType.simpleString()}, fp long")


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Position of each 64-bit value in the reflected Gray order."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Hierarchical index over fingerprints that are sorted by group and, inside a group, by Gray rank.

    Level 0 holds blocks of FAN_OUT neighbours, every next level blocks of nodes of the one below,
    up to one node a group. A node keeps the bits that all its fingerprints share (`mask`,
    `pattern`); bits already shared at its parent are factored out there. A search walks down from
    a group's node, adds up the differing shared bits, and leaves a node with all below it once the
    sum passes the bound.
    """

    def __init__(self, fps: np.ndarray, group_starts: np.ndarray):
        self.fps = fps
        self.levels: list[dict[str, np.ndarray]] = []
        ands = ors = fps
        starts, rows = group_starts, len(fps)
        while True:
            ends = np.r_[starts[1:], rows]
            blocks = -(-(ends - starts) // FAN_OUT)
            owner = np.repeat(np.arange(len(starts)), blocks)
            within = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            first = starts[owner] + within * FAN_OUT
            last = np.minimum(first + FAN_OUT, ends[owner])
            ands, ors = np.bitwise_and.reduceat(ands, first), np.bitwise_or.reduceat(ors, first)
            mask = ~(ands ^ ors)
            self.levels.append({"first": first, "last": last, "mask": mask, "pattern": ands & mask, "own": mask})
            starts, rows = np.cumsum(blocks) - blocks, len(owner)
            if (blocks == 1).all():
                break
        for below, above in zip(self.levels, self.levels[1:]):
            parent = np.repeat(np.arange(len(above["first"])), above["last"] - above["first"])
            below["own"] = below["mask"] & ~above["mask"][parent]

    def search(self, queries: np.ndarray, groups: np.ndarray, max_bits: int, settled=None) -> tuple[np.ndarray, np.ndarray]:
        """(query number, row) of all rows of the query's group within `max_bits`.

        `settled(query numbers, level, nodes)` may name visits that need not go on.
        """
        who, node, diff = np.arange(len(queries)), groups, np.zeros(len(queries), np.int64)
        for number in range(len(self.levels) - 1, -1, -1):
            level = self.levels[number]
            diff = diff + np.bitwise_count((queries[who] ^ level["pattern"][node]) & level["own"][node])
            keep = diff <= max_bits
            if settled is not None:
                keep &= ~settled(who, number, node)
            who, node, diff = who[keep], node[keep], diff[keep]
            first, count = level["first"][node], level["last"][node] - level["first"][node]
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            child = np.repeat(first, count) + step
            who, diff, node = np.repeat(who, count), np.repeat(diff, count), child
        near = np.bitwise_count(queries[who] ^ self.fps[node]) <= max_bits
        return who[near], node[near]


def _root(parent: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Root of every row; paths are halved on the way."""
    at = parent[rows]
    while True:
        up = parent[at]
        if (up == at).all():
            return at
        parent[rows] = up
        at = up


def _join(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the sets of a[i] and b[i]; the smaller root stays."""
    while True:
        x, y = _root(parent, a), _root(parent, b)
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))


def linked_rows(fps: np.ndarray, group_starts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """First row of the set that every row is linked to inside its group, through any chain of links.

    Rows are sorted by group and Gray rank. Gray neighbours are compared first; the index is then
    searched for the rest, and a node whose rows all are in the query's set is skipped, so a group of
    n copies that are close to each other takes about n log n steps and not n squared.
    """
    n = len(fps)
    parent = np.arange(n)
    group = np.zeros(n, np.int64)
    group[group_starts] = 1
    group = np.cumsum(group) - 1
    near = (np.bitwise_count(fps[1:] ^ fps[:-1]) <= max_bits) & (group[1:] == group[:-1])
    rows = np.flatnonzero(near)
    _join(parent, rows + 1, rows)
    index = GrayIndex(fps, group_starts)
    top = len(index.levels) - 1
    for start in range(0, n, QUERIES_AT_ONCE):
        queries = np.arange(start, min(start + QUERIES_AT_ONCE, n))
        sets = low = high = _root(parent, np.arange(n))
        spans = []
        for level in index.levels:
            low, high = np.minimum.reduceat(low, level["first"]), np.maximum.reduceat(high, level["first"])
            spans.append((low, high))

        def settled(who, number, node):
            mine = sets[queries[who]]
            return (spans[number][0][node] == mine) & (spans[number][1][node] == mine)

        assert len(index.levels[top]["first"]) == len(group_starts)
        who, found = index.search(fps[queries], group[queries], max_bits, settled)
        _join(parent, queries[who], found)
    return _root(parent, np.arange(n))


def _cuts(bits: int, parts: int) -> list[tuple[int, int]]:
    """(offset, width) of `parts` nearly equal segments of `bits` bits."""
    edges = [bits * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _masks(max_bits: int) -> list[int]:
    """Bit sets of which two fingerprints within `max_bits` share at least one in full.

    The bits are cut into max_bits + 1 segments, one of which must be untouched; the rest is cut
    likewise, so every set joins two segments.
    """
    found = []
    for offset, width in _cuts(64, max_bits + 1):
        rest = [i for i in range(64) if not offset <= i < offset + width]
        for start, count in _cuts(len(rest), max_bits + 1):
            found.append(sum(1 << i for i in [*range(offset, offset + width), *rest[start:start + count]]))
    return found


def near_links(fps: DataFrame, fp: str = "fp", node: str = "node", max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect all nodes whose distinct fingerprints are within `max_bits`, over any chain.

    Every fingerprint goes to one group for each of (max_bits + 1) squared bit sets, keyed by its
    bits there; two fingerprints within the bound share at least one group. A task sorts its groups
    by Gray rank and links each group through the hierarchical index; it gives a spanning set of
    links, not all pairs. Groups are runs of sorted rows, not lists gathered by key.
    """
    masks = _masks(max_bits)

    def signed(value: int) -> Column:
        return F.lit(value - (1 << 64) if value >> 63 else value).cast("long")

    tagged = F.array(*[F.struct(F.lit(i).cast("short").alias("part"), F.col(fp).bitwiseAND(signed(m)).alias("bits"))
                       for i, m in enumerate(masks)])
    dealt = fps.select(F.col(fp).alias("fp"), F.col(node).alias("node"), F.explode(tagged).alias("g"))
    dealt = dealt.select("g.part", "g.bits", "fp", "node").repartition("part", "bits").sortWithinPartitions("part", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("part", "bits", "fp", "node")])
            rows = rows if kept is None else np.concatenate([kept, rows], axis=1)
            changed = (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])
            if not changed.any():
                kept = rows
                continue
            cut = np.flatnonzero(changed)[-1] + 1
            kept = rows[:, cut:]
            yield from links(rows[:, :cut])
        if kept is not None:
            yield from links(kept)

    def links(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.r_[True, (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])])
        sizes = np.diff(np.r_[starts, rows.shape[1]])
        rows = rows[:, np.repeat(sizes > 1, sizes)]
        if not rows.shape[1]:
            return
        sizes = sizes[sizes > 1]
        values = rows[2].view(np.uint64)
        order = np.lexsort((gray_rank(values), np.repeat(np.arange(len(sizes)), sizes)))
        values, nodes = values[order], rows[3][order]
        root = linked_rows(values, np.cumsum(sizes) - sizes, max_bits)
        own = root != np.arange(len(root))
        if own.any():
            yield pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[root[own]])], ["a", "b"])

    return dealt.mapInArrow(lean(run), "a long, b long")


def simhash_components(df: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """(key, fp, component): fingerprints within `max_bits` link, component is the smallest key reachable.

    Copies share a fingerprint and count once in the index. Null, empty and blank texts have
    fingerprint 0 and are linked like any other; rows with a null key link with nothing and have a
    null component; repeated rows give repeated results. The key must be a 64-bit integer.
    """
    every = cut_lineage(with_fingerprint(df, key, text), "prints")
    prints = every.filter("key IS NOT NULL")
    distinct = cut_lineage(prints.groupBy("fp").agg(F.min("key").alias("node")), "distinct")
    components = connected_components(near_links(distinct, max_bits=max_bits).distinct())
    found = distinct.join(components, "node", "left").select("fp", F.coalesce("component", "node").alias("component"))
    alone = every.filter("key IS NULL").select("key", "fp", F.lit(None).cast("long").alias("component"))
    return prints.join(found, "fp").select("key", "fp", "component").unionByName(alone)


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """All columns of `df` for one row of each group of near copies: the one with the smallest key.

    Rows with a null key are kept. Rows with one key are rows of their own: different texts under one
    key stay, of equal or near ones the first stored does.
    """
    told, number = told_apart(df, key)
    hidden = free_name(told, "component")
    heads = simhash_components(told, number, text, max_bits).filter("key = component").select(F.col("component").alias(hidden))
    stay = told.join(heads, F.col(number) == F.col(hidden), "left_semi").select(*df.columns)
    return stay.unionByName(df.filter(F.col(key).isNull()))


def hex16(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
