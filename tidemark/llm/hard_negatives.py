"""Hard negatives by inner product: a multiway hyperplane tree whose split points know the distance ranges of their siblings' subtrees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import cut_lineage, lean

SCALE = 256.0
EVERY = 100
POSITIVES = NEGATIVES = 5
LOW_SHARE = (80, 100)
# The root's split points and first bounds come from a sample of so many rows; every row is in the tree.
SAMPLE = 4096
MAX_CELLS = 128
BLOCK = 4096
LEAF = 64
FANOUT = 8
BATCH = 1024
# A tile holds about so many blocks of a cell and so many batches of queries.
TILE_BLOCKS, TILE_BATCHES = 4, 16
# Distances carry rounding errors of some 1e-8 of the largest norm; only leaves decide, on exact integers.
SLACK = 1e-6
NO_ID = np.iinfo(np.int64).max


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows as a matrix of `dim` columns; what a row lacks is 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, starts = column.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(np.diff(column.offsets.to_numpy()))]
    sizes = np.diff(starts)
    if (sizes == dim).all():
        return np.asarray(flat, np.float64).reshape(-1, dim)
    out = np.zeros((len(column), dim))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - starts[row]] = flat
    return out


@dataclass
class Space:
    """Vectors lifted to a sphere of radius^2 `top`, so that a larger inner product is a smaller distance.

    A row x becomes (x, sqrt(top - |x|^2)) and a query a becomes (a, 0); their squared distance is
    top + |a|^2 - 2 a.x, so a window of scores is an annulus around the query.
    """

    dim: int
    top: float

    def heights(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.top - (x * x).sum(axis=1), 0))

    def between(self, p: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Distances of lifted rows."""
        return np.sqrt(np.maximum(2 * (self.top - p @ x.T - np.outer(self.heights(p), self.heights(x))), 0))

    @property
    def slack(self) -> float:
        return SLACK * float(np.sqrt(self.top))


def far_points(space: Space, x: np.ndarray, n: int) -> np.ndarray:
    """Row numbers of at most `n` distinct split points: each the farthest from those before."""
    found = [0]
    near = space.between(x[:1], x)[0]
    while len(found) < n:
        at = int(near.argmax())
        if near[at] <= space.slack:
            break
        found.append(at)
        near = np.minimum(near, space.between(x[at:at + 1], x)[0])
    return np.array(found)


def ranges(distances: np.ndarray, cell: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """(low, high): the least and greatest distance of every split point (row) to the rows of every cell (column)."""
    low, high = np.full((m, m), np.inf), np.full((m, m), -np.inf)
    for j in range(m):
        own = distances[:, cell == j]
        if own.shape[1]:
            low[:, j], high[:, j] = own.min(axis=1), own.max(axis=1)
    return low, high


def query_distances(space: Space, queries: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(squared distance at score 0, distances to the points) of every query."""
    base = (queries * queries).sum(axis=1) + space.top
    return base, np.sqrt(np.maximum(base[:, None] - 2 * (queries @ points.T), 0))


def survivors(space: Space, base: np.ndarray, d: np.ndarray, lo: np.ndarray, hi: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each query and sibling: whether its range meets the query's annulus as seen from every split point.

    The annulus holds the distances at which scores lie in [lo, hi]. A row in it is, from a split point
    at distance d, no farther than d + outer and no nearer than d - outer or inner - d.
    """
    inner, outer = (np.sqrt(np.maximum(base - 2 * end, 0)) for end in (hi, lo))
    upto = d + outer[:, None] + space.slack
    beyond = np.maximum(d - outer[:, None], inner[:, None] - d) - space.slack
    alive = np.repeat((lo <= hi)[:, None], low.shape[1], axis=1)
    for i in range(d.shape[1]):
        alive &= (low[i] <= upto[:, i:i + 1]) & (high[i] >= beyond[:, i:i + 1])
    return alive


class Tree:
    """One block of rows: split points with sibling ranges above leaves of rows in id order."""

    FIELDS = ("first", "last", "fanout", "splits", "kids", "low", "high")

    def __init__(self, space: Space, x: np.ndarray, uid: np.ndarray, ids: np.ndarray, label: np.ndarray, nodes: dict):
        self.space, self.x, self.uid, self.ids, self.label = space, x, uid, ids, label
        self.first, self.last, self.fanout, self.splits, self.kids, self.low, self.high = (nodes[f] for f in self.FIELDS)
        self.at = np.cumsum(self.fanout) - self.fanout
        squares = self.fanout.astype(np.int64) ** 2
        self.range_at = np.cumsum(squares) - squares

    @classmethod
    def build(cls, space: Space, x: np.ndarray, uid: np.ndarray, ids: np.ndarray, label: np.ndarray) -> Tree:
        first, last, fanout, splits, kids, low, high, order = [], [], [], [], [], [], [], []

        def add(rows: np.ndarray) -> int:
            me = len(first)
            first.append(len(order))
            last.append(0)
            chosen = rows[far_points(space, x[rows], FANOUT)] if len(rows) > LEAF else rows[:1]
            if len(chosen) < 2:
                fanout.append(0)
                splits.append([])
                kids.append([])
                low.append(np.zeros(0))
                high.append(np.zeros(0))
                order.extend(rows[np.lexsort((uid[rows], ids[rows]))].tolist())
            else:
                distances = space.between(x[chosen], x[rows])
                cell = distances.argmin(axis=0)
                near, far = ranges(distances, cell, len(chosen))
                fanout.append(len(chosen))
                splits.append(chosen.tolist())
                kids.append([])
                low.append(near.ravel())
                high.append(far.ravel())
                for j in range(len(chosen)):
                    kids[me].append(add(rows[cell == j]))
            last[me] = len(order)
            return me

        add(np.arange(len(x)))
        order = np.array(order)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        nodes = dict(zip(cls.FIELDS, (
            np.array(first), np.array(last), np.array(fanout), place[[r for own in splits for r in own]] if len(first) > 1 else np.zeros(0, np.int64),
            np.array([k for own in kids for k in own], np.int64), np.concatenate(low), np.concatenate(high))))
        return cls(space, x[order], uid[order], ids[order], label[order], nodes)

    def search(self, queries: np.ndarray, label: np.ndarray, own: np.ndarray, lo: np.ndarray, hi: np.ndarray, same: bool, k: int):
        """(query, row, score) of each query's first `k` rows of its window, by falling score, then id.

        Rows of the query's label count if `same`, else all others; the row `own` never does. A
        window narrows from below as soon as `k` rows are found.
        """
        lo, best, found = lo.copy(), np.full((len(queries), k), -np.inf), []

        def visit(node: int, alive: np.ndarray) -> None:
            m, a, b = int(self.fanout[node]), int(self.first[node]), int(self.last[node])
            if m:
                at, r = self.at[node], self.range_at[node]
                low, high = (f[r:r + m * m].reshape(m, m) for f in (self.low, self.high))
                base, d = query_distances(self.space, queries[alive], self.x[self.splits[at:at + m]])
                for j in range(m):
                    # Windows may have narrowed in the sibling before.
                    ok = survivors(self.space, base, d, lo[alive], hi[alive], low[:, j:j + 1], high[:, j:j + 1])[:, 0]
                    if ok.any():
                        visit(int(self.kids[at + j]), alive[ok])
                return
            s = queries[alive] @ self.x[a:b].T
            kin = label[alive, None] == self.label[None, a:b]
            ok = (kin if same else ~kin) & (s >= lo[alive, None]) & (s <= hi[alive, None]) & (own[alive, None] != self.uid[None, a:b])
            s[~ok] = -np.inf
            top, every = np.full((len(alive), k), -np.inf), np.arange(len(alive))
            for i in range(min(k, b - a)):
                j = s.argmax(axis=1)  # of equal scores the first row, which has the smaller id
                top[:, i] = s[every, j]
                hit = np.flatnonzero(top[:, i] > -np.inf)
                if not len(hit):
                    break
                found.append((alive[hit], a + j[hit], top[hit, i]))
                s[every, j] = -np.inf
            best[alive] = np.sort(np.concatenate([best[alive], top], axis=1), axis=1)[:, -k:]
            lo[alive] = np.maximum(lo[alive], best[alive, 0])

        if len(queries) and len(self.x):
            visit(0, np.arange(len(queries)))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        query, row, score = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((self.uid[row], self.ids[row], -score, query))
        query, row, score = query[order], row[order], score[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        return query[rank < k], row[rank < k], score[rank < k]


@dataclass
class Root:
    """The tree's first node, the same for all tasks: split points, sibling ranges over all rows, the sample."""

    space: Space
    points: np.ndarray
    sample: np.ndarray
    sample_uid: np.ndarray
    sample_label: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    def first_bounds(self, queries, label, own, lo, hi, same: bool, k: int) -> np.ndarray:
        """Lower ends of windows, raised to the k-th best sampled row where the sample holds so many."""
        s = queries @ self.sample.T
        kin = label[:, None] == self.sample_label[None]
        ok = (kin if same else ~kin) & (s >= lo[:, None]) & (s <= hi[:, None]) & (own[:, None] != self.sample_uid[None])
        if s.shape[1] < k:
            return lo
        return np.maximum(lo, np.partition(np.where(ok, s, -np.inf), -k, axis=1)[:, -k])


def usable(vectors: DataFrame, key: str, vector: str, label: str, scale: float) -> DataFrame:
    """(id, label, v) of rows that take part; components become floor(scale * x)."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), v.alias("v"))
    rows = rows.filter(F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))))
    return rows.withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("double")))


def _fit(points: DataFrame) -> Root | None:
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n, dim, top = points.agg(F.count("*"), F.max(F.size("v")), F.max(norm)).first()
    if not n:
        return None
    if top >= 2.0**53:
        raise ValueError("scores beyond 2^53 are not exact; use a smaller scale")
    space = Space(max(dim, 1), top or 1.0)
    sample = points.orderBy(F.xxhash64("uid")).limit(SAMPLE).toArrow()
    x = _matrix(sample.column("v"), space.dim)
    cells = min(MAX_CELLS, -(-n // (BLOCK // 4)))
    return Root(space, x[far_points(space, x, cells)], x, sample.column("uid").to_numpy(), sample.column("label").to_numpy())


def _grow(points: DataFrame, root: Root) -> DataFrame:
    """Blocks of the tree: rows are dealt to the nearest split point of the root and ordered by the distance to it."""
    space = root.space

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = space.between(root.points, _matrix(batch.column("v"), space.dim))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(d.argmin(axis=0), pa.int32()), pa.array(d.min(axis=0))],
                                             [*batch.schema.names, "cell", "near"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            kept = table if kept is None else pa.concat_tables([kept, table])
            cell = kept.column("cell").to_numpy()
            cuts = np.flatnonzero(cell[1:] != cell[:-1]) + 1
            done = 0
            for end in [*cuts, len(cell)]:
                while end - done >= BLOCK or (end < len(cell) and end > done):
                    size = min(BLOCK, end - done)
                    yield block(kept.slice(done, size))
                    done += size
            kept = kept.slice(done)
        if kept is not None and kept.num_rows:
            yield block(kept)

    def block(rows: pa.Table) -> pa.RecordBatch:
        x, uid = _matrix(rows.column("v"), space.dim), rows.column("uid").to_numpy()
        tree = Tree.build(space, x, uid, rows.column("id").fill_null(NO_ID).to_numpy(), rows.column("label").to_numpy())
        d = space.between(root.points, x)
        columns = {
            "cell": pa.array([rows.column("cell")[0].as_py()], pa.int32()), "block": pa.array([uid[0]], pa.int64()),
            "root_low": pa.array([d.min(axis=1)]), "root_high": pa.array([d.max(axis=1)]),
            "uid": pa.array([tree.uid], pa.list_(pa.int64())), "ids": pa.array([tree.ids], pa.list_(pa.int64())),
            "labels": pa.array([tree.label], pa.list_(pa.int64())), "x": pa.array([tree.x.ravel()], pa.list_(pa.float64())),
        }
        for f in Tree.FIELDS:
            kind = pa.float64() if f in ("low", "high") else pa.int64()
            columns[f] = pa.array([getattr(tree, f)], pa.list_(kind))
        return pa.RecordBatch.from_pydict(columns)

    dealt = points.mapInArrow(lean(assign), "uid long, id long, label long, v array<double>, cell int, near double")
    dealt = dealt.withColumn("spread", F.xxhash64("uid"))
    dealt = dealt.repartitionByRange("cell", "near", "spread").sortWithinPartitions("cell", "near", "spread").drop("spread")
    nodes = ", ".join(f"{f} array<{'double' if f in ('low', 'high') else 'long'}>" for f in Tree.FIELDS)
    return dealt.mapInArrow(lean(build), "cell int, block long, root_low array<double>, root_high array<double>, uid array<long>, "
                                         f"ids array<long>, labels array<long>, x array<double>, {nodes}")


def _root_ranges(trees: DataFrame, root: Root) -> None:
    """Ranges of the root's split points over all rows of each cell: at most MAX_CELLS rows of as many numbers."""
    m = len(root.points)
    root.low, root.high = np.full((m, m), np.inf), np.full((m, m), -np.inf)
    spread = trees.select("cell", F.posexplode(F.arrays_zip("root_low", "root_high")).alias("i", "r"))
    for cell, i, low, high in spread.groupBy("cell", "i").agg(F.min("r.root_low"), F.max("r.root_high")).collect():
        root.low[i, cell], root.high[i, cell] = low, high


_QUERY = {"anchor": pa.int64(), "partner": pa.int64(), "label": pa.int64(), "lo": pa.float64(), "hi": pa.float64()}


def _search(queries: DataFrame, trees: DataFrame, root: Root, same: bool, k: int) -> DataFrame:
    """(anchor, partner, row, id, score, rank): the first `k` rows of the window of every query (anchor, partner, label, lo, hi, v).

    The root sends a query only to cells whose ranges meet its annulus. There, batches of queries
    and blocks of the tree meet in tiles of bounded size, so that neither a hot cell nor many queries
    fall into one task.
    """
    space = root.space

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                q = _matrix(batch.column("v"), space.dim)
                label, own, lo, hi = (batch.column(c).to_numpy() for c in ("label", "anchor", "lo", "hi"))
                lo = root.first_bounds(q, label, own, lo, hi, same, k)
                alive = survivors(space, *query_distances(space, q, root.points), lo, hi, root.low, root.high)
                for cell in np.flatnonzero(alive.any(axis=0)):
                    rows = np.flatnonzero(alive[:, cell])
                    columns = {c: batch.column(c).take(pa.array(rows)) for c in _QUERY} | {"lo": pa.array(lo[rows])}
                    yield pa.RecordBatch.from_pydict({
                        "cell": pa.array([cell], pa.int32()), "batch": pa.array([own[0]], pa.int64()),
                        **{c: pa.array([v.to_numpy()], pa.list_(_QUERY[c])) for c, v in columns.items()},
                        "v": pa.array([q[rows].ravel()], pa.list_(pa.float64()))})

    written = cut_lineage(queries.select(*_QUERY, "v"), "queries")
    # Few, full batches: what is read here is one row in a hundred.
    parts = max(1, -(-written.count() // (2 * BATCH)))
    lists = ", ".join(f"{c} array<{'double' if c in ('lo', 'hi') else 'long'}>" for c in _QUERY)
    batches = cut_lineage(written.coalesce(parts).mapInArrow(lean(route), f"cell int, batch long, {lists}, v array<double>"), "batches")

    blocks = trees.groupBy("cell").agg(F.ceil(F.count("*") / TILE_BLOCKS).cast("int").alias("slots"))
    lanes = batches.groupBy("cell").agg(F.ceil(F.count("*") / TILE_BATCHES).cast("int").alias("lanes"))
    sizes = F.broadcast(blocks.join(lanes, "cell"))  # at most MAX_CELLS rows
    left = trees.drop("root_low", "root_high").join(sizes, "cell").select(
        F.pmod(F.xxhash64("block"), F.col("slots")).cast("int").alias("slot"), F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)).alias("lane"),
        "cell", "uid", "ids", "labels", "x", *Tree.FIELDS)
    right = batches.join(sizes, "cell").select(
        F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"), F.pmod(F.xxhash64("batch", F.element_at("partner", 1)), F.col("lanes")).cast("int").alias("lane"),
        "cell", *_QUERY, "v")

    def tile(blocks: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        for b in range(blocks.num_rows):
            block = {c: blocks.column(c)[b].values.to_numpy() for c in ("uid", "ids", "labels", "x", *Tree.FIELDS)}
            tree = Tree(space, block["x"].reshape(-1, space.dim), block["uid"], block["ids"], block["labels"], block)
            for i in range(queries.num_rows):
                own = {c: queries.column(c)[i].values.to_numpy() for c in (*_QUERY, "v")}
                q, row, score = tree.search(own["v"].reshape(-1, space.dim), own["label"], own["anchor"], own["lo"], own["hi"], same, k)
                found.append((own["anchor"][q], own["partner"][q], tree.uid[row], tree.ids[row], score.astype(np.int64)))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 5
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["anchor", "partner", "row", "id", "score"])

    keys = ["cell", "slot", "lane"]
    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(tile, "anchor long, partner long, row long, id long, score long")
    by = Window.partitionBy("anchor", "partner").orderBy(F.desc("score"), "id", "row")
    return hits.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = EVERY,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low_share: tuple[int, int] = LOW_SHARE,
                   scale: float = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(scale * x); a score is the integer inner product of two rows. Anchors
    are the rows whose key is divisible by `every`. An anchor's positives are its best `positives`
    other rows of the same label; for each of them, the negatives are the best `negatives` rows of
    other labels whose score lies between `low_share` (a fraction) of the positive's and the positive's. Equal scores
    are ordered by key. Positives without a negative give no row.

    Rows with a null label, a null vector or a null or non-finite component take no part; an empty
    vector scores 0, and of vectors of unequal length the shorter ends with zeros. A row without key
    is no anchor and comes last among equal scores, with a null id. Every row is a row of its own,
    also if its key or all of it is repeated: a copy is a partner like any other, and repeated
    anchors each give their rows. Keys and labels must be 64-bit integers, keys below 2^63 - 1;
    raises if a score could pass 2^53. Other columns are not read, so their names cannot clash.

    All rows are in the tree and leaves compare integers, so the result is exact. The
    tree's root (split points from a sample of SAMPLE rows) deals rows to cells, a range sort cuts
    cells into blocks by the distance to the cell's split point, tasks grow each block's subtree. First all positives are
    searched, then the windows they give; both start from bounds that the sample proves.
    """
    share, whole = low_share
    rows = usable(vectors, key, vector, label, scale).withColumn("uid", F.monotonically_increasing_id())
    points = cut_lineage(rows.select("uid", "id", "label", "v"), "points")
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    root = _fit(points)
    if root is None:
        return vectors.sparkSession.createDataFrame([], out)
    trees = cut_lineage(_grow(points, root), "trees")
    _root_ranges(trees, root)

    anchors = points.filter(F.col("id") % every == 0)
    first = anchors.select(F.col("uid").alias("anchor"), F.lit(-1).cast("long").alias("partner"), "label",
                           F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi"), "v")
    found = _search(first, trees, root, True, positives).filter(F.col("score") >= 0)
    found = cut_lineage(found.select("anchor", F.col("row").alias("partner"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    least = F.expr(f"(positive_score * {share} + {whole - 1}) div {whole}")
    windows = found.join(anchors.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id"), "label", "v"), "anchor")
    second = windows.select("anchor", "partner", "label", least.cast("double").alias("lo"), F.col("positive_score").cast("double").alias("hi"), "v")
    hard = _search(second, trees, root, False, negatives)
    rows = hard.join(windows.select("anchor", "partner", "anchor_id", "positive_id", "positive_score"), ["anchor", "partner"])

    def shown(name: str):
        return F.when(F.col(name) != int(NO_ID), F.col(name))

    return rows.select("anchor_id", shown("positive_id").alias("positive_id"), "rank", shown("id").alias("negative_id"),
                       "positive_score", F.col("score").alias("negative_score"))
