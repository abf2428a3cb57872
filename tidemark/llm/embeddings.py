"""Near-duplicate vectors: signs of random hyperplanes in several tables, exact cosines, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage, lean
from tidemark.llm.components import connected_components

TABLES = 16
BITS = 16
THRESHOLD = 0.98
TILE = 256
SEED = 5


def _flagged(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(key, label, v, usable); rows may link if key and label are not null, the vector is all finite and not all zero."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(label).alias("label"), v.alias("v"), bad.alias("bad"))
    good = F.col("key").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.col("bad") & F.exists("v", lambda x: x != 0)
    return rows.withColumn("usable", F.coalesce(good, F.lit(False))).drop("bad")


def _planes(dim: int, tables: int, bits: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, tables * bits))


def sign_codes(vectors: np.ndarray, tables: int = TABLES, bits: int = BITS) -> np.ndarray:
    """One number a table for every vector: its side of each of the table's hyperplanes."""
    side = (vectors @ _planes(vectors.shape[1], tables, bits) > 0).reshape(len(vectors), tables, bits)
    return side @ (1 << np.arange(bits, dtype=np.int64))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _coded(classes: DataFrame, tables: int, bits: int) -> DataFrame:
    """Classes with their unit vector and codes; vectors are handled by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("v").offsets.to_numpy())
            for dim in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dim))
                v = _matrix(part.column("v"))
                v = v / np.abs(v).max(axis=1, keepdims=True)
                v = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
                codes = sign_codes(v, tables, bits)
                yield pa.RecordBatch.from_arrays([
                    part.column("node"), part.column("label"), part.column("n"), pa.array(np.full(len(v), dim), pa.int32()),
                    pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), int(dim)).cast(pa.list_(pa.float64())),
                    pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel()), tables).cast(pa.list_(pa.int64()))],
                    ["node", "label", "n", "dim", "v", "codes"])

    kind = classes.schema["label"].dataType.simpleString()
    return classes.mapInArrow(lean(run), f"node long, label {kind}, n long, dim int, v array<double>, codes array<bigint>")


def _tile_links(threshold: float):
    """Links of a tile: rows of one block against rows of the same or a later block of a bucket.

    A pair counts in the first table in which its codes agree, so that it counts once. What leaves is
    the number of linked vectors of each class and a spanning set of the links, not the pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            kept = table if kept is None else pa.concat_tables([kept, table])
            tile = np.stack([kept.column(c).to_numpy() for c in ("bucket", "low", "high")])
            change = np.flatnonzero((tile[:, 1:] != tile[:, :-1]).any(axis=0)) + 1
            if len(change):
                yield from links(kept.slice(0, change[-1]), np.r_[0, change])
                kept = kept.slice(change[-1])
        if kept is not None and kept.num_rows:
            yield from links(kept, np.array([0, kept.num_rows]))

    def links(rows: pa.Table, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks().to_batches()
        if not rows:
            return
        rows = rows[0]
        node, n, block, low, high, table = (rows.column(c).to_numpy() for c in ("node", "n", "block", "low", "high", "table"))
        codes = _matrix(rows.column("codes"))
        starts = rows.column("v").offsets.to_numpy()
        flat = rows.column("v").values.to_numpy()
        found = []
        for a, b in zip(edges[:-1], edges[1:]):
            if b - a < 2:
                continue
            v = flat[starts[a]:starts[b]].reshape(b - a, -1)
            one = np.flatnonzero(block[a:b] == low[a])
            two = np.flatnonzero(block[a:b] == high[a])
            near = v[one] @ v[two].T >= threshold
            if low[a] == high[a]:
                near &= one[:, None] < two[None, :]
            i, j = np.nonzero(near)
            i, j = one[i] + a, two[j] + a
            first = (codes[i, :table[a]] != codes[j, :table[a]]).all(axis=1)
            i, j = i[first], j[first]
            if not len(i):
                continue
            both, weight = np.r_[i, j], np.r_[n[j], n[i]]
            where, which = np.unique(both, return_inverse=True)
            counts = np.bincount(which, weight).astype(np.int64)
            # A vector's link to its smallest neighbour here, and the smallest neighbour's other links, span the tile.
            least = node[where].copy()
            while True:
                step = least.copy()
                np.minimum.at(step, which[:len(i)], least[which[len(i):]])
                np.minimum.at(step, which[len(i):], least[which[:len(i)]])
                if (step == least).all():
                    break
                least = step
            found.append((node[where], counts, least))
        if found:
            columns = [np.concatenate(x) for x in zip(*found)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["node", "links", "least"])

    return run


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 threshold: float = THRESHOLD, tables: int = TABLES, bits: int = BITS) -> DataFrame:
    """One row per vector: (key, n_links, component, kept).

    Vectors of one label (and dimension) link at a cosine of at least `threshold` in double
    precision, if they share a bucket in at least one table; at the default setting a pair just at
    the threshold is found with a chance above 0.998. Copies are collapsed first and counted with
    their number, so a common vector costs as much as a rare one. Buckets of more than TILE
    classes are cut into blocks, and pairs of blocks go to different tasks. Null labels, null, empty
    or zero vectors, vectors with null or non-finite components and rows without key link with
    nothing; a null key has a null component and is kept. A repeated key counts as another vector, so
    there is one row for every row. The key must be a 64-bit integer.
    """
    rows = _flagged(vectors, key, vector, label)
    usable = rows.filter("usable").drop("usable")
    classes = usable.groupBy("label", "v").agg(F.min("key").alias("node"), F.count("*").alias("n"))
    coded = cut_lineage(_coded(classes, tables, bits), "codes")

    table = F.posexplode("codes").alias("table", "code")
    where = coded.select("node", "label", "dim", table)
    shared = where.groupBy("label", "dim", "table", "code").agg(F.count("*").alias("size")).filter("size > 1")
    shared = shared.withColumn("bucket", F.xxhash64("label", "dim", "table", "code"))
    members = where.join(shared, ["label", "dim", "table", "code"]).select("node", "table", "bucket", "size")
    # Blocks of about TILE classes; every row goes to the tiles of its block with all others.
    blocks = F.ceil(F.col("size") / TILE).cast("int")
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), blocks.cast("long")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    members = members.select("node", "table", "bucket", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    tiles = members.join(coded.select("node", "n", "v", "codes"), "node")
    tiles = tiles.repartition("bucket", "table", "low", "high").sortWithinPartitions("bucket", "table", "low", "high")
    found = cut_lineage(tiles.mapInArrow(lean(_tile_links(threshold)), "node long, links long, least long"), "links")

    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    components = connected_components(found.select(F.col("node").alias("a"), F.col("least").alias("b")))
    summed = coded.select("node", "n").join(counts, "node", "left").join(components, "node", "left")
    summed = summed.select("node", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    by_class = classes.select("label", "v", "node").join(summed, "node").select("label", "v", "n_links", "component")
    linked = usable.join(by_class, ["label", "v"]).select("key", "n_links", "component")
    alone = rows.filter("NOT usable").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component"))
    return linked.unionByName(alone).select("key", "n_links", "component", F.col("key").eqNullSafe(F.col("component")).alias("kept"))
