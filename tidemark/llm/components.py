"""Connected components of an undirected graph, with edges and labels kept in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage

MAX_ROUNDS = 60


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node it reaches.

    Alternates two steps on the edge table until nothing changes: every node hangs its larger
    neighbours below its smallest one, then every node hangs all its neighbours there. Both keep
    the components and need a logarithmic number of rounds; each round is written to the shared
    folder, so a lost executor repeats one round at most. The smallest neighbour of a hot node is
    combined before the shuffle, and the join that follows may be split by adaptive execution.
    Edges with a null end and loops are ignored.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = now.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    now = cut_lineage(now, "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            joined.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        now = cut_lineage(small, "edges")
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
