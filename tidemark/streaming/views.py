"""Stored views kept up by the changes of their sources: counting rules in place of a rebuild."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.compare import equal_on
from tidemark.operators.changes import ACTION, INSERTED, IS_UPDATE
from tidemark.session import cut_lineage
from tidemark.streaming.buckets import BucketedTable

COUNT = "_count"


def signed(feed: DataFrame) -> DataFrame:
    """A change feed as a delta: rows with how often they come (1) or go (-1).

    Whatever works row by row (filters, new columns, explodes that keep the count) may follow: the
    view of a delta is the delta of the view.
    """
    return feed.withColumn(COUNT, F.when(F.col(ACTION) == INSERTED, 1).otherwise(-1).cast("long")).drop(ACTION, IS_UPDATE)


def counted(df: DataFrame) -> DataFrame:
    """All rows of a table as a delta, to fill a view."""
    return df.withColumn(COUNT, F.lit(1).cast("long"))


def join_delta(left: DataFrame, right_before: DataFrame, left_after: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delta of an inner join on `keys` from the deltas `left` and `right` of its sides.

    Changes of the left meet the right as it was, changes of the right the left as it is now, so a
    change of both sides counts once. Other columns must differ in name; a NULL key joins nothing.
    """
    def meet(a: DataFrame, b: DataFrame) -> DataFrame:
        own = [F.col(f"b.{c}") for c in b.columns if c not in (*keys, COUNT)]
        joined = a.alias("a").join(b.alias("b"), equal_on("a", "b", keys))
        return joined.select(*[F.col(f"a.{c}") for c in a.columns if c != COUNT], *own,
                             (F.col(f"a.{COUNT}") * F.col(f"b.{COUNT}")).alias(COUNT))

    return meet(left, counted(right_before)).unionByName(meet(counted(left_after), right))


class MaintainedView:
    """A multiset of rows, or sums and counts by group, below `path` in buckets of its grouping columns.

    `schema` names the columns; those in `sums` are added up by the others, without them the view holds
    rows and how often each occurs. A step reads and writes the buckets its delta touches. Sums are
    whole numbers or decimals, so that taking a row out again is exact; a NULL adds nothing, and a sum
    of NULLs alone is NULL, which a count of values beside each sum tells. Groups without rows go. A
    delta that takes out what the view does not have raises, since the feed does not fit the view.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, sums: Sequence[str] = (), buckets: int = 8):
        for name in sums:
            if not isinstance(schema[name].dataType, (T.DecimalType, T.IntegralType)):
                raise TypeError(f"{name} is {schema[name].dataType.simpleString()}: only exact numbers can be taken out of a sum")
        self.schema, self.sums = schema, list(sums)
        self.keys = [n for n in schema.names if n not in sums]
        self.counts = [f"_n_{s}" for s in sums]
        stored = T.StructType([*schema])
        for name in (COUNT, *self.counts):
            stored = stored.add(name, T.LongType())
        self.table = BucketedTable(spark, path, stored, self.keys, buckets)

    def step(self, delta: DataFrame, version: int) -> int:
        """Version `version + 1`: the view after `delta`; returns the number of buckets written."""
        n = F.col(COUNT)
        changes = [F.sum(n).alias(COUNT)]
        for s, c in zip(self.sums, self.counts):
            changes += [F.sum(F.coalesce(F.col(s) * n, F.lit(0))).cast(self.schema[s].dataType).alias(s),
                        F.sum(F.when(F.col(s).isNotNull(), n).otherwise(0)).alias(c)]
        # Few rows are left of a delta once it is added up; what cancels out touches nothing.
        net = delta.groupBy(*[F.col(k).cast(self.schema[k].dataType).alias(k) for k in self.keys]).agg(*changes)
        moved = F.col(COUNT) != 0
        for name in (*self.sums, *self.counts):
            moved = moved | (F.col(name) != 0)
        net = cut_lineage(net.filter(moved), "view-delta")
        touched = self.table.touched(net)
        names = [COUNT, *self.sums, *self.counts]
        both = self.table.read(version, touched).unionByName(net.select(*self.table.schema.names))
        after = both.groupBy(*self.keys).agg(
            *[F.sum(c).cast(self.table.schema[c].dataType).alias(c) for c in names])
        wrong = F.concat(F.lit("the view lacks rows that the delta takes out: "), F.to_json(F.struct(*self.keys)))
        checked = after.withColumn(COUNT, F.when(n < 0, F.raise_error(wrong).cast("long")).otherwise(n))
        self.table.write(checked.filter(n > 0), version + 1, version, touched)
        return len(touched)

    def read(self, version: int) -> DataFrame:
        """Rows as often as they occur; of a view with sums, its groups with their `_count`."""
        stored = self.table.read(version)
        if not self.sums:
            each = stored.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(COUNT).cast("int"))))
            return each.select(*self.schema.names)
        sums = [F.when(F.col(c) > 0, F.col(s)).alias(s) for s, c in zip(self.sums, self.counts)]
        return stored.select(*self.keys, *sums, COUNT)
