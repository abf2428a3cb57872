"""Views kept up by deltas against views built anew."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows
from tidemark.operators.changes import change_feed
from tidemark.streaming.views import COUNT, MaintainedView, counted, join_delta, signed

LEFT, RIGHT = "id long, k long, a string, x long", "rid long, k long, b string"


def test_random_join_sums_and_rows(spark, tmp_path):
    """Both sides change in one step; NULL keys, groups and values included."""
    rng = random.Random(5)
    pick = lambda *v: rng.choice(v)
    left = {i: (pick(1, 2, 3, None), pick("p", "q", None), pick(1, 5, None)) for i in range(12)}
    right = {i: (pick(1, 2, 3, None), pick("s", None)) for i in range(6)}
    frames = lambda: (spark.createDataFrame([(i, *v) for i, v in left.items()], LEFT), spark.createDataFrame([(i, *v) for i, v in right.items()], RIGHT))
    sums = MaintainedView(spark, f"{tmp_path}/sums", T.StructType().add("a", "string").add("b", "string").add("x", "long"), ["x"], 4)
    flat = MaintainedView(spark, f"{tmp_path}/flat", T.StructType().add("a", "string").add("b", "string"), buckets=4)
    before = tuple(df.limit(0) for df in frames())
    for version in range(3):
        after = frames()
        moved = [signed(change_feed(p, c, key)) for p, c, key in zip(before, after, ("id", "rid"))]
        delta = join_delta(moved[0], before[1], after[0], moved[1], ["k"])
        sums.step(delta, version)
        flat.step(delta, version)
        want = after[0].join(after[1], "k")
        assert rows(sums.read(version + 1), "a", "b", "x", COUNT) == rows(
            want.groupBy("a", "b").agg(F.sum("x").alias("x"), F.count("*").alias(COUNT)))
        assert rows(flat.read(version + 1)) == rows(want, "a", "b")
        before = after
        for i in range(0, 12, 3):
            left[i] = (pick(1, 2, 3), pick("p", "q"), pick(None, 7))
        left.pop(version + 1, None)
        right[version] = (pick(1, 2), "t")


def test_views_refuse_what_does_not_fit(spark, tmp_path):
    schema = T.StructType().add("a", "string")
    view = MaintainedView(spark, f"{tmp_path}/v", schema, buckets=4)
    row = spark.createDataFrame([("x",)], schema)
    assert view.step(counted(row.union(row)), 0) == 1 and view.read(1).count() == 2
    # What cancels out touches nothing.
    assert view.step(counted(row).union(row.withColumn(COUNT, F.lit(-1).cast("long"))), 1) == 0 and view.read(2).count() == 2
    with pytest.raises(Exception, match="lacks rows"):
        view.step(row.withColumn(COUNT, F.lit(-3).cast("long")), 2)
    with pytest.raises(TypeError, match="exact numbers"):
        MaintainedView(spark, f"{tmp_path}/w", T.StructType().add("a", "string").add("x", "double"), ["x"])
