"""Windows over hot keys, ids and layout agree with the plain forms."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import rows
from tidemark.operators.aggregates import json_per_group, rows_to_array, string_agg
from tidemark.operators.layout import clustering_report, write_clustered
from tidemark.operators.ordered import (
    assign_ids, cap, effective_dates, next_value, row_numbers, running_sum, sorted_by_range, top_n, with_slices,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on key 1, a NULL key, and values with NULLs; `n` is unique."""
    rng = random.Random(5)
    data = [(1 if i % 3 == 0 else rng.choice([2, 3, 4, None]), rng.randrange(50), i, rng.choice([None, 1, 2, 3]))
            for i in range(900)]
    return spark.createDataFrame(data, "k int, t int, n int, v int").repartition(8).cache()


def test_next_value_hot_key(skewed):
    w = Window.partitionBy("k").orderBy("t", "n")
    want = rows(skewed.withColumn("x", F.lead("t").over(w)))
    assert rows(next_value(skewed, ["k"], ["t", "n"], "t", "x", rows_per_slice=40)) == want
    assert rows(next_value(skewed, ["k"], ["t", "n"], "t", "x")) == want


def test_hot_key_is_cut(skewed):
    sliced, order, cut = with_slices(skewed, ["k"], ["t", "n"], rows_per_slice=40)
    assert cut and order[:2] == ["t", "n"]
    biggest = sliced.groupBy("k", "_slice").count().agg(F.max("count")).first()[0]
    assert biggest < 300 / 2
    assert sliced.count() == skewed.count()


def test_no_hot_key_means_plain_window(skewed):
    _, order, cut = with_slices(skewed, ["k"], ["t", "n"], rows_per_slice=10_000)
    assert not cut and order == ["t", "n"]


def test_running_sum_hot_key(skewed):
    w = Window.partitionBy("k").orderBy("t", "n").rowsBetween(Window.unboundedPreceding, 0)
    want = rows(skewed.withColumn("x", F.sum("v").over(w)))
    assert rows(running_sum(skewed, ["k"], ["t", "n"], "v", "x", rows_per_slice=40)) == want


def test_row_numbers_of_copies(spark):
    """All rows are copies of one row: still cut, and numbered 1..n once each."""
    copies = spark.range(500).select(F.lit(1).alias("k"), F.lit(7).alias("t"))
    numbered = row_numbers(copies, ["k"], ["t"], "rn", rows_per_slice=50)
    assert sorted(r.rn for r in numbered.collect()) == list(range(1, 501))


def test_effective_dates(spark):
    data = [(1, "a", 10), (1, "b", 20), (2, "c", 5)]
    df = spark.createDataFrame(data, "k int, c string, s int").select(
        "k", "c", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"))
    got = rows(effective_dates(df, ["k"], "ts"), "c", F.date_format("valid_to", "yyyy-MM-dd HH:mm:ss"), "current_flag")
    assert got == [("a", "1970-01-01 00:00:20", "N"), ("b", "9999-12-31 00:00:00", "Y"), ("c", "9999-12-31 00:00:00", "Y")]


@pytest.mark.parametrize("spread", [False, True])
def test_assign_ids_dense_and_ordered(skewed, spread):
    got = assign_ids(skewed, 100, ["t", "n"], "id", spread=spread).orderBy("id").collect()
    assert [r.id for r in got] == list(range(100, 1000))
    assert [(r.t, r.n) for r in got] == sorted((r.t, r.n) for r in got)


def test_assign_ids_any_order(skewed):
    assert sorted(r.id for r in assign_ids(skewed, 1).collect()) == list(range(1, 901))


def test_sorted_by_range_spreads_copies(spark):
    copies = spark.range(4000).select(F.lit(7).alias("t"))
    sizes = sorted_by_range(copies, ["t"], 8, spread=True).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 4 and max(r["count"] for r in sizes) < 2000


def test_top_n_and_cap(skewed):
    assert [r.n for r in top_n(skewed, ["n"], 3).collect()] == [0, 1, 2]
    assert rows(cap(skewed, "n", 2), "n") == [(898,), (899,)]


def test_string_agg_parts_join_to_the_whole(skewed):
    data = skewed.withColumn("s", F.col("n").cast("string"))
    whole = {r.k: r.text for r in string_agg(data, ["k"], "s", "-", ["t", "n"]).collect()}
    parts = string_agg(data, ["k"], "s", "-", ["t", "n"], part_rows=17, rows_per_slice=40).orderBy("part_no").collect()
    joined = {}
    for r in parts:
        joined.setdefault(r.k, []).append(r.text)
        assert r.text.count("-") < 17
    assert {k: "-".join(v) for k, v in joined.items()} == whole


def test_rows_to_array_without_keys(skewed):
    got = rows_to_array(skewed.select("n"), ["n"], part_rows=100).orderBy("part_no").collect()
    assert [x.n for r in got for x in r.rows] == list(range(900)) and len(got) == 9


def test_json_per_group(spark):
    df = spark.createDataFrame([("g", "b", 2), ("g", "a", 1), ("g", "a", 5), ("h", "q\"x", 3)], "g string, k string, v int")
    assert rows(json_per_group(df, ["g"], "k", "v"), "g", "part_no", "json") == [("g", 0, '{"a":5,"b":2}'), ("h", 0, '{"q\\"x":3}')]
    parts = rows(json_per_group(df, ["g"], "k", "v", part_rows=1), "g", "part_no", "json")
    assert parts == [("g", 0, '{"a":5}'), ("g", 1, '{"b":2}'), ("h", 0, '{"q\\"x":3}')]


def test_json_per_group_without_names(spark):
    df = spark.createDataFrame([("g", None, 2), ("g", "a", 1), ("g", "b", None), ("h", None, 3), (None, "c", 4)], "g string, k string, v int")
    assert rows(json_per_group(df, ["g"], "k", "v"), "g", "json") == [("g", '{"a":1,"b":null}'), (None, '{"c":4}')]


def _brute(intervals):
    n = len(intervals)
    overlaps = [sum(1 for j in range(n) if i != j and intervals[j][0] <= intervals[i][1] and intervals[j][1] >= intervals[i][0])
                for i in range(n)]
    depth = [sum(1 for lo, hi in intervals if lo <= intervals[i][0] <= hi) for i in range(n)]
    return round(sum(overlaps) / n, 4), round(sum(depth) / n, 4)


@pytest.mark.parametrize("seed", [1, 2])
def test_clustering_report_against_pairs(spark, tmp_path, seed):
    rng = random.Random(seed)
    intervals = []
    for i in range(7):
        lo = rng.randrange(20)
        hi = lo if i == 0 else lo + rng.randrange(8)
        intervals.append((lo, hi))
        spark.createDataFrame([(lo,), (hi,)], "x int").coalesce(1).write.mode("append").parquet(f"{tmp_path}/t")
    got = clustering_report(spark.read.parquet(f"{tmp_path}/t"), ["x"]).first()
    overlaps, depth = _brute(intervals)
    assert (got.total_files, got.average_overlaps, got.average_depth) == (7, overlaps, depth)
    assert got.constant_files == sum(1 for lo, hi in intervals if lo == hi)


def test_write_clustered_boolean_key_fills_all_files(spark, tmp_path):
    df = spark.range(2000).select(F.col("id"), (F.col("id") % 10).alias("cost"))
    write_clustered(df, ["cost > 4"], 8, f"{tmp_path}/c")
    written = spark.read.parquet(f"{tmp_path}/c")
    assert written.count() == 2000 and len(written.inputFiles()) == 8
    assert clustering_report(written, ["cost > 4"]).first().constant_files >= 7
