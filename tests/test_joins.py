"""Joins and comparisons against their plain forms, NULLs included."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows
from tidemark.functions.compare import differs_ci, differs_num, rescale, to_schema
from tidemark.functions.text import before_mark, file_stamp, joined, plain_path, relative_path
from tidemark.operators import joins


@pytest.fixture(scope="module")
def left(spark):
    return spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (4, "e")], "k int, x string")


@pytest.fixture(scope="module")
def right(spark):
    return spark.createDataFrame([(1, "p"), (1, "q"), (3, "r"), (None, "s")], "k int, y string")


def test_reconcile_equals_full_outer(left, right):
    want = left.withColumnRenamed("k", "a").join(right.withColumnRenamed("k", "b"), F.col("a") == F.col("b"), "full_outer")
    got = joins.reconcile(left, right, ["k"])
    assert rows(got, "v_k", "v_x", "h_k", "h_y") == rows(want)
    assert {r.side: r["count"] for r in got.groupBy("side").count().collect()} == {"both": 4, "view": 3, "hist": 2}


def test_anti_follows_not_in(spark, left, right):
    keys = right.filter("k is not null")
    assert rows(joins.anti(left, keys, "k"), "x") == [("c",), ("e",)]
    assert rows(joins.anti(left, right, "k")) == []
    assert rows(joins.anti(left, right.limit(0), "k"), "x") == [("a",), ("b",), ("c",), ("d",), ("e",)]
    assert rows(joins.anti(left, right, "k", null_aware=False), "x") == [("c",), ("d",), ("e",)]


def test_semi_minus_new_rows(left, right):
    assert rows(joins.semi(left, right, "k"), "x") == [("a",), ("b",)]
    assert rows(joins.minus(left.select("k"), right.select("k"))) == [(2,), (4,)]
    assert rows(joins.new_rows(left, right, "k"), "x") == [("c",), ("e",)]


def test_lookup_code_raises_on_two_ids(spark, left):
    codes = spark.createDataFrame([("a", 10), ("b", 20)], "name string, id int")
    assert rows(joins.lookup_code(left, codes, "x", "name", "id"), "x", "id")[:3] == [("a", 10), ("b", 20), ("c", None)]
    twice = codes.unionByName(spark.createDataFrame([("a", 11)], "name string, id int"))
    with pytest.raises(PySparkException, match="more than one row"):
        joins.lookup_code(left, twice, "x", "name", "id").collect()


def test_cross_lookup_pairs_by_name(spark):
    tag = spark.createDataFrame([("T1", 1), ("T2", 2)], "tag string, tag_id int")
    obj = spark.createDataFrame([("O1", 7), ("O1", 8)], "obj string, obj_id int")
    asked = spark.createDataFrame([("T1", "O1"), ("T9", "O1")], "t string, o string")
    assert rows(joins.cross_lookup(asked, tag, obj, {"t": "tag"}, {"o": "obj"}), "tag_id", "obj_id") == [(1, 7), (1, 8)]


def test_comparisons(spark):
    df = spark.createDataFrame([("90", 90, "True"), ("91", 90, "FALSE"), ("x", 1, None)], "s string, n int, b string")
    got = [tuple(r) for r in df.select(differs_num(F.col("s"), F.col("n")), differs_ci(F.col("b"), F.lit("TRUE"))).collect()]
    assert got == [(False, False), (True, True), (None, None)]


def test_to_schema_modes(spark):
    df = spark.createDataFrame([("1", "2021-12-08 16:39:11.700"), ("x", None)], "a string, t string")
    schema = T.StructType().add("a", "integer").add("t", T.TimestampNTZType())
    assert [r.a for r in to_schema(df, schema, "null").collect()] == [1, None]
    assert [r._rejected for r in to_schema(df, schema, "reject").collect()] == [[], ["a"]]
    with pytest.raises(PySparkException):
        to_schema(df, schema).collect()
    with pytest.raises(ValueError):
        to_schema(df, schema, "other")


def test_rescale(spark):
    got = spark.range(1).select(rescale(F.lit("0.856"), 10, 2).alias("a"), rescale(F.lit("0.85"), 10, 2, True).alias("b")).first()
    assert (str(got.a), str(got.b)) == ("0.86", "1")


def test_text_helpers(spark):
    df = spark.createDataFrame([("content_test_20220115_130442.txt",), ("none",)], "n string")
    got = [tuple(r) for r in df.select(before_mark(F.col("n")), file_stamp(F.col("n")).cast("string")).collect()]
    assert got == [("content_test", "2022-01-15 13:04:42"), ("", None)]
    row = df.limit(1).select(
        plain_path(F.lit("file:///a/b")), relative_path("/a", F.lit("file:/a/b/c")), relative_path("/z", F.lit("/a/b")),
        joined("x", F.lit(None).cast("string")), joined("x", "y", sep="->")).first()
    assert tuple(row) == ("/a/b", "b/c", "/a/b", None, "x->y")
