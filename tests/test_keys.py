"""The key index and rule totals against counting all rows of all loads."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import Check, check_keys, rule_counts
from tidemark.sources.files import delete_folder
from tidemark.streaming.keys import KeyIndex

KEY = T.StructType().add("a", T.LongType()).add("b", T.StringType())


def keyed(df):
    return {(r.a, r.b): (r.before, r.added) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_index_against_counts_of_all_loads(spark, tmp_path, seed):
    """NULL keys, keys repeated within and across loads, a hot key, an empty load; earlier loads are gone when later ones are checked."""
    rng = random.Random(seed)
    index, total = KeyIndex(spark, f"{tmp_path}/index", KEY, buckets=4), Counter()
    for number in range(4):
        rows = [] if number == 2 else [(rng.choice([None, *range(15)]), rng.choice([None, "x", "y"])) for _ in range(12)] + [(7, "hot")] * (number == 1) * 10
        path = f"{tmp_path}/load{number}"
        spark.createDataFrame(rows, KEY).withColumn("other", F.rand()).write.parquet(path)
        written = index.step(spark.read.parquet(path), number)
        delete_folder(spark, path)
        came = Counter(rows)
        broken = {k: (total[k], n) for k, n in came.items() if total[k] + n > 1}
        nulls = {k: (total[k], n) for k, n in came.items() if None in k}
        assert keyed(index.violations(number + 1)) == {**broken, **nulls}
        assert keyed(index.violations(number + 1, primary=False)) == {k: v for k, v in broken.items() if None not in k}
        assert (written == []) == (number == 2)
        total += came
    assert {(r.a, r.b): r._count for r in index.table.read(4).collect()} == dict(total)
    # What the second load has broken is still told after later ones.
    assert (7, "hot") in keyed(index.violations(2))


def test_small_load_reads_and_writes_its_buckets_alone(spark, tmp_path):
    index = KeyIndex(spark, f"{tmp_path}/index", T.StructType().add("id", T.LongType()), buckets=16)
    index.step(spark.range(2000), 0)
    assert len(index.step(spark.range(5, 6), 1)) == 1
    assert [tuple(r) for r in index.violations(2).collect()] == [(5, 1, 1)]
    assert len(index.violations(2).inputFiles()) <= 1
    assert sorted(v for v in index.table.manifest(2).values()) == [1] * 15 + [2]
    # A step that is run again makes the same version.
    index.step(spark.range(5, 6), 1)
    assert [tuple(r) for r in index.violations(2).collect()] == [(5, 1, 1)]


def test_missing_parents(spark, tmp_path):
    index = KeyIndex(spark, f"{tmp_path}/index", T.StructType().add("id", T.LongType()))
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (9,)], "id int")
    assert sorted(tuple(r) for r in index.missing(child, 0).collect()) == [(1, 2), (2, 1), (9, 1)]
    index.step(spark.range(2), 0)
    index.step(spark.range(2, 4), 1)
    assert sorted(tuple(r) for r in index.missing(child, 1).collect()) == [(2, 1), (9, 1)]
    got = {r.id: r.added for r in index.missing(child, 2).collect()}
    whole = check_keys(child, foreign=[(["id"], spark.range(4), ["id"])])
    assert got == {int(r.key): r.row_count for r in whole.collect()} == {9: 1}


def test_rule_counts(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, None)], "id int, v int")
    checks = [Check("v", "id", "t"), Check("v", "id", "t", code="LOW", fails=F.col("v") < 9)]
    count = lambda rows: sorted((r.code, r.rows, r.failed) for r in rule_counts(rows, checks).collect())
    assert count(df) == [("ATTRIBUTE_IS_NULL", 3, 2), ("LOW", 3, 1)]
    assert count(df.limit(0)) == [("ATTRIBUTE_IS_NULL", 0, 0), ("LOW", 0, 0)]
    with pytest.raises(ValueError, match="occurs twice"):
        rule_counts(df, [checks[0], checks[0]])
