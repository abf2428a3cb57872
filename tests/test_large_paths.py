"""Registered queries with the paths for large data forced: every key over 40 rows is cut, nothing is
broadcast, joins are skew-split, and rows are spread before they are numbered."""

import pytest

import oracle
from __spark_entry__ import oracle_sql, queries
from tidemark.operators import ordered

NAMES = (
    "scd2_effective_dating", "next_time", "row_numbers", "change_feed", "scd1_sync", "scd2_apply_now", "scd2_apply_source",
    "merge_clauses", "star_running_total", "full_outer_reconcile", "listagg_ordered", "rows_to_json", "surrogate_ids",
    "dq_suite", "tag_lineage", "param_drift", "control_events", "access_history", "clustered_write_report",
)
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
}


@pytest.fixture()
def large(spark, monkeypatch):
    monkeypatch.setattr(ordered, "ROWS_PER_SLICE", 40)
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", NAMES)
def test_query(large, sf_dir, name):
    con = oracle.connect(sf_dir)
    difference = oracle.compare(queries()[name](large, sf_dir), con, oracle_sql()[name])
    assert difference is None, difference


def test_many_slices_of_one_key(spark):
    """One key cut into more than 256 slices, a third of it copies of one row."""
    df = spark.range(6000).selectExpr("1 as k", "if(id % 3 = 0, 7, id) as t", "id % 3 = 0 as copy")
    numbered = ordered.row_numbers(df, ["k"], ["t"], rows_per_slice=20).collect()
    assert sorted(r["rn"] for r in numbered) == list(range(1, 6001))
    by_time = sorted(numbered, key=lambda r: r["rn"])
    assert [r["t"] for r in by_time] == sorted(r["t"] for r in by_time)


def test_compressible_hot_key_is_cut(spark, monkeypatch):
    """Rows decide, not bytes: a key whose rows compress to nothing is found all the same."""
    df = spark.range(20_000_000).selectExpr("1 as k", "1 as v")
    seen = []
    monkeypatch.setattr(ordered, "_identified", lambda d, label: seen.append(label) or d.limit(100).withColumn("_f", d.k).withColumn("_r", d.v))
    _, _, cut = ordered.with_slices(df, ["k"], ["v"])
    assert cut and seen
