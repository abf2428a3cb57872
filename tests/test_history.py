"""Change feeds and history: worked examples, edge cases, random tables."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import rows, typed
from tidemark.operators import dml
from tidemark.operators.changes import apply_feed, change_feed, has_changes
from tidemark.operators.layout import write_bucketed
from tidemark.operators.scd import (
    MISSING, NEW_ROW, UPDATE_CLOSES, UPDATE_OPENS, scd1_changes, scd1_feed, scd1_state, scd1_sync, scd2_apply, scd2_classify,
    split_stale,
)

T1, T2 = "2023-03-02 08:15:00", "2023-03-02 09:40:00"
NOW1, NOW2 = "2023-03-02 10:00:00", "2023-03-02 11:00:00"
END = "9999-12-31 00:00:00"
ROW = "id long, content string, last_updated string"
HIST = "id long, content string, valid_from timestamp_ntz, valid_to timestamp_ntz, current_flag string, decision string"


def table(spark, *data):
    return typed(spark, list(data), ROW, last_updated="timestamp_ntz")


def hist_rows(df):
    return [(r[0], r[1], str(r[2]), str(r[3]), r[4], r[5]) for r in rows(df)]


@pytest.fixture(scope="module")
def first(spark):
    return table(spark, (41, "red", T1), (42, "green", T1), (43, "blue", T1))


@pytest.fixture(scope="module")
def second(spark):
    return table(spark, (41, "rose", T2), (42, "green", T1), (44, "grey", T2))


def test_sync_and_feed(first, second):
    changes = scd1_changes(first, second, "id", "last_updated")
    assert rows(scd1_state(changes), "id", "content") == [(41, "rose"), (42, "green"), (44, "grey")]
    want = [(41, "red", "DELETE", True), (41, "rose", "INSERT", True), (43, "blue", "DELETE", False), (44, "grey", "INSERT", False)]
    assert rows(scd1_feed(changes), "id", "content", "action", "is_update") == want
    assert rows(change_feed(first, second, "id"), "id", "content", "action", "is_update") == want


@pytest.mark.parametrize("null_safe", [False, True])
def test_two_files_to_history(spark, first, second, null_safe):
    empty = spark.createDataFrame([], HIST)
    feed1 = scd1_feed(scd1_changes(dml.truncate(first), first, "id", "last_updated"))
    hist1 = scd2_apply(empty, scd2_classify(feed1, empty, "id", "now", NOW1), ["id", "content"], "now", NOW1, null_safe)
    feed2 = scd1_feed(scd1_changes(first, second, "id", "last_updated"))
    hist2 = scd2_apply(hist1, scd2_classify(feed2, hist1, "id", "now", NOW2), ["id", "content"], "now", NOW2, null_safe)
    assert hist_rows(hist2) == [
        (41, "red", NOW1, NOW2, "N", UPDATE_CLOSES), (41, "rose", NOW2, END, "Y", UPDATE_OPENS),
        (42, "green", NOW1, END, "Y", NEW_ROW), (43, "blue", NOW1, NOW2, "N", MISSING), (44, "grey", NOW2, END, "Y", NEW_ROW)]


def test_successor_form(spark, first, second):
    feed1 = scd1_feed(scd1_changes(dml.truncate(first), first, "id", "last_updated"))
    empty = spark.createDataFrame([], HIST)
    hist1 = scd2_apply(empty, scd2_classify(feed1, empty, "id", "successor", NOW1), ["id", "content"])
    feed2 = scd1_feed(scd1_changes(first, second, "id", "last_updated"))
    hist2 = scd2_apply(hist1, scd2_classify(feed2, hist1, "id", "successor", NOW2, close_code="U"), ["id", "content"])
    assert [r[:5] for r in hist_rows(hist2)] == [
        (41, "red", T1, T2, "N"), (41, "rose", T2, END, "Y"), (42, "green", T1, END, "Y"),
        (43, "blue", T1, NOW2, "N"), (44, "grey", T2, END, "Y")]


def test_apply_is_idempotent(spark, first):
    empty = spark.createDataFrame([], HIST)
    feed = scd1_feed(scd1_changes(dml.truncate(first), first, "id", "last_updated"))
    classified = scd2_classify(feed, empty, "id", "successor", NOW1)
    once = scd2_apply(empty, classified, ["id", "content"])
    assert hist_rows(scd2_apply(once, classified, ["id", "content"])) == hist_rows(once)


def test_null_content_closes_only_null_safe(spark):
    before, after = table(spark, (1, None, T1)), table(spark, (1, "x", T2))
    empty = spark.createDataFrame([], HIST)
    hist = scd2_apply(empty, scd2_classify(scd1_feed(scd1_changes(dml.truncate(before), before, "id", "last_updated")), empty, "id", "now", NOW1), ["id", "content"])
    classified = scd2_classify(scd1_feed(scd1_changes(before, after, "id", "last_updated")), hist, "id", "now", NOW2)
    flags = lambda null_safe: rows(scd2_apply(hist, classified, ["id", "content"], null_safe=null_safe), "content", "current_flag")
    assert flags(False) == [("x", "Y"), (None, "Y")]
    assert flags(True) == [("x", "Y"), (None, "N")]


def test_stale_update_is_split_off(spark, first):
    hist = first.selectExpr("id", "content", "last_updated valid_from", "timestamp_ntz'9999-12-31' valid_to", "'Y' current_flag", "'' decision")
    renamed = table(spark, (41, "NEW", T1), (42, "green", T1), (43, "GHX", T2))
    good, bad = split_stale(change_feed(first, renamed, "id"), hist, "id")
    assert rows(good, "id", "action") == [(43, "DELETE"), (43, "INSERT")]
    assert rows(bad, "id", "action") == [(41, "DELETE"), (41, "INSERT")]


@pytest.mark.parametrize("stage,want", [
    ([(1, "n", T2), (None, "z", T2)], [(1, "n"), (2, "b"), (None, "c")]),  # a NULL key suspends deletes
    ([(1, "n", T2)], [(1, "n"), (None, "c")]),                            # a NULL target key stays
    ([], []),                                                             # an empty stage deletes all
    ([(1, "n", None), (2, "q", T1)], [(1, "a"), (2, "b"), (None, "c")]),  # NULL or equal time: no update
])
def test_sync_null_rules(spark, stage, want):
    target = table(spark, (1, "a", T1), (2, "b", T1), (None, "c", T1))
    staged = table(spark, *stage)
    assert rows(scd1_sync(target, staged, "id", "last_updated"), "id", "content") == sorted(want, key=repr)


def test_delete_missing_rules(spark):
    target = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    keys = lambda *values: spark.createDataFrame([(v,) for v in values], "id int")
    assert rows(dml.delete_missing(target, keys(1), "id")) == [(1,), (None,)]
    assert rows(dml.delete_missing(target, keys(1, None), "id")) == [(1,), (2,), (None,)]
    assert rows(dml.delete_missing(target, keys(), "id")) == []
    assert rows(dml.delete_missing(target, keys(1), "id", null_aware=False)) == [(1,)]


def test_merge_clause_order_delete_and_insert(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], "id int, v string")
    src = spark.createDataFrame([(1, "x"), (2, "del"), (4, "new"), (5, "skip"), (None, "m")], "id int, v string")
    out = dml.merge(
        tgt, src, "id",
        matched=[(F.col("src.v") == "del", dml.DELETE), (None, {"v": F.concat("tgt.v", "src.v")})],
        not_matched=[(F.col("src.v") == "new", {"id": F.col("src.id"), "v": F.lit("first")}),
                     (F.col("src.v").isin("new", "m"), {"id": F.col("src.id"), "v": F.col("src.v")})])
    assert rows(out) == [(1, "ax"), (3, "c"), (4, "first"), (None, "m"), (None, "n")]


def test_merge_rejects_two_sources_for_one_target(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    src = spark.createDataFrame([(1, "x"), (1, "y"), (9, "p"), (9, "q")], "id int, v string")
    clause = [(None, {"v": F.col("src.v")})]
    with pytest.raises(PySparkException, match="several source rows"):
        dml.merge(tgt, src, "id", matched=clause).collect()
    insert = [(None, {"id": F.col("src.id"), "v": F.col("src.v")})]
    assert rows(dml.merge(tgt, src.filter("id = 9"), "id", clause, insert)) == [(1, "a"), (2, "b"), (9, "p"), (9, "q")]


def test_row_defaults_and_required_columns(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, v string")
    assert rows(dml.with_defaults(df, {"v": F.lit("d"), "w": F.lit(0)}, ["v"])) == [(1, "d", 0), (2, "x", 0)]
    with pytest.raises(PySparkException, match="required column v"):
        dml.with_defaults(df, {}, ["v"]).collect()


@pytest.mark.parametrize("seed", range(3))
def test_random_tables(spark, seed):
    """Feeds round-trip; history has one open row per live key and no overlaps."""
    rng = random.Random(seed)
    states, current = [], {}
    for step in range(3):
        for k in range(30):
            roll = rng.random()
            if roll < 0.3:
                current[k] = (rng.choice(["a", "b", None]), f"2022-01-0{step + 1} 00:00:{k:02d}")
            elif roll < 0.4:
                current.pop(k, None)
        states.append(table(spark, *[(k, c, t) for k, (c, t) in current.items()]))
    hist, prev = spark.createDataFrame([], HIST), dml.truncate(states[0])
    for step, state in enumerate(states):
        feed = change_feed(prev, state, "id")
        assert rows(apply_feed(prev, feed, "id")) == rows(state)
        assert not has_changes(change_feed(state, state, "id"))
        feed = scd1_feed(scd1_changes(prev, state, "id", "last_updated"))
        classified = scd2_classify(feed, hist, "id", "successor", f"2022-01-0{step + 1} 12:00:00")
        hist = spark.createDataFrame(scd2_apply(hist, classified, ["id", "content"], null_safe=True).collect(), HIST)
        prev = state
    history = {}
    for r in hist.collect():
        history.setdefault(r.id, []).append(r)
    live = {r.id: r.content for r in states[-1].collect()}
    for k, versions in history.items():
        versions.sort(key=lambda r: r.valid_from)
        opened = [r for r in versions if r.current_flag == "Y"]
        assert [r.content for r in opened] == ([live[k]] if k in live else [])
        assert all(a.valid_to <= b.valid_from for a, b in zip(versions, versions[1:]))
        assert all(r.valid_from < r.valid_to for r in versions)
    assert set(live) <= set(history)


def test_null_keys_stay_out_of_the_feed_join(spark):
    """Rows without identity are deleted and inserted one by one, not paired."""
    before, after = table(spark, (None, "a", T1), (None, "b", T1), (1, "x", T1)), table(spark, (None, "a", T1), (1, "x", T1))
    feed = change_feed(before, after, "id")
    assert rows(feed, "content", "action") == [("a", "DELETE"), ("a", "INSERT"), ("b", "DELETE")]
    assert rows(apply_feed(before, feed, "id")) == rows(after)


def test_bucketed_snapshots_join_without_a_shuffle(spark, first, second, tmp_path):
    for name, df in (("snap_1", first), ("snap_2", second)):
        write_bucketed(df, name, ["id"], 4, f"{tmp_path}/{name}")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    feed = change_feed(spark.table("snap_1"), spark.table("snap_2"), "id")
    plan = feed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert feed.count() == 4
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for name in ("snap_1", "snap_2"):
        spark.sql(f"DROP TABLE {name}")


def test_feed_checks_uniqueness(spark, first, second):
    twice = table(spark, (1, "a", T1), (1, "b", T1), (None, "c", T1), (None, "d", T1))
    assert change_feed(first, second, "id").count() == 4
    for before, after, side in ((first, twice, "current"), (twice, first, "previous")):
        with pytest.raises(PySparkException, match=f"{side} snapshot: key .*:1.* occurs more than once"):
            change_feed(before, after, "id").count()


def test_key_staged_twice_raises(spark, first):
    synced = scd1_sync(first, table(spark, (1, "a", T1), (1, "b", T1)), "id", "last_updated")
    with pytest.raises(PySparkException, match="stage: key .*:1.* occurs more than once"):
        synced.count()


def test_feed_and_sync_shuffle_each_side_once_and_run_nothing_when_built(spark, first, second, tmp_path):
    """One hash exchange and one sort a side, although keys are checked; no job before an action."""
    for name, df in (("before", first), ("after", second)):
        df.write.parquet(f"{tmp_path}/{name}")
    before, after = (spark.read.schema(first.schema).parquet(f"{tmp_path}/{name}") for name in ("before", "after"))
    context = spark.sparkContext
    context.setJobGroup("build-only", "no job expected")
    built = [change_feed(before, after, "id"), scd1_feed(scd1_changes(before, after, "id", "last_updated"))]
    assert list(context.statusTracker().getJobIdsForGroup("build-only")) == []
    context.setLocalProperty("spark.jobGroup.id", None)
    for feed in built:
        plan = feed._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Sort [") == 2 and "FullOuter" in plan
