"""Control monitoring and cost reports on small reference data."""

import pytest
from pyspark.sql import functions as F

from helpers import rows, typed
from tidemark.operators import monitor
from tidemark.operators.aggregates import distinct_counts, sum_by

NOW = "2022-01-02 12:00:00"


@pytest.fixture(scope="module")
def ref(spark):
    g = spark.createDataFrame([(10000, "ACCOUNT PARAMETER"), (10001, "TIME TRAVEL")], "monitor_group_id int, monitor_group_name string")
    c = spark.createDataFrame([(1, 10000, "AC1"), (2, 10000, "AC2"), (3, 10001, "TT1")], "monitor_control_id int, monitor_group_id int, monitor_control_name string")
    p = spark.createDataFrame(
        [(1, 2, "prevent_unload", "true"), (2, 2, "require_storage", "TRUE"), (3, 3, "MONITOR", "90"), (4, 3, "TEST", "90"), (5, 1, "ACCOUNTADMIN", "-60")],
        "monitor_parameter_id int, monitor_control_id int, monitor_parameter_name string, monitor_parameter_value string")
    return monitor.monitor_data(g, c, p)


def test_reference_data_is_ordered(ref):
    assert [r.monitor_parameter_name for r in ref.collect()] == ["ACCOUNTADMIN", "prevent_unload", "require_storage", "MONITOR", "TEST"]


def test_param_drift(spark, ref):
    actual = lambda v: spark.createDataFrame([("PREVENT_UNLOAD", v), ("require_storage", "True")], "parameter_name string, parameter_value string")
    assert monitor.param_drift(ref, actual("True"), NOW, "ACCOUNT PARAMETER").count() == 0
    got = monitor.param_drift(ref, actual("false"), NOW, "ACCOUNT PARAMETER")
    assert rows(got, "monitor_log_id", "event_description", "event_result", "monitor_parameter_value") == [(10000, "PREVENT_UNLOAD", "false", "TRUE")]


def test_retention_drift(spark, ref):
    dbs = spark.createDataFrame([("MONITOR", 90, None), ("TEST", 1, None), ("TEST", 2, "gone")], "database_name string, retention_time int, deleted string")
    got = monitor.retention_drift(ref, dbs, NOW, "TIME TRAVEL")
    assert rows(got, "event_description", "event_result", "monitor_parameter_value") == [("TEST", "1", "90")]


@pytest.fixture(scope="module")
def log(spark):
    data = [(f"2022-01-02 {h:02d}:30:00", role, "db", "s", "u", "q", i) for i, (h, role) in enumerate([(9, "ACCOUNTADMIN"), (11, "ACCOUNTADMIN"), (11, "X")])]
    data.append(("2021-12-01 00:00:00", "ACCOUNTADMIN", "db", "s", "u", "q", 9))
    return typed(spark, data, "start_time string, role_name string, database_name string, schema_name string, user_name string, query_text string, query_id int",
                 start_time="timestamp_ntz")


def test_role_activity_and_controls(ref, log):
    assert rows(monitor.role_activity(log, "ACCOUNTADMIN"), "query_id") == [(0,), (1,), (9,)]
    recent = monitor.role_activity(log, "ACCOUNTADMIN", "2022-01-01 12:00:00", NOW, "AC1", "v_ac1")
    assert rows(recent, "control_name", "query_id") == [("AC1", 0), ("AC1", 1)]
    events = monitor.control_events(recent, ref, NOW, "AC1", "ACCOUNTADMIN")
    assert rows(events, "query_id", "monitor_group_name") == [(1, "ACCOUNT PARAMETER")]


def test_spend(spark):
    data = [("A", 1.5, "2022-01-01 00:00:00"), ("A", 2.0, "2022-01-01 23:59:59"), ("B", 1.0, "2022-01-02 00:00:00"), ("B", 4.0, "2021-12-31 23:59:59")]
    metering = typed(spark, data, "warehouse_name string, credits_used double, start_time string", start_time="timestamp_ntz")
    spend = monitor.daily_spend(metering, NOW)
    assert rows(spend) == [("A", 3.5, "20220101")]
    hist = spend.withColumn("last_updated", F.lit(NOW).cast("timestamp_ntz"))
    got = monitor.consolidate({"A1": hist, "B2": hist}, NOW)
    assert rows(got, "source_account", F.col("credits_used").cast("double"), "spend_date") == [("A1", 3.5, "20220101"), ("B2", 3.5, "20220101")]


def test_next_runs(spark):
    data = [("a", "SCHEDULED", "2022-01-02 12:01:00", "2022-01-01 00:00:00"), ("b", "SUCCEEDED", "2022-01-02 12:02:00", None), ("c", "SCHEDULED", "2022-01-02 11:59:30", None)]
    history = typed(spark, data, "name string, state string, scheduled_time string, completed_time string", scheduled_time="timestamp_ntz", completed_time="timestamp_ntz")
    assert [(r.name, r.next_run) for r in monitor.next_runs(history, NOW).collect()] == [("c", -30), ("a", 60)]


def test_access_history_null_part(spark):
    ah = typed(spark, [(1, "2022-01-01 00:00:00", "d", "b", "m"), (2, "2022-01-02 00:00:00", "d", "b", "m")],
               "query_id int, query_start_time string, direct_objects_accessed string, base_objects_accessed string, objects_modified string", query_start_time="timestamp_ntz")
    qh = spark.createDataFrame([(1, "q1", "u", "r", "w", "db", "s", "SELECT", "OK"), (2, "q2", "u", None, "w", "db", "s", "SELECT", "OK")],
                               "query_id int, query_text string, user_name string, role_name string, warehouse_name string, database_name string, schema_name string, query_type string, execution_status string")
    got = [(r.query_id, r.user_info, r.object_query) for r in monitor.access_history(ah, qh).collect()]
    assert got == [(2, None, "db.s -> SELECT -> OK"), (1, "u -> r -> w", "db.s -> SELECT -> OK")]


def test_event_log_cap(spark):
    df = typed(spark, [("scim", f"2022-01-02 11:{m:02d}:00", m) for m in range(60)] + [("other", "2022-01-02 11:59:59", 99)],
               "event_type string, event_timestamp string, event_id int", event_timestamp="timestamp_ntz")
    got = monitor.event_log(df, "scim", "2022-01-02 11:00:00", NOW, cap=3)
    assert [r.event_id for r in got.collect()] == [59, 58, 57]


def test_running_total_hot_key(spark):
    """One order holds a third of the lines and is cut; the result equals the plain window."""
    fact = spark.range(600).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("o"), (F.col("id") % 7).alias("item"), F.col("id").alias("n"), F.lit(1).alias("price"))
    item = spark.range(7).select(F.col("id").alias("i"), F.concat(F.lit("item"), F.col("id").cast("string")).alias("name"))
    run = lambda per: rows(monitor.running_total(fact, [(item, {"item": "i"}, F.col("i") != 3)], ["o"], ["name", "n"], "price", rows_per_slice=per), "o", "name", "n", "list_running_sum")
    assert run(30) == run(None)


def test_sums_and_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("B", 3)], "k string, v int")
    assert rows(sum_by(df, {"up": F.upper("k")}, "v", "t")) == [("A", 3), ("B", 3)]
    assert rows(distinct_counts(df, ["k", "v"])) == [(2, 3)]
    assert rows(distinct_counts(df, ["k"], approx=True)) == [(2,)]
