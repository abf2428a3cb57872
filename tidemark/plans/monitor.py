"""Registered queries: control monitoring, cost reports, log views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import ntz
from tidemark.operators import monitor
from tidemark.operators.enrich import as_relation, create_table_function
from tidemark.plans.common import AS_OF, Registry, load


def reference_data(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    """Regions as groups, nations as their controls, customers as the controls' parameters."""
    region, nation, customer = (load(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    groups = region.select(F.col("r_regionkey").alias("monitor_group_id"), F.col("r_name").alias("monitor_group_name"))
    controls = nation.select(
        F.col("n_nationkey").alias("monitor_control_id"), F.col("n_regionkey").alias("monitor_group_id"),
        F.col("n_name").alias("monitor_control_name"))
    parameters = customer.select(
        F.col("c_custkey").alias("monitor_parameter_id"), F.col("c_nationkey").alias("monitor_control_id"),
        F.col("c_name").alias("monitor_parameter_name"), F.col("c_mktsegment").alias("monitor_parameter_value"))
    return monitor.monitor_data(groups, controls, parameters, ordered)


REFERENCE = """
ref AS (
  SELECT r_regionkey AS monitor_group_id, r_name AS monitor_group_name, n_nationkey AS monitor_control_id,
         n_name AS monitor_control_name, c_custkey AS monitor_parameter_id, c_name AS monitor_parameter_name,
         c_mktsegment AS monitor_parameter_value
  FROM region, nation, customer WHERE r_regionkey = n_regionkey AND n_nationkey = c_nationkey)"""


def monitor_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference_data(spark, sf_dir, ordered=True)


def param_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load(spark, sf_dir, "customer")
    actual = customer.select(
        F.lower("c_name").alias("parameter_name"),
        F.when(F.col("c_acctbal") < 0, "Closed").otherwise(F.lower("c_mktsegment")).alias("parameter_value"))
    return monitor.param_drift(reference_data(spark, sf_dir), actual, AS_OF, "ASIA")


PARAM_DRIFT = f"""WITH {REFERENCE}
SELECT row_number() OVER (ORDER BY upper(c_name)) + 9999 AS monitor_log_id, upper(c_name) AS event_description,
       'Closed' AS event_result, monitor_control_name, upper(c_name) AS monitor_parameter_name,
       upper(monitor_parameter_value) AS monitor_parameter_value, TIMESTAMP '{AS_OF}' AS last_updated
FROM ref JOIN customer ON upper(c_name) = upper(monitor_parameter_name)
WHERE monitor_group_name = 'ASIA' AND c_acctbal < 0 AND upper('Closed') <> upper(monitor_parameter_value)"""


def retention_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as databases kept for as many days as they have orders; expected: ten days, as text."""
    orders = load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("retention_time"))
    databases = load(spark, sf_dir, "customer").join(orders, "c_custkey").select(
        F.col("c_name").alias("database_name"), "retention_time",
        F.when(F.col("c_acctbal") < 0, ntz(AS_OF)).alias("deleted"))
    ref = reference_data(spark, sf_dir).withColumn("monitor_parameter_value", F.lit("10"))
    return monitor.retention_drift(ref, databases, AS_OF, "EUROPE")


RETENTION_DRIFT = f"""WITH {REFERENCE},
dbs AS (SELECT c_name, c_acctbal, count(*) AS retention FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_name, c_acctbal)
SELECT row_number() OVER (ORDER BY c_name) + 9999 AS monitor_log_id, c_name AS event_description,
       CAST(retention AS VARCHAR) AS event_result, monitor_control_name, monitor_parameter_name, '10' AS monitor_parameter_value,
       TIMESTAMP '{AS_OF}' AS last_updated
FROM ref JOIN dbs ON c_name = monitor_parameter_name
WHERE monitor_group_name = 'EUROPE' AND c_acctbal >= 0 AND 10 <> retention"""


def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a statement log."""
    return load(spark, sf_dir, "events").select(
        F.col("ts").alias("start_time"), F.col("event_type").alias("role_name"), F.lit("DB").alias("database_name"),
        F.lit("PUBLIC").alias("schema_name"), F.concat(F.lit("USER_"), F.col("user_id").cast("string")).alias("user_name"),
        F.col("props").alias("query_text"), F.col("event_id").alias("query_id"))


LOG = """
log AS (
  SELECT ts AS start_time, event_type AS role_name, 'DB' AS database_name, 'PUBLIC' AS schema_name,
         'USER_' || user_id AS user_name, props AS query_text, event_id AS query_id FROM events)"""


def role_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.role_activity(query_log(spark, sf_dir), "error", control_name="AC1", control_object="monitor.v_ac1")


def role_activity_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.role_activity(query_log(spark, sf_dir), "error", "2024-01-30 00:00:00", AS_OF, "AC1", "monitor.v_rt_ac1")


def control_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity of each role inside its own lookback: a day per letter of the role name."""
    log = query_log(spark, sf_dir)
    activity = monitor.extend(log, {"control_name": F.concat(F.lit("AC_"), "role_name")})
    rules = log.select("role_name").distinct().select(
        F.lit("ACCOUNT PARAMETER").alias("monitor_group_name"), F.concat(F.lit("AC_"), "role_name").alias("monitor_control_name"),
        F.col("role_name").alias("monitor_parameter_name"),
        F.concat(F.lit("-"), (F.length("role_name") * 1440).cast("string")).alias("monitor_parameter_value"))
    rows = monitor.control_events(activity, rules, AS_OF)
    return rows.select("control_name", "start_time", "user_name", "query_id", "monitor_group_name",
                       "monitor_parameter_name", "monitor_parameter_value")


CONTROL_EVENTS = f"""WITH {LOG}
SELECT 'AC_' || role_name AS control_name, start_time, user_name, query_id, 'ACCOUNT PARAMETER' AS monitor_group_name,
       role_name AS monitor_parameter_name, '-' || CAST(length(role_name) * 1440 AS VARCHAR) AS monitor_parameter_value
FROM log WHERE start_time >= TIMESTAMP '{AS_OF}' - to_minutes(CAST(length(role_name) * 1440 AS BIGINT))"""


def login_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = load(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("USER_"), F.col("user_id").cast("string")).alias("user_name"))
    return monitor.login_history(log, "ACCOUNT_1", "events")


def access_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as object accesses, orders as the statements behind them."""
    lineitem, orders = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders")
    ah = lineitem.select(
        F.col("l_orderkey").alias("query_id"), F.col("l_shipdate").alias("query_start_time"),
        F.col("l_partkey").alias("direct_objects_accessed"), F.col("l_suppkey").alias("base_objects_accessed"),
        F.when(F.col("l_returnflag") == "R", F.col("l_linenumber")).alias("objects_modified"))
    qh = orders.select(
        F.col("o_orderkey").alias("query_id"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("query_text"),
        F.col("o_custkey").cast("string").alias("user_name"), F.col("o_orderpriority").alias("role_name"),
        F.lit("WH").alias("warehouse_name"), F.lit("DB").alias("database_name"), F.lit("PUBLIC").alias("schema_name"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("query_type"), F.lit("SUCCESS").alias("execution_status"))
    return monitor.access_history(ah, qh)


def metering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        F.col("event_type").alias("warehouse_name"), F.col("value").cast("decimal(18,6)").alias("credits_used"),
        F.col("ts").alias("start_time"))


def _double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def daily_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _double(monitor.daily_spend(metering(spark, sf_dir), AS_OF), "credits_used")


def spend_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _double(monitor.spend_by_day(metering(spark, sf_dir)), "credits_used")


def _spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.spend_by_day(metering(spark, sf_dir)).withColumn("last_updated", ntz(AS_OF))


def sql_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend history served by a table function without arguments."""
    as_relation(_spend(spark, sf_dir), "spend_history_rows")
    return _double(create_table_function(
        spark, "fn_get_spend",
        "warehouse_name STRING, credits_used DECIMAL(18,6), spend_date STRING, last_updated TIMESTAMP_NTZ",
        "SELECT warehouse_name, credits_used, spend_date, last_updated FROM spend_history_rows"), "credits_used")


def consolidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend of two accounts: events, and orders metered by priority."""
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("warehouse_name"), F.col("o_totalprice").cast("decimal(18,6)").alias("credits_used"),
        F.col("o_orderdate").alias("start_time"))
    spend = {
        "Provider Account A": _spend(spark, sf_dir),
        "Provider Account B": monitor.spend_by_day(orders).withColumn("last_updated", ntz(AS_OF)),
    }
    return _double(monitor.consolidate(spend, "2024-02-01 00:00:00"), "credits_used")


def next_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("name"),
        F.when(F.col("o_orderstatus") == "O", "SCHEDULED").otherwise("SUCCEEDED").alias("state"),
        F.col("o_orderdate").alias("scheduled_time"), F.col("o_orderdate").alias("completed_time"))
    return monitor.next_runs(history, "1998-01-01 12:30:00")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = load(spark, sf_dir, "events").withColumnRenamed("ts", "event_timestamp")
    return monitor.event_log(log, "click", "2024-01-10 00:00:00", "2024-01-20 00:00:00", cap=1000).select(
        "event_timestamp", "event_id", "event_type", "user_id", "props")


SPEND_BY_DAY = """
SELECT event_type AS warehouse_name, CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) AS credits_used,
       strftime(ts, '%Y%m%d') AS spend_date FROM events GROUP BY 1, 3"""

QUERIES: Registry = {
    "monitor_data": (monitor_data, f"WITH {REFERENCE} SELECT * FROM ref"),
    "param_drift": (param_drift, PARAM_DRIFT),
    "retention_drift": (retention_drift, RETENTION_DRIFT),
    "role_activity": (role_activity, f"""WITH {LOG}
SELECT 'AC1' AS control_name, 'monitor.v_ac1' AS control_object, * FROM log WHERE role_name = 'error'"""),
    "role_activity_recent": (role_activity_recent, f"""WITH {LOG}
SELECT 'AC1' AS control_name, 'monitor.v_rt_ac1' AS control_object, * FROM log
WHERE role_name = 'error' AND start_time BETWEEN TIMESTAMP '2024-01-30 00:00:00' AND TIMESTAMP '{AS_OF}'"""),
    "control_events": (control_events, CONTROL_EVENTS),
    "login_history": (login_history, """
SELECT event_id, 'USER_' || user_id AS user_name, 'ACCOUNT_1.USER_' || user_id AS object_name,
       'login log' AS source_name, 'events' AS source_path FROM events"""),
    "access_history": (access_history, """
SELECT 'order ' || o_orderkey AS query_text, o_custkey || ' -> ' || o_orderpriority || ' -> WH' AS user_info,
       'DB.PUBLIC -> ' || CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END || ' -> SUCCESS' AS object_query,
       l_shipdate AS query_start_time, l_partkey AS direct_objects_accessed, l_suppkey AS base_objects_accessed,
       CASE WHEN l_returnflag = 'R' THEN l_linenumber END AS objects_modified, l_orderkey AS query_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "daily_spend": (daily_spend, f"SELECT * FROM ({SPEND_BY_DAY}) WHERE spend_date = '20240130'"),
    "spend_by_day": (spend_by_day, SPEND_BY_DAY),
    "sql_table_function": (sql_table_function, f"SELECT *, TIMESTAMP '{AS_OF}' AS last_updated FROM ({SPEND_BY_DAY})"),
    "consolidate": (consolidate, f"""
SELECT 'Provider Account A' AS source_account, *, TIMESTAMP '{AS_OF}' AS source_last_updated,
       TIMESTAMP '2024-02-01 00:00:00' AS insert_timestamp FROM ({SPEND_BY_DAY})
UNION ALL
SELECT 'Provider Account B', o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,6))) AS DOUBLE), strftime(o_orderdate, '%Y%m%d'),
       TIMESTAMP '{AS_OF}', TIMESTAMP '2024-02-01 00:00:00' FROM orders GROUP BY 2, 4"""),
    "next_runs": (next_runs, """
SELECT date_diff('second', TIMESTAMP '1998-01-01 12:30:00', o_orderdate) AS next_run, o_orderdate AS scheduled_time,
       TIMESTAMP '1998-01-01 12:30:00' AS "current_timestamp", CAST(o_orderkey AS VARCHAR) AS name, 'SCHEDULED' AS state
FROM orders WHERE o_orderstatus = 'O'"""),
    "event_log": (event_log, """
SELECT ts AS event_timestamp, event_id, event_type, user_id, props FROM events
WHERE event_type = 'click' AND ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'
ORDER BY ts DESC, event_id LIMIT 1000"""),
}
