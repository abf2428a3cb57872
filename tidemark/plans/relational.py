"""Registered queries: joins, set operations, aggregation, windows over star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import ntz
from tidemark.operators import joins
from tidemark.operators.aggregates import distinct_counts, json_per_group, rows_to_array, string_agg, sum_by
from tidemark.operators.monitor import running_total
from tidemark.operators.ordered import cap, top_n
from tidemark.operators.scd import scd2_classify
from tidemark.plans.common import (
    AS_OF, HISTORY, RUN_2, SNAPSHOTS, Registry, load, money, sql_time_text, with_time_text,
)
from tidemark.plans.history import CLOSE_NOW, KEY, classified_sql, history_inputs
from tidemark.session import cut_lineage

LINE = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,"
        " l_linestatus, l_shipdate").split(", ")


def inner_two_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer")
    return joins.inner(orders, customer, {"o_custkey": "c_custkey"}).select("o_orderkey", "c_name", "o_totalprice")


def inner_three_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, orders, customer = (load(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    rows = joins.star(lineitem, orders, customer, [{"l_orderkey": "o_orderkey"}, {"o_custkey": "c_custkey"}])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "o_orderdate", "c_name")


def inner_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts and daily error counts per user, joined on user and day."""
    events = load(spark, sf_dir, "events")
    days = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n_day"))
    errors = events.filter(F.col("event_type") == "error").groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n_error"))
    return joins.inner(days, errors, ["user_id", "day"])


def _star(spark: SparkSession, sf_dir: str):
    lineitem, orders, part = (load(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    fact = lineitem.withColumn("price", money("l_extendedprice"))
    dates = orders.select("o_orderkey", "o_orderdate")
    # The first six months of 2000, as a range that reaches the scan.
    chosen = (F.col("o_orderdate") >= ntz("2000-01-01")) & (F.col("o_orderdate") < ntz("2000-07-01"))
    items = part.select("p_partkey", "p_name")
    return fact, [(dates, {"l_orderkey": "o_orderkey"}, chosen), (items, {"l_partkey": "p_partkey"}, None)]


def star_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, dims = _star(spark, sf_dir)
    rows = running_total(fact, dims, ["l_orderkey"], ["p_name", *LINE[1:]], "price")
    return rows.select("l_orderkey", "p_name", "l_partkey", "l_linenumber", F.col("list_running_sum").cast("double").alias("list_running_sum"))


RUNNING = f"""
SELECT l_orderkey, p_name, l_partkey, l_linenumber,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) OVER (
         PARTITION BY l_orderkey ORDER BY p_name, {', '.join(LINE[1:])}
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS list_running_sum
FROM lineitem, orders, part
WHERE l_orderkey = o_orderkey AND l_partkey = p_partkey
  AND year(o_orderdate) IN (2000) AND month(o_orderdate) IN (1, 2, 3, 4, 5, 6)"""


def top_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as shown: the first 100 rows of the running total."""
    fact, dims = _star(spark, sf_dir)
    rows = running_total(fact, dims, ["l_orderkey"], ["p_name", *LINE[1:]], "price", n=100)
    return rows.select("l_orderkey", "p_name", F.col("list_running_sum").cast("double").alias("list_running_sum"))


def full_outer_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed, hist = history_inputs(spark, sf_dir)
    view = cut_lineage(scd2_classify(feed, hist, KEY, "now", RUN_2), "classified")
    view = view.select(KEY, "valid_from", "status", "dml_type")
    rows = joins.reconcile(view, hist.select(KEY, "valid_from", "status", "current_flag"), [KEY, "valid_from"])
    return with_time_text(rows, "v_valid_from", "h_valid_from")


RECONCILE = f"""WITH {SNAPSHOTS}, {HISTORY}, {classified_sql(CLOSE_NOW)}
SELECT v.o_orderkey AS v_o_orderkey, {sql_time_text('v.valid_from', 'v_valid_from')}, v.status AS v_status,
       v.dml_type AS v_dml_type, h.o_orderkey AS h_o_orderkey, {sql_time_text('h.valid_from', 'h_valid_from')},
       h.status AS h_status, h.current_flag AS h_current_flag,
       CASE WHEN h.o_orderkey IS NULL THEN 'view' WHEN v.o_orderkey IS NULL THEN 'hist' ELSE 'both' END AS side
FROM classified v FULL OUTER JOIN hist h ON v.o_orderkey = h.o_orderkey AND v.valid_from = h.valid_from"""


def cross_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order names a priority and a status; both are looked up by name."""
    orders = load(spark, sf_dir, "orders")
    priorities = orders.groupBy(F.col("o_orderpriority").alias("priority")).agg(F.min("o_orderkey").alias("priority_id"))
    statuses = orders.groupBy(F.col("o_orderstatus").alias("state")).agg(F.max("o_orderkey").alias("state_id"))
    rows = joins.cross_lookup(orders, priorities, statuses, {"o_orderpriority": "priority"}, {"o_orderstatus": "state"})
    return rows.select("o_orderkey", "priority_id", "state_id")


def scalar_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    codes = events.filter(F.col("event_type") != "view").groupBy(F.col("event_type").alias("code_name")).agg(
        F.min("event_id").alias("code_id"))
    return joins.lookup_code(events.select("event_id", "event_type"), codes, "event_type", "code_name", "code_id")


def theta_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, orders = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders")
    rows = joins.join_diff(lineitem, orders, {"l_orderkey": "o_orderkey"}, lineitem["l_linestatus"] != orders["o_orderstatus"])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", "o_orderstatus")


def interval_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event type looks back as many days as its name has letters."""
    events = load(spark, sf_dir, "events")
    rules = events.select(F.col("event_type").alias("rule")).distinct().withColumn(
        "lookback", F.concat(F.lit("-"), (F.length("rule") * 1440).cast("string")))
    return joins.within_lookback(events, rules, {"event_type": "rule"}, AS_OF, "ts", "lookback").select(
        "event_id", "event_type", "ts", "lookback")


def semi_in_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, orders = load(spark, sf_dir, "customer"), load(spark, sf_dir, "orders")
    big = orders.filter(F.col("o_totalprice") > 450000).select(F.col("o_custkey").alias("c_custkey"))
    return joins.semi(customer, big, "c_custkey").select("c_custkey", "c_name")


def anti_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, orders = load(spark, sf_dir, "customer"), load(spark, sf_dir, "orders")
    big = orders.filter(F.col("o_totalprice") > 450000).select(F.col("o_custkey").alias("c_custkey"))
    return joins.anti(customer, big, "c_custkey").select("c_custkey", "c_name")


def set_minus(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, orders = load(spark, sf_dir, "customer"), load(spark, sf_dir, "orders")
    return joins.minus(customer.select("c_custkey"), orders.filter(F.col("o_orderstatus") == "F").select("o_custkey"))


def union_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three branches by position, duplicates kept."""
    customer, supplier, orders = (load(spark, sf_dir, t) for t in ("customer", "supplier", "orders"))
    return joins.union_all([
        customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"), F.lit("customer").alias("kind")),
        supplier.select("s_suppkey", "s_acctbal", F.lit("supplier")),
        orders.select("o_custkey", "o_totalprice", F.lit("customer")),
    ])


def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.distinct(load(spark, sf_dir, "events"), ["user_id", "event_type"])


def q_sum_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = load(spark, sf_dir, "lineitem").withColumn("price", money("l_extendedprice"))
    return sum_by(lineitem, ["l_returnflag", "l_linestatus"], "price", "total").withColumn("total", F.col("total").cast("double"))


def sum_by_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").withColumn("price", money("o_totalprice"))
    rows = sum_by(orders, {"order_month": F.date_format("o_orderdate", "yyyyMM"), "urgent": F.col("o_orderpriority") == "1-URGENT"},
                  "price", "total")
    return rows.withColumn("total", F.col("total").cast("double"))


def q_distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_counts(load(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])


# Rows to a part; small, so that users of the test tables have several parts.
PART_ROWS = 20


def listagg_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of each user's events in order of time, PART_ROWS to a part."""
    return string_agg(load(spark, sf_dir, "events"), ["user_id"], "event_type", ",", ["ts", "event_id"], "types", PART_ROWS).select(
        "user_id", "part_no", "types")


def q_rows_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    arrays = rows_to_array(events, ["event_id"], ["user_id"], "objects", PART_ROWS)
    return arrays.select("user_id", "part_no", F.size("objects").cast("long").alias("n"), F.to_json("objects").alias("objects"))


def q_json_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_per_group(load(spark, sf_dir, "events"), ["user_id"], "event_type", "event_id", "last_events", 2)


def json_null_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of rows some of which have no name."""
    events = load(spark, sf_dir, "events").withColumn("name", F.when(F.col("event_type") != "error", F.col("event_type")))
    return json_per_group(events, ["user_id"], "name", "event_id", "last_events", 10)


def top_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return top_n(orders, [F.col("o_totalprice").desc(), "o_orderkey"], 100)


def capped_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap(load(spark, sf_dir, "events").select("event_id", "ts", "event_type"), "ts", 1000, ["event_id"])


QUERIES: Registry = {
    "inner_two_way": (inner_two_way, "SELECT o_orderkey, c_name, o_totalprice FROM orders, customer WHERE o_custkey = c_custkey"),
    "inner_three_way": (inner_three_way, """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, o_orderdate, c_name
FROM lineitem, orders, customer WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey"""),
    "inner_two_keys": (inner_two_keys, """
SELECT d.user_id, d.day, n_day, n_error
FROM (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n_day FROM events GROUP BY 1, 2) d
INNER JOIN (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n_error FROM events WHERE event_type = 'error' GROUP BY 1, 2) e
ON d.user_id = e.user_id AND d.day = e.day"""),
    "star_running_total": (star_running_total, RUNNING),
    "top_running_total": (top_running_total, f"""
SELECT l_orderkey, p_name, list_running_sum FROM (
  SELECT l_orderkey, p_name, {', '.join(LINE[1:])},
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) OVER (
           PARTITION BY l_orderkey ORDER BY p_name, {', '.join(LINE[1:])}
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS list_running_sum
  FROM lineitem, orders, part
  WHERE l_orderkey = o_orderkey AND l_partkey = p_partkey
    AND year(o_orderdate) IN (2000) AND month(o_orderdate) IN (1, 2, 3, 4, 5, 6))
ORDER BY l_orderkey, p_name, {', '.join(LINE[1:])} LIMIT 100"""),
    "full_outer_reconcile": (full_outer_reconcile, RECONCILE),
    "cross_lookup": (cross_lookup, """
SELECT o_orderkey, priority_id, state_id FROM orders
JOIN (SELECT o_orderpriority AS p, min(o_orderkey) AS priority_id FROM orders GROUP BY 1) ON p = o_orderpriority
JOIN (SELECT o_orderstatus AS s, max(o_orderkey) AS state_id FROM orders GROUP BY 1) ON s = o_orderstatus"""),
    "scalar_lookup": (scalar_lookup, """
SELECT event_id, event_type,
       (SELECT min(c.event_id) FROM events c WHERE c.event_type = e.event_type AND c.event_type <> 'view') AS code_id
FROM events e"""),
    "theta_drift": (theta_drift, """
SELECT l_orderkey, l_linenumber, l_partkey, l_linestatus, o_orderstatus
FROM lineitem, orders WHERE l_orderkey = o_orderkey AND l_linestatus <> o_orderstatus"""),
    "interval_lookback": (interval_lookback, f"""
SELECT event_id, event_type, ts, '-' || CAST(length(event_type) * 1440 AS VARCHAR) AS lookback FROM events
WHERE ts >= TIMESTAMP '{AS_OF}' - to_minutes(CAST(length(event_type) * 1440 AS BIGINT))"""),
    "semi_in_distinct": (semi_in_distinct, """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 450000)"""),
    "anti_not_in": (anti_not_in, """
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)"""),
    "set_minus_keys": (set_minus, """
SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'"""),
    "union_branches": (union_branches, """
SELECT c_custkey AS id, c_acctbal AS amount, 'customer' AS kind FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, 'supplier' FROM supplier
UNION ALL SELECT o_custkey, o_totalprice, 'customer' FROM orders"""),
    "distinct_rows": (distinct_rows, "SELECT DISTINCT user_id, event_type FROM events"),
    "sum_by_key": (q_sum_by, """
SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM lineitem GROUP BY 1, 2"""),
    "sum_by_derived": (sum_by_derived, """
SELECT strftime(o_orderdate, '%Y%m') AS order_month, o_orderpriority = '1-URGENT' AS urgent,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1, 2"""),
    "distinct_counts": (q_distinct_counts, """
SELECT count(DISTINCT l_partkey) AS count_l_partkey, count(DISTINCT l_suppkey) AS count_l_suppkey FROM lineitem"""),
    "listagg_ordered": (listagg_ordered, f"""
SELECT user_id, part_no, string_agg(event_type, ',' ORDER BY rn) AS types
FROM (SELECT *, CAST((rn - 1) // {PART_ROWS} AS INTEGER) AS part_no
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)) GROUP BY 1, 2"""),
    "rows_to_json": (q_rows_to_json, f"""
SELECT user_id, part_no, count(*) AS n,
       '[' || string_agg('{{"event_id":' || event_id || ',"event_type":"' || event_type || '"}}', ',' ORDER BY event_id) || ']' AS objects
FROM (SELECT *, CAST((row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // {PART_ROWS} AS INTEGER) AS part_no FROM events)
GROUP BY 1, 2"""),
    "json_per_group": (q_json_per_group, """
SELECT user_id, part_no, '{' || string_agg('"' || event_type || '":' || id, ',' ORDER BY event_type) || '}' AS last_events
FROM (SELECT user_id, event_type, id, CAST((row_number() OVER (PARTITION BY user_id ORDER BY event_type) - 1) // 2 AS INTEGER) AS part_no
      FROM (SELECT user_id, event_type, max(event_id) AS id FROM events GROUP BY 1, 2)) GROUP BY 1, 2"""),
    "json_null_names": (json_null_names, """
SELECT user_id, CAST(0 AS INTEGER) AS part_no, '{' || string_agg('"' || event_type || '":' || id, ',' ORDER BY event_type) || '}' AS last_events
FROM (SELECT user_id, event_type, max(event_id) AS id FROM events WHERE event_type <> 'error' GROUP BY 1, 2) GROUP BY 1"""),
    "top_orders": (top_orders, "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100"),
    "capped_log": (capped_log, "SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id LIMIT 1000"),
}
