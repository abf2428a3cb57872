"""Registered queries: projections, predicates, scalar functions, catalogue and one-row relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import dates, text
from tidemark.functions.compare import differs_ci, differs_num, rescale, to_schema
from tidemark.operators.enrich import as_relation, run_query
from tidemark.operators.joins import union_all
from tidemark.operators.layout import ctas
from tidemark.operators.monitor import derive_then_filter, extend, with_constants
from tidemark.plans.common import AS_OF, Registry, load
from tidemark.session import new_folder
from tidemark.sources.relations import active_only, catalog_columns, catalog_tables, full_scan, inline_rows, lit_row, log_range


def string_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of order clerks' file names; a negative length gives the empty string."""
    orders = load(spark, sf_dir, "orders")
    name = text.joined(F.lower("o_orderpriority"), "_", F.date_format("o_orderdate", "yyyyMMdd_HHmmss"), ".txt")
    plain = F.when(F.col("o_orderstatus") == "P", F.lower("o_orderpriority")).otherwise(name)
    return orders.select("o_orderkey", "o_orderstatus", plain.alias("file")).select(
        "o_orderkey", text.entity_of(F.col("file")).alias("entity"), text.file_stamp(F.col("file")).alias("stamp"),
        F.regexp_instr("file", F.lit("_20")).cast("long").alias("mark"), F.length("file").cast("long").alias("chars"),
        F.upper("file").alias("upper_name"), F.substring("file", F.lit(1), F.length("file") - 1).alias("trimmed"),
        F.concat(F.col("file"), F.when(F.col("o_orderstatus") == "F", "!")).alias("null_concat"),
    )


def date_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    at = F.col("o_orderdate")
    return orders.select(
        "o_orderkey",
        dates.add_time("HOUR", -1, at).alias("hour_before"), dates.add_time("MINUTE", 90, at).alias("later"),
        dates.add_time("DAY", -1, at).alias("day_before"), dates.seconds_between(at, dates.ntz(AS_OF)).alias("age"),
        F.year(at).cast("long").alias("y"), F.month(at).cast("long").alias("m"), F.dayofmonth(at).cast("long").alias("d"),
        F.to_date(dates.day_text(at), "yyyyMMdd").alias("day"), F.date_sub(at.cast("date"), 1).alias("yesterday"),
        F.date_format(dates.open_end(), "yyyy-MM-dd").alias("open_end"),
    )


def decimal_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part")
    ratio = F.col("p_size").cast("decimal(10,0)") / F.lit(50).cast("decimal(10,0)")
    return part.select(
        "p_partkey", rescale(ratio, 10, 2).cast("double").alias("probability"),
        rescale(ratio, 10, 2, reference_rounding=True).cast("double").alias("rounded"),
        F.col("p_retailprice").cast("decimal(18,6)").cast("double").alias("price"),
        F.col("p_partkey").cast("string").cast("decimal(38,0)").cast("long").alias("as_number"),
    )


def context_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Role and account are arguments and become constants of every row."""
    return extend(with_constants(load(spark, sf_dir, "supplier").select("s_suppkey"), {"role": "STEWARD", "account": "ACCOUNT_1"}), {
        "object_name": text.joined(F.col("account"), F.col("s_suppkey").cast("string"), sep="."),
        "has_user": F.length(F.current_user()) > 0,
    })


def project_filter_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    size = F.when(F.col("o_totalprice") >= 400000, "large").when(F.col("o_totalprice") >= 100000, "medium").otherwise("small")
    rows = extend(orders.filter(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM") & ~F.col("o_orderstatus").isin("P")
        & (F.col("o_orderdate") >= dates.ntz("1997-01-01 00:00:00")) & (F.col("o_custkey") != 7)
        & F.col("o_orderkey").isNotNull()), {"size": size})
    return rows.select("o_orderkey", "o_orderpriority", "size").orderBy(
        F.col("o_orderpriority").asc_nulls_last(), F.col("o_orderkey").desc_nulls_last())


def alias_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases used further right in the same list, then in a filter and a grouping."""
    lineitem = load(spark, sf_dir, "lineitem").select(F.col("l_quantity").cast("bigint").alias("qty"), "l_shipdate")
    chained = lineitem.selectExpr("qty * 2 AS twice", "twice + 1 AS odd", "date_format(l_shipdate, 'yyyy') AS ship_year")
    return derive_then_filter(chained, {"big": F.col("odd") > 50}, F.col("big")).groupBy("ship_year").agg(
        F.count(F.lit(1)).alias("n"), F.sum("odd").alias("total"))


def compare_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case-insensitive and text-against-number comparison; text that is no number compares as NULL."""
    orders = load(spark, sf_dir, "orders")
    number = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey").cast("string")).when(
        F.col("o_orderstatus") == "O", "90").otherwise("ninety")
    return orders.select(
        "o_orderkey", differs_num(number, F.col("o_custkey")).alias("number_differs"),
        differs_ci(F.lower("o_orderpriority"), F.lit("1-Urgent")).alias("text_differs"))


def typed_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns to types; what does not convert is named, not lost."""
    orders = load(spark, sf_dir, "orders")
    staged = orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(F.col("o_orderstatus") == "P", "pending").otherwise(F.col("o_custkey").cast("string")).alias("customer"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("ordered"))
    schema = T.StructType().add("id", "long").add("customer", "long").add("ordered", T.TimestampNTZType())
    rows = to_schema(staged, schema, "reject")
    return rows.select("id", "customer", "ordered", F.array_join("_rejected", ",").alias("rejected"))


def param_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named values and a table name as arguments, on the result of an earlier query."""
    orders = load(spark, sf_dir, "orders")
    as_relation(orders.filter(F.col("o_totalprice") > 100000), "last_result")
    return run_query(spark, "SELECT o_orderkey, o_orderstatus FROM IDENTIFIER(:rel) WHERE o_orderstatus = :status AND o_custkey <> :cust",
                     {"rel": "last_result", "status": "F", "cust": 7})


def active_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = load(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") > 40, dates.ntz(AS_OF)).alias("deleted"))
    return active_only(parts).select("p_partkey")


def q_log_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_range(load(spark, sf_dir, "events").select("event_id", "ts"), "ts", "2024-01-05 00:00:00", "2024-01-12 12:00:00")


def q_catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of a table but two, each with its number of values."""
    as_relation(load(spark, sf_dir, "orders"), "orders_catalogued")
    columns = catalog_columns(spark, "orders_catalogued", exclude=["O_ORDERKEY", "O_ORDERDATE"])
    table = full_scan(spark, "orders_catalogued")
    names = [r["column_name"] for r in columns.select("column_name").toLocalIterator()]
    counted = table.agg(*[F.count(n).alias(n) for n in names]).unpivot([], names, "column_name", "n")
    return columns.join(counted, "column_name").select("ordinal_position", "column_name", "data_type", "n")


def q_catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations whose name fits a pattern, each with its rows."""
    names = ("customer", "orders", "supplier")
    for t in names:
        as_relation(load(spark, sf_dir, t), f"listed_{t}")
    listed = catalog_tables(spark, types=["TEMPORARY"], pattern="listed_*")
    counts = union_all([full_scan(spark, f"listed_{t}").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(f"listed_{t}").alias("table_name"), "n") for t in names])
    return listed.select("table_name", "table_type").join(counts, "table_name")


def q_lit_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of constants when the data's answer differs from the expected one, none otherwise."""
    orders = as_relation(load(spark, sf_dir, "orders"), "lit_orders")
    top = orders.agg(F.upper(F.max("o_orderstatus")).alias("v")).scalar()
    hit = lit_row(spark, {"parameter": F.lit("STATUS"), "actual": top}, F.lit("X") != top)
    miss = lit_row(spark, {"parameter": F.lit("SAME"), "actual": top}, top != top)
    return hit.unionByName(miss)


def ctas_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CREATE TABLE AS SELECT and a full scan of the new table."""
    path = new_folder(spark, "ctas")
    name = "copy_" + path.rsplit("-", 1)[-1]
    ctas(load(spark, sf_dir, "supplier"), name, path=path)
    return full_scan(spark, name)


def inline_with_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal rows beside stored ones: events matched to labels given inline."""
    labels = inline_rows(spark, [("click", "aaa"), ("view", "bbb"), ("error", "ccc")], "event_type string, label string")
    return load(spark, sf_dir, "events").join(labels, "event_type").select("event_id", "label")


QUERIES: Registry = {
    "string_functions": (string_functions, """
WITH f AS (
  SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN lower(o_orderpriority)
         ELSE lower(o_orderpriority) || '_' || strftime(o_orderdate, '%Y%m%d_%H%M%S') || '.txt' END AS file FROM orders)
SELECT o_orderkey, CASE WHEN instr(file, '_20') > 0 THEN left(file, instr(file, '_20') - 1) ELSE '' END AS entity,
       try_strptime(nullif(regexp_extract(file, '_(20[0-9]{6}_[0-9]{6})', 1), ''), '%Y%m%d_%H%M%S') AS stamp,
       CAST(instr(file, '_20') AS BIGINT) AS mark, CAST(length(file) AS BIGINT) AS chars, upper(file) AS upper_name,
       left(file, length(file) - 1) AS trimmed, CASE WHEN o_orderstatus = 'F' THEN file || '!' END AS null_concat FROM f"""),
    "date_functions": (date_functions, f"""
SELECT o_orderkey, o_orderdate - INTERVAL 1 HOUR AS hour_before, o_orderdate + INTERVAL 90 MINUTE AS later,
       o_orderdate - INTERVAL 1 DAY AS day_before, date_diff('second', o_orderdate, TIMESTAMP '{AS_OF}') AS age,
       year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d, CAST(o_orderdate AS DATE) AS day,
       CAST(o_orderdate - INTERVAL 1 DAY AS DATE) AS yesterday, '9999-12-31' AS open_end FROM orders"""),
    "decimal_functions": (decimal_functions, """
SELECT p_partkey, CAST(CAST(p_size / 50.0 AS DECIMAL(10,2)) AS DOUBLE) AS probability,
       CAST(round(CAST(p_size / 50.0 AS DECIMAL(10,2)), 0) AS DOUBLE) AS rounded, p_retailprice AS price, p_partkey AS as_number FROM part"""),
    "context_columns": (context_columns, """
SELECT 'STEWARD' AS role, 'ACCOUNT_1' AS account, s_suppkey, 'ACCOUNT_1.' || s_suppkey AS object_name, true AS has_user FROM supplier"""),
    "project_filter_mix": (project_filter_mix, """
SELECT o_orderkey, o_orderpriority, CASE WHEN o_totalprice >= 400000 THEN 'large' WHEN o_totalprice >= 100000 THEN 'medium' ELSE 'small' END AS size
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND o_orderstatus NOT IN ('P')
  AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_custkey <> 7 AND o_orderkey IS NOT NULL ORDER BY o_orderpriority, o_orderkey DESC"""),
    "alias_reuse": (alias_reuse, """
SELECT strftime(l_shipdate, '%Y') AS ship_year, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT) * 2 + 1) AS BIGINT) AS total
FROM lineitem WHERE CAST(l_quantity AS BIGINT) * 2 + 1 > 50 GROUP BY 1"""),
    "compare_text": (compare_text, """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN false WHEN 'O' THEN o_custkey <> 90 END AS number_differs,
       upper(o_orderpriority) <> '1-URGENT' AS text_differs FROM orders"""),
    "typed_cast": (typed_cast, """
SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS customer, o_orderdate AS ordered,
       CASE WHEN o_orderstatus = 'P' THEN 'customer' ELSE '' END AS rejected FROM orders"""),
    "param_query": (param_query, """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F' AND o_custkey <> 7"""),
    "active_rows": (active_rows, "SELECT p_partkey FROM part WHERE NOT p_size > 40"),
    "log_range": (q_log_range, """
SELECT event_id, ts FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-12 12:00:00'"""),
    "catalog_columns": (q_catalog_columns, """
SELECT 2 AS ordinal_position, 'o_custkey' AS column_name, 'bigint' AS data_type, count(o_custkey) AS n FROM orders
UNION ALL SELECT 3, 'o_orderstatus', 'string', count(o_orderstatus) FROM orders
UNION ALL SELECT 4, 'o_totalprice', 'double', count(o_totalprice) FROM orders
UNION ALL SELECT 6, 'o_orderpriority', 'string', count(o_orderpriority) FROM orders"""),
    "catalog_tables": (q_catalog_tables, """
SELECT 'listed_customer' AS table_name, 'TEMPORARY' AS table_type, count(*) AS n FROM customer
UNION ALL SELECT 'listed_orders', 'TEMPORARY', count(*) FROM orders
UNION ALL SELECT 'listed_supplier', 'TEMPORARY', count(*) FROM supplier"""),
    "lit_row": (q_lit_row, "SELECT 'STATUS' AS parameter, upper(max(o_orderstatus)) AS actual FROM orders"),
    "ctas_copy": (ctas_copy, "SELECT * FROM supplier"),
    "inline_rows": (inline_with_ids, """
SELECT event_id, CASE event_type WHEN 'click' THEN 'aaa' WHEN 'view' THEN 'bbb' ELSE 'ccc' END AS label
FROM events WHERE event_type IN ('click', 'view', 'error')"""),
}
