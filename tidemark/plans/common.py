"""Inputs shared by the registered queries, in Spark and in oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import open_end
from tidemark.operators.scd import NEW_ROW, UPDATE_CLOSES

Query = Callable[[SparkSession, str], DataFrame]
Registry = dict[str, tuple[Query, str | None]]

# The reports' current time.
AS_OF = "2024-01-31 00:00:00"
# Day between the two order snapshots.
CUTOFF = "2001-01-01"
# Times of the first and second history run.
RUN_1, RUN_2 = "2024-01-01 06:00:00", "2024-01-02 06:00:00"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def time_text(column: str) -> Column:
    """Microsecond text of a time, for columns that hold the open end."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


def sql_time_text(expression: str, alias: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f') AS {alias}"


def with_time_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.select([time_text(c) if c in columns else F.col(c) for c in df.columns])


def money(column: str | Column) -> Column:
    """Exact sums need a decimal; results go back to double."""
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(18,2)")


def order_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as of the cutoff, and the later table: new orders added, finished low-priority ones
    archived, urgent pending ones finished, some prices corrected without a new time stamp."""
    orders = load(spark, sf_dir, "orders")
    before = F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp_ntz")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    finished = (status == "P") & (priority == "1-URGENT")
    archived = before & (status == "F") & (priority == "5-LOW")
    prev = orders.filter(before).select(
        "o_orderkey", status.alias("status"), F.col("o_totalprice").alias("price"), F.col("o_orderdate").alias("last_updated"))
    curr = orders.filter(~archived).select(
        "o_orderkey",
        F.when(finished, "F").otherwise(status).alias("status"),
        F.when((status == "O") & (priority == "2-HIGH"), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("price"),
        F.when(finished, F.date_add(F.col("o_orderdate").cast("date"), 30).cast("timestamp_ntz"))
        .otherwise(F.col("o_orderdate")).alias("last_updated"),
    )
    return prev, curr


SNAPSHOTS = f"""
prev AS (
  SELECT o_orderkey, o_orderstatus AS status, o_totalprice AS price, o_orderdate AS last_updated
  FROM orders WHERE o_orderdate < TIMESTAMP '{CUTOFF}'),
curr AS (
  SELECT o_orderkey,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'F' ELSE o_orderstatus END AS status,
         CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '2-HIGH' THEN o_totalprice + 1 ELSE o_totalprice END AS price,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN o_orderdate + INTERVAL 30 DAY
              ELSE o_orderdate END AS last_updated
  FROM orders
  WHERE NOT (o_orderdate < TIMESTAMP '{CUTOFF}' AND o_orderstatus = 'F' AND o_orderpriority = '5-LOW'))"""


def seeded_history(prev: DataFrame) -> DataFrame:
    """History matching the first snapshot: an open row per order, and a closed one for status O."""
    opened = prev.select(
        "o_orderkey", "status", "price", F.col("last_updated").alias("valid_from"), open_end().alias("valid_to"),
        F.lit("Y").alias("current_flag"), F.lit(NEW_ROW).alias("decision"))
    closed = prev.filter(F.col("status") == "O").select(
        "o_orderkey", F.lit("P").alias("status"), "price",
        F.date_sub(F.col("last_updated").cast("date"), 10).cast("timestamp_ntz").alias("valid_from"),
        F.col("last_updated").alias("valid_to"), F.lit("N").alias("current_flag"), F.lit(UPDATE_CLOSES).alias("decision"))
    return opened.unionByName(closed)


HISTORY = f"""
hist AS (
  SELECT o_orderkey, status, price, last_updated AS valid_from, TIMESTAMP '9999-12-31' AS valid_to,
         'Y' AS current_flag, '{NEW_ROW}' AS decision FROM prev
  UNION ALL
  SELECT o_orderkey, 'P', price, last_updated - INTERVAL 10 DAY, last_updated, 'N', '{UPDATE_CLOSES}'
  FROM prev WHERE status = 'O')"""
