"""Registered queries: change feeds, type 1 and type 2 history, row changes, ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import ntz
from tidemark.operators import dml
from tidemark.operators.changes import apply_feed, change_feed, has_changes
from tidemark.operators.joins import feed_join, new_rows, union_all
from tidemark.operators.ordered import assign_ids, effective_dates, next_time, row_numbers
from tidemark.operators.quality import FIRST_ID, Check, run_checks
from tidemark.operators.scd import (
    MISSING, NEW_ROW, UPDATE_CLOSES, UPDATE_OPENS, scd1_changes, scd1_feed, scd1_sync, scd2_apply, scd2_classify,
    split_stale,
)
from tidemark.plans.common import (
    HISTORY, RUN_1, RUN_2, SNAPSHOTS, Registry, load, order_snapshots, seeded_history, sql_time_text, with_time_text,
)
from tidemark.session import cut_lineage, new_folder
from tidemark.streaming.appends import AppendLog, consume_into
from tidemark.streaming.history import append_typed
from tidemark.streaming.state import FeedState, Ledger, VersionedTable
from tidemark.streaming.views import COUNT, MaintainedView, counted, join_delta, signed

KEY = "o_orderkey"


def effective_dating(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return with_time_text(effective_dates(events, ["user_id"], "ts"), "valid_from", "valid_to")


EFFECTIVE = f"""
SELECT user_id, event_id, event_type, {sql_time_text('ts', 'valid_from')},
       {sql_time_text("coalesce(nxt, TIMESTAMP '9999-12-31')", 'valid_to')},
       CASE WHEN nxt IS NULL THEN 'Y' ELSE 'N' END AS current_flag
FROM (SELECT *, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts DESC) AS nxt FROM events)"""


def q_next_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    return next_time(events, ["user_id"], "ts")


def q_row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("event_type", "event_id", "ts")
    return row_numbers(events, ["event_type"], ["ts", "event_id"])


def q_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_feed(*order_snapshots(spark, sf_dir), KEY)


CHANGE_FEED = f"""WITH {SNAPSHOTS},
changed AS (
  SELECT p.o_orderkey FROM prev p JOIN curr c USING (o_orderkey)
  WHERE (p.status, p.price, p.last_updated) IS DISTINCT FROM (c.status, c.price, c.last_updated))
SELECT *, 'INSERT' AS action, false AS is_update FROM curr WHERE o_orderkey NOT IN (SELECT o_orderkey FROM prev)
UNION ALL SELECT *, 'DELETE', false FROM prev WHERE o_orderkey NOT IN (SELECT o_orderkey FROM curr)
UNION ALL SELECT *, 'DELETE', true FROM prev WHERE o_orderkey IN (SELECT o_orderkey FROM changed)
UNION ALL SELECT *, 'INSERT', true FROM curr WHERE o_orderkey IN (SELECT o_orderkey FROM changed)"""


def roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    prev, curr = order_snapshots(spark, sf_dir)
    return apply_feed(prev, cut_lineage(change_feed(prev, curr, KEY), "feed"), KEY)


def q_scd1_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd1_sync(*order_snapshots(spark, sf_dir), KEY, "last_updated")


SCD1 = f"""WITH {SNAPSHOTS}
SELECT c.o_orderkey,
       CASE WHEN p.last_updated = c.last_updated THEN p.status ELSE c.status END AS status,
       CASE WHEN p.last_updated = c.last_updated THEN p.price ELSE c.price END AS price,
       c.last_updated
FROM curr c LEFT JOIN prev p USING (o_orderkey)"""


def history_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    prev, curr = order_snapshots(spark, sf_dir)
    feed = cut_lineage(scd1_feed(scd1_changes(prev, curr, KEY, "last_updated")), "feed")
    return feed, seeded_history(prev)


def classify(close: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed, hist = history_inputs(spark, sf_dir)
        return with_time_text(scd2_classify(feed, hist, KEY, close, RUN_2), "valid_from", "valid_to")

    return query


def classified_sql(close_at: str) -> str:
    return f"""
ups AS (
  SELECT c.* FROM curr c JOIN prev p USING (o_orderkey) WHERE c.last_updated <> p.last_updated),
classified AS (
  SELECT '{NEW_ROW}' AS decision, o_orderkey, status, price, last_updated AS valid_from,
         TIMESTAMP '9999-12-31' AS valid_to, 'Y' AS current_flag, 'I' AS dml_type
  FROM curr WHERE o_orderkey NOT IN (SELECT o_orderkey FROM prev)
  UNION ALL
  SELECT '{UPDATE_OPENS}', o_orderkey, status, price, last_updated, TIMESTAMP '9999-12-31', 'Y', 'I' FROM ups
  UNION ALL
  SELECT '{UPDATE_CLOSES}', h.o_orderkey, h.status, h.price, h.valid_from, {close_at}, 'N', 'D'
  FROM hist h JOIN ups u USING (o_orderkey) WHERE h.current_flag = 'Y'
  UNION ALL
  SELECT '{MISSING}', p.o_orderkey, p.status, p.price, h.valid_from, TIMESTAMP '{RUN_2}', NULL, 'D'
  FROM prev p JOIN hist h ON h.o_orderkey = p.o_orderkey AND h.current_flag = 'Y'
  WHERE p.o_orderkey NOT IN (SELECT o_orderkey FROM curr))"""


CLOSE_NOW, CLOSE_NEXT = f"TIMESTAMP '{RUN_2}'", "u.last_updated"


def _classify_sql(close_at: str) -> str:
    return f"""WITH {SNAPSHOTS}, {HISTORY}, {classified_sql(close_at)}
SELECT decision, o_orderkey, status, price, {sql_time_text('valid_from', 'valid_from')},
       {sql_time_text('valid_to', 'valid_to')}, current_flag, dml_type FROM classified"""


def applied(close: str, valid_from: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed, hist = history_inputs(spark, sf_dir)
        rows = cut_lineage(scd2_classify(feed, hist, KEY, close, RUN_2), "classified")
        out = scd2_apply(hist, rows, [KEY, "status", "price"], valid_from, RUN_2)
        return with_time_text(out, "valid_from", "valid_to")

    return query


def _apply_sql(close_at: str, opened_at: str) -> str:
    return f"""WITH {SNAPSHOTS}, {HISTORY}, {classified_sql(close_at)},
merged AS (
  SELECT h.o_orderkey, h.status, h.price, h.valid_from, coalesce(c.valid_to, h.valid_to) AS valid_to,
         CASE WHEN c.dml_type IS NULL THEN h.current_flag ELSE 'N' END AS current_flag,
         coalesce(c.decision, h.decision) AS decision
  FROM hist h LEFT JOIN classified c ON c.dml_type = 'D' AND c.o_orderkey = h.o_orderkey AND c.status = h.status
       AND c.price = h.price AND c.valid_from = h.valid_from
  UNION ALL
  SELECT o_orderkey, status, price, {opened_at}, valid_to, current_flag, decision FROM classified WHERE dml_type = 'I')
SELECT o_orderkey, status, price, {sql_time_text('valid_from', 'valid_from')},
       {sql_time_text('valid_to', 'valid_to')}, current_flag, decision FROM merged"""


def stale_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates that would invert an interval: the corrected prices that kept their time stamp."""
    prev, curr = order_snapshots(spark, sf_dir)
    feed = cut_lineage(change_feed(prev, curr, KEY), "feed")
    return split_stale(feed, seeded_history(prev), KEY)[1]


STALE = f"""WITH {SNAPSHOTS},
same AS (
  SELECT p.o_orderkey FROM prev p JOIN curr c USING (o_orderkey)
  WHERE p.last_updated = c.last_updated AND (p.price <> c.price OR p.status <> c.status))
SELECT *, 'DELETE' AS action, true AS is_update FROM prev WHERE o_orderkey IN (SELECT o_orderkey FROM same)
UNION ALL SELECT *, 'INSERT', true FROM curr WHERE o_orderkey IN (SELECT o_orderkey FROM same)"""


def merge_clauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    totals = load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"), F.count(F.lit(1)).alias("n_orders"))
    totals = cut_lineage(totals, "totals")
    return dml.merge(
        customer.filter(F.col("c_acctbal") >= 0), totals, "c_custkey",
        matched=[
            (F.col("src.total") > 3000000, {"c_mktsegment": F.lit("GOLD"), "c_acctbal": F.col("tgt.c_acctbal") + 100}),
            (F.col("src.n_orders") <= 5, dml.DELETE),
        ],
        not_matched=[(F.col("src.total") > 1000000, {
            "c_custkey": F.col("src.c_custkey"), "c_acctbal": F.lit(0.0), "c_mktsegment": F.lit("NEW")})],
    )


MERGE = """
WITH tgt AS (SELECT c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal >= 0),
src AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total, count(*) AS n_orders FROM orders GROUP BY 1)
SELECT c_custkey, CASE WHEN total > 3000000 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal,
       CASE WHEN total > 3000000 THEN 'GOLD' ELSE c_mktsegment END AS c_mktsegment
FROM tgt LEFT JOIN src ON c_custkey = o_custkey
WHERE NOT coalesce(total <= 3000000 AND n_orders <= 5, false)
UNION ALL
SELECT o_custkey, 0.0::DOUBLE, 'NEW' FROM src
WHERE total > 1000000 AND o_custkey NOT IN (SELECT c_custkey FROM tgt)"""


def q_update_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load(spark, sf_dir, "customer")
    return dml.update_where(customer, F.col("c_acctbal") < 0, {"c_mktsegment": F.lit("REVIEW"), "c_acctbal": F.lit(0.0)})


def q_update_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    prev, curr = order_snapshots(spark, sf_dir)
    return dml.update_from(prev, curr, KEY, "last_updated")


UPDATE_FROM = f"""WITH {SNAPSHOTS}
SELECT p.o_orderkey,
       CASE WHEN c.last_updated <> p.last_updated THEN c.status ELSE p.status END AS status,
       CASE WHEN c.last_updated <> p.last_updated THEN c.price ELSE p.price END AS price,
       coalesce(c.last_updated, p.last_updated) AS last_updated
FROM prev p LEFT JOIN curr c USING (o_orderkey)"""


def q_delete_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dml.delete_where(load(spark, sf_dir, "customer"), (F.col("c_acctbal") < 0) & (F.col("c_mktsegment") == "BUILDING"))


def _order_keys(spark: SparkSession, sf_dir: str, with_nulls: bool) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    key = F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_custkey")) if with_nulls else F.col("o_custkey")
    return orders.filter(F.col("o_totalprice") > 400000).select(key.alias("c_custkey"))


def q_delete_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dml.delete_missing(load(spark, sf_dir, "customer"), _order_keys(spark, sf_dir, False), "c_custkey").select(
        "c_custkey", "c_name")


def delete_missing_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dml.delete_missing(load(spark, sf_dir, "customer"), _order_keys(spark, sf_dir, True), "c_custkey").select(
        "c_custkey", "c_name")


def q_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    prev, curr = order_snapshots(spark, sf_dir)
    return new_rows(curr, prev, KEY)


def insert_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts appended to a wider target: defaults fill columns the statement leaves out."""
    part = load(spark, sf_dir, "part")
    target = (
        T.StructType().add("p_partkey", "long").add("p_name", "string").add("price", "double")
        .add("state", "string").add("last_updated", T.TimestampNTZType()).add("note", "string"))
    rows = dml.with_defaults(
        part.select("p_partkey", "p_name", F.when(F.col("p_size") > 25, F.col("p_retailprice")).alias("price")),
        {"price": F.lit(0.0)}, not_null=["p_partkey", "price"])
    return dml.append_rows(target, rows, {"state": F.lit("N"), "last_updated": ntz(RUN_2)})


def truncate_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging cleared after one file and filled from the next."""
    prev, curr = order_snapshots(spark, sf_dir)
    return union_all([dml.truncate(prev), curr])


def affected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written by an append, counted while writing, beside the rows found afterwards."""
    path = new_folder(spark, "affected")
    rows = load(spark, sf_dir, "orders")
    counted, count = dml.run_counted(rows, "affected_rows")
    counted.write.parquet(path)
    written = count()
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("found")).withColumn(
        "written", F.lit(written).cast("long"))


def surrogate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return assign_ids(orders, 100000, ["o_custkey", "o_orderkey"], "order_sk")


def typed_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged text rows become typed rows with surrogate keys."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    text = orders.select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o_totalprice"))
    text = text.withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
    return append_typed(text, orders.schema, 100000, ["o_orderkey"], "test_load_id")


def sequence_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of typed rows; the second goes on where the first one's ids ended."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    log = AppendLog(spark, new_folder(spark, "sequence"))
    done = F.col("o_orderstatus") == "F"
    for rows, now in ((orders.filter(done), RUN_1), (orders.filter(~done), RUN_2)):
        log.append(lambda first, rows=rows: assign_ids(rows, first, ["o_orderkey"], "order_sk"), now, 100000)
    return log.read()


def two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs append to one table at a time; the one that finds its number taken numbers its rows anew."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    path, done = new_folder(spark, "writers"), F.col("o_orderstatus") == "F"
    one, two = (AppendLog(spark, path) for _ in range(2))
    beaten = []

    def slow(first: int) -> DataFrame:
        if not beaten:
            beaten.append(two.append(lambda f: assign_ids(orders.filter(~done), f, ["o_orderkey"], "order_sk"), RUN_1, 100000))
        return assign_ids(orders.filter(done), first, ["o_orderkey"], "order_sk")

    one.append(slow, RUN_2, 100000)
    return one.read().withColumn("loads", F.lit(two.version()).cast("long"))


def guarded_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job that runs only if its feed has changes: run, whether it ran, rows taken."""
    prev, curr = order_snapshots(spark, sf_dir)
    root = new_folder(spark, "guarded")
    table = VersionedTable(spark, f"{root}/orders", prev.schema)
    table.write(prev, 1)
    table.write(curr, 2)
    table.write(curr, 3)
    log = AppendLog(spark, f"{root}/changes")
    state, runs = FeedState(spark, table, log.ledger, KEY, log.name), []
    for run, latest in enumerate((1, 1, 2, 3, 3), 1):
        ran = has_changes(state.pending(latest))
        taken = consume_into(log, state, latest, lambda feed, first: feed.select(KEY, "action"), RUN_2) if ran else 0
        runs.append((run, ran, taken))
    return spark.createDataFrame(runs, "run long, ran boolean, taken long")


def dq_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of two order snapshots; exception ids go on from run to run."""
    snapshots = order_snapshots(spark, sf_dir)
    codes = spark.createDataFrame([(7, "ATTRIBUTE_IS_NULL")], "data_quality_exception_code_id long, data_quality_exception_code_name string")
    log = AppendLog(spark, new_folder(spark, "exceptions"))
    for rows, now in zip(snapshots, (RUN_1, RUN_2)):
        checked = rows.select(KEY, F.when(F.col("price") < 450000, F.col("price")).alias("price"), F.lit("Y").alias("current_flag"))
        log.append(lambda first, rows=checked, now=now: run_checks(rows, [Check("price", KEY, "orders")], codes, now, first), now, FIRST_ID)
    return log.read().select("data_quality_exception_id", "source_record_pk_value", "insert_timestamp")


def consume_into_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a table consumed into a change table, each once however often the step runs."""
    prev, curr = order_snapshots(spark, sf_dir)
    root = new_folder(spark, "consume")
    table = VersionedTable(spark, f"{root}/orders", prev.schema)
    table.write(prev, 1)
    table.write(curr, 2)
    log = AppendLog(spark, f"{root}/changes")
    state = FeedState(spark, table, log.ledger, KEY, log.name)
    for latest, now in ((1, RUN_1), (1, RUN_1), (2, RUN_2), (2, RUN_2)):
        consume_into(log, state, latest, lambda feed, first: feed.select(KEY, "status", "action"), now)
    return log.read()


def feed_with_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    prev, curr = order_snapshots(spark, sf_dir)
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return feed_join(change_feed(prev, curr, KEY), orders, KEY, ["o_custkey"])


def view_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders with their lines by status and return flag, kept up as both tables change at once."""
    exact = lambda c: F.col(c).cast("decimal(18,2)").alias(c)
    orders = [df.select(KEY, "status", exact("price")) for df in order_snapshots(spark, sf_dir)]
    lines = load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias(KEY), "l_linenumber", "l_returnflag", "l_discount", exact("l_quantity"))
    first = lines.filter(F.col("l_linenumber") <= 3).drop("l_discount")
    raised = F.when(F.col("l_returnflag") == "R", F.col("l_quantity") + 1).otherwise(F.col("l_quantity")).cast("decimal(18,2)")
    second = lines.filter(F.col("l_discount") > 0).drop("l_discount").withColumn("l_quantity", raised)
    # A row's key in a feed; copies of a line number within an order are one line here.
    keys = [KEY, "l_linenumber"]
    total = lambda df: df.groupBy(*keys).agg(F.min("l_returnflag").alias("l_returnflag"), F.sum("l_quantity").cast("decimal(18,2)").alias("l_quantity"))
    first, second = cut_lineage(total(first), "lines"), cut_lineage(total(second), "lines")
    schema = (
        T.StructType().add("status", "string").add("l_returnflag", "string")
        .add("price", T.DecimalType(28, 2)).add("l_quantity", T.DecimalType(28, 2)))
    view = MaintainedView(spark, new_folder(spark, "sum-view"), schema, ["price", "l_quantity"])
    live = lambda df: df.filter(F.col("status") != "F")
    none = dml.truncate(signed(change_feed(first, first, keys, check=False)))
    view.step(join_delta(counted(live(orders[0])), first, live(orders[0]), none, [KEY]), 0)
    moved = join_delta(live(signed(change_feed(*orders, KEY))), first, live(orders[1]), signed(change_feed(first, second, keys)), [KEY])
    view.step(moved, 1)
    return view.read(2).select(
        "status", "l_returnflag", *[F.col(c).cast("double").alias(c) for c in ("price", "l_quantity")], F.col(COUNT).alias("n"))


VIEW_DELTA = f"""WITH {SNAPSHOTS},
lines AS (
  SELECT l_orderkey AS o_orderkey, l_linenumber, min(l_returnflag) AS l_returnflag,
         sum(CAST(l_quantity AS DECIMAL(18,2)) + CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS l_quantity
  FROM lineitem WHERE l_discount > 0 GROUP BY ALL)
SELECT status, l_returnflag, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS price,
       CAST(sum(l_quantity) AS DOUBLE) AS l_quantity, count(*) AS n
FROM curr JOIN lines USING (o_orderkey) WHERE status <> 'F' GROUP BY status, l_returnflag"""


def feed_state_consume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of a feed leave its position; only a consuming step moves it."""
    prev, curr = order_snapshots(spark, sf_dir)
    root = new_folder(spark, "state")
    table = VersionedTable(spark, f"{root}/orders", prev.schema)
    table.write(prev, 1)
    table.write(curr, 2)
    state = FeedState(spark, table, Ledger(spark, f"{root}/ledger"), KEY)

    def step(name: str, feed: DataFrame) -> DataFrame:
        return cut_lineage(feed.groupBy().agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("step"), "rows"), "step")

    steps = [step("initial", state.pending(1)), step("read again", state.pending(1))]
    state.consume(1, RUN_2)
    steps.append(step("after first", state.pending(2)))
    state.consume(2, RUN_2)
    steps.append(step("after second", state.pending(2)))
    return union_all(steps)


FEED_STATE = f"""WITH {SNAPSHOTS},
changed AS (
  SELECT p.o_orderkey FROM prev p JOIN curr c USING (o_orderkey)
  WHERE (p.status, p.price, p.last_updated) IS DISTINCT FROM (c.status, c.price, c.last_updated)),
delta AS (
  SELECT (SELECT count(*) FROM curr WHERE o_orderkey NOT IN (SELECT o_orderkey FROM prev))
       + (SELECT count(*) FROM prev WHERE o_orderkey NOT IN (SELECT o_orderkey FROM curr))
       + 2 * (SELECT count(*) FROM changed) AS n)
SELECT 'initial' AS step, count(*) AS rows FROM prev
UNION ALL SELECT 'read again', count(*) FROM prev
UNION ALL SELECT 'after first', n FROM delta
UNION ALL SELECT 'after second', 0"""

QUERIES: Registry = {
    "scd2_effective_dating": (effective_dating, EFFECTIVE),
    "next_time": (q_next_time, """
SELECT user_id, event_id, ts, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts DESC) AS next_time FROM events"""),
    "row_numbers": (q_row_numbers, """
SELECT event_type, event_id, ts, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events"""),
    "change_feed": (q_change_feed, CHANGE_FEED),
    "view_delta": (view_delta, VIEW_DELTA),
    "change_feed_roundtrip": (roundtrip, f"WITH {SNAPSHOTS} SELECT * FROM curr"),
    "scd1_sync": (q_scd1_sync, SCD1),
    "scd2_classify_now": (classify("now"), _classify_sql(CLOSE_NOW)),
    "scd2_classify_successor": (classify("successor"), _classify_sql(CLOSE_NEXT)),
    "scd2_apply_now": (applied("now", "now"), _apply_sql(CLOSE_NOW, f"TIMESTAMP '{RUN_2}'")),
    "scd2_apply_source": (applied("successor", "source"), _apply_sql(CLOSE_NEXT, "valid_from")),
    "stale_updates": (stale_updates, STALE),
    "merge_clauses": (merge_clauses, MERGE),
    "update_where": (q_update_where, """
SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_acctbal < 0 THEN 'REVIEW' ELSE c_mktsegment END AS c_mktsegment FROM customer"""),
    "update_from": (q_update_from, UPDATE_FROM),
    "delete_where": (q_delete_where, "SELECT * FROM customer WHERE NOT (c_acctbal < 0 AND c_mktsegment = 'BUILDING')"),
    "delete_missing": (q_delete_missing, """
SELECT c_custkey, c_name FROM customer
WHERE NOT (c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000))"""),
    "delete_missing_nulls": (delete_missing_nulls, """
SELECT c_custkey, c_name FROM customer
WHERE NOT coalesce(c_custkey NOT IN (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END
                                     FROM orders WHERE o_totalprice > 400000), false)"""),
    "semi_in_minus": (q_new_rows, f"""WITH {SNAPSHOTS}
SELECT * FROM curr WHERE o_orderkey IN (SELECT o_orderkey FROM curr EXCEPT SELECT o_orderkey FROM prev)"""),
    "insert_defaults": (insert_defaults, f"""
SELECT p_partkey, p_name, CASE WHEN p_size > 25 THEN p_retailprice ELSE 0.0 END AS price, 'N' AS state,
       TIMESTAMP '{RUN_2}' AS last_updated, CAST(NULL AS VARCHAR) AS note FROM part"""),
    "truncate_reload": (truncate_reload, f"WITH {SNAPSHOTS} SELECT * FROM curr"),
    "affected_rows": (affected_rows, """
SELECT o_orderstatus, count(*) AS found, (SELECT count(*) FROM orders) AS written FROM orders GROUP BY 1"""),
    "surrogate_ids": (surrogate_ids, """
SELECT row_number() OVER (ORDER BY o_custkey, o_orderkey) + 99999 AS order_sk, o_orderkey, o_custkey, o_totalprice FROM orders"""),
    "typed_append": (typed_append, """
SELECT row_number() OVER (ORDER BY o_orderkey) + 99999 AS test_load_id, o_orderkey, o_orderdate, o_totalprice FROM orders"""),
    "feed_join": (feed_with_table, f"""
SELECT f.*, o_custkey FROM ({CHANGE_FEED}) f JOIN (SELECT o_orderkey AS k, o_custkey FROM orders) ON k = f.o_orderkey"""),
    "sequence_two_loads": (sequence_two_loads, """
SELECT row_number() OVER (ORDER BY o_orderstatus = 'F' DESC, o_orderkey) + 99999 AS order_sk, o_orderkey, o_custkey, o_orderstatus
FROM orders"""),
    "two_writers": (two_writers, """
SELECT row_number() OVER (ORDER BY o_orderstatus = 'F', o_orderkey) + 99999 AS order_sk, o_orderkey, o_custkey, o_orderstatus,
       CAST(2 AS BIGINT) AS loads FROM orders"""),
    "guarded_job": (guarded_job, f"""WITH {SNAPSHOTS},
differ AS (
  SELECT CAST(count(p.o_orderkey) + count(c.o_orderkey) AS BIGINT) AS n FROM prev p FULL JOIN curr c USING (o_orderkey)
  WHERE p.o_orderkey IS NULL OR c.o_orderkey IS NULL OR (p.status, p.price, p.last_updated) IS DISTINCT FROM (c.status, c.price, c.last_updated))
SELECT CAST(1 AS BIGINT) AS run, true AS ran, (SELECT count(*) FROM prev) AS taken
UNION ALL SELECT 2, false, 0 UNION ALL SELECT 3, true, (SELECT n FROM differ) UNION ALL SELECT 4, false, 0 UNION ALL SELECT 5, false, 0"""),
    "dq_two_runs": (dq_two_runs, f"""WITH {SNAPSHOTS},
runs AS (
  SELECT o_orderkey, TIMESTAMP '{RUN_1}' AS insert_timestamp FROM prev WHERE NOT price < 450000
  UNION ALL SELECT o_orderkey, TIMESTAMP '{RUN_2}' FROM curr WHERE NOT price < 450000)
SELECT row_number() OVER (ORDER BY insert_timestamp, CAST(o_orderkey AS VARCHAR)) + 9999 AS data_quality_exception_id,
       CAST(o_orderkey AS VARCHAR) AS source_record_pk_value, insert_timestamp FROM runs"""),
    "consume_into_table": (consume_into_table, f"""WITH {SNAPSHOTS}
SELECT o_orderkey, status, 'INSERT' AS action FROM prev
UNION ALL SELECT c.o_orderkey, c.status, 'INSERT' FROM curr c LEFT JOIN prev p USING (o_orderkey)
  WHERE p.o_orderkey IS NULL OR (p.status, p.price, p.last_updated) IS DISTINCT FROM (c.status, c.price, c.last_updated)
UNION ALL SELECT p.o_orderkey, p.status, 'DELETE' FROM prev p LEFT JOIN curr c USING (o_orderkey)
  WHERE c.o_orderkey IS NULL OR (p.status, p.price, p.last_updated) IS DISTINCT FROM (c.status, c.price, c.last_updated)"""),
    "feed_state_consume": (feed_state_consume, FEED_STATE),
}
