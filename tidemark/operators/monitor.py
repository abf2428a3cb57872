"""Control monitoring and cost reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.compare import differs_ci, differs_num
from tidemark.functions.dates import day_text, ntz, seconds_between
from tidemark.functions.text import joined
from tidemark.operators.joins import join_diff, star_filter, union_all, within_lookback
from tidemark.operators.ordered import assign_ids, cap as newest, running_sum, top_n
from tidemark.sources.relations import active_only, log_range

LOG_ID = "monitor_log_id"
FIRST_ID = 10000


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constant columns in front."""
    return df.select(*[F.lit(v).alias(n) for n, v in values.items()], "*")


def extend(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Every column plus computed ones."""
    return df.select("*", *[c.alias(n) for n, c in columns.items()])


def derive_then_filter(df: DataFrame, columns: Mapping[str, Column], pred: Column) -> DataFrame:
    """Computed columns a predicate may name."""
    return df.withColumns(dict(columns)).filter(pred)


def monitor_data(g: DataFrame, c: DataFrame, p: DataFrame, ordered: bool = True) -> DataFrame:
    """Group x control x parameter along their keys.

    g(monitor_group_id, monitor_group_name), c(monitor_control_id, monitor_group_id,
    monitor_control_name), p(monitor_parameter_id, monitor_control_id, monitor_parameter_name,
    monitor_parameter_value). `ordered` sorts for display; joins downstream do without.
    """
    rows = p.join(c, "monitor_control_id").join(g, "monitor_group_id").select(
        "monitor_group_id", "monitor_group_name", "monitor_control_id", "monitor_control_name",
        "monitor_parameter_id", "monitor_parameter_name", "monitor_parameter_value")
    order = ["monitor_group_name", "monitor_control_name", "monitor_parameter_name", "monitor_parameter_id"]
    return rows.orderBy(*[F.col(c).asc_nulls_last() for c in order]) if ordered else rows


def _log(rows: DataFrame, now: datetime | str, start: int) -> DataFrame:
    columns = ["event_description", "event_result", "monitor_control_name", "monitor_parameter_name",
               "monitor_parameter_value"]
    numbered = assign_ids(rows.select(*columns), start, columns, LOG_ID)
    return numbered.withColumn("last_updated", ntz(now))


def param_drift(ref: DataFrame, actual: DataFrame, now: datetime | str, group: str | None = None,
                start: int = FIRST_ID) -> DataFrame:
    """Log rows for parameters whose actual value differs, ignoring case, from the expected one.

    actual(parameter_name, parameter_value). event_description holds the name, event_result the
    actual value. One join stands in for a lookup per parameter.
    """
    if group is not None:
        ref = ref.filter(F.col("monitor_group_name") == group)
    expected = ref.select(
        "monitor_control_name", F.upper("monitor_parameter_name").alias("monitor_parameter_name"),
        F.upper("monitor_parameter_value").alias("monitor_parameter_value"))
    found = actual.select(F.upper("parameter_name").alias("_name"), F.col("parameter_value").alias("event_result"))
    rows = join_diff(expected, found, {"monitor_parameter_name": "_name"},
                     differs_ci(F.col("event_result"), F.col("monitor_parameter_value")))
    return _log(rows.withColumn("event_description", F.col("monitor_parameter_name")), now, start)


def retention_drift(ref: DataFrame, dbs: DataFrame, now: datetime | str, group: str | None = None,
                    start: int = FIRST_ID) -> DataFrame:
    """Log rows for live databases(database_name, retention_time, deleted) kept for another time than expected."""
    if group is not None:
        ref = ref.filter(F.col("monitor_group_name") == group)
    live = active_only(dbs).select("database_name", "retention_time")
    rows = join_diff(ref, live, {"monitor_parameter_name": "database_name"},
                     differs_num(F.col("monitor_parameter_value"), F.col("retention_time")))
    rows = rows.withColumns({"event_description": F.col("database_name"),
                             "event_result": F.col("retention_time").cast("string")})
    return _log(rows, now, start)


ACTIVITY = ("start_time", "role_name", "database_name", "schema_name", "user_name", "query_text", "query_id")


def role_activity(log: DataFrame, role: str, start: datetime | str | None = None, end: datetime | str | None = None,
                  control_name: str = "", control_object: str = "") -> DataFrame:
    """Statements run under a role, all history or a time range, labelled with their control."""
    if start is not None and end is not None:
        log = log_range(log, "start_time", start, end)
    rows = log.filter(F.col("role_name") == role).select(*ACTIVITY)
    return with_constants(rows, {"control_name": control_name, "control_object": control_object})


def control_events(activity: DataFrame, ref: DataFrame, now: datetime | str, control: str | None = None,
                   parameter: str | None = None) -> DataFrame:
    """Activity inside the lookback (minutes, as text, e.g. '-60') its control is configured with."""
    rules = ref
    if control is not None:
        rules = rules.filter(F.col("monitor_control_name") == control)
    if parameter is not None:
        rules = rules.filter(F.col("monitor_parameter_name") == parameter)
    rules = rules.select("monitor_group_name", "monitor_control_name", "monitor_parameter_name", "monitor_parameter_value")
    return within_lookback(activity, rules, {"control_name": "monitor_control_name"}, now, "start_time",
                           "monitor_parameter_value")


def login_history(log: DataFrame, account: str, source_path: str = "login_history",
                  source_name: str = "login log") -> DataFrame:
    """Login log with the account-qualified user and its source."""
    return extend(log, {
        "object_name": joined(account, ".", F.col("user_name").cast("string")),
        "source_name": F.lit(source_name),
        "source_path": F.lit(source_path),
    })


def access_history(ah: DataFrame, qh: DataFrame, ordered: bool = True) -> DataFrame:
    """Object accesses with the statement behind them, newest first."""
    accessed = ["query_start_time", "direct_objects_accessed", "base_objects_accessed", "objects_modified"]
    rows = ah.select("query_id", *accessed).join(qh, "query_id").select(
        "query_text",
        joined(F.col("user_name"), F.col("role_name"), F.col("warehouse_name"), sep=" -> ").alias("user_info"),
        joined(joined(F.col("database_name"), F.col("schema_name"), sep="."), F.col("query_type"),
               F.col("execution_status"), sep=" -> ").alias("object_query"),
        *accessed, "query_id",
    )
    return rows.orderBy(F.col("query_start_time").desc_nulls_first(), "query_id") if ordered else rows


def daily_spend(metering: DataFrame, now: datetime | str, days_back: int = 1) -> DataFrame:
    """Credits per warehouse on the day `days_back` before `now`: warehouse_name, credits_used, spend_date.

    The day is a range on start_time, so it reaches the scan as a pushed filter.
    """
    day = F.date_sub(ntz(now).cast("date"), days_back)
    first, last = day.cast("timestamp_ntz"), F.date_add(day, 1).cast("timestamp_ntz")
    ranged = metering.filter((F.col("start_time") >= first) & (F.col("start_time") < last))
    return spend_by_day(ranged)


def spend_by_day(metering: DataFrame) -> DataFrame:
    """Credits per warehouse and day."""
    return (
        metering.withColumn("spend_date", day_text(F.col("start_time")))
        .groupBy("warehouse_name", "spend_date").agg(F.sum("credits_used").alias("credits_used"))
        .select("warehouse_name", "credits_used", "spend_date")
    )


def consolidate(spend: Mapping[str, DataFrame], now: datetime | str) -> DataFrame:
    """Spend history of several accounts, labelled, with load time."""
    return union_all([
        df.select(
            F.lit(account).alias("source_account"), "warehouse_name",
            F.col("credits_used").cast("decimal(18,6)").alias("credits_used"), "spend_date",
            F.col("last_updated").alias("source_last_updated"), ntz(now).alias("insert_timestamp"))
        for account, df in spend.items()
    ])


def next_runs(history: DataFrame, now: datetime | str, state: str = "SCHEDULED") -> DataFrame:
    """Seconds until each scheduled run, last completed first."""
    moment = ntz(now)
    return (
        history.filter(F.col("state") == state)
        .withColumn("next_run", seconds_between(moment, F.col("scheduled_time")))
        .orderBy(F.col("completed_time").desc_nulls_first(), "scheduled_time", "name")
        .select("next_run", "scheduled_time", moment.alias("current_timestamp"), "name", "state")
    )


def event_log(df: DataFrame, type: str, start: datetime | str, end: datetime | str, cap: int | None = 1000,
              ties: Sequence[str] = ("event_id",)) -> DataFrame:
    """Events of one type in a time range, the newest `cap` of them."""
    rows = log_range(df.filter(F.col("event_type") == type), "event_timestamp", start, end)
    return rows if cap is None else newest(rows, "event_timestamp", cap, ties)


def running_total(fact: DataFrame, dims: Sequence[tuple[DataFrame, Mapping[str, str], Column | None]],
                  part: Sequence[str], order: Sequence[str], col: str, alias: str = "list_running_sum",
                  n: int | None = None, rows_per_slice: int | None = None) -> DataFrame:
    """Star join with filtered dimensions and a running sum per `part`; `order` must be total.

    Dimensions are unique on their keys, so hot parts are looked for in the fact alone.
    """
    probe = fact if set(part) <= set(fact.columns) else None
    rows = running_sum(star_filter(fact, dims), part, order, col, alias, rows_per_slice, probe)
    return rows if n is None else top_n(rows, [*part, *order], n)
