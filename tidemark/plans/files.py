"""Registered queries: file scans, loads, listings, streams and file-driven jobs.

Each writes rows of a given table to new folders below the shared folder and works on those files.
"""

from __future__ import annotations

import datetime
import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text
from tidemark.operators.enrich import enrich_files, external_function
from tidemark.operators.joins import union_all
from tidemark.operators.layout import column_reports, file_spans, report_path, with_z_rank, write_by_value, write_clustered, write_z_ordered
from tidemark.operators.monitor import daily_spend
from tidemark.operators.nested import json_path, nested_view
from tidemark.operators.quality import Check, run_checks
from tidemark.operators.scd import MISSING, NEW_ROW, UPDATE_CLOSES, UPDATE_OPENS
from tidemark.plans.common import AS_OF, CUTOFF, RUN_1, RUN_2, SNAPSHOTS, Registry, load, order_snapshots, sql_time_text, with_time_text
from tidemark.plans.history import KEY
from tidemark.plans.nested import PAGE, PARAM, NESTED, page_documents
from tidemark.session import new_folder
from tidemark.sources import delimited, files
from tidemark.sources.relations import read_json_variant
from tidemark.streaming import files as feeds
from tidemark.streaming.appends import AppendLog, copy_new
from tidemark.streaming.history import Entity, HistoryStore, run_pipeline
from tidemark.streaming.manifest import Manifest

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def event_files(spark: SparkSession, sf_dir: str, fmt: delimited.DelimitedFormat = delimited.COMMA,
                by_type: bool = False) -> tuple[DataFrame, str]:
    events = load(spark, sf_dir, "events")
    folder = new_folder(spark, "events-csv")
    if by_type:
        rows = events.withColumn("kind", F.col("event_type"))
        (rows.write.partitionBy("kind").option("sep", fmt.sep).option("header", "true").option("escape", '"')
         .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(folder))
    else:
        delimited.unload(events, folder, fmt)
    return events, folder


def delimited_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, folder = event_files(spark, sf_dir, delimited.PIPE)
    return delimited.read_delimited(spark, folder, events.schema, delimited.PIPE)


def line_break_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with line breaks, quotes and separators, unloaded and read back."""
    documents = load(spark, sf_dir, "documents")
    fmt = delimited.PIPE.override(line_breaks=True, null_tokens=("\\N",), empty_as_null=False)
    folder = new_folder(spark, "line-breaks")
    delimited.unload(documents, folder, fmt)
    return delimited.read_delimited(spark, folder, documents.schema, fmt)


def null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling of NULL in a file: two tokens, an empty field, and blank lines between rows."""
    events = load(spark, sf_dir, "events")
    spelled = F.when(F.col("event_type") == "error", "NULL").when(F.col("event_type") == "click", "null").when(
        F.col("event_type") == "view", "").otherwise(F.col("value").cast("string"))
    line = F.concat_ws(",", F.col("event_id").cast("string"), spelled, "event_type")
    folder = new_folder(spark, "nulls")
    lines = F.when(F.col("event_type") == "signup", F.array(F.lit(""), line)).otherwise(F.array(line))
    events.select(F.explode(lines).alias("value")).write.text(folder)
    schema = T.StructType().add("event_id", "long").add("value", "double").add("event_type", "string")
    return delimited.read_delimited(spark, folder, schema, delimited.COMMA.override(skip_header=False))


def positional_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, folder = event_files(spark, sf_dir)
    return delimited.read_positional(spark, folder, ",", skip_header=True).select("c1", "c3", "c4")


def uneven_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of one to four fields; the widest one gives the number of columns."""
    events = load(spark, sf_dir, "events")
    fields = [F.col("event_id").cast("string"), F.col("event_type"), F.col("user_id").cast("string"), F.lit("x")]
    wide = F.col("event_id") % 4
    line = F.concat_ws("|", *[F.when(wide >= i, f) for i, f in enumerate(fields)])
    folder = new_folder(spark, "uneven")
    events.select(line.alias("value")).write.text(folder)
    return delimited.read_positional(spark, folder, "|")


def whole_line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma files read with the pipe separator: each line comes back whole in the first column."""
    events = load(spark, sf_dir, "events")
    folder = new_folder(spark, "lines")
    events.select(F.concat_ws(",", F.col("event_id").cast("string"), "event_type").alias("value")).write.text(folder)
    return delimited.read_positional(spark, folder, "|")


def file_name_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, folder = event_files(spark, sf_dir, by_type=True)
    rows = delimited.read_positional(spark, f"{folder}/*", ",", 6, with_file=True, skip_header=True)
    kind = F.regexp_extract("_file_path", "kind=([^/]+)/", 1)
    return rows.groupBy(kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("_file_name").endswith(".csv"), 1)).alias("named"))


def list_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of a recursive listing, and whether all their files have bytes and a checksum."""
    _, folder = event_files(spark, sf_dir, by_type=True)
    listed = files.list_files(spark, folder, "*.csv", checksum=True, recursive=True)
    kind = F.regexp_extract("relative_path", "^kind=([^/]+)/", 1)
    good = (F.col("size") > 0) & (F.length("md5") == 32) & F.col("last_modified").isNotNull()
    return listed.groupBy(kind.alias("kind")).agg(F.bool_and(good).alias("complete"))


def file_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' first lines by language, one file each in order of id, and the files' checksums."""
    docs = load(spark, sf_dir, "documents")
    folder = new_folder(spark, "checksums")
    rows = docs.select("lang", "doc_id", F.split("text", "\n")[0].alias("value"))
    rows = rows.repartition("lang").sortWithinPartitions("lang", "doc_id").drop("doc_id")
    rows.write.partitionBy("lang").text(folder)
    listed = files.list_files(spark, folder, "*.txt", checksum=True, recursive=True)
    return listed.select(F.regexp_extract("relative_path", "^lang=([^/]+)/", 1).alias("lang"), "md5", "size")


def infer_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, folder = event_files(spark, sf_dir)
    return delimited.infer_columns(spark, folder)


def external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, folder = event_files(spark, sf_dir)
    delimited.refresh(spark, folder)
    cols = {"id": (1, "bigint"), "kind": (4, "string"), "amount": (5, "double")}
    return delimited.external_table(spark, folder, cols, "part-*.csv", width=6)


def unload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unloaded lines as text, header lines left out."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    folder = new_folder(spark, "unload")
    delimited.unload(orders, folder, delimited.PIPE)
    return spark.read.text(folder).filter(~F.col("value").startswith("o_orderkey")).select(F.col("value").alias("line"))


def copy_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk load that removes its files, run twice: the second run finds nothing to load."""
    events, folder = event_files(spark, sf_dir)
    target = new_folder(spark, "loaded")
    first = delimited.copy_into(spark, folder, target, events.schema, purge=True)
    second = delimited.copy_into(spark, folder, target, events.schema, purge=True)
    return spark.read.parquet(target).groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).select(
        "event_type", "n", F.lit(first).cast("long").alias("first_run"), F.lit(second).cast("long").alias("second_run"))


def copy_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk load with a history of files: a second run takes only what has come since."""
    events = load(spark, sf_dir, "events")
    base = new_folder(spark, "copy")
    log = AppendLog(spark, f"{base}/table")
    early = F.col("event_type").isin("click", "view")
    counts = []
    for name, rows in (("first run", events.filter(early)), (None, None), ("second+%20", events.filter(~early))):
        if name:
            delimited.unload(rows, f"{base}/in/{name}")
        counts.append(copy_new(log, f"{base}/in", events.schema, RUN_1, delimited.PIPE))
    runs = {f"run_{i + 1}": F.lit(n).cast("long") for i, n in enumerate(counts)}
    taken = log.files().agg(F.sum("row_count")).first()[0]
    return log.read().groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).withColumns(runs).withColumn("in_history", F.lit(taken).cast("long"))


def manifest_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder with one file for each market segment: what a second and a third look at it find."""
    customers = load(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.sum("c_custkey").alias("s"))
    base = new_folder(spark, "manifest")
    inbox, manifest = f"{base}/in", Manifest(spark, f"{base}/table", f"{base}/in", checksum=True)
    # One row for each of the five segments.
    texts = {r["c_mktsegment"]: (f"{r['n']}", f"{r['n']},{r['s']}") for r in customers.toLocalIterator()}
    for name, (short, _) in texts.items():
        if name != "MACHINERY":
            files.put_text(spark, f"{inbox}/{name} 100%.csv", short)
    manifest.refresh(RUN_1)
    files.put_text(spark, f"{inbox}/AUTOMOBILE 100%.csv", texts["AUTOMOBILE"][1], replace=True)
    files.put_text(spark, f"{inbox}/FURNITURE 100%.csv", texts["FURNITURE"][0], replace=True)
    files.put_text(spark, f"{inbox}/MACHINERY 100%.csv", texts["MACHINERY"][0])
    files.delete_files(spark, [f"{inbox}/BUILDING 100%.csv"])
    manifest.refresh(RUN_2)
    manifest.refresh(RUN_2)
    found = manifest.changes()
    return found.select("version", "relative_path", "change", "size", "md5", "old_size", "old_md5")


def new_file_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed files by kind that an earlier listing did not have."""
    events, folder = event_files(spark, sf_dir, by_type=True)
    seen = files.list_files(spark, folder, "*.csv", recursive=True).select(F.col("relative_path").alias("file"))
    seen = seen.filter(F.col("file").startswith("kind=click"))
    fresh = feeds.new_files(spark, folder, seen, "*.csv", recursive=True)
    return fresh.select(F.regexp_extract("relative_path", "^kind=([^/]+)/", 1).alias("kind")).distinct()


def feed_history_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second delivery with unreadable prices for finished orders: their history stays open. A third one
    has a line without a key, so nothing counts as missing in it."""
    prev, curr = order_snapshots(spark, sf_dir)
    base = new_folder(spark, "rejects")
    entity = Entity("orders", prev.schema, KEY, on_error="skip")
    incoming, root = f"{base}/incoming", f"{base}/tables"
    text_of = lambda df: df.withColumns({c: F.col(c).cast("string") for c in df.columns})
    broken = text_of(curr).withColumn("price", F.when(F.col("status") == "F", "unreadable").otherwise(F.col("price")))
    keyless = text_of(prev).limit(1).withColumn(KEY, F.lit(None).cast("string"))
    ledger = None
    for rows, stamp, now in ((prev, "20240101_010000", RUN_1), (broken, "20240102_010000", RUN_2), (keyless, "20240103_010000", RUN_2)):
        delimited.unload(rows, f"{incoming}/orders_{stamp}", delimited.COMMA)
        ledger = run_pipeline(spark, incoming, [entity], root, now)
    return HistoryStore(spark, root, entity).history(ledger.version("orders")).select(KEY, "status", "current_flag")


def ordered_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly deliveries loaded in path order in one scan, each row with the place of its delivery."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy").alias("y"))
    folder = new_folder(spark, "ordered")
    orders.write.partitionBy("y").option("header", "true").csv(folder)
    paths = files.ordered_files(spark, folder, "*.csv", recursive=True)
    deliveries = list(dict.fromkeys(re.sub("^file:/+", "/", p.rsplit("/", 1)[0]) for p in paths))
    places = spark.createDataFrame([(p, i) for i, p in enumerate(deliveries)], "delivery string, place int")
    rows = delimited.read_delimited(spark, f"{folder}/*", T.StructType().add("o_orderkey", "long"), with_file=True)
    delivery = F.regexp_replace(text.plain_path(F.col("_file_path")), "/[^/]*$", "")
    return rows.withColumn("delivery", delivery).join(places, "delivery").select("o_orderkey", "place")


def _planted(spark: SparkSession, sf_dir: str, by_type: bool = False) -> tuple[str, T.StructType]:
    """Event lines with a bad number for errors and one field too many for sign-ups."""
    events = load(spark, sf_dir, "events")
    kind = F.col("event_type")
    value = F.when(kind == "error", "n/a").otherwise(F.col("value").cast("string"))
    fields = F.concat_ws(",", F.col("event_id").cast("string"), kind, value)
    folder = new_folder(spark, "planted")
    lines = events.select(F.when(kind == "signup", F.concat(fields, F.lit(",extra"))).otherwise(fields).alias("value"), kind.alias("kind"))
    if by_type:
        lines.repartition("kind").write.partitionBy("kind").text(folder)
    else:
        lines.select("value").write.text(folder)
    return folder, T.StructType().add("event_id", "long").add("event_type", "string").add("value", "double")


def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, schema = _planted(spark, sf_dir)
    rejected = feeds.validate_load(spark, folder, schema, delimited.COMMA.override(skip_header=False))
    return rejected.select("event_id", "event_type", F.array_join("_rejected", ",").alias("reason"))


def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load history per file, one file for each type of event; file names are Spark's and left out."""
    folder, schema = _planted(spark, sf_dir, by_type=True)
    root = new_folder(spark, "report")
    fmt = delimited.COMMA.override(skip_header=False)
    feeds.ingest_stream(spark, f"{folder}/kind=*", schema, f"{root}/sink", f"{root}/checkpoint", fmt).awaitTermination()
    report = feeds.load_report(spark.read.parquet(f"{root}/sink"), since="2000-01-01")
    return report.select("row_count", "reject_count", "status")


def ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same folder; the second finds no new file and adds nothing."""
    events, folder = event_files(spark, sf_dir)
    root = new_folder(spark, "ingest")
    for _ in range(2):
        feeds.ingest_stream(spark, folder, events.schema, f"{root}/sink", f"{root}/checkpoint").awaitTermination()
    return feeds.accepted(spark.read.parquet(f"{root}/sink"))


def route_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed deliveries with the entity and time their names carry."""
    orders = load(spark, sf_dir, "orders")
    folder = new_folder(spark, "routes")
    late = F.col("o_orderdate") >= F.lit(CUTOFF).cast("timestamp_ntz")
    for stamp, rows in (("20240101_010000", orders.filter(~late)), ("20240102_020000", orders.filter(late))):
        rows.write.option("header", "true").csv(f"{folder}/orders_{stamp}")
    listed = files.list_files(spark, folder, "*.csv", recursive=True)
    routed = feeds.route_files(listed, folder)
    whole = F.col("path_to_file") == text.absolute_path(folder, F.col("relative_path"))
    return routed.groupBy("entity", "stamp", "action").agg(
        F.bool_and(whole).alias("absolute"), F.bool_and((F.col("size") > 0) & F.col("last_modified").isNotNull()).alias("sized"))


def file_feed_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshot deliveries applied in name order by two runs; a third run has nothing to do."""
    prev, curr = order_snapshots(spark, sf_dir)
    base = new_folder(spark, "deliveries")
    entity = Entity("orders", prev.schema, KEY)
    incoming, root = f"{base}/incoming", f"{base}/tables"
    deliveries = [(prev, "20240101_010000", RUN_1), (curr, "20240102_010000", RUN_2), (None, "", RUN_2)]
    for snapshot, stamp, now in deliveries:
        if snapshot is not None:
            delimited.unload(snapshot, f"{incoming}/orders_{stamp}", delimited.COMMA)
        ledger = run_pipeline(spark, incoming, [entity], root, now)
    out = HistoryStore(spark, root, entity).history(ledger.version("orders"))
    return with_time_text(out, "valid_from", "valid_to")


FEED_HISTORY = f"""WITH {SNAPSHOTS},
ups AS (SELECT c.* FROM curr c JOIN prev p USING (o_orderkey) WHERE c.last_updated <> p.last_updated),
gone AS (SELECT * FROM prev WHERE o_orderkey NOT IN (SELECT o_orderkey FROM curr)),
rows AS (
  SELECT p.o_orderkey, p.status, p.price, TIMESTAMP '{RUN_1}' AS valid_from,
         CASE WHEN u.o_orderkey IS NULL AND g.o_orderkey IS NULL THEN TIMESTAMP '9999-12-31' ELSE TIMESTAMP '{RUN_2}' END AS valid_to,
         CASE WHEN u.o_orderkey IS NULL AND g.o_orderkey IS NULL THEN 'Y' ELSE 'N' END AS current_flag,
         CASE WHEN u.o_orderkey IS NOT NULL THEN '{UPDATE_CLOSES}' WHEN g.o_orderkey IS NOT NULL THEN '{MISSING}'
              ELSE '{NEW_ROW}' END AS decision
  FROM prev p LEFT JOIN ups u USING (o_orderkey) LEFT JOIN gone g ON g.o_orderkey = p.o_orderkey
  UNION ALL
  SELECT o_orderkey, status, price, TIMESTAMP '{RUN_2}', TIMESTAMP '9999-12-31', 'Y', '{UPDATE_OPENS}' FROM ups
  UNION ALL
  SELECT o_orderkey, status, price, TIMESTAMP '{RUN_2}', TIMESTAMP '9999-12-31', 'Y', '{NEW_ROW}'
  FROM curr WHERE o_orderkey NOT IN (SELECT o_orderkey FROM prev))
SELECT o_orderkey, status, price, {sql_time_text('valid_from', 'valid_from')},
       {sql_time_text('valid_to', 'valid_to')}, current_flag, decision FROM rows"""


def on_new_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New document files are flattened and appended once, however often the job runs."""
    root = new_folder(spark, "json-job")
    page_documents(spark, sf_dir).write.text(f"{root}/incoming")
    target = f"{root}/view"

    def loader(paths: list[str], batch_id: int) -> None:
        docs = read_json_variant(spark, paths, "doc", lines=True)
        nested_view(docs, "doc", "$.page", "$.params", PAGE, PARAM).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    for _ in range(2):
        feeds.on_new_file(spark, f"{root}/incoming", loader, f"{root}/checkpoint", "*.txt")
    return spark.read.parquet(target).drop("batch")


def on_change_dq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks run when the feed has rows, and not when it has none."""
    _, curr = order_snapshots(spark, sf_dir)
    path = new_folder(spark, "exceptions")
    orders = load(spark, sf_dir, "orders")
    codes = orders.groupBy().agg(F.min("o_orderkey").alias("data_quality_exception_code_id")).withColumn(
        "data_quality_exception_code_name", F.lit("ATTRIBUTE_IS_NULL"))
    checked = curr.select(
        KEY, F.when(F.col("price") < 450000, F.col("price")).alias("price"), F.lit("Y").alias("current_flag"))

    def action(feed: DataFrame) -> None:
        run_checks(feed, [Check("price", KEY, "orders")], codes, AS_OF).write.mode("append").parquet(path)

    ran = feeds.on_change(checked, action)
    again = feeds.on_change(checked.filter(F.col(KEY) < 0), action)
    return spark.read.parquet(path).select(
        "data_quality_exception_id", "source_record_pk_value", F.lit(ran).alias("ran"), F.lit(again).alias("ran_again"))


def describer():
    """Deterministic stand-in for a remote extractor: sizes of a file or text.

    A nested function travels to the workers by value, so they need not have this package.
    """
    def describe(n: int, content: object) -> str:
        raw = content if isinstance(content, str) else bytes(content).decode("utf-8")
        return json.dumps({"chars": len(raw) + n, "lines": raw.count("\n")})

    return describe


DOCUMENTS_PER_FILE = 500


def binary_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every unloaded file passes an extractor; its answers are added up."""
    docs = load(spark, sf_dir, "documents").select(F.regexp_replace("text", "\n", " ").alias("value"))
    folder = new_folder(spark, "binary")
    # A file is one value in a worker, so files have so many documents at most, however many there are.
    docs.write.option("maxRecordsPerFile", DOCUMENTS_PER_FILE).text(folder)
    rows = enrich_files(files.read_binary(spark, folder, "*.txt"), describer())
    return rows.agg(
        F.sum(json_path("data", "$.chars", "bigint")).alias("chars"), F.sum(json_path("data", "$.lines", "bigint")).alias("lines"))


def external_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An external function per row, its JSON parsed and read by key."""
    docs = load(spark, sf_dir, "documents")
    data = F.parse_json(external_function(describer())(F.lit(1), F.col("text")))
    rows = docs.select("doc_id", data.alias("data"))
    return rows.select("doc_id", json_path("data", "$.chars", "bigint").alias("chars"), json_path("data", "$.lines", "bigint").alias("lines"))


def path_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absolute and relative paths of page addresses below a stage folder."""
    pages = load(spark, sf_dir, "pages")
    relative = F.substring_index("url", "/", -1)
    absolute = text.absolute_path("/stage/pages/", relative)
    return pages.select(
        "page_id", absolute.alias("absolute_path"), text.relative_path("/stage/pages", absolute).alias("relative_path"),
        text.plain_path(F.concat(F.lit("file://"), absolute)).alias("plain"), text.stage_location("/stage/pages").alias("stage_location"))


def clustered_write_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows in eight files, as they come and clustered by date: how many files a date touches."""
    lineitem = load(spark, sf_dir, "lineitem")
    base = new_folder(spark, "layout")
    # One file for each year, and one for each supplier number modulo 8: their ranges follow from the rows.
    for layout, part in (("by_year", F.year("l_shipdate")), ("by_supplier", F.col("l_suppkey") % 8)):
        write_by_value(lineitem, part, f"{base}/{layout}")
    write_clustered(lineitem, ["l_shipdate"], 8, f"{base}/clustered", scanned=True)
    reports = []
    for layout in ("by_year", "by_supplier", "clustered"):
        report = report_path(spark, f"{base}/{layout}", ["l_shipdate"])
        # Where the range cuts fall is sampled; only the other layouts have numbers to compare.
        known = lambda c: F.col(c) if layout != "clustered" else F.lit(None).cast("double")  # noqa: B023, E731
        reports.append(report.select(
            F.lit(layout).alias("layout"), "total_files", known("average_overlaps").alias("average_overlaps"),
            known("average_depth").alias("average_depth"), (F.col("average_depth") <= 2).alias("well_clustered")))
    return union_all(reports)


# Borders of the cells of z_order_cells: three dates, three quantities.
CELL_DATES, CELL_QUANTITIES = ("1996-01-01", "1999-01-01", "2001-07-01"), (13.0, 26.0, 39.0)


def z_order_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by the Z-order rank of date and quantity among fixed borders: rows and ranges of each cell."""
    lineitem = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", F.col("l_shipdate").cast("date").alias("ship"))
    dates = [datetime.date.fromisoformat(d) for d in CELL_DATES]
    ranked = with_z_rank(lineitem, ["ship", "l_quantity"], [dates, CELL_QUANTITIES], "cell", bits=2)
    ends = [f(c).alias(f"{end}_{c}") for c in ("ship", "l_quantity") for end, f in (("lo", F.min), ("hi", F.max))]
    return ranked.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys"), *ends)


def _place(column: str, borders: list[str]) -> str:
    return "(" + " + ".join(f"CAST({column} >= {b} AS BIGINT)" for b in borders) + ")"


Z_ORDER_CELLS = f"""
WITH placed AS (
  SELECT l_orderkey, l_quantity, CAST(l_shipdate AS DATE) AS ship,
         {_place("CAST(l_shipdate AS DATE)", [f"DATE '{d}'" for d in CELL_DATES])} AS p,
         {_place("l_quantity", [str(q) for q in CELL_QUANTITIES])} AS q FROM lineitem)
SELECT 8 * (p // 2) + 4 * (q // 2) + 2 * (p % 2) + q % 2 AS cell, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys,
       min(ship) AS lo_ship, max(ship) AS hi_ship, min(l_quantity) AS lo_l_quantity, max(l_quantity) AS hi_l_quantity
FROM placed GROUP BY 1"""


def z_order_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in sixteen files, sorted by two keys and in Z-order of both: on which key each layout prunes.

    Ranges and row counts come from the files' footers. Where cuts fall is sampled, so of the overlaps
    it is only told whether a file overlaps fewer than four fifths of the others.
    """
    lineitem = load(spark, sf_dir, "lineitem")
    base, keys = new_folder(spark, "z-order"), ["l_shipdate", "l_partkey"]
    write_clustered(lineitem, keys, 16, f"{base}/sorted", scanned=True)
    write_z_ordered(lineitem, keys, 16, f"{base}/z_order", scanned=True)
    reports = []
    for layout in ("sorted", "z_order"):
        path = f"{base}/{layout}"
        spans = file_spans(spark, path, keys)
        ends = union_all([spans.agg(
            F.lit(k).alias("key"), F.sum("rows").alias("n"), F.min(f"lo_{k}").cast("string").alias("lowest"),
            F.max(f"hi_{k}").cast("string").alias("highest")) for k in keys])
        reports.append(column_reports(spark, path, keys).join(ends, "key").select(
            F.lit(layout).alias("layout"), "key", "total_files", "n", "lowest", "highest",
            (F.col("average_overlaps") < 0.8 * (F.col("total_files") - 1)).alias("prunes")))
    return union_all(reports)


Z_ORDER_REPORT = """
WITH ends AS (
  SELECT 'l_shipdate' AS key, count(*) AS n, CAST(min(l_shipdate) AS VARCHAR) AS lowest, CAST(max(l_shipdate) AS VARCHAR) AS highest FROM lineitem
  UNION ALL SELECT 'l_partkey', count(*), CAST(min(l_partkey) AS VARCHAR), CAST(max(l_partkey) AS VARCHAR) FROM lineitem)
SELECT layout, key, CAST(16 AS BIGINT) AS total_files, n, lowest, highest, layout = 'z_order' OR key = 'l_shipdate' AS prunes
FROM ends, (VALUES ('sorted'), ('z_order')) AS l(layout) WHERE n > 0"""


def spend_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily spend appended once per day, however often the report runs."""
    events = load(spark, sf_dir, "events")
    metering = events.select(
        F.col("event_type").alias("warehouse_name"), F.col("value").cast("decimal(18,6)").alias("credits_used"),
        F.col("ts").alias("start_time"))
    path = new_folder(spark, "spend")
    for now in ("2024-01-30 01:00:00", "2024-01-31 01:00:00", "2024-01-31 02:00:00"):
        feeds.snapshot_append(daily_spend(metering, now), path, now)
    return spark.read.parquet(path).select(
        "warehouse_name", F.col("credits_used").cast("double").alias("credits_used"), "spend_date", "last_updated")


SPEND_HISTORY = """
SELECT event_type AS warehouse_name, CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) AS credits_used,
       strftime(ts, '%Y%m%d') AS spend_date, date_trunc('day', ts) + INTERVAL 25 HOUR AS last_updated
FROM events WHERE CAST(ts AS DATE) IN (DATE '2024-01-29', DATE '2024-01-30') GROUP BY 1, 3, 4"""

QUERIES: Registry = {
    "delimited_roundtrip": (delimited_roundtrip, "SELECT * FROM events"),
    "line_break_roundtrip": (line_break_roundtrip, "SELECT * FROM documents"),
    "null_tokens": (null_tokens, """
SELECT event_id, CASE WHEN event_type NOT IN ('error', 'click', 'view') THEN value END AS value, event_type FROM events"""),
    "positional_scan": (positional_scan, "SELECT CAST(event_id AS VARCHAR) AS c1, CAST(user_id AS VARCHAR) AS c3, event_type AS c4 FROM events"),
    "uneven_scan": (uneven_scan, """
SELECT CAST(event_id AS VARCHAR) AS c1, CASE WHEN event_id % 4 >= 1 THEN event_type END AS c2,
       CASE WHEN event_id % 4 >= 2 THEN CAST(user_id AS VARCHAR) END AS c3, CASE WHEN event_id % 4 >= 3 THEN 'x' END AS c4 FROM events"""),
    "whole_line_scan": (whole_line_scan, "SELECT event_id || ',' || event_type AS c1 FROM events"),
    "file_name_scan": (file_name_scan, "SELECT event_type AS kind, count(*) AS n, count(*) AS named FROM events GROUP BY 1"),
    "list_files": (list_files, "SELECT DISTINCT event_type AS kind, true AS complete FROM events"),
    "file_checksum": (file_checksum, """
SELECT lang, md5(body) AS md5, CAST(octet_length(encode(body)) AS BIGINT) AS size
FROM (SELECT lang, string_agg(string_split(text, chr(10))[1] || chr(10), '' ORDER BY doc_id) AS body FROM documents GROUP BY 1)"""),
    "infer_columns": (infer_columns, """
SELECT CAST(ordinal_position AS INTEGER) AS position, column_name, kind AS data_type, column_name || ' ' || kind AS ddl
FROM (SELECT *, CASE data_type WHEN 'BIGINT' THEN (SELECT CASE WHEN max(event_id) > 2147483647 THEN 'bigint' ELSE 'int' END FROM events)
                               WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp' END AS kind
      FROM information_schema.columns WHERE table_name = 'events')"""),
    "external_table": (external_table, "SELECT event_id AS id, event_type AS kind, value AS amount FROM events"),
    "unload": (unload, "SELECT o_orderkey || '|' || o_custkey || '|' || o_orderstatus AS line FROM orders"),
    "copy_load": (copy_load, """
SELECT event_type, count(*) AS n, (SELECT count(*) FROM events) AS first_run, CAST(0 AS BIGINT) AS second_run FROM events GROUP BY 1"""),
    "copy_twice": (copy_twice, """
SELECT event_type, count(*) AS n, (SELECT count(*) FROM events WHERE event_type IN ('click', 'view')) AS run_1, CAST(0 AS BIGINT) AS run_2,
       (SELECT count(*) FROM events WHERE event_type NOT IN ('click', 'view')) AS run_3, (SELECT count(*) FROM events) AS in_history
FROM events GROUP BY 1"""),
    "manifest_changes": (manifest_changes, """
WITH texts AS (
  SELECT c_mktsegment AS name, CAST(count(*) AS VARCHAR) AS short, count(*) || ',' || CAST(sum(c_custkey) AS BIGINT) AS long FROM customer GROUP BY 1),
seen AS (
  SELECT 1 AS version, name, 'new' AS change, short AS now, NULL AS was FROM texts WHERE name <> 'MACHINERY'
  UNION ALL SELECT 2, name, 'new', short, NULL FROM texts WHERE name = 'MACHINERY'
  UNION ALL SELECT 2, name, 'changed', long, short FROM texts WHERE name = 'AUTOMOBILE'
  UNION ALL SELECT 2, name, 'removed', NULL, short FROM texts WHERE name = 'BUILDING')
SELECT CAST(version AS BIGINT) AS version, name || ' 100%.csv' AS relative_path, change, CAST(length(now) AS BIGINT) AS size, md5(now) AS md5,
       CAST(length(was) AS BIGINT) AS old_size, md5(was) AS old_md5 FROM seen"""),
    "new_file_batch": (new_file_batch, "SELECT DISTINCT event_type AS kind FROM events WHERE event_type <> 'click'"),
    "feed_history_rejects": (feed_history_rejects, f"""WITH {SNAPSHOTS},
good AS (SELECT * FROM curr WHERE status <> 'F'),
ups AS (SELECT g.o_orderkey, g.status FROM good g JOIN prev p USING (o_orderkey) WHERE g.last_updated <> p.last_updated)
SELECT p.o_orderkey, p.status, CASE WHEN u.o_orderkey IS NOT NULL OR c.o_orderkey IS NULL THEN 'N' ELSE 'Y' END AS current_flag
FROM prev p LEFT JOIN ups u USING (o_orderkey) LEFT JOIN curr c ON c.o_orderkey = p.o_orderkey
UNION ALL SELECT o_orderkey, status, 'Y' FROM ups
UNION ALL SELECT o_orderkey, status, 'Y' FROM good WHERE o_orderkey NOT IN (SELECT o_orderkey FROM prev)"""),
    "ordered_load": (ordered_load, """
SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY year(o_orderdate)) - 1 AS INTEGER) AS place FROM orders"""),
    "load_rejects": (load_rejects, """
SELECT event_id, event_type, CASE event_type WHEN 'error' THEN 'value' ELSE 'line' END AS reason
FROM events WHERE event_type IN ('error', 'signup')"""),
    "load_report": (load_report, """
SELECT count(*) FILTER (WHERE event_type NOT IN ('error', 'signup')) AS row_count,
       count(*) FILTER (WHERE event_type IN ('error', 'signup')) AS reject_count,
       CASE WHEN event_type IN ('error', 'signup') THEN 'LOAD_FAILED' ELSE 'LOADED' END AS status FROM events GROUP BY event_type"""),
    "ingest_stream": (ingest_stream, "SELECT * FROM events"),
    "route_files": (route_files, f"""
SELECT DISTINCT 'orders' AS entity, CASE WHEN o_orderdate < TIMESTAMP '{CUTOFF}' THEN TIMESTAMP '2024-01-01 01:00:00'
       ELSE TIMESTAMP '2024-01-02 02:00:00' END AS stamp, 'INSERT' AS action, true AS absolute, true AS sized FROM orders"""),
    "file_feed_history": (file_feed_history, FEED_HISTORY),
    "on_new_json": (on_new_json, NESTED),
    "on_change_dq": (on_change_dq, f"""WITH {SNAPSHOTS}
SELECT row_number() OVER (ORDER BY CAST(o_orderkey AS VARCHAR)) + 9999 AS data_quality_exception_id,
       CAST(o_orderkey AS VARCHAR) AS source_record_pk_value, true AS ran, false AS ran_again
FROM curr WHERE NOT price < 450000"""),
    "binary_enrich": (binary_enrich, """
SELECT CAST(sum(length(text) + 1) AS BIGINT) AS chars, count(*) AS lines FROM documents"""),
    "external_scalar": (external_scalar, """
SELECT doc_id, CAST(length(text) + 1 AS BIGINT) AS chars,
       CAST(length(text) - length(replace(text, chr(10), '')) AS BIGINT) AS lines FROM documents"""),
    "path_functions": (path_functions, """
SELECT page_id, '/stage/pages/' || string_split(url, '/')[-1] AS absolute_path, string_split(url, '/')[-1] AS relative_path,
       '/stage/pages/' || string_split(url, '/')[-1] AS plain, '/stage/pages/' AS stage_location FROM pages"""),
    "clustered_write_report": (clustered_write_report, """
WITH spans AS (
  SELECT 'by_year' AS layout, year(l_shipdate) AS part, min(l_shipdate) AS lo, max(l_shipdate) AS hi FROM lineitem GROUP BY 1, 2
  UNION ALL SELECT 'by_supplier', l_suppkey % 8, min(l_shipdate), max(l_shipdate) FROM lineitem GROUP BY 1, 2),
pairs AS (
  SELECT a.layout, a.part, count(*) FILTER (WHERE b.lo <= a.hi AND b.hi >= a.lo) - 1 AS others,
         count(*) FILTER (WHERE b.lo <= a.lo AND b.hi >= a.lo) AS held
  FROM spans a JOIN spans b ON a.layout = b.layout GROUP BY 1, 2),
exact AS (
  SELECT layout, count(*) AS total_files, round(avg(others), 4) AS average_overlaps, round(avg(held), 4) AS average_depth FROM pairs GROUP BY 1)
SELECT layout, total_files, average_overlaps, average_depth, average_depth <= 2 AS well_clustered FROM exact
UNION ALL SELECT 'clustered', 8, NULL, NULL, true WHERE EXISTS (SELECT 1 FROM lineitem)"""),
    "z_order_cells": (z_order_cells, Z_ORDER_CELLS),
    "z_order_report": (z_order_report, Z_ORDER_REPORT),
    "spend_history": (spend_history, SPEND_HISTORY),
}
