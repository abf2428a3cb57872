"""Registered queries: JSON paths, exploded arrays and objects, nested documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import nested
from tidemark.operators.changes import change_feed
from tidemark.operators.layout import materialize
from tidemark.plans.common import Registry, load
from tidemark.session import cut_lineage, new_folder
from tidemark.sources.relations import read_json_variant
from tidemark.streaming.views import COUNT, MaintainedView, counted, signed


def props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select("event_id", F.parse_json("props").alias("props"))


def json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.extract(props(spark, sf_dir), {
        "k": ("props", "$.k"), "nothing": ("props", "$.k.deeper"), "missing": ("props", "$.none"),
    }, ("event_id",))


def json_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.extract(props(spark, sf_dir), {
        "k_int": ("props", "$.k", "int"), "k_double": ("props", "$.k", "double"),
    }, ("event_id",)).withColumn("k_rounded", (F.col("k_double") / 10).cast("decimal(10,0)").cast("double"))


def line_documents(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """Documents as JSON: an array of lines; with `gaps` some languages have it empty or not at all."""
    content = F.split("text", "\n", -1)
    if gaps:
        content = F.when(F.col("lang") == "de", F.array().cast("array<string>")).when(F.col("lang") != "fr", content)
    doc = F.to_json(F.struct("doc_id", "lang", content.alias("lines")))
    return load(spark, sf_dir, "documents").select("doc_id", F.parse_json(doc).alias("doc"))


def flatten_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = nested.explode_json(line_documents(spark, sf_dir), "doc", "$.lines")
    return rows.select("doc_id", F.col("pos").cast("long").alias("pos"), nested.json_path("value", "$").alias("line"))


def flatten_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays that are empty or missing keep one row; the lines of two languages are left out for that."""
    rows = nested.explode_json(line_documents(spark, sf_dir, gaps=True), "doc", "$.lines", outer=True)
    return rows.select(
        "doc_id", nested.json_path("doc", "$.lang").alias("lang"), F.col("pos").cast("long").alias("pos"),
        F.length(nested.json_path("value", "$")).cast("long").alias("line_chars"))


def flatten_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and value rows of one object per order."""
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", F.parse_json(nested.row_json("o_custkey", "o_orderstatus", "o_orderpriority")).alias("o"))
    return nested.explode_json(orders, "o").select("o_orderkey", "key", nested.json_path("value", "$").alias("value"))


def row_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows as VARIANT objects, read back by path."""
    customer = load(spark, sf_dir, "customer").select("c_custkey", nested.row_variant("c_name", "c_nationkey").alias("v"))
    return nested.extract(customer, {"name": ("v", "$.c_name"), "nation": ("v", "$.c_nationkey", "int")}, ("c_custkey",))


def page_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as nested documents: address, and query parameters as an array that may be missing."""
    url = F.col("url")
    query = F.split_part(url, F.lit("?"), F.lit(2))
    pairs = F.transform(F.split(query, "&"), lambda p: F.struct(
        F.split_part(p, F.lit("="), F.lit(1)).alias("type"), F.split_part(p, F.lit("="), F.lit(2)).alias("number")))
    base = F.split_part(url, F.lit("?"), F.lit(1))
    address = F.struct(F.split_part(base, F.lit("/"), F.lit(3)).alias("host"), F.split_part(base, F.lit("/"), F.lit(4)).alias("first"))
    page = F.struct(
        F.col("page_id").cast("string").alias("id"), address.alias("address"),
        F.when(query != "", pairs).alias("params"), F.length("html").alias("size"))
    return load(spark, sf_dir, "pages").select(F.to_json(F.struct(F.array(page).alias("page"))).alias("value"))


PAGE = {"id": "$.id", "host": "$.address.host", "first": "$.address.first", "size": "$.size"}
PARAM = {"param_type": "$.type", "param_number": "$.number"}


def nested_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document files to a stored flat view: scan, two explodes, Parquet."""
    folder = new_folder(spark, "pages-json")
    page_documents(spark, sf_dir).write.text(folder)
    docs = read_json_variant(spark, folder, "doc", lines=True)
    flat = nested.nested_view(docs, "doc", "$.page", "$.params", PAGE, PARAM)
    return materialize(flat, new_folder(spark, "pages-view"))


NESTED = """
WITH p AS (
  SELECT CAST(page_id AS VARCHAR) AS id, split_part(split_part(url, '?', 1), '/', 3) AS host,
         split_part(split_part(url, '?', 1), '/', 4) AS first, CAST(length(html) AS VARCHAR) AS size,
         split_part(url, '?', 2) AS q
  FROM pages)
SELECT id, host, first, size, split_part(kv, '=', 1) AS param_type, split_part(kv, '=', 2) AS param_number
FROM (SELECT *, unnest(string_split(q, '&')) AS kv FROM p WHERE q <> '')
UNION ALL SELECT id, host, first, size, NULL, NULL FROM p WHERE q = ''"""
FLAT = NESTED.split("UNION ALL")[0]


def view_delta_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat view of page documents, kept up as documents come, go and change."""
    docs = page_documents(spark, sf_dir).select(F.get_json_object("value", "$.page[0].id").alias("page_id"), "value")
    has_params = F.get_json_object("value", "$.page[0].params").isNotNull()
    # Of the earlier documents some sizes are wrong, and those of pages with an even size are yet to come.
    size = F.get_json_object("value", "$.page[0].size").cast("long")
    wrong = F.regexp_replace("value", '"size":[0-9]*5}', '"size":0}')
    before = docs.filter(size % 2 == 1).select("page_id", wrong.alias("value"))
    after = docs.filter(has_params).select("page_id", "value")
    before = cut_lineage(before, "pages-before")

    def flat(delta: DataFrame) -> DataFrame:
        parsed = delta.select(F.parse_json("value").alias("doc"), COUNT)
        return nested.nested_view(parsed, "doc", "$.page", "$.params", PAGE, PARAM, (COUNT,))

    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*PAGE, *PARAM)])
    view = MaintainedView(spark, new_folder(spark, "flat-view"), schema)
    view.step(flat(counted(before)), 0)
    view.step(flat(signed(change_feed(before, after, "page_id"))), 1)
    return view.read(2)


def json_array_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and second element of an array by index."""
    return nested.extract(line_documents(spark, sf_dir), {
        "first_line": ("doc", "$.lines[0]"), "second_line": ("doc", "$.lines[1]")}, ("doc_id",))


QUERIES: Registry = {
    "json_path": (json_path, """
SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS nothing,
       json_extract_string(props, '$.none') AS missing FROM events"""),
    "json_cast": (json_cast, """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k_int, CAST(json_extract(props, '$.k') AS DOUBLE) AS k_double,
       CAST(CAST(CAST(json_extract(props, '$.k') AS DECIMAL(10,1)) / 10 AS DECIMAL(10,1)) AS DECIMAL(10,0))::DOUBLE AS k_rounded
FROM events"""),
    "json_array_index": (json_array_index, r"""
SELECT doc_id, string_split(text, chr(10))[1] AS first_line, string_split(text, chr(10))[2] AS second_line FROM documents"""),
    "flatten_array": (flatten_array, """
SELECT doc_id, CAST(pos AS BIGINT) AS pos, string_split(text, chr(10))[pos + 1] AS line
FROM (SELECT doc_id, text, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents)"""),
    "flatten_outer": (flatten_outer, """
SELECT doc_id, lang, CAST(pos AS BIGINT) AS pos, CAST(length(string_split(text, chr(10))[pos + 1]) AS BIGINT) AS line_chars
FROM (SELECT doc_id, lang, text, unnest(range(len(string_split(text, chr(10))))) AS pos
      FROM documents WHERE lang NOT IN ('de', 'fr'))
UNION ALL SELECT doc_id, lang, NULL, NULL FROM documents WHERE lang IN ('de', 'fr')"""),
    "flatten_object": (flatten_object, """
SELECT o_orderkey, 'o_custkey' AS key, CAST(o_custkey AS VARCHAR) AS value FROM orders
UNION ALL SELECT o_orderkey, 'o_orderstatus', o_orderstatus FROM orders
UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority FROM orders"""),
    "row_object": (row_object, "SELECT c_custkey, c_name AS name, c_nationkey AS nation FROM customer"),
    "nested_view": (nested_view, NESTED),
    "view_delta_flat": (view_delta_flat, FLAT),
}
