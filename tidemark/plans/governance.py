"""Registered queries: data quality, masks and row filters, tags, classification, metadata schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import ntz
from tidemark.operators import classify, policies, tags
from tidemark.operators.changes import change_feed
from tidemark.operators.constructor import schema_from_metadata
from tidemark.operators.dml import update_where
from tidemark.operators.joins import union_all
from tidemark.operators.nested import flatten_classification
from tidemark.operators.quality import Check, check_keys, dq_not_null, rule_counts, run_checks
from tidemark.plans.common import AS_OF, Registry, load
from tidemark.session import cut_lineage, new_folder
from tidemark.sources.delimited import COMMA, read_delimited, unload
from tidemark.streaming.history import append_typed
from tidemark.streaming.keys import KeyIndex
from tidemark.streaming.views import MaintainedView, counted


# --- data quality -----------------------------------------------------------------------------

def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels as current rows; unlabelled ones have NULLs."""
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    current = F.when(F.col("lang") == "en", "Y").otherwise("N").alias("current_flag")
    return docs.select("doc_id", "n_chars", current).join(labels, "doc_id", "left")


LABELLED = """labelled AS (
  SELECT d.doc_id, n_chars, CASE WHEN lang = 'en' THEN 'Y' ELSE 'N' END AS current_flag, quality, toxic
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


def dq_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes numbered from the smallest label: one per rule."""
    first = load(spark, sf_dir, "labels").agg((F.min("doc_id") * 0 + 10000).alias("base"))
    rules = F.explode(F.array(
        F.struct(F.lit(0).alias("i"), F.lit("ATTRIBUTE_IS_NULL").alias("name")),
        F.struct(F.lit(1).alias("i"), F.lit("TEXT_TOO_SHORT").alias("name"))))
    return first.select("base", rules.alias("r")).select(
        (F.col("base") + F.col("r.i")).alias("data_quality_exception_code_id"),
        F.col("r.name").alias("data_quality_exception_code_name"))


def q_dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq_not_null(labelled(spark, sf_dir), "quality", "doc_id", dq_codes(spark, sf_dir), AS_OF, "labelled")


def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [
        Check("quality", "doc_id", "labelled"),
        Check("toxic", "doc_id", "labelled"),
        Check("n_chars", "doc_id", "labelled", code="TEXT_TOO_SHORT", fails=F.col("n_chars") < 500),
    ]
    return run_checks(labelled(spark, sf_dir), checks, dq_codes(spark, sf_dir), AS_OF)


def _dq_sql(branches: str) -> str:
    return f"""WITH {LABELLED}, found AS ({branches})
SELECT row_number() OVER (ORDER BY source_attribute_name, source_record_pk_value) + 9999 AS data_quality_exception_id,
       'Test' AS validation_routine, data_quality_exception_code_id, 'labelled' AS source_object_name,
       source_attribute_name, 'doc_id' AS source_record_pk_info, source_record_pk_value,
       TIMESTAMP '{AS_OF}' AS insert_timestamp FROM found"""


def _dq_branch(attribute: str, code: int, test: str) -> str:
    return (f"SELECT CAST({code} AS BIGINT) AS data_quality_exception_code_id, '{attribute}' AS source_attribute_name,"
            f" CAST(doc_id AS VARCHAR) AS source_record_pk_value FROM labelled WHERE current_flag = 'Y' AND {test}")


def key_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, orders = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders")
    finished = orders.filter(F.col("o_orderstatus") == "F")
    nullable = lineitem.withColumn("l_returnflag", F.when(F.col("l_quantity") < 50, F.col("l_returnflag")))
    return check_keys(
        nullable, primary=["l_orderkey", "l_linenumber"], unique=[["l_partkey", "l_suppkey"]],
        foreign=[(["l_orderkey"], finished, ["o_orderkey"])], not_null=["l_returnflag"])


KEY_CHECKS = """
SELECT 'primary' AS rule, 'l_orderkey,l_linenumber' AS columns, l_orderkey || '|' || l_linenumber AS key, count(*) AS row_count
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'unique', 'l_partkey,l_suppkey', l_partkey || '|' || l_suppkey, count(*)
FROM lineitem GROUP BY l_partkey, l_suppkey HAVING count(*) > 1
UNION ALL SELECT 'foreign', 'l_orderkey', CAST(l_orderkey AS VARCHAR), count(*) FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY l_orderkey
UNION ALL SELECT 'not_null', 'l_returnflag', 'NULL', count(*) FROM lineitem WHERE l_quantity >= 50 HAVING count(*) > 0"""


def keys_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in two loads: what each breaks of a primary key and of a foreign key to orders that also come in two."""
    lineitem = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    own = KeyIndex(spark, new_folder(spark, "line-keys"), lineitem.drop("l_suppkey").schema)
    parent = KeyIndex(spark, new_folder(spark, "order-keys"), orders.drop("o_orderstatus").schema)
    found = []
    for number, status in ((1, "F"), (2, "O")):
        rows = lineitem.filter(F.col("l_suppkey") % 2 == number - 1)
        parent.step(orders.filter(F.col("o_orderstatus") == status), number - 1)
        own.step(rows, number - 1)
        twice = own.violations(number).withColumn("rule", F.lit("primary"))
        lost = parent.missing(rows, number).select(
            "l_orderkey", F.lit(None).cast("int").alias("l_linenumber"), F.lit(None).cast("long").alias("before"), "added", F.lit("foreign").alias("rule"))
        found += [r.select(F.lit(number).alias("load_no"), "rule", "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "before", "added")
                  for r in (twice, lost)]
    return union_all(found)


KEYS_TWO_LOADS = """
WITH rows AS (SELECT CAST(1 + l_suppkey % 2 AS INTEGER) AS load_no, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem),
per AS (SELECT load_no, l_orderkey, l_linenumber, count(*) AS added FROM rows GROUP BY ALL),
twice AS (
  SELECT p.load_no, p.l_orderkey, p.l_linenumber, CAST(coalesce(e.added, 0) AS BIGINT) AS before, p.added
  FROM per p LEFT JOIN per e ON e.load_no < p.load_no AND e.l_orderkey = p.l_orderkey AND e.l_linenumber = p.l_linenumber)
SELECT load_no, 'primary' AS rule, l_orderkey, l_linenumber, before, added FROM twice WHERE before + added > 1
UNION ALL
SELECT load_no, 'foreign', l_orderkey, NULL, NULL, count(*) FROM rows r
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND (o_orderstatus = 'F' OR o_orderstatus = 'O' AND load_no = 2))
GROUP BY load_no, l_orderkey"""


def rules_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and failures of three rules over documents, kept up load by load."""
    docs = labelled(spark, sf_dir)
    checks = [Check("quality", "doc_id", "documents"), Check("toxic", "doc_id", "documents"),
              Check("n_chars", "doc_id", "documents", code="TOO_SHORT", fails=F.col("n_chars") < 1000)]
    counts = rule_counts(docs, checks)
    view = MaintainedView(spark, new_folder(spark, "rule-totals"), counts.schema, sums=["rows", "failed"], buckets=2)
    for number in (0, 1):
        part = docs.filter(F.col("current_flag") == ("Y", "N")[number])
        view.step(counted(rule_counts(part, checks)), number)
    return view.read(2).drop("_count")


RULES_TWO_LOADS = f"""
WITH {LABELLED}, rules AS (
  SELECT 'ATTRIBUTE_IS_NULL' AS code, 'quality' AS source_attribute_name, quality IS NULL AS fails FROM labelled
  UNION ALL SELECT 'ATTRIBUTE_IS_NULL', 'toxic', toxic IS NULL FROM labelled
  UNION ALL SELECT 'TOO_SHORT', 'n_chars', coalesce(n_chars < 1000, false) FROM labelled)
SELECT 'Test' AS validation_routine, code, 'documents' AS source_object_name, source_attribute_name,
       count(*) AS rows, count(*) FILTER (WHERE fails) AS failed FROM rules GROUP BY code, source_attribute_name"""


# --- policies ---------------------------------------------------------------------------------

ADMIN, OTHER = "STEWARD", "ANALYST"


def _both_roles(df: DataFrame, policy) -> DataFrame:
    return union_all([policy(df, role).withColumn("seen_by", F.lit(role)) for role in (ADMIN, OTHER)])


def mask_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return _both_roles(customer, lambda df, role: policies.mask(df, "c_name", role, [ADMIN]))


def mask_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    public = F.col("c_mktsegment") == "BUILDING"
    return _both_roles(customer, lambda df, role: policies.mask_when(df, "c_name", role, [ADMIN], public))


def row_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Administrators see all customers, others those with a debt-free account."""
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return _both_roles(customer, lambda df, role: policies.row_filter(df, (F.lit(role) == ADMIN) | (F.col("c_acctbal") >= 0)))


def policy_on_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policies set on a table hold in a change feed and a count built on it; unset, data shows again."""
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    rules = policies.PolicySet()
    rules.set_mask("customer", "c_name", "name_mask", lambda role, df: policies.masked(F.col("c_name"), role, [ADMIN]))
    rules.add_row_policy("customer", "segment_rows", lambda role, df: F.col("c_mktsegment") != "FURNITURE")
    seen = rules.apply("customer", customer, OTHER)
    feed = change_feed(seen.filter(F.lit(False)), seen, "c_custkey")
    masked = feed.groupBy("c_mktsegment", "c_name").agg(F.count(F.lit(1)).alias("n")).withColumn("step", F.lit("set"))
    rules.drop_row_policy("customer")
    rules.unset_mask("customer", "c_name")
    shown = rules.apply("customer", customer, OTHER).groupBy("c_mktsegment").agg(
        F.max("c_name").alias("c_name"), F.count(F.lit(1)).alias("n"), F.lit("unset").alias("step"))
    return masked.unionByName(shown)


def policy_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policies by table and column, each with the values it masks or the rows it hides."""
    customer = load(spark, sf_dir, "customer")
    rules = policies.PolicySet()
    public = F.col("c_mktsegment") == "BUILDING"
    rules.set_mask("customer", "c_name", "name_mask", lambda role, df: policies.masked(F.col("c_name"), role, [ADMIN], public))
    rules.add_row_policy("customer", "debt_rows", lambda role, df: F.col("c_acctbal") >= 0)
    seen = rules.apply("customer", customer, OTHER)
    masked = seen.agg(F.count(F.when(F.col("c_name") == policies.MASKED, 1)).alias("n")).select(
        F.lit("name_mask").alias("policy_name"), "n")
    hidden = customer.agg(F.count(F.when(~(F.col("c_acctbal") >= 0), 1)).alias("n")).select(
        F.lit("debt_rows").alias("policy_name"), "n")
    return rules.references(spark).join(masked.unionByName(hidden), "policy_name")


def sql_scalar_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A two-argument policy as a SQL function."""
    show = policies.policy(
        spark, "shown_name", "name STRING, segment STRING", "STRING",
        f"CASE WHEN segment = 'BUILDING' THEN name ELSE '{policies.MASKED}' END")
    return load(spark, sf_dir, "customer").select("c_custkey", show(F.col("c_name"), F.col("c_mktsegment")).alias("c_name"))


# --- tags -------------------------------------------------------------------------------------

def _catalogue(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(tag, object, requests, columns) from parts: a table per type and brand, a column per name.

    Every table carries its brand's tag, every column its name's tag; columns of one name `small
    ring` are tagged at table level only.
    """
    part = load(spark, sf_dir, "part")
    table = F.concat_ws("_", "p_type", F.regexp_replace("p_brand", "#", "_"))
    brand_tag, name_tag = F.upper(F.regexp_replace("p_brand", "#", "_")), F.upper(F.regexp_replace("p_name", " ", "_"))
    tag = part.select(brand_tag.alias("name"), F.concat(F.lit("Brand "), "p_brand").alias("comment")).unionByName(
        part.select(name_tag.alias("name"), F.concat(F.lit("Part "), "p_name").alias("comment"))).distinct()
    tag = tag.select(F.col("name").alias("tag_id"), "name", "comment")
    tables = part.select(table.alias("name"), F.lit(None).cast("string").alias("attribute"), brand_tag.alias("tag_name")).distinct()
    columns = part.select(table.alias("name"), F.col("p_name").alias("attribute"), name_tag.alias("tag_name")).distinct()
    both = tables.unionByName(columns).withColumns({"database": F.lit("TEST"), "schema": F.lit("public")})
    obj = both.select(
        F.concat_ws(".", "name", "attribute").alias("object_id"), "database", "schema", "name", "attribute")
    requests = both.filter(F.col("attribute").isNull() | (F.col("attribute") != "small ring")).select(
        "tag_name", "database", "schema", F.col("name").alias("object_name"), "attribute")
    return tag, obj, requests, columns.select(F.col("name").alias("object_name"), F.col("attribute").alias("column_name"))


CATALOGUE = """
parts AS (
  SELECT p_type || '_' || replace(p_brand, '#', '_') AS tab, p_name, p_brand, upper(replace(p_brand, '#', '_')) AS brand_tag,
         upper(replace(p_name, ' ', '_')) AS name_tag FROM part),
refs AS (
  SELECT DISTINCT brand_tag AS tag_name, 'Brand ' || p_brand AS tag_comment, tab AS object_name, CAST(NULL AS VARCHAR) AS attribute FROM parts
  UNION ALL
  SELECT DISTINCT name_tag, 'Part ' || p_name, tab, p_name FROM parts WHERE p_name <> 'small ring'),
assigned AS (
  SELECT row_number() OVER (ORDER BY tag_name, concat_ws('.', object_name, attribute)) + 9999 AS tag_object_id,
         tag_name AS tag_id, concat_ws('.', object_name, attribute) AS object_id, tag_name, tag_comment,
         'TEST' AS database, 'public' AS schema, object_name, attribute FROM refs)"""


def assign_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag, obj, requests, _ = _catalogue(spark, sf_dir)
    return tags.assign_tag(requests, tag, obj)


def _tag_objects(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    tag, obj, requests, columns = _catalogue(spark, sf_dir)
    return tags.tag_objects(tags.assign_tag(requests, tag, obj), tag, obj), columns


def tag_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tag_objects(spark, sf_dir)[0]


def render_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags.render_tags(_tag_objects(spark, sf_dir)[0])


def tag_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    star, columns = _tag_objects(spark, sf_dir)
    return union_all([
        tags.tag_references(star, columns, level).select(
            F.lit(level).alias("level"), "object_name", "column_name", "tag_name", "tag_value", "inherited")
        for level in ("TABLE", "COLUMN", "ALL_COLUMNS")])


TAG_REFERENCES = f"""WITH {CATALOGUE}
SELECT 'TABLE' AS level, object_name, attribute AS column_name, tag_name, tag_comment AS tag_value, false AS inherited
FROM assigned WHERE attribute IS NULL
UNION ALL SELECT 'COLUMN', object_name, attribute, tag_name, tag_comment, false FROM assigned WHERE attribute IS NOT NULL
UNION ALL SELECT 'ALL_COLUMNS', object_name, attribute, tag_name, tag_comment, false FROM assigned WHERE attribute IS NOT NULL
UNION ALL SELECT 'ALL_COLUMNS', object_name, p_name, tag_name, tag_comment, true
FROM assigned JOIN (SELECT DISTINCT tab, p_name FROM parts) ON tab = object_name WHERE attribute IS NULL"""


def invalid_tag_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders tagged by priority; two priorities allow only the states seen in large orders."""
    orders = load(spark, sf_dir, "orders")
    assign = orders.select("o_orderkey", F.col("o_orderpriority").alias("tag_name"), F.col("o_orderstatus").alias("tag_value"))
    allowed = orders.filter(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("o_orderstatus") != "P") & (F.col("o_totalprice") > 1000)
    ).select(F.col("o_orderpriority").alias("tag_name"), F.col("o_orderstatus").alias("tag_value")).distinct()
    return tags.invalid_tag_values(assign, allowed).select("o_orderkey", "tag_name", "tag_value")


def tag_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags of regions reach nations, their customers and those customers' orders."""
    region, nation, customer, orders = (load(spark, sf_dir, t) for t in ("region", "nation", "customer", "orders"))

    def node(kind: str, col: str) -> Column:
        return F.concat(F.lit(f"{kind}:"), F.col(col).cast("string"))

    edges = union_all([
        nation.select(node("region", "n_regionkey").alias("upstream"), node("nation", "n_nationkey").alias("downstream")),
        customer.select(node("nation", "c_nationkey"), node("customer", "c_custkey")),
        orders.select(node("customer", "o_custkey"), node("order", "o_orderkey")),
    ])
    assign = region.select(F.col("r_name").alias("tag_name"), node("region", "r_regionkey").alias("object_name"))
    return tags.tag_lineage(assign, edges)


TAG_LINEAGE = """
WITH RECURSIVE edges AS (
  SELECT 'region:' || n_regionkey AS upstream, 'nation:' || n_nationkey AS downstream FROM nation
  UNION ALL SELECT 'nation:' || c_nationkey, 'customer:' || c_custkey FROM customer
  UNION ALL SELECT 'customer:' || o_custkey, 'order:' || o_orderkey FROM orders),
reach AS (
  SELECT r_name AS tag_name, 'region:' || r_regionkey AS object_name, 0 AS depth FROM region
  UNION SELECT tag_name, downstream, depth + 1 FROM reach JOIN edges ON upstream = object_name)
SELECT tag_name, object_name, min(depth) AS depth FROM reach GROUP BY 1, 2"""


# --- classification ---------------------------------------------------------------------------

CLASSIFIED = ("customer", "part", "pages", "documents")


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.classify_schema({f"test.public.{t}": load(spark, sf_dir, t) for t in CLASSIFIED})


def classify_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load(spark, sf_dir, "customer")
    return classify.classify_columns(customer, path="test.public.customer").select(
        "path_to_object", "attribute", "semantic_category", "privacy_category",
        F.col("probability").cast("double").alias("probability"), F.array_join("alternates", ",").alias("alternates"))


def classify_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir).select(
        "path_to_object", "attribute", "semantic_category", "privacy_category",
        F.col("probability").cast("double").alias("probability"), F.array_join("alternates", ",").alias("alternates"))


COLUMNS = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "pages": ["page_id", "url", "html"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
}


def _ratios(tables: tuple[str, ...]) -> str:
    branches = [
        f"SELECT 'test.public.{t}' AS path_to_object, '{c}' AS attribute, {j} AS rule_no, '{r.semantic_category}' AS semantic_category,"
        f" '{r.privacy_category}' AS privacy_category,"
        f" count(*) FILTER (WHERE regexp_matches(CAST({c} AS VARCHAR), '{r.pattern}')) / nullif(count({c}), 0)::DOUBLE AS ratio FROM {t}"
        for t in tables for c in COLUMNS[t] for j, r in enumerate(classify.RULES)]
    return f"""ratios AS ({' UNION ALL '.join(branches)}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY path_to_object, attribute ORDER BY ratio DESC, rule_no) AS place
  FROM ratios WHERE ratio >= 0.8),
found AS (
  SELECT a.path_to_object, a.attribute, b.semantic_category, b.privacy_category,
         CAST(CAST(b.ratio AS DECIMAL(10,2)) AS DOUBLE) AS probability, coalesce(o.alternates, '') AS alternates
  FROM (SELECT DISTINCT path_to_object, attribute FROM ratios) a
  LEFT JOIN (SELECT * FROM ranked WHERE place = 1) b ON b.path_to_object = a.path_to_object AND b.attribute = a.attribute
  LEFT JOIN (SELECT path_to_object, attribute, string_agg(semantic_category, ',' ORDER BY place) AS alternates
             FROM ranked WHERE place > 1 GROUP BY 1, 2) o
         ON o.path_to_object = a.path_to_object AND o.attribute = a.attribute)"""


def q_flatten_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = classify.classification_document(_found(spark, sf_dir))
    rows = flatten_classification(docs, "doc", "path_to_object", ntz(AS_OF))
    return rows.withColumn("probability", F.col("probability").cast("double"))


def classification_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Found classifiers, the customer table's approved except its key, as one document per state."""
    rows = classify.found_classifiers(_found(spark, sf_dir), AS_OF)
    approved = update_where(
        rows, (F.col("path_to_object") == "test.public.customer") & (F.col("attribute") != "c_custkey"),
        {"deploy_flag": F.lit("Y")})
    return classify.classification_json(cut_lineage(approved, "classifiers"))


CLASSIFICATION_JSON = f"""WITH {_ratios(CLASSIFIED)}
SELECT path_to_object, deploy_flag, part_no,
       '{{' || string_agg('"' || attribute || '":{{"extra_info":{{"alternates":[],"probability":"' || CAST(CAST(probability AS DECIMAL(10,2)) AS VARCHAR)
         || '"}},"privacy_category":"' || privacy_category || '","semantic_category":"' || semantic_category || '"}}', ',' ORDER BY attribute) || '}}' AS json_string
FROM (SELECT *, CASE WHEN path_to_object = 'test.public.customer' AND attribute <> 'c_custkey' THEN 'Y' ELSE 'N' END AS deploy_flag
             , CAST((row_number() OVER (PARTITION BY path_to_object, path_to_object = 'test.public.customer' AND attribute <> 'c_custkey'
                                       ORDER BY attribute) - 1) // 10000 AS INTEGER) AS part_no
      FROM found WHERE privacy_category IS NOT NULL) GROUP BY 1, 2, 3"""


def q_schema_from_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging and target types come from constructor rows; the delivered file is loaded with them."""
    orders = load(spark, sf_dir, "orders")
    rows = [
        ("ORDERS", 0, "STAGING_TABLE", "STG_ORDERS", "STAGING", None, None, None, None),
        ("ORDERS", 10, "ATTRIBUTE", "O_TOTALPRICE", "VARCHAR", "255", "TOTAL_PRICE", "NUMBER", "18,2"),
        ("ORDERS", 2, "PRIMARY_KEY", "O_ORDERKEY", "VARCHAR", "255", "ORDER_ID", "NUMBER", "10"),
        ("ORDERS", 9, "DATE_MASTER_KEY", "O_ORDERDATE", "VARCHAR", "255", "ORDER_DATE", "TIMESTAMP_NTZ", None),
        ("PARTS", 1, "PRIMARY_KEY", "P_PARTKEY", "VARCHAR", "255", "PART_ID", "NUMBER", "10"),
    ]
    constructor = spark.createDataFrame(
        rows, "dataset string, position int, label string, source_attribute string, source_datatype string,"
              " source_precision string, target_attribute string, target_datatype string, target_precision string")
    built = schema_from_metadata(constructor, "ORDERS")
    folder = new_folder(spark, "constructor")
    unload(orders.select("o_orderkey", "o_orderdate", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice")), folder, COMMA)
    staged = read_delimited(spark, folder, built.source)
    renamed = staged.toDF(*built.target.names)
    typed = append_typed(renamed, built.target, 1, ["order_id"], "stg_orders_id")
    return typed.select("stg_orders_id", F.col("order_id").cast("bigint").alias("order_id"), "order_date",
                        F.col("total_price").cast("double").alias("total_price"))


QUERIES: Registry = {
    "dq_not_null": (q_dq_not_null, _dq_sql(_dq_branch("quality", 10000, "quality IS NULL"))),
    "dq_suite": (dq_suite, _dq_sql(" UNION ALL ".join([
        _dq_branch("quality", 10000, "quality IS NULL"), _dq_branch("toxic", 10000, "toxic IS NULL"),
        _dq_branch("n_chars", 10001, "n_chars < 500")]))),
    "key_checks": (key_checks, KEY_CHECKS),
    "keys_two_loads": (keys_two_loads, KEYS_TWO_LOADS),
    "rules_two_loads": (rules_two_loads, RULES_TWO_LOADS),
    "mask_role": (mask_role, f"""
SELECT c_custkey, c_name, '{ADMIN}' AS seen_by FROM customer
UNION ALL SELECT c_custkey, '{policies.MASKED}', '{OTHER}' FROM customer"""),
    "mask_conditional": (mask_conditional, f"""
SELECT c_custkey, c_name, c_mktsegment, '{ADMIN}' AS seen_by FROM customer
UNION ALL SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE '{policies.MASKED}' END, c_mktsegment, '{OTHER}' FROM customer"""),
    "row_access": (row_access, f"""
SELECT c_custkey, c_acctbal, '{ADMIN}' AS seen_by FROM customer
UNION ALL SELECT c_custkey, c_acctbal, '{OTHER}' FROM customer WHERE c_acctbal >= 0"""),
    "policy_on_view": (policy_on_view, f"""
SELECT c_mktsegment, '{policies.MASKED}' AS c_name, count(*) AS n, 'set' AS step FROM customer WHERE c_mktsegment <> 'FURNITURE' GROUP BY 1
UNION ALL SELECT c_mktsegment, max(c_name), count(*), 'unset' FROM customer GROUP BY 1"""),
    "policy_references": (policy_references, """
SELECT 'name_mask' AS policy_name, 'MASKING_POLICY' AS policy_kind, 'customer' AS object_name, 'c_name' AS column_name,
       count(*) AS n FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'BUILDING'
UNION ALL SELECT 'debt_rows', 'ROW_ACCESS_POLICY', 'customer', NULL, count(*) FROM customer WHERE c_acctbal < 0"""),
    "sql_scalar_function": (sql_scalar_function, f"""
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE '{policies.MASKED}' END AS c_name FROM customer"""),
    "assign_tag": (assign_tag, f"WITH {CATALOGUE} SELECT tag_object_id, tag_id, object_id FROM assigned"),
    "tag_objects": (tag_objects, f"WITH {CATALOGUE} SELECT * FROM assigned"),
    "render_tags": (render_tags, f"""WITH {CATALOGUE}
SELECT 'CREATE OR REPLACE TAG ' || tag_name || ' COMMENT = ''' || tag_comment || ''';' AS create_tag_stmt,
       'ALTER TABLE TEST.public.' || object_name || CASE WHEN attribute IS NULL THEN '' ELSE ' MODIFY COLUMN ' || attribute END
         || ' SET TAG ' || tag_name || ' = ''' || tag_comment || ''';' AS apply_tag_stmt,
       tag_name, tag_comment, database, schema, object_name, attribute FROM assigned"""),
    "tag_references": (tag_references, TAG_REFERENCES),
    "invalid_tag_values": (invalid_tag_values, """
WITH allowed AS (
  SELECT DISTINCT o_orderpriority AS p, o_orderstatus AS s FROM orders
  WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus <> 'P' AND o_totalprice > 1000)
SELECT o_orderkey, o_orderpriority AS tag_name, o_orderstatus AS tag_value FROM orders
WHERE o_orderpriority IN (SELECT p FROM allowed) AND (o_orderpriority, o_orderstatus) NOT IN (SELECT (p, s) FROM allowed)"""),
    "tag_lineage": (tag_lineage, TAG_LINEAGE),
    "classify_columns": (classify_columns, f"WITH {_ratios(('customer',))} SELECT * FROM found"),
    "classify_schema": (classify_schema, f"WITH {_ratios(CLASSIFIED)} SELECT * FROM found"),
    "flatten_classification": (q_flatten_classification, f"""WITH {_ratios(CLASSIFIED)}
SELECT path_to_object, attribute, privacy_category, semantic_category, probability, 'N' AS deploy_flag,
       TIMESTAMP '{AS_OF}' AS last_updated FROM found WHERE privacy_category IS NOT NULL"""),
    "classification_json": (classification_json, CLASSIFICATION_JSON),
    "schema_from_metadata": (q_schema_from_metadata, """
SELECT row_number() OVER (ORDER BY o_orderkey) AS stg_orders_id, o_orderkey AS order_id, o_orderdate AS order_date,
       o_totalprice AS total_price FROM orders"""),
}
