"""Object tags: catalogue star, statements, references, allowed values, lineage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import joined
from tidemark.operators.joins import cross_lookup, union_all
from tidemark.operators.ordered import assign_ids
from tidemark.session import cut_lineage


def tag_objects(assign: DataFrame, tag: DataFrame, obj: DataFrame) -> DataFrame:
    """Assignments with tag and object names.

    assign(tag_object_id, tag_id, object_id), tag(tag_id, name, comment),
    object(object_id, database, schema, name, attribute); a NULL attribute is a table-level tag.
    """
    named_tag = tag.select("tag_id", F.col("name").alias("tag_name"), F.col("comment").alias("tag_comment"))
    named_object = obj.select("object_id", "database", "schema", F.col("name").alias("object_name"), "attribute")
    return assign.join(named_tag, "tag_id").join(named_object, "object_id").select(
        "tag_object_id", "tag_id", "object_id", "tag_name", "tag_comment", "database", "schema", "object_name",
        "attribute")


def assign_tag(requests: DataFrame, tag: DataFrame, obj: DataFrame, start: int = 10000) -> DataFrame:
    """Assignment rows for requests(tag_name, database, schema, object_name, attribute) found by name."""
    wanted = requests.withColumn("_attribute", F.coalesce("attribute", F.lit("")))
    tags = tag.select("tag_id", F.col("name").alias("_tag"))
    objects = obj.select("object_id", F.col("database").alias("_database"), F.col("schema").alias("_schema"),
                         F.col("name").alias("_object"), F.coalesce("attribute", F.lit("")).alias("_at"))
    pairs = cross_lookup(
        wanted, tags, objects, {"tag_name": "_tag"},
        {"database": "_database", "schema": "_schema", "object_name": "_object", "_attribute": "_at"})
    return assign_ids(pairs.select("tag_id", "object_id"), start, ["tag_id", "object_id"], "tag_object_id")


def render_tags(v: DataFrame) -> DataFrame:
    """Create and apply statements per assignment, table or column form. The statement texts."""
    table = joined(F.col("database"), F.col("schema"), F.col("object_name"), sep=".")
    value = F.concat(F.lit(" SET TAG "), "tag_name", F.lit(" = '"), "tag_comment", F.lit("';"))
    column = F.when(F.col("attribute").isNull(), F.lit("")).otherwise(F.concat(F.lit(" MODIFY COLUMN "), "attribute"))
    return v.select(
        F.concat(F.lit("CREATE OR REPLACE TAG "), "tag_name", F.lit(" COMMENT = '"), "tag_comment", F.lit("';"))
        .alias("create_tag_stmt"),
        F.concat(F.lit("ALTER TABLE "), table, column, value).alias("apply_tag_stmt"),
        "tag_name", "tag_comment", "database", "schema", "object_name", "attribute",
    )


def tag_references(v: DataFrame, columns: DataFrame, level: str = "ALL_COLUMNS") -> DataFrame:
    """Tags of tables, of columns, or of all columns with table tags inherited.

    v as from `tag_objects`; columns(object_name, column_name) is the catalogue. Result:
    object_name, column_name (NULL at table level), tag_name, tag_value, inherited.
    """
    direct = v.select("object_name", F.col("attribute").alias("column_name"), "tag_name",
                      F.col("tag_comment").alias("tag_value"))
    tables = direct.filter(F.col("column_name").isNull())
    own = direct.filter(F.col("column_name").isNotNull()).withColumn("inherited", F.lit(False))
    if level == "TABLE":
        return tables.withColumn("inherited", F.lit(False))
    if level == "COLUMN":
        return own
    if level != "ALL_COLUMNS":
        raise ValueError(f"unknown level: {level}")
    passed = tables.drop("column_name").join(columns.select("object_name", "column_name"), "object_name")
    hidden = own.select("object_name", "column_name", "tag_name").distinct()
    passed = passed.join(hidden, ["object_name", "column_name", "tag_name"], "left_anti")
    passed = passed.select("object_name", "column_name", "tag_name", "tag_value", F.lit(True).alias("inherited"))
    return own.unionByName(passed)


def tag_value(references: DataFrame, tag_name: str, object_name: str, column_name: str | None = None) -> DataFrame:
    """Value of one tag on a table or column."""
    test = (F.col("tag_name") == tag_name) & (F.col("object_name") == object_name)
    at = F.col("column_name").isNull() if column_name is None else F.col("column_name") == column_name
    return references.filter(test & at).select("tag_value")


def invalid_tag_values(assign: DataFrame, allowed: DataFrame) -> DataFrame:
    """Assignments (tag_name, tag_value, ...) outside the allowed values; a tag without any list is free."""
    restricted = assign.join(allowed.select("tag_name").distinct(), "tag_name", "left_semi")
    return restricted.join(allowed.select("tag_name", "tag_value").distinct(), ["tag_name", "tag_value"], "left_anti")


def tag_lineage(assign: DataFrame, edges: DataFrame, tag: str | Sequence[str] | None = None) -> DataFrame:
    """Objects reached from tagged objects along dependency edges, with the smallest depth.

    assign(tag_name, object_name), edges(upstream, downstream). Edges are written once as two
    columns, each level once; a level is one join and one aggregation that combines repeated paths
    before the shuffle. Objects already reached are left out, so cycles end.
    """
    if tag is not None:
        names = [tag] if isinstance(tag, str) else list(tag)
        assign = assign.filter(F.col("tag_name").isin(names))
    names = ["tag_name", "object_name"]
    level = cut_lineage(assign.select(*names).distinct().withColumn("depth", F.lit(0)), "lineage")
    links = cut_lineage(edges.select(F.col("upstream").alias("object_name"), "downstream"), "edges")
    reached = [level]
    while not level.isEmpty():
        step = level.join(links, "object_name").select(
            "tag_name", F.col("downstream").alias("object_name"), F.lit(len(reached)).alias("depth"))
        # Only the frontier is aggregated; earlier levels are read as keys of an anti join.
        level = cut_lineage(step.distinct().join(union_all(reached).select(*names), names, "left_anti"), "lineage")
        reached.append(level)
    return union_all(reached)
