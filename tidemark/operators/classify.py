"""Semantic classification of columns by pattern rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import ntz
from tidemark.operators.aggregates import json_per_group
from tidemark.operators.joins import union_all


@dataclass(frozen=True)
class Rule:
    r"""A value belongs to the category when the whole value matches the pattern.

    `spaces` restates what the pattern implies, so that prose is ruled out without running the
    pattern over it. Patterns end in `\z`: `$` would also match before a last line break.
    """

    semantic_category: str
    privacy_category: str
    pattern: str
    spaces: bool = False

    def fits(self, value: Column) -> Column:
        test = value.rlike(self.pattern)
        if not self.spaces:
            test = ~F.contains(value, F.lit(" ")) & test
        return test


# Our own rules; the categories follow the usual names of such classifiers.
RULES = (
    Rule("EMAIL", "IDENTIFIER", r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\z"),
    Rule("US_SSN", "IDENTIFIER", r"^[0-9]{3}-[0-9]{2}-[0-9]{4}\z"),
    Rule("UK_NATIONAL_INSURANCE", "IDENTIFIER", r"^[A-Z]{2}[0-9]{6}[A-Z]\z"),
    Rule("URL", "IDENTIFIER", r"^https?://[^ ]+\z"),
    Rule("IP_ADDRESS", "IDENTIFIER", r"^([0-9]{1,3}\.){3}[0-9]{1,3}\z"),
    Rule("ACCOUNT_NAME", "IDENTIFIER", r"^[A-Za-z]+#[0-9]+\z"),
    Rule("UK_POSTCODE", "QUASI_IDENTIFIER", r"^[A-Z]{1,2}[0-9][0-9A-Z]? [0-9][A-Z]{2}\z", spaces=True),
    Rule("US_POSTAL_CODE", "QUASI_IDENTIFIER", r"^[0-9]{5}(-[0-9]{4})?\z"),
    Rule("GENDER", "QUASI_IDENTIFIER", r"^([Mm]ale|[Ff]emale|MALE|FEMALE)\z"),
    Rule("LANGUAGE", "QUASI_IDENTIFIER", r"^[a-z]{2}\z"),
    Rule("AMOUNT", "SENSITIVE", r"^-?[0-9]+\.[0-9]+\z"),
)


def classify_columns(df: DataFrame, rules: Sequence[Rule] = RULES, path: str = "", min_ratio: float = 0.8) -> DataFrame:
    """One row per column: attribute, semantic_category, privacy_category, probability, alternates.

    All match counts come from one pass: a row fans out to (column, value) pairs, which are counted
    per column before the shuffle. The best rule at or above `min_ratio` wins, earlier rules first;
    the others that qualify are alternates. A column no rule fits, or without values, has NULL
    categories; an empty table has no rows.
    """
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("attribute"), F.col(n).cast("string").alias("v")) for n in df.columns
    ])).alias("c")).select("c.*")
    counts = pairs.groupBy("attribute").agg(F.count("v").alias("n"), *[
        F.count(F.when(r.fits(F.col("v")), 1)).alias(f"m_{j}") for j, r in enumerate(rules)])
    hits = F.array(*[F.struct(
        F.try_divide(F.col(f"m_{j}"), F.col("n")).alias("ratio"), F.lit(-j).alias("rank"),
        F.lit(r.semantic_category).alias("semantic"), F.lit(r.privacy_category).alias("privacy"),
    ) for j, r in enumerate(rules)])
    ranked = counts.select(
        "attribute", F.sort_array(F.filter(hits, lambda h: h.ratio >= min_ratio), asc=False).alias("fit"))
    best = F.get("fit", F.lit(0))
    return ranked.select(
        F.lit(path).alias("path_to_object"), "attribute",
        best.semantic.alias("semantic_category"), best.privacy.alias("privacy_category"),
        best.ratio.cast("decimal(10,2)").alias("probability"),
        F.coalesce(F.transform(F.slice("fit", 2, len(rules)), lambda h: h.semantic), F.array().cast("array<string>"))
        .alias("alternates"),
    )


def classify_schema(tables: Mapping[str, DataFrame], rules: Sequence[Rule] = RULES, min_ratio: float = 0.8) -> DataFrame:
    """Classification of every table of a schema, keyed by path; only the names are on the driver."""
    return union_all([classify_columns(df, rules, path, min_ratio) for path, df in tables.items()])


def classification_entry() -> Column:
    """Document entry of one column."""
    return F.struct(
        F.struct(F.col("alternates"), F.col("probability").cast("string").alias("probability")).alias("extra_info"),
        "privacy_category", "semantic_category")


def classification_document(found: DataFrame) -> DataFrame:
    """VARIANT documents per table and part of its columns: {attribute: {extra_info, privacy_category, semantic_category}}."""
    docs = json_per_group(found, ["path_to_object"], "attribute", classification_entry(), "json")
    return docs.select("path_to_object", "part_no", F.parse_json("json").alias("doc"))


def found_classifiers(found: DataFrame, now: datetime | str) -> DataFrame:
    """Rows of the classifier table: columns with a privacy category, not yet approved."""
    return found.filter(F.col("privacy_category").isNotNull()).select(
        "path_to_object", "attribute", "privacy_category", "semantic_category", "probability",
        F.lit("N").alias("deploy_flag"), ntz(now).alias("last_updated"))


def classification_json(df: DataFrame) -> DataFrame:
    """JSON documents per (path_to_object, deploy_flag, part_no) from classifier rows."""
    filled = df.withColumn("alternates", F.array().cast("array<string>"))
    return json_per_group(filled, ["path_to_object", "deploy_flag"], "attribute", classification_entry(), "json_string")
