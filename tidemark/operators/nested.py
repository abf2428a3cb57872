"""Semi-structured values: explode arrays and objects, JSON paths, documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.compare import rescale


def json_path(value: Column | str, path: str, kind: str = "string", strict: bool = False) -> Column:
    """Value at a path such as `$.a[0].b`, NULL when the path is missing.

    A value that does not convert is NULL too, or raises when strict.
    """
    return (F.variant_get if strict else F.try_variant_get)(value, path, kind)


def _lateral(df: DataFrame, source: Column, outer: bool, prefix: str) -> DataFrame:
    tvf = df.sparkSession.tvf
    exploded = (tvf.variant_explode_outer if outer else tvf.variant_explode)(source)
    names = [F.col(c).alias(f"{prefix}{c}") for c in ("pos", "key", "value")]
    return df.lateralJoin(exploded.select(names))


def explode_json(df: DataFrame, column: str, path: str = "$", outer: bool = False, prefix: str = "") -> DataFrame:
    """One row per element of the array, or per field of the object, at `path`.

    Adds {prefix}pos, {prefix}key (objects) and {prefix}value. `outer` keeps rows whose array is
    missing or empty. A narrow generate step: no shuffle.
    """
    source = F.col(column).outer()
    if path != "$":
        source = F.try_variant_get(source, path, "variant")
    return _lateral(df, source, outer, prefix)


def extract(df: DataFrame, fields: Mapping[str, tuple[str, str] | tuple[str, str, str]], keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns {name: (variant column, path[, type])}; type defaults to string."""
    columns = [json_path(spec[0], spec[1], spec[2] if len(spec) > 2 else "string").alias(name)
               for name, spec in fields.items()]
    return df.select(*keep, *columns)


def nested_view(docs: DataFrame, column: str, first: str, second: str, fields: Mapping[str, str],
                inner_fields: Mapping[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Flat rows of a two-level document: one per element of `first`, times its `second` elements.

    An element without `second` rows appears once with NULLs.
    """
    outer_rows = explode_json(docs, column, first, prefix="e_")
    both = explode_json(outer_rows, "e_value", second, outer=True, prefix="p_")
    specs = {name: ("e_value", path) for name, path in fields.items()}
    specs.update({name: ("p_value", path) for name, path in inner_fields.items()})
    return extract(both, specs, keep)


def row_variant(*columns: str) -> Column:
    """The row as a VARIANT object."""
    return F.to_variant_object(F.struct(*columns))


def row_json(*columns: str) -> Column:
    """The row as JSON text; NULL fields are left out."""
    return F.to_json(F.struct(*columns))


def flatten_classification(docs: DataFrame, doc: str, path_col: str, now: Column,
                           reference_rounding: bool = False) -> DataFrame:
    """Classification documents to rows, attributes without a privacy category left out.

    `reference_rounding` lands the probability in a scale-0 column, i.e. 0 or 1.
    """
    rows = explode_json(docs, doc)
    probability = rescale(json_path("value", "$.extra_info.probability"), 10, 2, reference_rounding)
    return rows.select(
        F.col(path_col).alias("path_to_object"),
        F.col("key").alias("attribute"),
        json_path("value", "$.privacy_category").alias("privacy_category"),
        json_path("value", "$.semantic_category").alias("semantic_category"),
        probability.alias("probability"),
        F.lit("N").alias("deploy_flag"),
        now.alias("last_updated"),
    ).filter(F.col("privacy_category").isNotNull())
