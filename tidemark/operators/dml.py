"""Row changes as pure functions: each returns the next state of the target.

File tables have no UPDATE, DELETE or MERGE; the caller writes the returned state to a new
snapshot path and never over the path being read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.compare import equal_on
from tidemark.operators.changes import present

DELETE = "delete"
Clause = tuple[Column | None, "Mapping[str, Column] | str"]


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _required(column: Column, name: str) -> Column:
    return F.when(column.isNull(), F.raise_error(F.lit(f"NULL in required column {name}"))).otherwise(column)


def append_rows(target_schema: T.StructType, df: DataFrame, defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows in target order and type; absent columns take their default, else NULL."""
    defaults = defaults or {}
    out = []
    for field in target_schema:
        if field.name in df.columns:
            column = F.col(field.name)
        elif field.name in defaults:
            column = defaults[field.name]
        else:
            column = F.lit(None)
        column = column.cast(field.dataType)
        out.append((column if field.nullable else _required(column, field.name)).alias(field.name))
    return df.select(out)


def with_defaults(df: DataFrame, defaults: Mapping[str, Column], not_null: Sequence[str] = ()) -> DataFrame:
    """Fill NULLs from defaults, then raise on a NULL in a required column."""
    out = []
    for name in df.columns:
        column = F.coalesce(F.col(name), defaults[name]) if name in defaults else F.col(name)
        out.append((_required(column, name) if name in not_null else column).alias(name))
    extra = [column.alias(name) for name, column in defaults.items() if name not in df.columns]
    return df.select(*out, *extra)


def update_where(df: DataFrame, pred: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """SET the columns on rows where the predicate is true."""
    hit = F.coalesce(pred, F.lit(False))
    return df.select([
        F.when(hit, assignments[c]).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c)
        for c in df.columns
    ])


def delete_where(df: DataFrame, pred: Column) -> DataFrame:
    """Drop rows where the predicate is true; false and NULL stay."""
    return df.filter(~F.coalesce(pred, F.lit(False)))


def truncate(df: DataFrame) -> DataFrame:
    """No rows, same schema."""
    return df.filter(F.lit(False))


def null_facts(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """(rows, rows with a NULL key) as one aggregate."""
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(~present(keys), 1)).alias("n_null"),
    ).first()
    return row["n"], row["n_null"]


def delete_missing(tgt: DataFrame, src: DataFrame, key: str, null_aware: bool = True) -> DataFrame:
    """Drop target rows whose key is absent from the source.

    null_aware gives NOT IN: a NULL source key deletes nothing, an empty source deletes all rows,
    otherwise a NULL target key stays.
    """
    kept = tgt.join(src.select(key).distinct(), key, "left_semi")
    if not null_aware:
        return kept
    rows, nulls = null_facts(src, [key])
    if rows == 0:
        return truncate(tgt)
    if nulls:
        return tgt
    return kept.select(*tgt.columns).unionByName(tgt.filter(F.col(key).isNull()))


def _single_source(src: DataFrame, keys: list[str], null_safe: bool) -> DataFrame:
    """Source rows that can match, with `_copies` set where several share a key.

    Only repeated keys are joined back: normally none, and then the join is dropped at run time.
    """
    usable = src if null_safe else src.filter(present(keys))
    repeated = usable.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies")).filter(F.col("_copies") > 1)
    return usable.alias("s").join(repeated.alias("c"), equal_on("s", "c", keys, null_safe), "left").select("s.*", "c._copies")


def merge(tgt: DataFrame, src: DataFrame, on: str | Sequence[str], matched: Sequence[Clause] = (),
          not_matched: Sequence[tuple[Column | None, Mapping[str, Column]]] = (), null_safe: bool = False,
          check_source: bool = True) -> DataFrame:
    """MERGE with conditional clauses; the first clause whose predicate is true applies.

    matched: (predicate, {target column: value} or DELETE), columns written `tgt.x` / `src.x`.
    not_matched: (predicate, {target column: value}) for source rows without a target row.
    Two source rows for one target row raise unless check_source is off.

    A left and an anti join instead of one full outer join, so that adaptive execution may split a
    hot key of the target. A small source is sent to all tasks by adaptive execution, which knows its true size.
    The source is read by each part: pass a written one when it is costly to compute.
    """
    keys = _keys(on)
    source = _single_source(src, keys, null_safe) if check_source else src.withColumn("_copies", F.lit(None).cast("long"))
    pairs = tgt.alias("tgt").join(
        source.withColumn("_found", F.lit(True)).alias("src"), equal_on("tgt", "src", keys, null_safe), "left")
    found = F.when(F.col("src._copies") > 1, F.raise_error(F.lit("merge: several source rows for one target row")))
    found = found.otherwise(F.coalesce(F.col("src._found"), F.lit(False)))
    clause = F.lit(None).cast("int")
    for i in reversed(range(len(matched))):
        pred = matched[i][0]
        test = found if pred is None else found & F.coalesce(pred, F.lit(False))
        clause = F.when(test, F.lit(i)).otherwise(clause)
    pairs = pairs.withColumn("_clause", clause)
    deleting = [i for i, (_, action) in enumerate(matched) if action == DELETE]
    if deleting:
        pairs = pairs.filter(F.col("_clause").isNull() | ~F.col("_clause").isin(deleting))
    out = []
    for field in tgt.schema:
        column = F.col(f"tgt.{field.name}")
        value = column
        for i, (_, action) in enumerate(matched):
            if action != DELETE and field.name in action:
                value = F.when(F.col("_clause") == i, action[field.name].cast(field.dataType)).otherwise(value)
        out.append(value.alias(field.name))
    result = pairs.select(out)
    if not not_matched:
        return result
    fresh = unmatched(src, tgt, keys, null_safe).alias("src")
    taken = F.lit(False)
    for pred, values in not_matched:
        test = F.lit(True) if pred is None else F.coalesce(pred, F.lit(False))
        rows = fresh.filter(test & ~taken).select([
            (values[f.name] if f.name in values else F.lit(None)).cast(f.dataType).alias(f.name) for f in tgt.schema
        ])
        result = result.unionByName(rows)
        taken = taken | test
    return result


def unmatched(src: DataFrame, tgt: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Source rows without a target row of the same key; adaptive execution sends the smaller side."""
    known = tgt.select(*keys)
    known = known.distinct().alias("t")
    return src.alias("s").join(known, equal_on("s", "t", keys, null_safe), "left_anti")


def update_from(tgt: DataFrame, src: DataFrame, key: str | Sequence[str], match_col: str) -> DataFrame:
    """Copy every non-key source column where the key is equal and `match_col` differs."""
    keys = _keys(key)
    values = {c: F.col(f"src.{c}") for c in tgt.columns if c not in keys and c in src.columns}
    return merge(tgt, src, keys, matched=[(F.col(f"src.{match_col}") != F.col(f"tgt.{match_col}"), values)])


def run_counted(df: DataFrame, name: str) -> tuple[DataFrame, Callable[[], int]]:
    """The frame to write, and a function giving the rows written once the write has run."""
    seen = Observation(name)
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    return counted, lambda: seen.get["rows"]
