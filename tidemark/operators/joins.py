"""Joins, set operations and lookups.

No join type is forced: small sides are broadcast by the planner's own size check, large ones are
shuffled, and adaptive execution splits skewed partitions of inner, left, semi and anti joins. A
full outer join cannot be split, so `reconcile` is composed of joins that can.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.compare import equal_on
from tidemark.functions.dates import add_time, ntz


def _names(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def inner(l: DataFrame, r: DataFrame, on: str | Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Inner equi join on shared names, or on a {left: right} mapping."""
    if isinstance(on, Mapping):
        condition = reduce(lambda a, b: a & b, [l[a] == r[b] for a, b in on.items()])
        return l.join(r, condition, "inner")
    return l.join(r, _names(on), "inner")


def star(a: DataFrame, b: DataFrame, c: DataFrame, keys: Sequence[Mapping[str, str]]) -> DataFrame:
    """Three relations along two foreign keys: keys = [{a: b}, {b: c}]."""
    return inner(inner(a, b, keys[0]), c, keys[1])


def star_filter(fact: DataFrame, dims: Sequence[tuple[DataFrame, Mapping[str, str], Column | None]]) -> DataFrame:
    """Fact joined with dimensions, each filtered first: dims = [(dimension, {fact: dim}, predicate)]."""
    for dim, keys, predicate in dims:
        fact = inner(fact, dim if predicate is None else dim.filter(predicate), keys)
    return fact


def reconcile(view: DataFrame, hist: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join; output columns are prefixed `v_` and `h_`, `side` tells where a row was found.

    Inner join plus two anti joins: each can be split on a hot key, a full outer join cannot.
    """
    on = list(on)
    v = view.select([F.col(c).alias(f"v_{c}") for c in view.columns])
    h = hist.select([F.col(c).alias(f"h_{c}") for c in hist.columns])
    condition = reduce(lambda a, b: a & b, [F.col(f"v_{c}") == F.col(f"h_{c}") for c in on])
    hist_keys = h.select([f"h_{c}" for c in on]).distinct()
    view_keys = v.select([f"v_{c}" for c in on]).distinct()
    nulls = lambda frame: [F.lit(None).cast(f.dataType).alias(f.name) for f in frame.schema]
    both = v.join(h, condition).select("*", F.lit("both").alias("side"))
    only_v = v.join(hist_keys, condition, "left_anti").select("*", *nulls(h), F.lit("view").alias("side"))
    only_h = h.join(view_keys, condition, "left_anti").select(*nulls(v), "*", F.lit("hist").alias("side"))
    return both.unionByName(only_v).unionByName(only_h)


def semi(l: DataFrame, r: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of l whose key occurs in r. Distinct keys are combined before the shuffle."""
    names = _names(key)
    return l.join(r.select(*names).distinct(), names, "left_semi")


def minus(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct set difference; NULLs compare as equal."""
    return a.subtract(b)


def new_rows(src: DataFrame, tgt: DataFrame, key: str) -> DataFrame:
    """Source rows whose key is not in the target; a NULL key is never new."""
    return src.filter(F.col(key).isNotNull()).join(tgt.select(key).distinct(), key, "left_anti")


def anti(l: DataFrame, r: DataFrame, key: str, null_aware: bool = True) -> DataFrame:
    """Rows of l whose key is not in r.

    null_aware reproduces NOT IN: a NULL in r keeps nothing, an empty r keeps everything, and a
    NULL key in l is kept only for an empty r. Two one-row facts about r replace the null-aware
    broadcast join, so r may be of any size.
    """
    plain = l.join(r.select(key).distinct(), key, "left_anti")
    if not null_aware:
        return plain
    facts = r.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col(key).isNull(), 1)).alias("n_null"),
    ).first()
    if facts["n"] == 0:
        return l
    if facts["n_null"]:
        return l.filter(F.lit(False))
    return plain.filter(F.col(key).isNotNull())


def join_diff(l: DataFrame, r: DataFrame, on: Mapping[str, str], differs: Column) -> DataFrame:
    """Equi join with a non-equi residual evaluated inside the join."""
    condition = reduce(lambda a, b: a & b, [l[a] == r[b] for a, b in on.items()])
    return l.join(r, condition & differs, "inner")


def within_lookback(events: DataFrame, rules: DataFrame, on: Mapping[str, str], now: datetime | str,
                    ts: str, minutes: str) -> DataFrame:
    """Events inside the lookback of their rule; `rules.minutes` is text such as '-60'."""
    bound = add_time("MINUTE", F.col(minutes).try_cast("int"), ntz(now))
    return join_diff(events, rules, on, events[ts] >= bound)


def cross_lookup(requests: DataFrame, a: DataFrame, b: DataFrame, a_on: Mapping[str, str],
                 b_on: Mapping[str, str]) -> DataFrame:
    """Pairs of looked-up rows, one per request naming both; two equi joins, never a product."""
    return inner(inner(requests, a, a_on), b, b_on)


def lookup_code(df: DataFrame, codes: DataFrame, name_col: str, code_name: str, code_id: str) -> DataFrame:
    """Scalar lookup: attach the id of a name, NULL when unknown; two ids for one name raise."""
    single = codes.groupBy(F.col(code_name).alias("_name")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(code_id).alias("_id"))
    value = F.when(F.col("_n") > 1, F.raise_error(F.lit("lookup returns more than one row"))).otherwise(F.col("_id"))
    joined = df.join(single, F.col(name_col) == F.col("_name"), "left")
    return joined.select(*[df[c] for c in df.columns], value.cast(codes.schema[code_id].dataType).alias(code_id))


def feed_join(feed: DataFrame, table: DataFrame, key: str | Sequence[str], table_cols: Sequence[str]) -> DataFrame:
    """Feed rows with columns of the table row of the same key."""
    names = _names(key)
    return feed.alias("f").join(table.alias("t"), equal_on("f", "t", names)).select(
        "f.*", *[F.col(f"t.{c}").alias(c) for c in table_cols])


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by position."""
    return reduce(lambda a, b: a.union(b), dfs)


def distinct(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows of the given columns."""
    return (df.select(*cols) if cols else df).distinct()
