"""Change feeds between two snapshots of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.compare import equal_on

ACTION = "action"
IS_UPDATE = "is_update"
# Actions of a feed row.
INSERTED = "INSERT"
DELETED = "DELETE"


def present(keys: Sequence[str]) -> Column:
    """No key column is NULL."""
    test = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        test = test & F.col(k).isNotNull()
    return test


def feed_row(image: Column, action: str, update: bool) -> Column:
    """One feed row as a struct (img, action, is_update)."""
    return F.struct(image.alias("img"), F.lit(action).alias(ACTION), F.lit(update).alias(IS_UPDATE))


def once_per_key(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """`df`, whose keys are not NULL, with a mark `_here`; a key met for the second time raises while rows pass by.

    The window wants the rows hashed and sorted by key, as a join on the key does, so the check adds
    no shuffle and no sort to that join. It numbers rows one by one and holds none back.
    """
    copy = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    text = F.concat(F.lit(f"{what}: key "), F.to_json(F.struct(*keys)), F.lit(" occurs more than once"))
    return df.withColumn("_here", F.when(copy > 1, F.raise_error(text).cast("boolean")).otherwise(F.lit(True)))


def change_feed(prev: DataFrame, curr: DataFrame, key: str | Sequence[str], cols: Sequence[str] | None = None,
                check: bool = True) -> DataFrame:
    """Net row changes from `prev` to `curr`, both unique on `key`.

    An insert is (INSERT, false), a delete (DELETE, false), an update (DELETE, true) with the old
    image and (INSERT, true) with the new one. Images compare null-safe over `cols`. A row with a
    NULL key has no identity: it is deleted and inserted, and never enters the join. A key that a
    snapshot has twice raises when the feed is run, on the way into the join, unless `check` is off
    because the writer has made sure of it.
    Each snapshot is shuffled once, for the check and the join alike, and nothing runs when the feed
    is built; keys are unique, so none can be hot. Rows fan out with explode, not by reading the
    join twice. Snapshots bucketed by the key are checked and joined without a shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = list(cols) if cols else [c for c in curr.columns if c not in keys]
    names = keys + cols
    image = lambda frame: F.struct(*[F.col(f"{frame}.{c}") for c in names])
    known = present(keys)
    def marked(df: DataFrame, what: str) -> DataFrame:
        rows = df.filter(known).select(*names)
        return once_per_key(rows, keys, what) if check else rows.withColumn("_here", F.lit(True))

    joined = marked(prev, "previous snapshot").alias("p").join(
        marked(curr, "current snapshot").alias("c"), equal_on("p", "c", keys), "full_outer")
    had, has = F.col("p._here").isNotNull(), F.col("c._here").isNotNull()
    changed = had & has & ~image("p").eqNullSafe(image("c"))
    events = (
        F.when(~had, F.array(feed_row(image("c"), INSERTED, False)))
        .when(~has, F.array(feed_row(image("p"), DELETED, False)))
        .when(changed, F.array(feed_row(image("p"), DELETED, True), feed_row(image("c"), INSERTED, True)))
    )
    exploded = joined.select(F.explode(events).alias("e"))
    feed = exploded.select(*[F.col(f"e.img.{c}").alias(c) for c in names], f"e.{ACTION}", f"e.{IS_UPDATE}")
    for frame, action in ((prev, DELETED), (curr, INSERTED)):
        feed = feed.unionByName(frame.filter(~known).select(
            *names, F.lit(action).alias(ACTION), F.lit(False).alias(IS_UPDATE)))
    return feed


def inserts(feed: DataFrame, update: bool | None = None) -> DataFrame:
    """INSERT rows; `update` narrows to plain inserts (False) or new images of updates (True)."""
    return _of(feed, INSERTED, update)


def deletes(feed: DataFrame, update: bool | None = None) -> DataFrame:
    return _of(feed, DELETED, update)


def _of(feed: DataFrame, action: str, update: bool | None) -> DataFrame:
    test: Column = F.col(ACTION) == action
    if update is not None:
        test = test & (F.col(IS_UPDATE) == update)
    return feed.filter(test)


def apply_feed(state: DataFrame, feed: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """State after a feed: untouched rows plus the new images."""
    keys = [key] if isinstance(key, str) else list(key)
    touched = feed.select(*keys).distinct().alias("f")
    kept = state.alias("s").join(touched, equal_on("s", "f", keys, null_safe=True), "left_anti")
    return kept.unionByName(inserts(feed).select(*state.columns))


def has_changes(feed: DataFrame) -> bool:
    """Guard of a job: is there anything to do."""
    return not feed.isEmpty()
