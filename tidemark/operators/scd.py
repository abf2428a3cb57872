"""Slowly changing dimensions: type 1 sync of a full snapshot, type 2 history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.compare import equal_on
from tidemark.functions.dates import ntz, open_end
from tidemark.operators.changes import ACTION, DELETED, INSERTED, IS_UPDATE, deletes, feed_row, inserts, once_per_key, present
from tidemark.operators.dml import merge, unmatched
from tidemark.operators.joins import feed_join, semi
from tidemark.operators.ordered import effective_dates

# Decision texts of history rows.
NEW_ROW = "New Record - Insert or Existing Record - Ignore"
UPDATE_OPENS = "Existing Record - Insert"
UPDATE_CLOSES = "Existing Record - Delete"
MISSING = "Missing Record - Delete"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def scd1_changes(tgt: DataFrame, stg: DataFrame, key: str | Sequence[str], match_col: str,
                 unreadable: DataFrame | None = None, deletes: bool = True) -> DataFrame:
    """One row per key with `change` (insert, update, delete, same), `old` and `new` images.

    Next state and change feed both come from this single join; keys are unique on both sides.
    A NULL key is never inserted or deleted, a NULL staged key suspends deletes, and a row is
    updated only when `match_col` differs with neither side NULL. An empty stage deletes all rows.
    Target rows with a NULL key bypass the join; a key staged twice raises on its way into it, when the
    changes are run. Each side is shuffled once. Whether the stage is empty or has a NULL key is a
    subquery over its keys: one row, found without a shuffle of rows. `unreadable` holds keys that were
    delivered in rows that could not be read: they are not missing, so never deleted. With `deletes`
    off no key counts as missing.
    """
    keys = _keys(key)
    known = present(keys)
    facts = stg.agg(F.struct(F.count(F.lit(1)).alias("rows"), F.count(F.when(~known, 1)).alias("keyless"))).scalar()
    gone = F.when(facts["keyless"] > 0, "same").otherwise("delete") if deletes else F.lit("same")
    image = lambda frame: F.struct(*[F.col(f"{frame}.{c}") for c in tgt.columns])
    held = tgt.filter(known).withColumn("_here", F.lit(True))
    staged = once_per_key(stg.filter(known).select(*tgt.columns), keys, "stage")
    joined = held.alias("t").join(staged.alias("s"), equal_on("t", "s", keys), "full_outer")
    if unreadable is not None:
        broken = unreadable.select(*keys).distinct().withColumn("_broken", F.lit(True))
        joined = joined.join(broken.alias("b"), equal_on("t", "b", keys), "left")
        gone = F.when(F.col("b._broken"), "same").otherwise(gone)
    had, has = F.col("t._here").isNotNull(), F.col("s._here").isNotNull()
    newer = F.coalesce(F.col(f"t.{match_col}") != F.col(f"s.{match_col}"), F.lit(False))
    change = F.when(~had, "insert").when(~has, gone).when(newer, "update").otherwise("same")
    changes = joined.select(
        change.alias("change"), F.when(had, image("t")).alias("old"), F.when(has, image("s")).alias("new"))
    emptied = F.when(facts["rows"] > 0, "same").otherwise("delete") if deletes else F.lit("same")
    nameless = tgt.filter(~known).select(
        emptied.alias("change"), F.struct(*tgt.columns).alias("old"),
        F.lit(None).cast(changes.schema["new"].dataType).alias("new"))
    return changes.unionByName(nameless)


def scd1_state(changes: DataFrame) -> DataFrame:
    """Next state of the synced table."""
    row = F.when(F.col("change").isin("insert", "update"), F.col("new")).otherwise(F.col("old"))
    return changes.filter(F.col("change") != "delete").select(row.alias("r")).select("r.*")


def scd1_feed(changes: DataFrame) -> DataFrame:
    """Change feed of the sync, same shape as `change_feed`."""
    kind, old, new = F.col("change"), F.col("old"), F.col("new")
    events = (
        F.when(kind == "insert", F.array(feed_row(new, INSERTED, False)))
        .when(kind == "delete", F.array(feed_row(old, DELETED, False)))
        .when(kind == "update", F.array(feed_row(old, DELETED, True), feed_row(new, INSERTED, True)))
    )
    return changes.select(F.explode(events).alias("e")).select("e.img.*", f"e.{ACTION}", f"e.{IS_UPDATE}")


def scd1_sync(tgt: DataFrame, stg: DataFrame, key: str | Sequence[str], match_col: str) -> DataFrame:
    """Insert new keys, update changed rows, delete missing keys."""
    return scd1_state(scd1_changes(tgt, stg, key, match_col))


def open_rows(hist: DataFrame) -> DataFrame:
    return hist.filter(F.col("current_flag") == "Y")


def split_stale(feed: DataFrame, hist: DataFrame, key: str | Sequence[str], ts: str = "last_updated") -> tuple[DataFrame, DataFrame]:
    """(usable feed, rejected rows): an update not newer than the open row would invert intervals.

    Both images of a rejected update leave the feed.
    """
    keys = _keys(key)
    newest = inserts(feed, update=True).select(*keys, ts)
    opened = open_rows(hist).select(*keys, "valid_from")
    stale = feed_join(newest, opened, keys, ["valid_from"]).filter(F.col(ts) <= F.col("valid_from")).select(*keys).distinct()
    is_update = F.col(IS_UPDATE)
    updates = feed.filter(is_update)
    good = updates.alias("f").join(stale.alias("s"), equal_on("f", "s", keys), "left_anti")
    bad = updates.alias("f").join(stale.alias("s"), equal_on("f", "s", keys), "left_semi")
    return feed.filter(~is_update).unionByName(good), bad


def scd2_classify(feed: DataFrame, hist: DataFrame, key: str | Sequence[str], close: str = "now",
                  now: datetime | str = "", ts: str = "last_updated", close_code: str = "D") -> DataFrame:
    """Rows to open and to close: decision, key, content, valid_from, valid_to, current_flag, dml_type.

    close="now": an updated row's old version closes at `now`. close="successor": it closes at the
    new version's time. Missing keys always close at `now` with no flag. dml_type is I to open and
    `close_code` (D for missing keys) to close.

    The feed is read by each branch: pass a written one. Only open history rows are read, and only
    keys in the feed reach a window.
    """
    if close not in ("now", "successor"):
        raise ValueError(f"unknown close: {close}")
    keys = _keys(key)
    content = [c for c in feed.columns if c not in (*keys, ts, ACTION, IS_UPDATE)]
    names = [*keys, *content]
    shape = ["decision", *names, "valid_from", "valid_to", "current_flag", "dml_type"]
    opened = open_rows(hist)

    fresh = effective_dates(inserts(feed, update=False).select(*names, ts), keys, ts)
    fresh = fresh.withColumns({"decision": F.lit(NEW_ROW), "dml_type": F.lit("I")}).select(*shape)

    newer = inserts(feed, update=True).select(*names, F.col(ts).alias("valid_from")).withColumns(
        {"decision": F.lit(UPDATE_OPENS), "dml_type": F.lit("I")})
    older = semi(opened, newer, keys).select(*names, "valid_from").withColumns(
        {"decision": F.lit(UPDATE_CLOSES), "dml_type": F.lit(close_code)})
    if close == "now":
        newer = newer.withColumns({"valid_to": open_end(), "current_flag": F.lit("Y")})
        older = older.withColumns({"valid_to": ntz(now), "current_flag": F.lit("N")})
        updated = newer.select(*shape).unionByName(older.select(*shape))
    else:
        updated = effective_dates(newer.unionByName(older), keys, "valid_from", ties=["dml_type"]).select(*shape)

    gone = feed_join(deletes(feed, update=False).select(*names), opened, keys, ["valid_from"])
    gone = gone.withColumns({
        "decision": F.lit(MISSING), "valid_to": ntz(now),
        "current_flag": F.lit(None).cast("string"), "dml_type": F.lit("D"),
    }).select(*shape)
    return fresh.unionByName(updated).unionByName(gone)


def scd2_apply(hist: DataFrame, classified: DataFrame, on: Sequence[str], valid_from: str = "source",
               now: datetime | str = "", null_safe: bool = False) -> DataFrame:
    """Merge classified rows into history on (`on`, valid_from).

    A close sets valid_to, flag N and, where history has it, the decision. An open row is inserted
    with its own valid_from ("source") or `now`, unless history already has it. null_safe=True also
    closes rows whose content is NULL. Pass a written `classified`: it is read for each part.
    """
    if valid_from not in ("now", "source"):
        raise ValueError(f"unknown valid_from: {valid_from}")
    keys = [*on, "valid_from"]
    closing = {"valid_to": F.col("src.valid_to"), "current_flag": F.lit("N"), "decision": F.col("src.decision")}
    closing = {c: e for c, e in closing.items() if c in hist.columns}
    closers = classified.filter(F.col("dml_type").isin("U", "D"))
    # Only open rows can be closed; closed ones pass by without a shuffle.
    is_open = F.coalesce(F.col("current_flag") == "Y", F.lit(False))
    kept = merge(hist.filter(is_open), closers, keys, matched=[(None, closing)], null_safe=null_safe)
    kept = kept.unionByName(hist.filter(~is_open))

    opened = unmatched(classified.filter(F.col("dml_type") == "I"), hist, keys, null_safe)
    if valid_from == "now":
        opened = opened.withColumn("valid_from", ntz(now))
    return kept.unionByName(opened.select(
        [(F.col(f.name) if f.name in opened.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in hist.schema]))
