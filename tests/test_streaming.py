"""Jobs: the two-file example end to end, reruns, late and broken deliveries, positions."""

import os
from dataclasses import replace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows
from test_history import END, NOW1, NOW2, T1, T2
from test_sources import write
from tidemark.operators.scd import MISSING, NEW_ROW, UPDATE_CLOSES, UPDATE_OPENS
from tidemark.streaming import files as feeds
from tidemark.streaming import state as state_module
from tidemark.streaming.appends import AppendLog, consume_into, copy_new
from tidemark.streaming.buckets import BucketedTable
from tidemark.streaming.history import Entity, HistoryStore, append_typed, run_pipeline
from tidemark.streaming.manifest import Manifest
from tidemark.streaming.state import FeedState, Ledger, Totals, VersionedTable

SCHEMA = T.StructType().add("id", "long").add("content", "string").add("last_updated", T.TimestampNTZType())
HEAD = "id,content,last_updated"
FILE1 = [HEAD, f"41,red,{T1}", f"42,green,{T1}", f"43,blue,{T1}"]
FILE2 = [HEAD, f"41,rose,{T2}", f"42,green,{T1}", f"44,grey,{T2}"]
WANT = [
    (41, "red", NOW1, NOW2, "N", UPDATE_CLOSES), (41, "rose", NOW2, END, "Y", UPDATE_OPENS), (42, "green", NOW1, END, "Y", NEW_ROW),
    (43, "blue", NOW1, NOW2, "N", MISSING), (44, "grey", NOW2, END, "Y", NEW_ROW)]


def history(spark, root, entity, ledger):
    df = HistoryStore(spark, root, entity).history(ledger.version(entity.name))
    return [(r[0], r[1], str(r[2]), str(r[3]), r[4], r[5]) for r in rows(df)]


def test_files_to_history(spark, tmp_path):
    inbox, root, entity = str(tmp_path / "in"), str(tmp_path / "tables"), Entity("colours", SCHEMA, "id")
    write(inbox, "colours_20230302_081500.txt", FILE1)
    write(inbox, "unknown_20230302_081500.txt", FILE1)
    run_pipeline(spark, inbox, [entity], root, NOW1)
    write(inbox, "colours_20230302_094000.txt", FILE2)
    write(inbox, "colours_20220101_000000.txt", [HEAD, f"1,late,{T1}"])
    ledger = run_pipeline(spark, inbox, [entity], root, NOW2)
    assert history(spark, root, entity, ledger) == WANT
    again = run_pipeline(spark, inbox, [entity], root, "2023-03-03 00:00:00")
    assert history(spark, root, entity, again) == WANT
    assert rows(again.rows(), "status", "version", "row_count") == [("applied", 1, 3), ("applied", 2, 3), ("late", 1, 0), ("unknown", 0, 0)]


def test_both_files_in_one_run_go_in_name_order(spark, tmp_path):
    inbox, root = str(tmp_path / "in"), str(tmp_path / "tables")
    entity = Entity("colours", SCHEMA, "id", close="successor", valid_from="source")
    write(inbox, "colours_20230302_094000.txt", FILE2)
    write(inbox, "colours_20230302_081500.txt", FILE1)
    ledger = run_pipeline(spark, inbox, [entity], root, NOW2)
    assert [r[:5] for r in history(spark, root, entity, ledger)] == [
        (41, "red", T1, T2, "N"), (41, "rose", T2, END, "Y"), (42, "green", T1, END, "Y"), (43, "blue", T1, NOW2, "N"), (44, "grey", T2, END, "Y")]


def test_empty_and_broken_deliveries(spark, tmp_path):
    inbox, root, entity = str(tmp_path / "in"), str(tmp_path / "tables"), Entity("colours", SCHEMA, "id", on_error="skip")
    write(inbox, "colours_20230302_081500.txt", [*FILE1, f"bad,XXX,{T1}", f",YYY,{T1}"])
    write(inbox, "colours_20230302_110000.txt", [HEAD])
    ledger = run_pipeline(spark, inbox, [entity], root, NOW1)
    assert rows(ledger.rows(), "status", "row_count", "reject_count") == [("applied", 3, 2), ("empty", 0, 0)]
    assert len(history(spark, root, entity, ledger)) == 3
    write(f"{inbox}/colours_20230303_000000", "part-0.csv", FILE2)
    with pytest.raises(PySparkException, match="not complete"):
        run_pipeline(spark, inbox, [entity], root, NOW2)
    write(f"{inbox}/colours_20230303_000000", "_SUCCESS", [])
    assert history(spark, root, entity, run_pipeline(spark, inbox, [entity], root, NOW2)) == WANT


def test_bad_lines_do_not_delete(spark, tmp_path):
    inbox, root = str(tmp_path / "in"), str(tmp_path / "tables")
    strict, entity = Entity("colours", SCHEMA, "id"), Entity("colours", SCHEMA, "id", on_error="skip")
    write(inbox, "colours_20230302_081500.txt", FILE1)
    run_pipeline(spark, inbox, [strict], root, NOW1)
    # 42 comes with a bad time, 43 not at all.
    write(inbox, "colours_20230302_094000.txt", [HEAD, f"41,red,{T1}", "42,green,not a time"])
    with pytest.raises(Exception, match="cannot be read"):
        run_pipeline(spark, inbox, [strict], root, NOW2)
    ledger = run_pipeline(spark, inbox, [entity], root, NOW2)
    assert [(r[0], r[4]) for r in history(spark, root, entity, ledger)] == [(41, "Y"), (42, "Y"), (43, "N")]
    # A line without a key, and one with too many fields: nothing is missing for certain.
    write(inbox, "colours_20230302_110000.txt", [HEAD, f"41,red,{T1}", f",YYY,{T1}"])
    ledger = run_pipeline(spark, inbox, [entity], root, NOW2)
    assert [(r[0], r[4]) for r in history(spark, root, entity, ledger)] == [(41, "Y"), (42, "Y"), (43, "N")]


def test_deliveries_wait_for_their_entity(spark, tmp_path):
    inbox, root = str(tmp_path / "in"), str(tmp_path / "tables")
    entity, other = Entity("colours", SCHEMA, "id"), Entity("later", SCHEMA, "id")
    write(inbox, "colours_20230302_081500.txt", FILE1)
    write(inbox, "later_20230302_081500.txt", FILE1)
    for _ in range(2):
        ledger = run_pipeline(spark, inbox, [entity], root, NOW1)
    assert ledger.waiting(["later"]) == [("later", "later_20230302_081500.txt")]
    ledger = run_pipeline(spark, inbox, [entity, other], root, NOW2)
    assert [r[0] for r in history(spark, root, other, ledger)] == [41, 42, 43] and not ledger.waiting(["later"])


def test_half_written_version_is_replaced(spark, tmp_path):
    """A version folder without a ledger row counts for nothing."""
    inbox, root, entity = str(tmp_path / "in"), str(tmp_path / "tables"), Entity("colours", SCHEMA, "id")
    junk = spark.createDataFrame([(9, "junk", None, None, "N", "x")], entity.history_schema())
    store = HistoryStore(spark, root, entity)
    junk.write.parquet(f"{store.closed_path}/v=1")
    store.open_table.write(junk, 1)
    write(inbox, "colours_20230302_081500.txt", FILE1)
    ledger = run_pipeline(spark, inbox, [entity], root, NOW1)
    assert [r[0] for r in history(spark, root, entity, ledger)] == [41, 42, 43]


def snapshot_lines(content):
    return [HEAD, *[f"{k},{c},{t}" for k, (c, t) in content.items()]]


@pytest.mark.parametrize(("close", "valid_from"), [("now", "now"), ("successor", "source")])
def test_a_delivery_writes_the_buckets_it_touches(spark, tmp_path, close, valid_from):
    inbox, root = str(tmp_path / "in"), str(tmp_path / "tables")
    entity = Entity("colours", SCHEMA, "id", close=close, valid_from=valid_from, buckets=8)
    content = {k: (f"c{k}", T1) for k in range(200)}
    write(inbox, "colours_20230302_081500.txt", snapshot_lines(content))
    run_pipeline(spark, inbox, [entity], root, NOW1)
    store = HistoryStore(spark, root, entity)
    assert store.current_table.manifest(1) == store.open_table.manifest(1) == dict.fromkeys(range(8), 1)
    # One key changes, one comes back under its old content later on, one goes.
    del content[7]
    content[3] = ("new", T2)
    write(inbox, "colours_20230302_094000.txt", snapshot_lines(content))
    ledger = run_pipeline(spark, inbox, [entity], root, NOW2)
    touched = store.current_table.touched(spark.createDataFrame([(3,), (7,)], "id long"))
    assert 1 <= len(touched) <= 2
    for table in (store.current_table, store.open_table):
        assert {b for b, v in table.manifest(2).items() if v == 2} == set(touched)
        assert sorted(p.name for p in (tmp_path / "tables" / "colours" / table.path.rsplit("/", 1)[1] / "v=2").glob("_bucket=*")) == [f"_bucket={b}" for b in touched]
    assert rows(store.current_table.read(2), "id", "content") == sorted(((k, c) for k, (c, _) in content.items()), key=repr)
    found = history(spark, root, entity, ledger)
    assert len(found) == 201 and [r[:2] + (r[4],) for r in found if r[0] in (3, 7)] == [(3, "c3", "N"), (3, "new", "Y"), (7, "c7", "N")]
    # The same snapshot again touches nothing.
    write(inbox, "colours_20230302_110000.txt", snapshot_lines(content))
    ledger = run_pipeline(spark, inbox, [entity], root, "2023-03-03 00:00:00")
    assert store.current_table.manifest(3) == store.current_table.manifest(2) and not (tmp_path / "tables/colours/current/v=3").exists()
    assert history(spark, root, entity, ledger) == found


def test_versions_go_when_no_reader_needs_them(spark, tmp_path):
    inbox, root, entity = str(tmp_path / "in"), str(tmp_path / "tables"), Entity("colours", SCHEMA, "id", buckets=4)
    content = {k: (f"c{k}", T1) for k in range(40)}
    store = HistoryStore(spark, root, entity)
    for n in range(1, 5):
        content.update({k: (f"v{n}", f"2023-03-0{n} 10:00:00") for k in range(n, 40, 13)})
        write(inbox, f"colours_2023040{n}_000000.txt", snapshot_lines(content))
        ledger = run_pipeline(spark, inbox, [entity], root, NOW2)
        if n == 2:
            FeedState(spark, store.current_table, ledger, "id", "behind").consume(2, NOW2)
    feed = FeedState(spark, store.current_table, ledger, "id", "behind")
    want, past = rows(feed.pending(4)), history(spark, root, entity, ledger)
    needed = {f"v={v}/_bucket={b}" for k in (2, 4) for b, v in store.current_table.manifest(k).items()}
    (tmp_path / "tables/colours/current/v=5/_bucket=0").mkdir(parents=True)
    assert store.sweep(ledger, ["behind"]) and rows(feed.pending(4)) == want and history(spark, root, entity, ledger) == past
    left = {f"{p.parent.name}/{p.name}" for p in (tmp_path / "tables/colours/current").glob("v=*/_bucket=*")}
    assert left == needed | {"v=5/_bucket=0"}
    with pytest.raises(ValueError, match="no version 1"):
        store.current_table.read(1)
    feed.consume(4, NOW2)
    store.sweep(ledger, ["behind"])
    assert store.sweep(ledger, ["behind"]) == [] and history(spark, root, entity, ledger) == past
    left = {f"{p.parent.name}/{p.name}" for p in (tmp_path / "tables/colours/open").glob("v=*/_bucket=*")}
    assert left == {f"v={v}/_bucket={b}" for b, v in store.open_table.manifest(4).items()}


def test_bucketed_table(spark, tmp_path):
    schema = T.StructType().add("id", "long").add("v", "string")
    table = BucketedTable(spark, f"{tmp_path}/t", schema, ["id"], 4)
    assert table.read(0).isEmpty() and table.sweep([0]) == []
    table.write(spark.createDataFrame([(None, "n"), *[(k, "a") for k in range(20)]], schema), 1)
    only = table.touched(spark.createDataFrame([(5,)], "id int"))
    assert len(only) == 1
    # All rows of one bucket go: the bucket leaves the manifest.
    table.write(table.read(1, only).limit(0), 2, 1, only)
    assert set(table.manifest(2)) == set(range(4)) - set(only)
    assert table.read(1).count() == 21 and table.read(2).count() == 21 - table.read(1, only).count()
    before, after = table.pair(1, 2)
    assert rows(before) == rows(table.read(1, only)) and after.isEmpty()
    with pytest.raises(ValueError, match="not among the touched"):
        table.write(table.read(1), 3, 2, only)
    with pytest.raises(ValueError, match="has 4 buckets, not 8"):
        BucketedTable(spark, table.path, schema, ["id"], 8).read(2)


def test_ingest_and_reports(spark, tmp_path):
    inbox, sink, ck = str(tmp_path / "in"), str(tmp_path / "sink"), str(tmp_path / "ck")
    write(inbox, "a.csv", FILE1)
    feeds.ingest_stream(spark, inbox, SCHEMA, sink, ck).awaitTermination()
    write(inbox, "b.csv", [HEAD, f"1,x,{T1}", "oops,x,y,z", f"bad,x,{T1}"])
    for _ in range(2):
        feeds.ingest_stream(spark, inbox, SCHEMA, sink, ck).awaitTermination()
    loaded = spark.read.parquet(sink)
    assert feeds.accepted(loaded).count() == 4 and feeds.accepted(loaded).columns == SCHEMA.names
    report = feeds.load_report(loaded, since="2000-01-01")
    assert rows(report) == [("a.csv", 3, 0, "LOADED"), ("b.csv", 1, 2, "PARTIALLY_LOADED")]
    assert feeds.load_report(loaded, since="2000-01-01", until="2000-01-02").count() == 0
    assert feeds.validate_load(spark, f"{inbox}/b.csv", SCHEMA).count() == 2


def test_continuous_ingest_until_stopped(spark, tmp_path):
    inbox, sink, ck = str(tmp_path / "in"), str(tmp_path / "sink"), str(tmp_path / "ck")
    write(inbox, "a.csv", FILE1)
    query = feeds.ingest_stream(spark, inbox, SCHEMA, sink, ck, interval="100 milliseconds")
    query.processAllAvailable()
    write(inbox, "b.csv", FILE2)
    query.processAllAvailable()
    query.stop()
    assert feeds.accepted(spark.read.parquet(sink)).count() == 6


def test_ingest_archives_files_of_earlier_runs(spark, tmp_path):
    inbox, sink, ck, done = (str(tmp_path / n) for n in ("in", "sink", "ck", "done"))
    clean = {"cleanSource": "archive", "sourceArchiveDir": done}
    for name in ("a.csv", "b.csv", "c.csv"):
        write(inbox, name, FILE1)
        feeds.ingest_stream(spark, inbox, SCHEMA, sink, ck, clean_source=clean).awaitTermination()
    assert spark.read.parquet(sink).count() == 9
    assert "a.csv" not in os.listdir(inbox)


def test_new_files_and_routing(spark, tmp_path):
    inbox = str(tmp_path)
    for name in ("x_20220101_000000.csv", "y_20220102_000000.csv"):
        write(inbox, name, FILE1)
    seen = spark.createDataFrame([("x_20220101_000000.csv",)], "file string")
    routed = feeds.route_files(feeds.new_files(spark, inbox, seen), inbox)
    assert rows(routed, "entity", F.col("stamp").cast("string"), "action") == [("y", "2022-01-02 00:00:00", "INSERT")]


def test_on_new_file_orders_and_stops(spark, tmp_path):
    inbox, seen = str(tmp_path / "in"), []
    loader = lambda paths, batch: seen.append([os.path.basename(p) for p in paths])
    for name in ("b.json", "a.json"):
        write(inbox, name, ["{}"])
    feeds.on_new_file(spark, inbox, loader, str(tmp_path / "ck"), "*.json")
    feeds.on_new_file(spark, inbox, loader, str(tmp_path / "ck"), "*.json")
    assert seen == [["a.json", "b.json"]]


def test_feed_position(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t", T.StructType().add("id", "integer").add("v", "string"))
    table.write(spark.createDataFrame([(1, "a")], table.schema), 1)
    table.write(spark.createDataFrame([(1, "b"), (2, "c")], table.schema), 2)
    state = FeedState(spark, table, Ledger(spark, f"{tmp_path}/ledger"), "id")
    assert state.pending(1).count() == state.pending(1).count() == 1
    state.consume(1, NOW1)
    assert rows(state.pending(2), "id", "v", "action") == [(1, "a", "DELETE"), (1, "b", "INSERT"), (2, "c", "INSERT")]
    state.consume(2, NOW2)
    assert state.pending(2).count() == 0


def test_append_typed(spark, tmp_path):
    stage = spark.createDataFrame(
        [("41", "first paint", "1", "2023-03-02 08:15:00.250"), ("42", "second paint", "2", "2023-03-02 08:15:00.250")],
        "id string, description string, value string, stg_last_updated string")
    schema = T.StructType().add("id", "long").add("description", "string").add("value", "long").add("stg_last_updated", T.TimestampNTZType())
    append_typed(stage, schema, 100000, ["id"], "test_load_id", f"{tmp_path}/int")
    assert rows(spark.read.parquet(f"{tmp_path}/int"), "test_load_id", "id", "value") == [(100000, 41, 1), (100001, 42, 2)]


def test_append_typed_goes_on(spark, tmp_path):
    stage = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, description string")
    schema = T.StructType().add("id", "long").add("description", "string")
    for _ in range(2):
        loaded = append_typed(stage, schema, 100, ["id"], "sk", f"{tmp_path}/int")
    assert rows(loaded, "sk", "id") == [(100, 1), (101, 2), (102, 1), (103, 2)]


def test_a_load_that_died_is_repeated(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, f"{tmp_path}/t", T.StructType().add("id", "integer").add("v", "string"))
    table.write(spark.createDataFrame([(1, "a"), (2, "b")], table.schema), 1)
    log = AppendLog(spark, f"{tmp_path}/changes")
    state = FeedState(spark, table, log.ledger, "id", log.name)
    step = lambda: consume_into(log, state, 1, lambda feed, first: feed.select("id", "v"), NOW1)
    monkeypatch.setattr(Ledger, "put", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        step()
    monkeypatch.undo()
    assert log.version() == 0 and step() == 2 and step() == 0
    assert rows(log.read()) == [(1, "a"), (2, "b")] and log.next_id(10) == 12


def test_copy_new_takes_a_file_once(spark, tmp_path):
    inbox, log = str(tmp_path / "in"), AppendLog(spark, str(tmp_path / "t"))
    write(inbox, "a.csv", [*FILE1, f"bad,x,{T1}"])
    write(inbox, "empty.csv", [HEAD])
    with pytest.raises(ValueError):
        copy_new(log, inbox, SCHEMA, NOW1)
    assert copy_new(log, inbox, SCHEMA, NOW1, on_error="skip") == 3 and copy_new(log, inbox, SCHEMA, NOW1) == 0
    write(f"{inbox}/sub", "b.csv", FILE2)
    assert copy_new(log, inbox, SCHEMA, NOW2) == 3 and log.read().count() == 6
    assert rows(log.files(), "file", "row_count", "reject_count") == [("a.csv", 3, 1), ("empty.csv", 0, 0), ("sub/b.csv", 3, 0)]


def test_copy_new_with_odd_names_and_replaced_files(spark, tmp_path):
    inbox, log = str(tmp_path / "in"), AppendLog(spark, str(tmp_path / "t"))
    names = ["a b.csv", "c%20d.csv", "e+f.csv", "g[1].csv", "é{x}.csv"]
    for i, name in enumerate(names):
        write(inbox, name, [HEAD, *[f"{j},{i},{T1}" for j in range(i + 1)]])
    assert copy_new(log, inbox, SCHEMA, NOW1) == 15 and copy_new(log, inbox, SCHEMA, NOW1) == 0
    assert rows(log.files(), "file", "row_count") == sorted(((n, i + 1) for i, n in enumerate(names)), key=repr)
    write(inbox, "a b.csv", [HEAD, f"7,new,{T2}", f"8,new,{T2}"])
    assert copy_new(log, inbox, SCHEMA, NOW2) == 2 and copy_new(log, inbox, SCHEMA, NOW2) == 0
    assert rows(log.files().filter("file = 'a b.csv'"), "row_count") == [(1,), (2,)]
    assert log.read().count() == 17


def test_manifest(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    manifest = Manifest(spark, f"{tmp_path}/m", str(inbox), checksum=True)
    assert manifest.refresh(NOW1) == 0 and manifest.listing().count() == 0 and manifest.changes().count() == 0
    for name in ("a b", "c%20d", "e"):
        (inbox / name).write_text(name)
    assert manifest.refresh(NOW1) == 3 and manifest.refresh(NOW1) == 0 and manifest.version() == 1
    (inbox / "a b").write_text("a c")
    os.utime(inbox / "e", (1, 1))
    (inbox / "c%20d").unlink()
    (inbox / "sub").mkdir()
    (inbox / "sub" / "f").write_text("f")
    other = Manifest(spark, f"{tmp_path}/m", str(inbox), checksum=True)
    assert other.refresh(NOW2) == 3
    assert rows(manifest.changes(1), "relative_path", "change", "size", "old_size") == [
        ("a b", "changed", 3, 3), ("c%20d", "removed", None, 5), ("sub/f", "new", 1, None)]
    assert rows(manifest.listing(), "relative_path") == [("a b",), ("e",), ("sub/f",)] and manifest.listing(1).count() == 3
    # Without checksums the time of change decides.
    plain = Manifest(spark, f"{tmp_path}/p", str(inbox))
    assert plain.refresh(NOW1) == 3
    os.utime(inbox / "e", (5, 5))
    assert plain.refresh(NOW2) == 1


def test_two_writers_keep_all_rows(spark, tmp_path):
    one, two = (AppendLog(spark, f"{tmp_path}/t") for _ in range(2))
    numbered = lambda texts, first: spark.createDataFrame([(first + i, t) for i, t in enumerate(texts)], "id long, t string")
    tried = []

    def slow(first):
        tried.append(first)
        if len(tried) == 1:
            assert two.append(lambda f: numbered("de", f), NOW1) == 2
        return numbered("abc", first)

    assert one.append(slow, NOW2) == 3 and tried == [1, 3]
    want = [(1, "d"), (2, "e"), (3, "a"), (4, "b"), (5, "c")]
    assert rows(one.read()) == rows(two.read(numbered("", 1).schema)) == want
    assert one.version() == 2 and two.next_id() == 6


def test_two_consumers_of_one_feed(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t", T.StructType().add("id", "integer").add("v", "string"))
    table.write(spark.createDataFrame([(1, "a"), (2, "b")], table.schema), 1)
    logs = [AppendLog(spark, f"{tmp_path}/changes") for _ in range(2)]
    states = [FeedState(spark, table, log.ledger, "id", log.name) for log in logs]
    plain = lambda feed, first: feed.select("id", "v")
    other = []

    def late(feed, first):
        if not other:
            other.append(consume_into(logs[1], states[1], 1, plain, NOW1))
        return plain(feed, first)

    assert consume_into(logs[0], states[0], 1, late, NOW1) == 0 and other == [2]
    assert rows(logs[0].read()) == [(1, "a"), (2, "b")]


def test_a_long_ledger_is_read_from_its_checkpoint(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state_module, "CHECKPOINT_EVERY", 100)
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    state = ledger.latest()
    for i in range(1, 1001):
        entry = Ledger.entry("t", f"f{i}", i, i, 2, 0, None, NOW1)
        assert ledger.put(state, entry) and (i % 100 or len(ledger.latest().tail) == 0)
        state = state.plus(entry) if i % 100 else ledger.latest()
    assert not ledger.put(replace(state, number=999), entry)
    ledger.add("t", "more", 1001, 1001, 5, 0, None, NOW2)
    read = []
    whole = state_module.read_text
    monkeypatch.setattr(state_module, "read_text", lambda spark, path: read.append(path) or whole(spark, path))
    now = ledger.latest()
    assert len(read) == 3 and now.number == 1001
    assert now.of("t") == Totals(1001, 2005, 1001, None) and ledger.rows().count() == 1001
    assert ledger.seen("t", "f1") and ledger.seen("t", "more") and not ledger.seen("t", "f0")
    assert rows(ledger.rows().filter("file = 'f7'"), "version", "row_count") == [(7, 2)]
    # A lost note costs reads, not rows.
    os.remove(f"{tmp_path}/ledger/last.json")
    assert Ledger(spark, f"{tmp_path}/ledger").latest().of("t") == now.of("t")


def test_snapshot_append_once_a_day(spark, tmp_path):
    report = spark.createDataFrame([("wh", 1.5)], "warehouse_name string, credits_used double")
    path = f"{tmp_path}/spend"
    assert feeds.snapshot_append(report, path, NOW1) is True
    assert feeds.snapshot_append(report, path, NOW2) is False
    assert feeds.snapshot_append(report, path, "2023-03-03 00:00:00") is True
    assert spark.read.parquet(path).count() == 2


def test_on_change(spark):
    ran = []
    df = spark.createDataFrame([(1,)], "x int")
    assert feeds.on_change(df, lambda f: ran.append(f.count())) and not feeds.on_change(df.limit(0), ran.append)
    assert ran == [1]


def test_reading_a_log_deals_no_load_to_one_task(spark, tmp_path):
    """The loads that count are sent to the rows, which are neither shuffled nor sorted by load."""
    log = AppendLog(spark, f"{tmp_path}/t")
    for now in (NOW1, NOW2):
        log.append(lambda first: spark.range(first, first + 100, numPartitions=4).toDF("sk"), now)
    spark.range(5).toDF("sk").write.parquet(f"{tmp_path}/t/load=2/try=beaten")
    read = log.read()
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "Sort" not in plan
    assert sorted(r.sk for r in read.collect()) == list(range(1, 201))
