"""WARC archives against a plain sequential reader and a plain grouping of payloads."""

import base64
import hashlib
import random
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from cases import ODD, clashing
from pyspark.sql import functions as F

from tidemark.llm import warc

DATE = "2024-01-01T00:00:00Z"
PAGES = "page_id long, url string, html string"
FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:key:666>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
HTML = [
    "", "<p>x</p>", FAKE, "\r\n" + FAKE, "a\r\n\r\n" + FAKE + FAKE, "\r\nWARC/", "WARC/1.1\r\n", "\r\nWARC/1.1\r\nContent-Length: 9999999\r\n\r\nx",
    "\r\nWARC/WARC/1.1\r\n\r\nWARC/1.0\r\n\r\n", "\r\n\r\n", "\r\n", "é好\r\nWARC/0.18\r\nContent-Length: 2\r\n\r\n", "y" * 40_000, ("\r\n" + FAKE) * 200,
]


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def plain(rows, min_bytes=0):
    """What every row's record must say."""
    groups = defaultdict(list)
    for key, html in rows:
        groups[html or ""].append(key)
    out = []
    for key, html in rows:
        html = html or ""
        keys = [k for k in groups[html] if k is not None]
        first = min(keys) if keys and len(html.encode()) >= min_bytes else None
        again = first is not None and key != first
        out.append((key, len(html.encode()), digest(html), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def read(spark, path, payloads=False):
    found = warc.read_warc(spark, path)
    found = warc.with_payloads(found) if payloads else found
    key = warc.key_of("record_id").cast("long")
    return found.select(key.alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        warc.key_of("refers_to").cast("long").alias("refers_to"), "target_uri", F.col("payload").cast("string"))


def told(rows):
    return sorted((tuple(r)[:5] for r in rows), key=repr)


def sequential(path):
    """(header, block) of the records of all files, read one after the other."""
    for file in sorted(Path(path).glob("part-*")):
        data, at = file.read_bytes(), 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at)
            head = data[at:end].decode()
            assert head.startswith("WARC/1.1\r\n")
            n = int(head.split("Content-Length: ")[1].split("\r\n")[0])
            yield head, data[end + 4:end + 4 + n]
            assert data[end + 4 + n:end + 8 + n] == b"\r\n\r\n"
            at = end + 8 + n


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    yield lambda n: (spark.conf.set("spark.sql.files.maxPartitionBytes", str(n)), spark.conf.set("spark.sql.files.openCostInBytes", "1"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
    spark.conf.set("spark.sql.files.openCostInBytes", old[1])


ROWS = [(i, h) for i, h in enumerate(HTML)] + [(100 + i, h) for i, h in enumerate(HTML)] + [
    (50, None), (None, "<p>x</p>"), (None, "only null keys"), (None, "only null keys"), (1, "another text of page 1"), (1, "<p>x</p>"), (-7, "é好")]


SHORT = [(k, h) for k, h in ROWS if len(h or "") < 200][:9]


@pytest.mark.parametrize("rows, split", [(ROWS, None), (ROWS, 4000), (SHORT, 60)])
def test_round_trip(spark, tmp_path, small_splits, rows, split):
    df = spark.createDataFrame([(k, f"http://x/{k}?WARC/1.1", h) for k, h in rows], PAGES).coalesce(1)
    warc.write_warc(df, f"{tmp_path}/a", DATE)
    if split:
        small_splits(split)
    got = read(spark, f"{tmp_path}/a", payloads=True).collect()
    assert told(got) == plain(rows)
    assert {r["target_uri"] for r in got} == {f"http://x/{k}?WARC/1.1" for k, _ in rows}
    # A payload is found again by digest and key, so that it does not matter which of equal rows is the response.
    assert sorted((r["payload"] or "") for r in got) == sorted(h or "" for _, h in rows)


def test_records_by_a_sequential_reader(spark, tmp_path):
    warc.write_warc(spark.createDataFrame([(k, None, h) for k, h in ROWS], PAGES).repartition(3), f"{tmp_path}/a", DATE)
    kinds = [(h.split("WARC-Type: ")[1].split("\r\n")[0], b) for h, b in sequential(f"{tmp_path}/a")]
    assert len(kinds) == len(ROWS)
    assert all("Target-URI" not in h for h, _ in sequential(f"{tmp_path}/a"))
    assert sorted(b.split(b"\r\n\r\n", 1)[1].decode() for k, b in kinds if k == "response") == sorted(
        [*set(h or "" for _, h in ROWS), "only null keys", "<p>x</p>"])


def test_small_payloads_are_responses(spark, tmp_path):
    warc.write_warc(spark.createDataFrame([(k, "u", h) for k, h in ROWS], PAGES), f"{tmp_path}/a", DATE, min_bytes=9)
    assert told(read(spark, f"{tmp_path}/a").collect()) == plain(ROWS, 9)


def test_odd_texts_and_clashing_names(spark, documents, tmp_path):
    df = clashing(documents([*ODD, (8, "again"), (None, None)])).withColumn("digest", F.lit(1)).withColumn("first", F.lit(2))
    warc.write_warc(df, f"{tmp_path}/a", DATE, key="doc_id", url="source", payload="text")
    assert told(read(spark, f"{tmp_path}/a").collect()) == plain([*ODD, (8, "again"), (None, None)])


def test_text_keys_and_line_ends_in_urls(spark, tmp_path):
    keys = ["a b", "ü/%>\r\n", "", None]
    df = spark.createDataFrame([(k, "http://x/\r\nWARC/1.1\r\n", str(k)) for k in keys], "page_id string, url string, html string")
    warc.write_warc(df, f"{tmp_path}/a", DATE)
    found = warc.read_warc(spark, f"{tmp_path}/a").select(warc.key_of("record_id").alias("k"), "target_uri").collect()
    assert {r["k"] for r in found} == set(keys) and {r["target_uri"] for r in found} == {"http://x/%0D%0AWARC/1.1%0D%0A"}


def test_empty_table(spark, tmp_path):
    warc.write_warc(spark.createDataFrame([], PAGES), f"{tmp_path}/a", DATE)
    assert warc.read_warc(spark, f"{tmp_path}/a").count() == 0


def test_damage_is_told(spark, tmp_path):
    warc.write_warc(spark.createDataFrame([(i, "u", f"text {i}") for i in range(5)], PAGES).coalesce(1), f"{tmp_path}/a", DATE)
    file = next(Path(f"{tmp_path}/a").glob("part-*"))
    data = file.read_bytes()
    for name, bad, what in (("cut", data[:-9], "end at byte"), ("longer", data.replace(b"text 3", b"text three"), "end at byte"),
                            ("other", data.replace(b"text 3", b"text 4"), "damaged")):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "x.warc").write_bytes(bad)
        with pytest.raises(Exception, match=what):
            warc.read_warc(spark, str(folder)).collect()


def test_other_versions_and_gzip(spark, tmp_path):
    import gzip

    old = "WARC/1.0\r\nWARC-Type: warcinfo\r\nwarc-record-id: <urn:x>\r\nContent-Type: application/warc-fields\r\ncontent-length: 6\r\n\r\na: b\r\n\r\n\r\n"
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress((old + old.replace("urn:x", "urn:y")).encode()))
    got = warc.read_warc(spark, str(tmp_path)).collect()
    assert {(r["record_id"], r["record_type"], r["payload_bytes"]) for r in got} == {("urn:x", "warcinfo", 6), ("urn:y", "warcinfo", 6)}


def test_chains_match_a_plain_walk():
    rng = random.Random(4)
    for _ in range(50):
        starts = np.array(sorted(rng.sample(range(200), 30)))
        stops = np.array([rng.choice([*(x for x in starts if x > s), 300 + s]) for s in starts])
        last, end = warc.follow(starts, stops)
        nxt = dict(zip(starts.tolist(), stops.tolist()))
        for i, s in enumerate(starts.tolist()):
            while nxt[s] in nxt:
                s = nxt[s]
            assert (last[i], end[i]) == (s, nxt[s])
