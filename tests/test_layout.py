"""Z-order against plain bit counting, footers against rows."""

import datetime
import random
from decimal import Decimal

import pytest

from tidemark.operators import layout
from tidemark.operators.layout import (
    clustering_report, column_reports, file_spans, quantile_borders, report_path, with_z_rank, write_clustered, write_z_ordered,
)
from tidemark.sources.footers import footer_spans


def _interleaved(places, bits):
    """Bits of the places in turn, highest first, by text."""
    return int("".join(f"{p:0{bits}b}"[k] for k in range(bits) for p in places), 2)


@pytest.mark.parametrize("bits,borders", [(2, ([10, 20, 30], ["b", "m", "t"])), (3, ([5, 5, 5, 9], ["k"])), (4, ([], ["", "\u00e9"]))])
def test_z_rank_against_counting(spark, bits, borders):
    rng = random.Random(bits)
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, "", "a", "b", "kk", "m", "tz", "\u00e9t\u00e9"])) for _ in range(200)]
    df = spark.createDataFrame(rows, "x int, s string")
    number = lambda s: int.from_bytes(s.encode()[:7].ljust(7, b"\0"), "big")
    texts = [number(b) for b in borders[1]]
    got = with_z_rank(df, ["x", "s"], [borders[0], texts], "z", bits)
    assert got.columns == ["x", "s", "z"]
    for x, s, z in got.collect():
        places = [0 if x is None else sum(b <= x for b in borders[0]), 0 if s is None else sum(b <= number(s) for b in texts)]
        assert z == _interleaved(places, bits), (x, s)


def test_z_rank_refuses_what_does_not_fit(spark):
    df = spark.range(3).selectExpr("id a", "id b")
    with pytest.raises(ValueError, match="do not fit a 64-bit rank"):
        with_z_rank(df, ["a", "b"], [[1], [1]], "z", bits=32)
    with pytest.raises(ValueError, match="4 borders do not fit 2 bits"):
        with_z_rank(df, ["a"], [[1, 2, 3, 4]], "z", bits=2)
    assert quantile_borders(df.filter("a < 0"), ["a"], bits=2) == [[]]


@pytest.mark.parametrize("hot", [False, True])
def test_z_order_prunes_on_both_keys(spark, tmp_path, hot):
    """Depth and overlaps of either key lie below those of the second key of a sorted layout, also if a third of the
    rows share a value of the first key."""
    df = spark.range(30_000).selectExpr(f"if({hot} and id % 3 = 0, 7, cast(xxhash64(id) % 1000 as int)) a", "cast(xxhash64(id, 1) % 1000 as int) b", "id")
    write_clustered(df, ["a", "b"], 16, f"{tmp_path}/sorted")
    write_z_ordered(df, ["a", "b"], 16, f"{tmp_path}/z")
    assert spark.read.parquet(f"{tmp_path}/z").exceptAll(df).isEmpty() and spark.read.parquet(f"{tmp_path}/z").count() == 30_000
    report = lambda layout: {r.key: r for r in column_reports(spark, f"{tmp_path}/{layout}", ["a", "b"]).collect()}
    second, z = report("sorted")["b"], report("z")
    for key in ("a", "b"):
        assert z[key].average_depth < second.average_depth and z[key].average_overlaps < second.average_overlaps
    assert hot or max(z["a"].average_overlaps, z["b"].average_overlaps) < 12 < second.average_overlaps == 15
    most = max(r.rows for r in file_spans(spark, f"{tmp_path}/z", ["a"]).collect())
    assert most < 3 * 30_000 / 16


def test_footers_give_the_report_of_the_rows(spark, tmp_path):
    """NULLs, a file of NULLs alone, an empty file, blanks and signs in names, dates, decimals."""
    shape = "x long, d date, t timestamp_ntz, c decimal(12,2), b boolean, s string"
    rng, path = random.Random(5), f"{tmp_path}/odd name + %20"
    for part in range(8):
        one = lambda: (rng.randrange(100), datetime.date(2024, 1, 1 + rng.randrange(28)), datetime.datetime(2024, 1, 1, rng.randrange(24)),
                       Decimal(rng.randrange(10_000)) / 100, rng.random() < 0.5, "x" * rng.randrange(9))
        rows = [(None,) * 6] * 2 if part == 3 else [one() for _ in range(5)] + [(None,) * 6] * (part == 5)
        spark.createDataFrame([] if part == 4 else rows, shape).coalesce(1).write.parquet(f"{path}/part={part}")
    names = ["x", "d", "t", "c", "b"]
    for c in names:
        want = clustering_report(spark.read.parquet(path), [c]).first()
        assert report_path(spark, path, [c]).first() == want and want.total_files == 7, c
    by_rows = file_spans(spark, path, [*names, "s"])
    key = lambda df: sorted((tuple(r) for r in df.select("rows", *[f"{e}_{c}" for c in names for e in ("lo", "hi")]).collect()), key=repr)
    assert key(file_spans(spark, path, names)) == key(by_rows)


def test_footer_report_reads_no_column_data(spark, tmp_path):
    spark.range(100).write.parquet(f"{tmp_path}/t")
    plan = footer_spans(spark, f"{tmp_path}/t", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FileScan binaryFile [path" in plan and "content" not in plan.split("ReadSchema")[1]
    spark.createDataFrame([("a",)], "s string").write.parquet(f"{tmp_path}/texts")
    with pytest.raises(TypeError, match="no exact ends"):
        footer_spans(spark, f"{tmp_path}/texts", ["s"])


@pytest.mark.parametrize("scanned", [False, True])
def test_files_larger_than_a_sort_are_sorted_ranges(spark, tmp_path, monkeypatch, scanned):
    """Four files of 2,500 rows, of which a task sorts at most some 500: as many files, disjoint and sorted, copies included."""
    monkeypatch.setattr(layout, "ROWS_PER_SORT", 500)
    sizes = []
    kept = layout.sorted_by_range
    monkeypatch.setattr(layout, "sorted_by_range", lambda df, by, n, spread: sizes.append(n) or kept(df, by, n, spread))
    spark.range(10_000).selectExpr("if(id % 4 = 0, 7, cast(xxhash64(id) % 1000 as int)) a", "if(id % 4 = 0, 0, id) id").write.parquet(f"{tmp_path}/in")
    df = spark.read.parquet(f"{tmp_path}/in")
    write_clustered(df, ["a"], 4, f"{tmp_path}/out", scanned)
    write_z_ordered(df, ["a", "id"], 4, f"{tmp_path}/z", scanned=scanned)
    assert sizes == [20, 20]
    for path in ("out", "z"):
        out = spark.read.parquet(f"{tmp_path}/{path}")
        assert out.exceptAll(df).isEmpty() and out.count() == 10_000 and out.columns == df.columns
        assert len(file_spans(spark, f"{tmp_path}/{path}", ["a"]).collect()) == 4
    spans = sorted((r.lo_a, r.hi_a) for r in file_spans(spark, f"{tmp_path}/out", ["a"]).collect())
    assert all(hi <= lo for (_, hi), (lo, _) in zip(spans, spans[1:]))
    placed = spark.read.parquet(f"{tmp_path}/out").selectExpr("_metadata.file_name f", "_metadata.row_index r", "a").orderBy("f", "r").collect()
    assert all(x.f != y.f or x.a <= y.a for x, y in zip(placed, placed[1:]))


def test_one_file_for_each_value_without_a_sort(spark, tmp_path):
    """Values that a hash deals to one task have a file each, and so has NULL; the write sorts nothing."""
    df = spark.range(4000).selectExpr("if(id % 9 = 8, null, id % 9 * 5) v", "id")
    layout.write_by_value(df, df.v + 0, f"{tmp_path}/v")
    spans = file_spans(spark, f"{tmp_path}/v", ["v"]).collect()
    assert len(spans) == 9 and all(r.lo_v == r.hi_v for r in spans) and sum(r.rows for r in spans) == 4000
    layout.write_by_value(df.filter("id < 0"), df.v, f"{tmp_path}/none")
    assert spark.read.parquet(f"{tmp_path}/none").count() == 0


def test_z_order_report_writes_no_copy_to_tell_rows_apart(spark, sf_dir, monkeypatch):
    """Rows of a scan have their file and number there, so none of the layouts writes them first, however many there are."""
    from tidemark.operators import ordered
    from tidemark.plans import files as plans_files

    monkeypatch.setattr(ordered, "cut_lineage", None)
    kept = ordered.more_rows_than
    monkeypatch.setattr(ordered, "more_rows_than", lambda df, n: kept(df, 100 if "l_quantity" in df.columns else n))
    assert plans_files.z_order_report(spark, sf_dir).count() == 4
