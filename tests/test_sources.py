"""File formats with their quirks, listings, documents, catalogue."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows
from tidemark.plans import files as plans_files
from tidemark.session import new_folder
from tidemark.operators import layout, nested
from tidemark.operators.enrich import create_table_function, enrich_files, run_query
from tidemark.sources import delimited, files, records, relations
from tidemark.sources.delimited import COMMA, PIPE, read_checked, read_delimited, unload

SCHEMA = T.StructType().add("id", "long").add("label", "string").add("at", T.TimestampNTZType())
LINES = ["id|label|at", "1|aaa|2022-01-01 00:00:00", "2|NULL|null", "", "3||2022-01-01 00:00:01"]


def write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join(lines) + "\n")
    return f"{folder}/{name}"


def test_null_tokens_blank_lines_header(spark, tmp_path):
    write(tmp_path, "a.txt", LINES)
    got = rows(delimited.read_delimited(spark, str(tmp_path), SCHEMA, delimited.PIPE), "id", "label", F.col("at").cast("string"))
    assert got == [(1, "aaa", "2022-01-01 00:00:00"), (2, None, None), (3, None, "2022-01-01 00:00:01")]


def test_inline_options_override_the_format(spark, tmp_path):
    write(tmp_path, "a.txt", ["1,x,", "2,NULL,"])
    fmt = delimited.PIPE.override(sep=",", skip_header=False, null_tokens=())
    assert rows(delimited.read_delimited(spark, str(tmp_path), SCHEMA, fmt), "id", "label") == [(1, "x"), (2, "NULL")]


def test_empty_fields_may_stay_empty(spark, tmp_path):
    write(tmp_path, "a.txt", ["1||", "2|NULL|"])
    fmt = delimited.PIPE.override(skip_header=False, empty_as_null=False)
    schema = T.StructType().add("id", "long").add("label", "string").add("note", "string")
    assert rows(delimited.read_delimited(spark, str(tmp_path), schema, fmt)) == [(1, "", ""), (2, None, "")]


def test_bad_records(spark, tmp_path):
    write(tmp_path, "a.txt", [*LINES, "4|too|2022-01-01 00:00:00|many", "5|few", "six|x|2022-01-01 00:00:00"])
    read = lambda mode: delimited.read_delimited(spark, str(tmp_path), SCHEMA, delimited.PIPE, mode)
    assert rows(read("skip"), "id") == [(1,), (2,), (3,)]
    assert read("null").count() == 6
    with pytest.raises(PySparkException, match="bad record in a.txt"):
        read("abort").collect()
    checked = delimited.read_checked(spark, str(tmp_path), SCHEMA, delimited.PIPE).filter(F.size("_rejected") > 0)
    assert rows(checked, F.array_join("_rejected", ",")) == [("id",), ("line",), ("line",)]


def test_positional_and_file_name(spark, tmp_path):
    write(tmp_path, "b.txt", ["1,x", "2,y"])
    assert rows(delimited.read_positional(spark, str(tmp_path))) == [("1,x",), ("2,y",)]
    got = delimited.read_positional(spark, str(tmp_path), ",", with_file=True)
    assert rows(got, "c1", "c2", "_file_name") == [("1", "x", "b.txt"), ("2", "y", "b.txt")]


def test_external_table_sees_new_files_by_pattern(spark, tmp_path):
    write(tmp_path, "keep_1.csv", ["id,v", "1,x"])
    write(tmp_path, "other.csv", ["id,v", "9,z"])
    cols = {"id": (1, "int"), "v": (2, "string")}
    assert rows(delimited.external_table(spark, str(tmp_path), cols, "keep_*.csv")) == [(1, "x")]
    write(tmp_path, "keep_2.csv", ["id,v", "2,y"])
    delimited.refresh(spark, str(tmp_path))
    assert rows(delimited.external_table(spark, str(tmp_path), cols, "keep_*.csv")) == [(1, "x"), (2, "y")]


def test_external_table_on_bad_values(spark, tmp_path):
    write(tmp_path, "a.csv", ["id,v", "1,x", "oops,y", ",z"])
    cols = {"id": (1, "int"), "v": (2, "string")}
    with pytest.raises(PySparkException, match="bad int in column id: oops"):
        delimited.external_table(spark, str(tmp_path), cols).collect()
    assert rows(delimited.external_table(spark, str(tmp_path), cols, on_error="skip")) == [(1, "x"), (None, "z")]
    assert len(rows(delimited.external_table(spark, str(tmp_path), cols, on_error="null"))) == 3


def test_positional_scan_takes_the_widest_line(spark, tmp_path):
    write(tmp_path / "p", "a.txt", ["1|2", "3|4|5"])
    assert rows(delimited.read_positional(spark, str(tmp_path / "p"))) == [("1", "2", None), ("3", "4", "5")]


def test_infer_columns(spark, tmp_path):
    write(tmp_path, "a.csv", ["id,v,t", "1,x,2022-01-01 00:00:00"])
    assert rows(delimited.infer_columns(spark, str(tmp_path)), "ddl") == [("id int",), ("t timestamp",), ("v string",)]
    assert delimited.infer_ddl(spark, str(tmp_path)) == "id int, v string, t timestamp"


def test_copy_into_purges_what_it_loaded(spark, tmp_path):
    write(tmp_path / "in", "a.txt", LINES)
    target = str(tmp_path / "out")
    assert delimited.copy_into(spark, str(tmp_path / "in"), target, SCHEMA, delimited.PIPE, purge=True) == 3
    assert os.listdir(tmp_path / "in") == [] or all(f.startswith(".") for f in os.listdir(tmp_path / "in"))
    assert spark.read.parquet(target).count() == 3


def test_unload_reads_back(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None), (3, 'q"t')], "id int, v string")
    delimited.unload(df, str(tmp_path / "u"))
    back = delimited.read_delimited(spark, str(tmp_path / "u"), df.schema, delimited.PIPE)
    assert rows(back) == rows(df)


def test_listing(spark, tmp_path):
    write(tmp_path / "b", "2.txt", ["x"])
    write(tmp_path / "a", "1.txt", ["x"])
    listed = files.list_files(spark, str(tmp_path), "*.txt", checksum=True, recursive=True)
    assert rows(listed, "relative_path", "size") == [("a/1.txt", 2), ("b/2.txt", 2)]
    assert listed.select("md5").distinct().count() == 1
    assert [p.rsplit("/", 1)[-1] for p in files.ordered_files(spark, str(tmp_path / "a"))] == ["1.txt"]


DOC = ('{"crew":[{"call":"Ann","berth":{"town":"Leeds"},"radios":[{"band":"vhf","code":"1"},{"band":"uhf","code":"2"}]},'
       '{"call":"Bob","radios":[]},{"call":"Cyd"}]}')


def test_nested_document(spark, tmp_path):
    write(tmp_path, "d.json", [DOC])
    docs = relations.read_json_variant(spark, str(tmp_path))
    got = nested.nested_view(docs, "doc", "$.crew", "$.radios", {"name": "$.call", "town": "$.berth.town"}, {"band": "$.band"})
    assert rows(got) == [("Ann", "Leeds", "uhf"), ("Ann", "Leeds", "vhf"), ("Bob", None, None), ("Cyd", None, None)]
    assert rows(docs.select(nested.json_path("doc", "$.crew[1].call"))) == [("Bob",)]
    assert nested.explode_json(docs, "doc", "$.nothing").count() == 0
    assert rows(docs.select(nested.json_path("doc", "$.crew[0].call", "int"))) == [(None,)]
    with pytest.raises(PySparkException):
        docs.select(nested.json_path("doc", "$.crew[0].call", "int", strict=True)).collect()


def test_bad_json_raises(spark, tmp_path):
    write(tmp_path, "d.json", ["{not json"])
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING|INVALID_JSON|parse"):
        relations.read_json_variant(spark, str(tmp_path)).collect()


def test_classification_document(spark):
    doc = ('{"A":{"extra_info":{"alternates":[],"probability":"0.856"},"privacy_category":"QUASI_IDENTIFIER","semantic_category":"US_POSTAL_CODE"},'
           '"B":{"extra_info":{"probability":"1"}}}')
    df = spark.createDataFrame([("t", doc)], "p string, j string").select("p", F.parse_json("j").alias("v"))
    for rounding, want in ((False, "0.86"), (True, "1")):
        got = nested.flatten_classification(df, "v", "p", F.lit("now"), rounding).collect()
        assert [(r.attribute, r.privacy_category, str(r.probability)) for r in got] == [("A", "QUASI_IDENTIFIER", want)]


def test_catalogue_and_functions(spark, tmp_path):
    layout.ctas(spark.createDataFrame([(1, "a", 2.0)], "ID int, Name string, amount double"), "some_copy", path=str(tmp_path / "t"))
    assert rows(relations.catalog_columns(spark, "some_copy", ["id"]), "ordinal_position", "column_name") == [(2, "Name"), (3, "amount")]
    assert rows(relations.catalog_tables(spark, "default", ["EXTERNAL"], "some_*"), "table_name") == [("some_copy",)]
    assert rows(create_table_function(spark, "fn_some", "n STRING", "SELECT Name FROM some_copy")) == [("a",)]
    assert rows(run_query(spark, "SELECT ? AS x, Name FROM some_copy WHERE ID = ?", [7, 1])) == [(7, "a")]
    spark.sql("DROP TABLE some_copy")


def test_one_row_relation(spark):
    assert rows(relations.lit_row(spark, {"a": F.lit(1)}, F.lit("x") != F.lit("y"))) == [(1,)]
    assert rows(relations.lit_row(spark, {"a": F.lit(1)}, F.lit(None).cast("boolean"))) == []


def test_enrich_files_typed(spark, tmp_path):
    write(tmp_path, "i.bin", ["abc"])
    got = enrich_files(files.read_binary(spark, str(tmp_path)), lambda n, b: f'{{"size": {len(b) + n}}}', "size int", n=1)
    assert [r.data.size for r in got.collect()] == [5]


NASTY = ["plain", "two\nlines", 'a "quoted" word', '"', '""\n"', "a|b,c", "\r\n", "ends with\r", "\n\n", " spaces ", "\\", '\\"', "é\n好|", "x" * 500 + "\n" + "y" * 500]


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    yield lambda n: [spark.conf.set(k, v) for k, v in zip(names, (str(n), "1"))]
    for name, value in zip(names, old):
        spark.conf.set(name, value)


@pytest.mark.parametrize("split", [None, 40, 700])
def test_texts_with_line_breaks_come_back(spark, tmp_path, small_splits, split):
    data = [(i, t, t[::-1], None if i % 3 else t) for i, t in enumerate(NASTY * 2)]
    schema = T.StructType().add("i", "long").add("a", "string").add("b", "string").add("c", "string")
    fmt = PIPE.override(line_breaks=True)
    unload(spark.createDataFrame(data, schema).coalesce(2), f"{tmp_path}/out", fmt)
    if split:
        small_splits(split)
    got = read_delimited(spark, f"{tmp_path}/out", schema, fmt, with_file=True)
    assert rows(got, "i", "a", "b", "c") == sorted(data, key=repr)
    assert all(r["_file_path"].endswith(r["_file_name"]) for r in got.collect())


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    lines = [f'{i},"text {i}\nof two lines, ""{i}"""' for i in range(300)]
    write(str(tmp_path), "one.csv", lines)
    small_splits(1000)
    found = records.read_records(spark, str(tmp_path))
    assert sorted(r["value"] for r in found.collect()) == sorted(lines)
    assert found.filter("head").collect()[0]["value"] == lines[0]
    assert records.split_parities(spark, str(tmp_path)).count() > 5
    schema = T.StructType().add("i", "long").add("t", "string")
    got = read_delimited(spark, str(tmp_path), schema, COMMA.override(line_breaks=True, skip_header=False))
    assert rows(got) == sorted(((i, f'text {i}\nof two lines, "{i}"') for i in range(300)), key=repr)


def test_line_ends_blank_lines_and_open_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'h1,h2\r\n1,x\r\n\r\n2,"y\r\nz"\r\n3,too,many\r\n')
    (tmp_path / "b.csv").write_bytes(b'h1,h2\n4,"never closed\n5,x\n')
    (tmp_path / "c.csv").write_bytes(b"")
    schema = T.StructType().add("i", "long").add("t", "string")
    fmt = COMMA.override(line_breaks=True)
    got = read_checked(spark, f"{tmp_path}/a.csv", schema, fmt)
    assert rows(got.filter("size(_rejected) = 0"), "i", "t") == [(1, "x"), (2, "y\r\nz")]
    assert rows(got.filter("size(_rejected) > 0"), F.array_join("_rejected", ","), "_file_name") == [("line", "a.csv")]
    assert read_checked(spark, f"{tmp_path}/b.csv", schema, fmt).count() == 1
    assert read_checked(spark, f"{tmp_path}/c.csv", schema, fmt).count() == 0


def test_line_breaks_need_their_format(spark, tmp_path):
    with pytest.raises(Exception, match="line break"):
        unload(spark.createDataFrame([("a\nb",)], "t string"), f"{tmp_path}/out")


def test_binary_enrich_files_stay_small(spark, sf_dir, monkeypatch):
    """No file that an extractor takes as one value has more documents than the bound, however many there are."""
    folders = []
    monkeypatch.setattr(plans_files, "DOCUMENTS_PER_FILE", 5, raising=False)
    monkeypatch.setattr(plans_files, "new_folder", lambda s, label: folders.append(new_folder(s, label)) or folders[-1])
    total = plans_files.binary_enrich(spark, sf_dir).first()
    lines = spark.read.text(folders[0]).groupBy(F.col("_metadata.file_path")).count().agg(F.max("count"), F.sum("count")).first()
    assert lines[0] <= 5 and lines[1] == total.lines
