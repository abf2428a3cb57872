"""Fill-in-the-middle against a plain version, and its boundary set against sorted lists."""

import hashlib
import re

import numpy as np
import pytest
from cases import LONG, ODD, clashing
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import infill

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(key, text):
    text, name = text or "", "" if key is None else str(key)
    h = hashlib.sha256(f"42:{name}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    words = TOKEN.findall(text)
    n = len(words)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(words[:a]), "".join(words[a:b]), "".join(words[b:])
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("values", [
    [], [0], [7, 70_000, 70_001], range(200_000), range(0, 200_000, 2), range(0, 300_000, 37), [*range(5), 65_535, 65_536, *range(131_072, 140_000)],
])
def test_selects_every_rank(values):
    values = np.array(values, np.int64)
    bounds = infill.BoundarySet(values)
    assert len(bounds) == len(values)
    for k in range(0, len(values), max(1, len(values) // 500)):
        assert bounds.select(k) == values[k]
    for k in (-1, len(values)):
        with pytest.raises(IndexError):
            bounds.select(k)


def test_all_three_forms_are_used():
    kinds = {c.kind for v in (range(200_000), range(0, 200_000, 2), range(0, 300_000, 37)) for c in infill.BoundarySet(np.array(v)).containers}
    assert kinds == {"run", "bitmap", "array"}


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab<>PSM \t\n\r\x0b\x0c\x1c\x85é好　"), max_size=40), st.integers(0, 10**12))
def test_one_text(text, key):
    n, form, output, a, b = infill.transform(text.encode(), key)
    assert (n, form, a, b, output.decode()) == plain(key, text)


def test_table(spark, documents):
    rows = [*ODD, *((100 + i, f" a<S{i} b  <{i}\tc <M é好 " * (i % 7)) for i in range(80)), (200, "x<P>y"), (None, "no id here"), (8, LONG), (8, "other"), (None, None)]
    out = infill.infill(clashing(documents(rows))).withColumn("back", infill.restored())
    got = sorted(((r["key"], r["back"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in out.collect()), key=repr)
    assert got == sorted(((k, t or "", *plain(k, t)) for k, t in rows), key=repr)
    assert {r[3] for r in got} == {"plain", "psm", "spm"}


def test_empty_table_and_text_keys(spark, documents):
    assert infill.infill(documents([])).count() == 0
    row = infill.infill(spark.createDataFrame([("k-1", "a b c")], "id string, body string"), "id", "body", rate=100).first()
    assert row["key"] == "k-1" and row["form"] != "plain"


def test_every_plan_is_narrow(spark, documents):
    plan = infill.infill(documents(ODD)).select(F.sha2("output", 256))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
