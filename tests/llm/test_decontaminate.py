"""Decontamination against brute force, and the pipeline against a plain version of its stages."""

import hashlib
import random
import re

import pytest
from cases import ODD, clashing
from pyspark.sql import functions as F
from test_near_dedup import brute_lines, groups, plain_fingerprint, without_lines
from tokenizers import Tokenizer

import corpus_pipeline
import oracle
from tidemark.llm import decontaminate, quality, queries
from tidemark.llm.common import load

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans(decontaminate.UPPER, decontaminate.LOWER)


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(docs, items):
    out = {}
    for key, text in docs:
        own, hit, found = words(text), set(), set()
        for item, passage in items:
            w = words(passage)
            size = min(len(w), 13)
            windows = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if w else set()
            for i in range(len(own)):
                if size and tuple(own[i:i + size]) in windows:
                    hit.update(range(i, i + size))
                    found.add(item)
        hit, found = (hit, found) if key is not None else (set(), set())
        out[key] = (len(own), len(hit), len(found), sorted(str(i) for i in found if i is not None), bool(hit) and 20 * len(hit) >= len(own))
    return out


def table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def check(spark, documents, docs, items):
    rows = decontaminate.contamination(clashing(documents(docs)), table(spark, items)).collect()
    got = {r["key"]: (r["n_words"], r["n_hit"], r["n_items"], r["items"], r["contaminated"]) for r in rows}
    assert len(rows) == len(docs) and got == brute(docs, items)


def test_random_passages_match_brute_force(spark, documents):
    rng = random.Random(11)
    vocabulary = ["a", "b", "the", "The", "of", "é", "x1", "好"] + [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice((1, 2, 3, 5, 12, 13, 14, 30))))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "?! -"), (103, items[0][1]), (None, "w1 w2 w3"), (None, "w4 w5"), (104, "tie tie tie tie")]
    docs = [r for r in ODD if r[1] is None or len(r[1]) < 30_000] + [(None, "w1 w2 w3 w4"), (50, "w1 w2 w3 w4 w5")]
    for i in range(120):
        parts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(40)))]
        if i % 2:
            w = rng.choice(items[:25])[1].split()
            cut = rng.randrange(3)
            parts.insert(rng.randrange(2), ", ".join(w[cut:]).upper() if i % 3 else "\n".join(w))
        docs.append((100 + i, " ".join(parts)))
    check(spark, documents, docs, items)


def test_a_passage_of_thirteen_words_counts_and_of_twelve_does_not(spark, documents):
    passage = " ".join(f"p{i}" for i in range(20))
    w = passage.split()
    docs = [(1, " ".join(w[3:16])), (2, " ".join(w[3:15])), (3, " ".join(w[3:15] + ["x"] + w[15:])), (4, passage + " " + passage), (5, " ".join(w[:13] + ["z"] * 300))]
    check(spark, documents, docs, [(7, passage)])
    kept = decontaminate.decontaminate(documents([*docs, (None, passage)]), table(spark, [(7, passage)]))
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 2, 3, 5]


def test_large_sides_are_joined_too(spark, documents, monkeypatch):
    monkeypatch.setattr(decontaminate, "SEND_BYTES", 0)
    check(spark, documents, [(1, "a b c d e f g h i j k l m n"), (2, "no")], [(1, "a b c d e f g h i j k l m n o"), (2, "no no")])


@pytest.mark.parametrize("docs, items", [([], [(1, "a b")]), ([(1, "a b")], []), ([(1, "a b")], [(1, "  ")])])
def test_empty_tables(spark, documents, docs, items):
    check(spark, documents, docs, items)


def test_no_python_in_the_plan(spark, sf_dir):
    plan = queries.decontamination(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct", plan)


@pytest.mark.parametrize("name", [n for n, (_, sql) in queries.QUERIES.items() if sql])
def test_query_against_sql(spark, sf_dir, name):
    query, sql = queries.QUERIES[name]
    difference = oracle.compare(query(spark, sf_dir), oracle.connect(sf_dir), sql)
    assert difference is None, difference


def test_pipeline_matches_plain_stages(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    model = quality.train(docs, load(spark, sf_dir, "labels"))
    rows = [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()]
    rows = [r for r in rows if model.score([r[1]])[0] >= quality.ACCEPT]
    before = rows
    rows = without_lines(rows, brute_lines(rows, True))
    # A document that line dedup has emptied goes; one that had no words stays.
    rows = [(k, t) for (k, t), (_, was) in zip(rows, before) if t == was or (t or "").split()]
    fps = [plain_fingerprint(t) for _, t in rows]
    root = groups(len(rows), [(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows)) if (fps[i] ^ fps[j]).bit_count() <= 4])
    rows = [r for i, r in enumerate(rows) if root[i] == i]
    items = [(r["item_id"], r["text"]) for r in load(spark, sf_dir, "benchmark").collect()]
    bad = brute(rows, items)
    tokenizer = Tokenizer.from_file(queries.tokenizer_file("word_bpe_49k.json"))
    want = {}
    for key, text in rows:
        if not bad[key][4]:
            ids = tokenizer.encode(text, add_special_tokens=False).ids
            want[key] = (ids, hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = {r["doc_id"]: (r["ids"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == want


def test_stages_keep_the_columns(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.schema.simpleString() == docs.schema.simpleString()
    empty = docs.filter(F.lit(False))
    assert all(stage(spark, empty, sf_dir).count() == 0 for _, stage in corpus_pipeline.STAGES)
