"""Trained operators: exact recursions by brute force, accuracy on held-out documents, odd tables."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import ODD, clashing
from pyspark.sql import functions as F

from tidemark.llm import hmm, licenses, quality, queries, toxicity
from tidemark.llm.common import fold, load
from tidemark.llm.ragged import steps
from tidemark.llm.sample import labelled_sample

LABELS = "doc_id long, quality int, toxic int"


def test_steps_visit_every_element_in_order():
    lengths = np.array([3, 0, 1, 5])
    seen = [rows.tolist() for rows in steps(lengths)]
    assert seen == [[4, 0, 3], [5, 1], [6, 2], [7], [8]]


def test_fold_is_crc32_of_the_text(spark):
    got = spark.range(50).select("id", fold("id").alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in got)


def test_forward_backward_is_exact():
    rng = np.random.default_rng(0)
    good, trans, counts = rng.normal(size=7), rng.normal(size=(2, 2)), np.array([4, 0, 3])
    chance, pairs, total = quality.forward_backward(good, trans, counts)
    want, want_pairs, want_total, at = [], np.zeros((2, 2)), 0.0, 0
    for n in (4, 3):
        paths = list(itertools.product((0, 1), repeat=n))
        weight = np.array([math.exp(sum(good[at + i] * y for i, y in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:]))) for p in paths])
        share = weight / weight.sum()
        want += [sum(s for s, p in zip(share, paths) if p[i]) for i in range(n)]
        for s, p in zip(share, paths):
            for a, b in zip(p, p[1:]):
                want_pairs[a, b] += s
        want_total += math.log(weight.sum())
        at += n
    assert np.allclose(chance, want) and np.allclose(pairs, want_pairs) and np.isclose(total, want_total)


def test_hmm_likelihood_and_counts_are_exact():
    rng = np.random.default_rng(1)
    model = hmm.Hmm.estimated(rng.random(3), rng.random((3, 3)), rng.random((5, 3)))
    symbols, lengths = rng.integers(0, 5, 9), np.array([4, 1, 4])
    start, trans, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    logs, at = [], 0
    for n in lengths:
        own, total = symbols[at:at + n], 0.0
        s, t, e = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            p = model.start[path[0]] * np.prod([model.trans[a, b] for a, b in zip(path, path[1:])]) * np.prod([model.emit[x, k] for x, k in zip(own, path)])
            total += p
            s[path[0]] += p
            for a, b in zip(path, path[1:]):
                t[a, b] += p
            for x, k in zip(own, path):
                e[x, k] += p
        logs.append(math.log10(total))
        start, trans, emit, at = start + s / total, trans + t / total, emit + e / total, at + n
    assert np.allclose(model.log10(symbols, lengths), logs)
    for got, want in zip(model.expected(symbols, lengths), (start, trans, emit)):
        assert np.allclose(got, want)


def test_baum_welch_never_lowers_the_likelihood():
    rng = np.random.default_rng(2)
    symbols, lengths = rng.integers(0, 20, 600), np.full(30, 20)
    model, last = hmm.Hmm.initial(np.bincount(symbols, minlength=20), 4), -np.inf
    for _ in range(8):
        now = model.log10(symbols, lengths).sum()
        assert now > last - 1
        last = now
        model = hmm.Hmm.estimated(*model.expected(symbols, lengths))


def unigrams(rows):
    tokens = [(k, (t or "").encode().lower().split() + [None]) for k, t in rows]
    train = Counter(w for k, ws in tokens if zlib.crc32(str(k).encode()) % 5 != 1 for w in ws)
    n, v = sum(train.values()), len(train)
    return {k: (len(ws), sum(train[w] > 0 for w in ws), n, sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for k, ws in tokens}


SMALL = {"bits": 6, "block_bytes": 2000}


def test_language_model_of_odd_texts(documents):
    rng = random.Random(3)
    rows = ODD + [(100 + i, " ".join(rng.choice(("the", "of", "le", "la", f"w{rng.randrange(40)}")) for _ in range(30))) for i in range(60)]
    got = {r["key"]: r for r in hmm.score_corpus(clashing(documents(rows)), fold() != 1, **SMALL).collect()}
    for key, want in unigrams(rows).items():
        r = got[key]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:3]
        assert math.isclose(r["base_score"], want[3], rel_tol=1e-9) and r["score"] < 0 and math.isfinite(r["score"])


def test_language_model_without_rows(documents):
    assert hmm.score_corpus(documents([]), fold() != 1, **SMALL).count() == 0
    untrained = hmm.score_corpus(documents(ODD), F.lit(False), **SMALL).collect()
    assert {r["train_tokens"] for r in untrained} == {0} and all(math.isfinite(r["score"]) for r in untrained)


def test_every_round_covers_the_corpus(documents):
    rng = random.Random(9)
    rows = [(i, " ".join(f"t{i % 3}w{rng.randrange(60)}" if rng.random() < 0.7 else f"w{rng.randrange(9)}" for _ in range(8))) for i in range(2400)]
    rows += [(9000 + i, " ".join(f"long{rng.randrange(90)}" for _ in range(4000))) for i in range(3)]
    texts = [t.split() for k, t in rows if zlib.crc32(str(k).encode()) % 5 != 1]
    lengths = np.array([len(w) + 1 for w in texts])
    symbols = np.concatenate([[*(1 + (zlib.crc32(x.encode()) >> 26) for x in w), hmm.END] for w in texts])
    model, last = hmm.Hmm.initial(np.bincount(symbols, minlength=65).astype(float)), -np.inf
    while (now := model.log10(symbols, lengths).sum() / len(symbols)) - last >= hmm.SETTLED:
        last, model = now, hmm.Hmm.estimated(*model.expected(symbols, lengths))
    model = hmm.Hmm.estimated(*model.expected(symbols, lengths))
    known = Counter(w for ws in texts for w in ws)
    size, distinct = Counter(), Counter()
    for w, n in known.items():
        size[zlib.crc32(w.encode()) >> 26] += n
        distinct[zlib.crc32(w.encode()) >> 26] += 1
    within = [sum(math.log10((known[w] + 0.5) / (size[c] + 0.5 * (distinct[c] + 1))) for w in ws for c in [zlib.crc32(w.encode()) >> 26]) for ws in texts]
    want = dict(zip((k for k, _ in rows if zlib.crc32(str(k).encode()) % 5 != 1), model.log10(symbols, lengths) + within))
    got = {r["key"]: r["score"] for r in hmm.score_corpus(documents(rows), fold() != 1, bits=6, block_bytes=40_000).collect()}
    assert all(math.isclose(got[k], x, rel_tol=1e-3) for k, x in want.items())


def test_language_model_beats_single_words(spark, sf_dir):
    rows = queries.lm_scores(spark, sf_dir).groupBy("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).collect()
    assert len(rows) == 2 and all(r["s"] > r["b"] for r in rows)


def accuracy(spark, folder, query, label):
    rows = query(spark, folder).join(load(spark, folder, "labels"), "doc_id").filter("held_out").filter(F.col(label).isNotNull()).collect()
    return np.mean([r["predicted"] == r[label] for r in rows]), len(rows)


@pytest.mark.parametrize("query, label, least", [(queries.quality_scores, "quality", 0.95), (queries.toxicity_scores, "toxic", 0.9)])
def test_held_out_accuracy(spark, query, label, least):
    share, n = accuracy(spark, "/root/testdata/sf0.01", query, label)
    assert n >= 50 and share >= least


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_on_odd_tables(spark, documents, module):
    label = "quality" if module is quality else "toxic"
    rng = random.Random(1)
    rows = list(ODD)
    for i in range(200):
        bad = i % 4 == 0
        words = [f"w{rng.randrange(40)}" + ("%%%" if bad and module is quality else "") for _ in range(20)]
        if bad and module is toxicity:
            words[rng.randrange(20)] = "vileword"
        rows.append((100 + i, " ".join(words)))
    labels = [(k, int(k % 4 != 0), int(k % 4 == 0)) for k, _ in rows if k >= 100] + [(None, 1, 1), (101, None, None), (104, 0, 1), (9999, 1, 0)]
    docs, table = documents(rows), spark.createDataFrame(labels, LABELS)
    model = module.train(docs, table, label=label)
    got = {r["key"]: r["score"] for r in module.score_documents(clashing(docs), model).collect()}
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in got.values())
    assert all((got[k] >= 0.5) == (k % 4 != (0 if module is quality else 0) if module is quality else k % 4 == 0) for k, _ in rows if k >= 100)
    for none in (spark.createDataFrame([], LABELS), table.filter(F.col(label) == 1)):
        flat = module.score_documents(docs, module.train(docs, none, label=label)).collect()
        assert len({round(r["score"], 9) for r in flat}) == 1
    assert module.score_documents(documents([]), model).count() == 0


def test_sample_leaves_held_out_documents_alone(spark, documents):
    rows = [(i, f"text {i}") for i in range(100)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)] * 2, LABELS)
    got = labelled_sample(documents(rows), labels, "quality", train_docs=30).collect()
    assert len(got) == 30 and all(zlib.crc32(str(r["key"]).encode()) % 5 for r in got)


def test_keep_good_keeps_columns_and_clean_rows(spark):
    docs = load(spark, "/root/testdata/sf0.01", "documents")
    labels = load(spark, "/root/testdata/sf0.01", "labels")
    kept = quality.keep_good(docs, labels)
    assert kept.schema == docs.schema
    judged = labels.join(kept.select("doc_id").withColumn("in", F.lit(1)), "doc_id", "left").collect()
    good = [r["in"] == 1 for r in judged if r["quality"] == 1]
    assert np.mean(good) > 0.98 and np.mean([r["in"] is None for r in judged if r["quality"] == 0]) > 0.9


def every_run(scanner, text):
    lines, best = [licenses.words_of(x) for x in (text or "").split("\n")], {}
    for name, template in scanner.templates:
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                if lines[a] and lines[b]:
                    words = [w for x in lines[a:b + 1] for w in x]
                    value = licenses.dice(set(zip(words, words[1:])), template)
                    if value >= scanner.threshold:
                        best[name] = min(best.get(name, (0, 0, 0)), (-value, a, b))
    return [(n, -best[n][0], best[n][1], best[n][2]) for n in sorted(best)]


def test_license_runs_match_brute_force():
    scanner, rng = licenses.Scanner(), random.Random(7)
    notices = [t for texts in licenses.NOTICES.values() for t in texts]
    for _ in range(60):
        words = rng.choice(notices).split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = rng.choice(("other", "words", "the"))
        for _ in range(rng.randrange(4)):
            words.insert(rng.randrange(len(words)), "\n")
        text = "\n".join(["some text before", " ".join(words), rng.choice(notices)][rng.randrange(2):])
        assert scanner.scan(text) == every_run(scanner, text)


def test_notices_beside_other_text():
    scanner, apache, isc = licenses.Scanner(), licenses.NOTICES["Apache-2.0"][0], licenses.NOTICES["ISC"][0].split()
    found = scanner.find(f"one\nCopyright 2020 The Authors. {apache} See the LICENSE file.\ntwo")
    assert found == [("Apache-2.0", 1.0, 1, 1)]
    halves = " ".join(isc[:12]), " ".join(isc[12:])
    assert scanner.find(f"x y z {halves[0]}\n\n// \n{halves[1]} a b c") == [("ISC", 1.0, 0, 3)]
    assert scanner.find(f"{' '.join(isc[:12])} {' '.join(map(str, range(90)))} {' '.join(isc[12:])}") == []
    assert scanner.find("Released under the MIT " * 5000) == [("MIT", 6 / 7, 0, 0)]
    assert scanner.find(None) == scanner.find("word") == []


def test_one_notice_is_one_licence(spark, documents, tmp_path):
    gpl3, gpl2 = licenses.NOTICES["GPL-3.0"][0], licenses.NOTICES["GPL-2.0"][0]
    rows = [(1, gpl3), (2, f"{gpl2}\ntext\n{gpl3}"), (3, licenses.NOTICES["LGPL-2.1"][1]), (4, licenses.NOTICES["CC-BY-NC-4.0"][1]), (5, "none"), (6, f"{gpl3} {gpl2}")]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.license_scan(spark, str(tmp_path)).collect()}
    assert {k: r["licenses"] for k, r in got.items()} == {1: "GPL-3.0", 2: "GPL-2.0,GPL-3.0", 3: "LGPL-2.1", 4: "CC-BY-NC-4.0", 5: "", 6: "GPL-2.0,GPL-3.0"}
    assert [tuple(x) for x in got[2]["found"]] == [("GPL-2.0", 1.0, 0, 0), ("GPL-3.0", 1.0, 2, 2)] and got[2]["n_licenses"] == 2


def every_window(scanner, text):
    words, best = licenses.words_of(text), {}
    for name, template in scanner.templates:
        for a in range(len(words)):
            for b in range(a + 2, min(len(words), a + 110) + 1):
                best[name] = max(best.get(name, 0), licenses.dice(set(zip(words[a:b], words[a + 1:b])), template))
    return {n: v for n, v in best.items() if v >= scanner.threshold}


def test_license_windows_match_brute_force():
    rng = random.Random(8)
    short = {n: tuple(t for t in texts if len(t) < 130) for n, texts in licenses.NOTICES.items()}
    scanner = licenses.Scanner(short)
    for _ in range(25):
        words = rng.choice([t for texts in short.values() for t in texts]).split()
        for _ in range(rng.randrange(4)):
            words.insert(rng.randrange(len(words)), rng.choice(("other", "\n", "the")))
        text = " ".join(["some text before", *words, "and after", rng.choice(("", "\n")), "the end"])
        best = every_window(scanner, text)
        found = {x[0]: x[1] for x in scanner.find(text)}
        assert (max(found.values()) if found else 0) == (max(best.values()) if best else 0)
        assert all(best[n] >= v for n, v in found.items())


def test_license_scan_of_odd_tables(documents):
    rows = [*ODD, (50, "hello\nLicensed under\nthe APACHE license, version 2.0\nbye"), (51, "MIT License"), (51, "Released under the MIT License.")]
    got = licenses.scan_documents(clashing(documents(rows))).collect()
    assert len(got) == len(rows)
    found = [(r["key"], [tuple(x) for x in r["licenses"]]) for r in got if r["licenses"]]
    assert sorted(found) == [(50, [("Apache-2.0", 1.0, 1, 2)]), (51, [("MIT", 1.0, 0, 0)])]
    assert licenses.scan_documents(documents([])).count() == 0


def test_quality_trains_on_slices_of_the_sample(monkeypatch):
    texts = [None, "", *(f"line {i} of good prose here\n\n| {i} | {i} !!!\nLINE {i % 3}" for i in range(60))]
    labels, whole, sizes = np.arange(62) % 2, quality.line_features, []
    once = quality.fit(texts, labels)
    monkeypatch.setattr(quality, "FIT_DOCS", 7)
    monkeypatch.setattr(quality, "line_features", lambda t: sizes.append(len(t)) or whole(t))
    sliced = quality.fit(texts, labels)
    assert max(sizes) == 7 and sum(sizes) == len(texts)
    assert (once.weights == sliced.weights).all() and (once.trans == sliced.trans).all() and once.curve == sliced.curve
    assert quality.fit([], np.zeros(0)).prior == 0.5
