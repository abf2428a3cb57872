"""SimHash, embeddings, lines and components against brute force."""

import random

import numpy as np
import pytest
import xxhash
from cases import ODD, clashing
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import components, embeddings, lines, queries, simhash


def groups(n, pairs):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_of_odd_texts():
    for _, text in ODD:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_gray_rank_follows_the_code():
    rank = np.arange(300, dtype=np.uint64)
    code = rank ^ (rank >> np.uint64(1))
    assert (simhash.gray_rank(code) == rank).all()


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_every_near_pair(seed):
    rng = np.random.default_rng(seed)
    heads = rng.integers(0, 2**63, 12, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.integers(0, 64, 3)) for _ in range(240)], np.uint64)
    fps = np.unique(heads[rng.integers(0, 12, 240)] ^ flips)
    fps = fps[np.argsort(simhash.gray_rank(fps))]
    index = simhash.GrayIndex(fps, np.array([0]))
    who, row = index.search(fps, np.zeros(len(fps), np.int64), 4)
    want = {(i, j) for i in range(len(fps)) for j in range(len(fps)) if int(fps[i] ^ fps[j]).bit_count() <= 4}
    assert set(zip(who.tolist(), row.tolist())) == want
    pairs = [(i, j) for i, j in want if i < j]
    assert simhash.linked_rows(fps, np.array([0])).tolist() == groups(len(fps), pairs)


def test_every_pair_within_bound_shares_a_mask():
    masks, rng = simhash._masks(4), random.Random(3)
    for _ in range(2000):
        difference = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(difference & m == 0 for m in masks)


def test_components_match_brute_force(spark, documents):
    rng = random.Random(1)
    base = [" ".join(rng.choice("abcdefghijklmnop") * 3 + str(rng.randrange(50)) for _ in range(120)) for _ in range(15)]
    rows = list(ODD)
    for i in range(150):
        words = rng.choice(base).split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(99)}"
        rows.append((100 + i, " ".join(words)))
    fps = [plain_fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows)) if (fps[i] ^ fps[j]).bit_count() <= 4]
    root = groups(len(rows), pairs)
    want = {(rows[i][0], rows[root[i]][0]) for i in range(len(rows))}
    found = simhash.simhash_components(clashing(documents(rows)))
    assert {(r["key"], r["component"]) for r in found.collect()} == want
    kept = simhash.near_duplicates(documents([*rows, (None, "no id")]))
    assert kept.columns == documents(rows).columns
    assert {r["doc_id"] for r in kept.collect()} == {c for _, c in want} | {None}
    alone = simhash.simhash_components(documents([(None, base[0]), (3, base[0])])).collect()
    assert {(r["key"], r["component"]) for r in alone} == {(None, None), (3, 3)}


def test_rows_with_one_id_are_rows_of_their_own(documents):
    one, two = ("first text of some words here", "wholly different and unlike the other one")
    rows = [(1, one), (1, two), (1, one), (2, two), (3, two + " not"), (None, one), (None, one)]
    kept = simhash.near_duplicates(documents(rows).coalesce(1)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=repr) == sorted(
        [(1, one), (1, two), (3, two + " not"), (None, one), (None, one)], key=repr)
    out = lines.drop_repeated_lines(documents([(1, one), (1, two), (1, one), (2, two)]).coalesce(1)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in out) == sorted([(1, one), (1, two), (1, ""), (2, "")])


def test_simhash_of_an_empty_table(documents):
    assert simhash.simhash_components(documents([])).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (7, None), (5, 5)], "a long, b long")
    found = {r["node"]: r["component"] for r in components.connected_components(edges).collect()}
    assert found == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


VECTORS = "vec_id long, embedding array<float>, label int"


def test_embeddings_match_brute_force(spark):
    rng = np.random.default_rng(2)
    heads = rng.standard_normal((12, 16))
    v = heads[rng.integers(0, 12, 400)] + 0.02 * rng.standard_normal((400, 16))
    v[300:360] = v[300]
    labels = rng.integers(0, 2, 400)
    rows = [(i, v[i].astype(np.float32).tolist(), int(labels[i])) for i in range(400)]
    odd = [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] + [1.0] * 15, 1), (903, [None] + [1.0] * 15, 0),
           (904, rows[0][1], None), (905, [], 0), (906, [float("inf")] + [1.0] * 15, 1), (907, None, 0)]
    twice = [(907, [5.0] + [-1.0] * 15, 0), (None, rows[1][1], int(labels[1])), (None, None, None)]
    df = spark.createDataFrame([*rows, *odd, *twice], VECTORS)
    exact = np.array([r[1] for r in rows], np.float64)
    exact /= np.linalg.norm(exact, axis=1, keepdims=True)
    near = (exact @ exact.T >= embeddings.THRESHOLD) & (labels[:, None] == labels[None])
    np.fill_diagonal(near, False)
    root = groups(400, [(i, j) for i, j in zip(*np.nonzero(near)) if i < j])
    found = embeddings.near_vectors(df).collect()
    assert sorted((r["key"] is None, r["key"]) for r in found if r["key"] in (907, None)) == [(False, 907)] * 2 + [(True, None)] * 2
    got = {r["key"]: (r["n_links"], r["component"], r["kept"]) for r in found}
    assert got[None] == (0, None, True)
    assert all(got[i] == (0, i, True) for i, _, _ in odd)
    links = sum(got[i][0] for i in range(400))
    assert 0.98 * near.sum() <= links <= near.sum()
    assert np.mean([got[i][1] == root[i] for i in range(400)]) >= 0.98


def test_large_buckets_are_tiled(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "TILE", 8)
    rng = np.random.default_rng(4)
    v = np.ones(8) + 1e-3 * rng.standard_normal((90, 8))
    df = spark.createDataFrame([(i, x.tolist(), 3) for i, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    got = embeddings.near_vectors(df).collect()
    assert {r["n_links"] for r in got} == {89} and {r["component"] for r in got} == {0}


def test_embeddings_of_an_empty_table(spark):
    assert embeddings.near_vectors(spark.createDataFrame([], VECTORS)).count() == 0


def brute_lines(rows, short_copies=False):
    """(row number, line) of every line to go, for rows in key order."""
    seen, gone = [], set()
    for row, (_, text) in enumerate(rows):
        for number, line in enumerate((text or "").split("\n")):
            words = lines.line_words(line)
            if len(words) >= lines.MIN_WORDS:
                if any(lines.within_one_word(words, w) for w in seen if len(w) >= lines.MIN_WORDS):
                    gone.add((row, number))
                seen.append(words)
            elif words and short_copies:
                if words in seen:
                    gone.add((row, number))
                seen.append(words)
    return gone


def without_lines(rows, gone):
    return [(k, None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (row, i) not in gone)) for row, (k, t) in enumerate(rows)]


def test_within_one_word():
    a = b"a b c d e".split()
    assert lines.within_one_word(a, a) and lines.within_one_word(a, b"a b x d e".split())
    assert lines.within_one_word(a, b"a b c d e f".split()) and lines.within_one_word(b"b c d e".split(), a)
    assert not lines.within_one_word(a, b"b a c d e".split()) and not lines.within_one_word(a, b"a b c".split())


def random_rows(rng, n=120):
    base = [[f"w{rng.randrange(30)}" for _ in range(rng.randrange(1, 9))] for _ in range(25)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randrange(1, 5)):
            words = list(rng.choice(base))
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(words)) if words else 0
                words[at:at + rng.randrange(2)] = [f"w{rng.randrange(30)}"] * rng.randrange(2)
            text.append(" ".join(words))
        rows.append((100 + i, "\n".join(text)))
    return rows


def test_lines_match_brute_force(documents):
    rows = [r for r in ODD if r[1] is not None and len(r[1]) < 15_000] + random_rows(random.Random(5))
    want = brute_lines(rows)
    assert want
    got = lines.repeated_lines(clashing(documents(rows)))
    assert {tuple(r) for r in got.collect()} == {(rows[i][0], n) for i, n in want}
    out = lines.drop_repeated_lines(documents([*rows, (None, "a b c d e f"), (999, None)]), n_chars="n_chars")
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts == dict(without_lines(rows, want)) | {None: "a b c d e f", 999: None}


@pytest.mark.parametrize("seed", range(3))
def test_registered_line_dedup_matches_brute_force(spark, documents, tmp_path, seed):
    rng = random.Random(seed)
    rows = [*[r for r in ODD if len(r[1] or "") < 15_000], *random_rows(rng), *[(rng.randrange(100, 220), t) for _, t in random_rows(rng, 30)], (150, None), (150, "")]
    rows.sort(key=lambda r: r[0])
    documents([*rows, (None, "w1 w2 w3 w4 w5")]).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in queries.line_dedup(spark, str(tmp_path)).collect()), key=repr)
    want = [*without_lines(rows, brute_lines(rows, True)), (None, "w1 w2 w3 w4 w5")]
    assert got == sorted(((k, t, None if t is None else len(t)) for k, t in want), key=repr)


def test_lines_of_an_empty_table(documents):
    assert lines.drop_repeated_lines(documents([])).count() == 0


SHORT_LINES = [(1, "les.\nalpha beta gamma delta epsilon zeta\n\nFin"), (2, "les.\nalpha beta gamma delta epsilon zeta\n\nFin"),
               (3, "Les.\nfin de\none two three four five six"), (4, " \n"), (5, "les\nfin  DE\nfin des")]


def test_copies_of_short_lines_go(spark, documents, tmp_path):
    documents(SHORT_LINES).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in queries.line_dedup(spark, str(tmp_path)).collect()}
    want = {1: SHORT_LINES[0][1], 2: "", 3: "fin de\none two three four five six", 4: " \n", 5: "les\nfin des"}
    assert got == {k: (t, len(t)) for k, t in want.items()}


def test_a_copy_with_short_lines_leaves_the_pipeline_whole(spark, documents):
    out = corpus_pipeline.line_dedup(spark, documents(SHORT_LINES), "")
    assert {r["doc_id"] for r in out.collect()} == {1, 3, 4, 5}
    assert 2 not in {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, out, "").collect()}


def test_the_key_filter_sends_no_text_through_python(spark, documents):
    rows = [(i, f"text {i}" if i % 10 else None) for i in range(-1000, 1000)] + [(None, "no id")]
    docs = documents(rows)
    table = lines.KeyFilter(docs.filter("doc_id % 7 = 0"), "doc_id")
    found = table.passing(docs, F.col("doc_id"))
    assert found.columns == [*docs.columns, "may_hold"]
    assert not any(x in found._jdf.queryExecution().executedPlan().toString() for x in ("MapInArrow", "Python", "Shuffle"))
    got = found.collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=repr) == sorted(rows, key=repr)
    assert all(r["may_hold"] for r in got if r["doc_id"] is not None and r["doc_id"] % 7 == 0)
    assert sum(r["may_hold"] for r in got) < len([i for i, _ in rows if i is not None and i % 7 == 0]) + 20
    twice = table.passing(found, F.col("doc_id"))
    assert all(r["may_hold"] == r["_may_hold"] for r in twice.collect())
    none = lines.KeyFilter(docs.filter("false"), "doc_id").passing(docs, F.col("doc_id"))
    assert not any(r["may_hold"] for r in none.collect())
