"""Hard negatives against brute force, and the tree against a scan."""

import numpy as np
import pytest
from cases import clashing

from tidemark.llm import hard_negatives as hn

VECTORS = "vec_id long, embedding array<double>, label int"


def brute(rows, every=100, k=5):
    use = [(i, lab, np.floor(256 * np.array(v, float))) for i, v, lab in rows
           if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dim = max((len(v) for _, _, v in use), default=0) or 1
    x = np.array([np.r_[v, np.zeros(dim - len(v))] for _, _, v in use]).reshape(-1, dim)
    s = (x @ x.T).astype(np.int64)
    out = []
    for a, (aid, alab, _) in enumerate(use):
        if aid is None or aid % every:
            continue
        order = sorted((r for r in range(len(use)) if r != a), key=lambda r: (-s[a, r], use[r][0] is None, use[r][0] or 0))
        for p in [r for r in order if use[r][1] == alab][:k]:
            fit = [r for r in order if use[r][1] != alab and 80 * s[a, p] <= 100 * s[a, r] <= 100 * s[a, p]]
            out += [(aid, use[p][0], n, use[r][0], int(s[a, p]), int(s[a, r])) for n, r in enumerate(fit[:k], 1)]
    return sorted(out, key=repr)


def mined(df, **how):
    return sorted((tuple(r) for r in hn.hard_negatives(df, **how).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=repr)


def clustered(rng, n, dim, heads=10, spread=0.1):
    centres = rng.standard_normal((heads, dim))
    return centres[rng.integers(0, heads, n)] + spread * rng.standard_normal((n, dim))


@pytest.mark.parametrize("seed", range(6))
def test_tree_matches_a_scan(seed, monkeypatch):
    monkeypatch.setattr(hn, "LEAF", 5)
    rng = np.random.default_rng(seed)
    x = np.floor(20 * clustered(rng, 400, 6))
    x[100:200] = x[100]
    uid, ids, label = np.arange(400) + 7, rng.integers(0, 150, 400), rng.integers(0, 3, 400)
    space = hn.Space(6, float((x * x).sum(axis=1).max()))
    tree = hn.Tree.build(space, x, uid, ids, label)
    assert sorted(tree.uid) == sorted(uid) and len(tree.first) > 20
    q, own = x[::9], uid[::9]
    for same in (True, False):
        lo, hi = np.where(rng.random(len(q)) < 0.5, -np.inf, 50.0), np.where(rng.random(len(q)) < 0.5, np.inf, 400.0)
        who, row, score = tree.search(q, label[::9], own, lo, hi, same, 5)
        for i in range(len(q)):
            s = x @ q[i]
            ok = [r for r in range(400) if (label[r] == label[9 * i]) == same and lo[i] <= s[r] <= hi[i] and uid[r] != own[i]]
            want = sorted(ok, key=lambda r: (-s[r], ids[r], uid[r]))[:5]
            assert tree.uid[row[who == i]].tolist() == [uid[r] for r in want]
            assert score[who == i].tolist() == [s[r] for r in want]


def test_subtrees_are_eliminated():
    rng = np.random.default_rng(1)
    x = np.floor(256 * clustered(rng, 4000, 16, 30, 0.02))
    space = hn.Space(16, float((x * x).sum(axis=1).max()))
    points = x[hn.far_points(space, x, 16)]
    d = space.between(points, x)
    low, high = hn.ranges(d, d.argmin(axis=0), 16)
    q = x[:50]
    lo = np.sort(q @ x.T, axis=1)[:, -10]
    alive = hn.survivors(space, *hn.query_distances(space, q, points), lo, np.full(50, np.inf), low, high)
    assert alive.mean() < 0.5
    inside = (q @ x.T >= lo[:, None])
    for i, r in zip(*np.nonzero(inside)):
        assert alive[i, d.argmin(axis=0)[r]]


def rows_of(x, labels, ids=None):
    return [(int(i), v.tolist(), int(lab)) for i, v, lab in zip(range(len(x)) if ids is None else ids, x, labels)]


@pytest.mark.parametrize("small", [False, True])
def test_table_matches_brute_force(spark, monkeypatch, small):
    if small:
        for name, value in (("BLOCK", 16), ("LEAF", 4), ("FANOUT", 3), ("SAMPLE", 40), ("BATCH", 3), ("TILE_BLOCKS", 2), ("TILE_BATCHES", 2)):
            monkeypatch.setattr(hn, name, value)
    rng = np.random.default_rng(3)
    x = clustered(rng, 600, 8)
    x[200:400] = x[200]
    rows = rows_of(x, rng.integers(0, 4, 600))
    odd = [(700, None, 1), (800, [float("nan")] + [1.0] * 7, 1), (900, [None] + [1.0] * 7, 0), (1000, rows[0][1], None), (1100, [], 0),
           (1200, [float("inf")] * 8, 1), (None, x[0].tolist(), 2), (None, x[100].tolist(), 3), (1300, x[300].tolist()[:3], 1), (-100, x[5].tolist(), 2),
           (0, x[0].tolist(), rows[0][2]), (0, x[0].tolist(), rows[0][2]), (200, x[7].tolist(), 3), (1400, [0.0] * 8, 2)]
    df = clashing(spark.createDataFrame([*rows, *odd], VECTORS).withColumnRenamed("label", "lab")).withColumnRenamed("label", "x")
    assert mined(df, label="lab", every=20 if not small else 100) == brute([*rows, *odd], 20 if not small else 100)


def test_no_rows_one_row_and_no_negatives(spark):
    assert mined(spark.createDataFrame([], VECTORS)) == []
    assert mined(spark.createDataFrame([(0, [1.0], 1)], VECTORS)) == []
    assert mined(spark.createDataFrame([(0, None, 1)], VECTORS)) == []
    assert mined(spark.createDataFrame([(0, [], 1), (1, [], 1), (2, [], 2)], VECTORS)) == brute([(0, [], 1), (1, [], 1), (2, [], 2)]) != []


def test_scores_too_large_raise(spark):
    with pytest.raises(ValueError, match="not exact"):
        hn.hard_negatives(spark.createDataFrame([(0, [1e9], 1)], VECTORS))
