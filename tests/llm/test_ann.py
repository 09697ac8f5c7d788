import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoal.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, leaf int, block int, vec string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, "x") for i, v in rows], SCHEMA)


def brute(rows, is_query, k=10):
    ok = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        ok.setdefault(i, []).append(tuple(map(float, np.float32(v))))
    common = max({len(v) for vs in ok.values() for v in vs}, key=lambda d: (sum(len(v) == d for vs in ok.values() for v in vs), d))
    ok = {i: min(v for v in vs if len(v) == common) for i, vs in ok.items() if any(len(v) == common for v in vs)}
    out = {}
    for q in filter(is_query, ok):
        near = sorted((math.dist(ok[q], v), i) for i, v in ok.items() if i != q)[:k]
        out[q] = [(i, d) for d, i in near]
    return out


def vectors(n, dim=6, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    return [(i, [float(x) for x in centres[i % 12] + 0.3 * rng.normal(size=dim)]) for i in range(n)]


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_and_exact_scores(spark):
    rows = vectors(3000)
    got = found(ann.search(frame(spark, rows), F.col("vec_id") % 50 == 0))
    want = brute(rows, lambda i: i % 50 == 0)
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    exact = {q: dict(brute(rows, lambda i, q=q: i == q, 3000)[q]) for q in list(want)[:5]}
    assert all(abs(d - exact[q][i]) < 1e-9 for q in exact for i, d in got[q])
    assert all(v == sorted(v, key=lambda x: (x[1], x[0])) for v in got.values())


def test_awkward_rows_ties_and_repeats(spark):
    rows = vectors(40, 3) + [(100, None), (101, [0.0, 0.0, 0.0]), (102, [1.0, None, 2.0]), (103, [float("nan"), 1.0, 1.0]),
                             (104, [float("inf"), 1.0, 1.0]), (105, [1.0, 2.0]), (None, [1.0, 2.0, 3.0]),
                             (50, [1.0, 2.0, 3.0]), (50, [1.0, 2.0, 3.0]), (60, [1.0, 2.0, 3.0]), (70, [1.0, 2.0, 3.0]),
                             (80, [1.0, 2.0, 3.0]), (80, [0.5, 2.0, 3.0])]
    random.Random(3).shuffle(rows)
    got = found(ann.search(frame(spark, rows), F.col("vec_id") % 10 == 0))
    want = brute(rows, lambda i: i % 10 == 0)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert [i for i, _ in got[60]][:2] == [50, 70]  # ties to the smaller id


def test_few_candidates_and_empty(spark):
    rows = vectors(5, 3)
    assert {q: len(v) for q, v in found(ann.search(frame(spark, rows), F.col("vec_id") >= 0)).items()} == dict.fromkeys(range(5), 4)
    assert ann.search(frame(spark, []), F.col("vec_id") >= 0).count() == 0
    assert ann.search(frame(spark, [(1, [1.0])]), F.col("vec_id") >= 0).count() == 0


def test_one_vector_fills_the_table(spark, monkeypatch):
    """A leaf of copies is dealt into blocks; none is left out."""
    monkeypatch.setattr(ann, "BLOCK", 64)
    rows = vectors(300, 4) + [(1000 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(700)]
    got = found(ann.search(frame(spark, rows), F.col("vec_id") % 100 == 0))
    for q in (1000, 1300):
        assert [i for i, _ in got[q]] == [i for i in range(1000, 1011) if i != q][:10] and got[q][0][1] == 0.0


@pytest.mark.parametrize("n", [10, 500])
def test_traversal_opens_every_leaf_once_nearest_first(n):
    x = np.array([v for _, v in vectors(n)])
    tree = ann.grow(x)
    for q in x[:5]:
        order = list(ann.best_bins(tree, q))
        assert sorted(order) == list(range(tree.n_leaves))
        assert order[0] == ann.descend(tree, q[None])[0]


def test_gathering_keeps_shards_bounded():
    shards = ann.gather({0: 10, 1: 20, 2: 500, 3: 5, 5: 90, 6: 8}, 100)
    assert shards == {0: (0, 1), 1: (0, 1), 2: (1, 5), 3: (2, 1), 5: (2, 1), 6: (3, 1)}


def test_chunks_by_the_number_that_asks(spark, monkeypatch):
    """Many chunks give the rows of one; a far group finds its own."""
    rows = vectors(900, 4) + [(2000 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(300)]
    monkeypatch.setattr(ann, "BLOCK", 64)
    one = found(ann.search(frame(spark, rows), F.col("vec_id") % 5 == 0))
    monkeypatch.setattr(ann, "CHUNK", 7)
    assert found(ann.search(frame(spark, rows), F.col("vec_id") % 5 == 0)) == one
    far = vectors(600, 4) + [(5000 + i, [900.0 + i / 100, 900.0, 900.0, 900.0]) for i in range(400)]
    few = ann.search(frame(spark, far), F.col("vec_id") == 5000)
    assert {i // 5000 for i, _ in found(few)[5000]} == {1}
