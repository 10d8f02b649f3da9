"""Top-k search against all inner products."""

import numpy as np
import pytest

from formline.llm import search

SCHEMA = "vec_id long, embedding array<float>, label int, row long, code string, size int, cluster int, score double"


def table_of(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "c", 3, 4, 5.0) for r in rows], SCHEMA)


def brute(rows):
    usable = [
        (n, i, [int(np.floor(256 * float(np.float32(x)))) for x in v])
        for n, (i, v) in enumerate(rows) if v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for n, i, v in usable:
        if i is not None and i % 50 == 0:
            others = [(-sum(map(int.__mul__, v, w)), j is None, j or 0, m) for m, j, w in usable if m != n and len(w) == len(v)]
            out += [(i, r + 1, None if no_id else j, -s) for r, (s, no_id, j, _) in enumerate(sorted(others)[:5])]
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in search.top_products(frame).collect()), key=str)


@pytest.fixture(scope="module")
def rows(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()
    out = [tuple(r) for r in given] + [(1000 + i, [0.1] * 64) for i in range(700)]  # ties by the hundred
    return out + [
        (None, [0.1] * 64), (None, None), (50, None), (100, [float("nan")] * 64), (150, [None] * 64), (200, [0.0] * 64), (200, [0.0] * 64),
        (250, [1e6] * 64), (300, [-1e6] * 64), (350, [1.0, 2.0]), (351, [3.0, -2.0]), (400, []), (401, []), (50, out[50][1]),
        (450, [-1.5] * 64), (0, [float("inf")] * 64), (500, [0.5, 0.5, 0.5]),
    ]


@pytest.mark.parametrize("least, leaf", [(1024, 128), (64, 16)])
def test_every_query_gets_its_best(spark, rows, monkeypatch, least, leaf):
    monkeypatch.setattr(search, "LEAST_ROWS", least)
    monkeypatch.setattr(search, "LEAF", leaf)
    assert found(table_of(spark, rows).repartition(3)) == brute(rows)


def test_fewer_candidates_than_asked_for_and_none(spark):
    rows = [(0, [1.0, 0.0]), (7, [0.5, 0.5]), (50, [0.0, 1.0])]
    assert found(table_of(spark, rows)) == brute(rows)
    assert found(table_of(spark, [])) == [] and found(table_of(spark, [(0, [1.0])])) == []


def test_bounds_hold_and_leaves_below_the_kth_score_stay_closed(monkeypatch):
    rng = np.random.default_rng(4)
    near = rng.integers(-200, 200, (12, 1, 16)) + rng.integers(-6, 7, (12, 100, 16))
    vectors = near.reshape(-1, 16)
    tree, queries = search.BallTree(vectors, leaf=20), vectors[::50] * 2
    exact = queries @ vectors.T
    for i, leaf in enumerate(tree.leaves):
        low, high = tree.spans[leaf]
        assert (tree.bounds(queries)[:, i] >= exact[:, tree.order[low:high]].max(axis=1)).all()
    assert sorted(tree.order.tolist()) == list(range(len(vectors)))
    opened, products = [], search._products
    monkeypatch.setattr(search, "_products", lambda x, y: opened.append(len(x) * len(y)) or products(x, y))
    ids = np.arange(len(vectors))
    search.search(tree, vectors, ids, ids, queries, np.full(len(queries), -1), np.full(len(queries), -(2**63)))
    assert sum(opened) < exact.size / 4
    opened.clear()
    best = np.sort(exact, axis=1)[:, -5]
    shared = search.search(tree, vectors, ids, ids, queries, np.full(len(queries), -1), best + 1)
    assert len(shared[0]) == sum((exact[i] >= b + 1).sum() for i, b in enumerate(best))


def test_large_components_are_multiplied_as_integers():
    x = np.array([[2**30, 1], [2**30 - 1, 3]])
    assert search._products(x, x).tolist() == [[2**60 + 1, 2**60 - 2**30 + 3], [2**60 - 2**30 + 3, (2**30 - 1) ** 2 + 9]]
