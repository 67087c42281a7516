"""Nearest neighbours: recall against brute force, copies and ties, rows that take no part."""

import numpy as np
import pytest

from kitchenlens.llm import ann


def brute(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in queries:
        s = np.round(u @ u[np.flatnonzero(ids == q)[0]], 12)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[q] = [int(ids[j]) for j in order]
    return out


@pytest.mark.parametrize("how", [{"block_rows": 100}, {}, {"partitions": 4, "part_rows": 100, "block_queries": 7}])
def test_recall(spark, how):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((30, 24))
    x = (centres[rng.integers(0, 30, 1500)] + 0.5 * rng.standard_normal((1500, 24))).astype(np.float32)
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.nearest(vectors, vectors.where("vec_id % 50 = 0"), 5, **how).collect()
    want, found = brute(rows, range(0, 1500, 50), 5), {}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append(r.vec_id)
        assert abs(r.score - unit[r.query_id] @ unit[r.vec_id]) < 1e-12 and r["rank"] == len(found[r.query_id])
    hit = sum(len(set(found[q]) & set(want[q])) for q in want)
    assert hit / (5 * len(want)) >= 0.9


def test_copies_ties_and_odd_rows(spark):
    same, other = [1.0, 0.0], [0.0, 2.0]
    rows = [(i, same, 1) for i in range(0, 200)] + [(300, other, 1), (300, other, 1), (400, [3.0, 0.0], 1), (401, None, 1), (402, [0.0, 0.0], 1), (403, [float("nan"), 1.0], 1),
                                                    (404, [1.0, 2.0, 3.0], 1), (None, same, 1), (450, [None, 1.0], 1), (500, [1.0, 1.0], 1), (403 + 47, [float("inf"), 1.0], 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = {}
    for r in sorted(ann.nearest(vectors, vectors.where("vec_id % 50 = 0"), 5).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert sorted(got) == [0, 50, 100, 150, 300, 400, 500]
    assert got[0] == [1, 2, 3, 4, 5] and got[50] == got[100] == got[150] == got[400] == [0, 1, 2, 3, 4]
    assert got[300] == [500, 0, 1, 2, 3] and set(got[500]) <= {300, *range(200), 400}
    assert ann.nearest(vectors.limit(0), vectors.limit(0)).count() == 0
    assert ann.nearest(vectors.where("vec_id = 300"), vectors.where("vec_id = 300")).count() == 0


def test_tree_routes(spark):
    """Levels are added while parts are large; a vector's leaf is its likeliest, and all leaves together hold each vector once."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((2000, 8)) + 4 * rng.standard_normal((2000, 1)) * np.eye(8)[rng.integers(0, 8, 2000)]
    ids = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, vec array<double>")
    one, two = (ann.fit_tree(ids, 2000, 4, 500, part_rows) for part_rows in (10 ** 6, 150))
    assert list(one) == [1] and len(two) >= 4
    tree = ann.Tree(two)
    row, leaf = tree.leaves(ann.unit_rows(x), 1)
    assert row.tolist() == list(range(2000)) and not set(leaf.tolist()) & set(two) and len(set(leaf.tolist())) > 8
    rows, leaves = tree.leaves(ann.unit_rows(x[:50]), 10_000)
    everywhere = sum(s[3].shape[0] for s in two.values()) - len(two) + 1
    assert np.bincount(rows).tolist() == [everywhere] * 50 and all(len(set(leaves[rows == i].tolist())) == everywhere for i in range(50))


def test_queries_whose_leaves_hold_too_few_rows(spark, monkeypatch):
    """With one leaf searched of many small ones every query still gets its five rows."""
    monkeypatch.setattr(ann, "_probes", lambda *a: 1)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((130, 6))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.nearest(vectors, vectors, 5, part_rows=5).groupBy("query_id").count().collect()
    assert len(got) == 130 and all(r["count"] == 5 for r in got)


def test_very_large_and_very_small_components(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e-200, 1e-200]), (2, [-3e300, 1e300]), (3, [1.0, 0.0]), (4, [5e-324, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in ann.nearest(vectors, vectors, 5).collect()}
    assert len(got) == 20 and abs(got[0, 1] - 1) < 1e-15 and abs(got[3, 2] + 3 / 10 ** 0.5) < 1e-15 and got[3, 4] == 1.0 and abs(got[0, 3] - 0.5 ** 0.5) < 1e-15


def test_contract(spark):
    got = ann.op10_ann(spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    want, found = brute([(r.vec_id, r.embedding) for r in vectors], [r.vec_id for r in vectors if r.vec_id % 50 == 0], 5), {}
    for r in sorted(got.collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert set(found) == set(want) and all(len(v) == 5 for v in found.values())
    assert sum(len(set(found[q]) & set(want[q])) for q in want) / (5 * len(want)) >= 0.9
