"""Hard negatives against brute force: ties, repeated rows, unusable rows, other vector lengths, anchor chunks."""

import math
import random

import numpy as np
import pytest

from kitchenlens.llm import negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, every, n_pos=5, n_neg=10, low=30, high=90):
    usable = [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows
              if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {}
    for i, v, lab in usable:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (lab, v)), (lab, v))
    out = []
    for a, (lab, v) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, w, other in usable if len(w) == len(v) and i != a)
        for ps, p, _ in [s for s in scored if s[2] == lab][:n_pos]:
            fits = [s for s in scored if s[2] != lab and low * -ps <= 100 * -s[0] <= high * -ps][:n_neg]
            out += [(a, p, r, s[1], -ps, -s[0]) for r, s in enumerate(fits, 1)]
    return sorted(out)


def rows_of(n, dims=6, seed=3):
    rnd = random.Random(seed)
    rows = [(i, [rnd.uniform(-0.2, 0.8) for _ in range(dims)], rnd.randrange(4)) for i in range(n)]
    rows += [(n + i, rows[5][1], rnd.randrange(4)) for i in range(40)]          # ties
    rows += [(n + 50, None, 1), (n + 51, [0.1] * 5 + [None], 1), (n + 52, [float("nan")] * dims, 1), (n + 53, [float("inf")] * dims, 1),
             (n + 54, [0.5] * dims, None), (None, [0.5] * dims, 1), (n + 60, [0.9, 0.9], 1), (n + 61, [0.8, 0.9], 2), (n + 62, [0.0] * dims, 3)]
    return rows + rows[:12]           # repeated rows, some of them anchors


@pytest.mark.parametrize("every,anchor_bytes", [(7, hn.ANCHOR_BYTES), (10, 400)])
def test_against_brute_force(spark, every, anchor_bytes):
    rows = rows_of(300)
    random.Random(5).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = hn.hard_negatives(df, anchor_every=every, anchor_bytes=anchor_bytes)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute_force(rows, every)


def test_small_and_wide_limits(spark):
    rows = rows_of(60)
    df = spark.createDataFrame(rows, SCHEMA)
    got = hn.hard_negatives(df, anchor_every=1, positives=2, negatives=3, low=80, high=100).collect()
    assert sorted(map(tuple, got)) == brute_force(rows, 1, 2, 3, 80, 100)
    # more than three windows overlap and share their rows
    assert hn.hard_negatives(df.limit(0)).collect() == []
    assert hn.hard_negatives(df.where("vec_id % 100 <> 0")).collect() == []
    alone = spark.createDataFrame([(0, [0.5, 0.5], 1), (1, [0.5, 0.5], 1)], SCHEMA)
    assert hn.hard_negatives(alone).collect() == []


def test_extra_columns_with_clashing_names(spark):
    rows = rows_of(120)
    df = spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], SCHEMA + ", slot int, anchor_id string, score double")
    assert sorted(map(tuple, hn.hard_negatives(df, anchor_every=9).collect())) == brute_force(rows, 9)


def test_large_components():
    big = np.array([[2.0 ** 40, 1.0], [-2.0 ** 40, 3.0]])
    whole = hn.whole_numbers(big.ravel()).reshape(2, 2)
    assert hn.products(whole, whole).tolist() == [[hn.LONGEST, -hn.LONGEST], [-hn.LONGEST, hn.LONGEST]]
    near = hn.whole_numbers(np.array([2.0 ** 22, 1.0, 2.0 ** 22, 1 / 256])).reshape(2, 2)
    assert hn.products(near, near).tolist() == [[2 ** 60 + 65536, 2 ** 60 + 256], [2 ** 60 + 256, 2 ** 60 + 1]]
    assert hn.whole_numbers(np.array([1e308, -1e308, 0.999])).tolist() == [int(1e308) * 256, -int(1e308) * 256, 255]
    assert hn.products(np.zeros((2, 0)), np.zeros((3, 0))).tolist() == [[0, 0, 0], [0, 0, 0]]


def test_contract(spark):
    got = hn.op11_hard_negatives(spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in vectors]
    assert sorted(map(tuple, got.collect())) == brute_force(rows, 100)
