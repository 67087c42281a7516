"""The forest of deep trees: splits against brute force, votes against Spark's own forest, both ways of dealing the rows out."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from kitchenlens.operators import forest as fo
from kitchenlens.operators import mlprep as mp
from kitchenlens.operators import models as md


def table(spark, n=1500, seed=1):
    """Half of the rows are for training; row 0 is there twice, and a category is seen in the other half only."""
    rng = np.random.default_rng(seed)
    x, g, h = rng.lognormal(0, 1, n), rng.integers(0, 6, n), rng.integers(0, 40, n)
    y = (x + g / 2 + (h % 7 == 0) + rng.normal(0, 0.5, n) > 2.6).astype(int)
    rows = [(i, f"g{a}" if i % 2 or i % 100 else "never", f"h{b}", float(v), int(c), "train" if i % 2 else "test") for i, (a, b, v, c) in enumerate(zip(g, h, x, y))]
    return spark.createDataFrame(rows + rows[:2], "k long, c string, d string, n double, is_infraction int, split string")


def test_split_is_the_best_of_the_drawn_features():
    rng = np.random.default_rng(3)
    n, lay = 400, fo.Layout(np.array([0] * 4 + [1] * 5 + [2]), 9, [(9, 6)], 15)
    codes = np.stack([rng.integers(0, 4, n), 4 + rng.integers(0, 5, n), 9 + rng.integers(0, 6, n)], axis=1).astype(np.int32)
    codes[::50, 0] = lay.pad
    y, w, node = rng.integers(0, 2, n), rng.integers(1, 4, n) * 0.7, np.sort(rng.integers(0, 12, n))
    total = fo._sums(node, w, w * y, 12)
    got = fo._best_splits(codes, node, w, w * y, total, lay, np.random.default_rng(5))
    drawn = fo._draw(np.random.default_rng(5), 12, lay.n_features)
    assert all(len(set(d)) == 4 for d in drawn.tolist())

    def impurity(of):
        s, s1 = w[of].sum(), (w * y)[of].sum()
        return s1 * (s - s1) / s if s else 0.0

    def gain(k, right):
        return impurity(node == k) - impurity((node == k) & right) - impurity((node == k) & ~right)
    for k in range(12):
        every = [codes[:, lay.column[f]] == f for f in drawn[k] if f < 9] + [codes[:, 2] >= 9 + t for t in range(1, 6) if 9 in drawn[k]]
        x = codes[:, got.column[k]]
        assert got.found[k] and np.isclose(gain(k, (x >= got.lo[k]) & (x <= got.hi[k])), max(gain(k, r) for r in every))


def test_large_nodes_are_split_as_small_ones_are(monkeypatch):
    """Votes of a tree are the same however large a node is that is split by itself, many copies of a row and rows that are scored only included."""
    rng = np.random.default_rng(8)
    n, lay = 3000, fo.Layout(np.repeat([0, 1, 2, 3], [7, 300, 1, 1]), 307, [(307, 32), (339, 1)], 340)
    assert lay.dtype == np.uint16 and lay.bases.tolist() == [0, 7, 307, 339]
    columns = np.stack([rng.integers(0, 8, n), rng.integers(0, 31, n) * 10, rng.integers(0, 32, n), np.zeros(n, int)]).astype(lay.dtype)      # 7: never seen
    assert lay.ids(columns)[columns[0] == 7, 0].tolist() == [lay.pad] * int((columns[0] == 7).sum())
    y = ((columns[0] < 3) ^ (columns[2] > 20) ^ (rng.random(n) < 0.2)).astype(np.int8)
    w, scored, copies = np.where(y == 1, 0.7, 1.9) * (rng.random(n) < 0.8), rng.random(n) < 0.5, rng.poisson(1.0, n).astype(np.uint8)
    copies[:40] = np.arange(40) % 13
    found, alone = [], []
    splits = fo._best_of_large
    monkeypatch.setattr(fo, "_best_of_large", lambda nodes, *a: alone.append(len(nodes)) or splits(nodes, *a))
    for large, block, rows in ((10 ** 9, 1 << 15, fo.Rows(columns, y, w > 0, scored, (1.9, 0.7), None)), (10 ** 9, 1 << 15, fo.Rows(columns, y, w > 0, scored, None, w)),
                               (150, 1 << 15, fo.Rows(columns, y, w > 0, scored, (1.9, 0.7), None)), (300, 64, fo.Rows(columns, y, w > 0, scored, (1.9, 0.7), None))):
        monkeypatch.setattr(fo, "LARGE", large)
        monkeypatch.setattr(fo, "BLOCK", block)
        votes = np.zeros(n)
        fo.grow(rows, copies, lay, 12, np.random.default_rng(2), votes)
        found.append(votes[scored])
        assert bool(alone) == (large < 1000)
    assert (found[0] == found[1]).all() and np.allclose(found[0], found[2]) and np.allclose(found[0], found[3]) and len(set(found[0].tolist())) > 5


def test_only_the_wanted_rows_are_scored(spark):
    """The forest is the same, whichever rows' votes are wanted; in groups of rows and in one."""
    df = table(spark, 400)
    prep = Pipeline(stages=md.preprocessing(["c", "d"], ["n"])).fit(df.where("split = 'train'"))
    rows = prep.transform(mp.class_weights(df))
    train, some = F.col("split") == "train", F.col("k") % 3 == 0
    for group_rows in (1_000_000, 200):
        forest = md.BaggedForest(num_trees=5, group_rows=group_rows)
        every, part = (forest.score(prep, rows, "is_infraction", "weight", train, "p", s) for s in (None, some))
        assert sorted((r.k, r.p) for r in every.where(some).collect()) == sorted((r.k, r.p) for r in part.collect())


@pytest.fixture(scope="module")
def sparks(spark):
    df = table(spark)
    model = md.fit_pipeline(mp.class_weights(df.where("split = 'train'")), md.random_forest(num_trees=60), ["c", "d"], ["n"])
    return {r.k: r for r in md.predict(model, df.where("split = 'test'"), ["k", "is_infraction"]).collect()}


@pytest.mark.parametrize("group_rows", [1_000_000, 300])
def test_forest_is_as_good_as_sparks(spark, sparks, monkeypatch, group_rows):
    """Rows in one group, and top levels over all rows with subtrees below; every row, repeated or of a category never seen, has its vote."""
    df, want = table(spark), sparks

    def never(*_):
        raise AssertionError("the deep forest isn't Spark's")
    monkeypatch.setattr(md.RandomForestClassifier, "fit", never)
    monkeypatch.setattr(fo, "CHUNK_ROWS", 200)
    got = md.predict_by_forest(df, md.BaggedForest(num_trees=60, group_rows=group_rows), ["c", "d"], ["n"], ["k", "is_infraction"]).collect()
    assert sorted(r.k for r in got) == sorted([0, *range(0, 1500, 2)]) and all(0 <= r.probability <= 1 and r.y_pred == (r.probability > 0.5) for r in got)
    assert len({r.probability for r in got if r.k == 0}) == 1
    ours, theirs = (np.mean([r.y_pred == r.is_infraction for r in rows]) for rows in (got, want.values()))
    assert ours > theirs - 0.02 and ours > 0.75
    assert np.mean([abs(r.probability - want[r.k].probability) for r in got]) < 0.06


def test_every_kind_of_row_is_grown_or_scored_once(spark):
    df = table(spark, 300)
    prep = Pipeline(stages=md.preprocessing(["c", "d"], ["n"])).fit(df.where("split = 'train'"))
    rows = prep.transform(mp.class_weights(df))
    for group_rows in (1_000_000, 40):
        forest = md.BaggedForest(num_trees=40, group_rows=group_rows)
        train = F.col("split") == "train"
        out = forest.score(prep, rows, "is_infraction", "weight", train, "p")
        assert out.count() == df.count() and out.where("p is null").count() == 0 and "_row" not in out.columns
        right = out.where(train).agg(F.avg(((F.col("p") > 0.5).cast("int") == F.col("is_infraction")).cast("int"))).first()[0]
        assert right > 0.9         # deep trees know the rows that they were grown on
        assert sorted(out.collect()) == sorted(forest.score(prep, rows, "is_infraction", "weight", train, "p").collect())
    with pytest.raises(ValueError):
        forest.score(prep, rows, "is_infraction", "weight", F.lit(False), "p")


def test_cross_validation_takes_a_forest_beside_others(spark):
    df = table(spark, 600).selectExpr("cast(k % 3 as int) as fold", "if(split = 'train', 'train', 'val') as role", "c", "d", "n", "is_infraction", "cast(k as int) as inspection_id",
                                      "date'2000-01-01' as inspection_date", "cast(k as int) as establishment_id", "'R' as establishmenttype", "'1 ST' as establishment_address")
    recs = md.cross_validate(df, {"rf": lambda n: md.BaggedForest(num_trees=30), "always_infrac": "always_infrac", "lr": md.logistic_regression}, ["c", "d"], ["n"])
    assert [(r["classifier"], r["split_index"]) for r in recs] == [(c, k) for c in ("rf", "always_infrac", "lr") for k in range(3)]
    assert sum(r["len_train"] + r["len_val"] for r in recs) == 3 * df.count()
    rf = [r for r in recs if r["classifier"] == "rf"]
    assert all(r["f1_train"] > 0.95 and r["f1_test"] > 0.6 for r in rf)


def test_cross_validation_grows_forests_on_codes(spark, monkeypatch):
    """A forest's rows go without the vectors of the other classifiers, and their records are as those of either alone."""
    df = table(spark, 300).selectExpr("0 as fold", "if(split = 'train', 'train', 'val') as role", "c", "d", "n", "is_infraction", "cast(k as int) as inspection_id",
                                      "date'2000-01-01' as inspection_date", "cast(k as int) as establishment_id", "'R' as establishmenttype", "'1 ST' as establishment_address")
    seen = []

    def score(self, prep, rows, label, weight, train, out):
        seen.append(rows.columns)
        return rows.withColumn(out, F.when(train, F.lit(1.0)).otherwise(0.0))
    monkeypatch.setattr(fo.BaggedForest, "score", score)
    recs = {r["classifier"]: r for r in md.cross_validate(df, {"lr": md.logistic_regression, "rf": lambda n: md.BaggedForest(), "always_infrac": "always_infrac"}, ["c", "d"], ["n"])}
    assert len(seen) == 1 and "features" not in seen[0]
    assert recs["rf"]["recall_train"] == 1.0 == recs["always_infrac"]["recall_test"] and recs["rf"]["recall_test"] == 0.0 and recs["rf"]["precision_train"] == recs["always_infrac"]["precision_train"]
    alone = md.cross_validate(df, {"lr": md.logistic_regression}, ["c", "d"], ["n"])[0]
    assert recs["lr"] == alone


def test_the_power_transforms_passes_are_small_plans(spark, monkeypatch):
    """λ are rows of a pass, not columns of it; moments as numpy's, with λ of 0 and 2, negative, missing and repeated values."""
    x = [-3.0, -1.0, 0.0, 0.0, 0.5, 7.0]
    values = spark.createDataFrame([(0, v, n) for v, n in [(-3.0, 1), (-1.0, 1), (0.0, 2), (0.5, 1), (7.0, 1), (None, 0)]] + [(1, 2.0, 3)], "column int, x double, n long")
    kind = type(values)
    agg = kind.agg
    monkeypatch.setattr(kind, "agg", lambda self, *a: agg(self, *a) if len(a) < 20 else pytest.fail("a column for each λ"))
    lams = [0.0, 0.3, 1.0, 2.0, 2.5]
    got = md._weighted(values, {0: lams, 1: lams, 2: lams}, {0: 0.6, 1: 2.0, 2: 0.0})

    def transform(v, lam):
        if v >= 0:
            return np.log1p(v) if lam == 0 else ((v + 1) ** lam - 1) / lam
        return -np.log1p(-v) if lam == 2 else -((1 - v) ** (2 - lam) - 1) / (2 - lam)
    for lam, (mean, var) in zip(lams, got[0]):
        y = [transform(v, lam) for v in x]
        assert np.isclose(mean, np.mean(y)) and np.isclose(var, np.var(y))
    assert [v for _, v in got[1]] == [0.0] * 5 and got[2] == [(None, None)] * 5
