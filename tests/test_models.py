"""Power transform as a saved stage, balanced rows, perceptron, optimality, evaluation of written predictions."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel

from kitchenlens.operators import evaluation as ev
from kitchenlens.operators import mlprep as mp
from kitchenlens.operators import models as md
from kitchenlens.plans import catalog

SF001 = "/root/testdata/sf0.001"


def rows_of(n, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.lognormal(0, 1, n)
    group = rng.integers(0, 3, n)
    y = (x + group + rng.normal(0, 0.7, n) > 2.6).astype(int)
    return [(i, f"g{g}", float(v), int(c)) for i, (g, v, c) in enumerate(zip(group, x, y))]


def frame(spark, n=400):
    return spark.createDataFrame(rows_of(n), "k long, c string, n double, is_infraction int")


def test_transform_stages_are_saved_like_any_other(spark, scratch):
    df = frame(spark)
    stage = md.YeoJohnson(columns=["n"], suffix="_t")
    stage.write().overwrite().save(f"{scratch}/estimator")
    again = md.YeoJohnson.load(f"{scratch}/estimator")
    assert again.getColumns() == ["n"] and again.getSuffix() == "_t" and again.uid == stage.uid
    fitted = again.fit(df)
    fitted.write().save(f"{scratch}/fitted")
    loaded = md.YeoJohnsonModel.load(f"{scratch}/fitted")
    assert fitted.transform(df).collect() == loaded.transform(df).collect()
    copy = fitted.copy({fitted.suffix: "_u"})
    assert "n_u" in copy.transform(df).columns and "n_t" in fitted.transform(df).columns
    assert Pipeline(stages=[stage]).fit(df).stages[0].getOrDefault("lambdas") == fitted.getOrDefault("lambdas")


def test_round_trip_of_a_pipeline(spark, scratch):
    df = mp.class_weights(frame(spark))
    model = md.fit_pipeline(df, md.logistic_regression(400), ["c"], ["n"])
    md.save_model(model, f"{scratch}/m")
    md.save_model(model, f"{scratch}/m")        # over itself
    loaded = md.load_model(f"{scratch}/m")
    assert isinstance(loaded, PipelineModel) and [s.uid for s in loaded.stages] == [s.uid for s in model.stages]
    assert tuple(md.same_predictions(model, loaded, df).first()) == (400, 400, 400)
    other = md.fit_pipeline(df, md.logistic_regression(1), ["c"], ["n"])
    assert md.same_predictions(model, other, df).first().num_equal_probabilities < 400


def test_gradient_is_zero_at_the_fit_only(spark):
    df = mp.class_weights(frame(spark))
    model = md.fit_pipeline(df, md.logistic_regression(400), ["c"], ["n"])
    g = {r.position: r for r in md.objective_gradient(model, df).collect()}
    assert sorted(g) == [-1, 0, 1, 2, 3] and math.sqrt(sum(r.gradient ** 2 for r in g.values())) < 1e-3
    # against numpy, on other rows than those it was fitted on
    some = mp.class_weights(frame(spark).where("k < 50"))
    lr = model.stages[-1]
    data = model.transform(some).select("features", "weight", "is_infraction").collect()
    x, w, y = np.array([r.features.toArray() for r in data]), np.array([r.weight for r in data]), np.array([r.is_infraction for r in data])
    p = 1 / (1 + np.exp(-(x @ lr.coefficients.toArray() + lr.intercept)))
    want = (w * (p - y)) @ x / w.sum() + lr.getOrDefault("regParam") * lr.coefficients.toArray()
    got = {r.position: r.gradient for r in md.objective_gradient(model, some).collect()}
    assert np.allclose([got[i] for i in range(4)], want) and np.isclose(got[-1], (w * (p - y)).sum() / w.sum()) and np.abs(want).max() > 1e-2


def test_coefficients_have_their_own_names(spark):
    """Each seen category has one column, an unseen one none, so names and coefficients are as many and in step."""
    rows = [(i, f"g{i % 3}", f"h{i % 2}", float(i % 7), int(i % 3 == 2 or i % 10 == 0)) for i in range(300)]
    df = mp.class_weights(spark.createDataFrame(rows, "k long, c string, d string, n double, is_infraction int"))
    model = md.fit_pipeline(df, md.logistic_regression(300), ["c", "d"], ["n"])
    named = dict(md.coefficients(model, ["c", "d"], ["n"]))
    assert list(named) == ["c_g0", "c_g1", "c_g2", "d_h0", "d_h1", "n"]
    assert named["c_g2"] > 2 > 0 > named["c_g0"] and abs(named["d_h0"]) < 1 and abs(named["n"]) < 1
    new = spark.createDataFrame([(1, "never", "h0", 1.0)], "k long, c string, d string, n double")
    assert model.transform(new).first().features.toArray()[:3].tolist() == [0.0, 0.0, 0.0]


def test_likelihood_table_agrees_with_the_fit(spark):
    df = frame(spark).selectExpr("n", "5.0 as same", "cast(null as double) as none")
    grid = [i / 10 for i in range(-20, 21)]
    table = md.yeo_johnson_likelihood(df, ["n", "same", "none"], grid).collect()
    assert len(table) == 3 * len(grid) and all(r.mean_log_likelihood is None for r in table if r.feature != "n")
    best = max((r for r in table if r.feature == "n"), key=lambda r: r.mean_log_likelihood)
    assert abs(best["lambda"] - md.fit_yeo_johnson(df, ["n"])["n"]) <= 0.1


def test_balanced_rows(spark):
    df = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(1000)] + [(2000, None)], "k long, is_infraction int")
    got = md.balanced_rows(df, ["k"]).groupBy("is_infraction").count().collect()
    assert {r.is_infraction: r["count"] for r in got} == {0: 900, 1: 900}
    thirds = spark.createDataFrame([(i, int(i % 5 < 2)) for i in range(3000)], "k long, is_infraction int")     # each of 1,200 counts 1.5 times
    copies = md.balanced_rows(thirds, ["k"]).groupBy("is_infraction").count().collect()
    assert {r.is_infraction: r["count"] for r in copies}[0] == 1800 and abs({r.is_infraction: r["count"] for r in copies}[1] - 1800) < 90
    assert md.balanced_rows(df.where("is_infraction = 0"), ["k"]).count() == 900
    assert md.balanced_rows(df.limit(0), ["k"]).count() == 0
    assert sorted(md.balanced_rows(thirds.repartition(7), ["k"]).collect()) == sorted(md.balanced_rows(thirds, ["k"]).collect())


def test_perceptron_beats_the_constant_baseline(spark):
    df = frame(spark, 600)
    model = md.fit_perceptron(df.where("k < 450"), ["c"], ["n"], ["k"], hidden=12)
    assert model.stages[-1].getLayers() == [4, 12, 2] if hasattr(model.stages[-1], "getLayers") else True
    scores = md.binary_scores(md.predict(model, df.where("k >= 450"), ["is_infraction"]))
    constant = md.binary_scores(df.where("k >= 450").selectExpr("is_infraction", "1 as y_pred"))
    assert scores["f1"] > constant["f1"] + 0.1 and scores["precision"] > constant["precision"] + 0.1
    tens = model.transform(df).select("features", "prediction").first()
    assert len(tens.features) == 4


@pytest.fixture(scope="module")
def scored(spark):
    return catalog.scored(spark, SF001)


def test_evaluation_of_written_predictions(spark, scored, scratch):
    """The ten-row table equals what SQL computes from the predictions the fitted model wrote."""
    scored.write.parquet(f"{scratch}/scored")
    table = ev.metrics_table(scored, "y_pred", ["y_guess", "y_always_infrac"], names={"y_pred": "ML"}).collect()
    assert len(table) == 10
    con = duckdb.connect()
    con.execute(f"CREATE VIEW s AS SELECT * FROM read_parquet('{scratch}/scored/*.parquet')")
    for r in table:
        column = "y_pred" if r.strategy == "ML" else r.strategy
        tp, fp, fn = con.execute(f"SELECT count(*) FILTER (WHERE y_true = 1 AND {column} = 1), count(*) FILTER (WHERE y_true = 0 AND {column} = 1), "
                                 f"count(*) FILTER (WHERE y_true = 1 AND {column} = 0) FROM s WHERE split = '{r.split}'").fetchone()
        p, q = tp / (tp + fp) if tp + fp else 0.0, tp / (tp + fn) if tp + fn else 0.0
        assert math.isclose(r.value, {"precision": p, "recall": q, "f1": 2 * p * q / (p + q) if p + q else 0.0}[r.metric]), r
    assert con.execute("SELECT count(*), count(DISTINCT (establishment_id, inspection_id, inspection_date)) FROM s").fetchone()[0] == scored.count()
    assert con.execute("SELECT bool_and((probability >= 0.5) = (y_pred = 1)) FROM s WHERE abs(probability - 0.5) > 1e-12").fetchone()[0]


def test_memo_is_by_table_version(spark, tmp_path):
    import os
    import shutil
    for name in catalog.INSPECTION_TABLES:
        shutil.copy(f"{SF001}/{name}.parquet", tmp_path / f"{name}.parquet")
    before = catalog._memo_key(spark, str(tmp_path), "lr")
    assert before == catalog._memo_key(spark, str(tmp_path), "lr")
    os.utime(tmp_path / "nation.parquet", (1, 1))
    assert catalog._memo_key(spark, str(tmp_path), "lr") != before
    assert catalog._memo_key(spark, "viewfs://store/in", "lr") is None


def test_the_transform_reads_its_rows_once(spark):
    rows = spark.sparkContext.accumulator(0)
    df = frame(spark).selectExpr("round(n, 1) as n", "-n as m", "cast(null as double) as none", "5.0 as same")

    def counted(batches):
        for b in batches:
            rows.add(b.num_rows)
            yield b
    seen = df.mapInArrow(counted, df.schema)
    fitted = md.YeoJohnson(columns=df.columns).fit(seen)
    assert rows.value == df.count()
    lambdas, means, stds = (fitted.getOrDefault(p) for p in ("lambdas", "means", "stds"))
    assert lambdas == list(md.fit_yeo_johnson(df, df.columns).values()) and lambdas[2:] == [1.0, 1.0]
    want = df.agg(*[f(md.yeo_johnson_expr(md.F.col(c), lam)) for c, lam in zip("nm", lambdas) for f in (md.F.avg, md.F.stddev_pop)]).first()
    assert np.allclose([means[0], stds[0], means[1], stds[1]], list(want), rtol=1e-9)
    grid = [lambdas[0] + d for d in (-0.05, 0.0, 0.05)]      # against the likelihood of the rows themselves
    llf = [r.mean_log_likelihood for r in md.yeo_johnson_likelihood(df, ["n"], grid).collect()]
    assert llf[1] == max(llf)


def test_a_fit_transforms_its_rows_once(spark):
    rows = spark.sparkContext.accumulator(0)
    df = mp.class_weights(frame(spark)).localCheckpoint()

    def counted(batches):
        for b in batches:
            rows.add(b.num_rows)
            yield b
    model = md.fit_pipeline(df.mapInArrow(counted, df.schema), md.logistic_regression(400), ["c"], ["n"])
    assert rows.value == 3 * df.count()         # labels, values, vectors
    assert len(model.stages) == 5 and model.transform(df).where("prediction is null").count() == 0


def test_a_forest_of_one_file_is_fitted_by_all_cores(spark, monkeypatch):
    partitions, fit = [], md.RandomForestClassifier.fit

    def noted(forest, rows, *args):
        partitions.append(rows.rdd.getNumPartitions())
        return fit(forest, rows, *args)
    monkeypatch.setattr(md.RandomForestClassifier, "fit", noted)
    model = md.fit_pipeline(mp.class_weights(frame(spark)).coalesce(1), md.random_forest(num_trees=3, max_depth=3), ["c"], ["n"])
    assert partitions == [spark.sparkContext.defaultParallelism] and partitions[0] > 1
    assert model.stages[-1].getNumTrees == 3
