"""Model preparation and evaluation algebra."""

import datetime as dt
import math

import numpy as np

from kitchenlens.operators import evaluation as ev
from kitchenlens.operators import mlprep as mp
from kitchenlens.operators import models as md


def test_classification_report_matches_hand_numbers(spark):
    cm = spark.createDataFrame([("m", 50, 10, 5, 35)], "strategy string, tn bigint, fp bigint, fn bigint, tp bigint")
    r = {x["label"]: x for x in ev.classification_report(cm).collect()}
    p1, r1 = 35 / 45, 35 / 40
    assert math.isclose(r["1"]["precision"], p1) and math.isclose(r["1"]["recall"], r1)
    assert math.isclose(r["1"]["f1"], 2 * p1 * r1 / (p1 + r1))
    assert math.isclose(r["accuracy"]["f1"], 85 / 100) and r["accuracy"]["support"] == 100
    zero = spark.createDataFrame([("c", 0, 0, 0, 10)], "strategy string, tn bigint, fp bigint, fn bigint, tp bigint")
    z = {x["label"]: x for x in ev.classification_report(zero).collect()}
    assert z["0"]["precision"] == 0.0 and z["0"]["f1"] == 0.0      # 0/0 → 0


def test_time_split_and_folds(spark):
    days = [dt.date(2000, 1, 1) + dt.timedelta(days=i) for i in range(0, 400, 10)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "inspection_id int, inspection_date date")
    s = {r["inspection_date"]: r["split"] for r in mp.time_split(df).collect()}
    mx = max(days)
    assert all((v == "test") == (d >= mx - dt.timedelta(days=60)) for d, v in s.items())
    folds = mp.cv_folds(df, starts=["2000-07-01"], train_start="2000-01-01")
    roles = {(r["inspection_date"], r["role"]) for r in folds.collect()}
    assert (dt.date(2000, 6, 29), "train") in roles and (dt.date(2000, 7, 9), "val") in roles


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(1,)] * 2 + [(0,)] * 6, "is_infraction int")
    w = {r["is_infraction"]: r["weight"] for r in mp.class_weights(df).collect()}
    assert math.isclose(w[1], 8 / (2 * 2)) and math.isclose(w[0], 8 / (2 * 6))


def test_yeo_johnson_lambda_matches_dense_grid(spark):
    rng = np.random.default_rng(0)
    x = rng.lognormal(1.0, 0.6, 400)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    lam = md.fit_yeo_johnson(df, ["x"])["x"]

    def llf(l):
        y = ((x + 1) ** l - 1) / l if abs(l) > 1e-12 else np.log1p(x)
        return -len(x) / 2 * np.log(y.var()) + (l - 1) * np.sum(np.log1p(x))
    grid = np.linspace(-3, 5, 8001)
    best = grid[np.argmax([llf(g) for g in grid])]
    assert abs(lam - best) < 0.01


def test_logistic_regression_separable(spark):
    rows = [(str(i % 2), float(i % 2) + 0.01 * i, i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "c string, n double, is_infraction int")
    df = mp.class_weights(df)
    model = md.fit_pipeline(df, md.logistic_regression(60), ["c"], ["n"])
    pred = md.predict(model, df, ["is_infraction"])
    assert pred.where("y_pred <> is_infraction").count() == 0


def test_cross_validate_baselines_and_lr(spark):
    rows = []
    for f in range(2):
        for role, n in (("train", 30), ("val", 10)):
            for i in range(n):
                y = i % 2
                rows.append((f, role, str(y), float(y) + 0.01 * i, y, i, dt.date(2000, 1, 1) + dt.timedelta(days=i),
                             i, "Restaurant", f"{i} ST"))
    folds = spark.createDataFrame(rows, "fold int, role string, c string, n double, is_infraction int, "
                                        "inspection_id int, inspection_date date, establishment_id int, "
                                        "establishmenttype string, establishment_address string")
    recs = md.cross_validate(folds, {"always_infrac": "always_infrac", "lr": md.logistic_regression},
                             ["c"], ["n"], parallelism=2)
    by = {(r["classifier"], r["split_index"]): r for r in recs}
    assert set(by) == {("always_infrac", 0), ("always_infrac", 1), ("lr", 0), ("lr", 1)}
    assert by[("always_infrac", 0)]["recall_test"] == 1.0 and by[("always_infrac", 0)]["precision_test"] == 0.5
    assert by[("lr", 1)]["f1_test"] == 1.0 and by[("lr", 0)]["len_val"] == 10


def test_error_shares(spark):
    pred = spark.createDataFrame([(0, "A", 1, 1), (0, "A", 1, 0), (1, "B", 0, 1), (1, "B", 1, 1)],
                                 "inspection_weekday int, AREA_NAME string, y_true int, y_pred int")
    s = {(r["subset"], r["inspection_weekday_name"]): (r["true_share"], r["pred_share"])
         for r in ev.weekday_error_share(pred).collect()}
    assert s[("all", "Monday")] == (2 / 3, 1 / 3) and s[("all", "Tuesday")] == (1 / 3, 2 / 3)
    assert s[("incorrect", "Monday")] == (1.0, 0.0)
    top = ev.area_error_top(ev.area_error_share(pred), 1).where("subset = 'all'").collect()
    assert len(top) == 1


def test_save_and_load_pipeline(spark, scratch):
    rows = [(str(i % 2), float(i % 2) + 0.01 * i, i % 2) for i in range(40)]
    df = mp.class_weights(spark.createDataFrame(rows, "c string, n double, is_infraction int"))
    model = md.fit_pipeline(df, md.logistic_regression(40), ["c"], ["n"])
    md.save_model(model, f"{scratch}/model")
    again = md.load_model(f"{scratch}/model")
    a = md.predict(model, df, ["n"]).orderBy("n").collect()
    b = md.predict(again, df, ["n"]).orderBy("n").collect()
    assert [r["y_pred"] for r in a] == [r["y_pred"] for r in b]


def test_perceptron_defined_and_fits(spark):
    rows = [(str(i % 2), float(i % 2) + 0.01 * i, i % 2) for i in range(40)]
    df = mp.class_weights(spark.createDataFrame(rows, "c string, n double, is_infraction int"))
    # width of the assembled vector: one-hot of 2 labels (dropLast keeps both, unseen bucket dropped) + 1
    model = md.fit_pipeline(df, md.perceptron(3), ["c"], ["n"])
    assert md.predict(model, df, ["n"]).count() == 40


def test_yeo_johnson_edges(spark):
    x = np.random.default_rng(1).normal(50, 8, 400) ** (1 / 12) - 1      # normal at λ = 12, outside the first grid
    df = spark.createDataFrame([(float(v), 3.0, None) for v in x], "x double, same double, none double")
    lam = md.fit_yeo_johnson(df, ["x", "same", "none"])
    assert lam["same"] == lam["none"] == 1.0 and 8 < lam["x"] < 16
    big = spark.createDataFrame([(1e9 + i,) for i in range(50)], "x double")
    assert math.isfinite(md.fit_yeo_johnson(big, ["x"])["x"])


def test_standardise_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [tuple(r) for r in md.standardise(df, ["a", "b"]).orderBy("a").collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_model_inputs():
    plain, flags = md.categorical_features(), md.categorical_features(use_flags=True)
    assert len(plain) == len(flags) == 25 and not {"Shape__Area", "neigh_shape_length", *mp.NUMERIC_FEATURES} & set(plain)
    assert sum(c.endswith("_gt_zero") for c in flags) == 8


def test_cross_validate_two_models_share_a_fold(spark):
    rows = [(0, "train" if i < 40 else "val", str(i % 2), float(i % 2) + 0.01 * i, i % 2, i, dt.date(2000, 1, 1), i, "R", "S") for i in range(50)]
    folds = spark.createDataFrame(rows, "fold int, role string, c string, n double, is_infraction int, inspection_id int, inspection_date date, "
                                        "establishment_id int, establishmenttype string, establishment_address string")
    recs = md.cross_validate(folds, {"guess": "guess", "lr": md.logistic_regression, "rf": lambda n: md.random_forest(num_trees=5, max_depth=3)}, ["c"], ["n"])
    assert [(r["classifier"], r["len_train"], r["len_val"]) for r in recs] == [(c, 40, 10) for c in ("guess", "lr", "rf")]
    assert all(r["f1_test"] == 1.0 and r["f1_train"] == 1.0 for r in recs[1:])
