"""The weighted perceptron: its loss and gradient against Spark's model, rows counted once, the fit against Spark's own."""

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from kitchenlens.operators import models as md
from kitchenlens.operators import perceptron as pe


def table(spark, n=500, seed=4):
    rng = np.random.default_rng(seed)
    x, g = rng.integers(0, 9, n) / 3, rng.integers(0, 4, n)
    y = (x + g + rng.normal(0, 0.6, n) > 4.2).astype(int)
    return spark.createDataFrame([(i, f"g{a}", float(v), int(c)) for i, (a, v, c) in enumerate(zip(g, x, y))], "k long, c string, n double, is_infraction int")


def spark_fit(df, **net):
    prep = Pipeline(stages=md.preprocessing(["c"], ["n"])).fit(df)
    return md.PipelineModel([*prep.stages, md.perceptron(5, **net).fit(prep.transform(md.balanced_rows(df, ["k"])))])


def loss(model, df):
    p = md.vector_to_array("probability")
    return model.transform(md.balanced_rows(df, ["k"])).agg(F.avg(-F.log(F.when(F.col("is_infraction") == 1, p[1]).otherwise(p[0])))).first()[0]


def test_loss_and_gradient():
    rng = np.random.default_rng(0)
    rows, hidden = 37, 3
    codes, numbers = np.stack([rng.integers(0, 3, rows), 3 + rng.integers(0, 3, rows)], axis=1), rng.normal(size=(rows, 2))
    codes[:4, 1] = 5        # never seen: no input is set
    y, n, w = rng.integers(0, 2, rows), rng.integers(1, 5, rows), rng.normal(size=(5 + 2) * hidden + hidden + 2 * hidden + 2)
    batch = pa.RecordBatch.from_pydict({"codes": codes.tolist(), "numbers": numbers.tolist(), "y": y.tolist(), "n": n.tolist()})
    records = [r for b in pe.pack(iter([batch.slice(0, 20), batch.slice(20, 0), batch.slice(20)])) for r in b.to_pylist()]
    assert sum(r["size"] for r in records) == rows
    got = next(pe._loss(records, w, 5, hidden))

    def direct(w):
        w1, b1, w2, b2 = np.split(w, np.cumsum([21, 3, 6]))
        x = np.zeros((rows, 7))
        for i in range(rows):
            x[i, [c for c in codes[i] if c < 5]] = 1
        x[:, 5:] = numbers
        z = 1 / (1 + np.exp(-(x @ w1.reshape(7, 3) + b1))) @ w2.reshape(3, 2) + b2
        return (n * (np.log(np.exp(z).sum(axis=1)) - z[np.arange(rows), y])).sum()
    steps = np.eye(len(w)) * 1e-5
    want = [(direct(w + s) - direct(w - s)) / 2e-5 for s in steps]
    assert np.isclose(got[-2], direct(w), rtol=1e-5) and got[-1] == n.sum() and np.allclose(got[:-2], want, atol=2e-4 * n.sum())


def test_minimum_is_found():
    a = np.diag([1.0, 10.0, 100.0])
    x, history = pe.minimise(lambda x: (float(x @ a @ x) / 2 + 1, a @ x), np.array([3.0, -2.0, 1.0]), 50)
    assert np.abs(x).max() < 1e-3 and all(b <= a for a, b in zip(history, history[1:]))
    assert len(pe.minimise(lambda x: (float(x @ a @ x) / 2, a @ x), np.ones(3), 2)[1]) == 3


def test_fit_is_as_good_as_sparks_on_rows_read_once_as_counts(spark, monkeypatch):
    df, sizes, fit = table(spark), [], md.fit_weights

    def noted(packed, *args):
        sizes.append(packed.agg(F.sum("size")).first()[0])
        return fit(packed, *args)
    monkeypatch.setattr(md, "fit_weights", noted)
    start = spark_fit(df, hidden=8, max_iter=0)
    assert np.isclose(loss(md.fit_perceptron(df, ["c"], ["n"], ["k"], hidden=8, max_iter=0), df), loss(start, df))      # Spark's own start
    ours, theirs = md.fit_perceptron(df, ["c"], ["n"], ["k"], hidden=8), spark_fit(df, hidden=8)
    assert loss(ours, df) < loss(theirs, df) + 0.01 < loss(start, df) - 0.1
    assert sizes == [df.select("c", "n", "is_infraction").distinct().count()] * 2 and sizes[0] < df.count() / 3
    # a category never seen, and all zeros: the model is Spark's
    new = spark.createDataFrame([("never", 1.0)], "c string, n double")
    assert 0 < ours.transform(new).select(md.vector_to_array("probability")[1]).first()[0] < 1
