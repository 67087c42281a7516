"""Stage 8 models on ``pyspark.ml``: encoding, power transform, classifiers, cross-validation.

* categorical counts → ``StringIndexer(handleInvalid="keep")`` + ``OneHotEncoder(dropLast=True)``:
  every seen category keeps its column and an unseen one encodes as all zeros;
* numeric features → Yeo-Johnson power transform (λ by maximum likelihood) and standardisation,
  fitted with a handful of aggregation passes over the whole table (a λ grid per pass);
* logistic regression with balanced class weights and the L2 strength mapped from ``C``;
* random forest with balanced weights (deep forests: ``forest.BaggedForest``).
Every fit is a series of distributed aggregations; nothing is collected except model state.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import hash_text
from ..session import cut_lineage, drop_stage
from .forest import BaggedForest
from .mlprep import FLAG_FEATURES, LABEL, MODEL_FEATURES, NUMERIC_FEATURES, UNUSED_FEATURES, class_weights, gt_zero_flags
from .perceptron import fit_weights, pack


# ---- Yeo-Johnson -------------------------------------------------------------------------------

def yeo_johnson_expr(x: Column, lam: float) -> Column:
    """Native expression of the Yeo-Johnson transform for one λ."""
    pos = (F.pow(x + 1.0, lam) - 1.0) / lam if abs(lam) > 1e-12 else F.log1p(x)
    neg = -(F.pow(1.0 - x, 2.0 - lam) - 1.0) / (2.0 - lam) if abs(lam - 2.0) > 1e-12 else -F.log1p(-x)
    return F.when(x >= 0, pos).otherwise(neg)


def _value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, x, n): how often each column (by its place) has each value, written once; the fit's passes read it in place of the
    rows, of which features like days between visits repeat few values."""
    pairs = F.explode(F.array(*[F.struct(F.lit(j).alias("column"), F.col(c).cast("double").alias("x")) for j, c in enumerate(columns)]))
    return cut_lineage(df.select(pairs.alias("r")).select("r.*").groupBy("column", "x").agg(F.count("x").alias("n")), "value_counts")


def _yeo_johnson_of(x: Column, lam: Column) -> Column:
    """``yeo_johnson_expr`` of a column of λ."""
    pos = F.when(F.abs(lam) > 1e-12, (F.pow(x + 1.0, lam) - 1.0) / lam).otherwise(F.log1p(x))
    neg = F.when(F.abs(lam - 2.0) > 1e-12, -(F.pow(1.0 - x, 2.0 - lam) - 1.0) / (2.0 - lam)).otherwise(-F.log1p(-x))
    return F.when(x >= 0, pos).otherwise(neg)


def _weighted(values: DataFrame, lams: dict[int, Sequence[float]], centre: dict[int, float]) -> dict[int, list]:
    """For each column (by its place) and λ: (mean, population variance) of the transformed values, from one pass over their counts.

    A value meets its column's λ as rows, so that passes with other λ run the same compiled expression.  Sums are of differences from the
    transform of ``centre``, a value amid the others, so that they don't cancel."""
    entries = F.array(*[F.struct(F.lit(j).alias("of"), F.lit(i).alias("i"), F.lit(float(lam)).alias("lam"), F.lit(float(centre[j])).alias("centre"))
                        for j, grid in lams.items() for i, lam in enumerate(grid)])
    n, at = F.col("n"), _yeo_johnson_of(F.col("e.centre"), F.col("e.lam"))
    d = _yeo_johnson_of(F.col("x"), F.col("e.lam")) - at
    rows = values.where("x is not null").select("column", "x", "n", F.explode(entries).alias("e")).where("e.of = column")
    sums = {(r["of"], r["i"]): r for r in rows.select("e.of", "e.i", at.alias("y"), n.alias("n"), d.alias("d")).groupBy("of", "i").agg(
        F.first("y").alias("y"), F.sum("n").alias("n"), F.sum(n * F.col("d")).alias("a"), F.sum(n * F.col("d") * F.col("d")).alias("b")).collect()}

    def moments(r):
        return (None, None) if r is None or not r["n"] or r["a"] is None else (r["y"] + r["a"] / r["n"], r["b"] / r["n"] - (r["a"] / r["n"]) ** 2)
    return {j: [moments(sums.get((j, i))) for i in range(len(grid))] for j, grid in lams.items()}


def _loglik_aggs(x: Column, lams: Sequence[float], tag: str) -> list[Column]:
    aggs = [F.count(x).alias(f"{tag}_n"), (F.min(x) == F.max(x)).alias(f"{tag}_same"),
            F.sum(F.signum(x) * F.log1p(F.abs(x))).alias(f"{tag}_s")]
    for i, lam in enumerate(lams):
        y = yeo_johnson_expr(x, lam)
        aggs.append(F.var_pop(y).alias(f"{tag}_v{i}"))
    return aggs


def fit_yeo_johnson(df: DataFrame, columns: Sequence[str], lo: float = -3.0, hi: float = 5.0,
                    grid: int = 33, rounds: int = 3, max_widenings: int = 20) -> dict[str, float]:
    """λ per column by maximum likelihood: llf(λ) = −n/2·ln σ²(y_λ) + (λ−1)·Σ sign(x)·ln(1+|x|).

    The rows are read once, for the counts of the values; each round then evaluates a λ grid for all columns in ONE
    aggregation pass over these, then narrows the grid around the best λ; while the best is at an edge the grid moves on
    past it instead.  A column with no finite likelihood (constant or empty) keeps λ = 1.  Only the variances (a few
    numbers per column) reach the driver.
    """
    values = _value_counts(df, columns)
    try:
        return _fit_lambdas(values, columns, lo, hi, grid, rounds, max_widenings)[0]
    finally:
        drop_stage(values)


def _fit_lambdas(values: DataFrame, columns: Sequence[str], lo: float = -3.0, hi: float = 5.0, grid: int = 33, rounds: int = 3,
                 max_widenings: int = 20) -> tuple[dict[str, float], dict[int, float]]:
    """λ per column from the counts of its values, and the columns' means."""
    x, n = F.col("x"), F.col("n")
    first = {r["column"]: r for r in values.where("x is not null").groupBy("column").agg(
        F.sum("n").alias("n"), (F.min("x") == F.max("x")).alias("same"), F.sum(n * F.signum(x) * F.log1p(F.abs(x))).alias("s"),
        (F.sum(n * x) / F.sum("n")).alias("mean")).collect()}
    centre = {j: first[j]["mean"] if j in first else 0.0 for j in range(len(columns))}
    bounds, best = {c: (lo, hi) for c in columns}, {c: 1.0 for c in columns}
    narrowed, widened = {c: 0 for c in columns}, {c: 0 for c in columns}
    open_columns = [c for j, c in enumerate(columns) if j in first and not first[j]["same"]]
    while open_columns:
        lam_grid = {c: [a + (b - a) * i / (grid - 1) for i in range(grid)] for c, (a, b) in bounds.items()}
        moments = _weighted(values, {columns.index(c): lam_grid[c] for c in open_columns}, centre)
        for c in list(open_columns):
            j = columns.index(c)
            scores = [(-first[j]["n"] / 2.0 * math.log(var) + (lam - 1.0) * first[j]["s"], lam)
                      for lam, (_, var) in zip(lam_grid[c], moments[j]) if var is not None and math.isfinite(var) and var > 0]
            if not scores:
                best[c] = 1.0
                open_columns.remove(c)
                continue
            best[c] = max(scores)[1]
            (a, b), step = bounds[c], (bounds[c][1] - bounds[c][0]) / (grid - 1)
            if not narrowed[c] and best[c] in (lam_grid[c][0], lam_grid[c][-1]) and widened[c] < max_widenings:
                widened[c] += 1
                bounds[c] = (a - (b - a), a + step) if best[c] == lam_grid[c][0] else (b - step, b + (b - a))
                continue
            narrowed[c] += 1
            bounds[c] = (best[c] - step, best[c] + step)
            if narrowed[c] == rounds:
                open_columns.remove(c)
    return best, centre


def yeo_johnson_likelihood(df: DataFrame, columns: Sequence[str], lambdas: Sequence[float]) -> DataFrame:
    """M6: (feature, lambda, mean_log_likelihood) over a λ grid, from one aggregation pass; NULL where a column is constant or
    empty.  The mean over the rows, so that tables of any size compare."""
    aggs, rows = [], []
    for j, c in enumerate(columns):
        aggs += _loglik_aggs(F.col(f"`{c}`").cast("double"), lambdas, f"c{j}")
        for i, lam in enumerate(lambdas):
            llf = -F.log(F.col(f"c{j}_v{i}")) / 2 + F.lit(lam - 1.0) * F.try_divide(F.col(f"c{j}_s"), F.col(f"c{j}_n"))
            rows.append(F.struct(F.lit(c).alias("feature"), F.lit(float(lam)).alias("lambda"),
                                 F.when((F.col(f"c{j}_n") > 0) & ~F.col(f"c{j}_same") & (F.col(f"c{j}_v{i}") > 0), llf).alias("mean_log_likelihood")))
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


class _YeoJohnsonParams(Params):
    """Parameters of the power transform and of its fitted form; all of them are saved with the stage."""
    columns = Param(Params._dummy(), "columns", "numeric input columns", TypeConverters.toListString)
    suffix = Param(Params._dummy(), "suffix", "suffix of the output columns", TypeConverters.toString)

    def getColumns(self) -> list[str]:
        return self.getOrDefault(self.columns)

    def getSuffix(self) -> str:
        return self.getOrDefault(self.suffix)


class YeoJohnsonModel(Model, _YeoJohnsonParams, DefaultParamsReadable, DefaultParamsWritable):
    """Applies fitted λ, then standardises with the fitted mean / population sd."""
    lambdas = Param(Params._dummy(), "lambdas", "fitted λ of each column", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "mean of each transformed column", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "population sd of each transformed column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, columns=None, suffix="_yj", lambdas=None, means=None, stds=None):
        super().__init__()
        self._setDefault(suffix="_yj")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols = {}
        for c, lam, mean, sd in zip(self.getColumns(), *(self.getOrDefault(p) for p in (self.lambdas, self.means, self.stds))):
            y = yeo_johnson_expr(F.col(c).cast("double"), lam)
            cols[c + self.getSuffix()] = (y - F.lit(mean)) / F.lit(sd or 1.0)
        return dataset.withColumns(cols)


class YeoJohnson(Estimator, _YeoJohnsonParams, DefaultParamsReadable, DefaultParamsWritable):
    """M6 + M7: power transform with λ by maximum likelihood, standardised output columns."""

    @keyword_only
    def __init__(self, *, columns=None, suffix="_yj"):
        super().__init__()
        self._setDefault(suffix="_yj")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> YeoJohnsonModel:
        columns = self.getColumns()
        values = _value_counts(dataset, columns)
        lambdas, centre = _fit_lambdas(values, columns)
        moments = [m[0] for m in _weighted(values, {j: [lambdas[c]] for j, c in enumerate(columns)}, centre).values()]
        drop_stage(values)
        return YeoJohnsonModel(columns=columns, suffix=self.getSuffix(), lambdas=[lambdas[c] for c in columns], means=[mean or 0.0 for mean, _ in moments],
                               stds=[math.sqrt(var) if var and var > 0 else 1.0 for _, var in moments])


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """M7: (x − mean) / population sd; a constant column becomes 0.  All statistics come from ONE
    scalar subquery returning a struct, so the input is aggregated once."""
    st = df.agg(F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c)
                           for c in columns])).scalar()
    return df.withColumns({c: (F.col(c) - st[c]["m"]) / F.when(st[c]["s"] == 0, F.lit(1.0)).otherwise(st[c]["s"]) for c in columns})


# ---- pipelines -----------------------------------------------------------------------------------

def categorical_features(features: Sequence[str] = MODEL_FEATURES, numeric: Sequence[str] = NUMERIC_FEATURES,
                         unused: Sequence[str] = UNUSED_FEATURES, use_flags: bool = False) -> list[str]:
    """Features that are one-hot encoded.  ``use_flags`` takes ``<count>_gt_zero`` for the sparse counts (add them with
    ``with_model_flags``), so the label lists don't grow with the busiest establishment's visits."""
    out = [c for c in features if c not in {*numeric, *unused}]
    return [f"{c}_gt_zero" if use_flags and c in FLAG_FEATURES else c for c in out]


def with_model_flags(df: DataFrame) -> DataFrame:
    return gt_zero_flags(df, FLAG_FEATURES)


def preprocessing(categoricals: Sequence[str], numerics: Sequence[str]) -> list:
    """M5 + M6 + M8: one-hot categoricals (unseen → zeros), power-transformed numerics, assembled
    categorical first, then numeric."""
    idx = [f"{c}__idx" for c in categoricals]
    ohe = [f"{c}__ohe" for c in categoricals]
    return [
        StringIndexer(inputCols=list(categoricals), outputCols=idx, handleInvalid="keep", stringOrderType="alphabetAsc"),
        # the indexer's last category is the unseen one: dropped, so it has no column
        OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True, handleInvalid="error"),
        YeoJohnson(columns=list(numerics)),
        VectorAssembler(inputCols=ohe + [f"{c}_yj" for c in numerics], outputCol="features"),
    ]


def logistic_regression(n_rows: int, C: float = 1.0, max_iter: int = 1500, tol: float = 1e-4) -> LogisticRegression:
    """M9: L2 logistic regression with balanced weights.  Spark minimises the weighted mean loss
    + regParam/2·‖β‖², the source C·Σ w·loss + ½‖β‖²; with weights summing to n the two agree
    for regParam = 1 / (C·n).  ``tol`` is the source library's default stopping tolerance."""
    return LogisticRegression(featuresCol="features", labelCol=LABEL, weightCol="weight", maxIter=max_iter,
                              regParam=1.0 / (C * max(n_rows, 1)), elasticNetParam=0.0, standardization=False,
                              tol=tol)


def random_forest(num_trees: int = 250, max_depth: int = 30, seed: int = 42, max_memory_mb: int = 1024) -> RandomForestClassifier:
    """Random forest with balanced weights (Spark caps tree depth at 30).

    ``max_memory_mb`` bounds the split statistics gathered in one pass over the rows: more of it
    means fewer passes per tree level."""
    # Node ids are cached and checkpointed to the session's checkpoint folder, so deep trees
    # neither rebuild long lineages nor keep every level's state in memory.
    return RandomForestClassifier(featuresCol="features", labelCol=LABEL, weightCol="weight", numTrees=num_trees,
                                  maxDepth=max_depth, seed=seed, cacheNodeIds=True, checkpointInterval=10,
                                  maxMemoryInMB=max_memory_mb)


def predict_by_forest(data: DataFrame, forest: BaggedForest, categoricals: Sequence[str], numerics: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Label and class-1 probability of the test rows by a forest grown on the training rows (``split``)."""
    train = class_weights(data.where(F.col("split") == "train"))
    prep = Pipeline(stages=preprocessing(categoricals, numerics)).fit(train)
    rows = train.unionByName(data.where(F.col("split") == "test"), allowMissingColumns=True)
    coded = prep.transform(rows).select(*dict.fromkeys([*keep, LABEL, "split", "weight"]), *prep.stages[0].getOutputCols(), *[f"{c}_yj" for c in numerics])
    test = F.col("split") == "test"
    scored = forest.score(prep, coded, LABEL, "weight", F.col("split") == "train", "probability", test).where(test)
    return scored.select(*keep, (F.col("probability") > 0.5).cast("int").alias("y_pred"), "probability")


def perceptron(n_features: int, seed: int = 42, hidden: int = 100, max_iter: int = 100) -> MultilayerPerceptronClassifier:
    """One hidden layer of 100 units."""
    return MultilayerPerceptronClassifier(featuresCol="features", labelCol=LABEL, layers=[n_features, hidden, 2], seed=seed, maxIter=max_iter)


def fit_pipeline(train: DataFrame, classifier, categoricals: Sequence[str], numerics: Sequence[str]) -> PipelineModel:
    """Preprocessing and classifier; the vectors are written once, as a fit reads them several times before its own cache.

    A forest is work for all cores even where its vectors are one small file, which would be read by one task."""
    prep = Pipeline(stages=preprocessing(categoricals, numerics)).fit(train)
    keep = [classifier.getLabelCol(), *([classifier.getWeightCol()] if classifier.hasParam("weightCol") and classifier.isDefined("weightCol") else [])]
    vectors = cut_lineage(prep.transform(train).select("features", *keep), "vectors")
    cores = train.sparkSession.sparkContext.defaultParallelism
    fitted = classifier.fit(vectors.repartition(cores) if classifier.hasParam("numTrees") else vectors)
    drop_stage(vectors)
    return PipelineModel([*prep.stages, fitted])


def balanced_rows(df: DataFrame, key: Sequence[str], label: str = LABEL, seed: int = 42) -> DataFrame:
    """Rows repeated so that the classes are as good as equally large, for learners that take no weights: a row of a class
    counts size of the largest class / size of its class times, the fraction by a seeded hash of its key.

    Every row stays; nothing is repeated where a class is absent.  NULL labels are left out."""
    sizes = df.agg(F.struct(F.count(F.when(F.col(label) == 1, 1)).alias("n1"), F.count(F.when(F.col(label) == 0, 1)).alias("n0"))).scalar()
    most = F.greatest(sizes["n0"], sizes["n1"]).cast("double")
    times = F.coalesce(F.try_divide(most, F.when(F.col(label) == 1, sizes["n1"]).otherwise(sizes["n0"])), F.lit(1.0))
    # 13 hex digits of the hash: a number of 52 bits
    spread = F.conv(F.substring(hash_text(seed, key), 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))
    copies = (F.floor(times) + F.when(spread < times - F.floor(times), 1).otherwise(0)).cast("int")
    return df.where(F.col(label).isNotNull()).withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


def fit_perceptron(train: DataFrame, categoricals: Sequence[str], numerics: Sequence[str], key: Sequence[str], seed: int = 42, **net) -> PipelineModel:
    """Preprocessing fitted on the rows as they are, the network on the balanced rows; its input layer is as wide as the
    assembled vectors.

    Rows of equal features and label count as one row with their number as weight; Spark's estimator gives the initial weights and,
    without a step of its own, the model of the fitted ones."""
    prep = Pipeline(stages=preprocessing(categoricals, numerics)).fit(train)
    widths = [len(labels) for labels in prep.stages[0].labelsArray]
    ends, n_onehot = [sum(widths[:i]) for i in range(len(widths))], sum(widths)
    features = list(dict.fromkeys([*categoricals, *numerics]))
    rows = prep.transform(balanced_rows(train, key, seed=seed).groupBy(*[F.col(f"`{c}`") for c in features], LABEL).agg(F.count(F.lit(1)).alias("_n")))
    codes = [F.when(F.col(c) < w, F.col(c).cast("int") + at).otherwise(n_onehot) for c, w, at in zip(prep.stages[0].getOutputCols(), widths, ends)]
    coded = rows.select(F.array(*codes).alias("codes"), F.array(*[F.col(f"{c}_yj") for c in numerics]).cast("array<double>").alias("numbers"),
                        F.col(LABEL).alias("y"), F.col("_n").alias("n"))
    cores = train.sparkSession.sparkContext.defaultParallelism
    packed = cut_lineage(coded.repartition(4 * cores).mapInArrow(pack, "size long, codes binary, numbers binary, y binary, n binary"), "balanced")     # read by every step
    width = n_onehot + len(numerics)
    estimator = perceptron(width, seed, **net)
    _, hidden, _ = estimator.getLayers()
    no_rows = train.sparkSession.createDataFrame([(Vectors.sparse(width, {}), y) for y in (0, 1)], ["features", LABEL])
    initial = estimator.copy({estimator.maxIter: 0}).fit(no_rows).weights.toArray()
    weights, _ = fit_weights(packed, initial, n_onehot, hidden, estimator.getMaxIter())
    drop_stage(packed)
    fitted = estimator.copy({estimator.maxIter: 0, estimator.initialWeights: Vectors.dense(weights)}).fit(no_rows)
    return PipelineModel([*prep.stages, fitted])


def objective_gradient(model: PipelineModel, train: DataFrame) -> DataFrame:
    """M9: (position, coefficient, gradient) of the objective the regression minimises, at the fitted coefficients: the mean of
    weight · (p − y) · x over the rows (weights scaled to a sum of the rows) plus regParam · coefficient; position −1 is the intercept, which has no penalty.

    One grouped sum over the vectors' non-zero entries; only coefficients and their gradients, one row a feature, come together."""
    lr = model.stages[-1]
    reg, coefs = lr.getOrDefault(lr.regParam), lr.coefficients.toArray().tolist()
    rows = model.transform(train)
    residual = F.col(lr.getWeightCol()) * (vector_to_array(lr.getProbabilityCol())[1] - F.col(LABEL))
    total = train.agg(F.sum(lr.getWeightCol())).first()[0]
    entries = rows.select(residual.alias("r"), vector_to_array("features").alias("x")).select("r", F.posexplode(F.concat("x", F.array(F.lit(1.0)))).alias("at", "value"))
    sums = entries.where("value <> 0").groupBy("at").agg((F.sum(F.col("r") * F.col("value")) / F.lit(total)).alias("g"))
    spark = train.sparkSession
    state = spark.createDataFrame([(i, float(c), float(c) * reg) for i, c in enumerate(coefs)] + [(len(coefs), float(lr.intercept), 0.0)], "at int, coefficient double, penalty double")
    return state.join(sums, "at", "left").select(F.when(F.col("at") == len(coefs), -1).otherwise(F.col("at")).alias("position"), "coefficient",
                                                 (F.coalesce("g", F.lit(0.0)) + F.col("penalty")).alias("gradient"))


def same_predictions(a: PipelineModel, b: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows of ``df``, and on how many two fitted pipelines give equal labels and bitwise equal probabilities; one pass, no join."""
    first = a.transform(df).select(*[F.col(f"`{c}`") for c in df.columns], F.col("prediction").alias("_label_a"), vector_to_array("probability").alias("_probability_a"))
    both = b.transform(first)
    return both.agg(F.count("*").alias("num_rows"), F.count_if(F.col("prediction") == F.col("_label_a")).alias("num_equal_labels"),
                    F.count_if(vector_to_array("probability") == F.col("_probability_a")).alias("num_equal_probabilities"))


def predict(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Predicted label and class-1 probability next to the given columns."""
    out = model.transform(df)
    return out.select(*keep, F.col("prediction").cast("int").alias("y_pred"),
                      vector_to_array("probability")[1].alias("probability"))


def coefficients(model: PipelineModel, categoricals: Sequence[str], numerics: Sequence[str]) -> list[tuple[str, float]]:
    """Encoder feature names paired with logistic-regression coefficients (model state,
    one entry per feature column)."""
    indexer = model.stages[0]
    names = []
    for c, labels in zip(categoricals, indexer.labelsArray):
        names += [f"{c}_{v}" for v in labels]
    names += list(numerics)
    coefs = model.stages[-1].coefficients.toArray().tolist()
    return list(zip(names, coefs, strict=True))


# ---- cross-validation ------------------------------------------------------------------------------

def binary_scores(pred: DataFrame, y_true: str = LABEL, y_pred: str = "y_pred") -> dict:
    """Precision, recall, f1 of class 1 and the row count, from one aggregation (0/0 → 0)."""
    t, p = F.col(y_true), F.col(y_pred)
    r = pred.agg(F.sum(F.when((t == 1) & (p == 1), 1).otherwise(0)).alias("tp"),
                 F.sum(F.when((t == 0) & (p == 1), 1).otherwise(0)).alias("fp"),
                 F.sum(F.when((t == 1) & (p == 0), 1).otherwise(0)).alias("fn"),
                 F.count(F.lit(1)).alias("n")).first()
    tp, fp, fn = r["tp"] or 0, r["fp"] or 0, r["fn"] or 0
    prec = tp / (tp + fp) if tp + fp else 0.0
    rec = tp / (tp + fn) if tp + fn else 0.0
    f1 = 2 * prec * rec / (prec + rec) if prec + rec else 0.0
    return {"precision": prec, "recall": rec, "f1": f1, "n": r["n"]}


def cross_validate(folds: DataFrame, classifiers: dict, categoricals: Sequence[str], numerics: Sequence[str],
                   seed: int = 42, parallelism: int = 4) -> list[dict]:
    """Per fold, fit on the fold's train rows, score train and validation rows.

    ``classifiers`` maps a name to a callable(n_train) → estimator, or to the strings
    ``"guess"`` / ``"always_infrac"`` for the two baselines.  A fold's rows are written once, its preprocessing
    is fitted once and its vectors are kept for all classifiers of the fold.  Confusion counts of both roles come
    from one grouped aggregate, and one a forest, which reads codes instead of vectors.  Folds are independent; like
    ``CrossValidator(parallelism=…)`` they are submitted from a small thread pool: the fits of many short passes
    first, then the forests, whose long tasks these would wait for.
    """
    from concurrent.futures import ThreadPoolExecutor

    from .mlprep import baseline_predictions
    fold_ids = sorted(r[0] for r in folds.select("fold").distinct().collect())
    cores = folds.sparkSession.sparkContext.defaultParallelism

    def confusion(scored, pred):
        aggs = [F.count(F.lit(1)).alias("n")]
        for n, p in pred.items():
            for cell, y, q in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0)):
                aggs.append(F.count(F.when((F.col(LABEL) == y) & (p == q), 1)).alias(f"{cell}_{n}"))
        return {r["role"]: r.asDict() for r in scored.groupBy("role").agg(*aggs).collect()}

    def run(k):
        rows = folds.where(F.col("fold") == k)
        fitted = {n: m for n, m in classifiers.items() if m not in ("guess", "always_infrac")}
        pred = {n: F.col("y_guess" if m == "guess" else "y_always_infrac").cast("int") for n, m in classifiers.items() if n not in fitted}
        if not fitted:
            return confusion(baseline_predictions(rows, seed), pred), None
        rows = cut_lineage(rows, "fold_rows")       # every pass over the folds expands all rows again
        train = class_weights(rows.where(F.col("role") == "train"))
        prep = Pipeline(stages=preprocessing(categoricals, numerics)).fit(train)
        vectors = prep.transform(train).select("features", LABEL, "weight").repartition(cores).cache()
        made = {name: make(vectors.count()) for name, make in fitted.items()}
        forests = {name: m for name, m in made.items() if isinstance(m, BaggedForest)}
        scored = prep.transform(baseline_predictions(rows, seed)).select("role", LABEL, "features", "y_guess", "y_always_infrac")
        for name, classifier in made.items():
            if name not in forests:
                model = classifier.fit(vectors)
                scored = (model.setPredictionCol(f"p_{name}").setProbabilityCol("").setRawPredictionCol("").transform(scored))
                pred[name] = F.col(f"p_{name}").cast("int")
        vectors.unpersist()
        return confusion(scored, pred), (rows, train, prep, forests)

    def grown(part):
        got, (rows, train, prep, forests) = part
        both = train.unionByName(rows.where(F.col("role") == "val"), allowMissingColumns=True)
        coded = prep.transform(both).select("role", LABEL, "weight", *prep.stages[0].getOutputCols(), *[f"{c}_yj" for c in numerics])
        for name, forest in forests.items():
            share = forest.score(prep, coded, LABEL, "weight", F.col("role") == "train", f"p_{name}")
            for role, counts in confusion(share, {name: (F.col(f"p_{name}") > 0.5).cast("int")}).items():
                got[role].update(counts)
        drop_stage(rows)
        return got

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        parts = list(pool.map(run, fold_ids))
        counts = list(pool.map(lambda part: grown(part) if part[1] else part[0], parts))
    per_fold = [[_record(n, k, got.get("train"), got.get("val")) for n in classifiers] for k, got in zip(fold_ids, counts)]
    names = list(classifiers)
    return [per_fold[i][names.index(n)] for n in names for i in range(len(fold_ids))]


def _record(name: str, fold, train, val) -> dict:
    """Scores of class 1 from the two roles' confusion counts (0/0 → 0)."""
    out = {"classifier": name, "split_index": int(fold), "len_train": train["n"] if train else 0, "len_val": val["n"] if val else 0}
    scores = {}
    for role, r in (("train", train), ("test", val)):
        tp, fp, fn = (r[f"{c}_{name}"] if r else 0 for c in ("tp", "fp", "fn"))
        prec, rec = tp / (tp + fp) if tp + fp else 0.0, tp / (tp + fn) if tp + fn else 0.0
        scores[role] = {"recall": rec, "precision": prec, "f1": 2 * prec * rec / (prec + rec) if prec + rec else 0.0}
    return out | {f"{m}_{role}": scores[role][m] for m in ("recall", "precision", "f1") for role in ("train", "test")}


def as_categorical_strings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Categorical inputs as text (the indexer takes strings; booleans / counts become labels)."""
    return df.withColumns({c: F.col(f"`{c}`").cast("string") for c in columns})


def save_model(model: PipelineModel, path: str) -> None:
    """Persist a fitted pipeline, every stage of it in Spark's own format."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Inverse of ``save_model``."""
    return PipelineModel.load(path)
