"""Stage 8 data preparation: model table, time split, operating filter, folds, class weights.

Global scalars (latest date, class counts) are scalar subqueries of one-row aggregates: they
are computed once per query and inlined, so no cross join and no driver collect is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import EST
from ..functions.text import hash_text

# --- fixed values: the model's feature list (29 features) and the label ---
MODEL_FEATURES = [
    "AREA_NAME", "Shape__Area", "neigh_shape_length", "time_since_last_infrac", "last_pass", "last_cond_pass",
    "num_minor_prev", "num_significant_prev", "num_crucial_prev", "cumulative_failures", "cumulative_minor",
    "cumulative_significant", "cumulative_crucial", "ever_failed", "ever_minor", "ever_significant",
    "ever_crucial", "cumulative_inspections", "days_since_last_inspection", "last_inspection_month",
    "last_inspection_weekday", "last_inspection_weekofyear", "last_inspection_quarter", "last_inspection_year",
    "inspection_month", "inspection_weekday", "inspection_weekofyear", "inspection_quarter", "inspection_year",
]
LABEL = "is_infraction"
ROW_KEY = EST + ["inspection_id", "inspection_date"]

# Numeric features kept numeric (power transform); the other counts are one-hot encoded.
NUMERIC_FEATURES = ["time_since_last_infrac", "days_since_last_inspection"]
# In the model table but no input of a model.
UNUSED_FEATURES = ["Shape__Area", "neigh_shape_length"]
# Counts of which almost every value is 0: as booleans where ``use_flags`` is set.
FLAG_FEATURES = ["num_minor_prev", "num_significant_prev", "num_crucial_prev", "cumulative_failures", "cumulative_minor",
                 "cumulative_significant", "cumulative_crucial", "cumulative_inspections"]
TEST_DAYS = 60
FOLD_TRAIN_START = "2017-01-01"
FOLD_STARTS = ["2018-07-01", "2018-10-01", "2019-01-01", "2019-04-01", "2019-07-01"]
OPERATING_CUTOFF = "2017-11-01"


def ml_features(df_full: DataFrame, features: Sequence[str] = MODEL_FEATURES, label: str = LABEL) -> DataFrame:
    """M1 + F12 + F13: row key, features and label; rows without an area dropped, every other
    NULL filled with 0 (booleans with false)."""
    out = df_full.select(*ROW_KEY, *features, label).na.drop(subset=["AREA_NAME"])
    types = dict(out.dtypes)
    fill = {}
    for c in list(features) + [label]:
        if types[c] == "boolean":
            fill[c] = F.coalesce(F.col(f"`{c}`"), F.lit(False))
        elif types[c] in ("int", "bigint", "double", "float", "smallint", "tinyint") or types[c].startswith("decimal"):
            fill[c] = F.coalesce(F.col(f"`{c}`"), F.lit(0).cast(types[c]))
    return out.withColumns(fill)


def _max_date(df: DataFrame, date_col: str) -> Column:
    return df.agg(F.max(date_col)).scalar()


def time_split(df: DataFrame, test_days: int = TEST_DAYS, date_col: str = "inspection_date") -> DataFrame:
    """M2: ``split`` = test for the last ``test_days`` days (date ≥ max − 60), train for
    date ≤ max − 61.  The max is a scalar subquery."""
    mx = _max_date(df, date_col)
    role = (F.when(F.col(date_col) >= F.date_sub(mx, test_days), F.lit("test"))
            .when(F.col(date_col) <= F.date_sub(mx, test_days + 1), F.lit("train")))
    return df.withColumn("split", role)


def time_split_report(split: DataFrame, date_col: str = "inspection_date") -> DataFrame:
    """M2 report: rows per split, latest train date and earliest test date."""
    return split.agg(
        F.count(F.when(F.col("split") == "train", 1)).cast("bigint").alias("num_train"),
        F.count(F.when(F.col("split") == "test", 1)).cast("bigint").alias("num_test"),
        F.max(F.when(F.col("split") == "train", F.col(date_col))).alias("max_train_date"),
        F.min(F.when(F.col("split") == "test", F.col(date_col))).alias("min_test_date"))


def recently_inspected(train: DataFrame, cutoff: str = OPERATING_CUTOFF, date_col: str = "inspection_date") -> DataFrame:
    """Establishments whose latest training inspection is on or after ``cutoff``."""
    return (train.groupBy(*EST).agg(F.max(date_col).alias(date_col))
            .where(F.col(date_col) >= F.lit(cutoff).cast("date")))


def operating_test_rows(test: DataFrame, train: DataFrame, cutoff: str = OPERATING_CUTOFF,
                        operating_only: bool = False) -> DataFrame:
    """The source left-joins the recent establishments, which keeps every test row
    (default).  ``operating_only`` applies the intended semi-join."""
    if not operating_only:
        return test
    return test.join(recently_inspected(train, cutoff).select(*EST), EST, "left_semi")


def cv_folds(train: DataFrame, starts: Sequence[str] = FOLD_STARTS, train_start: str = FOLD_TRAIN_START,
             val_days: int = TEST_DAYS, date_col: str = "inspection_date") -> DataFrame:
    """M4: forward-chaining folds — val = [start, start + 60 d], train = [train_start, start − 1 d].

    The fold table is a literal array of a few structs exploded per row (a bounded range join,
    no join operator); a row appears once per fold that uses it, tagged ``fold`` and ``role``.
    """
    folds = F.array(*[F.struct(F.lit(i).alias("fold"), F.lit(s).cast("date").alias("start"))
                      for i, s in enumerate(starts)])
    d = F.col(date_col)
    x = train.withColumn("_f", F.explode(folds))
    start = F.col("_f.start")
    role = (F.when(d.between(start, F.date_add(start, val_days)), F.lit("val"))
            .when(d.between(F.lit(train_start).cast("date"), F.date_sub(start, 1)), F.lit("train")))
    return (x.withColumn("fold", F.col("_f.fold")).withColumn("role", role).drop("_f")
            .where(F.col("role").isNotNull()))


def class_weights(df: DataFrame, label: str = LABEL, weight_col: str = "weight") -> DataFrame:
    """Balanced weights n / (k · n_c) for a binary label (scalar-subquery counts)."""
    stats = df.agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.col(label)).alias("n1"))).scalar()
    n, n1 = stats["n"], stats["n1"]
    w1 = F.try_divide(n.cast("double"), F.lit(2.0) * n1)
    w0 = F.try_divide(n.cast("double"), F.lit(2.0) * (n - n1))
    return df.withColumn(weight_col, F.when(F.col(label) == 1, w1).otherwise(w0))


def gt_zero_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``<count>_gt_zero`` booleans."""
    return df.withColumns({f"{c}_gt_zero": F.col(c) > 0 for c in columns})


def baseline_predictions(df: DataFrame, seed: int = 42, key: Sequence[str] = ROW_KEY) -> DataFrame:
    """Uniform random guess (seeded hash of the row key, p = 0.5) and constant 1."""
    guess = F.when(hash_text(seed, key) >= "8", 1).otherwise(0)
    return df.withColumns({"y_guess": guess, "y_always_infrac": F.lit(1)})


def inspection_priority(pred: DataFrame, threshold: float = 0.5, step: float = 0.1,
                        date_col: str = "inspection_date", prob_col: str = "probability") -> DataFrame:
    """Schedule by predicted likelihood — at or above ``threshold`` inspect on the planned
    day; each ``step`` below it delays the visit by one more day."""
    delay = F.greatest(F.ceil(F.try_divide(F.lit(threshold) - F.col(prob_col), F.lit(step))), F.lit(0)).cast("int")
    return pred.withColumns({"priority_delay_days": delay,
                             "planned_date": F.date_add(F.col(date_col), delay)})
