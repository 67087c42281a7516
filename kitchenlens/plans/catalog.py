"""Registered queries: name → callable(spark, sf_dir) → DataFrame.

Each entry runs one operator (or one chain) over the whole fixture tables.  The matching
DuckDB text for the correctness check lives in ``oracles.py`` under the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import fixtures as fx
from ..operators import inspections as insp
from ..sources import snapshots as snap
from .report import as_report

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            _HANDED_OVER.clear()        # every query makes its own stage tables
            return as_report(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


# ---------------------------------------------------------------------------------------------
# shared inputs
# ---------------------------------------------------------------------------------------------

def infractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snap.normalise_infractions(fx.infractions(spark, sf_dir), rename={"amount_fined_raw": "amount_fined"})


# What the steps of one query hand over to each other, by name and input folder.
_HANDED_OVER: dict = {}


def handed_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed infractions, written once a query, as the source hands its stage 1 over: the pivot's values, the hot
    establishments, the aggregates and the coordinates read the columns they need of it, and the three raw tables are joined once."""
    from ..session import cut_lineage, is_written
    key = ("infractions", spark.sparkContext.applicationId, sf_dir)
    if key not in _HANDED_OVER or not is_written(_HANDED_OVER[key]):
        _HANDED_OVER[key] = cut_lineage(infractions(spark, sf_dir), "infractions")
    return _HANDED_OVER[key]


# Infraction rows for each task of an exchange whose tasks sort what they get: their memory doesn't grow with the table.
ROWS_PER_TASK = 500_000


def task_count(spark: SparkSession, sf_dir: str, rows_per_task: int = ROWS_PER_TASK) -> int | None:
    """Partitions of the exchanges of infractions and inspections; None (AQE's choice) while the session's cores are enough."""
    rows = handed_over(spark, sf_dir)
    key = ("rows", rows.stage_path)
    if key not in _HANDED_OVER:
        _HANDED_OVER[key] = rows.count()
    needed = -(-_HANDED_OVER[key] // rows_per_task)
    return needed if needed > spark.sparkContext.defaultParallelism else None


def aggregate(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return insp.inspections_aggregate(handed_over(spark, sf_dir), num_partitions=task_count(spark, sf_dir), **kw)


# An establishment with more infraction rows than this has its ordered scans split into parallel
# chunks (operators/ordered.py), so one dominant establishment never becomes one task.  Which
# ones there are is counted on the key columns alone; where there are none the plain window is
# planned and its input is read once.
HOT_GROUP_ROWS = 2_000_000


def split_args(spark: SparkSession, sf_dir: str, hot_group_rows: int = HOT_GROUP_ROWS) -> dict:
    """Arguments of the ordered scans: those of the split path where an establishment is hot, else none."""
    from ..operators.ordered import hot_keys
    rows = handed_over(spark, sf_dir)
    key = ("hot", rows.stage_path, hot_group_rows)
    if key not in _HANDED_OVER:
        hot = hot_keys(rows.select(*insp.EST), insp.EST, hot_group_rows)
        _HANDED_OVER[key] = {} if hot is None else {"hot_group_rows": hot_group_rows, "hot": hot}
    return dict(_HANDED_OVER[key])


def labelled(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    if "hot_group_rows" not in kw:
        kw |= split_args(spark, sf_dir)
    return insp.labelled_inspections(handed_over(spark, sf_dir), num_partitions=task_count(spark, sf_dir), **kw)


# ---------------------------------------------------------------------------------------------
# stage 2: infractions → inspections
# ---------------------------------------------------------------------------------------------

@query("normalise_infractions")
def q_normalise(spark, sf_dir):
    """Typed infraction rows, money text parsed."""
    return infractions(spark, sf_dir)


@query("valid_infractions")
def q_valid(spark, sf_dir):
    return insp.valid_infractions(infractions(spark, sf_dir))


@query("valid_infractions_strict")
def q_valid_strict(spark, sf_dir):
    return insp.valid_infractions(infractions(spark, sf_dir), strict_types=True)


@query("infraction_groups")
def q_groups(spark, sf_dir):
    return insp.infraction_groups(insp.valid_infractions(infractions(spark, sf_dir)))


@query("infractions_summary")
def q_summary(spark, sf_dir):
    """Details text per inspection (sorted, null-skipping)."""
    return (infractions(spark, sf_dir).groupBy(*insp.EST, "inspection_id")
            .agg(insp.sorted_text_agg("infraction_details").alias("infractions_summary")))


@query("distinct_actions")
def q_distinct_actions(spark, sf_dir):
    return infractions(spark, sf_dir).select("action").distinct()


@query("distinct_outcomes")
def q_distinct_outcomes(spark, sf_dir):
    return infractions(spark, sf_dir).select("court_outcome").distinct()


@query("inspections_aggregate")
def q_aggregate(spark, sf_dir):
    return aggregate(spark, sf_dir)


@query("inspections_aggregate_rows")
def q_aggregate_rows(spark, sf_dir):
    return aggregate(spark, sf_dir, pivot_counts="rows")


@query("inspections_aggregate_strict")
def q_aggregate_strict(spark, sf_dir):
    return aggregate(spark, sf_dir, strict_types=True)


@query("multi_day_inspections")
def q_multi_day(spark, sf_dir):
    return insp.multi_day_inspections(aggregate(spark, sf_dir))


@query("single_day_inspections")
def q_single_day(spark, sf_dir):
    return insp.single_day_inspections(aggregate(spark, sf_dir))


def gap_input(spark, sf_dir, split):
    """Single-day inspections; partitioned by establishment for the plain window only."""
    one_day = insp.single_day_inspections(aggregate(spark, sf_dir))
    return one_day if split else insp.by_establishment(one_day, task_count(spark, sf_dir))


@query("days_to_next")
def q_days_to_next(spark, sf_dir):
    split = split_args(spark, sf_dir)
    return insp.with_days_to_next(gap_input(spark, sf_dir, split), **split)


@query("reinspections")
def q_reinspections(spark, sf_dir):
    split = split_args(spark, sf_dir)
    return insp.reinspections(gap_input(spark, sf_dir, split), **split)


@query("no_reinspections")
def q_no_reinspections(spark, sf_dir):
    split = split_args(spark, sf_dir)
    return insp.no_reinspections(gap_input(spark, sf_dir, split), **split)


@query("no_reinspections_strict")
def q_no_reinspections_strict(spark, sf_dir):
    split = split_args(spark, sf_dir)
    return insp.no_reinspections(gap_input(spark, sf_dir, split), strict=True, **split)


@query("inspection_label")
def q_label(spark, sf_dir):
    """Flagship: labelled inspections."""
    return labelled(spark, sf_dir)


@query("class_balance")
def q_class_balance(spark, sf_dir):
    return insp.class_balance(labelled(spark, sf_dir))


# ---------------------------------------------------------------------------------------------
# exploration and expectations
# ---------------------------------------------------------------------------------------------

from ..operators import explore as ex  # noqa: E402
from ..operators import quality as qa  # noqa: E402

PREVIEW_INSPECTION_ID = 1


@query("preview_rows")
def q_preview(spark, sf_dir):
    return ex.preview_rows(infractions(spark, sf_dir))


@query("filter_inspection")
def q_filter_inspection(spark, sf_dir):
    return ex.filter_inspection(infractions(spark, sf_dir), PREVIEW_INSPECTION_ID)


@query("missing_coords")
def q_missing_coords(spark, sf_dir):
    return ex.missing_coords(infractions(spark, sf_dir))


@query("na_severity_rows")
def q_na_rows(spark, sf_dir):
    return ex.na_severity_rows(infractions(spark, sf_dir))


@query("na_severity_closed")
def q_na_closed(spark, sf_dir):
    return ex.na_severity_closed(infractions(spark, sf_dir))


@query("establishments_per_inspection")
def q_a1(spark, sf_dir):
    return ex.establishments_per_inspection(infractions(spark, sf_dir))


@query("inspections_per_establishment")
def q_a2(spark, sf_dir):
    return ex.inspections_per_establishment(infractions(spark, sf_dir))


@query("infractions_per_inspection")
def q_a3(spark, sf_dir):
    return ex.infractions_per_inspection(infractions(spark, sf_dir))


@query("missing_address_count")
def q_a4(spark, sf_dir):
    return ex.missing_address_count(infractions(spark, sf_dir))


@query("addresses_missing_coords")
def q_a5(spark, sf_dir):
    return ex.addresses_missing_coords(infractions(spark, sf_dir))


@query("coord_null_consistency")
def q_a6(spark, sf_dir):
    return ex.coord_null_consistency(infractions(spark, sf_dir))


@query("severity_counts")
def q_a7a(spark, sf_dir):
    return ex.severity_counts(infractions(spark, sf_dir))


@query("na_status_counts")
def q_a7b(spark, sf_dir):
    return ex.na_status_counts(infractions(spark, sf_dir))


@query("severity_status_counts")
def q_a7c(spark, sf_dir):
    return ex.severity_status_counts(infractions(spark, sf_dir))


@query("type_summary")
def q_a8(spark, sf_dir):
    return ex.type_summary(infractions(spark, sf_dir))


def single_day(spark, sf_dir):
    return insp.single_day_inspections(aggregate(spark, sf_dir))


@query("est_recount")
def q_a13(spark, sf_dir):
    return ex.est_recount(single_day(spark, sf_dir))


@query("status_per_inspection")
def q_a14(spark, sf_dir):
    return ex.status_per_inspection(labelled(spark, sf_dir))


@query("null_counts")
def q_a23(spark, sf_dir):
    return ex.null_counts(infractions(spark, sf_dir))


@query("profile_table")
def q_a24(spark, sf_dir):
    return ex.profile_table(labelled(spark, sf_dir))


@query("head_tail")
def q_l4(spark, sf_dir):
    return ex.head_tail(labelled(spark, sf_dir), ["establishment_id", "inspection_id", "inspection_date"])


@query("histogram_bins")
def q_a25(spark, sf_dir):
    return ex.histogram_bins(infractions(spark, sf_dir), "amount_fined")


@query("expect_no_na")
def q_k1(spark, sf_dir):
    return qa.expect_no_na(labelled(spark, sf_dir))


@query("expect_recount")
def q_k2(spark, sf_dir):
    return qa.expect_recount(ex.est_recount(single_day(spark, sf_dir)))


@query("expect_recount_total")
def q_k2b(spark, sf_dir):
    from ..session import cut_lineage
    one_day = cut_lineage(single_day(spark, sf_dir), "single_day")
    return qa.expect_recount_total(ex.est_recount(one_day), one_day)


@query("expect_single_status")
def q_k3(spark, sf_dir):
    return qa.expect_single_status(ex.status_per_inspection(labelled(spark, sf_dir)))


# ---------------------------------------------------------------------------------------------
# stage 3-4: coordinates, spatial join, neighbourhood facts
# ---------------------------------------------------------------------------------------------

from ..operators import features as ft  # noqa: E402
from ..operators import geo  # noqa: E402
from ..operators import neighbourhood as nb  # noqa: E402

AREA_KEEP = ["AREA_NAME", "Shape__Area"]
# the fixture's dates lie in the 1990s: the parameters are shifted to them here
CENSUS_SLICES = [(1995, 1996, None, 2006), (1997, 1999, "neigh_pop_2011", 2011), (2000, None, "neigh_pop_2016", 2016)]
CRIME_START_YEAR = 1998
FOLDS = {"starts": ["1999-07-01", "1999-10-01", "2000-01-01", "2000-04-01", "2000-07-01"], "train_start": "1997-01-01"}
OPERATING_CUTOFF = "2000-11-01"


def areas(spark, sf_dir):
    return geo.fix_area_names(fx.areas_raw(spark, sf_dir))


def filled(spark, sf_dir, columns=None):
    """Stage-3 output (of the given columns of the inspections), written once to the checkpoint folder and read back: the spatial join, the
    census join and everything after read it several times, and each read would otherwise
    re-aggregate the infractions (the source hands stages over as files too)."""
    from ..session import cut_lineage
    rows = labelled(spark, sf_dir)
    f = geo.fill_coordinates(rows.select(*columns) if columns else rows, handed_over(spark, sf_dir), fx.addressinfo(spark, sf_dir))
    return cut_lineage(f, "filled")


def located(spark, sf_dir, inspections=None):
    src = inspections if inspections is not None else filled(spark, sf_dir)
    return geo.point_in_polygon(geo.unique_locations(src), areas(spark, sf_dir), keep=AREA_KEEP)


def population(spark, sf_dir):
    return nb.profile_transpose(fx.profile_wide(spark, sf_dir))


def stats(spark, sf_dir, loc=None):
    loc = loc if loc is not None else located(spark, sf_dir)
    return nb.neighbourhood_stats(areas(spark, sf_dir), loc, population(spark, sf_dir))


def with_population(spark, sf_dir, f=None):
    from ..session import cut_lineage
    f = filled(spark, sf_dir) if f is None else f
    loc = cut_lineage(located(spark, sf_dir, f), "located")     # read for the statistics and for the locations
    full = nb.locations_with_stats(loc, stats(spark, sf_dir, loc), num_areas=areas(spark, sf_dir).count())
    return nb.population_as_of(f, full, CENSUS_SLICES)


def with_crime(spark, sf_dir, f=None):
    from ..session import cut_lineage
    # written, so that its size is known to the join: a row for each area and day
    pivot = cut_lineage(nb.crime_daily_pivot(fx.crimes(spark, sf_dir)), "crime_days")
    return nb.crime_fill_by_year(nb.crime_join(with_population(spark, sf_dir, f), pivot), CRIME_START_YEAR)


@query("coords_per_establishment")
def q_a16(spark, sf_dir):
    return geo.coords_per_establishment(infractions(spark, sf_dir))


@query("title_address")
def q_x1(spark, sf_dir):
    return geo.title_address(ex.addresses_missing_coords(infractions(spark, sf_dir)))


@query("addresses_to_geocode")
def q_j3(spark, sf_dir):
    missing = geo.addresses_needing_geocode(labelled(spark, sf_dir), handed_over(spark, sf_dir))
    return geo.addresses_to_geocode(missing, fx.addressinfo(spark, sf_dir))


@query("incomplete_addresses")
def q_f17(spark, sf_dir):
    return geo.incomplete_addresses(fx.addressinfo(spark, sf_dir))


@query("retry_addresses")
def q_f18(spark, sf_dir):
    return geo.retry_addresses(fx.addressinfo(spark, sf_dir))


@query("fill_coordinates")
def q_j2(spark, sf_dir):
    return filled(spark, sf_dir)


@query("point_in_polygon")
def q_j4(spark, sf_dir):
    return located(spark, sf_dir)


@query("fix_area_names")
def q_s16(spark, sf_dir):
    return areas(spark, sf_dir).drop("geometry")


@query("area_name_match")
def q_f19(spark, sf_dir):
    return geo.area_name_match(areas(spark, sf_dir)).drop("geometry")


@query("establishments_per_area")
def q_a19(spark, sf_dir):
    return nb.establishments_per_area(located(spark, sf_dir))


@query("profile_transpose")
def q_a20(spark, sf_dir):
    return population(spark, sf_dir)


@query("neighbourhood_stats")
def q_j5(spark, sf_dir):
    return stats(spark, sf_dir)


@query("population_as_of")
def q_j7(spark, sf_dir):
    return with_population(spark, sf_dir)


@query("crime_filter")
def q_f10(spark, sf_dir):
    return nb.crime_filter(fx.crimes(spark, sf_dir))


@query("crime_daily")
def q_a17(spark, sf_dir):
    return nb.crime_daily(fx.crimes(spark, sf_dir))


@query("crime_daily_pivot")
def q_a18(spark, sf_dir):
    return nb.crime_daily_pivot(fx.crimes(spark, sf_dir))


@query("crime_daily_pivot_sum")
def q_a18s(spark, sf_dir):
    return nb.crime_daily_pivot(fx.crimes(spark, sf_dir), mode="sum")


@query("crime_join")
def q_j8(spark, sf_dir):
    return nb.crime_join(with_population(spark, sf_dir), nb.crime_daily_pivot(fx.crimes(spark, sf_dir)))


@query("crime_fill_by_year")
def q_f11(spark, sf_dir):
    return with_crime(spark, sf_dir)


@query("spot_check_sample")
def q_l3(spark, sf_dir):
    return nb.spot_check_sample(located(spark, sf_dir), insp.EST)


# ---------------------------------------------------------------------------------------------
# stage 7: history features
# ---------------------------------------------------------------------------------------------

FEATURE_KEYS = insp.EST + ["inspection_id", "inspection_date"]


def with_history(spark, sf_dir, df, **kw):
    """History features of labelled inspections; the pivot columns are those the data gave."""
    split = {k: kw[k] for k in ("hot_group_rows", "chunk_rows") if k in kw} or split_args(spark, sf_dir)
    return ft.history_features(df, insp.pivoted(df, "action"), insp.pivoted(df, "court_outcome"),
                               exclude_current=kw.get("exclude_current", False), **split)


def featured(spark, sf_dir, **kw):
    return with_history(spark, sf_dir, labelled(spark, sf_dir), **kw)


def _feature_query(name: str, cols, **kw):
    def fn(spark, sf_dir):
        f = featured(spark, sf_dir, **kw)
        return f.select(*FEATURE_KEYS, *cols(insp.pivoted(f, "action"), insp.pivoted(f, "court_outcome")))
    fn.__doc__ = f"Features subset {name}."
    query(name)(fn)


_PREV = lambda a, o: list(ft.pivot_prev_names(a, o).values())
_feature_query("history_features", ft.feature_columns)
_feature_query("feat_gap", lambda a, o: ["time_since_last_infrac", "days_since_last_inspection"])
_feature_query("feat_last_status", lambda a, o: ["last_pass", "last_cond_pass"])
_feature_query("feat_prev_counts", lambda a, o: [f"num_{t}_prev" for t in ft.INFRACTION_TYPES] + _PREV(a, o))
_feature_query("feat_cumulative", lambda a, o: ["cumulative_failures"] + [f"cumulative_{t}" for t in ft.INFRACTION_TYPES])
_feature_query("feat_cumulative_prev", lambda a, o: [f"cumulative_{p}" for p in _PREV(a, o)])
_feature_query("feat_ever", lambda a, o: ["ever_failed"] + [f"ever_{t}" for t in ft.INFRACTION_TYPES])
_feature_query("feat_inspection_index", lambda a, o: ["cumulative_inspections"])
_feature_query("feat_proportions", lambda a, o: ["proportion_past_failures"]
               + [f"proportion_past_{t}" for t in ft.INFRACTION_TYPES])
_feature_query("feat_dates", lambda a, o: [c for c in ft.feature_columns(a, o) if c.startswith(("last_inspection_", "inspection_"))])
_feature_query("feat_cumulative_exclusive", lambda a, o: ["cumulative_failures"] + [f"cumulative_{t}" for t in ft.INFRACTION_TYPES]
               + ["ever_failed"] + [f"ever_{t}" for t in ft.INFRACTION_TYPES], exclude_current=True)


# ---------------------------------------------------------------------------------------------
# stage 8: model table, split, folds, evaluation, models
# ---------------------------------------------------------------------------------------------

from ..operators import evaluation as ev  # noqa: E402
from ..operators import mlprep as mp  # noqa: E402
from ..operators import models as md  # noqa: E402

COUNT_FEATURES = ["num_minor_prev", "num_significant_prev", "num_crucial_prev", "cumulative_failures",
                  "cumulative_minor", "cumulative_significant", "cumulative_crucial", "cumulative_inspections"]


# What the model table and its context take of an inspection: its texts and pivoted counts are no features.
MODEL_INPUT_COLUMNS = [*insp.OUTER_KEYS, *[f"num_{t}" for t in ft.INFRACTION_TYPES], "is_infraction"]


def full_table(spark, sf_dir):
    rows, n = with_crime(spark, sf_dir, filled(spark, sf_dir, MODEL_INPUT_COLUMNS)), task_count(spark, sf_dir)
    return with_history(spark, sf_dir, insp.by_establishment(rows, n) if n and not split_args(spark, sf_dir) else rows)


def ml_table(spark, sf_dir):
    """Model table, written once: the split's latest date, the class counts and every model fit
    read it."""
    from ..session import cut_lineage
    return cut_lineage(mp.ml_features(full_table(spark, sf_dir)), "model_table")


def split_table(spark, sf_dir):
    return mp.time_split(ml_table(spark, sf_dir))


def train_rows(spark, sf_dir):
    return split_table(spark, sf_dir).where("split = 'train'")


def test_rows(spark, sf_dir):
    return split_table(spark, sf_dir).where("split = 'test'")


def fixture_predictions(spark, sf_dir, t=None):
    """Predictions derived from the model table (for checking the metric algebra exactly)."""
    from pyspark.sql import functions as F
    t = ml_table(spark, sf_dir) if t is None else t
    y = F.col("is_infraction")
    return t.select(*mp.ROW_KEY, "AREA_NAME", "inspection_weekday", y.alias("y_true"),
                    F.when(F.col("inspection_id") % 5 == 0, 1 - y).otherwise(y).alias("y_pred"),
                    ((F.col("inspection_id") % 1000) / F.lit(1000.0)).alias("probability"),
                    F.lit(1).alias("y_always_infrac"))


@query("ml_features")
def q_m1(spark, sf_dir):
    return ml_table(spark, sf_dir)


@query("ml_null_policy")
def q_f12(spark, sf_dir):
    return ex.null_counts(ml_table(spark, sf_dir))


@query("time_split")
def q_m2(spark, sf_dir):
    return split_table(spark, sf_dir)


@query("time_split_report")
def q_m2r(spark, sf_dir):
    return mp.time_split_report(split_table(spark, sf_dir))


@query("recently_inspected")
def q_a21(spark, sf_dir):
    return mp.recently_inspected(train_rows(spark, sf_dir), OPERATING_CUTOFF)


@query("operating_test_rows")
def q_m3(spark, sf_dir):
    split = split_table(spark, sf_dir)
    return mp.operating_test_rows(split.where("split = 'test'"), split.where("split = 'train'"), OPERATING_CUTOFF)


@query("operating_test_rows_strict")
def q_m3s(spark, sf_dir):
    split = split_table(spark, sf_dir)
    return mp.operating_test_rows(split.where("split = 'test'"), split.where("split = 'train'"), OPERATING_CUTOFF, operating_only=True)


@query("cv_folds")
def q_m4(spark, sf_dir):
    return mp.cv_folds(train_rows(spark, sf_dir), **FOLDS)


@query("class_weights")
def q_m12(spark, sf_dir):
    return mp.class_weights(train_rows(spark, sf_dir))


@query("gt_zero_flags")
def q_f15(spark, sf_dir):
    return mp.gt_zero_flags(train_rows(spark, sf_dir), COUNT_FEATURES)


@query("top5_values")
def q_a22(spark, sf_dir):
    return ex.top_values(train_rows(spark, sf_dir), COUNT_FEATURES, 5)


@query("standardise")
def q_m7(spark, sf_dir):
    return md.standardise(train_rows(spark, sf_dir), mp.NUMERIC_FEATURES)


@query("baseline_constant")
def q_m13c(spark, sf_dir):
    return mp.baseline_predictions(test_rows(spark, sf_dir)).drop("y_guess")


@query("baseline_guess")
def q_m13g(spark, sf_dir):
    return mp.baseline_predictions(test_rows(spark, sf_dir))


@query("confusion_matrix")
def q_e1(spark, sf_dir):
    return ev.confusion_matrix(fixture_predictions(spark, sf_dir), ["y_pred", "y_always_infrac"])


@query("classification_report")
def q_e2(spark, sf_dir):
    return ev.classification_report(ev.confusion_matrix(fixture_predictions(spark, sf_dir),
                                                        ["y_pred", "y_always_infrac"]))


@query("metrics_long")
def q_e3(spark, sf_dir):
    rep = ev.classification_report(ev.confusion_matrix(fixture_predictions(spark, sf_dir),
                                                       ["y_pred", "y_always_infrac"]))
    return ev.metrics_long(rep, "test")


@query("metrics_table")
def q_e3t(spark, sf_dir):
    """E3 in the source's layout: model on both splits, baselines on the test split."""
    from pyspark.sql import functions as F
    t = split_table(spark, sf_dir)
    y = F.col("is_infraction")
    pred = t.select("split", y.alias("y_true"), F.when(F.col("inspection_id") % 5 == 0, 1 - y).otherwise(y).alias("ML"),
                    F.lit(1).alias("always_infrac"), (F.col("inspection_id") % 2).cast("int").alias("guess"))
    return ev.metrics_table(pred, "ML", ["guess", "always_infrac"])


@query("weekday_error_share")
def q_e5(spark, sf_dir):
    return ev.weekday_error_share(fixture_predictions(spark, sf_dir))


@query("area_error_share")
def q_e6(spark, sf_dir):
    return ev.area_error_share(fixture_predictions(spark, sf_dir))


@query("area_error_top15")
def q_e6t(spark, sf_dir):
    return ev.area_error_top(ev.area_error_share(fixture_predictions(spark, sf_dir)), 15)


@query("inspection_priority")
def q_m17(spark, sf_dir):
    return mp.inspection_priority(fixture_predictions(spark, sf_dir))


@query("error_context")
def q_j10(spark, sf_dir):
    """Predictions ⟕ context columns of the full table on the row key."""
    from ..session import cut_lineage
    full = cut_lineage(full_table(spark, sf_dir), "full_table")
    ctx = full.select(*mp.ROW_KEY, "latitude", "longitude", "neigh_pop")
    return fixture_predictions(spark, sf_dir, mp.ml_features(full)).join(ctx, mp.ROW_KEY, "left")


# ---- models (rows-only checks: fitted parameters are not SQL) ------------------------------------

CATEGORICALS = md.categorical_features()
NUMERICS = list(mp.NUMERIC_FEATURES)


def model_inputs(spark, sf_dir):
    """Model table with categoricals as text, written once: every fit iterates over it."""
    from ..session import cut_lineage     # forests checkpoint their node ids in the same folder
    return cut_lineage(md.as_categorical_strings(split_table(spark, sf_dir), CATEGORICALS), "model_inputs")


_FIT_MEMO: dict = {}
INSPECTION_TABLES = ("lineitem", "orders", "customer", "nation", "events")


def _memo_key(spark, sf_dir, name):
    """Session, versions of the tables a model is made from, and name; None (nothing is kept) where versions can't be told."""
    versions = fx.table_versions(sf_dir, INSPECTION_TABLES)
    return versions and (spark.sparkContext.applicationId, versions, name)


def _fit(spark, sf_dir, make, name=None):
    """Fit a pipeline on the training split; a named fit is kept per session and input folder so
    the queries reading the same model (predictions, coefficients) fit it once."""
    from pyspark.sql import functions as F
    key = _memo_key(spark, sf_dir, name)
    if name is not None and key in _FIT_MEMO:
        return _FIT_MEMO[key]
    data = model_inputs(spark, sf_dir)
    train = mp.class_weights(data.where(F.col("split") == "train"))
    model = md.fit_pipeline(train, make(train.count()), CATEGORICALS, NUMERICS)
    out = (model, train, data.where(F.col("split") == "test"))
    if name is not None and key:
        _FIT_MEMO[key] = out
    return out


def onehot_widths(spark, train, columns):
    from pyspark.ml.feature import StringIndexer
    idx = StringIndexer(inputCols=columns, outputCols=[f"{c}__i" for c in columns], handleInvalid="keep").fit(train)
    return spark.createDataFrame([(c, len(labels)) for c, labels in zip(columns, idx.labelsArray)], "feature string, width bigint")


@query("onehot_width")
def q_m5(spark, sf_dir):
    """M5: one-hot width per categorical (labels seen in training; unseen → all zeros)."""
    return onehot_widths(spark, model_inputs(spark, sf_dir).where("split = 'train'"), CATEGORICALS)


def flag_inputs(spark, sf_dir):
    """Model table with the sparse counts as booleans: the encoder's label lists don't grow with the counts."""
    from ..session import cut_lineage
    flags = md.categorical_features(use_flags=True)
    return cut_lineage(md.as_categorical_strings(md.with_model_flags(split_table(spark, sf_dir)), flags), "flag_inputs"), flags


@query("onehot_width_flags")
def q_m5f(spark, sf_dir):
    """M5 with F15's booleans for the sparse counts."""
    data, flags = flag_inputs(spark, sf_dir)
    return onehot_widths(spark, data.where("split = 'train'"), flags)


@query("lr_flags_optimality")
def q_m9f(spark, sf_dir):
    """M9 on F15's booleans: the regression is fitted, and the gradient of its objective is as good as zero there."""
    from pyspark.sql import functions as F
    data, flags = flag_inputs(spark, sf_dir)
    train = mp.class_weights(data.where("split = 'train'"))
    model = md.fit_pipeline(train, md.logistic_regression(train.count()), flags, NUMERICS)
    g = md.objective_gradient(model, train)
    norm = g.agg(F.sqrt(F.sum(F.col("gradient") ** 2))).first()[0]
    width = len(md.coefficients(model, flags, NUMERICS))
    return train.agg(F.count("*").alias("num_rows")).withColumns({"num_features": F.lit(width).cast("bigint"), "optimal": F.lit(norm < 1e-3)})


@query("yeo_johnson")
def q_m6(spark, sf_dir):
    """M6: fitted λ per numeric feature (maximum likelihood over the training rows)."""
    train = split_table(spark, sf_dir).where("split = 'train'").select(*NUMERICS)
    lams = md.fit_yeo_johnson(train, NUMERICS)
    return spark.createDataFrame([(c, float(v)) for c, v in lams.items()], "feature string, lambda double")


@query("lr_predict")
def q_m9(spark, sf_dir):
    model, train, test = _fit(spark, sf_dir, md.logistic_regression, "lr")
    return md.predict(model, test, mp.ROW_KEY + ["is_infraction"])


@query("rf_predict")
def q_m10(spark, sf_dir):
    return md.predict_by_forest(model_inputs(spark, sf_dir), md.BaggedForest(), CATEGORICALS, NUMERICS, mp.ROW_KEY + ["is_infraction"])


CV_METRICS = ["recall_train", "recall_test", "precision_train", "precision_test", "f1_train", "f1_test"]


_CV_MEMO: dict = {}


def cv_table(spark, sf_dir, classifiers=None):
    """Per-fold records of the four pipelines.  The records are a small local result, so the
    summary queries reuse one cross-validation run per session and input folder."""
    key = _memo_key(spark, sf_dir, "cv") if classifiers is None else None
    if key is None or key not in _CV_MEMO:
        folds = mp.cv_folds(model_inputs(spark, sf_dir).where("split = 'train'"), **FOLDS)
        classifiers = classifiers or {"guess": "guess", "always_infrac": "always_infrac",
                                      "lr": md.logistic_regression, "rf": lambda n: md.BaggedForest()}
        records = md.cross_validate(folds, classifiers, CATEGORICALS, NUMERICS)
        if key is None:
            return spark.createDataFrame(records)
        _CV_MEMO[key] = records
    return spark.createDataFrame(_CV_MEMO[key])


@query("cv_records")
def q_m14(spark, sf_dir):
    return cv_table(spark, sf_dir)


@query("cv_baseline_records")
def q_m14b(spark, sf_dir):
    """The constant baseline's fold records, which SQL can check: fold rows and confusion counts."""
    folds = mp.cv_folds(train_rows(spark, sf_dir), **FOLDS)
    return spark.createDataFrame(md.cross_validate(folds, {"always_infrac": "always_infrac"}, CATEGORICALS, NUMERICS))


@query("cv_summary")
def q_e4(spark, sf_dir):
    return ev.cv_summary(cv_table(spark, sf_dir), CV_METRICS)


@query("cv_best")
def q_l2(spark, sf_dir):
    return ev.cv_best(ev.cv_summary(cv_table(spark, sf_dir), CV_METRICS), "mean_f1_test")


@query("coef_extremes")
def q_e7(spark, sf_dir):
    """Ten largest and ten smallest logistic-regression coefficients with feature names."""
    from pyspark.sql import functions as F
    model, train, test = _fit(spark, sf_dir, md.logistic_regression, "lr")
    coefs = spark.createDataFrame(md.coefficients(model, CATEGORICALS, NUMERICS), "feature string, coefficient double")
    top = coefs.orderBy(F.col("coefficient").desc(), "feature").limit(10).withColumn("end", F.lit("largest"))
    low = coefs.orderBy(F.col("coefficient").asc(), "feature").limit(10).withColumn("end", F.lit("smallest"))
    return top.unionByName(low)


# ---------------------------------------------------------------------------------------------
# sources over the fixture tables: snapshots, union, de-duplication, numbering, file round trips
# ---------------------------------------------------------------------------------------------

from ..session import scratch_folder  # noqa: E402
from ..sources import files as fl  # noqa: E402


def snapshots(spark, sf_dir, infr=None):
    """Two overlapping snapshots of the infractions (years ≤ 1998 and ≥ 1998): the shared
    year appears in both, as rows repeated across published archives do."""
    from pyspark.sql import functions as F
    infr = infractions(spark, sf_dir) if infr is None else infr
    y = F.year("inspection_date")
    a = infr.where(y <= 1998).withColumn("filename", F.lit(1).cast("bigint"))
    b = infr.where(y >= 1998).withColumn("filename", F.lit(2).cast("bigint"))
    return a, b


@query("union_snapshots")
def q_s4(spark, sf_dir):
    return snap.union_snapshots(list(snapshots(spark, sf_dir)))


@query("dedup_full_row")
def q_s5(spark, sf_dir):
    """Q1 notebook form: provenance ignored, repeated rows across snapshots removed."""
    return snap.dedup_full_row(snap.union_snapshots(list(snapshots(spark, sf_dir))).drop("filename"))


@query("dedup_with_provenance")
def q_s5f(spark, sf_dir):
    """Q1 flow form: ``filename`` compared too, so rows repeated across snapshots survive."""
    return snap.dedup_full_row(snap.union_snapshots(list(snapshots(spark, sf_dir))))


@query("new_snapshots")
def q_s6(spark, sf_dir):
    """S6 batch form: rows of snapshot ids not loaded yet (snapshot 1 is loaded)."""
    a, b = snapshots(spark, sf_dir)
    return snap.new_snapshots(snap.union_snapshots([a, b]), a.select("filename"))


@query("incremental_append")
def q_s6b(spark, sf_dir):
    """S6 on a table: snapshot 1 is loaded, then both arrive; rows per loaded snapshot id."""
    from pyspark.sql import functions as F
    a, b = snapshots(spark, sf_dir)
    path = scratch_folder(spark, "snapshots")
    snap.incremental_append(spark, a, path)
    snap.incremental_append(spark, snap.union_snapshots([a, b]), path)
    return spark.read.parquet(path).groupBy("filename").agg(F.count(F.lit(1)).cast("bigint").alias("num_rows"))


@query("contiguous_parts_csv")
def q_s7b(spark, sf_dir):
    """The numbered parts written as one CSV folder each and read back; rows and key range per part."""
    from pyspark.sql import functions as F
    o = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    path = scratch_folder(spark, "parts")
    snap.write_parts_csv(snap.partition_numbering(o, ["o_orderkey"], 10), path)
    back = spark.read.schema("o_orderkey bigint, o_custkey bigint, part int").option("header", True).csv(path)
    return back.groupBy("part").agg(F.count(F.lit(1)).cast("bigint").alias("num_rows"), F.min("o_orderkey").alias("first_key"),
                                    F.max("o_orderkey").alias("last_key"))


@query("partition_numbering")
def q_s7(spark, sf_dir):
    """Orders in key order split into 10 contiguous near-equal parts."""
    o = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return snap.partition_numbering(o, ["o_orderkey"], 10)


@query("scan_xml_snapshot")
def q_s1(spark, sf_dir):
    """S1-S3 round trip: the infractions written as one XML snapshot per inspection year
    (folder = snapshot id), read back with a declared schema, provenance and normalisation."""
    from pyspark.sql import functions as F
    raw = fx.infractions(spark, sf_dir).withColumn("snap", F.year("inspection_date"))
    upper = raw.select(*[F.col(c).cast("string").alias(c.upper()) for c in raw.columns if c != "snap"], "snap")
    path = scratch_folder(spark, "xml_snapshots")
    snap.write_xml_snapshot(upper, path, partition_by=["snap"])
    df = snap.read_xml_snapshot(spark, f"{path}/snap=*",
                                schema=snap.raw_snapshot_schema(fields=[c for c in raw.columns if c != "snap"]))
    return snap.normalise_infractions(snap.with_snapshot_id(df, r"snap=(\d+)/"),
                                      rename={"amount_fined_raw": "amount_fined"})


@query("scan_csv_format")
def q_s8(spark, sf_dir):
    """S8 round trip: the typed infractions as bulk CSV files (header, quotes, \\N for NULL) read
    back FAILFAST with the declared schema."""
    from ..constants import INFRACTION_SCHEMA
    path = scratch_folder(spark, "bulk_csv")
    snap.write_bulk_csv(infractions(spark, sf_dir).select(*INFRACTION_SCHEMA.fieldNames()), path, null_value="\\N")
    return fl.read_bulk_csv(spark, path)


@query("explode_records")
def q_s15(spark, sf_dir):
    """The customers as paged catalog responses (JSON lines of 100 records), read back as rows."""
    from pyspark.sql import functions as F
    c = snap.partition_numbering(fx.table(spark, sf_dir, "customer").select("c_custkey", "c_name"), ["c_custkey"], 10)
    pages = c.groupBy(F.floor(F.col("row_index") / 100)).agg(F.collect_list(F.struct("c_custkey", "c_name")).alias("records"))
    path = scratch_folder(spark, "records")
    pages.select(F.to_json(F.struct(F.struct("records").alias("result"))).alias("value")).write.text(path)
    return fl.read_catalog_records(spark, path, rename={"c_custkey": "id", "c_name": "name"}, multi_line=False)


@query("stage_csv_handoff")
def q_s12(spark, sf_dir):
    """The labelled inspections handed to the next stage as CSV (header, ISO
    dates), the newest output picked by modification time and read back with the stage schema."""
    lab = labelled(spark, sf_dir)
    folder = scratch_folder(spark, "stage_csv")
    fl.write_stage(lab, f"{folder}/labelled", fmt="csv")
    return fl.read_stage(spark, fl.latest_stage(spark, folder), schema=lab.schema, fmt="csv")


@query("expect_area_count")
def q_k4(spark, sf_dir):
    return qa.expect_count(areas(spark, sf_dir), fx.N_AREAS, "area_count")


@query("expect_population")
def q_k5(spark, sf_dir):
    return qa.expect_population(stats(spark, sf_dir))


@query("expect_join_cardinality")
def q_k6(spark, sf_dir):
    """K6: the census join keeps every inspection row."""
    f = filled(spark, sf_dir)
    return qa.expect_rows_equal(f, with_population(spark, sf_dir, f), "census_join_keeps_rows")


@query("expect_unique_geocode")
def q_k8(spark, sf_dir):
    return qa.expect_unique(fx.addressinfo(spark, sf_dir), ["address"], "one_geocode_per_address")


# ---- hot-group splitting: same answers as the plain windows, checked against the same oracles ----

SPLIT_ARGS = {"hot_group_rows": 5, "chunk_rows": 3}   # small, so most fixture establishments split


@query("inspection_label_split")
def q_label_split(spark, sf_dir):
    """Flagship with establishments above 5 inspections scanned in chunks of ~3."""
    return labelled(spark, sf_dir, **SPLIT_ARGS)


@query("no_reinspections_strict_split")
def q_strict_split(spark, sf_dir):
    return insp.no_reinspections(insp.single_day_inspections(aggregate(spark, sf_dir)), strict=True, **SPLIT_ARGS)


@query("history_features_split")
def q_features_split(spark, sf_dir):
    f = with_history(spark, sf_dir, labelled(spark, sf_dir, **SPLIT_ARGS), **SPLIT_ARGS)
    return f.select(*FEATURE_KEYS, *ft.feature_columns(insp.pivoted(f, "action"), insp.pivoted(f, "court_outcome")))


def odd_inspections(spark, sf_dir):
    """Labelled inspections with some dates and addresses missing, for the ordered scans' NULL rules."""
    from pyspark.sql import functions as F
    k = F.col("inspection_id")
    return labelled(spark, sf_dir).withColumns({
        "inspection_date": F.when(k % 7 != 0, F.col("inspection_date")),
        "establishment_address": F.when(F.col("establishment_id") % 3 != 0, F.col("establishment_address"))})


@query("days_to_next_nulls_split")
def q_nulls_split(spark, sf_dir):
    """Gap to the next visit, split, where dates and key columns may be NULL."""
    return insp.with_days_to_next(odd_inspections(spark, sf_dir), **SPLIT_ARGS).select(*FEATURE_KEYS, "days_to_next")


@query("feat_inspection_index_nulls_split")
def q_index_nulls_split(spark, sf_dir):
    f = with_history(spark, sf_dir, odd_inspections(spark, sf_dir), **SPLIT_ARGS)
    return f.select(*FEATURE_KEYS, "cumulative_inspections", "cumulative_minor", "num_minor_prev")


@query("inspections_aggregate_collision")
def q_aggregate_collision(spark, sf_dir):
    """The pivot where two outcomes share a column name and an action is in no list."""
    from pyspark.sql import functions as F
    k = F.col("inspection_id")
    odd = handed_over(spark, sf_dir).withColumns({
        "action": F.when(F.col("action") == "Ticket", F.when(k % 2 == 0, F.lit("Verbal Warning")).otherwise(F.col("action"))).otherwise(F.col("action")),
        "court_outcome": F.when((F.col("court_outcome") == "Pending") & (k % 2 == 0), F.lit("Pen-ding")).otherwise(F.col("court_outcome"))})
    return insp.inspections_aggregate(odd)


@query("load_count_check")
def q_s9(spark, sf_dir):
    """Bulk-append the normalised infractions to a fresh table, then compare counts."""
    return snap.append_and_check(spark, infractions(spark, sf_dir), scratch_folder(spark, "loaded"))


@query("unlocated_establishments")
def q_q14(spark, sf_dir):
    """Q14: establishments dropped by the spatial join (outside every area or no coordinates)."""
    f = filled(spark, sf_dir)
    return geo.unlocated_points(geo.unique_locations(f), located(spark, sf_dir, f), insp.EST)


# ---------------------------------------------------------------------------------------------
# stream ingest, polygon layers from files, large polygons, catalog, models on their own table
# ---------------------------------------------------------------------------------------------

from ..streaming import ingest  # noqa: E402


def land_snapshot(rows, folder):
    """Write a snapshot as raw XML files (upper-case names, every value as text) into its folder, beside what is there."""
    from pyspark.sql import functions as F
    raw = rows.select(*[F.col(c).cast("string").alias(c.upper()) for c in rows.columns if c != "filename"])
    snap.write_xml_snapshot(raw, folder, mode="append")


@query("snapshot_stream_ingest")
def q_s6s(spark, sf_dir):
    """S6 stream form: snapshot 1 lands and is loaded; then snapshot 1 is published again beside a new snapshot 2.  Rows
    and dates of each loaded snapshot, and the round that loaded it."""
    from pyspark.sql import functions as F
    a, b = snapshots(spark, sf_dir, handed_over(spark, sf_dir))     # landed in three writes: the tables are joined once
    folder = scratch_folder(spark, "stream")
    for landed in ([(a, 1)], [(a, 1), (b, 2)]):
        for rows, number in landed:
            land_snapshot(rows, f"{folder}/landing/{number}")
        ingest.ingest_rounds(spark, f"{folder}/landing/*", f"{folder}/table", f"{folder}/checkpoint", fmt="xml", max_files_per_trigger=3)
    return (ingest.snapshot_rows(spark, f"{folder}/table").groupBy("filename", "round")
            .agg(F.count("*").alias("num_rows"), F.min("inspection_date").alias("first_date"), F.max("inspection_date").alias("last_date"),
                 F.sum(F.col("amount_fined").cast("decimal(20,2)")).cast("double").alias("fined")))


@query("geojson_areas")
def q_s16g(spark, sf_dir):
    """The area layer (whole cells, cells with holes, cells of two parts) written as GeoJSON with one feature on each line and read
    back; outline sizes and located establishments of each area, those in a hole left out."""
    from pyspark.sql import functions as F
    path = scratch_folder(spark, "areas")
    fl.write_geojson_features(fx.areas_with_holes(spark, sf_dir), path, ["AREA_NAME", "Shape__Area"])
    layer = geo.fix_area_names(fl.read_geojson_features(spark, path, ["AREA_NAME", "Shape__Area"]))
    inside = geo.point_in_polygon(geo.coords_per_establishment(infractions(spark, sf_dir)), layer, keep=["AREA_NAME"])
    found = inside.groupBy("AREA_NAME").agg(F.count("*").alias("num_located"), F.sum("establishment_id").alias("sum_ids"))
    sizes = layer.select("AREA_NAME", F.col("Shape__Area").cast("double").alias("Shape__Area"), "geometry_type", F.size("geometry").alias("num_rings"),
                         F.size(F.flatten("geometry")).alias("num_vertices"))
    return sizes.join(found, "AREA_NAME", "left").na.fill(0, ["num_located", "sum_ids"])


def continent_points(spark, sf_dir, **bounds):
    """Orders' points over the globe and establishments, against the 25 areas and one polygon of 40 degrees around them."""
    from pyspark.sql import functions as F
    places = geo.coords_per_establishment(infractions(spark, sf_dir)).select(F.lit("establishment").alias("kind"), F.col("establishment_id").alias("point_id"), "longitude", "latitude")
    layer = areas(spark, sf_dir).select("AREA_NAME", "geometry").unionByName(fx.continent(spark, sf_dir))
    return geo.point_in_polygon(places.unionByName(fx.order_points(spark, sf_dir)), layer, **bounds).select("kind", "point_id", "AREA_NAME")


@query("continent_points")
def q_j4c(spark, sf_dir):
    """J4 with polygons of very different size: the cover is bounded for each."""
    return continent_points(spark, sf_dir)


@query("continent_points_shuffled")
def q_j4s(spark, sf_dir):
    """J4 where the cover is too large to broadcast."""
    return continent_points(spark, sf_dir, max_broadcast_cells=0, max_broadcast_vertices=0)


@query("catalog_lifecycle")
def q_s10(spark, sf_dir):
    """A database and a table with a comment are created, listed, filled, truncated and dropped; what the catalog says
    after each step."""
    import uuid
    database, steps = f"inspections_{uuid.uuid4().hex}", []
    name = f"{database}.infractions"

    def step(action):
        there = fl.list_tables(spark, database).first()
        steps.append((len(steps) + 1, action, spark.catalog.databaseExists(database), there is not None, there.comment if there else "", len(there.columns) if there else 0,
                      spark.table(name).count() if there else 0))
    rows = infractions(spark, sf_dir)
    try:
        fl.create_database(spark, database, scratch_folder(spark, "catalog"))
        step("create database")
        fl.create_table(spark, name, rows.schema, comment="infractions of all snapshots")
        step("create table")
        rows.write.insertInto(name)
        step("load")
        fl.truncate_table(spark, name)
        step("truncate")
        fl.drop_table(spark, name)
        step("drop table")
    finally:
        fl.drop_database(spark, database)
    step("drop database")
    return spark.createDataFrame(steps, "step int, action string, database_exists boolean, table_exists boolean, comment string, num_columns int, num_rows bigint")


@query("parquet_gzip")
def q_s14(spark, sf_dir):
    """The infractions as gzip Parquet, read back."""
    path = scratch_folder(spark, "gzip")
    fl.write_parquet_gzip(infractions(spark, sf_dir), path)
    return spark.read.parquet(path)


@query("active_resource")
def q_s15a(spark, sf_dir):
    """One catalog package response for each customer segment and nation, with a resource for each customer, of which some
    are served as records: the first served resource of each package."""
    from pyspark.sql import functions as F
    c = fx.table(spark, sf_dir, "customer")
    resource = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), (F.col("c_custkey") % 5 == 0).alias("datastore_active"))
    packages = c.groupBy("c_mktsegment", "c_nationkey").agg(F.array_sort(F.collect_list(resource)).alias("resources"))
    path = scratch_folder(spark, "packages")
    packages.select(F.to_json(F.struct(F.struct("resources").alias("result"))).alias("value")).write.text(path)
    return fl.active_resource(spark.read.schema("result struct<resources: array<struct<id: bigint, name: string, datastore_active: boolean>>>").json(path))


@query("histogram_transformed")
def q_a25t(spark, sf_dir):
    """Bins of the two numeric features, raw and power-transformed with fixed λ."""
    from functools import reduce
    from pyspark.sql import functions as F
    t = train_rows(spark, sf_dir)
    parts = []
    for c, lam in zip(NUMERICS, HISTOGRAM_LAMBDAS):
        both = t.select(F.col(c).cast("double").alias("raw"), md.yeo_johnson_expr(F.col(c).cast("double"), lam).alias("transformed"))
        parts += [ex.histogram_bins(both, form).select(F.lit(c).alias("feature"), F.lit(form).alias("form"), "*") for form in ("raw", "transformed")]
    return reduce(lambda a, b: a.unionByName(b), parts)


HISTOGRAM_LAMBDAS = (0.5, 1.5)
LIKELIHOOD_LAMBDAS = [i / 4 for i in range(-8, 17)]


@query("histogram_fitted")
def q_a25f(spark, sf_dir):
    """A25 with the λ that the data gives: bins of the two numeric features after the fitted transform."""
    from functools import reduce
    from pyspark.sql import functions as F
    t = train_rows(spark, sf_dir).select(*[F.col(c).cast("double").alias(c) for c in NUMERICS])
    fitted = md.YeoJohnson(columns=NUMERICS).fit(t).transform(t)
    return reduce(lambda a, b: a.unionByName(b), [ex.histogram_bins(fitted, f"{c}_yj").select(F.lit(c).alias("feature"), "*") for c in NUMERICS])


@query("yeo_johnson_likelihood")
def q_m6l(spark, sf_dir):
    """M6: the profile likelihood of each numeric feature over a λ grid."""
    return md.yeo_johnson_likelihood(train_rows(spark, sf_dir), NUMERICS, LIKELIHOOD_LAMBDAS)


@query("lr_optimality")
def q_m9o(spark, sf_dir):
    """M9: the gradient of the regression's objective at the fitted coefficients is as good as zero."""
    from pyspark.sql import functions as F
    model, train, _ = _fit(spark, sf_dir, md.logistic_regression, "lr")
    g = md.objective_gradient(model, train)
    norm = g.agg(F.sqrt(F.sum(F.col("gradient") ** 2))).first()[0]
    return train.agg(F.count("*").alias("num_rows"), F.sum("is_infraction").alias("num_positive")).withColumn("optimal", F.lit(norm < 1e-3))


@query("model_round_trip")
def q_m16(spark, sf_dir):
    """The fitted pipeline saved, loaded and applied beside the original to all rows."""
    model, train, test = _fit(spark, sf_dir, md.logistic_regression, "lr")
    path = scratch_folder(spark, "model")
    md.save_model(model, path)
    return md.same_predictions(model, md.load_model(path), test.unionByName(train.drop("weight")))


def scored(spark, sf_dir):
    """The regression's labels and probabilities of training and test rows, and the baselines', written once."""
    from ..session import cut_lineage
    model, train, test = _fit(spark, sf_dir, md.logistic_regression, "lr")
    rows = mp.baseline_predictions(train.drop("weight").unionByName(test))
    keep = [*mp.ROW_KEY, "split", "AREA_NAME", "inspection_weekday", mp.LABEL, "y_guess", "y_always_infrac"]
    return cut_lineage(md.predict(model, rows, keep).withColumnRenamed(mp.LABEL, "y_true"), "scored")


@query("model_evaluation")
def q_m15(spark, sf_dir):
    """M15 into E1-E3: the ten-row metric table of the fitted regression and the baselines."""
    return ev.metrics_table(scored(spark, sf_dir), "y_pred", ["y_guess", "y_always_infrac"],
                            names={"y_pred": "ML", "y_guess": "guess", "y_always_infrac": "always_infrac"})


@query("model_supports")
def q_e2m(spark, sf_dir):
    """M15 into E1 / E2: what of the evaluation doesn't depend on the fit: rows of each class, and the baselines' confusion counts by split
    (−1 for the fitted model)."""
    from pyspark.sql import functions as F
    cm = ev.confusion_matrix(scored(spark, sf_dir), ["y_pred", "y_guess", "y_always_infrac"], group=["split"])
    fitted = F.col("strategy") == "y_pred"
    return cm.select("split", "strategy", (F.col("tn") + F.col("fp")).alias("num_0"), (F.col("fn") + F.col("tp")).alias("num_1"),
                     F.when(fitted, -1).otherwise(F.col("fp")).alias("fp"), F.when(fitted, -1).otherwise(F.col("tp")).alias("tp"))


@query("model_error_context")
def q_j10m(spark, sf_dir):
    """M15 into J10, E5 and E6: the fitted regression's error shares by weekday and by area on the test rows."""
    from pyspark.sql import functions as F
    test = scored(spark, sf_dir).where("split = 'test'")
    days = ev.weekday_error_share(test).select(F.lit("weekday").alias("by"), F.col("inspection_weekday_name").alias("value"), "subset", "true_share", "pred_share")
    places = ev.area_error_share(test).select(F.lit("area").alias("by"), F.col("AREA_NAME").alias("value"), "subset", "true_share", "pred_share")
    return days.unionByName(places)


@query("mlp_predict")
def q_m11(spark, sf_dir):
    """The perceptron's predictions of the test rows, fitted on balanced rows."""
    from pyspark.sql import functions as F
    data = model_inputs(spark, sf_dir)
    model = md.fit_perceptron(data.where(F.col("split") == "train"), CATEGORICALS, NUMERICS, mp.ROW_KEY)
    return md.predict(model, data.where(F.col("split") == "test"), mp.ROW_KEY + ["is_infraction"])


@query("balanced_rows")
def q_m11b(spark, sf_dir):
    """How often balancing repeats each training row."""
    from pyspark.sql import functions as F
    return md.balanced_rows(train_rows(spark, sf_dir), mp.ROW_KEY).groupBy(*mp.ROW_KEY, "is_infraction").agg(F.count("*").alias("copies"))
