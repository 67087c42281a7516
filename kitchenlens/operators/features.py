"""Stage 7: per-establishment history features, all in one windowed pass.

Every feature is a function of the establishment's earlier inspections, so they share one
window specification (establishment key, ordered by date then inspection id).  Spark plans the
whole set as one exchange + one sort feeding back-to-back Window operators; the source's
repeated group-by loops become a single ``select``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import EST, STATUS_CLOSED, STATUS_CONDITIONAL_PASS, STATUS_PASS

INFRACTION_TYPES = ["minor", "significant", "crucial"]


def history_window(order: Sequence[str] = ("inspection_date", "inspection_id", "establishment_status")) -> Window:
    return Window.partitionBy(*EST).orderBy(*order)


def running(w: Window, exclude_current: bool = False) -> Window:
    return w.rowsBetween(Window.unboundedPreceding, -1 if exclude_current else Window.currentRow)


def pivot_prev_names(actions: Sequence[str], outcomes: Sequence[str]) -> dict[str, str]:
    """``action_null`` → ``num_action_null_prev``; ``num_ticket`` (action) → ``num_action_ticket_prev``;
    ``num_pending`` (outcome) → ``num_court_outcome_pending_prev``."""
    names = {}
    for c in actions:
        names[c] = "num_" + c.replace("num_", "action_", 1) + "_prev" if c.startswith("num_") else f"num_{c}_prev"
    for c in outcomes:
        names[c] = ("num_" + c.replace("num_", "court_outcome_", 1) + "_prev" if c.startswith("num_")
                    else f"num_{c}_prev")
    return names


def date_parts(c: Column, prefix: str) -> dict[str, Column]:
    """Month, weekday (Monday = 0), ISO week, quarter, year."""
    return {f"{prefix}_month": F.month(c), f"{prefix}_weekday": F.weekday(c),
            f"{prefix}_weekofyear": F.weekofyear(c), f"{prefix}_quarter": F.quarter(c),
            f"{prefix}_year": F.year(c)}


def history_features(df: DataFrame, action_columns: Sequence[str] = (), outcome_columns: Sequence[str] = (),
                     exclude_current: bool = False, hot_group_rows: int | None = None,
                     chunk_rows: int = 1_000_000, hot: DataFrame | None = None) -> DataFrame:
    """W4–W13 and X5 in one pass.

    Totals include the current inspection by default (as the source computes them, which leaks
    the label into ``cumulative_significant`` / ``ever_*``); ``exclude_current=True`` uses the
    frame ``unbounded preceding .. 1 preceding`` instead.

    ``hot_group_rows``: establishments with more rows than this are split into chunks of about
    ``chunk_rows`` rows and scanned in parallel (``ordered.chunked_scan``); the result is the same.
    """
    if hot_group_rows is not None:
        return _history_features_chunked(df, action_columns, outcome_columns, exclude_current,
                                         hot_group_rows, chunk_rows, hot)
    w = history_window()
    frame = running(w, exclude_current)
    prev_date = F.lag("inspection_date").over(w)
    prev_names = pivot_prev_names(action_columns, outcome_columns)

    # level 1: lag-based columns
    lagged = {
        "_last_date": prev_date,
        "_last_status": F.lag("establishment_status").over(w),
        "cumulative_inspections": (F.row_number().over(w) - 1).cast("bigint"),
    }
    for t in INFRACTION_TYPES:
        lagged[f"num_{t}_prev"] = F.lag(f"num_{t}").over(w)
    for src, name in prev_names.items():
        lagged[name] = F.lag(src).over(w)
    lagged["cumulative_failures"] = F.sum(_is_closed()).over(frame).cast("bigint")
    for t in INFRACTION_TYPES:
        lagged[f"cumulative_{t}"] = F.sum(f"num_{t}").over(frame).cast("bigint")
    # running totals of the lagged pivot counts are those of the counts before the current row: no second window
    past = running(w, exclude_current=True)
    for src, name in prev_names.items():
        lagged[f"cumulative_{name}"] = F.sum(src).over(past).cast("bigint")
    return _derived(df.withColumns(lagged))


def _is_closed() -> Column:
    return F.when(F.col("establishment_status") == STATUS_CLOSED, 1).otherwise(0)


def _derived(out: DataFrame) -> DataFrame:
    """Level 2: plain expressions on the lagged values and totals."""
    zero_fail = F.coalesce(F.col("cumulative_failures"), F.lit(0))
    derived = {
        "time_since_last_infrac": F.datediff(F.col("inspection_date"), F.col("_last_date")),
        "last_pass": F.coalesce(F.col("_last_status") == F.lit(STATUS_PASS), F.lit(False)),
        "last_cond_pass": F.coalesce(F.col("_last_status") == F.lit(STATUS_CONDITIONAL_PASS), F.lit(False)),
        "ever_failed": zero_fail != 0,
        "proportion_past_failures": F.try_divide(F.col("cumulative_failures").cast("double"),
                                                 F.col("cumulative_inspections").cast("double")),
        "days_since_last_inspection": F.datediff(F.col("_last_date"), F.col("inspection_date")),
    }
    for t in INFRACTION_TYPES:
        derived[f"ever_{t}"] = F.coalesce(F.col(f"cumulative_{t}"), F.lit(0)) > 0
        derived[f"proportion_past_{t}"] = F.try_divide(F.col(f"cumulative_{t}").cast("double"),
                                                       F.col("cumulative_inspections").cast("double"))
    derived.update(date_parts(F.col("_last_date"), "last_inspection"))
    derived.update(date_parts(F.col("inspection_date"), "inspection"))
    return out.withColumns(derived).drop("_last_date", "_last_status")


def _history_features_chunked(df, action_columns, outcome_columns, exclude_current, hot_group_rows, chunk_rows, hot):
    from .ordered import CHUNK, NCH, assign_chunks, chunked_scan
    order = ["inspection_date", "inspection_id", "establishment_status"]
    prev_names = pivot_prev_names(action_columns, outcome_columns)
    from ..session import cut_lineage
    # the rows are read for the hot groups, their cuts and the assignment, and this for the scan and its carry table: written once each
    base = cut_lineage(assign_chunks(cut_lineage(df, "history_rows"), EST, "inspection_date", hot_group_rows, chunk_rows, hot=hot, second_order="inspection_id")
                       .withColumn("_closed", _is_closed()), "history_input")
    lags = {"_last_date": "inspection_date", "_last_status": "establishment_status"}
    lags.update({f"num_{t}_prev": f"num_{t}" for t in INFRACTION_TYPES})
    lags.update({name: src for src, name in prev_names.items()})
    totals = {"cumulative_failures": "_closed"}
    totals.update({f"cumulative_{t}": f"num_{t}" for t in INFRACTION_TYPES})
    past = {f"cumulative_{name}": src for src, name in prev_names.items()}
    out = chunked_scan(base, EST, order, lags=lags, index="cumulative_inspections", sums={} if exclude_current else totals,
                       exclusive_sums={**totals, **past} if exclude_current else past)
    return _derived(out.withColumns({c: F.col(c).cast("bigint") for c in [*totals, *past]}).drop("_closed", CHUNK, NCH))


def feature_columns(action_columns: Sequence[str], outcome_columns: Sequence[str]) -> list[str]:
    prev = list(pivot_prev_names(action_columns, outcome_columns).values())
    cols = ["time_since_last_infrac", "last_pass", "last_cond_pass"]
    cols += [f"num_{t}_prev" for t in INFRACTION_TYPES] + prev
    cols += ["cumulative_failures"] + [f"cumulative_{t}" for t in INFRACTION_TYPES]
    cols += [f"cumulative_{p}" for p in prev]
    cols += ["ever_failed"] + [f"ever_{t}" for t in INFRACTION_TYPES] + ["cumulative_inspections"]
    cols += ["proportion_past_failures"] + [f"proportion_past_{t}" for t in INFRACTION_TYPES]
    cols += ["days_since_last_inspection"]
    cols += list(date_parts(F.lit(None), "last_inspection")) + list(date_parts(F.lit(None), "inspection"))
    return cols
