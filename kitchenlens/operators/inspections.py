"""Stage 2: infractions (one row per finding) → labelled inspections (one row per visit).

Plan shape, chosen for scale:

* the validity filter runs before any shuffle and is pushed into the scan where possible;
* valid rows are hash-partitioned once on (establishment id, inspection id): the 8-key inner
  aggregate, the 6-key outer aggregate and the multi-day check all group by supersets of those
  two columns, so they run in that one stage without further exchanges, and a hot
  establishment is spread across tasks by inspection (the sorted text of one inspection is one
  string, so one group's text is never split, with or without map-side combining);
* one more exchange on the establishment key feeds the gap to the next visit;
* pivot values are read from the data in one narrow pass (or given), so no value is left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import (DETAILS_SEPARATOR, EST, ESTABLISHMENT_TYPES_WANTED, SEVERITY_PATTERNS,
                         VALID_SEVERITIES)
from ..functions.text import sanitise_action, sanitise_outcome

INNER_KEYS = EST + ["inspection_date", "inspection_id", "establishment_status", "action", "court_outcome"]
OUTER_KEYS = EST + ["inspection_date", "inspection_id", "establishment_status"]
COUNT_COLUMNS = ["num_significant", "num_crucial", "num_minor", "num_na", "num_infractions"]


# ---------------------------------------------------------------------------------------------
# filters
# ---------------------------------------------------------------------------------------------

def valid_infractions(df: DataFrame, types: Sequence[str] = ESTABLISHMENT_TYPES_WANTED,
                      strict_types: bool = False) -> DataFrame:
    """Rows kept for the inspection aggregate.

    Default reproduces ``type IN (…) AND severity IS NULL OR severity IN (S, C, M)``: by SQL
    precedence the type list only limits null-severity rows.  ``strict_types`` applies the type
    list to every row.
    """
    type_ok = F.col("establishmenttype").isin(list(types))
    sev_null = F.col("severity").isNull()
    sev_ok = F.col("severity").isin(VALID_SEVERITIES)
    cond = (type_ok & (sev_null | sev_ok)) if strict_types else ((type_ok & sev_null) | sev_ok)
    return df.where(cond)


# ---------------------------------------------------------------------------------------------
# aggregates
# ---------------------------------------------------------------------------------------------

def sorted_text_agg(c: str, sep: str = DETAILS_SEPARATOR) -> Column:
    """Null-skipping string concatenation in value order (deterministic listagg)."""
    return F.expr(f"listagg(`{c}`, '{sep}') WITHIN GROUP (ORDER BY `{c}`)")


def _severity_count(name: str, pattern: str) -> Column:
    return F.sum(F.when(F.col("severity").like(pattern), 1).otherwise(0)).cast("bigint").alias(name)


def infraction_groups(df: DataFrame, with_row_count: bool = False) -> DataFrame:
    """Inner aggregate: one row per (establishment, visit, status, action, court outcome)."""
    aggs = [sorted_text_agg("infraction_details").alias("infractions_summary")]
    aggs += [_severity_count(k, v) for k, v in SEVERITY_PATTERNS.items()]
    aggs.append(F.count("infraction_details").cast("bigint").alias("num_infractions"))
    if with_row_count:
        aggs.append(F.count(F.lit(1)).cast("bigint").alias("num_rows"))
    return df.groupBy(*INNER_KEYS).agg(*aggs)


def distinct_values(df: DataFrame, column: str, max_values: int = 1000) -> list:
    """Distinct values of a low-cardinality column, for building a static pivot.

    Only the distinct values reach the driver; more than ``max_values`` is an error, so the
    list that crosses to the driver is bounded.
    """
    rows = df.select(column).distinct().limit(max_values + 1).collect()
    if len(rows) > max_values:
        raise ValueError(f"{column} has more than {max_values} distinct values; pass the list explicitly")
    vals = [r[0] for r in rows]
    return sorted(v for v in vals if v is not None) + ([None] if None in vals else [])


def pivot_values(df: DataFrame, columns: Sequence[str] = ("action", "court_outcome"), max_values: int = 1000) -> list[list]:
    """Distinct values of several low-cardinality columns from one pass over them (NULL last).

    Only the distinct values reach the driver; more than ``max_values`` in a column is an error."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).alias("v")) for i, c in enumerate(columns)]))
    rows = df.select(pairs.alias("x")).select("x.*").distinct().limit(len(columns) * max_values + 1).collect()
    out = []
    for i, c in enumerate(columns):
        vals = [r["v"] for r in rows if r["i"] == i]
        if len(vals) > max_values:
            raise ValueError(f"{c} has more than {max_values} distinct values; pass the list explicitly")
        out.append(sorted(v for v in vals if v is not None) + ([None] if None in vals else []))
    return out


def pivot_columns(values: Sequence[str | None], column: str, namer, null_name: str,
                  weight: Column | None = None) -> list[Column]:
    """Conditional sums, one per column name: values whose names are the same are counted together; NULL
    is its own value (``IS NULL`` test).  The columns carry which column they pivot as metadata."""
    hits: dict[str, Column] = {}
    for v in values:
        name = null_name if v is None else namer(v)
        hit = F.col(column).isNull() if v is None else F.coalesce(F.col(column) == F.lit(v), F.lit(False))
        hits[name] = hits[name] | hit if name in hits else hit
    w = F.lit(1) if weight is None else weight
    return [F.sum(F.when(hit, w).otherwise(0)).cast("bigint").alias(name, metadata={"pivot_of": column}) for name, hit in hits.items()]


def pivoted(df: DataFrame, column: str) -> list[str]:
    """The columns of ``df`` that count values of ``column`` (by their metadata, which written tables keep)."""
    return [f.name for f in df.schema.fields if (f.metadata or {}).get("pivot_of") == column]


def inspections_aggregate(df: DataFrame, actions: Sequence[str | None] | None = None,
                          outcomes: Sequence[str | None] | None = None, pivot_counts: str = "groups",
                          types: Sequence[str] = ESTABLISHMENT_TYPES_WANTED,
                          strict_types: bool = False, num_partitions: int | None = None) -> DataFrame:
    """Outer aggregate: one row per (establishment, date, inspection, status).

    ``pivot_counts="groups"`` (default) counts inner groups per action / outcome value, as the
    source's nested query does; ``"rows"`` counts infraction rows instead.  ``num_partitions`` fixes the exchange's
    partitions (default: the session's, coalesced by AQE).
    """
    valid = valid_infractions(df, types, strict_types)
    if actions is None or outcomes is None:
        found = pivot_values(df)
        actions, outcomes = (found[0] if actions is None else actions), (found[1] if outcomes is None else outcomes)
    # one exchange serves the inner and outer aggregates and the multi-day window downstream; by the whole key, so that
    # rows without ids are spread by type and address
    valid = valid.repartition(*([num_partitions] if num_partitions else []), *EST, "inspection_id")
    inner = infraction_groups(valid, with_row_count=(pivot_counts == "rows"))
    weight = F.col("num_rows") if pivot_counts == "rows" else None
    aggs = [sorted_text_agg("infractions_summary").alias("infractions_summary")]
    aggs += [F.sum(c).cast("bigint").alias(c) for c in COUNT_COLUMNS]
    aggs += pivot_columns(actions, "action", sanitise_action, "action_null", weight)
    aggs += pivot_columns(outcomes, "court_outcome", sanitise_outcome, "court_outcome_null", weight)
    return inner.groupBy(*OUTER_KEYS).agg(*aggs)


def pivot_column_names(actions: Sequence[str | None], outcomes: Sequence[str | None]) -> list[str]:
    names = []
    for v in actions:
        n = "action_null" if v is None else sanitise_action(v)
        if n not in names:
            names.append(n)
    for v in outcomes:
        n = "court_outcome_null" if v is None else sanitise_outcome(v)
        if n not in names:
            names.append(n)
    return names


# ---------------------------------------------------------------------------------------------
# per-establishment steps (share one exchange on the establishment key)
# ---------------------------------------------------------------------------------------------

def by_establishment(df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Hash-partition on the establishment key once; every later EST window reuses it.

    AQE coalesces by compressed bytes, of which the windows sort many times as many; ``num_partitions`` fixes their number."""
    return df.repartition(*([num_partitions] if num_partitions else []), *EST)


def with_date_span(df: DataFrame) -> DataFrame:
    w = Window.partitionBy(*EST, "inspection_id")
    return (df.withColumn("_d_min", F.min("inspection_date").over(w))
              .withColumn("_d_max", F.max("inspection_date").over(w)))


def multi_day_inspections(agg: DataFrame) -> DataFrame:
    """Report: inspections whose rows carry more than one date, with the number of dates."""
    return (agg.groupBy(*EST, "inspection_id")
               .agg(F.count_distinct("inspection_date").cast("bigint").alias("num_dates"))
               .where(F.col("num_dates") > 1))


def single_day_inspections(agg: DataFrame) -> DataFrame:
    """Keep inspections completed on one date (all rows of the inspection share the date)."""
    return (with_date_span(agg).where(F.col("_d_min") == F.col("_d_max"))
            .drop("_d_min", "_d_max"))


def _next_order(strict: bool) -> list[Column]:
    if strict:
        return [F.col("inspection_date"), F.col("inspection_id"), F.col("establishment_status")]
    return [F.col("inspection_id"), F.col("inspection_date"), F.col("establishment_status")]


def with_days_to_next(df: DataFrame, hot_group_rows: int | None = None, chunk_rows: int = 1_000_000,
                      hot: DataFrame | None = None) -> DataFrame:
    """``days_to_next`` = |date − next date| with rows ordered by inspection id, then date.

    With ``hot_group_rows`` an establishment above that size is split into id ranges scanned in
    parallel: the next row is the previous row of the reversed order (``ordered.chunked_scan``).
    """
    if hot_group_rows is not None:
        from .ordered import CHUNK, NCH, assign_chunks, chunked_scan
        from ..session import cut_lineage       # the scan and its carry table read the assignment
        base = cut_lineage(assign_chunks(df, EST, "inspection_id", hot_group_rows, chunk_rows, descending=True, hot=hot, second_order="inspection_date"), "gap_input")
        out = chunked_scan(base, EST, ["inspection_id", "inspection_date", "establishment_status"],
                           lags={"_next_date": "inspection_date"}, descending=True)
        return (out.withColumn("days_to_next", F.abs(F.datediff(F.col("inspection_date"), F.col("_next_date")))
                               .cast("bigint")).drop("_next_date", CHUNK, NCH))
    w = Window.partitionBy(*EST).orderBy(*_next_order(False))
    nxt = F.lead("inspection_date").over(w)
    return df.withColumn("days_to_next", F.abs(F.datediff(F.col("inspection_date"), nxt)).cast("bigint"))


def with_days_from_previous(df: DataFrame, hot_group_rows: int | None = None, chunk_rows: int = 1_000_000,
                            hot: DataFrame | None = None) -> DataFrame:
    """Strict form: gap to the previous inspection in date order (the follow-up is the later row)."""
    if hot_group_rows is not None:
        from .ordered import CHUNK, NCH, assign_chunks, chunked_scan
        from ..session import cut_lineage
        base = cut_lineage(assign_chunks(df, EST, "inspection_date", hot_group_rows, chunk_rows, hot=hot, second_order="inspection_id"), "gap_input")
        out = chunked_scan(base, EST, ["inspection_date", "inspection_id", "establishment_status"], lags={"_prev_date": "inspection_date"})
        return (out.withColumn("days_from_prev", F.datediff(F.col("inspection_date"), F.col("_prev_date")).cast("bigint"))
                .drop("_prev_date", CHUNK, NCH))
    w = Window.partitionBy(*EST).orderBy(*_next_order(True))
    prev = F.lag("inspection_date").over(w)
    return df.withColumn("days_from_prev", F.datediff(F.col("inspection_date"), prev).cast("bigint"))


def reinspections(df: DataFrame, **split) -> DataFrame:
    return with_days_to_next(df, **split).where(F.col("days_to_next") <= 2)


def no_reinspections(df: DataFrame, strict: bool = False, **split) -> DataFrame:
    """Drop follow-up visits within two days.

    Default reproduces the source: the gap sits on the earlier row (id order), so the first visit
    of a close pair is dropped.  ``strict`` drops the later visit in date order instead.
    """
    if strict:
        return (with_days_from_previous(df, **split)
                .where(F.col("days_from_prev").isNull() | (F.col("days_from_prev") > 2))
                .drop("days_from_prev"))
    return (with_days_to_next(df, **split)
            .where(F.col("days_to_next").isNull() | (F.col("days_to_next") > 2))
            .drop("days_to_next"))


def inspection_label(df: DataFrame) -> DataFrame:
    """``is_infraction`` = 1 when a significant or crucial infraction was found."""
    hit = (F.col("num_significant") > 0) | (F.col("num_crucial") > 0)
    return df.withColumn("is_infraction", F.when(hit, 1).otherwise(0))


def class_balance(labelled: DataFrame) -> DataFrame:
    """Inspections and fraction per label (two rows; the window runs over the tiny aggregate)."""
    counts = labelled.groupBy("is_infraction").agg(F.count(F.lit(1)).cast("bigint").alias("num_inspections"))
    total = F.sum("num_inspections").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("fraction", F.col("num_inspections") / total)


def labelled_inspections(infractions: DataFrame, actions=None, outcomes=None, *,
                         strict_types: bool = False, strict_reinspection: bool = False,
                         pivot_counts: str = "groups", hot_group_rows: int | None = None,
                         chunk_rows: int = 1_000_000, hot: DataFrame | None = None, num_partitions: int | None = None) -> DataFrame:
    """The flagship chain: valid rows → aggregates → single-day → no re-inspection → label.

    Default plan: two exchanges — (establishment id, inspection id) for both aggregates and the
    single-day check, then the establishment key for the gap to the next visit.  With
    ``hot_group_rows`` no step partitions by the establishment alone: the gap to the next visit
    splits establishments above that size into parallel chunks.
    """
    agg = inspections_aggregate(infractions, actions, outcomes, pivot_counts=pivot_counts,
                                strict_types=strict_types, num_partitions=num_partitions)
    one_day = single_day_inspections(agg)          # runs on the aggregate's partitioning
    if hot_group_rows is not None:
        kept = no_reinspections(one_day, strict=strict_reinspection, hot_group_rows=hot_group_rows, chunk_rows=chunk_rows, hot=hot)
        return inspection_label(kept)
    return inspection_label(no_reinspections(by_establishment(one_day, num_partitions), strict=strict_reinspection))
