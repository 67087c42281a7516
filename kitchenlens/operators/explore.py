"""Exploration queries over raw infractions and over inspections (counts, previews, profiles).

All of them are single aggregation passes or filters; results are small except the row-level
filters.  Global statistics (min / max of a column) are scalar subqueries, computed once and
inlined, so no cross join and no driver round trip is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import EST, STATUS_CLOSED


def _cnt(name: str) -> Column:
    return F.count(F.lit(1)).cast("bigint").alias(name)


def _all_ordered(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`").asc_nulls_first() for c in df.columns]


# ---- row-level filters / previews ------------------------------------------------------------

def preview_rows(df: DataFrame, n: int = 6) -> DataFrame:
    """first ``n`` rows; ordered by every column so the answer is repeatable (a top-k)."""
    return df.orderBy(*_all_ordered(df)).limit(n)


def filter_inspection(df: DataFrame, inspection_id: int) -> DataFrame:
    """all rows of one inspection (pushed into the scan as a predicate)."""
    return df.where(F.col("inspection_id") == F.lit(inspection_id))


def missing_coords(df: DataFrame) -> DataFrame:
    """rows without a latitude or a longitude."""
    return df.where(F.col("latitude").isNull() | F.col("longitude").isNull())


def na_severity_rows(df: DataFrame, pattern: str = "%NA -%") -> DataFrame:
    """rows whose severity is 'NA - …', projected to details, severity, status."""
    return df.where(F.col("severity").like(pattern)).select(
        "infraction_details", "severity", "establishment_status")


def na_severity_closed(df: DataFrame, pattern: str = "%NA -%") -> DataFrame:
    """F4 restricted to closed establishments."""
    return na_severity_rows(df.where(F.col("establishment_status") == STATUS_CLOSED), pattern)


def head_tail(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """L4: first and last ``n`` rows in a given order (two top-k's, union)."""
    first = df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(n)
    last = df.orderBy(*[F.col(c).desc_nulls_last() for c in order]).limit(n)
    return first.withColumn("end", F.lit("head")).unionByName(last.withColumn("end", F.lit("tail")))


# ---- counts ----------------------------------------------------------------------------------

def establishments_per_inspection(df: DataFrame) -> DataFrame:
    """A1: distinct establishments per inspection id (expected 1)."""
    return df.groupBy("inspection_id").agg(
        F.count_distinct("establishment_id").cast("bigint").alias("num_establishments"))


def inspections_per_establishment(df: DataFrame) -> DataFrame:
    """A2: distinct inspections per establishment."""
    return df.groupBy(*EST).agg(F.count_distinct("inspection_id").cast("bigint").alias("num_inspections"))


def infractions_per_inspection(df: DataFrame) -> DataFrame:
    """A3: rows per establishment and inspection."""
    return df.groupBy(*EST, "inspection_id").agg(_cnt("number_of_infractions"))


def missing_address_count(df: DataFrame) -> DataFrame:
    """A4: global count of rows without an address."""
    return df.agg(F.count(F.when(F.col("establishment_address").isNull(), 1)).cast("bigint")
                  .alias("num_missing_addresses"))


def addresses_missing_coords(df: DataFrame) -> DataFrame:
    """A5: unique addresses lacking a coordinate, with independent maxima of lat and lon."""
    return missing_coords(df).groupBy("establishment_address").agg(
        F.max("latitude").alias("latitude"), F.max("longitude").alias("longitude"))


def coord_null_consistency(df: DataFrame) -> DataFrame:
    """Over A5 — null-lat count, null-lon count, distinct addresses (all equal when both
    coordinates are always missing together)."""
    a = addresses_missing_coords(df)
    return a.agg(
        F.sum(F.when(F.col("latitude").isNull(), 1).otherwise(0)).cast("bigint").alias("num_miss_lat"),
        F.sum(F.when(F.col("longitude").isNull(), 1).otherwise(0)).cast("bigint").alias("num_miss_lon"),
        F.count_distinct("establishment_address").cast("bigint").alias("num_establishments"))


def severity_counts(df: DataFrame) -> DataFrame:
    """Rows per severity."""
    return df.groupBy("severity").agg(_cnt("num_infractions"))


def na_status_counts(df: DataFrame, pattern: str = "%NA -%") -> DataFrame:
    """Rows per status among NA-severity rows."""
    return df.where(F.col("severity").like(pattern)).groupBy("establishment_status").agg(_cnt("num_rows"))


def severity_status_counts(df: DataFrame) -> DataFrame:
    """Rows per severity × status."""
    return df.groupBy("severity", "establishment_status").agg(_cnt("num_infractions"))


def type_summary(df: DataFrame, na_pattern: str = "%NA -") -> DataFrame:
    """Per type — distinct inspections and non-null details among rows with a known,
    non-NA severity.  The default pattern has no trailing wildcard (as in the source), so NA
    rows are still counted; pass ``'%NA -%'`` for the intended filter."""
    keep = ~F.col("severity").like(na_pattern) & F.col("severity").isNotNull()
    return df.where(keep).groupBy("establishmenttype").agg(
        F.count_distinct("inspection_id").cast("bigint").alias("num_inspections"),
        F.count("infraction_details").cast("bigint").alias("num_infractions"))


def est_recount(inspections: DataFrame) -> DataFrame:
    """Inspections and dates counted per establishment (must agree)."""
    return inspections.groupBy(*EST).agg(
        F.count("inspection_id").cast("bigint").alias("num_inspection_ids"),
        F.count("inspection_date").cast("bigint").alias("num_inspection_dates"))


def status_per_inspection(inspections: DataFrame) -> DataFrame:
    """Distinct statuses per inspection (must be 1)."""
    return inspections.groupBy(*EST, "inspection_id", "inspection_date").agg(
        F.count_distinct("establishment_status").cast("bigint").alias("num_statuses"))


# ---- column profiles -------------------------------------------------------------------------

def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, one aggregation pass, unpivoted to (column, num_missing)."""
    cols = df.columns
    wide = df.agg(*[F.count(F.when(F.col(f"`{c}`").isNull(), 1)).cast("bigint").alias(c) for c in cols])
    return wide.unpivot([], [F.col(f"`{c}`") for c in cols], "column", "num_missing")


def profile_table(df: DataFrame, approx: bool = False) -> DataFrame:
    """Per column — type, nulls, rows, distinct non-null values, and one value taken from a
    complete row (the smallest complete row, so the pick is repeatable).

    The input is written once, so it is computed once.  Exact distinct counts stack the columns into
    narrow (column index, value, weight) rows and count them with two hash aggregates: the first
    dedups (column, value) map-side before its shuffle, the second is one row per column.  Values
    are compared as text, with float -0.0 folded into 0.0 first, so equal numbers stay one value.
    The sample row is the first of an ordered scan that keeps one row a task.

    ``approx=True`` uses HyperLogLog distinct counts instead of the dedup.
    """
    from ..session import cut_lineage
    cols, dtypes = df.columns, dict(df.dtypes)
    df = cut_lineage(df, "profile")

    def as_text(c):
        col = F.col(f"`{c}`")
        if dtypes[c] in ("double", "float"):
            col = col + F.lit(0.0)
        return col.cast("string")

    plain = [F.col(f"`{c}`").cast("string").alias(c) for c in cols]
    row = df.select(*plain).na.drop("any").orderBy(*[F.col(f"`{c}`") for c in cols]).first()
    items = F.array(*[F.struct(F.lit(i).alias("i"), as_text(c).alias("v"), F.lit(1).alias("w")) for i, c in enumerate(cols)])
    stacked = df.select(F.explode(items).alias("kv")).select("kv.*")
    # one weightless row per column, so an empty input still reports every column
    every = df.sparkSession.range(len(cols)).select(F.col("id").cast("int").alias("i"), F.lit(None).cast("string").alias("v"), F.lit(0).alias("w"))
    rows = stacked.unionByName(every)
    if not approx:
        rows = rows.groupBy("i", "v").agg(F.sum("w").alias("w"))
    distinct = F.approx_count_distinct("v") if approx else F.count("v")
    per_col = rows.groupBy("i").agg(distinct.cast("bigint").alias("nunique"), F.sum("w").cast("bigint").alias("num"),
                                    F.sum(F.when(F.col("v").isNull(), F.col("w")).otherwise(F.lit(0))).cast("bigint").alias("num_missing"))
    pos = F.col("i") + F.lit(1)

    def by_column(values):
        return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), pos)
    return per_col.select(by_column(cols).alias("column"), by_column(dtypes[c] for c in cols).alias("dtype"), "num_missing", "num", "nunique",
                          by_column([None if row is None else row[c] for c in cols]).alias("sample_value"))


def histogram_bins(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Counts in ``bins`` equal-width bins between the column's min and max (last bin
    closed, as numpy does).  min / max are scalar subqueries."""
    c = F.col(column).cast("double")
    stats = df.agg(F.struct(F.min(c).alias("lo"), F.max(c).alias("hi"))).scalar()
    lo, hi = stats["lo"], stats["hi"]
    width = (hi - lo) / F.lit(float(bins))
    raw = F.floor(F.try_divide(c - lo, width))
    b = F.when(hi == lo, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")
    return (df.where(c.isNotNull()).groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("count"))
            .select("bin", (lo + F.col("bin") * width).alias("bin_start"),
                    (lo + (F.col("bin") + 1) * width).alias("bin_end"), "count"))


def top_values(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    """The ``k`` most frequent values per column, all columns in one pass.

    Columns are stacked to (column, value) and counted together, then a per-column rank keeps
    the top ``k``; ties broken by value so the answer is repeatable.  The rank filter lets
    Spark cut each partition to ``k`` rows per column before the window's shuffle.
    """
    from pyspark.sql import Window
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns
    ])).alias("kv")).select("kv.*")
    counts = stacked.groupBy("column", "value").agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    w = Window.partitionBy("column").orderBy(F.col("count").desc(), F.col("value").asc_nulls_first())
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
