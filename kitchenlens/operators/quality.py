"""Data-quality expectations: a predicate over rows → a one-row report of violations.

A violation does not stop the job unless ``raise_on_violation`` is set; the report is a normal
DataFrame (expectation, rows checked, violations), computed in one aggregation pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def expect(df: DataFrame, violated: Column, name: str) -> DataFrame:
    """Rows where ``violated`` is true count as violations (NULL counts as no violation)."""
    return df.agg(F.lit(name).alias("expectation"),
                  F.count(F.lit(1)).cast("bigint").alias("num_rows"),
                  F.count(F.when(violated, 1)).cast("bigint").alias("num_violations"))


def assert_expectation(report: DataFrame) -> None:
    """Raise when a report has violations (driver sees one small row)."""
    row = report.first()
    if row["num_violations"]:
        raise AssertionError(f"{row['expectation']}: {row['num_violations']} of {row['num_rows']} rows violate")


def expect_no_na(inspections: DataFrame) -> DataFrame:
    """K1: no inspection carries an NA-severity count."""
    return expect(inspections, F.col("num_na") > 0, "no_na_severity")


def expect_recount(recount: DataFrame) -> DataFrame:
    """K2: per establishment, ids counted = dates counted."""
    return expect(recount, F.col("num_inspection_ids") != F.col("num_inspection_dates"), "ids_equal_dates")


def expect_recount_total(recount: DataFrame, inspections: DataFrame) -> DataFrame:
    """K2, second half: the establishments' counts add up to the inspection rows."""
    total = recount.agg(F.sum("num_inspection_ids").cast("bigint")).scalar()
    rows = inspections.agg(F.count(F.lit(1)).cast("bigint")).scalar()
    return inspections.sparkSession.range(1).select(F.lit("recount_equals_rows").alias("expectation"), total.alias("recounted"),
                                                    rows.alias("num_rows"), (total == rows).alias("ok"))


def expect_rows_equal(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """K2/K6/K7: two row counts must agree (e.g. before and after a left join).

    Both counts are scalar subqueries of one-row aggregates, so nothing is joined.
    """
    na = a.agg(F.count(F.lit(1)).cast("bigint").alias("n")).scalar()
    nb = b.agg(F.count(F.lit(1)).cast("bigint").alias("n")).scalar()
    spark = a.sparkSession
    return spark.range(1).select(F.lit(name).alias("expectation"), na.alias("rows_before"),
                                 nb.alias("rows_after"), (na == nb).alias("ok"))


def expect_single_status(status_counts: DataFrame) -> DataFrame:
    """K3: every inspection has exactly one status."""
    return expect(status_counts, F.col("num_statuses") != 1, "one_status_per_inspection")


def expect_count(df: DataFrame, expected: int, name: str) -> DataFrame:
    """K4: a table has exactly ``expected`` rows (e.g. the number of areas)."""
    return df.agg(F.lit(name).alias("expectation"), F.count(F.lit(1)).cast("bigint").alias("num_rows"),
                  F.lit(expected).cast("bigint").alias("expected"),
                  (F.count(F.lit(1)) == F.lit(expected)).alias("ok"))


def expect_population(stats: DataFrame, column: str = "neigh_pop_2016") -> DataFrame:
    """K5: no area without a population figure."""
    return expect(stats, F.col(column).isNull(), "population_present")


def expect_unique(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """K8: a lookup has one row per key (otherwise a left join would multiply rows)."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return expect(dup, F.col("_n") > 1, name)

