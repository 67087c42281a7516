"""Ordered scans of hot groups: the same answer as the plain window, NULLs and outliers included."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kitchenlens.operators import inspections as insp
from kitchenlens.operators.ordered import CHUNK, assign_chunks, chunked_scan, hot_keys


def rows(n=300, seed=3):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        day = None if i % 11 == 0 else dt.date(2000, 1, 1) + dt.timedelta(days=rnd.randrange(200))
        if i == 17:
            day = dt.date(1900, 1, 1)
        if i == 18:
            day = dt.date(2999, 1, 1)
        out.append((rnd.choice(["a", "a", "a", None, "b"]), rnd.choice(["x", None]), day, i, rnd.choice([1, 2, None])))
    return out


SCHEMA = "k1 string, k2 string, d date, id int, v int"
KEYS, ORDER = ["k1", "k2"], ["d", "id"]


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("given,second", [(False, None), (True, None), (False, "id"), (True, "id")])
@pytest.mark.parametrize("tied", [False, True])
def test_split_equals_plain_window(spark, descending, given, second, tied):
    data = rows()
    if tied:        # most rows of a group on two days or on none
        data = [(a, b, None if i % 4 == 0 else dt.date(2000, 1, 1 + i % 2) if i % 4 < 3 else d, None if i % 29 == 0 else i, v) for a, b, d, i, v in data]
        data = [(a, b, d, i if i is not None else -1, v) for a, b, d, i, v in {(r[0], r[1], r[2], r[3]): r for r in data}.values()]
    df = spark.createDataFrame(data, SCHEMA)
    hot = hot_keys(df.select(*KEYS), KEYS, 20) if given else None
    base = assign_chunks(df, KEYS, "d", 20, 4, descending=descending, hot=hot, second_order=second)
    assert base.where("_nch is not null").groupBy(*KEYS).agg(F.countDistinct(CHUNK).alias("n")).agg(F.min("n")).first()[0] > (3 if tied else 5)
    got = chunked_scan(base, KEYS, ORDER, lags={"prev": "id"}, sums={"s": "v"}, exclusive_sums={"x": "v"}, index="i", descending=descending)
    w = Window.partitionBy(*KEYS).orderBy(*[F.col(c).desc() if descending else F.col(c).asc() for c in ORDER])
    want = df.select("*", F.lag("id").over(w).alias("prev"), F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
                     F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("x"), (F.row_number().over(w) - 1).cast("bigint").alias("i"))
    assert sorted(map(tuple, got.select(want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_an_outlier_does_not_gather_the_rest(spark):
    df = spark.range(1000).selectExpr("1 AS g", "CASE WHEN id = 0 THEN 1000000000 ELSE id END AS v")
    sizes = assign_chunks(df, ["g"], "v", 100, 50).groupBy(CHUNK).count().agg(F.max("count")).first()[0]
    assert sizes <= 100


@pytest.mark.parametrize("descending", [False, True])
def test_one_value_does_not_gather_its_rows(spark, descending):
    """A day that holds three quarters of a group, and rows without a day, are cut by the second order column."""
    df = spark.range(8000).selectExpr("1 AS g", "CASE WHEN id % 8 = 0 THEN NULL WHEN id % 8 < 7 THEN 5 ELSE id END AS v", "id")
    sizes = {r["v"]: r for r in assign_chunks(df, ["g"], "v", 100, 500, descending=descending, second_order="id").groupBy(CHUNK).agg(F.count("*").alias("n"), F.max("v").alias("v")).collect()}
    largest = assign_chunks(df, ["g"], "v", 100, 500, descending=descending, second_order="id").groupBy(CHUNK).count().agg(F.max("count")).first()[0]
    assert largest <= 400 and 5 in sizes
    assert assign_chunks(df, ["g"], "v", 100, 500).groupBy(CHUNK).count().agg(F.max("count")).first()[0] >= 6000


def test_no_hot_group_changes_nothing(spark):
    df = spark.createDataFrame(rows(30), SCHEMA)
    assert hot_keys(df.select(*KEYS), KEYS, 1000) is None
    assert assign_chunks(df, KEYS, "d", 1000, 10).select(CHUNK).distinct().collect()[0][0] == 0


def test_pivot_counts_every_value(spark):
    df = spark.createDataFrame([("A-B",), ("AB",), ("new one",), (None,), ("AB",)], "court_outcome string").withColumn("action", F.lit("x"))
    values = insp.pivot_values(df)
    assert values == [["x"], ["A-B", "AB", "new one", None]]
    out = df.agg(*insp.pivot_columns(values[1], "court_outcome", insp.sanitise_outcome, "court_outcome_null"))
    assert out.first().asDict() == {"num_ab": 3, "num_new_one": 1, "court_outcome_null": 1}
    assert insp.pivoted(out, "court_outcome") == ["num_ab", "num_new_one", "court_outcome_null"] and insp.pivoted(out, "action") == []
    with pytest.raises(ValueError):
        insp.pivot_values(spark.range(20).selectExpr("cast(id as string) AS action", "'x' AS court_outcome"), max_values=10)


def test_small_groups_have_few_cuts(spark):
    """A group is cut by its size, so its rows don't carry the most cuts there may be."""
    df = spark.range(200).selectExpr("id % 10 AS g", "id AS v", "id")
    chunks = assign_chunks(df, ["g"], "v", 5, 10, second_order="id").groupBy("g").agg(F.count_distinct(CHUNK).alias("n"), F.max("_nch").alias("nch")).collect()
    assert all(2 <= r.n <= 4 for r in chunks)
