"""Plan shape: shuffles, no cartesian products, no Python in the row path; driver contract."""

import re

from conftest import SF001
from kitchenlens.plans import catalog as c


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(pattern, text):
    return len(re.findall(pattern, text))


def test_flagship_plan(spark):
    p = plan_of(c.labelled(spark, SF001, hot_group_rows=None))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p
    # (establishment id, inspection id) for both aggregates and the multi-day window, then the
    # establishment key for the gap window
    assert count(r"Exchange hashpartitioning", p) == 2
    assert count(r"Window \[", p) >= 2


def test_flagship_default_reads_once_where_nothing_is_hot(spark):
    assert c.split_args(spark, SF001) == {}
    p = plan_of(c.labelled(spark, SF001))
    # the raw tables were joined and written once; the plan reads that table alone
    assert "lineitem" not in p and len(re.findall(r"FileScan parquet[^\n]*tables/infractions-", p)) == 1
    assert count(r"Exchange hashpartitioning", p) == count(r"Exchange hashpartitioning", plan_of(c.labelled(spark, SF001, hot_group_rows=None)))


def test_each_query_joins_the_raw_tables_once(spark, monkeypatch):
    """Pivot values, hot keys, aggregates and coordinates read one hand-off table; the next query makes its own."""
    made = []
    plain = c.infractions
    monkeypatch.setattr(c, "infractions", lambda *a: made.append(1) or plain(*a))
    c.QUERIES["crime_fill_by_year"](spark, SF001)
    assert len(made) == 1
    c.QUERIES["inspection_label"](spark, SF001)
    assert len(made) == 2


def test_flagship_splits_hot_establishments(spark):
    split = c.split_args(spark, SF001, hot_group_rows=20)
    assert set(split) == {"hot_group_rows", "hot"}
    p = plan_of(c.labelled(spark, SF001, chunk_rows=5, **split))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    specs = [re.sub(r"#\d+L?", "", m) for m in re.findall(r"Window \[.*?\], \[([^\]]*)\]", p)]
    est = "establishment_id, establishmenttype, establishment_address"
    assert est + ", _chunk" in specs            # the gap scan runs per (establishment, chunk)
    assert specs.count(est) <= 1                # only the carry table (one row per hot chunk)


def test_features_add_no_extra_exchange(spark):
    base = count(r"Exchange hashpartitioning", plan_of(c.labelled(spark, SF001)))
    feats = count(r"Exchange hashpartitioning", plan_of(c.featured(spark, SF001)))
    assert feats - base <= 1          # all history windows share one spec → at most one exchange


def test_scan_pruning(spark):
    p = c.infractions(spark, SF001).select("inspection_id", "action")._jdf.queryExecution().executedPlan().toString()
    schemas = {m[0]: m[1] for m in re.findall(r"FileScan parquet[^\n]*?(lineitem|orders|customer)\.parquet[^\n]*ReadSchema: struct<([^>]*)>", p)}
    assert schemas == {"lineitem": "l_orderkey:bigint,l_linenumber:int", "orders": "o_orderkey:bigint,o_custkey:bigint", "customer": "c_custkey:bigint"}


def test_entry_and_contract(spark):
    import __spark_entry__ as ent
    df = ent.entry(spark)
    assert df.count() > 0
    assert set(ent.oracle_sql()) <= set(ent.queries())
    assert "inspection_label" in ent.oracle_sql()


def test_spatial_join_has_no_nested_loop(spark):
    p = plan_of(c.located(spark, SF001))
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_profile_table_values_and_plan(spark):
    from kitchenlens.operators import explore as ex
    df = spark.createDataFrame([(0.0, "a", 1), (-0.0, None, 1), (None, "b", 2), (float("nan"), "a", None)],
                               "x double, y string, z int")
    got = {r["column"]: r.asDict() for r in ex.profile_table(df).collect()}
    assert [got[k]["num"] for k in "xyz"] == [4, 4, 4]
    assert [got[k]["num_missing"] for k in "xyz"] == [1, 1, 1]
    assert [got[k]["nunique"] for k in "xyz"] == [2, 2, 2]      # -0.0 equals 0.0; NaN is one value
    assert {got[k]["sample_value"] for k in "xyz"} == {"0.0", "a", "1"}   # the smallest complete row
    assert got["x"]["dtype"] == "double"
    empty = ex.profile_table(df.where("z > 99")).collect()
    assert sorted((r["column"], r["num"], r["nunique"]) for r in empty) == [("x", 0, 0), ("y", 0, 0), ("z", 0, 0)]
    # hash aggregates over one written input, no per-distinct-column row expansion, no subquery
    p = plan_of(ex.profile_table(c.labelled(spark, SF001)))
    assert "Expand" not in p and "Subquery" not in p and "SortAggregate" not in p
    assert count("FileScan parquet", p) == 1 and "lineitem" not in p


def test_hot_groups_broadcast_only_after_their_count(spark, monkeypatch):
    from kitchenlens.operators import ordered
    df = spark.range(0, 100).selectExpr("id % 3 AS g", "id AS v")

    def hinted():
        out = ordered.assign_chunks(df, ["g"], "v", 5, chunk_rows=5)
        return "strategy=broadcast" in out._jdf.queryExecution().optimizedPlan().toString()

    assert hinted()                     # three hot groups were counted
    monkeypatch.setattr(ordered, "MAX_BROADCAST_HOT_GROUPS", 2)
    assert not hinted()                 # more than the bound: left to AQE


def test_model_table_takes_no_texts_or_pivoted_counts(spark):
    from kitchenlens.plans import catalog
    full = catalog.full_table(spark, "/root/testdata/sf0.001")
    assert "infractions_summary" not in full.columns and not [c for c in full.columns if "ticket" in c]
    assert catalog.task_count(spark, "/root/testdata/sf0.001") is None
    rows = catalog.handed_over(spark, "/root/testdata/sf0.001").count()
    assert catalog.task_count(spark, "/root/testdata/sf0.001", rows_per_task=100) == -(-rows // 100)
