"""History features on one hand-made establishment."""

import datetime as dt

from kitchenlens.operators import features as ft

D = dt.date


def frame(spark):
    recs = [(10, D(2024, 1, 1), "Pass", 1, 0, 0, 1),        # Monday
            (11, D(2024, 1, 11), "Closed", 0, 2, 0, 0),
            (12, D(2024, 2, 1), "Conditional Pass", 0, 0, 1, 2)]
    return spark.createDataFrame(
        [(7, "Restaurant", "7 ST", i, d, s, mi, si, cr, t, 0, 0) for i, d, s, mi, si, cr, t in recs],
        "establishment_id bigint, establishmenttype string, establishment_address string, inspection_id bigint, "
        "inspection_date date, establishment_status string, num_minor bigint, num_significant bigint, "
        "num_crucial bigint, num_ticket bigint, action_null bigint, court_outcome_null bigint")


def test_history_features(spark):
    out = ft.history_features(frame(spark), ["num_ticket", "action_null"], ["court_outcome_null"])
    r = {x["inspection_id"]: x for x in out.collect()}
    assert r[10]["time_since_last_infrac"] is None and r[11]["time_since_last_infrac"] == 10
    assert r[11]["days_since_last_inspection"] == -10
    assert (r[10]["last_pass"], r[11]["last_pass"], r[12]["last_pass"]) == (False, True, False)
    assert r[12]["num_significant_prev"] == 2 and r[10]["num_significant_prev"] is None
    assert r[12]["num_action_ticket_prev"] == 0 and r[11]["num_action_ticket_prev"] == 1
    # totals include the current row (as the source computes them)
    assert [r[i]["cumulative_failures"] for i in (10, 11, 12)] == [0, 1, 1]
    assert [r[i]["cumulative_significant"] for i in (10, 11, 12)] == [0, 2, 2]
    assert r[11]["ever_significant"] and not r[10]["ever_significant"]
    # running totals of the lagged counts: NULL on the first row
    assert [r[i]["cumulative_num_action_ticket_prev"] for i in (10, 11, 12)] == [None, 1, 1]
    assert [r[i]["cumulative_inspections"] for i in (10, 11, 12)] == [0, 1, 2]
    assert r[10]["proportion_past_failures"] is None and r[12]["proportion_past_failures"] == 0.5
    assert r[10]["inspection_weekday"] == 0 and r[10]["inspection_weekofyear"] == 1
    assert r[11]["last_inspection_month"] == 1 and r[10]["last_inspection_year"] is None


def test_exclusive_totals(spark):
    out = ft.history_features(frame(spark), [], [], exclude_current=True)
    r = {x["inspection_id"]: x for x in out.collect()}
    assert [r[i]["cumulative_significant"] for i in (10, 11, 12)] == [None, 0, 2]
    assert not r[11]["ever_significant"]


def _hot_frame(spark):
    import random
    rnd = random.Random(7)
    statuses = ["Pass", "Conditional Pass", "Closed"]
    recs = []
    for est, n in ((1, 60), (2, 3), (3, 1)):
        for i in range(n):
            d = dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(0, 300))
            recs.append((est, "Restaurant", f"{est} ST", est * 1000 + i, d, rnd.choice(statuses),
                         rnd.randrange(0, 3), rnd.randrange(0, 2), rnd.randrange(0, 2), rnd.choice([0, 1, None]), 0, 1))
    return spark.createDataFrame(
        recs, "establishment_id bigint, establishmenttype string, establishment_address string, inspection_id bigint, "
              "inspection_date date, establishment_status string, num_minor bigint, num_significant bigint, "
              "num_crucial bigint, num_ticket bigint, action_null bigint, court_outcome_null bigint")


def _rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def test_split_hot_groups_equals_plain_window(spark):
    df = _hot_frame(spark)
    for excl in (False, True):
        plain = ft.history_features(df, ["num_ticket", "action_null"], ["court_outcome_null"], exclude_current=excl)
        split = ft.history_features(df, ["num_ticket", "action_null"], ["court_outcome_null"], exclude_current=excl,
                                    hot_group_rows=10, chunk_rows=7)
        assert _rows(plain) == _rows(split)


def test_one_window_makes_all_history_features(spark):
    from kitchenlens.constants import EST
    df = spark.range(6).selectExpr(*[f"'a' as `{c}`" for c in EST], "id as inspection_id", "date_add(date'2020-01-01', int(id)) as inspection_date", "'Pass' as establishment_status",
                                   *[f"id as num_{t}" for t in ft.INFRACTION_TYPES], "if(id % 3 = 1, null, id) as num_ticket")
    out = ft.history_features(df, ["num_ticket"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1
    rows = out.orderBy("inspection_id").collect()
    assert [r.cumulative_num_action_ticket_prev for r in rows] == [None, 0, 0, 2, 5, 5]
    assert [r.num_action_ticket_prev for r in rows] == [None, 0, None, 2, 3, None]
