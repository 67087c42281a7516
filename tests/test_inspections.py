"""Stage 2 semantics on tiny hand-made frames (quirks Q2, Q5, Q6, Q7, Q10)."""

import datetime as dt

from kitchenlens.operators import inspections as insp

D = dt.date


def rows(spark, recs):
    base = dict(establishment_id=1, establishmenttype="Restaurant", establishment_address="1 MAIN ST",
                inspection_id=10, inspection_date=D(2020, 1, 1), establishment_status="Pass",
                infraction_details="x", severity="M - Minor", action=None, court_outcome=None)
    schema = ("establishment_id bigint, establishmenttype string, establishment_address string, "
              "inspection_id bigint, inspection_date date, establishment_status string, "
              "infraction_details string, severity string, action string, court_outcome string")
    order = [f.split()[0] for f in schema.split(", ")]
    return spark.createDataFrame([tuple({**base, **r}[c] for c in order) for r in recs], schema)


def test_type_filter_precedence(spark):
    df = rows(spark, [dict(establishmenttype="Private Club", severity="S - Significant"),
                      dict(establishmenttype="Private Club", severity=None),
                      dict(establishmenttype="Restaurant", severity=None),
                      dict(severity="NA - Not Applicable")])
    assert insp.valid_infractions(df).count() == 2          # unwanted type with S kept (Q2)
    assert insp.valid_infractions(df, strict_types=True).count() == 1


def test_pivot_counts_groups_and_rows(spark):
    df = rows(spark, [dict(action="Ticket", court_outcome="Pending", infraction_details="a"),
                      dict(action="Ticket", court_outcome="Pending", infraction_details="b"),
                      dict(action=None, court_outcome=None, infraction_details="c")])
    acts, outs = ["Ticket", None], ["Pending", None]
    g = insp.inspections_aggregate(df, acts, outs).first()
    assert g["num_ticket"] == 1 and g["num_pending"] == 1          # inner groups (Q5)
    assert g["action_null"] == 1 and g["court_outcome_null"] == 1   # NULL is its own value (Q6)
    r = insp.inspections_aggregate(df, acts, outs, pivot_counts="rows").first()
    assert r["num_ticket"] == 2
    assert g["infractions_summary"] == "a. b. c"                    # sorted, joined twice (Q7)
    assert g["num_minor"] == 3 and g["num_infractions"] == 3


def test_summary_null_when_all_details_null(spark):
    df = rows(spark, [dict(infraction_details=None, severity=None)])
    g = insp.inspections_aggregate(df, [None], [None]).first()
    assert g["infractions_summary"] is None and g["num_infractions"] == 0


def test_multi_day_inspection_removed(spark):
    df = rows(spark, [dict(inspection_id=10, inspection_date=D(2020, 1, 1)),
                      dict(inspection_id=10, inspection_date=D(2020, 1, 2)),
                      dict(inspection_id=11, inspection_date=D(2020, 3, 1))])
    agg = insp.inspections_aggregate(df, [None], [None])
    assert insp.multi_day_inspections(agg).count() == 1
    kept = insp.single_day_inspections(agg)
    assert [r["inspection_id"] for r in kept.collect()] == [11]


def test_reinspection_default_drops_first_of_close_pair(spark):
    # ids in date order; visits 1 day apart → the gap sits on the earlier row (Q10)
    df = rows(spark, [dict(inspection_id=1, inspection_date=D(2020, 1, 1)),
                      dict(inspection_id=2, inspection_date=D(2020, 1, 2)),
                      dict(inspection_id=3, inspection_date=D(2020, 6, 1))])
    agg = insp.by_establishment(insp.single_day_inspections(insp.inspections_aggregate(df, [None], [None])))
    default = sorted(r["inspection_id"] for r in insp.no_reinspections(agg).collect())
    strict = sorted(r["inspection_id"] for r in insp.no_reinspections(agg, strict=True).collect())
    assert default == [2, 3]
    assert strict == [1, 3]


def test_label_and_class_balance(spark):
    df = rows(spark, [dict(inspection_id=1, severity="S - Significant"),
                      dict(inspection_id=2, inspection_date=D(2020, 5, 1), severity="M - Minor"),
                      dict(inspection_id=3, inspection_date=D(2020, 9, 1), severity="C - Crucial")])
    lab = insp.labelled_inspections(df, [None], [None])
    got = {r["inspection_id"]: r["is_infraction"] for r in lab.collect()}
    assert got == {1: 1, 2: 0, 3: 1}
    bal = {r["is_infraction"]: (r["num_inspections"], round(r["fraction"], 4))
           for r in insp.class_balance(lab).collect()}
    assert bal == {1: (2, 0.6667), 0: (1, 0.3333)}


def test_gap_to_next_split_equals_plain(spark):
    import random
    rnd = random.Random(3)
    recs = [dict(inspection_id=i, inspection_date=D(2020, 1, 1) + dt.timedelta(days=rnd.randrange(0, 200)),
                 establishment_status=rnd.choice(["Pass", "Closed"])) for i in range(1, 80)]
    recs += [dict(establishment_id=2, establishment_address="2 ST", inspection_id=500 + i,
                  inspection_date=D(2021, 1, 1) + dt.timedelta(days=3 * i)) for i in range(4)]
    agg = insp.single_day_inspections(insp.inspections_aggregate(rows(spark, recs), [None], [None]))
    plain = insp.with_days_to_next(insp.by_establishment(agg))
    split = insp.with_days_to_next(agg, hot_group_rows=10, chunk_rows=6)
    key = lambda r: (r["establishment_id"], r["inspection_id"], r["establishment_status"])
    assert sorted((key(r), r["days_to_next"]) for r in plain.collect()) == \
        sorted((key(r), r["days_to_next"]) for r in split.collect())
