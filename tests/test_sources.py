"""File round trips: XML snapshots, bulk CSV, JSON catalog, GeoJSON, numbering, streaming ingest."""

import json
import os

import pytest

from kitchenlens.operators import geo
from kitchenlens.sources import files, snapshots as snap
from kitchenlens.streaming.ingest import ingest_snapshots


def _xml(rows, with_coords=True):
    out = ["<ROOT>"]
    for r in rows:
        out.append("<ROW>" + "".join(f"<{k}>{v}</{k}>" for k, v in r.items()
                                     if with_coords or k not in ("LATITUDE", "LONGITUDE")) + "</ROW>")
    return "\n".join(out + ["</ROOT>"])


ROW = {"ESTABLISHMENT_ID": 1, "INSPECTION_ID": 10, "ESTABLISHMENT_NAME": "A", "ESTABLISHMENTTYPE": "Restaurant",
       "ESTABLISHMENT_ADDRESS": "1 MAIN ST", "ESTABLISHMENT_STATUS": "Pass", "INSPECTION_DATE": "2020-01-02",
       "SEVERITY": "M - Minor", "AMOUNT_FINED": "1,250.50", "LATITUDE": "43.7", "LONGITUDE": "-79.4"}


def test_xml_snapshots_union_dedup_provenance(spark, scratch):
    for sid, coords in (("20200101", True), ("20200201", False)):
        os.makedirs(f"{scratch}/{sid}")
        rows = [ROW, {**ROW, "INSPECTION_ID": 11, "AMOUNT_FINED": "n/a"}]
        with open(f"{scratch}/{sid}/snap.xml", "w") as fh:
            fh.write(_xml(rows, coords))
    raw = snap.with_snapshot_id(snap.read_xml_snapshot(spark, f"{scratch}/*/snap.xml"))
    df = snap.normalise_infractions(raw)
    got = sorted((r["filename"], r["inspection_id"], r["amount_fined"], r["latitude"]) for r in df.collect())
    assert got == [(20200101, 10, 1250.5, 43.7), (20200101, 11, None, 43.7),
                   (20200201, 10, 1250.5, None), (20200201, 11, None, None)]
    assert str(df.schema["inspection_date"].dataType) == "DateType()"
    data_only = snap.dedup_full_row(df.drop("latitude", "longitude"), ignore=("filename",))
    assert data_only.count() == 2
    assert snap.dedup_full_row(df).count() == 4


def test_bulk_csv_failfast(spark, scratch):
    good = f"{scratch}/good.csv"
    with open(good, "w") as fh:
        fh.write("a,b,c\n1,\"x, y\",\\N\n2,z,3\n")
    df = files.read_bulk_csv(spark, good, schema=spark.createDataFrame([], "a int, b string, c int").schema)
    assert sorted(tuple(r) for r in df.collect()) == [(1, "x, y", None), (2, "z", 3)]
    bad = f"{scratch}/bad.csv"
    with open(bad, "w") as fh:
        fh.write("a,b,c\n1,x\n")
    with pytest.raises(Exception):
        files.read_bulk_csv(spark, bad, schema=df.schema).collect()


def test_catalog_records_and_geojson(spark, scratch):
    cat = f"{scratch}/cat.json"
    with open(cat, "w") as fh:
        json.dump({"result": {"records": [{"_id": 1, "Neighbourh": "X"}, {"_id": 2, "Neighbourh": "Y"}]}}, fh)
    rec = files.read_catalog_records(spark, cat, rename={"Neighbourh": "AREA_NAME"})
    assert sorted(r["AREA_NAME"] for r in rec.collect()) == ["X", "Y"]
    gj = f"{scratch}/areas.geojson"
    sq = [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]
    hole = [[0.25, 0.25], [0.75, 0.25], [0.75, 0.75], [0.25, 0.75], [0.25, 0.25]]
    far = [[5, 5], [6, 5], [6, 6], [5, 6], [5, 5]]
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"AREA_NAME": "North St.James Town (74)"},
         "geometry": {"type": "Polygon", "coordinates": [sq, hole]}},
        {"type": "Feature", "properties": {"AREA_NAME": "Far"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[x + 2, y] for x, y in sq]], [far]]}}]}
    with open(gj, "w") as fh:
        json.dump(doc, fh)
    areas = geo.fix_area_names(files.read_geojson_areas(spark, gj, ["AREA_NAME"]))
    assert sorted(r["AREA_NAME"] for r in areas.collect()) == ["Far", "North St. James Town (74)"]
    pts = spark.createDataFrame([(1, 0.1, 0.1), (2, 0.5, 0.5), (3, 5.5, 5.5), (4, 2.5, 0.5)],
                                "id int, longitude double, latitude double")
    got = {r["id"]: r["AREA_NAME"] for r in geo.point_in_polygon(pts, areas, cell=0.5).collect()}
    assert got == {1: "North St. James Town (74)", 3: "Far", 4: "Far"}


def test_partition_numbering_contiguous(spark):
    df = spark.range(0, 1003).withColumnRenamed("id", "k")
    out = snap.partition_numbering(df, ["k"], 10)
    rows = sorted((r["k"], r["row_index"], r["part"]) for r in out.collect())
    assert [r[1] for r in rows] == list(range(1003))
    parts = [r[2] for r in rows]
    assert parts == sorted(parts) and set(parts) == set(range(10))
    assert max(parts.count(p) for p in range(10)) - min(parts.count(p) for p in range(10)) <= 1


def test_partition_numbering_with_a_dominant_tie(spark):
    from pyspark.sql import functions as F
    # half the rows share one first-column value; the second column orders them
    df = spark.range(0, 4000).select(F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("k1"),
                                     F.col("id").alias("k2"))
    rows = sorted(snap.partition_numbering(df, ["k1", "k2"], 4).collect(), key=lambda r: r["row_index"])
    assert [r["row_index"] for r in rows] == list(range(4000))
    assert [(r["k1"], r["k2"]) for r in rows] == sorted((r["k1"], r["k2"]) for r in rows)
    assert [r["part"] for r in rows] == [i // 1000 for i in range(4000)]


def test_incremental_append_and_stream(spark, scratch):
    tbl = f"{scratch}/table"
    a = spark.createDataFrame([(1, "x"), (2, "y")], "filename bigint, v string")
    assert sorted(r[0] for r in snap.incremental_append(spark, a, tbl).collect()) == [1, 2]
    b = spark.createDataFrame([(2, "y"), (3, "z")], "filename bigint, v string")
    snap.incremental_append(spark, b, tbl)
    assert spark.read.parquet(tbl).count() == 3            # snapshot 2 skipped the second time

    land, out, ck = f"{scratch}/landing", f"{scratch}/stream_table", f"{scratch}/ckpt"
    os.makedirs(f"{land}/20200101")
    cols = snap.raw_snapshot_schema().fieldNames()     # files carry the declared column order
    header = ",".join(cols)
    line = ",".join(f'"{ROW[c]}"' if c in ROW else "" for c in cols)
    with open(f"{land}/20200101/s.csv", "w") as fh:
        fh.write(header + "\n" + line + "\n")
    ingest_snapshots(spark, f"{land}/*/", out, ck)
    os.makedirs(f"{land}/20200201")
    with open(f"{land}/20200201/s.csv", "w") as fh:
        fh.write(header + "\n" + line + "\n")
    ingest_snapshots(spark, f"{land}/*/", out, ck)
    got = sorted(r["filename"] for r in spark.read.parquet(out).collect())
    assert got == [20200101, 20200201]                        # each file loaded exactly once


def test_table_ddl_and_gzip_parquet(spark, scratch):
    from kitchenlens.constants import ADDRESSINFO_SCHEMA
    name = "kl_test_addressinfo"
    assert files.create_table(spark, name, ADDRESSINFO_SCHEMA, "geocode cache", location=f"{scratch}/tbl")
    assert [f.name for f in spark.table(name).schema.fields] == ADDRESSINFO_SCHEMA.fieldNames()
    assert files.drop_table(spark, name)
    df = spark.range(10).withColumnRenamed("id", "k")
    files.write_parquet_gzip(df, f"{scratch}/gz")
    assert spark.read.parquet(f"{scratch}/gz").count() == 10
    assert any(p.endswith(".gz.parquet") for p in os.listdir(f"{scratch}/gz"))


def test_stage_handoff_round_trip_and_latest(spark, scratch):
    import datetime as dt
    import time
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("establishment_id", T.LongType()),
                           T.StructField("inspection_date", T.DateType()),
                           T.StructField("num_infractions", T.LongType())])
    rows = [(1, dt.date(2020, 1, 2), 3), (2, None, 0), (3, dt.date(2021, 12, 31), None)]
    df = spark.createDataFrame(rows, schema)
    files.write_stage(df, f"{scratch}/stages/s2_old", fmt="csv")
    time.sleep(0.05)
    files.write_stage(df, f"{scratch}/stages/s2_new")
    back = files.read_stage(spark, f"{scratch}/stages/s2_old", schema=schema, fmt="csv")
    assert back.schema == schema
    assert sorted(back.collect(), key=lambda r: r[0]) == sorted(df.collect(), key=lambda r: r[0])
    with pytest.raises(ValueError):
        files.read_stage(spark, f"{scratch}/stages/s2_old", fmt="csv")
    latest = files.latest_stage(spark, f"{scratch}/stages")
    assert latest.endswith("s2_new")
    assert files.read_stage(spark, latest).count() == 3


def test_incremental_append_surfaces_errors(spark, scratch):
    import pytest
    with open(f"{scratch}/broken", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        snap.incremental_append(spark, spark.range(2).withColumnRenamed("id", "filename"), f"{scratch}/broken")


def test_append_check_counts_what_was_there(spark, scratch):
    rows = spark.range(5)
    for want in (5, 10):
        assert tuple(snap.append_and_check(spark, rows, f"{scratch}/t").first()) == (want, want, True)
    assert snap.load_count_check(spark, rows, "count_check_t", expected=6).first()["ok"] is False
    spark.sql("DROP TABLE count_check_t")


def test_contiguous_part_files(spark, scratch):
    df = spark.range(103).selectExpr("102 - id AS k", "'a,b' AS v")
    snap.write_parts_csv(snap.partition_numbering(df, ["k"], 10, n_buckets=4), f"{scratch}/parts")
    back = spark.read.schema("k bigint, v string, part int").option("header", True).csv(f"{scratch}/parts").collect()
    by = {}
    for r in back:
        by.setdefault(r["part"], []).append(r["k"])
    assert len(back) == 103 and sorted(by) == list(range(10))
    assert [max(by[p]) < min(by[p + 1]) for p in range(9)] == [True] * 9 and {len(v) for v in by.values()} == {10, 11}


def test_xml_stream(spark, scratch):
    from kitchenlens.streaming.ingest import ingest_snapshots
    import os
    for i in (1, 2):
        os.makedirs(f"{scratch}/land/{i}")
        with open(f"{scratch}/land/{i}/s.xml", "w") as f:
            f.write(f"<R><ROW><ROW_ID>{i}</ROW_ID><ESTABLISHMENT_ID>7</ESTABLISHMENT_ID><INSPECTION_DATE>2019-01-0{i}</INSPECTION_DATE></ROW></R>")
        ingest_snapshots(spark, f"{scratch}/land/*", f"{scratch}/table", f"{scratch}/ckpt", fmt="xml")
    got = sorted((r["row_id"], str(r["inspection_date"])) for r in spark.read.parquet(f"{scratch}/table").collect())
    assert got == [(1, "2019-01-01"), (2, "2019-01-02")]


def test_active_resource(spark, scratch):
    import json
    from kitchenlens.sources import files as fl
    packs = [{"result": {"resources": [{"id": "a", "datastore_active": False}, {"id": "b", "datastore_active": True}, {"id": "c", "datastore_active": True}]}},
             {"result": {"resources": [{"id": "d", "datastore_active": None}]}}]
    with open(f"{scratch}/p.json", "w") as f:
        f.write("\n".join(map(json.dumps, packs)))
    assert [r["id"] for r in fl.active_resource(spark.read.json(f"{scratch}/p.json")).collect()] == ["b"]


def test_written_xml_snapshots_are_gzipped(spark, scratch):
    from kitchenlens.plans.catalog import land_snapshot
    rows = [(i, "tags & values <" + "x" * i, None if i % 2 else 1.5) for i in range(500)]
    df = spark.createDataFrame(rows, "inspection_id bigint, infraction_details string, latitude double").coalesce(1)
    land_snapshot(df, f"{scratch}/land/7")
    files = [f for f in os.listdir(f"{scratch}/land/7") if f.startswith("part-")]
    assert files and all(f.endswith(".xml.gz") for f in files)
    back = snap.normalise_infractions(snap.with_snapshot_id(snap.read_xml_snapshot(spark, f"{scratch}/land/*")))
    assert sorted((r.inspection_id, r.infraction_details, r.latitude, r.filename) for r in back.collect()) == [(*r, 7) for r in rows]
