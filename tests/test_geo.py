"""Spatial join, title case, coordinate filling."""

from pyspark.sql import functions as F

from kitchenlens.functions.text import title_case
from kitchenlens.operators import geo


def square(x0, y0, x1, y1):
    return [{"lon": x0, "lat": y0}, {"lon": x1, "lat": y0}, {"lon": x1, "lat": y1}, {"lon": x0, "lat": y1},
            {"lon": x0, "lat": y0}]


def polygons(spark):
    schema = "AREA_NAME string, geometry array<array<struct<lon:double,lat:double>>>"
    return spark.createDataFrame([
        ("A", [square(0.0, 0.0, 1.0, 1.0)]),
        # a square with a square hole, and a second part elsewhere (multi-polygon)
        ("B", [square(2.0, 0.0, 4.0, 2.0), square(2.5, 0.5, 3.5, 1.5), square(5.0, 5.0, 6.0, 6.0)]),
    ], schema)


def test_point_in_polygon_even_odd(spark):
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 3.0, 1.0), (3, 2.2, 0.2), (4, 5.5, 5.5), (5, 9.0, 9.0),
                                 (6, None, 1.0)], "id int, longitude double, latitude double")
    got = {r["id"]: r["AREA_NAME"] for r in geo.point_in_polygon(pts, polygons(spark), cell=0.7).collect()}
    assert got == {1: "A", 3: "B", 4: "B"}   # 2 is in the hole, 5 outside, 6 has no coordinate


def test_point_in_polygon_without_broadcast(spark):
    pts = spark.createDataFrame([(1, 0.5, 0.5), (3, 2.2, 0.2)], "id int, longitude double, latitude double")
    got = geo.point_in_polygon(pts, polygons(spark), cell=0.5, max_broadcast_cells=0, max_broadcast_vertices=0)
    assert sorted(r["id"] for r in got.collect()) == [1, 3]


def test_title_case_matches_python(spark):
    words = ["O'CONNOR ST", "12TH AVE", "mcdonald's-plaza", "ÉCOLE rue", "a1b2 c", "", "X"]
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = [r[0] for r in df.select(title_case("s")).collect()]
    assert got == [w.title() for w in words]


def test_fill_coordinates_prefers_own_then_cache(spark):
    insp = spark.createDataFrame([(1, "Restaurant", "1 MAIN ST"), (2, "Restaurant", "2 SIDE ST")],
                                 "establishment_id bigint, establishmenttype string, establishment_address string")
    infr = spark.createDataFrame([(1, "Restaurant", "1 MAIN ST", 43.7, -79.4), (2, "Restaurant", "2 SIDE ST", None, None)],
                                 "establishment_id bigint, establishmenttype string, establishment_address string, "
                                 "latitude double, longitude double")
    cache = spark.createDataFrame([("2 Side St, Toronto, ON, Canada", None, "Toronto", "x", "M1", 43.8, -79.3),
                                   ("2 Side St, Toronto, ON, Canada", None, "Toronto", "x", "M1", 43.8, -79.3)],
                                  "address string, neighbourhood string, locality string, formattedaddress string, "
                                  "postalcode string, latitude double, longitude double")
    out = {r["establishment_id"]: (r["latitude"], r["longitude"])
           for r in geo.fill_coordinates(insp, infr, cache).collect()}
    assert out == {1: (43.7, -79.4), 2: (43.8, -79.3)}   # duplicate cache rows do not multiply


def test_addresses_to_geocode_anti_join(spark):
    missing = spark.createDataFrame([("2 SIDE ST",), ("3 LANE RD",)], "establishment_address string")
    cache = spark.createDataFrame([("2 Side St, Toronto, ON, Canada",)], "address string")
    got = [r[0] for r in geo.addresses_to_geocode(missing, cache).collect()]
    assert got == ["3 Lane Rd, Toronto, ON, Canada"]


def test_boundary_is_outside(spark):
    on_edge = [(0.0, 0.5), (1.0, 0.5), (0.5, 0.0), (0.5, 1.0), (0.0, 0.0), (1.0, 1.0), (2.5, 1.0), (3.0, 1.5), (2.5, 0.5), (6.0, 5.5)]
    pts = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(on_edge)] + [(99, 0.999, 0.001)], "id int, longitude double, latitude double")
    assert [r["id"] for r in geo.point_in_polygon(pts, polygons(spark), cell=0.3).collect()] == [99]


def test_repeated_polygons_count_once_each(spark):
    pts = spark.createDataFrame([(1, 0.5, 0.5)], "id int, longitude double, latitude double")
    twice = polygons(spark).unionByName(polygons(spark))
    assert geo.point_in_polygon(pts, twice, cell=0.4).count() == 2
    assert geo.point_in_polygon(pts, twice, cell=0.4, max_broadcast_cells=0, max_broadcast_vertices=0).count() == 2
