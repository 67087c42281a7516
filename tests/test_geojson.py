"""GeoJSON layers of one feature a line: mixed depths, holes, odd features, written and read back."""

import json

import pytest

from kitchenlens.operators import geo
from kitchenlens.sources import files

SQUARE = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
HOLE = [[1, 1], [3, 1], [3, 3], [1, 3], [1, 1]]


def feature(name, kind, coordinates, **more):
    return {"type": "Feature", "properties": {"AREA_NAME": name, **more}, "geometry": coordinates and {"type": kind, "coordinates": coordinates}}


def moved(ring, dx):
    return [[x + dx, *rest] for x, *rest in ring]


FEATURES = [
    feature("plain", "Polygon", [SQUARE], size=1.5), feature("holed", "Polygon", [moved(SQUARE, 10), moved(HOLE, 10)]),
    feature("parts", "MultiPolygon", [[moved(SQUARE, 20), moved(HOLE, 20)], [moved(SQUARE, 30)]]), feature("high", "Polygon", [[[x + 40, y, 7.5] for x, y in SQUARE]]),
    feature("open", "Polygon", [moved(SQUARE, 50)[:-1]]), feature("point", "Point", [1.0, 2.0]), feature("nothing", None, None), feature("comma, }", "Polygon", [moved(SQUARE, 60)])]


def check(spark, path):
    layer = files.read_geojson_features(spark, path, ["AREA_NAME", "size"])
    rows = {r.AREA_NAME: r for r in layer.collect()}
    assert set(rows) == {f["properties"]["AREA_NAME"] for f in FEATURES}
    assert [len(r) for r in rows["parts"].geometry] == [5, 5, 5] and rows["parts"].geometry_type == "MultiPolygon"
    assert rows["point"].geometry is None and rows["nothing"].geometry is None and rows["plain"].size == "1.5" and rows["holed"].size is None
    assert tuple(rows["open"].geometry[0][-1]) == (50.0, 0.0) and tuple(rows["high"].geometry[0][1]) == (44.0, 0.0)
    pts = spark.createDataFrame([(i, float(x), 2.0 if i % 2 else 0.5) for i, x in enumerate([2, 2, 12, 12, 22, 22, 32, 32, 42, 42, 52, 52, 62, 62, 1])], "id int, longitude double, latitude double")
    got = {r.id: r.AREA_NAME for r in geo.point_in_polygon(pts, layer, keep=["AREA_NAME"]).collect()}
    assert got == {0: "plain", 1: "plain", 2: "holed", 4: "parts", 6: "parts", 7: "parts", 8: "high", 9: "high", 10: "open", 11: "open", 12: "comma, }", 13: "comma, }", 14: "plain"}


def test_newline_delimited(spark, scratch):
    with open(f"{scratch}/layer.geojsonl", "w") as out:
        out.write("\n".join(json.dumps(f) for f in FEATURES) + "\n\n")
    check(spark, f"{scratch}/layer.geojsonl")


def test_collection_with_a_feature_on_each_line(spark, scratch):
    with open(f"{scratch}/layer.geojson", "w") as out:
        out.write('{\n"type": "FeatureCollection",\n"name": "areas",\n"crs": { "type": "name" },\n"features": [\n')
        out.write(",\n".join("  " + json.dumps(f) for f in FEATURES) + "\n]\n}\n")
    check(spark, f"{scratch}/layer.geojson")


def test_a_broken_feature_fails_the_read(spark, scratch):
    with open(f"{scratch}/broken.geojsonl", "w") as out:
        out.write(json.dumps(FEATURES[0]) + "\n" + json.dumps(FEATURES[1])[:-9] + "\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        files.read_geojson_features(spark, f"{scratch}/broken.geojsonl", ["AREA_NAME"]).collect()


def test_write_and_read(spark, scratch):
    def ring(r):
        return [{"lon": float(x), "lat": y + 1 / 3} for x, y in r]
    rows = [("a", 1.5, [[ring(SQUARE)]]), ("b", None, [[ring(SQUARE), ring(HOLE)]]), ("c", 2.0, [[ring(SQUARE), ring(HOLE)], [ring(moved(SQUARE, 9))]]), ('d"\n', 0.0, [])]
    areas = spark.createDataFrame(rows, "AREA_NAME string, size double, polygons array<array<array<struct<lon:double,lat:double>>>>").repartition(3)
    files.write_geojson_features(areas, f"{scratch}/out", ["AREA_NAME", "size"])
    got = {r.AREA_NAME: r for r in files.read_geojson_features(spark, f"{scratch}/out", ["AREA_NAME", "size"]).collect()}
    for name, size, polygons in rows:
        assert [[p.asDict() for p in r] for r in got[name].geometry] == [r for poly in polygons for r in poly]
        assert got[name].size == (None if size is None else str(size)) and got[name].geometry_type == ("Polygon" if len(polygons) == 1 else "MultiPolygon")
