"""Hierarchical polygon cover: the same answers as the test against the whole outline, few cells, both join paths."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kitchenlens.operators import cover, geo

SCHEMA = "AREA_NAME string, geometry array<array<struct<lon:double,lat:double>>>"


def ring(points):
    points = [*points, points[0]]
    return [{"lon": float(x), "lat": float(y)} for x, y in points]


def star(rnd, x, y, radius, corners):
    turn = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(corners))
    return ring([(x + radius * rnd.uniform(0.3, 1) * math.cos(t), y + radius * rnd.uniform(0.3, 1) * math.sin(t)) for t in turn])


def square(x0, y0, x1, y1):
    return ring([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])


def layer():
    rnd = random.Random(11)
    rows = [("continent", [star(rnd, 3, -2, 40, 700)]), ("holed", [star(rnd, -5, 5, 12, 90), star(rnd, -5, 5, 2.5, 40)]),
            ("parts", [square(-1, -1, 0.5, 0.5), square(8, 8, 9, 9), square(0.5, 0.5, 1, 1)]), ("comb", [ring([p for i in range(60) for p in ((i / 4, 0), (i / 4 + 0.125, 6))] + [(15, -1), (0, -1)])]),
            ("empty", []), ("none", None), ("short", [[{"lon": 1.0, "lat": 1.0}], []])]
    return rows + [(f"small{i}", [star(rnd, rnd.uniform(-20, 20), rnd.uniform(-20, 20), 0.4, rnd.randrange(3, 12))]) for i in range(40)]


def points(rows):
    rnd = random.Random(12)
    out = [(rnd.uniform(-45, 45), rnd.uniform(-45, 45)) for _ in range(1500)] + [(rnd.uniform(-1, 16), rnd.uniform(-1, 7)) for _ in range(800)]
    for _, geometry in rows:
        for r in geometry or []:
            for a, b in zip(r[:40], r[1:]):       # vertices, points on edges, and near them
                out += [(a["lon"], a["lat"]), ((a["lon"] + b["lon"]) / 2, (a["lat"] + b["lat"]) / 2), (a["lon"] + 1e-9, a["lat"]), (b["lon"], a["lat"])]
    out += [(round(x * 2) / 2, round(y * 4) / 4) for x, y in out[:400]]       # cell borders
    return [(i, x, y) for i, (x, y) in enumerate(out)] + [(-1, None, 1.0), (-2, 1.0, None)]


@pytest.mark.parametrize("cell,max_cells,max_edges,broadcast", [(0.25, 256, 32, True), (0.01, 24, 2, False), (1.0, 2000, 1, True), (100.0, 4, 1, False)])
def test_same_as_the_whole_outline(spark, cell, max_cells, max_edges, broadcast):
    rows = layer()
    areas, pts = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(points(rows), "id int, longitude double, latitude double")
    bounds = {} if broadcast else {"max_broadcast_cells": 0, "max_broadcast_vertices": 0}
    got = geo.point_in_polygon(pts, areas, cell=cell, max_cells=max_cells, max_edges=max_edges, **bounds).select("id", "AREA_NAME").collect()
    want = pts.crossJoin(areas).where(geo.contains_point(F.col("geometry"), F.col("longitude"), F.col("latitude"))).select("id", "AREA_NAME").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) > 1000


def outline(rows, cell):
    ends = [np.array([e[side][axis] for r in rows for e in ({"a": a, "b": b} for a, b in zip(r, r[1:]))]) for side in "ab" for axis in ("lon", "lat")]
    return cover.Outline(*ends, cell)


@pytest.mark.parametrize("max_cells", [8, 64, 256])
def test_cells_are_bounded_and_do_not_overlap(max_cells):
    rows = [ring([((30 + 3 * math.sin(9 * t)) * math.cos(t), (30 + 3 * math.sin(9 * t)) * math.sin(t)) for t in np.linspace(0, 2 * math.pi, 4001)[:-1]])]
    cells = outline(rows, 0.01).cover(max_cells, 32)
    assert len(cells) <= max_cells
    spans = {(k, x, y) for k, x, y, *_ in cells}
    assert len(spans) == len(cells)
    assert not any((up, x >> (up - k), y >> (up - k)) in spans for k, x, y in spans for up in range(k + 1, 20))
    if max_cells == 256:        # most of the area needs no test, and an edge cell has few of the 4000 edges
        inside = sum(4.0 ** c[0] for c in cells if c[3])
        assert inside > 0.5 * sum(4.0 ** c[0] for c in cells)
        assert np.mean([len(c[5]) for c in cells if not c[3]]) < 120


def test_a_simple_outline_is_not_split():
    assert len(outline([square(-170, -80, 170, 80)], 0.01).cover(256, 32)) <= 4


def test_no_polygon_and_no_point(spark):
    areas = spark.createDataFrame([], SCHEMA)
    pts = spark.createDataFrame([(1, 0.5, 0.5)], "id int, longitude double, latitude double")
    assert geo.point_in_polygon(pts, areas).collect() == []
    assert geo.point_in_polygon(pts.limit(0), spark.createDataFrame(layer(), SCHEMA)).collect() == []
