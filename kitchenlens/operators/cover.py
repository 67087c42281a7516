"""Hierarchical grid cover of polygons: cells of sizes ``cell`` · 2^k, few per polygon, small where the outline is.

A cell wholly inside its polygon needs no further test.  Any other cell holds the edges that a ray from a
point in it towards larger longitudes can meet, and the parity of those it meets wherever it starts; so the
even-odd test inside the cell gives what the test against the whole outline gives.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # executors need no copy of the library

#: Cells of a polygon at most, and edges in a cell below which it isn't split.
MAX_CELLS, MAX_EDGES = 256, 32
#: Cells are judged a little larger than they are: a point on a border counts for either side.
MARGIN = 1e-6
COVER = "_pid long, _k int, _cx long, _cy long, _inside boolean, _odd boolean, _edges array<struct<a:struct<lon:double,lat:double>,b:struct<lon:double,lat:double>>>"


class Outline:
    """The edges of one polygon (a to b) and the questions a cell asks them."""

    def __init__(self, ax, ay, bx, by, cell: float):
        self.ax, self.ay, self.bx, self.by, self.cell = ax, ay, bx, by, cell
        self.west, self.east, self.south, self.north = np.minimum(ax, bx), np.maximum(ax, bx), np.minimum(ay, by), np.maximum(ay, by)

    def crossings(self, at: np.ndarray, lon: float, lat: float) -> int:
        """How many of the edges ``at`` a ray from the point to larger longitudes crosses."""
        at = at[(self.ay[at] > lat) != (self.by[at] > lat)]
        ax, ay, bx, by = self.ax[at], self.ay[at], self.bx[at], self.by[at]
        return int((lon < (bx - ax) * (lat - ay) / (by - ay) + ax).sum())

    def judge(self, k: int, cx: int, cy: int, at: np.ndarray, odd: bool):
        """(edges that touch the cell, edges its points need, parity of those they need not); ``at`` and ``odd`` are its parent's."""
        size, slack = self.cell * 2.0 ** k, self.cell * MARGIN
        x0, x1, y0, y1 = cx * size - slack, (cx + 1) * size + slack, cy * size - slack, (cy + 1) * size + slack
        at = at[(self.north[at] >= y0) & (self.south[at] <= y1)]
        ax, ay, dx, dy = self.ax[at], self.ay[at], self.bx[at] - self.ax[at], self.by[at] - self.ay[at]
        sides = [dx * (y - ay) - dy * (x - ax) for x in (x0, x1) for y in (y0, y1)]     # of the cell's corners
        apart = (np.minimum.reduce(sides) > 0) | (np.maximum.reduce(sides) < 0)
        touch = (self.east[at] >= x0) & (self.west[at] <= x1) & ~apart
        whole = ~touch & (self.south[at] < y0) & (self.north[at] > y1)     # met by the rays of all points, or of none
        odd ^= bool(self.crossings(at[whole], (x0 + x1) / 2, (y0 + y1) / 2) & 1)
        need = touch | (~whole & (self.east[at] >= x0))
        return at[touch], at[need], odd

    def cover(self, max_cells: int, max_edges: int) -> list[tuple]:
        """(k, cx, cy, inside, odd, edges) of at most ``max_cells`` disjoint cells that hold the polygon.

        It starts with the up to four cells of the least size that the bounding box does not exceed; the cell that the most
        edges touch is split next, until no cell has more than ``max_edges`` or there are enough cells."""
        box = [int(np.floor(v / self.cell)) for v in (self.west.min(), self.east.max(), self.south.min(), self.north.max())]
        k = max(0, max(box[1] - box[0], box[3] - box[2]).bit_length())
        done, queue = [], []

        def place(k, cx, cy, at, odd):
            touch, need, odd = self.judge(k, cx, cy, at, odd)
            if len(touch):
                heappush(queue, (-len(touch), k, cx, cy, odd, need))
            elif odd ^ bool(self.crossings(need, (cx + 0.5) * self.cell * 2.0 ** k, (cy + 0.5) * self.cell * 2.0 ** k) & 1):
                done.append((k, cx, cy, True, False, need[:0]))

        every = np.arange(len(self.ax))
        for cx in range(box[0] >> k, (box[1] >> k) + 1):
            for cy in range(box[2] >> k, (box[3] >> k) + 1):
                place(k, cx, cy, every, False)
        waiting = []
        while queue:
            most, k, cx, cy, odd, need = heappop(queue)
            if -most <= max_edges or k == 0 or len(done) + len(waiting) + len(queue) + 4 > max_cells:
                waiting.append((k, cx, cy, False, odd, need))
                continue
            for x in (2 * cx, 2 * cx + 1):
                for y in (2 * cy, 2 * cy + 1):
                    place(k - 1, x, y, need, odd)
        return done + waiting


def _covers(cell: float, max_cells: int, max_edges: int):
    def covers(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        point = pa.struct([("lon", pa.float64()), ("lat", pa.float64())])
        for batch in batches:
            for i, pid in enumerate(batch["_pid"].to_pylist()):
                ends = [batch[c].slice(i, 1).flatten().to_numpy(zero_copy_only=False).astype(float) for c in ("_ax", "_ay", "_bx", "_by")]
                if not len(ends[0]):
                    continue
                outline = Outline(*ends, cell)
                cells = outline.cover(max_cells, max_edges)
                at = np.concatenate([c[5] for c in cells] or [np.zeros(0, int)])
                stops = np.cumsum([0, *[len(c[5]) for c in cells]]).astype(np.int32)
                a, b = (pa.StructArray.from_arrays([pa.array(x[at]), pa.array(y[at])], fields=list(point)) for x, y in ((ends[0], ends[1]), (ends[2], ends[3])))
                edges = pa.ListArray.from_arrays(pa.array(stops), pa.StructArray.from_arrays([a, b], fields=[pa.field("a", point), pa.field("b", point)]))
                columns = list(zip(*[c[:5] for c in cells])) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array([pid] * len(cells), pa.int64()), pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()),
                                                  pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.bool_()), pa.array(columns[4], pa.bool_()), edges],
                                                 names=["_pid", "_k", "_cx", "_cy", "_inside", "_odd", "_edges"])
    return covers


def polygon_cover(edges: DataFrame, cell: float, max_cells: int = MAX_CELLS, max_edges: int = MAX_EDGES) -> DataFrame:
    """(_pid, _k, _cx, _cy, _inside, _odd, _edges) of polygons given as (_pid, _edges); those without an edge have no cell.

    Cell (_k, _cx, _cy) holds the points with floor(lon / cell) >> _k = _cx, and likewise for the latitude.  Each polygon is covered by itself, in one
    task; the cells of a polygon don't overlap, so a point meets each polygon once at most."""
    def ends(end: str, axis: str):
        return F.transform("_edges", lambda e: e[end][axis])
    flat = edges.where("size(_edges) > 0").select("_pid", ends("a", "lon").alias("_ax"), ends("a", "lat").alias("_ay"), ends("b", "lon").alias("_bx"), ends("b", "lat").alias("_by"))
    return flat.mapInArrow(_covers(cell, max_cells, max_edges), COVER)
