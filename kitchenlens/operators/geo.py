"""Stage 3 and the spatial join: coordinates per establishment, geocode cache, point in polygon.

Set-based throughout: the per-address lookups of the source become anti / left joins, and the
spatial join is an equi-join on the cells of a hierarchical cover (``cover.py``), followed by an exact even-odd
test of the cell's few edges written with native array functions, so the points stay in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import EST, GEOCODE_SUFFIX
from ..functions.text import title_case
from .cover import MAX_CELLS, MAX_EDGES, polygon_cover

# Side tables of the spatial join are broadcast only below these checked sizes.
MAX_BROADCAST_CELLS = 1_000_000        # cells of all covers, and polygons
MAX_BROADCAST_VERTICES = 5_000_000     # edges held by all cells


# ---- coordinates and geocode cache -----------------------------------------------------------

def coords_per_establishment(infractions: DataFrame) -> DataFrame:
    """One (latitude, longitude) per establishment — independent maxima, as the source."""
    return infractions.groupBy(*EST).agg(F.max("latitude").alias("latitude"),
                                         F.max("longitude").alias("longitude"))


def title_address(addresses: DataFrame, column: str = "establishment_address",
                  suffix: str = GEOCODE_SUFFIX) -> DataFrame:
    """Geocoder form of an address — Python-style title case plus the city suffix."""
    return addresses.select(F.concat(title_case(F.col(column)), F.lit(suffix)).alias("address")).distinct()


def addresses_needing_geocode(inspections: DataFrame, infractions: DataFrame) -> DataFrame:
    """Unique addresses of inspected establishments still lacking a coordinate."""
    with_coords = inspections.join(coords_per_establishment(infractions), EST, "left")
    return (with_coords.where(F.col("latitude").isNull() | F.col("longitude").isNull())
            .groupBy("establishment_address")
            .agg(F.max("latitude").alias("latitude"), F.max("longitude").alias("longitude")))


def addresses_to_geocode(missing: DataFrame, addressinfo: DataFrame) -> DataFrame:
    """Cache anti-join — only addresses not yet in the geocode table go to the geocoder."""
    return title_address(missing).join(addressinfo.select("address"), "address", "left_anti")


def incomplete_addresses(addressinfo: DataFrame) -> DataFrame:
    """cache rows where the geocoder did not return every attribute."""
    cols = ["postalcode", "locality", "formattedaddress", "latitude", "longitude"]
    cond = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return addressinfo.where(cond)


def retry_addresses(addressinfo: DataFrame) -> DataFrame:
    """cache without the incompletely geocoded rows (they are geocoded again)."""
    return addressinfo.join(incomplete_addresses(addressinfo).select("address").distinct(), "address", "left_anti")


def geocode_lookup(addressinfo: DataFrame, suffix: str = GEOCODE_SUFFIX) -> DataFrame:
    """Cache keyed back to the upper-case establishment address; one row per address, so a
    left join cannot multiply rows."""
    key = F.upper(F.replace(F.col("address"), F.lit(suffix), F.lit("")))
    return (addressinfo.groupBy(key.alias("establishment_address"))
            .agg(F.max("latitude").alias("latitude_geo"), F.max("longitude").alias("longitude_geo")))


def fill_coordinates(inspections: DataFrame, infractions: DataFrame, addressinfo: DataFrame) -> DataFrame:
    """J2 + F9: attach per-establishment coordinates, then fill gaps from the geocode cache."""
    with_coords = inspections.join(coords_per_establishment(infractions), EST, "left")
    filled = with_coords.join(geocode_lookup(addressinfo), "establishment_address", "left")
    return (filled.withColumn("latitude", F.coalesce("latitude", "latitude_geo"))
                  .withColumn("longitude", F.coalesce("longitude", "longitude_geo"))
                  .drop("latitude_geo", "longitude_geo"))


def unique_locations(inspections: DataFrame) -> DataFrame:
    """One point per establishment (de-duplicate before the spatial join)."""
    return inspections.groupBy(*EST).agg(F.max("latitude").alias("latitude"),
                                         F.max("longitude").alias("longitude"))


# ---- point in polygon ------------------------------------------------------------------------

def _edges(geometry: Column) -> Column:
    """All edges of all rings (outer rings, holes, parts of a multi-polygon) as one array."""
    def ring_edges(ring: Column) -> Column:
        n = F.size(ring)
        return F.arrays_zip(F.slice(ring, 1, n - 1).alias("a"), F.slice(ring, 2, n - 1).alias("b"))
    return F.flatten(F.transform(F.filter(geometry, lambda r: F.size(r) > 1), ring_edges))


def _strictly_inside(edges: Column, lon: Column, lat: Column, odd: Column | None = None) -> Column:
    """The point is on no edge, and a ray to +x crosses an odd number of edges (an even one where ``odd`` others are met)."""
    def cross(e: Column) -> Column:
        a, b = e["a"], e["b"]
        return (b["lon"] - a["lon"]) * (lat - a["lat"]) - (b["lat"] - a["lat"]) * (lon - a["lon"])

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        straddles = (a["lat"] > lat) != (b["lat"] > lat)
        x_at = F.try_divide((b["lon"] - a["lon"]) * (lat - a["lat"]), b["lat"] - a["lat"]) + a["lon"]
        return straddles & (lon < x_at)

    def on_edge(e: Column) -> Column:
        a, b = e["a"], e["b"]
        return ((cross(e) == 0) & lon.between(F.least(a["lon"], b["lon"]), F.greatest(a["lon"], b["lon"]))
                & lat.between(F.least(a["lat"], b["lat"]), F.greatest(a["lat"], b["lat"])))
    met = F.size(F.filter(edges, crosses)) % 2 == 1
    return (met if odd is None else met != odd) & ~F.exists(edges, on_edge)


def contains_point(geometry: Column, lon: Column, lat: Column) -> Column:
    """Strict containment against the whole outline: the point is on no edge, and a ray to +x crosses an odd number of edges."""
    return _strictly_inside(_edges(geometry), lon, lat)


def point_in_polygon(points: DataFrame, polygons: DataFrame, lon: str = "longitude", lat: str = "latitude",
                     keep: list[str] | None = None, cell: float = 0.01, geometry: str = "geometry",
                     max_broadcast_cells: int = MAX_BROADCAST_CELLS,
                     max_broadcast_vertices: int = MAX_BROADCAST_VERTICES,
                     max_cells: int = MAX_CELLS, max_edges: int = MAX_EDGES) -> DataFrame:
    """Inner spatial join — polygon contains point (strictly).  Points outside every polygon drop out, as do
    points without coordinates and polygons without an outline.

    Each polygon is covered by at most about ``max_cells`` cells of sizes ``cell`` · 2^k, however large it is.  A point looks up its cell
    of every size that occurs (an equi-join, no nested loop); in a cell wholly inside the polygon it is in, in any
    other the test takes the few edges the cell holds.  The cover and the polygons' columns are broadcast
    only after their rows and edges are counted; above either bound they are shuffled and AQE splits hot cells.
    """
    keep = keep if keep is not None else [c for c in polygons.columns if c != geometry]
    from ..session import cut_lineage
    # the row number, fixed by writing the layer once, tells equal polygons apart
    polys = cut_lineage(polygons.select(*keep, geometry).withColumn("_pid", F.monotonically_increasing_id()), "polygons")
    cover = cut_lineage(polygon_cover(polys.select("_pid", _edges(F.col(geometry)).alias("_edges")), cell, max_cells, max_edges), "cover")
    size = cover.agg(F.count("*").alias("cells"), F.sum(F.size("_edges")).alias("edges"), F.array_sort(F.collect_set("_k")).alias("levels")).first()
    small = size["cells"] <= max_broadcast_cells and (size["edges"] or 0) <= max_broadcast_vertices
    attributes = polys.select("_pid", *keep)
    levels = F.array(*[F.lit(k) for k in size["levels"]]) if size["levels"] else F.array().cast("array<int>")
    x, y = F.floor(F.col(lon) / cell).cast("long"), F.floor(F.col(lat) / cell).cast("long")
    pts = (points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull()).withColumns({"_x": x, "_y": y}).withColumn("_k", F.explode(levels))
           .withColumns({"_cx": F.expr("shiftright(_x, _k)"), "_cy": F.expr("shiftright(_y, _k)")}).drop("_x", "_y"))
    met = pts.join(F.broadcast(cover) if small else cover, ["_k", "_cx", "_cy"])
    inside = met.where(F.col("_inside") | _strictly_inside(F.col("_edges"), F.col(lon), F.col(lat), F.col("_odd"))).drop("_k", "_cx", "_cy", "_inside", "_odd", "_edges")
    return inside.join(F.broadcast(attributes) if small else attributes, "_pid").drop("_pid")


def fix_area_names(areas: DataFrame, fixes=None, column: str = "AREA_NAME") -> DataFrame:
    """Literal typo fixes of area names."""
    from ..constants import AREA_NAME_FIXES
    c = F.col(column)
    for a, b in (fixes or AREA_NAME_FIXES):
        c = F.replace(c, F.lit(a), F.lit(b))
    return areas.withColumn(column, c)


def area_name_match(areas: DataFrame, patterns=None, column: str = "AREA_NAME") -> DataFrame:
    """spot check — names containing any of the given fragments."""
    from ..constants import AREA_NAME_SPOT_CHECK
    cond = None
    for p in (patterns or AREA_NAME_SPOT_CHECK):
        t = F.col(column).contains(p)
        cond = t if cond is None else cond | t
    return areas.where(cond)


def unlocated_points(points: DataFrame, located: DataFrame, keys: list[str]) -> DataFrame:
    """Q14: the points the spatial join dropped (outside every polygon or without coordinates),
    reported as a true row count instead of the source's column count."""
    return (points.join(located.select(*keys), keys, "left_anti")
            .agg(F.count(F.lit(1)).cast("bigint").alias("num_dropped")))
