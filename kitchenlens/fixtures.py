"""Domain views over the driver's generic tables.

The operators work on the domain schemas (infractions, areas, profile, crimes, addressinfo).
The test data ships TPC-H-like tables, so this module maps them onto those schemas with plain,
set-based projections.  ``oracle_cte()`` returns the same mapping as DuckDB SQL so every oracle
query starts from identical inputs.

Everything here is a projection or equi-join of the given tables: the work grows with them.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .constants import GEOCODE_SUFFIX

N_AREAS = 25
GRID = 5
ORIGIN_LAT, ORIGIN_LON = 43.6, -79.6
CELL_H, CELL_W, SHEAR = 0.05, 0.08, 0.2
# the parts of a cell in ``areas_with_holes``, as shares of its width and height: holes (u0, u1, v0, v1), and where a cell is parted
HOLE, PARTS, PART_HOLE = (0.25, 0.5, 0.2, 0.7), (0.4, 0.6), (0.7, 0.9, 0.2, 0.7)
CONTINENT_LON, CONTINENT_LAT = -100, 20


_SCHEMAS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table.  The schema is inferred on the first read of a path and given on later
    reads (each inference is a Spark job); a rewritten file has a new timestamp and is inferred
    again."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    try:
        key = (path, os.stat(path).st_mtime_ns)
    except OSError:                     # not a local path: infer every time
        return spark.read.parquet(path)
    schema = _SCHEMAS.get(key)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[key] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def table_versions(sf_dir: str, names) -> tuple | None:
    """Paths and timestamps of driver tables; None where they are not local files."""
    try:
        return tuple((p := f"{sf_dir.rstrip('/')}/{n}.parquet", os.stat(p).st_mtime_ns) for n in names)
    except OSError:
        return None


def _case(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default))


def _lat(custkey: Column) -> Column:
    return F.when(custkey % 7 == 0, F.lit(None).cast("double")).otherwise(
        F.lit(43.6005) + (custkey % 250).cast("double") * F.lit(0.001))


def _lon(custkey: Column) -> Column:
    return F.when(custkey % 7 == 0, F.lit(None).cast("double")).otherwise(
        F.lit(-79.59943) + (custkey % 400).cast("double") * F.lit(0.001))


def infractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per infraction: lineitem ⋈ orders ⋈ customer, projected to the domain schema."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == F.col("c_custkey"))
    line = F.col("l_linenumber")
    no_detail = (line == 1) & (F.col("o_orderkey") % 3 == 0)
    day = F.to_date("o_orderdate")
    return j.select(
        F.col("l_linenumber").cast("bigint").alias("row_id"),
        F.col("o_custkey").alias("establishment_id"),
        F.col("o_orderkey").alias("inspection_id"),
        F.col("c_name").alias("establishment_name"),
        _case(F.col("c_mktsegment"), {"BUILDING": "Restaurant", "AUTOMOBILE": "Food Take Out",
                                      "HOUSEHOLD": "Supermarket", "FURNITURE": "Food Bank"},
              "Private Club").alias("establishmenttype"),
        F.upper(F.concat("c_name", F.lit(" ST"))).alias("establishment_address"),
        _case(F.col("o_orderstatus"), {"F": "Pass", "O": "Conditional Pass"}, "Closed")
        .alias("establishment_status"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("minimum_inspections_peryear"),
        F.when(no_detail, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("DETAIL "), (F.col("l_partkey") % 20).cast("string")))
        .alias("infraction_details"),
        F.when((F.col("o_orderkey") % 97 == 0) & (line == 1), F.date_add(day, 1)).otherwise(day)
        .alias("inspection_date"),
        F.when(no_detail, F.lit(None).cast("string"))
        .when(F.col("l_discount") == 0, "NA - Not Applicable")
        .when(F.col("l_quantity") > 45, "C - Crucial")
        .when(F.col("l_returnflag") == "R", "S - Significant")
        .otherwise("M - Minor").alias("severity"),
        _case(line, {2: "Corrected During Inspection", 3: "Notice to Comply", 4: "Ticket",
                     5: "Summons", 6: "Closure Order", 7: "Education Provided"}).alias("action"),
        F.when(line < 4, F.lit(None).cast("string")).otherwise(
            _case(F.col("l_partkey") % 5, {0: "Conviction - Fined", 1: "Pending",
                                           2: "Charges Withdrawn",
                                           3: "Conviction - Fined & Order to Close by Court"}))
        .alias("court_outcome"),
        F.concat((F.col("l_partkey") % 9 + 1).cast("string"), F.lit(",250.50")).alias("amount_fined_raw"),
        _lat(F.col("o_custkey")).alias("latitude"),
        _lon(F.col("o_custkey")).alias("longitude"),
    )


def _area_label(n: Column, name: Column) -> Column:
    return (F.when(n == 0, F.lit("North St.James Town (0)"))
            .when(n == 1, F.lit("Weston-Pellam Park (1)"))
            .otherwise(F.concat(name, F.lit(" ("), n.cast("string"), F.lit(")"))))


def areas_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygon layer: one sheared rectangular cell per nation, ring as array<struct<lon,lat>>."""
    n = F.col("n_nationkey")
    row = F.floor(n / F.lit(float(GRID)))
    col = n % GRID
    lat0 = F.lit(ORIGIN_LAT) + F.lit(CELL_H) * row
    lon0 = F.lit(ORIGIN_LON) + F.lit(CELL_W) * col

    def vertex(dlat: float, dlon: float) -> Column:
        lat = lat0 + F.lit(dlat)
        return F.struct((lon0 + F.lit(SHEAR) * (lat - F.lit(ORIGIN_LAT)) + F.lit(dlon)).alias("lon"),
                        lat.alias("lat"))

    ring = F.array(vertex(0, 0), vertex(0, CELL_W), vertex(CELL_H, CELL_W), vertex(CELL_H, 0), vertex(0, 0))
    return table(spark, sf_dir, "nation").select(
        _area_label(n, F.col("n_name")).alias("AREA_NAME"),
        F.array(ring).alias("geometry"),
        (F.lit(1000000.0) + F.lit(1000.0) * n).alias("Shape__Area"),
        (F.lit(4000.0) + n).alias("Shape__Length"),
        F.lit(None).cast("string").alias("CLASSIFICATION"),
        F.lit(None).cast("string").alias("CLASSIFICATION_CODE"),
    )


def areas_with_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The area layer with every kind of outline: whole cells, cells with a hole, and cells of two parts of which one has a hole.

    ``polygons`` is array<array<array<struct<lon,lat>>>>: polygons, each an outer ring and its holes."""
    n = F.col("n_nationkey")
    lat0 = F.lit(ORIGIN_LAT) + F.lit(CELL_H) * F.floor(n / F.lit(float(GRID)))
    lon0 = F.lit(ORIGIN_LON) + F.lit(CELL_W) * (n % GRID)

    def box(u0: float, u1: float, v0: float, v1: float) -> Column:
        def vertex(u, v):
            lat = lat0 + F.lit(v * CELL_H)
            return F.struct((lon0 + F.lit(SHEAR) * (lat - F.lit(ORIGIN_LAT)) + F.lit(u * CELL_W)).alias("lon"), lat.alias("lat"))
        return F.array(vertex(u0, v0), vertex(u1, v0), vertex(u1, v1), vertex(u0, v1), vertex(u0, v0))
    whole, holed = F.array(F.array(box(0, 1, 0, 1))), F.array(F.array(box(0, 1, 0, 1), box(*HOLE)))
    parts = F.array(F.array(box(0, PARTS[0], 0, 1)), F.array(box(PARTS[1], 1, 0, 1), box(*PART_HOLE)))
    return table(spark, sf_dir, "nation").select(_area_label(n, F.col("n_name")).alias("AREA_NAME"), (F.lit(1000000.0) + F.lit(1000.0) * n).alias("Shape__Area"),
                                                 F.when(n % 3 == 0, whole).when(n % 3 == 1, holed).otherwise(parts).alias("polygons"))


def continent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One area of 40 degrees square, sheared, with a large hole, around and beyond the small areas: about 800 vertices."""
    def ring(u0: int, u1: int, v0: int, v1: int) -> Column:
        def side(u, up):
            first, last = (v0, v1) if up else (v1, v0)
            step = 1 if up else -1
            return F.transform(F.sequence(F.lit(8 * first), F.lit(8 * last), F.lit(step)), lambda i: F.struct(
                (i / 16.0 + F.lit(CONTINENT_LON + u - CONTINENT_LAT / 2)).alias("lon"), (i / 8.0).alias("lat")))
        points = F.concat(side(u1, True), side(u0, False))
        return F.concat(points, F.slice(points, 1, 1))
    outer = ring(0, 40, CONTINENT_LAT, CONTINENT_LAT + 40)
    return table(spark, sf_dir, "region").where("r_regionkey = 1").select(F.col("r_name").alias("AREA_NAME"), F.array(outer, ring(10, 20, CONTINENT_LAT + 10, CONTINENT_LAT + 20)).alias("geometry"))


def order_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point for each order, spread over the globe."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(F.lit("order").alias("kind"), k.alias("point_id"), ((k * 7919) % 360000 / F.lit(1000.0) - F.lit(180.0)).alias("longitude"),
                                                 ((k * 104729) % 170000 / F.lit(1000.0) - F.lit(84.9995)).alias("latitude"))


def profile_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census profile in long form: one row per area with raw comma-formatted numbers."""
    n = F.col("n_nationkey")
    name = (F.when(n == 0, F.lit("North St. James Town")).when(n == 1, F.lit("Weston-Pelham Park"))
            .otherwise(F.col("n_name")))
    return table(spark, sf_dir, "nation").select(
        name.alias("area_name"),
        n.cast("string").alias("neighbourhood_number"),
        F.concat((n + 10).cast("string"), F.lit(","), (n + 100).cast("string")).alias("pop_2011"),
        F.concat((n + 11).cast("string"), F.lit(","), (n + 200).cast("string")).alias("pop_2016"),
    )


def profile_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The census table in its published shape: one row per characteristic, one column per area.

    Built by pivoting the long view; the area list is small and bounded (one column per area).
    """
    long = profile_long(spark, sf_dir)
    stacked = long.select(
        "area_name",
        F.explode(F.array(
            F.struct(F.lit("Neighbourhood Number").alias("Characteristic"),
                     F.col("neighbourhood_number").alias("value")),
            F.struct(F.lit("Population, 2011").alias("Characteristic"), F.col("pop_2011").alias("value")),
            F.struct(F.lit("Population, 2016").alias("Characteristic"), F.col("pop_2016").alias("value")),
        )).alias("kv"))
    # Spark collects the distinct area names for the pivot and refuses more than
    # spark.sql.pivotMaxValues of them, so the driver-side list is bounded.
    return (stacked.groupBy(F.col("kv.Characteristic").alias("Characteristic"))
            .pivot("area_name").agg(F.first("kv.value")))


def crimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per crime event, attributes only (geometry is not used)."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    nat = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("area_no"), _area_label(F.col("n_nationkey"), F.col("n_name")).alias("raw"))
    e = F.col("event_id")
    out = ev.select(
        e.alias("Index_"),
        (F.col("user_id") % N_AREAS).cast("int").alias("area_no"),
        F.date_add(F.lit("1995-01-01").cast("date"), ((e % 240) * 10).cast("int")).alias("occurrence"),
        _case(F.col("event_type"), {"view": "Assault", "click": "Auto Theft", "purchase": "Break and Enter",
                                    "signup": "Robbery", "error": "Theft Over"}).alias("MCI"),
        _case(e % 4, {0: "Outside", 1: "Commercial", 2: "Other"}, "House").alias("premises_t"),
        F.when(e % 11 == 0, F.lit("Robbery - Taxi")).when(e % 11 == 1, F.lit(None).cast("string"))
        .otherwise(F.lit("Assault")).alias("offence"),
    )
    # 25-row dimension: broadcast is bounded by the number of areas.
    out = out.join(F.broadcast(nat), "area_no")
    fixed = F.replace(F.replace("raw", F.lit("St.James"), F.lit("St. James")),
                      F.lit("Weston-Pellam"), F.lit("Weston-Pelham"))
    return out.select("Index_", fixed.alias("Neighbourh"), "occurrence", "MCI", "premises_t", "offence")


def addressinfo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geocode cache: the customers with a settled account have been looked up, some with attributes missing."""
    c = table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0).select("c_custkey", "c_name")
    k = F.col("c_custkey")
    lat = F.lit(43.6005) + (k % 250).cast("double") * F.lit(0.001)
    lon = F.lit(-79.59943) + (k % 400).cast("double") * F.lit(0.001)
    return c.select(
        F.concat(F.substring("c_name", 1, 1), F.lower(F.expr("substring(c_name, 2)")),
                 F.lit(" St" + GEOCODE_SUFFIX)).alias("address"),
        F.when(k % 5 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Area "), (k % N_AREAS).cast("string"))).alias("neighbourhood"),
        F.lit("Toronto").alias("locality"),
        F.when(k % 28 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.upper(F.concat("c_name", F.lit(" ST"))), F.lit(GEOCODE_SUFFIX)))
        .alias("formattedaddress"),
        F.when(k % 42 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("M"), (k % 10).cast("string"), F.lit("A 1B2"))).alias("postalcode"),
        lat.alias("latitude"),
        lon.alias("longitude"),
    )


# ---------------------------------------------------------------------------------------------
# The same mapping as DuckDB SQL (oracle side).  Area membership uses the closed form of the
# sheared grid instead of a polygon test, so the spatial operator is checked independently.
# ---------------------------------------------------------------------------------------------

_AREA_LABEL_SQL = """CASE WHEN {n} = 0 THEN 'North St.James Town (0)'
                    WHEN {n} = 1 THEN 'Weston-Pellam Park (1)'
                    ELSE {name} || ' (' || CAST({n} AS VARCHAR) || ')' END"""

_AREA_FIXED_SQL = """CASE WHEN {n} = 0 THEN 'North St. James Town (0)'
                    WHEN {n} = 1 THEN 'Weston-Pelham Park (1)'
                    ELSE {name} || ' (' || CAST({n} AS VARCHAR) || ')' END"""

ORACLE_VIEWS = {
    "infractions": """
    SELECT CAST(l.l_linenumber AS BIGINT) AS row_id,
           o.o_custkey AS establishment_id,
           o.o_orderkey AS inspection_id,
           c.c_name AS establishment_name,
           CASE c.c_mktsegment WHEN 'BUILDING' THEN 'Restaurant' WHEN 'AUTOMOBILE' THEN 'Food Take Out'
                WHEN 'HOUSEHOLD' THEN 'Supermarket' WHEN 'FURNITURE' THEN 'Food Bank'
                ELSE 'Private Club' END AS establishmenttype,
           upper(c.c_name || ' ST') AS establishment_address,
           CASE o.o_orderstatus WHEN 'F' THEN 'Pass' WHEN 'O' THEN 'Conditional Pass'
                ELSE 'Closed' END AS establishment_status,
           CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS minimum_inspections_peryear,
           CASE WHEN l.l_linenumber = 1 AND o.o_orderkey % 3 = 0 THEN NULL
                ELSE 'DETAIL ' || CAST(l.l_partkey % 20 AS VARCHAR) END AS infraction_details,
           CASE WHEN o.o_orderkey % 97 = 0 AND l.l_linenumber = 1
                THEN CAST(o.o_orderdate + INTERVAL '1' DAY AS DATE)
                ELSE CAST(o.o_orderdate AS DATE) END AS inspection_date,
           CASE WHEN l.l_linenumber = 1 AND o.o_orderkey % 3 = 0 THEN NULL
                WHEN l.l_discount = 0 THEN 'NA - Not Applicable'
                WHEN l.l_quantity > 45 THEN 'C - Crucial'
                WHEN l.l_returnflag = 'R' THEN 'S - Significant'
                ELSE 'M - Minor' END AS severity,
           CASE l.l_linenumber WHEN 2 THEN 'Corrected During Inspection' WHEN 3 THEN 'Notice to Comply'
                WHEN 4 THEN 'Ticket' WHEN 5 THEN 'Summons' WHEN 6 THEN 'Closure Order'
                WHEN 7 THEN 'Education Provided' END AS action,
           CASE WHEN l.l_linenumber < 4 THEN NULL
                ELSE CASE l.l_partkey % 5 WHEN 0 THEN 'Conviction - Fined' WHEN 1 THEN 'Pending'
                     WHEN 2 THEN 'Charges Withdrawn'
                     WHEN 3 THEN 'Conviction - Fined & Order to Close by Court' END END AS court_outcome,
           CAST(l.l_partkey % 9 + 1 AS VARCHAR) || ',250.50' AS amount_fined_raw,
           CASE WHEN o.o_custkey % 7 = 0 THEN NULL
                ELSE 43.6005e0 + CAST(o.o_custkey % 250 AS DOUBLE) * 0.001e0 END AS latitude,
           CASE WHEN o.o_custkey % 7 = 0 THEN NULL
                ELSE -79.59943e0 + CAST(o.o_custkey % 400 AS DOUBLE) * 0.001e0 END AS longitude
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                    JOIN customer c ON o.o_custkey = c.c_custkey""",
    "area_names": f"""
    SELECT n_nationkey AS area_no,
           {_AREA_FIXED_SQL.format(n='n_nationkey', name='n_name')} AS AREA_NAME,
           1000000e0 + 1000e0 * n_nationkey AS Shape__Area,
           4000e0 + n_nationkey AS Shape__Length
    FROM nation""",
    "profile_long": """
    SELECT CASE WHEN n_nationkey = 0 THEN 'North St. James Town' WHEN n_nationkey = 1 THEN 'Weston-Pelham Park'
                ELSE n_name END AS area_name,
           CAST(n_nationkey AS VARCHAR) AS neighbourhood_number,
           CAST(n_nationkey + 10 AS VARCHAR) || ',' || CAST(n_nationkey + 100 AS VARCHAR) AS pop_2011,
           CAST(n_nationkey + 11 AS VARCHAR) || ',' || CAST(n_nationkey + 200 AS VARCHAR) AS pop_2016
    FROM nation""",
    "crimes": f"""
    SELECT e.event_id AS Index_,
           {_AREA_FIXED_SQL.format(n='n.n_nationkey', name='n.n_name')} AS Neighbourh,
           CAST(DATE '1995-01-01' + CAST((e.event_id % 240) * 10 AS INTEGER) AS DATE) AS occurrence,
           CASE e.event_type WHEN 'view' THEN 'Assault' WHEN 'click' THEN 'Auto Theft'
                WHEN 'purchase' THEN 'Break and Enter' WHEN 'signup' THEN 'Robbery'
                WHEN 'error' THEN 'Theft Over' END AS MCI,
           CASE e.event_id % 4 WHEN 0 THEN 'Outside' WHEN 1 THEN 'Commercial' WHEN 2 THEN 'Other'
                ELSE 'House' END AS premises_t,
           CASE WHEN e.event_id % 11 = 0 THEN 'Robbery - Taxi' WHEN e.event_id % 11 = 1 THEN NULL
                ELSE 'Assault' END AS offence
    FROM events e JOIN nation n ON CAST(e.user_id % 25 AS INTEGER) = n.n_nationkey""",
    "addressinfo": f"""
    SELECT substr(c_name, 1, 1) || lower(substr(c_name, 2)) || ' St{GEOCODE_SUFFIX}' AS address,
           CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'Area ' || CAST(c_custkey % 25 AS VARCHAR) END
               AS neighbourhood,
           'Toronto' AS locality,
           CASE WHEN c_custkey % 28 = 0 THEN NULL ELSE upper(c_name || ' ST') || '{GEOCODE_SUFFIX}' END
               AS formattedaddress,
           CASE WHEN c_custkey % 42 = 0 THEN NULL
                ELSE 'M' || CAST(c_custkey % 10 AS VARCHAR) || 'A 1B2' END AS postalcode,
           43.6005e0 + CAST(c_custkey % 250 AS DOUBLE) * 0.001e0 AS latitude,
           -79.59943e0 + CAST(c_custkey % 400 AS DOUBLE) * 0.001e0 AS longitude
    FROM customer WHERE c_acctbal >= 0""",
}


def oracle_cte(*names: str) -> str:
    """``WITH`` prefix defining the requested domain views for a DuckDB oracle query."""
    parts = [f"{n} AS ({ORACLE_VIEWS[n]}\n)" for n in names]
    return "WITH " + ",\n".join(parts) + "\n"


def area_of_point_sql(lat: str, lon: str) -> str:
    """Closed-form area number of a point in the sheared grid (NULL outside), DuckDB SQL."""
    row = f"floor(({lat} - {ORIGIN_LAT}e0) / {CELL_H}e0)"
    col = f"floor(({lon} - ({ORIGIN_LON}e0) - {SHEAR}e0 * ({lat} - {ORIGIN_LAT}e0)) / {CELL_W}e0)"
    return (f"CASE WHEN {row} BETWEEN 0 AND {GRID - 1} AND {col} BETWEEN 0 AND {GRID - 1} "
            f"THEN CAST({row} * {GRID} + {col} AS INTEGER) END")


# --- fixed values: action and court-outcome values present in the fixture (pivot lists) ---
FIXTURE_ACTIONS = ["Closure Order", "Corrected During Inspection", "Education Provided",
                   "Notice to Comply", "Summons", "Ticket", None]
FIXTURE_OUTCOMES = ["Charges Withdrawn", "Conviction - Fined",
                    "Conviction - Fined & Order to Close by Court", "Pending", None]
