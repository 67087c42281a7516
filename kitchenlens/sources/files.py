"""File formats around the pipeline: bulk CSV, JSON catalog responses, GeoJSON layers, Parquet.

All readers take an explicit schema where the shape is known, so no inference pass runs and
a malformed file fails instead of silently changing types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import INFRACTION_SCHEMA


def read_bulk_csv(spark: SparkSession, path: str, schema: T.StructType = INFRACTION_SCHEMA,
                  null_value: str = "\\N", date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Comma separated, one header row, optional double quotes, ``\\N`` = NULL, and any row
    with the wrong number of fields fails the read (FAILFAST)."""
    return (spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"')
            .option("nullValue", null_value).option("dateFormat", date_format).option("mode", "FAILFAST")
            .option("enforceSchema", False).csv(path))


def write_parquet_gzip(df: DataFrame, path: str) -> None:
    """Parquet with gzip compression."""
    df.write.mode("overwrite").option("compression", "gzip").parquet(path)


def write_stage(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a stage result for the next stage.  Parquet by default (typed, column-pruned
    reads); ``fmt="csv"`` writes a header and ISO dates, as the source's hand-off files have."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w = w.option("header", True).option("dateFormat", "yyyy-MM-dd")
    w.format(fmt).save(path)


def read_stage(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet",
               date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Read a stage result.  CSV needs ``schema``: date columns are parsed by it (no
    inference pass); rows keep no order — steps that need one sort inside their window."""
    if fmt == "csv":
        if schema is None:
            raise ValueError("read_stage: a CSV stage file needs its schema")
        return (spark.read.schema(schema).option("header", True).option("dateFormat", date_format)
                .option("mode", "FAILFAST").csv(path))
    r = spark.read.schema(schema) if schema is not None else spark.read
    return r.format(fmt).load(path)


def latest_stage(spark: SparkSession, folder: str) -> str:
    """Q17: the newest output under ``folder`` chosen by modification time (the source takes
    the last name of an unsorted listing).  Lists one folder through Hadoop's file system, so it
    works on any shared store; only the listing reaches the driver."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(folder)
    statuses = p.getFileSystem(conf).listStatus(p)
    entries = [(st.getModificationTime(), st.getPath().getName(), st.getPath().toString()) for st in statuses
               if not st.getPath().getName().startswith(("_", "."))]
    if not entries:
        raise FileNotFoundError(f"latest_stage: nothing under {folder}")
    return max(entries)[2]


def active_resource(package: DataFrame) -> DataFrame:
    """From catalog package responses ``{"result": {"resources": [...]}}`` the first resource of each that
    is served as records (``datastore_active``); packages without one give no row."""
    active = F.filter("result.resources", lambda r: F.coalesce(r["datastore_active"], F.lit(False)))
    return package.select(F.get(active, F.lit(0)).alias("r")).where("r is not null").select("r.*")


def read_catalog_records(spark: SparkSession, path: str, rename: dict | None = None, multi_line: bool = True) -> DataFrame:
    """JSON catalog responses ``{"result": {"records": [...]}}`` → one row per record, optional
    column renames.  Paged responses are read one per line with ``multi_line=False``, which splits files."""
    doc = spark.read.option("multiLine", multi_line).json(path)
    out = doc.select(F.explode("result.records").alias("r")).select("r.*")
    return out.withColumnsRenamed(rename or {})


_FEATURE_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()),
        # kept as raw JSON text: Polygon and MultiPolygon nest to different depths
        T.StructField("coordinates", T.StringType()),
    ])),
])
_GEOJSON_SCHEMA = T.StructType([T.StructField("features", T.ArrayType(_FEATURE_SCHEMA))])


def _rings(coords_json, geom_type):
    """All rings of a Polygon or MultiPolygon, closed; NULL for other types of geometry."""
    def ring(r):
        points = F.transform(r, lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat")))
        return F.when(F.get(points, F.lit(0)) != F.get(points, F.size(points) - 1), F.concat(points, F.slice(points, 1, 1))).otherwise(points)
    poly = F.from_json(coords_json, "array<array<array<double>>>")
    multi = F.from_json(coords_json, "array<array<array<array<double>>>>")
    return (F.when(geom_type == "MultiPolygon", F.transform(F.flatten(multi), ring))
            .when(geom_type == "Polygon", F.transform(poly, ring)))


def _feature_columns(features: DataFrame, properties: list[str] | None) -> DataFrame:
    cols = [F.col("f.properties")[p].alias(p) for p in properties or []]
    return features.select(*cols, F.col("f.geometry.type").alias("geometry_type"), _rings(F.col("f.geometry.coordinates"), F.col("f.geometry.type")).alias("geometry"))


def read_geojson_areas(spark: SparkSession, path: str, properties: list[str] | None = None) -> DataFrame:
    """GeoJSON FeatureCollection → one row per feature with its properties and the geometry
    as ``array<array<struct<lon, lat>>>`` (all rings; a multi-polygon's parts and holes are
    exact under the even-odd containment test).

    One document is read by one task: ``read_geojson_features`` splits layers that have a feature on each line."""
    doc = spark.read.schema(_GEOJSON_SCHEMA).option("multiLine", True).json(path)
    return _feature_columns(doc.select(F.explode("features").alias("f")), properties).drop("geometry_type")


def read_geojson_features(spark: SparkSession, path: str, properties: list[str] | None = None) -> DataFrame:
    """S16 at scale: a layer with one feature on each line → the properties, ``geometry_type`` and ``geometry``.

    Takes newline-delimited features and the common form of a FeatureCollection that has the collection's
    beginning and end on lines of their own and a comma after each feature, so files split into many tasks.  A line
    that holds a feature but is no valid JSON fails the read; points, lines and null geometries have a NULL ``geometry``;
    positions may have a height, which is left out; open rings are closed."""
    line = F.regexp_replace(F.trim("value"), r",$", "")
    lines = spark.read.text(path).select(line.alias("line")).where(F.col("line").startswith("{") & F.col("line").contains('"geometry"'))
    parsed = lines.select(F.from_json("line", _FEATURE_SCHEMA, {"mode": "FAILFAST"}).alias("f")).where("f.type = 'Feature'")
    return _feature_columns(parsed, properties)


def write_geojson_features(areas: DataFrame, path: str, properties: list[str], polygons: str = "polygons") -> None:
    """S16 sink: one GeoJSON feature on each line.  ``polygons`` is ``array<array<array<struct<lon, lat>>>>``: the polygons of an
    area, each an outer ring and its holes; an area of one polygon is written as Polygon, any other as MultiPolygon."""
    numbers = F.transform(F.col(polygons), lambda poly: F.transform(poly, lambda r: F.transform(r, lambda p: F.array(p["lon"], p["lat"]))))

    def feature(kind, coordinates):
        return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*[F.col(f"`{p}`") for p in properties]).alias("properties"),
                                  F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")).alias("geometry")))
    text = F.when(F.size(numbers) == 1, feature("Polygon", F.get(numbers, F.lit(0)))).otherwise(feature("MultiPolygon", numbers))
    areas.select(text.alias("value")).write.mode("overwrite").text(path)


def create_table(spark: SparkSession, name: str, schema: T.StructType, comment: str = "",
                 location: str | None = None) -> bool:
    """Create a Parquet catalog table with a fixed schema and a comment; report existence."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet COMMENT '{comment}'{loc}")
    return spark.catalog.tableExists(name)


def create_database(spark: SparkSession, name: str, location: str) -> bool:
    """Create a database whose tables live under ``location``; report that it is there."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")
    return spark.catalog.databaseExists(name)


def drop_database(spark: SparkSession, name: str) -> bool:
    """Drop our own database and the tables left in it; report that it is gone."""
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    return not spark.catalog.databaseExists(name)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """(name, comment, columns) of a database's tables; none where there is no such database.

    The catalog's listing is a small driver-side list by nature."""
    rows = []
    for t in spark.catalog.listTables(database) if spark.catalog.databaseExists(database) else []:
        rows.append((t.name, t.description, [c.name for c in spark.catalog.listColumns(f"{database}.{t.name}")]))
    return spark.createDataFrame(rows, "name string, comment string, columns array<string>")


def truncate_table(spark: SparkSession, name: str) -> int:
    """Remove all rows and keep the table; returns the rows left."""
    spark.sql(f"TRUNCATE TABLE {name}")
    return spark.table(name).count()


def drop_table(spark: SparkSession, name: str) -> bool:
    """Drop our own table; report that it is gone."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return not spark.catalog.tableExists(name)
