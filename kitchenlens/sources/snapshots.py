"""Infraction snapshots: read, normalise, union, de-duplicate, incremental append, bulk files.

A snapshot is an XML document whose root children are rows.  Spark 4 reads XML natively
(``format("xml")``), one task a file, plain or gzipped; the schema is declared, not inferred.
Columns are bound by name, so snapshots with other column orders or without coordinates load
into the same shape.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import INFRACTION_SCHEMA
from ..functions.text import parse_money

MONEY_COLUMNS = {"amount_fined"}


def raw_snapshot_schema(fields: Sequence[str] | None = None, upper: bool = True) -> T.StructType:
    """All-string schema of a raw snapshot (types are applied by ``normalise_infractions``)."""
    names = fields or [f.name for f in INFRACTION_SCHEMA.fields]
    return T.StructType([T.StructField(n.upper() if upper else n, T.StringType()) for n in names])


def read_xml_snapshot(spark: SparkSession, path: str, row_tag: str = "ROW",
                      schema: T.StructType | None = None) -> DataFrame:
    """Children of the root element are rows; one row per ``row_tag`` element."""
    return (spark.read.format("xml").option("rowTag", row_tag)
            .schema(schema or raw_snapshot_schema()).load(path))


def write_xml_snapshot(df: DataFrame, path: str, row_tag: str = "ROW", mode: str = "errorifexists", partition_by: Sequence[str] = ()) -> None:
    """Inverse of ``read_xml_snapshot``: gzipped XML files, as the tags of a row take many times the room of its values."""
    writer = df.write.mode(mode).format("xml").option("rootTag", "ROOT").option("rowTag", row_tag).option("compression", "gzip")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def with_snapshot_id(df: DataFrame, pattern: str = r"/(\d+)/[^/]*$") -> DataFrame:
    """Provenance — the snapshot id is a folder name in the file path, kept as a bigint."""
    return df.withColumn("filename",
                         F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).cast("bigint"))


def normalise_infractions(df: DataFrame, rename: dict | None = None, date_format: str = "yyyy-MM-dd",
                          keep: Sequence[str] = ("filename",)) -> DataFrame:
    """S3: lower-case names, parse dates, cast ids, strip thousands commas from money (bad text →
    NULL), add absent columns (e.g. coordinates) as NULL, fixed column order.
    """
    rename = rename or {}
    cols = {c.lower(): c for c in df.columns}
    for src, dst in rename.items():
        if src.lower() in cols:
            cols[dst.lower()] = cols.pop(src.lower())
    dtypes = dict(df.dtypes)
    out = []
    for f in INFRACTION_SCHEMA.fields:
        src = cols.get(f.name)
        if src is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f"`{src}`")
        if f.name in MONEY_COLUMNS and dtypes[src] == "string":
            out.append(parse_money(src).alias(f.name))
        elif isinstance(f.dataType, T.DateType) and dtypes[src] == "string":
            out.append(F.try_to_date(c, date_format).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            out.append(c.cast("string").alias(f.name))
        else:
            out.append(c.try_cast(f.dataType).alias(f.name))
    out += [F.col(f"`{cols[k]}`").alias(k) for k in keep if k in cols]
    return df.select(*out)


def union_snapshots(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; columns missing in a frame become NULL."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def dedup_full_row(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Drop exact duplicate rows.  ``ignore`` lists provenance columns not compared (the
    notebook variant compares data columns only; the flow variant also compares ``filename``)."""
    cols = [c for c in df.columns if c not in set(ignore)]
    return df.dropDuplicates(cols) if ignore else df.dropDuplicates()


def new_snapshots(incoming: DataFrame, loaded: DataFrame, key: str = "filename") -> DataFrame:
    """S6 (batch form): rows of snapshots whose id is not loaded yet (anti-join on the id)."""
    return incoming.join(loaded.select(key).distinct(), key, "left_anti")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the file system that Spark reads it from."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def incremental_append(spark: SparkSession, incoming: DataFrame, table_path: str,
                       key: str = "filename") -> DataFrame:
    """Append only unseen snapshots to a Parquet table; return the distinct loaded ids.

    Only a table that is not there counts as a first load; any other error surfaces."""
    fresh = new_snapshots(incoming, spark.read.parquet(table_path), key) if path_exists(spark, table_path) else incoming
    fresh.write.mode("append").parquet(table_path)
    return spark.read.parquet(table_path).select(key).distinct()


def partition_numbering(df: DataFrame, order: Sequence[str], n_parts: int, n_buckets: int | None = None) -> DataFrame:
    """Split rows in a total order into ``n_parts`` near-equal contiguous parts.

    part = floor(global_row_index / (n / n_parts)).  The global index is built without a
    single-partition window: a range shuffle on the whole order key (sampled bounds) cuts the
    rows into ``n_buckets`` sorted ranges — ties on the first column spread over ranges by the
    later columns — and each row's index is its position inside its range plus the row count of
    the ranges before it, from a table with one row per range (its broadcast is bounded by the
    bucket count).  The numbered ranges are written once to the checkpoint folder.
    """
    spark = df.sparkSession
    n_buckets = n_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    from ..session import cut_lineage
    # written once: the counts and the index read the same ranges, range ids and positions
    # (two range shuffles could sample different bounds), and a lost executor cannot renumber
    ranges = cut_lineage(df.repartitionByRange(n_buckets, *order).sortWithinPartitions(*order)
                         .select(*df.columns, F.spark_partition_id().alias("_b"),
                                 F.monotonically_increasing_id().alias("_id")), "numbering")
    sizes = ranges.groupBy("_b").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = sizes.select(
        "_b",
        F.coalesce(F.sum("_cnt").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_offset"),
        F.sum("_cnt").over(Window.partitionBy(F.lit(0))).alias("_total"))
    # the id is (range << 33) + position inside the sorted range
    local = F.col("_id") - F.shiftleft(F.col("_b").cast("bigint"), 33)
    idx = ranges.join(F.broadcast(offsets), "_b")
    row_index = F.col("_offset") + local
    part = F.floor(row_index / (F.col("_total") / F.lit(float(n_parts)))).cast("int")
    return idx.select(*df.columns, row_index.cast("bigint").alias("row_index"), part.alias("part"))


def write_parts_csv(numbered: DataFrame, path: str, null_value: str = "") -> None:
    """S7 sink: one folder of CSV files with a header per ``part`` of ``partition_numbering``, rows in order.

    Tasks write ranges of the row order, so a part of any size is written by many tasks."""
    keep = [c for c in numbered.columns if c not in ("row_index", "part")]
    (numbered.repartitionByRange("part", "row_index").sortWithinPartitions("part", "row_index").select(*keep, "part")
     .write.mode("overwrite").partitionBy("part").option("header", True).option("nullValue", null_value)
     .option("dateFormat", "yyyy-MM-dd").csv(path))


def write_bulk_csv(df: DataFrame, path: str, null_value: str = "") -> None:
    """S8 sink: bulk CSV files with a header, as many as the frame has partitions."""
    (df.write.mode("overwrite").option("header", True).option("nullValue", null_value).option("dateFormat", "yyyy-MM-dd").csv(path))


def load_count_check(spark: SparkSession, staged: DataFrame, table: str, expected: int) -> DataFrame:
    """Append staged rows to a catalog table, then report loaded vs expected rows (all rows the
    table should hold afterwards)."""
    staged.write.mode("append").saveAsTable(table)
    loaded = spark.table(table).agg(F.count(F.lit(1)).cast("bigint").alias("loaded"))
    exp = F.lit(expected).cast("bigint")
    return loaded.select("loaded", exp.alias("expected"), (F.col("loaded") == exp).alias("ok"))


def append_and_check(spark: SparkSession, staged: DataFrame, path: str) -> DataFrame:
    """S9 / K7 on a storage path: the rows are staged as files, as the source stages them, appended to the table, and the
    rows in the table are reported against those before plus those staged.

    (An ``Observation`` would count them during the write, but a session that has used one can't be serialised any more, and a
    fitted regression's tasks carry it.)"""
    from ..session import cut_lineage
    before = spark.read.parquet(path).count() if path_exists(spark, path) else 0
    files = cut_lineage(staged, "staged")
    expected = before + files.count()
    files.write.mode("append").parquet(path)
    loaded = spark.read.parquet(path).agg(F.count(F.lit(1)).cast("bigint")).scalar()
    exp = F.lit(expected).cast("bigint")
    return spark.range(1).select(loaded.alias("loaded"), exp.alias("expected"), (loaded == exp).alias("ok"))
