"""Sharding: a seeded global shuffle in two external passes, cut into shards of equal row counts."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, table

SHARDS = 16
SEED = 42
#: Text bytes of a bucket, which one task shuffles in memory.
BUCKET_BYTES = 64 << 20
#: Partitions of the scatter at most; with more buckets a task shuffles several, one after another.
MAX_PARTITIONS = 100_000
#: Buckets whose counts are summed together before the running totals are taken.
BUCKETS_PER_GROUP = 4096


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A uniform order of n rows, drawn from the seed and the bucket number alone."""
    draw = np.random.Generator(np.random.Philox(key=[seed & (2 ** 64 - 1), bucket]))
    order = np.arange(n)
    picks = (draw.random(max(0, n - 1)) * np.arange(n, 1, -1)).astype(np.int64).tolist()
    values = order.tolist()
    for last, pick in zip(range(n - 1, 0, -1), picks):
        values[last], values[pick] = values[pick], values[last]
    return np.array(values, np.int64)


def _shuffle_buckets(seed: int):
    def shuffle(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        """Rows come sorted by bucket; each bucket is held, shuffled and passed on."""
        held: list[pa.RecordBatch] = []
        current = None

        def flush():
            rows = pa.Table.from_batches(held).combine_chunks()
            order = fisher_yates(len(rows), seed, current)
            rows = rows.take(pa.array(order)).append_column("__position", pa.array(np.arange(len(rows)), pa.int64()))
            return rows.drop_columns(["__tie"]).combine_chunks().to_batches(max_chunksize=1024)

        for batch in batches:
            marks = batch["__bucket"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(marks)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if current is not None and marks[a] != current and held:
                    yield from flush()
                    held = []
                current = int(marks[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield from flush()
    return shuffle


def external_shuffle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, seed: int = SEED,
                     bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` in a seeded random order: columns shard (0 to shards - 1) and slot (0, 1, ... in its shard) are added.

    Pass one scatters the rows by a seeded hash into buckets of about ``bucket_bytes`` (at least
    as many as the session has shuffle partitions); pass two shuffles each bucket in
    memory (Fisher-Yates) and writes it to the checkpoint folder.  The buckets one after
    another are one uniform random order, cut into shards whose row counts differ by at most one.

    Null ids and texts and repeated rows are rows like any other (equal rows are scattered by
    their place in the input); an input column named shard or slot is replaced; an empty
    table gives an empty result."""
    spark = docs.sparkSession
    names = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    size = F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long") + 1
    total = docs.agg(F.sum(size)).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // bucket_bytes), 1)
    # the columns have numbers for names meanwhile, so none of theirs clashes with one made here
    tied = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col(f"`{id_col}`").alias("id"), F.monotonically_increasing_id().alias("__tie"))
    scattered = tied.withColumn("__bucket", F.pmod(F.xxhash64(F.lit(seed), "id", "__tie"), F.lit(buckets))).drop("id")
    # a bucket's number is its partition's: hashing the number again would put several buckets in one
    parts = min(buckets, MAX_PARTITIONS)
    ordered = scattered.repartitionById(parts, (F.col("__bucket") % parts).cast("int")).sortWithinPartitions("__bucket", F.xxhash64(F.lit(seed + 1), "__tie"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in scattered.schema if f.name != "__tie") + ", __position long"
    written = cut_lineage(ordered.mapInArrow(_shuffle_buckets(seed), schema), "shuffled")
    counts = cut_lineage(written.groupBy("__bucket").agg(F.count("*").alias("n")), "bucket-counts")
    rows = counts.agg(F.sum("n")).first()[0] or 0
    before = _rows_before(counts)
    place = F.col("__position") + F.col("before")
    # shard k holds the places from ceil(k rows / shards) on
    shard = F.floor(place * shards / F.lit(max(1, rows))) if rows < 2 ** 40 else F.floor(place.cast("decimal(38,0)") * shards / rows)
    first = F.ceil(F.col("shard").cast("decimal(38,0)") * F.lit(rows).cast("decimal(38,0)") / F.lit(shards)).cast("long")
    return (written.join(before, "__bucket").withColumn("place", place).withColumn("shard", shard.cast("int"))
            .withColumn("slot", F.col("place") - first).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "shard", "slot"))


def _rows_before(counts: DataFrame) -> DataFrame:
    """(bucket, rows in earlier buckets): running totals inside groups of buckets, and over the groups."""
    from pyspark.sql import Window
    grouped = counts.withColumn("g", F.floor(F.col("__bucket") / BUCKETS_PER_GROUP))
    inside = Window.partitionBy("g").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    groups = grouped.groupBy("g").agg(F.sum("n").alias("n")).select("g", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("earlier"))
    return (grouped.withColumn("here", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(groups, "g")
            .select("__bucket", (F.col("here") + F.col("earlier")).alias("before")))


def write_shards(shuffled: DataFrame, path: str) -> None:
    """Shuffled rows as one Parquet folder a shard, in slot order."""
    shuffled.repartition("shard", F.floor(F.col("slot") / 1_000_000)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op8_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of a seeded shuffle."""
    out = external_shuffle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return out.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                      F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
