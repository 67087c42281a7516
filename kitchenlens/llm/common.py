"""Small helpers shared by the training-text operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, drop_stage, ensure_checkpoint_dir, scratch_folder  # noqa: F401  (re-exported)

#: Texts above this many bytes are read word block by word block.
BLOCK_BYTES = 1 << 20


#: Rows of an Arrow batch at most: texts are long, and a task holds a batch of them and of its results.
BATCH_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; a session that still has Spark's default size of Arrow batches gets smaller ones."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def strings(column, at_once: int = 256) -> Iterator[str | None]:
    """The values of an Arrow string column, a few in memory at a time."""
    for at in range(0, len(column), at_once):
        yield from column.slice(at, at_once).to_pylist()


def word_blocks(data: bytes, block: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The whitespace-separated words of ``data`` in lists, each from about ``block`` bytes.

    Splits at ASCII white space (space and \\x09-\\x0D) only; a word is never cut."""
    if len(data) <= block:
        yield data.split()
        return
    start, end = 0, len(data)
    while start < end:
        stop = min(end, start + block)
        while stop < end and data[stop] not in b" \t\n\r\x0b\x0c":
            stop += 1
        yield data[start:stop].split()
        start = stop


def with_column_replaced(df: DataFrame, name: str, col) -> DataFrame:
    """``df`` with column ``name`` last; an input column of that name (in any case) gives way."""
    keep = [f"`{c}`" for c in df.columns if c.lower() != name.lower()]
    return df.select(*keep, col.alias(name))


def unused_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as it takes to be no column of ``df`` (in any case)."""
    taken = {c.lower() for c in df.columns}
    name = "__" + name
    while name.lower() in taken:
        name = "_" + name
    return name


def crc_of_id(col: str):
    """CRC-32 of the id written as decimal text."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def smallest_hashes(df: DataFrame, place: str, total: int, limit: int) -> DataFrame:
    """The ``limit`` rows of ``df`` (``total`` rows) with the smallest values of ``place``, a 64-bit hash column.

    A first cut at one and a half times the share asked for leaves few rows to sort, so what meets in
    one task is bounded by ``limit`` and not by the number of tasks."""
    share = min(1.0, (1.5 * limit + 100) / max(1, total))
    if share < 1.0:
        df = df.where(F.col(place) < F.lit(int((2 * share - 1) * 2 ** 63)))
    return df.orderBy(place).limit(limit)
