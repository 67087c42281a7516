"""Ordered per-group scans (previous value, running totals, row index) that split hot groups.

A plain ``Window.partitionBy(key)`` puts every row of a key into one task.  When one key holds a
large share of the data that task is the whole job.  Here a group with more than
``hot_group_rows`` rows is cut into contiguous chunks along its first order column (cut points are
the group's own quantiles, so one outlying value does not gather the rest in one chunk, and where one value holds
several quantiles its rows are cut again along the second order column, as are those without a value); each
chunk is scanned by its own window partition, and what a chunk needs from the chunks before it (row
count, totals, the last row's values) comes from a small carry table with one row per chunk of a hot
group.  Side tables have at most ``rows / hot_group_rows`` hot groups; they are broadcast only after
their rows are counted and otherwise the joins are left to AQE.  Results equal the plain window's
exactly, NULL keys and NULL order values included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "_chunk"
NCH = "_nch"

QUANTILES = 64                      # most pieces a hot group is cut into before equal-width sub-chunks
MAX_BROADCAST_HOT_GROUPS = 10_000   # counted before the broadcast


def hot_keys(rows: DataFrame, keys: Sequence[str], hot_group_rows: int) -> DataFrame | None:
    """The key groups with more than ``hot_group_rows`` of the given (narrow) rows, written once; None if
    there are none, so the caller can plan the plain window without reading its input twice."""
    from ..session import cut_lineage
    hot = cut_lineage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_group_rows)
                      .select(*keys), "hot_keys")
    return None if hot.isEmpty() else hot


def _join_null_safe(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys where NULL equals NULL; the side's keys are dropped."""
    right = side.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    return df.join(right, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], how).drop(*[f"_k_{k}" for k in keys])


def _num(c: Column, is_date: bool) -> Column:
    return F.unix_date(c).cast("double") if is_date else c.cast("double")


def _every(cuts: Column, pieces: Column) -> Column:
    """Of the QUANTILES - 1 cuts those that part a group into so many pieces; none where there is no value."""
    at = F.transform(F.sequence(F.lit(1), pieces - 1), lambda i: F.get(cuts, F.floor(i * QUANTILES / pieces).cast("int") - 1))
    return F.when(cuts.isNull() | (pieces < 2), F.array().cast("array<double>")).otherwise(at)


def _ties(hot_rows: DataFrame, pieces: DataFrame, keys: Sequence[str], first_order: str, v: Column, second: Column) -> DataFrame:
    """(keys, first order value, _pieces, _cuts2): the values of hot groups that hold several quantiles, or are NULL, and the
    quantiles of the second order column among their rows; at most QUANTILES values a group."""
    at = _join_null_safe(hot_rows, pieces.select(*keys, "_cuts", "_p"), keys, "inner")
    several = F.when(v.isNull(), F.col("_p")).otherwise(F.size(F.filter("_cuts", lambda c: c == v)))
    cuts = F.percentile_approx(second, [i / QUANTILES for i in range(1, QUANTILES)], 1000)
    return (at.withColumn("_pieces", several).where(F.col("_pieces") > 1).groupBy(*keys, first_order, "_pieces")
            .agg(cuts.alias("_cuts2")).withColumn("_cuts2", _every(F.col("_cuts2"), F.col("_pieces"))))


def assign_chunks(df: DataFrame, keys: Sequence[str], first_order: str, hot_group_rows: int,
                  chunk_rows: int, descending: bool = False, hot: DataFrame | None = None, second_order: str | None = None) -> DataFrame:
    """Add ``_chunk`` (0 for ordinary groups) and ``_nch`` (NULL for ordinary groups).

    A hot group is cut at its quantiles of the first order column into two pieces for each ``chunk_rows`` rows, QUANTILES at
    most, and each piece into equal-width sub-chunks where it would still hold more than ``chunk_rows`` rows, so chunk numbers follow the
    scan order.  With ``second_order`` (numbers or dates) the rows of one value, or without a value, that fill several pieces are cut
    by their quantiles of that column; without it they share a chunk.  ``hot`` (from
    ``hot_keys``) says which groups may be hot; without it they are counted here.
    """
    types = dict(df.dtypes)
    v = _num(F.col(first_order), types[first_order] == "date")
    if hot is None:
        hot = hot_keys(df.select(*keys), keys, hot_group_rows)
        if hot is None:
            return df.withColumns({CHUNK: F.lit(0), NCH: F.lit(None).cast("int")})
    small = hot.limit(MAX_BROADCAST_HOT_GROUPS + 1).count() <= MAX_BROADCAST_HOT_GROUPS
    side = F.broadcast(hot) if small else hot
    cuts = F.percentile_approx(v, [i / QUANTILES for i in range(1, QUANTILES)], 1000)
    # the inner join keeps the rows of hot groups only, before anything is shuffled
    hot_rows = _join_null_safe(df.select(*keys, first_order, *([second_order] if second_order else [])), side, keys, "inner")
    pieces = (hot_rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(v).alias("_v0"), F.max(v).alias("_v1"), cuts.alias("_cuts"))
              .withColumn("_p", F.least(F.lit(QUANTILES), F.ceil(F.col("_n") * 2 / F.lit(float(chunk_rows)))).cast("int"))
              .select(*keys, F.ceil(F.col("_n") / F.lit(float(chunk_rows * QUANTILES))).cast("int").alias("_sub"), "_v0", "_v1",
                      _every(F.col("_cuts"), F.col("_p")).alias("_cuts"), "_p"))
    j = _join_null_safe(df, F.broadcast(pieces.drop("_p")) if small else pieces.drop("_p"), keys, "left")
    piece = F.size(F.filter("_cuts", lambda c: c < v))
    low = F.when(piece == 0, F.col("_v0")).otherwise(F.get("_cuts", piece - 1))
    high = F.when(piece >= F.size("_cuts"), F.col("_v1")).otherwise(F.get("_cuts", piece))
    inside = F.least(F.floor(F.coalesce(F.try_divide((v - low) * F.col("_sub"), high - low), F.lit(0.0))), F.col("_sub") - 1)
    numbers, tie = QUANTILES, F.lit(0)
    if second_order:        # pieces for the rows without a value come before the others
        numbers = 2 * QUANTILES
        second = _num(F.col(second_order), types[second_order] == "date")
        ties = _ties(hot_rows, pieces, keys, first_order, v, second)
        j = _join_null_safe(j, F.broadcast(ties) if small else ties, [*keys, first_order], "left")
        rank = F.coalesce(F.size(F.filter("_cuts2", lambda c: c < second)), F.lit(0))
        tie = F.greatest(rank, F.lit(0))
        inside = F.when(tie > 0, F.lit(0)).otherwise(inside)
        up = F.when(v.isNull(), tie * F.col("_sub")).otherwise((piece + tie + QUANTILES) * F.col("_sub") + inside)
    else:
        up = F.when(v.isNull(), F.lit(0)).otherwise(piece * F.col("_sub") + inside)
    chunk = (F.lit(numbers) * F.col("_sub") - 1 - up) if descending else up
    return (j.withColumn(NCH, (F.lit(numbers) * F.col("_sub")).cast("int"))
            .withColumn(CHUNK, F.when(F.col(NCH).isNull(), F.lit(0)).otherwise(chunk).cast("int")).drop("_v0", "_v1", "_sub", "_cuts", "_cuts2", "_pieces"))


def _add(a: Column, b: Column) -> Column:
    """NULL + NULL = NULL, otherwise NULLs count as 0 (running SUM semantics)."""
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))


def chunked_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], *, lags: dict | None = None,
                 sums: dict | None = None, exclusive_sums: dict | None = None, index: str | None = None,
                 descending: bool = False) -> DataFrame:
    """Previous-row values (``lags``: out → column), running totals including (``sums``) or
    excluding (``exclusive_sums``) the current row, and a 0-based row ``index``, per key in the
    order of the ``order`` columns (all ascending, or all descending).  ``df`` must carry
    ``_chunk`` / ``_nch`` from ``assign_chunks`` (built with the same direction)."""
    lags, sums, exclusive_sums = lags or {}, sums or {}, exclusive_sums or {}
    sort = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    w = Window.partitionBy(*keys, CHUNK).orderBy(*sort)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    local = {"_rn": F.row_number().over(w)}
    local.update({f"_l_{o}": F.lag(F.col(c)).over(w) for o, c in lags.items()})
    local.update({f"_s_{o}": F.sum(F.col(c)).over(upto) for o, c in sums.items()})
    local.update({f"_x_{o}": F.sum(F.col(c)).over(before) for o, c in exclusive_sums.items()})
    scanned = df.withColumns(local)

    # carry table: one row per chunk of a hot group (bounded by rows / chunk_rows)
    order_key = F.struct(*[F.col(c) for c in order])
    last_by = F.min_by if descending else F.max_by
    chunk_aggs = [F.count(F.lit(1)).alias("_cnt")]
    chunk_aggs += [F.sum(F.col(c)).alias(f"_t_{o}") for o, c in {**sums, **exclusive_sums}.items()]
    if lags:
        chunk_aggs.append(last_by(F.struct(*[F.col(c).alias(o) for o, c in lags.items()]), order_key).alias("_last"))
    per_chunk = df.where(F.col(NCH).isNotNull()).groupBy(*keys, CHUNK).agg(*chunk_aggs)
    wc = Window.partitionBy(*keys).orderBy(F.col(CHUNK))
    prior = wc.rowsBetween(Window.unboundedPreceding, -1)
    carry_cols = [F.sum("_cnt").over(prior).alias("_c_cnt")]
    carry_cols += [F.sum(f"_t_{o}").over(prior).alias(f"_c_{o}") for o in {**sums, **exclusive_sums}]
    if lags:
        carry_cols.append(F.lag("_last").over(wc).alias("_c_last"))
    carry = per_chunk.select(*keys, CHUNK, *carry_cols)
    out = _join_null_safe(scanned, carry, [*keys, CHUNK], "left")

    split = F.col(NCH).isNotNull()
    final = {}
    for o in lags:
        carried = F.col("_c_last")[o]
        final[o] = F.when(split & (F.col("_rn") == 1), carried).otherwise(F.col(f"_l_{o}"))
    for o in sums:
        final[o] = F.when(split, _add(F.col(f"_s_{o}"), F.col(f"_c_{o}"))).otherwise(F.col(f"_s_{o}"))
    for o in exclusive_sums:
        final[o] = F.when(split, _add(F.col(f"_x_{o}"), F.col(f"_c_{o}"))).otherwise(F.col(f"_x_{o}"))
    if index:
        final[index] = (F.col("_rn") - 1 + F.coalesce(F.col("_c_cnt"), F.lit(0))).cast("bigint")
    helper = [c for c in out.columns if c.startswith(("_l_", "_s_", "_x_", "_c_"))] + ["_rn"]
    return out.withColumns(final).drop(*helper)
