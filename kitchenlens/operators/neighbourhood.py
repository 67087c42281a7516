"""Stage 4: neighbourhood facts — areas, census population as of the inspection year, crimes.

Small dimension tables (areas, census, crime pivot per area and day) are joined to the
inspection rows with left joins; only the areas table has a proven size bound (one row per
area) and is broadcast explicitly, everything else is left to AQE's runtime size decisions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import CRIME_OFFENCES_DROPPED, CRIME_PREMISES_KEPT, CRIME_TYPES, EST
from ..functions.text import hash_text, parse_int_text

# Census slices: (first year, last year or None, population column or None, census year).
DEFAULT_CENSUS_SLICES = [(2011, 2012, None, 2006), (2013, 2017, "neigh_pop_2011", 2011),
                         (2018, None, "neigh_pop_2016", 2016)]
DEFAULT_CRIME_START_YEAR = 2014


# ---- census profile --------------------------------------------------------------------------

def profile_transpose(profile_wide: DataFrame, characteristics: dict | None = None) -> DataFrame:
    """Wide census table (one column per area) → one row per area with the wanted
    characteristics as integer columns; area label ``name (number)``.

    ``unpivot`` turns the area columns into rows (no driver round trip), then a pivot over
    the known characteristic list brings them back as columns.
    """
    characteristics = characteristics or {"Neighbourhood Number": "number", "Population, 2011": "pop_2011",
                                          "Population, 2016": "pop_2016"}
    areas = [c for c in profile_wide.columns if c != "Characteristic"]
    long = (profile_wide.where(F.col("Characteristic").isin(list(characteristics)))
            .unpivot(["Characteristic"], [F.col(f"`{a}`") for a in areas], "area_name", "value"))
    wide = long.groupBy("area_name").pivot("Characteristic", list(characteristics)).agg(F.first("value"))
    for k, v in characteristics.items():
        wide = wide.withColumnRenamed(k, v)
    out = wide.select(
        F.concat(F.col("area_name"), F.lit(" ("), F.col("number"), F.lit(")")).alias("AREA_NAME"),
        *[parse_int_text(v).alias(v) for v in characteristics.values() if v != "number"])
    return out


def establishments_per_area(located: DataFrame) -> DataFrame:
    """Located establishments per area."""
    return located.groupBy("AREA_NAME").agg(F.count(F.lit(1)).cast("bigint").alias("establishments_inspected"))


def neighbourhood_stats(areas: DataFrame, located: DataFrame, population: DataFrame) -> DataFrame:
    """Area attributes ⟕ establishments per area ⟕ population, prefixed ``neigh_`` and
    cleaned (lower case, ``__`` → ``_``); ``AREA_NAME`` keeps its name."""
    base = areas.select("AREA_NAME", "Shape__Area", "Shape__Length", "CLASSIFICATION", "CLASSIFICATION_CODE")
    stats = (base.join(establishments_per_area(located), "AREA_NAME", "left")
             .join(population.select("AREA_NAME", "pop_2011", "pop_2016"), "AREA_NAME", "left"))
    renamed = {c: ("neigh_" + c).lower().replace("__", "_") for c in stats.columns if c != "AREA_NAME"}
    return stats.withColumnsRenamed(renamed)


MAX_BROADCAST_AREAS = 1_000_000     # rows of per-area statistics


def locations_with_stats(located: DataFrame, stats: DataFrame, num_areas: int | None = None,
                         max_broadcast_areas: int = MAX_BROADCAST_AREAS) -> DataFrame:
    """Each located establishment ⟕ its area's statistics.  ``stats`` has one row per area;
    it is broadcast when ``num_areas`` (the caller's count of the area layer) is within
    ``max_broadcast_areas``, otherwise the join is left to AQE."""
    side = F.broadcast(stats) if num_areas is not None and num_areas <= max_broadcast_areas else stats
    return located.join(side, "AREA_NAME", "left")


def population_as_of(inspections: DataFrame, locations_full: DataFrame,
                     slices: Sequence[tuple] = DEFAULT_CENSUS_SLICES) -> DataFrame:
    """One left join on establishment + point, then the inspection year picks the census.

    ``neigh_pop`` is the population of the census valid in that year (NULL for years with no
    usable census); ``pop_census_year`` is set for matched rows only.  Rows of every year are
    kept (the source's three filtered joins lose years outside its slices).
    """
    keys = EST + ["latitude", "longitude"]
    # Right-side keys are renamed so the join stays unambiguous when both sides derive from the
    # same inspections frame; coordinates match null-safely (NULL = NULL, as the source's merge).
    right = (locations_full.withColumn("_matched", F.lit(True))
             .withColumnsRenamed({k: f"_r_{k}" for k in keys}))
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    j = inspections.join(right, cond, "left").drop(*[f"_r_{k}" for k in keys])
    year = F.year("inspection_date")
    pop, census = None, None
    for lo, hi, col, cy in slices:
        in_slice = (year >= lo) if hi is None else year.between(lo, hi)
        pv = F.col(col).cast("double") if col else F.lit(None).cast("double")
        pop = F.when(in_slice, pv) if pop is None else pop.when(in_slice, pv)
        census = (F.when(in_slice, F.lit(cy)) if census is None else census.when(in_slice, F.lit(cy)))
    census = F.when(F.col("_matched"), census)
    drop = [c for c in ("neigh_pop_2011", "neigh_pop_2016", "_matched") if c in j.columns]
    return j.withColumn("neigh_pop", pop).withColumn("pop_census_year", census.cast("int")).drop(*drop)


# ---- crimes ----------------------------------------------------------------------------------

def crime_filter(crimes: DataFrame, premises: Sequence[str] = CRIME_PREMISES_KEPT,
                 offences_dropped: Sequence[str] = CRIME_OFFENCES_DROPPED) -> DataFrame:
    """premises in the kept list and offence not in the dropped list (a NULL offence is
    kept, as a pandas ``~isin`` keeps it)."""
    return crimes.where(F.col("premises_t").isin(list(premises))
                        & ~F.coalesce(F.col("offence").isin(list(offences_dropped)), F.lit(False)))


def _crime_base(crimes: DataFrame, date_col: str) -> DataFrame:
    return crime_filter(crimes).select(F.col("Neighbourh").alias("AREA_NAME"),
                                       F.col("occurrence").alias(date_col), "MCI", "Index_")


def crime_daily(crimes: DataFrame, date_col: str = "inspection_date") -> DataFrame:
    """Crimes per area, day and type."""
    return (_crime_base(crimes, date_col).groupBy("AREA_NAME", date_col, "MCI")
            .agg(F.count("Index_").cast("bigint").alias("crimes")))


def crime_daily_pivot(crimes: DataFrame, date_col: str = "inspection_date", types: Sequence[str] = CRIME_TYPES,
                      mode: str = "presence") -> DataFrame:
    """One row per area × day, one ``neigh_<type>`` column per crime type, missing → 0.

    ``mode="presence"`` reproduces the source (counting already-counted rows gives 0/1 cells);
    ``mode="sum"`` gives the number of crimes.  The type list is a parameter, so the plan is
    static and no distinct job runs.
    """
    daily = crime_daily(crimes, date_col)
    agg = F.count("crimes") if mode == "presence" else F.sum("crimes")
    p = daily.groupBy("AREA_NAME", date_col).pivot("MCI", list(types)).agg(agg.cast("bigint"))
    p = p.na.fill(0, subset=list(types))
    return p.withColumnsRenamed({t: f"neigh_{t}" for t in types})


def crime_join(inspections: DataFrame, pivot: DataFrame, date_col: str = "inspection_date") -> DataFrame:
    """Inspections ⟕ daily crime cells on (area, day)."""
    return inspections.join(pivot, ["AREA_NAME", date_col], "left")


def crime_fill_by_year(df: DataFrame, start_year: int = DEFAULT_CRIME_START_YEAR,
                       types: Sequence[str] = CRIME_TYPES, date_col: str = "inspection_date") -> DataFrame:
    """crime cells → 0 from the first year with crime data; earlier years stay NULL."""
    later = F.year(date_col) >= start_year
    return df.withColumns({f"neigh_{t}": F.when(later, F.coalesce(F.col(f"`neigh_{t}`"), F.lit(0)))
                          .otherwise(F.col(f"`neigh_{t}`")) for t in types})


def spot_check_sample(df: DataFrame, key: Sequence[str], n: int = 25, seed: int = 42) -> DataFrame:
    """L3: a repeatable sample of ``n`` rows: those with the smallest seeded hashes of the key, whatever the engine and
    the partitions.  Each task keeps its ``n`` smallest."""
    return df.withColumn("_h", hash_text(seed, key)).orderBy("_h", *key).limit(n).drop("_h")
