"""DuckDB oracle SQL, one text per registered query (same names as ``catalog.QUERIES``).

Written independently of the Spark operators: set-based SQL over the same fixture views
(``fixtures.ORACLE_VIEWS``).  Dates are rendered as ISO text and doubles rounded to 6 digits,
matching ``report.as_report``.
"""

from __future__ import annotations

from .. import fixtures as fx
from ..constants import ESTABLISHMENT_TYPES_WANTED

ORACLES: dict[str, str] = {}

# --- fixed values: the column name of every action and court outcome in the fixture ---
ACTION_NAMES = {"Closure Order": "num_closure_order", "Corrected During Inspection": "num_corrected_during_inspection",
                "Education Provided": "num_education_provided", "Notice to Comply": "num_notice_to_comply",
                "Summons": "num_summons", "Ticket": "num_ticket", None: "action_null"}
OUTCOME_NAMES = {"Charges Withdrawn": "num_charges_withdrawn", "Conviction - Fined": "num_conviction_fined",
                 "Conviction - Fined & Order to Close by Court": "num_conviction_fined_order_to_close_by_court",
                 "Pending": "num_pending", None: "court_outcome_null"}

EST = "establishment_id, establishmenttype, establishment_address"
EST_A = "a.establishment_id, a.establishmenttype, a.establishment_address"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


TYPES_SQL = "(" + ", ".join(_q(t) for t in ESTABLISHMENT_TYPES_WANTED) + ")"

INFR = """
infr AS (
    SELECT row_id, establishment_id, inspection_id, establishment_name, establishmenttype,
           establishment_address, establishment_status,
           CAST(minimum_inspections_peryear AS BIGINT) AS minimum_inspections_peryear,
           infraction_details, inspection_date, severity, action, court_outcome,
           TRY_CAST(replace(amount_fined_raw, ',', '') AS DOUBLE) AS amount_fined,
           latitude, longitude
    FROM infractions
)"""


def _valid(strict: bool = False) -> str:
    if strict:
        cond = (f"establishmenttype IN {TYPES_SQL} AND (severity IS NULL OR "
                "severity IN ('S - Significant', 'C - Crucial', 'M - Minor'))")
    else:
        cond = (f"establishmenttype IN {TYPES_SQL} AND severity IS NULL "
                "OR severity IN ('S - Significant', 'C - Crucial', 'M - Minor')")
    return f"valid AS (SELECT * FROM infr WHERE {cond})"


INNER = f"""
inner_g AS (
    SELECT {EST}, inspection_date, inspection_id, establishment_status, action, court_outcome,
           string_agg(infraction_details, '. ' ORDER BY infraction_details) AS infractions_summary,
           CAST(SUM(CASE WHEN severity LIKE '%S - Significant' THEN 1 ELSE 0 END) AS BIGINT) AS num_significant,
           CAST(SUM(CASE WHEN severity LIKE '%C - Crucial' THEN 1 ELSE 0 END) AS BIGINT) AS num_crucial,
           CAST(SUM(CASE WHEN severity LIKE '%M - Minor' THEN 1 ELSE 0 END) AS BIGINT) AS num_minor,
           CAST(SUM(CASE WHEN severity LIKE '%NA -' THEN 1 ELSE 0 END) AS BIGINT) AS num_na,
           CAST(COUNT(infraction_details) AS BIGINT) AS num_infractions,
           CAST(COUNT(*) AS BIGINT) AS num_rows
    FROM valid
    GROUP BY {EST}, inspection_date, inspection_id, establishment_status, action, court_outcome
)"""


def _pivot_sql(weight: str, actions: dict = ACTION_NAMES, outcomes: dict = OUTCOME_NAMES) -> str:
    parts = []
    for column, names in (("action", actions), ("court_outcome", outcomes)):
        for name in dict.fromkeys(names.values()):
            tests = " OR ".join(f"{column} IS NULL" if v is None else f"{column} = {_q(v)}" for v, n in names.items() if n == name)
            parts.append(f"CAST(SUM(CASE WHEN {tests} THEN {weight} ELSE 0 END) AS BIGINT) AS {name}")
    return ",\n           ".join(parts)


def _outer(weight: str = "1", **names) -> str:
    return f"""
agg AS (
    SELECT {EST}, inspection_date, inspection_id, establishment_status,
           string_agg(infractions_summary, '. ' ORDER BY infractions_summary) AS infractions_summary,
           CAST(SUM(num_significant) AS BIGINT) AS num_significant,
           CAST(SUM(num_crucial) AS BIGINT) AS num_crucial,
           CAST(SUM(num_minor) AS BIGINT) AS num_minor,
           CAST(SUM(num_na) AS BIGINT) AS num_na,
           CAST(SUM(num_infractions) AS BIGINT) AS num_infractions,
           {_pivot_sql(weight, **names)}
    FROM inner_g
    GROUP BY {EST}, inspection_date, inspection_id, establishment_status
)"""


def chain(*parts: str, views=("infractions",)) -> str:
    return fx.oracle_cte(*views).rstrip() + ",\n" + ",\n".join(p.strip() for p in parts) + "\n"


SINGLE_DAY = f"""
one_day AS (
    SELECT a.* FROM agg a
    JOIN (SELECT {EST}, inspection_id FROM agg
          GROUP BY {EST}, inspection_id HAVING COUNT(DISTINCT inspection_date) = 1) k
      ON a.establishment_id = k.establishment_id AND a.establishmenttype = k.establishmenttype
     AND a.establishment_address = k.establishment_address AND a.inspection_id = k.inspection_id
)"""

GAP = f"""
gap AS (
    SELECT *, CAST(abs(datediff('day', inspection_date,
                 lead(inspection_date) OVER (PARTITION BY {EST}
                     ORDER BY inspection_id, inspection_date, establishment_status))) AS BIGINT) AS days_to_next
    FROM one_day
)"""

GAP_STRICT = f"""
gap AS (
    SELECT *, CAST(datediff('day', lag(inspection_date) OVER (PARTITION BY {EST}
                     ORDER BY inspection_date, inspection_id, establishment_status), inspection_date) AS BIGINT)
              AS days_from_prev
    FROM one_day
)"""

LABELLED = """
kept AS (SELECT * EXCLUDE (days_to_next) FROM gap WHERE days_to_next IS NULL OR days_to_next > 2),
labelled AS (
    SELECT *, CAST(CASE WHEN num_significant > 0 OR num_crucial > 0 THEN 1 ELSE 0 END AS BIGINT) AS is_infraction
    FROM kept
)"""


def _d(src: str, dates=("inspection_date",), doubles=()) -> str:
    """Final select: date columns as ISO text, doubles rounded to 6 digits."""
    repl = [f"CAST({c} AS VARCHAR) AS {c}" for c in dates]
    repl += [f"ROUND({c}, 6) AS {c}" for c in doubles]
    if not repl:
        return f"SELECT * FROM {src}"
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM {src}"


INFR_DOUBLES = ("amount_fined", "latitude", "longitude")


AGG_CHAIN = (INFR, _valid(), INNER, _outer())
LABEL_CHAIN = AGG_CHAIN + (SINGLE_DAY, GAP, LABELLED)

ORACLES["normalise_infractions"] = chain(INFR) + _d(src="infr", doubles=INFR_DOUBLES)
ORACLES["valid_infractions"] = chain(INFR, _valid()) + _d(src="valid", doubles=INFR_DOUBLES)
ORACLES["valid_infractions_strict"] = chain(INFR, _valid(True)) + _d(src="valid", doubles=INFR_DOUBLES)
ORACLES["infraction_groups"] = chain(INFR, _valid(), INNER) + _d(src="(SELECT * EXCLUDE (num_rows) FROM inner_g)")
ORACLES["infractions_summary"] = chain(INFR) + f"""
SELECT {EST}, inspection_id,
       string_agg(infraction_details, '. ' ORDER BY infraction_details) AS infractions_summary
FROM infr GROUP BY {EST}, inspection_id"""
ORACLES["distinct_actions"] = chain(INFR) + "SELECT DISTINCT action FROM infr"
ORACLES["distinct_outcomes"] = chain(INFR) + "SELECT DISTINCT court_outcome FROM infr"
ORACLES["inspections_aggregate"] = chain(*AGG_CHAIN) + _d(src="agg")
ORACLES["inspections_aggregate_rows"] = chain(INFR, _valid(), INNER, _outer("num_rows")) + _d(src="agg")
ORACLES["inspections_aggregate_strict"] = chain(INFR, _valid(True), INNER, _outer()) + _d(src="agg")
ORACLES["multi_day_inspections"] = chain(*AGG_CHAIN) + f"""
SELECT {EST}, inspection_id, CAST(COUNT(DISTINCT inspection_date) AS BIGINT) AS num_dates
FROM agg GROUP BY {EST}, inspection_id HAVING COUNT(DISTINCT inspection_date) > 1"""
ORACLES["single_day_inspections"] = chain(*AGG_CHAIN, SINGLE_DAY) + _d(src="one_day")
ORACLES["days_to_next"] = chain(*AGG_CHAIN, SINGLE_DAY, GAP) + _d(src="gap")
ORACLES["reinspections"] = chain(*AGG_CHAIN, SINGLE_DAY, GAP) + _d(src="gap WHERE days_to_next <= 2")
ORACLES["no_reinspections"] = chain(*AGG_CHAIN, SINGLE_DAY, GAP) + _d(
    src="(SELECT * EXCLUDE (days_to_next) FROM gap WHERE days_to_next IS NULL OR days_to_next > 2)")
ORACLES["no_reinspections_strict"] = chain(*AGG_CHAIN, SINGLE_DAY, GAP_STRICT) + _d(
    src="(SELECT * EXCLUDE (days_from_prev) FROM gap WHERE days_from_prev IS NULL OR days_from_prev > 2)")
ORACLES["inspection_label"] = chain(*LABEL_CHAIN) + _d(src="labelled")
ORACLES["class_balance"] = chain(*LABEL_CHAIN) + """
SELECT is_infraction, CAST(COUNT(*) AS BIGINT) AS num_inspections,
       ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS fraction
FROM labelled GROUP BY is_infraction"""


# ---- exploration ------------------------------------------------------------------------------

INFR_COLS = ["row_id", "establishment_id", "inspection_id", "establishment_name", "establishmenttype",
             "establishment_address", "establishment_status", "minimum_inspections_peryear",
             "infraction_details", "inspection_date", "severity", "action", "court_outcome", "amount_fined",
             "latitude", "longitude"]
PIVOT_COLS = [*ACTION_NAMES.values(), *OUTCOME_NAMES.values()]
LABELLED_TYPES = ([("establishment_id", "bigint"), ("establishmenttype", "string"),
                   ("establishment_address", "string"), ("inspection_date", "date"),
                   ("inspection_id", "bigint"), ("establishment_status", "string"),
                   ("infractions_summary", "string")]
                  + [(c, "bigint") for c in ("num_significant", "num_crucial", "num_minor", "num_na",
                                             "num_infractions")]
                  + [(c, "bigint") for c in PIVOT_COLS] + [("is_infraction", "int")])
SINGLE_DAY_CHAIN = AGG_CHAIN + (SINGLE_DAY,)

ORACLES["preview_rows"] = chain(INFR) + _d(
    src="(SELECT * FROM infr ORDER BY " + ", ".join(f"{c} ASC NULLS FIRST" for c in INFR_COLS) + " LIMIT 6)",
    doubles=INFR_DOUBLES)
ORACLES["filter_inspection"] = chain(INFR) + _d(src="(SELECT * FROM infr WHERE inspection_id = 1)",
                                                doubles=INFR_DOUBLES)
ORACLES["missing_coords"] = chain(INFR) + _d(
    src="(SELECT * FROM infr WHERE latitude IS NULL OR longitude IS NULL)", doubles=INFR_DOUBLES)
ORACLES["na_severity_rows"] = chain(INFR) + """
SELECT infraction_details, severity, establishment_status FROM infr WHERE severity LIKE '%NA -%'"""
ORACLES["na_severity_closed"] = chain(INFR) + """
SELECT infraction_details, severity, establishment_status FROM infr
WHERE severity LIKE '%NA -%' AND establishment_status = 'Closed'"""
ORACLES["establishments_per_inspection"] = chain(INFR) + """
SELECT inspection_id, CAST(COUNT(DISTINCT establishment_id) AS BIGINT) AS num_establishments
FROM infr GROUP BY inspection_id"""
ORACLES["inspections_per_establishment"] = chain(INFR) + f"""
SELECT {EST}, CAST(COUNT(DISTINCT inspection_id) AS BIGINT) AS num_inspections FROM infr GROUP BY {EST}"""
ORACLES["infractions_per_inspection"] = chain(INFR) + f"""
SELECT {EST}, inspection_id, CAST(COUNT(*) AS BIGINT) AS number_of_infractions
FROM infr GROUP BY {EST}, inspection_id"""
ORACLES["missing_address_count"] = chain(INFR) + """
SELECT CAST(COUNT(*) AS BIGINT) AS num_missing_addresses FROM infr WHERE establishment_address IS NULL"""
ORACLES["addresses_missing_coords"] = chain(INFR) + """
SELECT establishment_address, ROUND(MAX(latitude), 6) AS latitude, ROUND(MAX(longitude), 6) AS longitude
FROM infr WHERE latitude IS NULL OR longitude IS NULL GROUP BY establishment_address"""
ORACLES["coord_null_consistency"] = chain(INFR) + """
SELECT CAST(SUM(CASE WHEN latitude IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS num_miss_lat,
       CAST(SUM(CASE WHEN longitude IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS num_miss_lon,
       CAST(COUNT(DISTINCT establishment_address) AS BIGINT) AS num_establishments
FROM (SELECT establishment_address, MAX(latitude) AS latitude, MAX(longitude) AS longitude
      FROM infr WHERE latitude IS NULL OR longitude IS NULL GROUP BY establishment_address) combo"""
ORACLES["severity_counts"] = chain(INFR) + """
SELECT severity, CAST(COUNT(*) AS BIGINT) AS num_infractions FROM infr GROUP BY severity"""
ORACLES["na_status_counts"] = chain(INFR) + """
SELECT establishment_status, CAST(COUNT(*) AS BIGINT) AS num_rows FROM infr
WHERE severity LIKE '%NA -%' GROUP BY establishment_status"""
ORACLES["severity_status_counts"] = chain(INFR) + """
SELECT severity, establishment_status, CAST(COUNT(*) AS BIGINT) AS num_infractions
FROM infr GROUP BY severity, establishment_status"""
ORACLES["type_summary"] = chain(INFR) + """
SELECT establishmenttype, CAST(COUNT(DISTINCT inspection_id) AS BIGINT) AS num_inspections,
       CAST(COUNT(infraction_details) AS BIGINT) AS num_infractions
FROM infr WHERE severity NOT LIKE '%NA -' AND severity IS NOT NULL GROUP BY establishmenttype"""
ORACLES["est_recount"] = chain(*SINGLE_DAY_CHAIN) + f"""
SELECT {EST}, CAST(COUNT(inspection_id) AS BIGINT) AS num_inspection_ids,
       CAST(COUNT(inspection_date) AS BIGINT) AS num_inspection_dates
FROM one_day GROUP BY {EST}"""
ORACLES["status_per_inspection"] = chain(*LABEL_CHAIN) + f"""
SELECT {EST}, inspection_id, CAST(inspection_date AS VARCHAR) AS inspection_date,
       CAST(COUNT(DISTINCT establishment_status) AS BIGINT) AS num_statuses
FROM labelled GROUP BY {EST}, inspection_id, inspection_date"""
ORACLES["null_counts"] = chain(INFR) + """
UNPIVOT (SELECT """ + ", ".join(f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS {c}" for c in INFR_COLS) + """
         FROM infr)
ON COLUMNS(*) INTO NAME "column" VALUE num_missing"""


def _profile_sql() -> str:
    cols = [c for c, _ in LABELLED_TYPES]
    complete = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    pack = ", ".join(f"{c} := CAST({c} AS VARCHAR)" for c in cols)
    aggs = ["CAST(COUNT(*) AS BIGINT) AS _n", f"min(CASE WHEN {complete} THEN struct_pack({pack}) END) AS _s"]
    for i, c in enumerate(cols):
        aggs.append(f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS _m{i}")
        aggs.append(f"CAST(COUNT(DISTINCT {c}) AS BIGINT) AS _d{i}")
    wide = "SELECT " + ",\n       ".join(aggs) + " FROM labelled"
    parts = [f"SELECT '{c}' AS \"column\", '{t}' AS dtype, _m{i} AS num_missing, _n AS num, _d{i} AS nunique, "
             f"_s.{c} AS sample_value FROM w" for i, (c, t) in enumerate(LABELLED_TYPES)]
    return chain(*LABEL_CHAIN, f"w AS ({wide})") + "\nUNION ALL\n".join(parts)


ORACLES["profile_table"] = _profile_sql()
ORACLES["head_tail"] = chain(*LABEL_CHAIN) + _d(src="""(
  (SELECT *, 'head' AS "end" FROM labelled
   ORDER BY establishment_id ASC NULLS FIRST, inspection_id ASC NULLS FIRST, inspection_date ASC NULLS FIRST LIMIT 5)
  UNION ALL
  (SELECT *, 'tail' AS "end" FROM labelled
   ORDER BY establishment_id DESC NULLS LAST, inspection_id DESC NULLS LAST, inspection_date DESC NULLS LAST LIMIT 5))""")
ORACLES["histogram_bins"] = chain(INFR) + """
, st AS (SELECT MIN(amount_fined) AS lo, MAX(amount_fined) AS hi FROM infr),
b AS (SELECT CASE WHEN st.hi = st.lo THEN 0
                  ELSE CAST(least(floor((amount_fined - st.lo) / ((st.hi - st.lo) / 10.0)), 9) AS INTEGER) END AS bin
      FROM infr, st WHERE amount_fined IS NOT NULL)
SELECT CAST(bin AS BIGINT) AS bin, ROUND(st.lo + bin * ((st.hi - st.lo) / 10.0), 6) AS bin_start,
       ROUND(st.lo + (bin + 1) * ((st.hi - st.lo) / 10.0), 6) AS bin_end, CAST(COUNT(*) AS BIGINT) AS "count"
FROM b, st GROUP BY bin, st.lo, st.hi"""
ORACLES["expect_no_na"] = chain(*LABEL_CHAIN) + """
SELECT 'no_na_severity' AS expectation, CAST(COUNT(*) AS BIGINT) AS num_rows,
       CAST(COUNT(*) FILTER (WHERE num_na > 0) AS BIGINT) AS num_violations FROM labelled"""
ORACLES["expect_recount"] = chain(*SINGLE_DAY_CHAIN) + f"""
SELECT 'ids_equal_dates' AS expectation, CAST(COUNT(*) AS BIGINT) AS num_rows,
       CAST(COUNT(*) FILTER (WHERE ni <> nd) AS BIGINT) AS num_violations
FROM (SELECT COUNT(inspection_id) AS ni, COUNT(inspection_date) AS nd FROM one_day GROUP BY {EST}) r"""
ORACLES["expect_recount_total"] = chain(*SINGLE_DAY_CHAIN) + f"""
SELECT 'recount_equals_rows' AS expectation, CAST(SUM(ni) AS BIGINT) AS recounted, (SELECT CAST(COUNT(*) AS BIGINT) FROM one_day) AS num_rows,
       SUM(ni) = (SELECT COUNT(*) FROM one_day) AS ok
FROM (SELECT COUNT(inspection_id) AS ni FROM one_day GROUP BY {EST})"""
ORACLES["expect_single_status"] = chain(*LABEL_CHAIN) + f"""
SELECT 'one_status_per_inspection' AS expectation, CAST(COUNT(*) AS BIGINT) AS num_rows,
       CAST(COUNT(*) FILTER (WHERE ns <> 1) AS BIGINT) AS num_violations
FROM (SELECT COUNT(DISTINCT establishment_status) AS ns FROM labelled
      GROUP BY {EST}, inspection_id, inspection_date) r"""


# ---- stage 3-4 ----------------------------------------------------------------------------------

GEO_VIEWS = ("infractions", "addressinfo", "area_names", "profile_long", "crimes")
AREA_NO = fx.area_of_point_sql("l.latitude", "l.longitude")
CRIME_TYPES_SQL = ["Assault", "Auto Theft", "Break and Enter", "Robbery", "Theft Over"]

FILLED = f"""
coords AS (SELECT {EST}, MAX(latitude) AS latitude, MAX(longitude) AS longitude FROM infr GROUP BY {EST}),
geo AS (SELECT upper(replace(address, ', Toronto, ON, Canada', '')) AS establishment_address,
               MAX(latitude) AS latitude_geo, MAX(longitude) AS longitude_geo
        FROM addressinfo GROUP BY 1),
filled AS (
    SELECT lb.*, COALESCE(c.latitude, g.latitude_geo) AS latitude, COALESCE(c.longitude, g.longitude_geo) AS longitude
    FROM labelled lb
    LEFT JOIN coords c ON lb.establishment_id = c.establishment_id AND lb.establishmenttype = c.establishmenttype
                      AND lb.establishment_address = c.establishment_address
    LEFT JOIN geo g ON lb.establishment_address = g.establishment_address
),
locs AS (SELECT {EST}, MAX(latitude) AS latitude, MAX(longitude) AS longitude FROM filled GROUP BY {EST}),
located AS (
    SELECT l.*, a.AREA_NAME, a.Shape__Area FROM locs l JOIN area_names a ON a.area_no = {AREA_NO}
),
pop AS (
    SELECT area_name || ' (' || neighbourhood_number || ')' AS AREA_NAME,
           TRY_CAST(replace(pop_2011, ',', '') AS BIGINT) AS pop_2011,
           TRY_CAST(replace(pop_2016, ',', '') AS BIGINT) AS pop_2016
    FROM profile_long
),
stats AS (
    SELECT a.AREA_NAME, a.Shape__Area AS neigh_shape_area, a.Shape__Length AS neigh_shape_length,
           CAST(NULL AS VARCHAR) AS neigh_classification, CAST(NULL AS VARCHAR) AS neigh_classification_code,
           e.n AS neigh_establishments_inspected, p.pop_2011 AS neigh_pop_2011, p.pop_2016 AS neigh_pop_2016
    FROM area_names a
    LEFT JOIN (SELECT AREA_NAME, CAST(COUNT(*) AS BIGINT) AS n FROM located GROUP BY AREA_NAME) e ON a.AREA_NAME = e.AREA_NAME
    LEFT JOIN pop p ON a.AREA_NAME = p.AREA_NAME
),
locfull AS (SELECT l.*, s.* EXCLUDE (AREA_NAME) FROM located l LEFT JOIN stats s ON l.AREA_NAME = s.AREA_NAME),
withpop AS (
    SELECT f.*, lf.AREA_NAME, lf.Shape__Area, lf.neigh_shape_area, lf.neigh_shape_length, lf.neigh_classification,
           lf.neigh_classification_code, lf.neigh_establishments_inspected,
           CASE WHEN year(f.inspection_date) BETWEEN 1995 AND 1996 THEN CAST(NULL AS DOUBLE)
                WHEN year(f.inspection_date) BETWEEN 1997 AND 1999 THEN CAST(lf.neigh_pop_2011 AS DOUBLE)
                WHEN year(f.inspection_date) >= 2000 THEN CAST(lf.neigh_pop_2016 AS DOUBLE) END AS neigh_pop,
           CASE WHEN lf.establishment_id IS NOT NULL THEN
                CASE WHEN year(f.inspection_date) BETWEEN 1995 AND 1996 THEN 2006
                     WHEN year(f.inspection_date) BETWEEN 1997 AND 1999 THEN 2011
                     WHEN year(f.inspection_date) >= 2000 THEN 2016 END END AS pop_census_year
    FROM filled f LEFT JOIN locfull lf
      ON f.establishment_id = lf.establishment_id AND f.establishmenttype = lf.establishmenttype
     AND f.establishment_address = lf.establishment_address
     AND f.latitude IS NOT DISTINCT FROM lf.latitude AND f.longitude IS NOT DISTINCT FROM lf.longitude
)"""

CRIME = """
cf AS (SELECT * FROM crimes WHERE premises_t IN ('Outside', 'Commercial', 'Other')
       AND NOT COALESCE(offence IN ('Robbery - Vehicle Jacking', 'Theft From Motor Vehicle Over', 'Robbery - Taxi',
                                     'Robbery - Home Invasion', 'Robbery - Financial Institute',
                                     'B&E - M/Veh To Steal Firearm'), false)),
cd AS (SELECT Neighbourh AS AREA_NAME, occurrence AS inspection_date, MCI, CAST(COUNT(Index_) AS BIGINT) AS crimes
       FROM cf GROUP BY 1, 2, 3)"""


def _crime_pivot(mode: str) -> str:
    agg = "COUNT(crimes)" if mode == "presence" else "SUM(crimes)"
    cols = ",\n           ".join(f"CAST(COALESCE({agg} FILTER (WHERE MCI = '{t}'), 0) AS BIGINT) AS \"neigh_{t}\""
                                  for t in CRIME_TYPES_SQL)
    return f"pv AS (SELECT AREA_NAME, inspection_date,\n           {cols}\n    FROM cd GROUP BY AREA_NAME, inspection_date)"


CRIME_COLS = ", ".join(f'pv."neigh_{t}"' for t in CRIME_TYPES_SQL)
CRIMEJOIN = f"""
cj AS (SELECT w.*, {CRIME_COLS} FROM withpop w LEFT JOIN pv
       ON w.AREA_NAME = pv.AREA_NAME AND w.inspection_date = pv.inspection_date)"""
CRIMEFILL = "cfill AS (SELECT * REPLACE (" + ", ".join(
    f'CASE WHEN year(inspection_date) >= 1998 THEN COALESCE("neigh_{t}", 0) ELSE "neigh_{t}" END AS "neigh_{t}"'
    for t in CRIME_TYPES_SQL) + ") FROM cj)"

GEO_CHAIN = LABEL_CHAIN + (FILLED,)
LOC_DOUBLES = ("latitude", "longitude", "Shape__Area")
POP_DOUBLES = LOC_DOUBLES + ("neigh_shape_area", "neigh_shape_length", "neigh_pop")


def gchain(*parts: str) -> str:
    return chain(*parts, views=GEO_VIEWS)


def _title_sql(col: str) -> str:
    """Python-style title case for the fixture's ASCII text: upper after a non-letter."""
    return (f"list_aggr(list_transform(range(1, length({col}) + 1), lambda i: CASE WHEN i = 1 OR NOT regexp_matches("
            f"substr({col}, i - 1, 1), '[A-Za-z]') THEN upper(substr({col}, i, 1)) ELSE lower(substr({col}, i, 1)) END),"
            f" 'string_agg', '')")


ORACLES["coords_per_establishment"] = chain(INFR) + f"""
SELECT {EST}, ROUND(MAX(latitude), 6) AS latitude, ROUND(MAX(longitude), 6) AS longitude FROM infr GROUP BY {EST}"""
ORACLES["title_address"] = chain(INFR) + f"""
SELECT DISTINCT {_title_sql('establishment_address')} || ', Toronto, ON, Canada' AS address
FROM (SELECT establishment_address FROM infr WHERE latitude IS NULL OR longitude IS NULL GROUP BY establishment_address) m"""
ORACLES["addresses_to_geocode"] = gchain(*LABEL_CHAIN) + f"""
, coords AS (SELECT {EST}, MAX(latitude) AS latitude, MAX(longitude) AS longitude FROM infr GROUP BY {EST}),
miss AS (SELECT lb.establishment_address FROM labelled lb
         LEFT JOIN coords c ON lb.establishment_id = c.establishment_id AND lb.establishmenttype = c.establishmenttype
                           AND lb.establishment_address = c.establishment_address
         WHERE c.latitude IS NULL OR c.longitude IS NULL GROUP BY lb.establishment_address),
t AS (SELECT DISTINCT {_title_sql('establishment_address')} || ', Toronto, ON, Canada' AS address FROM miss)
SELECT address FROM t WHERE address NOT IN (SELECT address FROM addressinfo WHERE address IS NOT NULL)"""
ORACLES["incomplete_addresses"] = gchain(INFR) + _d(src="""(SELECT * FROM addressinfo WHERE postalcode IS NULL
    OR locality IS NULL OR formattedaddress IS NULL OR latitude IS NULL OR longitude IS NULL)""", dates=(),
    doubles=("latitude", "longitude"))
ORACLES["retry_addresses"] = gchain(INFR) + _d(src="""(SELECT * FROM addressinfo WHERE address NOT IN (
    SELECT address FROM addressinfo WHERE postalcode IS NULL OR locality IS NULL OR formattedaddress IS NULL
    OR latitude IS NULL OR longitude IS NULL))""", dates=(), doubles=("latitude", "longitude"))
ORACLES["fill_coordinates"] = gchain(*GEO_CHAIN) + _d(src="filled", doubles=("latitude", "longitude"))
ORACLES["point_in_polygon"] = gchain(*GEO_CHAIN) + _d(src="located", dates=(), doubles=LOC_DOUBLES)
ORACLES["fix_area_names"] = gchain(INFR) + """
SELECT AREA_NAME, ROUND(Shape__Area, 6) AS Shape__Area, ROUND(Shape__Length, 6) AS Shape__Length,
       CAST(NULL AS VARCHAR) AS CLASSIFICATION, CAST(NULL AS VARCHAR) AS CLASSIFICATION_CODE FROM area_names"""
ORACLES["area_name_match"] = ORACLES["fix_area_names"] + """
WHERE AREA_NAME LIKE '%James Town%' OR AREA_NAME LIKE '%Weston-%' OR AREA_NAME LIKE '%Cabbage%'"""
ORACLES["establishments_per_area"] = gchain(*GEO_CHAIN) + """
SELECT AREA_NAME, CAST(COUNT(*) AS BIGINT) AS establishments_inspected FROM located GROUP BY AREA_NAME"""
ORACLES["profile_transpose"] = gchain(*GEO_CHAIN) + "SELECT * FROM pop"
ORACLES["neighbourhood_stats"] = gchain(*GEO_CHAIN) + _d(
    src="stats", dates=(), doubles=("neigh_shape_area", "neigh_shape_length"))
ORACLES["population_as_of"] = gchain(*GEO_CHAIN) + _d(src="withpop", doubles=POP_DOUBLES)
ORACLES["crime_filter"] = gchain(CRIME) + "SELECT * REPLACE (CAST(occurrence AS VARCHAR) AS occurrence) FROM cf"
ORACLES["crime_daily"] = gchain(CRIME) + _d(src="cd")
ORACLES["crime_daily_pivot"] = gchain(CRIME, _crime_pivot("presence")) + _d(src="pv")
ORACLES["crime_daily_pivot_sum"] = gchain(CRIME, _crime_pivot("sum")) + _d(src="pv")
ORACLES["crime_join"] = gchain(*GEO_CHAIN, CRIME, _crime_pivot("presence"), CRIMEJOIN) + _d(src="cj", doubles=POP_DOUBLES)
ORACLES["crime_fill_by_year"] = gchain(*GEO_CHAIN, CRIME, _crime_pivot("presence"), CRIMEJOIN, CRIMEFILL) + _d(
    src="cfill", doubles=POP_DOUBLES)


# ---- stage 7: history features ---------------------------------------------------------------------

ACTION_COLS = list(ACTION_NAMES.values())
OUTCOME_COLS = list(OUTCOME_NAMES.values())


def _prev_name(c: str, kind: str) -> str:
    return "num_" + c.replace("num_", f"{kind}_", 1) + "_prev" if c.startswith("num_") else f"num_{c}_prev"


PREV = {c: _prev_name(c, "action") for c in ACTION_COLS}
PREV.update({c: _prev_name(c, "court_outcome") for c in OUTCOME_COLS})
W = f"PARTITION BY {EST} ORDER BY inspection_date, inspection_id, establishment_status"
TYPES3 = ["minor", "significant", "crucial"]


def _features_sql(exclude_current: bool = False, src: str = "labelled") -> str:
    frame = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING" if exclude_current else "ROWS UNBOUNDED PRECEDING"
    lvl1 = [f"datediff('day', lag(inspection_date) OVER (w), inspection_date) AS time_since_last_infrac",
            "COALESCE(lag(establishment_status) OVER (w) = 'Pass', false) AS last_pass",
            "COALESCE(lag(establishment_status) OVER (w) = 'Conditional Pass', false) AS last_cond_pass",
            "lag(inspection_date) OVER (w) AS last_date",
            "CAST(row_number() OVER (w) - 1 AS BIGINT) AS cumulative_inspections",
            f"CAST(SUM(CASE WHEN establishment_status = 'Closed' THEN 1 ELSE 0 END) OVER (w {frame}) AS BIGINT)"
            " AS cumulative_failures"]
    lvl1 += [f"lag(num_{t}) OVER (w) AS num_{t}_prev" for t in TYPES3]
    lvl1 += [f"CAST(SUM(num_{t}) OVER (w {frame}) AS BIGINT) AS cumulative_{t}" for t in TYPES3]
    lvl1 += [f"lag({src}) OVER (w) AS {name}" for src, name in PREV.items()]
    lvl2 = [f"CAST(SUM({name}) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_{name}"
            for name in PREV.values()]
    lvl3 = ["COALESCE(cumulative_failures, 0) <> 0 AS ever_failed",
            "CASE WHEN cumulative_inspections = 0 THEN NULL ELSE cumulative_failures / cumulative_inspections END"
            " AS proportion_past_failures",
            "datediff('day', inspection_date, last_date) AS days_since_last_inspection"]
    for t in TYPES3:
        lvl3.append(f"COALESCE(cumulative_{t}, 0) > 0 AS ever_{t}")
        lvl3.append(f"CASE WHEN cumulative_inspections = 0 THEN NULL ELSE cumulative_{t} / cumulative_inspections END"
                    f" AS proportion_past_{t}")
    for prefix, c in (("last_inspection", "last_date"), ("inspection", "inspection_date")):
        lvl3 += [f"month({c}) AS {prefix}_month", f"isodow({c}) - 1 AS {prefix}_weekday",
                 f"weekofyear({c}) AS {prefix}_weekofyear", f"quarter({c}) AS {prefix}_quarter",
                 f"year({c}) AS {prefix}_year"]
    return (f"f1 AS (SELECT *, {', '.join(lvl1)} FROM {src} WINDOW w AS ({W})),\n"
            f"f2 AS (SELECT *, {', '.join(lvl2)} FROM f1 WINDOW w AS ({W})),\n"
            f"feats AS (SELECT *, {', '.join(lvl3)} FROM f2)")


def _feat_cols(name: str) -> list[str]:
    prev = list(PREV.values())
    groups = {
        "feat_gap": ["time_since_last_infrac", "days_since_last_inspection"],
        "feat_last_status": ["last_pass", "last_cond_pass"],
        "feat_prev_counts": [f"num_{t}_prev" for t in TYPES3] + prev,
        "feat_cumulative": ["cumulative_failures"] + [f"cumulative_{t}" for t in TYPES3],
        "feat_cumulative_prev": [f"cumulative_{p}" for p in prev],
        "feat_ever": ["ever_failed"] + [f"ever_{t}" for t in TYPES3],
        "feat_inspection_index": ["cumulative_inspections"],
        "feat_proportions": ["proportion_past_failures"] + [f"proportion_past_{t}" for t in TYPES3],
        "feat_dates": [f"{p}_{k}" for p in ("last_inspection", "inspection")
                       for k in ("month", "weekday", "weekofyear", "quarter", "year")],
    }
    groups["feat_cumulative_exclusive"] = groups["feat_cumulative"] + groups["feat_ever"]
    if name == "history_features":
        order = ["feat_gap", "feat_last_status", "feat_prev_counts", "feat_cumulative", "feat_cumulative_prev",
                 "feat_ever", "feat_inspection_index", "feat_proportions", "feat_dates"]
        return [c for g in order for c in groups[g]]
    return groups[name]


def _feat_select(name: str) -> str:
    cols = _feat_cols(name)
    sel = []
    for c in cols:
        if c.startswith("proportion_past_"):
            sel.append(f"ROUND({c}, 6) AS {c}")
        elif c in ("time_since_last_infrac", "days_since_last_inspection") or c.endswith(
                ("_month", "_weekday", "_weekofyear", "_quarter", "_year")):
            sel.append(f"CAST({c} AS BIGINT) AS {c}")
        else:
            sel.append(c)
    return (f"SELECT {EST}, inspection_id, CAST(inspection_date AS VARCHAR) AS inspection_date, "
            + ", ".join(sel) + " FROM feats")


for _n in ["history_features", "feat_gap", "feat_last_status", "feat_prev_counts", "feat_cumulative",
           "feat_cumulative_prev", "feat_ever", "feat_inspection_index", "feat_proportions", "feat_dates"]:
    ORACLES[_n] = chain(*LABEL_CHAIN, _features_sql()) + _feat_select(_n)
ORACLES["feat_cumulative_exclusive"] = chain(*LABEL_CHAIN, _features_sql(True)) + _feat_select("feat_cumulative_exclusive")


# ---- stage 8: model table, split, evaluation ---------------------------------------------------------

MODEL_FEATURES = ["AREA_NAME", "Shape__Area", "neigh_shape_length", "time_since_last_infrac", "last_pass",
                  "last_cond_pass", "num_minor_prev", "num_significant_prev", "num_crucial_prev",
                  "cumulative_failures", "cumulative_minor", "cumulative_significant", "cumulative_crucial",
                  "ever_failed", "ever_minor", "ever_significant", "ever_crucial", "cumulative_inspections",
                  "days_since_last_inspection", "last_inspection_month", "last_inspection_weekday",
                  "last_inspection_weekofyear", "last_inspection_quarter", "last_inspection_year",
                  "inspection_month", "inspection_weekday", "inspection_weekofyear", "inspection_quarter",
                  "inspection_year"]
BOOL_FEATURES = {"last_pass", "last_cond_pass", "ever_failed", "ever_minor", "ever_significant", "ever_crucial"}
INT_FEATURES = {"time_since_last_infrac", "days_since_last_inspection"} | {
    c for c in MODEL_FEATURES if c.endswith(("_month", "_weekday", "_weekofyear", "_quarter", "_year"))}
COUNT_FEATURES = ["num_minor_prev", "num_significant_prev", "num_crucial_prev", "cumulative_failures",
                  "cumulative_minor", "cumulative_significant", "cumulative_crucial", "cumulative_inspections"]
NUMERIC_FEATURES = ["time_since_last_infrac", "days_since_last_inspection"]


def _ml_select() -> str:
    sel = []
    for c in MODEL_FEATURES:
        if c == "AREA_NAME":
            sel.append(c)
        elif c in BOOL_FEATURES:
            sel.append(f"COALESCE({c}, false) AS {c}")
        elif c in ("Shape__Area", "neigh_shape_length"):
            sel.append(f"COALESCE({c}, 0) AS {c}")
        elif c in INT_FEATURES:
            sel.append(f"CAST(COALESCE({c}, 0) AS BIGINT) AS {c}")
        else:
            sel.append(f"COALESCE({c}, 0) AS {c}")
    return (f"ml AS (SELECT {EST}, inspection_id, inspection_date, {', '.join(sel)}, is_infraction FROM feats "
            "WHERE AREA_NAME IS NOT NULL)")


ML_CHAIN = GEO_CHAIN + (CRIME, _crime_pivot("presence"), CRIMEJOIN, CRIMEFILL, _features_sql(src="cfill"), _ml_select())
ML_DOUBLES = ("Shape__Area", "neigh_shape_length")
SPLIT = """
mx AS (SELECT MAX(inspection_date) AS d FROM ml),
split AS (SELECT ml.*, CASE WHEN ml.inspection_date >= mx.d - INTERVAL 60 DAY THEN 'test'
                            WHEN ml.inspection_date <= mx.d - INTERVAL 61 DAY THEN 'train' END AS split
          FROM ml, mx),
train AS (SELECT * FROM split WHERE split = 'train'),
test AS (SELECT * FROM split WHERE split = 'test')"""
SPLIT_CHAIN = ML_CHAIN + (SPLIT,)
PRED = """
pred AS (SELECT establishment_id, establishmenttype, establishment_address, inspection_id, inspection_date, AREA_NAME,
                inspection_weekday, is_infraction AS y_true,
                CASE WHEN inspection_id % 5 = 0 THEN 1 - is_infraction ELSE is_infraction END AS y_pred,
                (inspection_id % 1000) / 1000.0 AS probability, 1 AS y_always_infrac
         FROM ml)"""
PRED_CHAIN = ML_CHAIN + (PRED,)


def _cm() -> str:
    parts = []
    for s in ("y_pred", "y_always_infrac"):
        parts.append(f"""SELECT '{s}' AS strategy,
       CAST(SUM(CASE WHEN y_true = 0 AND {s} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
       CAST(SUM(CASE WHEN y_true = 0 AND {s} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
       CAST(SUM(CASE WHEN y_true = 1 AND {s} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
       CAST(SUM(CASE WHEN y_true = 1 AND {s} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp FROM pred""")
    return "cm AS (" + "\nUNION ALL\n".join(parts) + ")"


def _sd(a: str, b: str) -> str:
    return f"COALESCE(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 0.0)"


REPORT = f"""
cmx AS (SELECT *, {_sd('tp', 'tp + fp')} AS p1, {_sd('tp', 'tp + fn')} AS r1,
               {_sd('tn', 'tn + fn')} AS p0, {_sd('tn', 'tn + fp')} AS r0,
               tp + fn AS s1, tn + fp AS s0, tn + fp + fn + tp AS n FROM cm),
cmy AS (SELECT *, {_sd('2 * p1 * r1', 'p1 + r1')} AS f1_1, {_sd('2 * p0 * r0', 'p0 + r0')} AS f1_0 FROM cmx),
report AS (
    SELECT strategy, '0' AS label, p0 AS precision, r0 AS recall, f1_0 AS f1, s0 AS support FROM cmy
    UNION ALL SELECT strategy, '1', p1, r1, f1_1, s1 FROM cmy
    UNION ALL SELECT strategy, 'accuracy', NULL, NULL, {_sd('tp + tn', 'n')}, n FROM cmy
    UNION ALL SELECT strategy, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n FROM cmy
    UNION ALL SELECT strategy, 'weighted avg', {_sd('p0 * s0 + p1 * s1', 'n')}, {_sd('r0 * s0 + r1 * s1', 'n')},
                     {_sd('f1_0 * s0 + f1_1 * s1', 'n')}, n FROM cmy)"""


def _shares_sql(by_expr: str, by_name: str) -> str:
    return f"""
per AS (SELECT CASE WHEN y_true <> y_pred THEN 'incorrect' ELSE 'correct' END AS subset, {by_expr} AS {by_name},
               SUM(y_true) AS t, SUM(y_pred) AS p FROM pred GROUP BY 1, 2),
per2 AS (SELECT * FROM per UNION ALL SELECT 'all', {by_name}, SUM(t), SUM(p) FROM per GROUP BY {by_name}),
shares AS (SELECT subset, {by_name}, CAST(t AS DOUBLE) / NULLIF(SUM(t) OVER (PARTITION BY subset), 0) AS true_share,
                  CAST(p AS DOUBLE) / NULLIF(SUM(t) OVER (PARTITION BY subset), 0) AS pred_share FROM per2)"""


WEEKDAY_SQL = ("CASE inspection_weekday WHEN 0 THEN 'Monday' WHEN 1 THEN 'Tuesday' WHEN 2 THEN 'Wednesday' "
               "WHEN 3 THEN 'Thursday' WHEN 4 THEN 'Friday' WHEN 5 THEN 'Saturday' WHEN 6 THEN 'Sunday' END")

ORACLES["ml_features"] = gchain(*ML_CHAIN) + _d(src="ml", doubles=ML_DOUBLES)
ORACLES["ml_null_policy"] = gchain(*ML_CHAIN) + """
UNPIVOT (SELECT """ + ", ".join(f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS {c}"
                                for c in ["establishment_id", "establishmenttype", "establishment_address",
                                          "inspection_id", "inspection_date"] + MODEL_FEATURES + ["is_infraction"]) + """
         FROM ml)
ON COLUMNS(*) INTO NAME "column" VALUE num_missing"""
ORACLES["time_split"] = gchain(*SPLIT_CHAIN) + _d(src="split", doubles=ML_DOUBLES)
ORACLES["time_split_report"] = gchain(*SPLIT_CHAIN) + """
SELECT CAST(COUNT(*) FILTER (WHERE split = 'train') AS BIGINT) AS num_train,
       CAST(COUNT(*) FILTER (WHERE split = 'test') AS BIGINT) AS num_test,
       CAST(MAX(inspection_date) FILTER (WHERE split = 'train') AS VARCHAR) AS max_train_date,
       CAST(MIN(inspection_date) FILTER (WHERE split = 'test') AS VARCHAR) AS min_test_date FROM split"""
ORACLES["recently_inspected"] = gchain(*SPLIT_CHAIN) + f"""
SELECT {EST}, CAST(MAX(inspection_date) AS VARCHAR) AS inspection_date FROM train GROUP BY {EST}
HAVING MAX(inspection_date) >= DATE '2000-11-01'"""
ORACLES["operating_test_rows"] = gchain(*SPLIT_CHAIN) + _d(src="test", doubles=ML_DOUBLES)
ORACLES["operating_test_rows_strict"] = gchain(*SPLIT_CHAIN) + _d(src=f"""(SELECT * FROM test t WHERE EXISTS (
    SELECT 1 FROM (SELECT {EST} FROM train GROUP BY {EST} HAVING MAX(inspection_date) >= DATE '2000-11-01') r
    WHERE r.establishment_id = t.establishment_id AND r.establishmenttype = t.establishmenttype
      AND r.establishment_address = t.establishment_address))""", doubles=ML_DOUBLES)
_FOLDS = "(VALUES (0, DATE '1999-07-01'), (1, DATE '1999-10-01'), (2, DATE '2000-01-01'), (3, DATE '2000-04-01'), (4, DATE '2000-07-01')) f(fold, start)"
ORACLES["cv_folds"] = gchain(*SPLIT_CHAIN) + _d(src=f"""(
    SELECT t.*, f.fold, CASE WHEN t.inspection_date BETWEEN f.start AND f.start + INTERVAL 60 DAY THEN 'val'
                             ELSE 'train' END AS role
    FROM train t JOIN {_FOLDS} ON t.inspection_date BETWEEN f.start AND f.start + INTERVAL 60 DAY
         OR t.inspection_date BETWEEN DATE '1997-01-01' AND f.start - INTERVAL 1 DAY)""", doubles=ML_DOUBLES)
ORACLES["cv_baseline_records"] = gchain(*SPLIT_CHAIN) + f"""
, r AS (SELECT f.fold, CASE WHEN t.inspection_date BETWEEN f.start AND f.start + INTERVAL 60 DAY THEN 'val' ELSE 'train' END AS role,
               COUNT(*) AS n, AVG(t.is_infraction) AS p
        FROM train t JOIN {_FOLDS} ON t.inspection_date BETWEEN f.start AND f.start + INTERVAL 60 DAY
             OR t.inspection_date BETWEEN DATE '1997-01-01' AND f.start - INTERVAL 1 DAY GROUP BY 1, 2)
SELECT 'always_infrac' AS classifier, CAST(a.fold AS BIGINT) AS split_index, CAST(a.n AS BIGINT) AS len_train, CAST(b.n AS BIGINT) AS len_val,
       CASE WHEN a.p > 0 THEN 1.0::DOUBLE ELSE 0 END AS recall_train, CASE WHEN b.p > 0 THEN 1.0::DOUBLE ELSE 0 END AS recall_test,
       ROUND(a.p, 6) AS precision_train, ROUND(b.p, 6) AS precision_test,
       ROUND(2 * a.p / (1 + a.p), 6) AS f1_train, ROUND(2 * b.p / (1 + b.p), 6) AS f1_test
FROM r a JOIN r b ON a.fold = b.fold AND a.role = 'train' AND b.role = 'val'"""
ORACLES["class_weights"] = gchain(*SPLIT_CHAIN) + _d(src="""(
    SELECT t.*, CASE WHEN is_infraction = 1 THEN c.n / (2.0 * c.n1) ELSE c.n / (2.0 * (c.n - c.n1)) END AS weight
    FROM train t, (SELECT COUNT(*) AS n, SUM(is_infraction) AS n1 FROM train) c)""", doubles=ML_DOUBLES + ("weight",))
ORACLES["gt_zero_flags"] = gchain(*SPLIT_CHAIN) + _d(
    src="(SELECT *, " + ", ".join(f"{c} > 0 AS {c}_gt_zero" for c in COUNT_FEATURES) + " FROM train)",
    doubles=ML_DOUBLES)
ORACLES["top5_values"] = gchain(*SPLIT_CHAIN) + """
, stacked AS (""" + "\nUNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM train"
                                         for c in COUNT_FEATURES) + """),
cnt AS (SELECT "column", value, CAST(COUNT(*) AS BIGINT) AS "count" FROM stacked GROUP BY 1, 2)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY "count" DESC, value ASC NULLS FIRST)
                              AS BIGINT) AS rank FROM cnt) WHERE rank <= 5"""
ORACLES["standardise"] = gchain(*SPLIT_CHAIN) + _d(src="(SELECT t.* REPLACE (" + ", ".join(
    f"(t.{c} - s.m_{c}) / CASE WHEN s.s_{c} = 0 THEN 1 ELSE s.s_{c} END AS {c}" for c in NUMERIC_FEATURES) + ") FROM train t, (SELECT "
    + ", ".join(f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}" for c in NUMERIC_FEATURES) + " FROM train) s)",
    doubles=ML_DOUBLES + tuple(NUMERIC_FEATURES))
ORACLES["baseline_constant"] = gchain(*SPLIT_CHAIN) + _d(src="(SELECT *, 1 AS y_always_infrac FROM test)",
                                                         doubles=ML_DOUBLES)
ORACLES["confusion_matrix"] = gchain(*PRED_CHAIN, _cm()) + "SELECT * FROM cm"
ORACLES["classification_report"] = gchain(*PRED_CHAIN, _cm(), REPORT) + """
SELECT strategy, label, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall, ROUND(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM report"""
ORACLES["metrics_long"] = gchain(*PRED_CHAIN, _cm(), REPORT) + """
SELECT strategy, metric, ROUND(value, 6) AS value, 'test' AS split FROM (
    SELECT strategy, 'precision' AS metric, precision AS value FROM report WHERE label = '1'
    UNION ALL SELECT strategy, 'recall', recall FROM report WHERE label = '1'
    UNION ALL SELECT strategy, 'f1', f1 FROM report WHERE label = '1')"""
ORACLES["metrics_table"] = gchain(*SPLIT_CHAIN) + """
, p AS (SELECT split, is_infraction AS y, CASE WHEN inspection_id % 5 = 0 THEN 1 - is_infraction ELSE is_infraction END AS ml,
               1 AS aw, inspection_id % 2 AS gs FROM split WHERE split IS NOT NULL),
s AS (SELECT split, 'ML' AS strategy, y, ml AS q FROM p UNION ALL SELECT split, 'always_infrac', y, aw FROM p
      UNION ALL SELECT split, 'guess', y, gs FROM p),
c AS (SELECT split, strategy, SUM(CASE WHEN y = 1 AND q = 1 THEN 1.0 ELSE 0 END) AS tp, SUM(CASE WHEN q = 1 THEN 1.0 ELSE 0 END) AS pp,
             SUM(CASE WHEN y = 1 THEN 1.0 ELSE 0 END) AS ap FROM s GROUP BY ALL),
m AS (SELECT split, strategy, COALESCE(tp / NULLIF(pp, 0), 0) AS pr, COALESCE(tp / NULLIF(ap, 0), 0) AS re FROM c)
SELECT ROUND(value, 6) AS value, metric, split, strategy FROM (
    SELECT pr AS value, 'precision' AS metric, split, strategy FROM m WHERE strategy = 'ML' OR split = 'test'
    UNION ALL SELECT re, 'recall', split, strategy FROM m WHERE strategy = 'ML' OR split = 'test'
    UNION ALL SELECT COALESCE(2 * pr * re / NULLIF(pr + re, 0), 0), 'f1', split, strategy FROM m WHERE strategy = 'ML')"""
ORACLES["weekday_error_share"] = gchain(*PRED_CHAIN, _shares_sql(WEEKDAY_SQL, "inspection_weekday_name")) + """
SELECT subset, inspection_weekday_name, ROUND(true_share, 6) AS true_share, ROUND(pred_share, 6) AS pred_share
FROM shares"""
ORACLES["area_error_share"] = gchain(*PRED_CHAIN, _shares_sql("AREA_NAME", "AREA_NAME")) + """
SELECT subset, AREA_NAME, ROUND(true_share, 6) AS true_share, ROUND(pred_share, 6) AS pred_share,
       ROUND(abs(true_share - pred_share), 6) AS diff FROM shares"""
ORACLES["area_error_top15"] = gchain(*PRED_CHAIN, _shares_sql("AREA_NAME", "AREA_NAME")) + """
SELECT * FROM (SELECT subset, AREA_NAME, ROUND(true_share, 6) AS true_share, ROUND(pred_share, 6) AS pred_share,
       ROUND(abs(true_share - pred_share), 6) AS diff,
       CAST(row_number() OVER (PARTITION BY subset ORDER BY abs(true_share - pred_share) DESC NULLS LAST, AREA_NAME)
            AS BIGINT) AS rank FROM shares) WHERE rank <= 15"""
ORACLES["inspection_priority"] = gchain(*PRED_CHAIN) + """
SELECT * REPLACE (CAST(inspection_date AS VARCHAR) AS inspection_date, ROUND(probability, 6) AS probability),
       CAST(greatest(ceil((0.5 - probability) / 0.1), 0) AS BIGINT) AS priority_delay_days,
       CAST(CAST(inspection_date + CAST(greatest(ceil((0.5 - probability) / 0.1), 0) AS INTEGER) AS DATE) AS VARCHAR)
           AS planned_date
FROM pred"""
ORACLES["error_context"] = gchain(*PRED_CHAIN) + f"""
SELECT p.* REPLACE (CAST(p.inspection_date AS VARCHAR) AS inspection_date, ROUND(p.probability, 6) AS probability),
       ROUND(c.latitude, 6) AS latitude, ROUND(c.longitude, 6) AS longitude, ROUND(c.neigh_pop, 6) AS neigh_pop
FROM pred p LEFT JOIN cfill c
  ON p.establishment_id = c.establishment_id AND p.establishmenttype = c.establishmenttype
 AND p.establishment_address = c.establishment_address AND p.inspection_id = c.inspection_id
 AND p.inspection_date = c.inspection_date"""


# ---- sources over the fixture tables ---------------------------------------------------------------

SNAPS = """
snaps AS (SELECT *, CAST(1 AS BIGINT) AS filename FROM infr WHERE year(inspection_date) <= 1998
          UNION ALL
          SELECT *, CAST(2 AS BIGINT) AS filename FROM infr WHERE year(inspection_date) >= 1998)"""
ORACLES["union_snapshots"] = chain(INFR, SNAPS) + _d(src="snaps", doubles=INFR_DOUBLES)
ORACLES["dedup_full_row"] = chain(INFR, SNAPS) + _d(src="(SELECT DISTINCT * EXCLUDE (filename) FROM snaps)",
                                                    doubles=INFR_DOUBLES)
ORACLES["dedup_with_provenance"] = chain(INFR, SNAPS) + _d(src="(SELECT DISTINCT * FROM snaps)", doubles=INFR_DOUBLES)
ORACLES["new_snapshots"] = chain(INFR, SNAPS) + _d(
    src="(SELECT * FROM snaps ANTI JOIN (SELECT DISTINCT filename FROM snaps WHERE filename = 1) loaded USING (filename))",
    doubles=INFR_DOUBLES)
ORACLES["partition_numbering"] = chain(INFR) + """
, o AS (SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx,
               COUNT(*) OVER () AS n FROM orders)
SELECT o_orderkey, o_custkey, CAST(idx AS BIGINT) AS row_index, CAST(floor(idx / (n / 10.0)) AS BIGINT) AS part FROM o"""
ORACLES["scan_xml_snapshot"] = chain(INFR) + _d(
    src="(SELECT *, CAST(year(inspection_date) AS BIGINT) AS filename FROM infr)", doubles=INFR_DOUBLES)
ORACLES["scan_csv_format"] = chain(INFR) + _d(src="infr", doubles=INFR_DOUBLES)
ORACLES["expect_area_count"] = gchain(INFR) + """
SELECT 'area_count' AS expectation, CAST(COUNT(*) AS BIGINT) AS num_rows, CAST(25 AS BIGINT) AS expected,
       COUNT(*) = 25 AS ok FROM area_names"""
ORACLES["expect_population"] = gchain(*GEO_CHAIN) + """
SELECT 'population_present' AS expectation, CAST(COUNT(*) AS BIGINT) AS num_rows,
       CAST(COUNT(*) FILTER (WHERE neigh_pop_2016 IS NULL) AS BIGINT) AS num_violations FROM stats"""
ORACLES["expect_join_cardinality"] = gchain(*GEO_CHAIN) + """
SELECT 'census_join_keeps_rows' AS expectation, (SELECT CAST(COUNT(*) AS BIGINT) FROM filled) AS rows_before,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM withpop) AS rows_after,
       (SELECT COUNT(*) FROM filled) = (SELECT COUNT(*) FROM withpop) AS ok"""
ORACLES["expect_unique_geocode"] = gchain(INFR) + """
SELECT 'one_geocode_per_address' AS expectation, CAST(COUNT(*) AS BIGINT) AS num_rows,
       CAST(COUNT(*) FILTER (WHERE n > 1) AS BIGINT) AS num_violations
FROM (SELECT address, COUNT(*) AS n FROM addressinfo GROUP BY 1)"""


ORACLES["inspection_label_split"] = ORACLES["inspection_label"]
ORACLES["history_features_split"] = ORACLES["history_features"]
ORACLES["no_reinspections_strict_split"] = ORACLES["no_reinspections_strict"]

ODD = """
odd AS (SELECT * REPLACE (CASE WHEN inspection_id % 7 <> 0 THEN inspection_date END AS inspection_date,
                          CASE WHEN establishment_id % 3 <> 0 THEN establishment_address END AS establishment_address)
        FROM labelled)"""
ORACLES["days_to_next_nulls_split"] = chain(*LABEL_CHAIN, ODD) + f"""
SELECT {EST}, inspection_id, CAST(inspection_date AS VARCHAR) AS inspection_date,
       CAST(abs(datediff('day', inspection_date, lead(inspection_date) OVER (PARTITION BY {EST}
            ORDER BY inspection_id NULLS FIRST, inspection_date NULLS FIRST, establishment_status NULLS FIRST))) AS BIGINT) AS days_to_next
FROM odd"""
ORACLES["feat_inspection_index_nulls_split"] = chain(*LABEL_CHAIN, ODD) + f"""
SELECT {EST}, inspection_id, CAST(inspection_date AS VARCHAR) AS inspection_date,
       CAST(row_number() OVER (w) - 1 AS BIGINT) AS cumulative_inspections,
       CAST(SUM(num_minor) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_minor, lag(num_minor) OVER (w) AS num_minor_prev
FROM odd WINDOW w AS (PARTITION BY {EST} ORDER BY inspection_date NULLS FIRST, inspection_id NULLS FIRST, establishment_status NULLS FIRST)"""

ORACLES["inspections_aggregate_collision"] = chain(INFR, """
changed AS (SELECT * REPLACE (
        CASE WHEN action = 'Ticket' AND inspection_id % 2 = 0 THEN 'Verbal Warning' ELSE action END AS action,
        CASE WHEN court_outcome = 'Pending' AND inspection_id % 2 = 0 THEN 'Pen-ding' ELSE court_outcome END AS court_outcome)
    FROM infr)""", _valid().replace("FROM infr", "FROM changed"), INNER,
    _outer(actions={**ACTION_NAMES, "Verbal Warning": "num_verbal_warning"}, outcomes={**OUTCOME_NAMES, "Pen-ding": "num_pending"})) + _d(src="agg")

ORACLES["explode_records"] = "SELECT c_custkey AS id, c_name AS name FROM customer"
ORACLES["incremental_append"] = chain(INFR) + """
SELECT CAST(f AS BIGINT) AS filename, CAST(COUNT(*) AS BIGINT) AS num_rows
FROM (SELECT 1 AS f FROM infr WHERE year(inspection_date) <= 1998 UNION ALL SELECT 2 FROM infr WHERE year(inspection_date) >= 1998) GROUP BY f"""
ORACLES["contiguous_parts_csv"] = """
SELECT CAST(part AS INTEGER) AS part, CAST(COUNT(*) AS BIGINT) AS num_rows, MIN(o_orderkey) AS first_key, MAX(o_orderkey) AS last_key
FROM (SELECT o_orderkey, floor((row_number() OVER (ORDER BY o_orderkey) - 1) / (COUNT(*) OVER () / 10.0)) AS part FROM orders) GROUP BY part"""

ORACLES["load_count_check"] = chain(INFR) + """
SELECT CAST(COUNT(*) AS BIGINT) AS loaded, CAST(COUNT(*) AS BIGINT) AS expected, true AS ok FROM infr"""

ORACLES["stage_csv_handoff"] = ORACLES["inspection_label"]

ORACLES["unlocated_establishments"] = gchain(*GEO_CHAIN) + f"""
SELECT CAST(COUNT(*) AS BIGINT) AS num_dropped FROM locs l
WHERE NOT EXISTS (SELECT 1 FROM located x WHERE x.establishment_id = l.establishment_id
                  AND x.establishmenttype = l.establishmenttype AND x.establishment_address = l.establishment_address)"""


# ---- stream ingest, polygon layers from files, large polygons, catalog, models on their own table ----

ORACLES["snapshot_stream_ingest"] = chain(INFR, SNAPS) + """
SELECT filename, filename AS round, CAST(count(*) AS BIGINT) AS num_rows, CAST(min(inspection_date) AS VARCHAR) AS first_date,
       CAST(max(inspection_date) AS VARCHAR) AS last_date, CAST(sum(CAST(amount_fined AS DECIMAL(20,2))) AS DOUBLE) AS fined
FROM snaps GROUP BY filename"""

_COORDS = f"""
coords AS (SELECT {EST}, max(latitude) AS lat, max(longitude) AS lon FROM infr GROUP BY {EST}),
placed AS (SELECT *, {fx.area_of_point_sql("lat", "lon")} AS area_no FROM coords)"""


def _in_box(u0, u1, v0, v1) -> str:
    return f"(u > {u0} AND u < {u1} AND v > {v0} AND v < {v1})"


ORACLES["geojson_areas"] = gchain(INFR, _COORDS) + f"""
, shares AS (SELECT p.*, (lat - {fx.ORIGIN_LAT}e0 - {fx.CELL_H}e0 * floor(area_no / {fx.GRID}e0)) / {fx.CELL_H}e0 AS v,
                    (lon - ({fx.ORIGIN_LON}e0) - {fx.CELL_W}e0 * (area_no % {fx.GRID}) - {fx.SHEAR}e0 * (lat - {fx.ORIGIN_LAT}e0)) / {fx.CELL_W}e0 AS u
             FROM placed p WHERE area_no IS NOT NULL),
held AS (SELECT * FROM shares WHERE area_no % 3 = 0 OR (area_no % 3 = 1 AND NOT {_in_box(*fx.HOLE)})
         OR (area_no % 3 = 2 AND (u < {fx.PARTS[0]} OR u > {fx.PARTS[1]}) AND NOT {_in_box(*fx.PART_HOLE)}))
SELECT a.AREA_NAME, round(a.Shape__Area, 6) AS Shape__Area, CASE WHEN a.area_no % 3 = 2 THEN 'MultiPolygon' ELSE 'Polygon' END AS geometry_type,
       CAST(a.area_no % 3 + 1 AS BIGINT) AS num_rings, CAST(5 * (a.area_no % 3 + 1) AS BIGINT) AS num_vertices,
       CAST(count(h.establishment_id) AS BIGINT) AS num_located, CAST(coalesce(sum(h.establishment_id), 0) AS BIGINT) AS sum_ids
FROM area_names a LEFT JOIN held h ON h.area_no = a.area_no GROUP BY a.AREA_NAME, a.Shape__Area, a.area_no"""

_W, _S = fx.CONTINENT_LON, fx.CONTINENT_LAT
ORACLES["continent_points"] = gchain(INFR, _COORDS) + f"""
, points AS (SELECT 'establishment' AS kind, establishment_id AS point_id, lon, lat FROM coords WHERE lat IS NOT NULL AND lon IS NOT NULL
            UNION ALL SELECT 'order', o_orderkey, (o_orderkey * 7919) % 360000 / 1000.0 - 180.0, (o_orderkey * 104729) % 170000 / 1000.0 - 84.9995 FROM orders),
sheared AS (SELECT *, lon - ({_W}) - (lat - {_S}) / 2 AS u, lat - {_S} AS v FROM points)
SELECT kind, point_id, (SELECT r_name FROM region WHERE r_regionkey = 1) AS AREA_NAME FROM sheared
WHERE u > 0 AND u < 40 AND v > 0 AND v < 40 AND NOT (u > 10 AND u < 20 AND v > 10 AND v < 20)
UNION ALL
SELECT kind, point_id, a.AREA_NAME FROM (SELECT *, {fx.area_of_point_sql("lat", "lon")} AS area_no FROM points) p JOIN area_names a ON a.area_no = p.area_no"""
ORACLES["continent_points_shuffled"] = ORACLES["continent_points"]

ORACLES["catalog_lifecycle"] = chain(INFR) + """
SELECT CAST(step AS BIGINT) AS step, action, step < 6 AS database_exists, step BETWEEN 2 AND 4 AS table_exists,
       CASE WHEN step BETWEEN 2 AND 4 THEN 'infractions of all snapshots' ELSE '' END AS comment, CAST(CASE WHEN step BETWEEN 2 AND 4 THEN 16 ELSE 0 END AS BIGINT) AS num_columns,
       CAST(CASE step WHEN 3 THEN (SELECT count(*) FROM infr) ELSE 0 END AS BIGINT) AS num_rows
FROM (VALUES (1, 'create database'), (2, 'create table'), (3, 'load'), (4, 'truncate'), (5, 'drop table'), (6, 'drop database')) s(step, action)"""
ORACLES["parquet_gzip"] = chain(INFR) + _d(src="infr", doubles=INFR_DOUBLES)
ORACLES["active_resource"] = """
SELECT CAST(min(c_custkey) AS BIGINT) AS id, min_by(c_name, c_custkey) AS name, TRUE AS datastore_active
FROM customer WHERE c_custkey % 5 = 0 GROUP BY c_mktsegment, c_nationkey"""

_LAMBDAS = dict(zip(NUMERIC_FEATURES, (0.5, 1.5)))      # fixed values: λ of the histogram query


def _yj(x: str, lam: float) -> str:
    up = f"(pow({x} + 1, {lam}e0) - 1) / {lam}e0" if lam else f"ln(1 + {x})"
    down = f"-(pow(1 - {x}, {2 - lam}e0) - 1) / {2 - lam}e0" if lam != 2 else f"-ln(1 - {x})"
    return f"CASE WHEN {x} >= 0 THEN {up} ELSE {down} END"


_FORMS = "\nUNION ALL ".join(f"SELECT '{c}' AS feature, '{form}' AS form, CAST({expr} AS DOUBLE) AS x FROM train"
                             for c, lam in _LAMBDAS.items() for form, expr in (("raw", c), ("transformed", _yj(f"CAST({c} AS DOUBLE)", lam))))
ORACLES["histogram_transformed"] = gchain(*SPLIT_CHAIN) + f"""
, forms AS ({_FORMS}),
edges AS (SELECT feature, form, min(x) AS lo, (max(x) - min(x)) / 10 AS width FROM forms GROUP BY feature, form),
bins AS (SELECT feature, form, lo, width, least(CAST(floor((x - lo) / width) AS BIGINT), 9) AS bin FROM forms JOIN edges USING (feature, form))
SELECT feature, form, bin, round(lo + bin * width, 6) AS bin_start, round(lo + (bin + 1) * width, 6) AS bin_end, CAST(count(*) AS BIGINT) AS "count"
FROM bins GROUP BY feature, form, lo, width, bin"""
ORACLES["yeo_johnson_likelihood"] = gchain(*SPLIT_CHAIN) + "\nUNION ALL ".join(
    f"""SELECT '{c}' AS feature, CAST({i / 4} AS DOUBLE) AS lambda, round(-ln(var_pop({_yj(f'CAST({c} AS DOUBLE)', i / 4)})) / 2
        + ({i / 4} - 1) * avg(sign({c}) * ln(1 + abs({c}))), 6) AS mean_log_likelihood FROM train"""
    for c in NUMERIC_FEATURES for i in range(-8, 17))
ORACLES["lr_optimality"] = gchain(*SPLIT_CHAIN) + """
SELECT CAST(count(*) AS BIGINT) AS num_rows, CAST(sum(is_infraction) AS BIGINT) AS num_positive, TRUE AS optimal FROM train"""
ORACLES["model_round_trip"] = gchain(*SPLIT_CHAIN) + """
SELECT CAST(count(*) AS BIGINT) AS num_rows, CAST(count(*) AS BIGINT) AS num_equal_labels, CAST(count(*) AS BIGINT) AS num_equal_probabilities
FROM split WHERE split IS NOT NULL"""


def _hash(seed: int, columns) -> str:
    return f"md5(concat_ws('|', '{seed}', " + ", ".join(f"coalesce('=' || CAST({c} AS VARCHAR), '')" for c in columns) + "))"


_KEY = ["establishment_id", "establishmenttype", "establishment_address", "inspection_id", "inspection_date"]
_GUESS = f"CASE WHEN {_hash(42, _KEY)} >= '8' THEN 1 ELSE 0 END"
ORACLES["baseline_guess"] = gchain(*SPLIT_CHAIN) + _d(src=f"(SELECT *, {_GUESS} AS y_guess, 1 AS y_always_infrac FROM test)", doubles=ML_DOUBLES)
ORACLES["model_supports"] = gchain(*SPLIT_CHAIN) + f"""
, p AS (SELECT split, is_infraction AS y, {_GUESS} AS guess FROM split WHERE split IS NOT NULL),
s AS (SELECT split, y, 'y_pred' AS strategy, NULL AS q FROM p UNION ALL SELECT split, y, 'y_guess', guess FROM p UNION ALL SELECT split, y, 'y_always_infrac', 1 FROM p)
SELECT split, strategy, CAST(count(*) FILTER (WHERE y = 0) AS BIGINT) AS num_0, CAST(count(*) FILTER (WHERE y = 1) AS BIGINT) AS num_1,
       CAST(CASE WHEN strategy = 'y_pred' THEN -1 ELSE count(*) FILTER (WHERE y = 0 AND q = 1) END AS BIGINT) AS fp,
       CAST(CASE WHEN strategy = 'y_pred' THEN -1 ELSE count(*) FILTER (WHERE y = 1 AND q = 1) END AS BIGINT) AS tp
FROM s GROUP BY split, strategy"""
ORACLES["balanced_rows"] = gchain(*SPLIT_CHAIN) + f"""
, c AS (SELECT count(*) FILTER (WHERE is_infraction = 0) AS n0, count(*) FILTER (WHERE is_infraction = 1) AS n1 FROM train),
t AS (SELECT train.*, CAST(greatest(n0, n1) AS DOUBLE) / CASE WHEN is_infraction = 1 THEN n1 ELSE n0 END AS times,
             CAST(('0x' || substr({_hash(42, _KEY)}, 1, 13)) AS BIGINT) / {16 ** 13}.0 AS spread FROM train, c)
SELECT {", ".join(_KEY[:-1])}, CAST(inspection_date AS VARCHAR) AS inspection_date, CAST(is_infraction AS BIGINT) AS is_infraction,
       CAST(floor(times) + CASE WHEN spread < times - floor(times) THEN 1 ELSE 0 END AS BIGINT) AS copies FROM t"""
ORACLES["spot_check_sample"] = gchain(*GEO_CHAIN) + _d(
    src=f"(SELECT * FROM located ORDER BY {_hash(42, _KEY[:3])}, {EST} LIMIT 25)", dates=(), doubles=LOC_DOUBLES)
ORACLES["onehot_width"] = gchain(*SPLIT_CHAIN) + "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(count(DISTINCT {c}) AS BIGINT) AS width FROM train"
    for c in MODEL_FEATURES if c not in {*NUMERIC_FEATURES, "Shape__Area", "neigh_shape_length"})

_FLAGGED = [f"{c}_gt_zero" if c in COUNT_FEATURES else c for c in MODEL_FEATURES if c not in {*NUMERIC_FEATURES, "Shape__Area", "neigh_shape_length"}]
_WIDTHS = "\nUNION ALL ".join(f"SELECT '{c}' AS feature, CAST(count(DISTINCT {c.replace('_gt_zero', ' > 0') if c.endswith('_gt_zero') else c}) AS BIGINT) AS width FROM train"
                              for c in _FLAGGED)
ORACLES["onehot_width_flags"] = gchain(*SPLIT_CHAIN) + _WIDTHS
ORACLES["lr_flags_optimality"] = gchain(*SPLIT_CHAIN) + f""", widths AS ({_WIDTHS})
SELECT CAST((SELECT count(*) FROM train) AS BIGINT) AS num_rows, CAST(sum(width) + {len(NUMERIC_FEATURES)} AS BIGINT) AS num_features, TRUE AS optimal FROM widths"""
