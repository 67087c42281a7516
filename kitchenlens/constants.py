"""Fixed values that must equal the source project's for results to match.

Everything here is data, not logic: literal lists, labels and text patterns used by the
operators as parameter defaults.
"""

from pyspark.sql import types as T

# --- fixed values: establishment types kept for analysis (retail food, grocery) ---
ESTABLISHMENT_TYPES_WANTED = [
    "Restaurant",
    "Food Take Out",
    "Food Store (Convenience / Variety)",
    "Food Court Vendor",
    "Supermarket",
    "Bakery",
    "Butcher Shop",
    "Cafeteria - Public Access",
    "Cocktail Bar / Beverage Room",
    "Fish Shop",
    "Bake Shop",
    "Flea Market",
    "Farmer's Market",
]

# --- fixed values: severities, statuses and text patterns ---
VALID_SEVERITIES = ["S - Significant", "C - Crucial", "M - Minor"]
SEVERITY_PATTERNS = {
    "num_significant": "%S - Significant",
    "num_crucial": "%C - Crucial",
    "num_minor": "%M - Minor",
    # The source's pattern has no trailing wildcard, so it never matches "NA - Not Applicable".
    "num_na": "%NA -",
}
STATUS_PASS = "Pass"
STATUS_CONDITIONAL_PASS = "Conditional Pass"
STATUS_CLOSED = "Closed"
DETAILS_SEPARATOR = ". "
GEOCODE_SUFFIX = ", Toronto, ON, Canada"

# --- fixed values: establishment key (the triple used by every grouping) ---
EST = ["establishment_id", "establishmenttype", "establishment_address"]

# --- fixed values: area-name typo fixes applied to the polygon layer ---
AREA_NAME_FIXES = [("St.James", "St. James"), ("Weston-Pellam", "Weston-Pelham")]
AREA_NAME_SPOT_CHECK = ["James Town", "Weston-", "Cabbage"]

# --- fixed values: crime filter ---
CRIME_PREMISES_KEPT = ["Outside", "Commercial", "Other"]
CRIME_OFFENCES_DROPPED = [
    "Robbery - Vehicle Jacking",
    "Theft From Motor Vehicle Over",
    "Robbery - Taxi",
    "Robbery - Home Invasion",
    "Robbery - Financial Institute",
    "B&E - M/Veh To Steal Firearm",
]
CRIME_TYPES = ["Assault", "Auto Theft", "Break and Enter", "Robbery", "Theft Over"]

# --- fixed values: weekday names, Monday = 0 ---
WEEKDAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Raw infraction schema, bound by name (column order of a snapshot is not trusted).
INFRACTION_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("establishment_id", T.LongType()),
    T.StructField("inspection_id", T.LongType()),
    T.StructField("establishment_name", T.StringType()),
    T.StructField("establishmenttype", T.StringType()),
    T.StructField("establishment_address", T.StringType()),
    T.StructField("establishment_status", T.StringType()),
    T.StructField("minimum_inspections_peryear", T.IntegerType()),
    T.StructField("infraction_details", T.StringType()),
    T.StructField("inspection_date", T.DateType()),
    T.StructField("severity", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("court_outcome", T.StringType()),
    T.StructField("amount_fined", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])
INFRACTION_COLUMNS = [f.name for f in INFRACTION_SCHEMA.fields]

ADDRESSINFO_SCHEMA = T.StructType([
    T.StructField("address", T.StringType()),
    T.StructField("neighbourhood", T.StringType()),
    T.StructField("locality", T.StringType()),
    T.StructField("formattedaddress", T.StringType()),
    T.StructField("postalcode", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])
