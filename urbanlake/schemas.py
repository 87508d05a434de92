"""Declared schemas of the landing tables and report column names.

CSV files are mapped **by position** onto these schemas (the header line is
skipped, not matched), as ``COPY … CSV HEADER`` does.  Column names are
snake_case inside the library; the reference's header names are used only
when reports are written out (``REPORT_HEADERS``).
"""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

S, D, DBL, I, L = StringType(), DateType(), DoubleType(), IntegerType(), LongType()
MONEY = DecimalType(18, 2)
MONEY_SUM = DecimalType(28, 2)


def _schema(*cols: tuple[str, DataType]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


TAXI_TRIPS = _schema(
    ("trip_id", S), ("taxi_id", S), ("trip_start", D), ("trip_end", D),
    ("trip_seconds", DBL), ("trip_miles", DBL),
    ("pickup_census_tract", L), ("dropoff_census_tract", L),
    ("pickup_community_area", I), ("dropoff_community_area", I),
    ("fare", MONEY), ("tips", MONEY), ("tolls", MONEY), ("extras", MONEY), ("trip_total", MONEY),
    ("payment_type", S), ("company", S),
    ("pickup_lat", DBL), ("pickup_lon", DBL), ("pickup_location", S),
    ("dropoff_lat", DBL), ("dropoff_lon", DBL), ("dropoff_location", S),
    ("community_areas", I),
)

BOUNDARIES_ZIP = _schema(
    ("the_geom", S), ("objectid", I), ("zip", I), ("shape_area", DBL), ("shape_len", DBL),
)

COVID_BY_ZIP = _schema(
    ("zip_code", S), ("week_number", I), ("week_start", D), ("week_end", D),
    ("cases_weekly", I), ("cases_cumulative", I),
    ("case_rate_weekly", DBL), ("case_rate_cumulative", DBL),
    ("tests_weekly", I), ("tests_cumulative", I),
    ("test_rate_weekly", DBL), ("test_rate_cumulative", DBL),
    ("pct_positive_weekly", S), ("pct_positive_cumulative", S),
    ("deaths_weekly", I), ("deaths_cumulative", I),
    ("death_rate_weekly", DBL), ("death_rate_cumulative", DBL),
    ("population", I), ("row_id", S), ("zip_location", S),
)

# The ten rank columns of the vulnerability index, in file order.
CCVI_RANKS = [
    "socioeconomic_status", "household_composition_and_disability", "adults_with_no_pcp",
    "cumulative_mobility_ratio", "frontline_essential_workers", "age_65_plus",
    "comorbid_conditions", "covid_incidence_rate", "covid_hospital_admission_rate",
    "covid_crude_mortality_rate",
]

CCVI_BY_CA = _schema(
    ("geography_type", S), ("area_or_zip", S), ("community_area_name", S),
    ("ccvi_score", DBL), ("ccvi_category", S),
    *[(f"rank_{r}", DBL) for r in CCVI_RANKS],
    ("location", S),
)

# Public-health indicator columns between the name and the
# gonorrhea-in-males column, in file order (all double).
HEALTH_RATES = [
    "birth_rate", "general_fertility_rate", "low_birth_weight",
    "prenatal_care_first_trimester", "preterm_births", "teen_birth_rate",
    "assault_homicide", "breast_cancer_females", "cancer_all_sites", "colorectal_cancer",
    "diabetes_related", "firearm_related", "infant_mortality_rate", "lung_cancer",
    "prostate_cancer_males", "stroke", "childhood_blood_lead_screening",
    "childhood_lead_poisoning", "gonorrhea_females",
]

PUBLIC_HEALTH = _schema(
    ("community_area", I), ("community_area_name", S),
    *[(c, DBL) for c in HEALTH_RATES],
    ("gonorrhea_males", S),
    ("tuberculosis", DBL), ("below_poverty_level", DBL), ("crowded_housing", DBL),
    ("dependency", DBL), ("no_high_school_diploma", DBL),
    ("per_capita_income", MONEY), ("unemployment", DBL),
)

# Fee columns of the permit file, in file order (text, cast at staging).
PERMIT_FEES = [
    "building_fee_paid", "zoning_fee_paid", "other_fee_paid", "subtotal_paid",
    "building_fee_unpaid", "zoning_fee_unpaid", "other_fee_unpaid", "subtotal_unpaid",
    "building_fee_waived", "building_fee_subtotal", "zoning_fee_subtotal", "other_fee_subtotal",
    "zoning_fee_waived", "other_fee_waived", "subtotal_waived", "total_fee",
]
PERMIT_CONTACT_FIELDS = ["type", "name", "city", "state", "zipcode"]
PERMIT_CONTACTS = 15
PERMIT_PINS = 10

BUILDING_PERMIT = _schema(
    ("id", S), ("permit_no", S), ("permit_status", S), ("permit_milestone", S),
    ("permit_type", S), ("review_type", S),
    ("application_start_date", D), ("issue_date", D),
    ("processing_time", I), ("street_number", I),
    ("street_direction", S), ("street_name", S), ("work_type", S), ("work_description", S),
    *[(f, S) for f in PERMIT_FEES],
    *[(f"contact_{n}_{f}", S) for n in range(1, PERMIT_CONTACTS + 1) for f in PERMIT_CONTACT_FIELDS],
    ("reported_cost", S), ("pin_list", S),
    *[(f"pin{n}", S) for n in range(1, PERMIT_PINS + 1)],
    ("community_area", I), ("census_tract", L), ("ward", I),
    ("xcoordinate", DBL), ("ycoordinate", DBL), ("latitude", DBL), ("longitude", DBL),
    ("location", S),
)

COMM_AREA = _schema(
    ("the_geom", S), ("perimeter", DBL), ("area", DBL), ("comarea", DBL), ("comarea_id", DBL),
    ("area_numbe", I), ("community", S), ("area_num_1", I), ("shape_area", DBL), ("shape_len", DBL),
)

LANDING = {
    "taxi_trips": TAXI_TRIPS,
    "boundaries_zip": BOUNDARIES_ZIP,
    "covid_by_zip": COVID_BY_ZIP,
    "ccvi_by_ca": CCVI_BY_CA,
    "public_health": PUBLIC_HEALTH,
    "building_permit": BUILDING_PERMIT,
    "comm_area": COMM_AREA,
}

# Text formats of date columns in the source files.
DATE_FORMATS = {
    "taxi_trips": "MM/dd/yyyy hh:mm:ss a",
    "covid_by_zip": "MM/dd/yyyy",
    "building_permit": "MM/dd/yyyy",
}

# Airport names and their pickup ZIP codes.
REFERENCE_AIRPORTS = {"Midway": [60638], "O'Hare": [60656, 60666]}

# Report column headers as the reference names them.
REPORT_HEADERS = {
    "rpttbl01": {
        "week_start": "Week Start", "week_number": "Week Number", "zip": "ZIP",
        "total_trip_count": "Total Trip Count", "weekly_positive_cases": "Weekly Positive Cases",
        "severity": "Severity", "forecasted_severity": "Forecasted Severity",
    },
    "rpttbl02": {
        "week_start": "Week Start", "week_number": "Week Number", "from_airport": "From Airport",
        "to_zip_code": "To Zip Code",
        "trip_count": "Total Trip Count from Airport to Zip Code",
        "weekly_positive_cases": "Weekly Positive Cases",
    },
    "rpttbl03": {
        "week_number": "Week Number", "week_start": "Week Start", "community_area": "Community Area",
        "trips_from": "Number of Trips From Community Area",
        "trips_to": "Number of Trips To Community Area", "ccvi_category": "CCVI Category",
    },
    "rpttbl04a": {
        "week_number": "Week Number", "week_start": "Week Start", "zip": "ZIP",
        "total_trip_count": "Total Trip Count", "forecasted_trip_count": "Forecasted Trip Count",
    },
    "rpttbl04b": {
        "month_number": "Month Number", "zip": "ZIP",
        "total_trip_count": "Total Trip Count", "forecasted_trip_count": "Forecasted Trip Count",
    },
    "rpttbl04c": {
        "date": "Date", "zip": "ZIP",
        "total_trip_count": "Total Trip Count", "forecasted_trip_count": "Forecasted Trip Count",
    },
    "rpttbl05": {"community_area": "Community Area", "total_fees_waived": "Total fees to be Waived"},
    "rpttbl06": {"zip": "ZIP", "permit_id": "Permit ID - ELIGIBLE FOR LOAN"},
}

# Declared type of each report column, in report column order.
REPORT_SQL_TYPES = {
    "rpttbl01": ["date", "text", "numeric", "numeric", "numeric", "text", "text"],
    "rpttbl02": ["date", "text", "text", "numeric", "bigint", "numeric"],
    "rpttbl03": ["text", "date", "numeric", "bigint", "bigint", "text"],
    "rpttbl04a": ["text", "date", "numeric", "numeric", "integer"],
    "rpttbl04b": ["text", "numeric", "numeric", "integer"],
    "rpttbl04c": ["date", "numeric", "numeric", "integer"],
    "rpttbl05": ["numeric", "numeric"],
    "rpttbl06": ["numeric", "text"],
}

# What a declared type is here; the numeric columns hold counts and keys but
# for the fees.
_FROM_SQL = {"date": D, "text": S, "bigint": L, "integer": I, "numeric": L}
_NUMERIC = {
    "zip": I, "to_zip_code": I, "community_area": I, "total_fees_waived": MONEY_SUM,
}


def report_types(report: str) -> dict[str, str]:
    """Declared type by (snake_case) column of a report, in column order."""
    return dict(zip(REPORT_HEADERS[report], REPORT_SQL_TYPES[report]))


def report_schema(report: str) -> StructType:
    """Typed schema of a report with snake_case names (for re-loading its CSV)."""
    return _schema(*[(n, _NUMERIC.get(n, _FROM_SQL[t])) for n, t in report_types(report).items()])
