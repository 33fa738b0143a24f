"""Fixed values of the domain: source tables, rule bounds, labels and declared types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- Fixed values -----------------------------------------------------------------------
# Names, bounds and texts that results are compared on; they have to stay exactly as given.

SOURCE_SYSTEMS = {
    "pcc_residents": "pointclickcare",
    "pcc_incidents": "pointclickcare",
    "pcc_care_history": "pointclickcare",
    "yardi_units": "yardi",
    "yardi_leases": "yardi",
    "adp_shifts": "adp",
    "gbp_reviews": "google_business_profile",
    "hubspot_leads": "hubspot",
}

FILE_NAME_PATTERN = r"^([a-z_]+)_(\d{4})_(\d{2})\.csv$"

CARE_LEVELS = {
    "IL": "IL",
    "INDEPENDENT": "IL",
    "INDEPENDENT LIVING": "IL",
    "AL": "AL",
    "ASSISTED": "AL",
    "ASSISTED LIVING": "AL",
    "MC": "MC",
    "MEMORY": "MC",
    "MEMORY CARE": "MC",
}

ACUITY_RANGE = (1, 10)
SEVERITY_RANGE = (1, 5)
RATING_RANGE = (1, 5)
MAX_SHIFT_HOURS = 16

DEFAULT_WINDOW = ("2025-01-01", "2025-06-30")
CALENDAR_RANGE = ("2020-01-01", "2026-12-31")
OPEN_END = "2099-01-01"
TOLERANCE_PCT = 0.5

REASON_ANCHOR = "Initial level (inferred)"
REASON_NO_HISTORY = "Initial level (no change history)"
UNKNOWN = "Unknown"
PERIOD_MONTHS = {"3m": 3, "6m": 6, "12m": 12}

# id, place (the part of the name after the operator's brand), city, state, region
COMMUNITIES = [
    ("C001", "Willamette", "Portland", "OR", "Pacific Northwest"),
    ("C002", "Cascade", "Bend", "OR", "Pacific Northwest"),
    ("C003", "Rose City", "Portland", "OR", "Pacific Northwest"),
    ("C004", "Umpqua", "Roseburg", "OR", "Pacific Northwest"),
    ("C005", "Coast", "Newport", "OR", "Pacific Northwest"),
    ("C006", "Desert Sun", "Phoenix", "AZ", "Southwest"),
    ("C007", "Saguaro", "Tucson", "AZ", "Southwest"),
    ("C008", "Red Rock", "Sedona", "AZ", "Southwest"),
    ("C009", "Camelback", "Scottsdale", "AZ", "Southwest"),
    ("C010", "Sonoran", "Mesa", "AZ", "Southwest"),
    ("C011", "Hill Country", "Austin", "TX", "South"),
    ("C012", "Lone Star", "Dallas", "TX", "South"),
    ("C013", "Gulf Breeze", "Houston", "TX", "South"),
    ("C014", "Alamo", "San Antonio", "TX", "South"),
]

# Declared types of the star schema, written as Spark DDL.
STAR_SCHEMA = {
    "dim_date": "date_key date, year int, quarter int, month int, month_start date, "
    "month_name string, day int, day_of_week string, is_weekend boolean",
    "dim_community": "community_id string, community_name string, city string, state string, region string",
    "dim_unit": "unit_id string, community_id string, unit_type string, list_rent decimal(10,2)",
    "dim_resident": "resident_id string, community_id string, first_name string, last_name string, "
    "dob date, gender string, admit_date date, discharge_date date, current_care_level string, "
    "current_acuity int",
    "dim_resident_care_level": "care_level_key bigint, resident_id string, care_level string, "
    "effective_from date, effective_to date, is_current boolean, change_reason string",
    "fact_resident_day": "date_key date, resident_id string, community_id string, "
    "care_level_key bigint, care_level string",
    "fact_monthly_revenue": "month_start date, lease_id string, resident_id string, unit_id string, "
    "community_id string, active_days int, days_in_month int, monthly_rate decimal(10,2), "
    "revenue decimal(12,2)",
    "fact_shift": "shift_id string, date_key date, community_id string, employee_id string, "
    "role string, hours_worked decimal(5,2), hourly_rate decimal(8,2), labor_cost decimal(10,2)",
    "fact_incident": "incident_id string, date_key date, resident_id string, community_id string, "
    "incident_type string, severity int, reported_by string",
    "fact_lease": "lease_id string, resident_id string, unit_id string, community_id string, "
    "move_in_date date, move_out_date date, move_out_reason string, monthly_rate decimal(10,2)",
    "fact_review": "review_id string, date_key date, community_id string, rating int, "
    "was_responded boolean, response_days int",
    "fact_lead": "lead_id string, community_id string, lead_source string, created_date date, "
    "tour_date date, deposit_date date, move_in_date date, status string, lost_reason string, "
    "toured boolean, deposited boolean, converted boolean",
}

PRIMARY_KEYS = {
    "dim_date": ["date_key"],
    "dim_community": ["community_id"],
    "dim_unit": ["unit_id"],
    "dim_resident": ["resident_id"],
    "dim_resident_care_level": ["care_level_key"],
    "fact_resident_day": ["date_key", "resident_id"],
    "fact_monthly_revenue": ["month_start", "lease_id"],
    "fact_shift": ["shift_id"],
    "fact_incident": ["incident_id"],
    "fact_lease": ["lease_id"],
    "fact_review": ["review_id"],
    "fact_lead": ["lead_id"],
}

# table -> [(column, referenced dimension, referenced key)]
FOREIGN_KEYS = {
    "dim_unit": [("community_id", "dim_community", "community_id")],
    "dim_resident": [("community_id", "dim_community", "community_id")],
    "dim_resident_care_level": [("resident_id", "dim_resident", "resident_id")],
    "fact_resident_day": [
        ("date_key", "dim_date", "date_key"),
        ("resident_id", "dim_resident", "resident_id"),
        ("community_id", "dim_community", "community_id"),
        ("care_level_key", "dim_resident_care_level", "care_level_key"),
    ],
    "fact_monthly_revenue": [
        ("resident_id", "dim_resident", "resident_id"),
        ("community_id", "dim_community", "community_id"),
    ],
    "fact_shift": [
        ("date_key", "dim_date", "date_key"),
        ("community_id", "dim_community", "community_id"),
    ],
    "fact_incident": [
        ("date_key", "dim_date", "date_key"),
        ("resident_id", "dim_resident", "resident_id"),
        ("community_id", "dim_community", "community_id"),
    ],
    "fact_lease": [
        ("resident_id", "dim_resident", "resident_id"),
        ("community_id", "dim_community", "community_id"),
    ],
    "fact_review": [
        ("date_key", "dim_date", "date_key"),
        ("community_id", "dim_community", "community_id"),
    ],
    "fact_lead": [("community_id", "dim_community", "community_id")],
}

# Columns that may not be NULL besides the primary key.
REQUIRED_COLUMNS = {
    "dim_date": ["year", "quarter", "month", "month_start", "month_name", "day", "day_of_week", "is_weekend"],
    "dim_community": ["community_name", "state", "region"],
    "dim_unit": ["community_id", "unit_type"],
    "dim_resident": ["community_id"],
    "dim_resident_care_level": ["resident_id", "care_level", "effective_from", "is_current"],
    "fact_resident_day": ["community_id"],
    "fact_monthly_revenue": ["community_id", "active_days", "days_in_month", "monthly_rate", "revenue"],
    "fact_shift": ["date_key", "community_id", "employee_id", "role", "hours_worked", "hourly_rate", "labor_cost"],
    "fact_incident": ["date_key", "community_id", "incident_type", "severity"],
    "fact_lease": ["community_id"],
    "fact_review": ["date_key", "community_id", "rating", "was_responded"],
    "fact_lead": ["community_id", "toured", "deposited", "converted"],
}
# --- End of fixed values ----------------------------------------------------------------

QUARANTINE_COLUMNS = ["source_table", "business_key", "reason", "action_taken", "raw_value", "quarantined_at"]


def community_seed(spark: SparkSession, brand: str = "", rows=None) -> DataFrame:
    """Community master rows; ``brand`` is the operator's name that precedes each place."""
    named = [
        (cid, f"{brand} {place}".strip(), city, state, region)
        for cid, place, city, state, region in (rows or COMMUNITIES)
    ]
    return spark.createDataFrame(named, STAR_SCHEMA["dim_community"])
