"""Cleaners: landed text rows to typed, deduplicated rows plus a quarantine log.

Each cleaner is a lazy plan. The accepted rows and the log derive from the same typed frame;
the log raises all its findings in one pass. The order of the steps matters: where validation
comes before deduplication, a bad last copy lets an earlier good copy survive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import model
from ..functions import canonical, half_even, parse_date, rate_for_role, raw_json, snapshot_month, to_number
from ..operators.keys import latest_per_key, latest_snapshot
from ..operators.quality import (
    LOAD_ORDER,
    Finding,
    conflicting_keys,
    contested_winners,
    evidence,
    holds,
    keep_first,
    keep_last,
    once_per_row,
    quarantine_log,
    quarantine_rows,
)

# --- Fixed values: reasons and actions as the quarantine log records them -----------------
REJECTED = "row rejected"
DUPLICATE_IDENTITY = "duplicate identity in same snapshot (name/community conflict)"
KEPT_USUAL = "row rejected; kept row matching modal community"
LEVEL_CLEARED = "care_level set NULL"
FIELD_CLEARED = "field set NULL, raise to client"
DISCHARGE_CLEARED = "discharge_date set NULL (treated as active), raise to client"
EARLY_DISCHARGE = "discharge before admit"
ODD_SEVERITY = "severity out of range"
UNIT_QUARANTINED = "row quarantined, raise to client"
LEASE_REPEATED = "lease re-exported in move-out month"
LEASE_DEDUPLICATED = "deduplicated on lease_id (kept latest export)"
EARLY_MOVE_OUT = "move_out before move_in"
NO_RATE = "hourly_rate not parseable for role"
ODD_HOURS = "hours_worked out of range"
ODD_RATING = "rating out of range"
LEAD_CONFLICT = "conflicting duplicate lead across exports"
LEAD_KEPT = "kept latest export's version, raise to client"
# --- End of fixed values ------------------------------------------------------------------


@dataclass(frozen=True)
class Cleaned:
    rows: DataFrame
    quarantine: DataFrame | None = None
    current: DataFrame | None = None


def landed(bronze: DataFrame) -> list[str]:
    """The columns as they arrived, for the log's raw value."""
    return [c for c in bronze.columns if c != "_row_seq"]


def outside(value: Column, bounds: tuple[int, int]) -> Column:
    return ~value.between(*bounds)


def whole(value: Column) -> Column:
    return F.rint(value).cast("bigint").cast("string")


def clean_residents(bronze: DataFrame) -> Cleaned:
    low, high = model.ACUITY_RANGE
    raw = bronze.withColumn("snapshot_month", snapshot_month(F.col("_source_file")))
    winners = contested_winners(raw, "resident_id", "snapshot_month", "community_id")
    horizon = F.last_day(raw.agg(F.max("snapshot_month")).scalar())
    judged = raw.join(winners, ["resident_id", "snapshot_month"], "left").withColumns(
        {"_loser": holds(F.struct(*LOAD_ORDER) != F.col("_winner")), "_horizon": horizon}
    )
    dates = {"_admit": parse_date(F.col("admit_date")), "_out": parse_date(F.col("discharge_date"))}
    typed = (
        once_per_row(judged, **dates)
        .withColumns(
            {
                "_dob": parse_date(F.col("dob")),
                "_level": canonical(F.col("care_level"), model.CARE_LEVELS),
                "_acuity": to_number(F.col("acuity_score")),
            }
        )
        .withColumns(
            {
                "_no_level": F.col("_level").isNull() & F.col("care_level").isNotNull(),
                "_odd_acuity": holds(outside(F.col("_acuity"), model.ACUITY_RANGE)),
                "_future": holds(F.col("_out") > F.col("_horizon")),
            }
        )
        .withColumn("_reversed", holds(~F.col("_future") & (F.col("_out") < F.col("_admit"))))
    )
    stays_in = ~F.col("_loser")
    raw_columns = landed(bronze)
    log = quarantine_log(
        typed,
        "pcc_residents",
        "resident_id",
        [
            Finding(
                F.col("_loser"),
                DUPLICATE_IDENTITY,
                KEPT_USUAL,
                raw_columns,
            ),
            Finding(
                stays_in & F.col("_no_level"),
                F.concat(F.lit("unmappable care level '"), "care_level", F.lit("'")),
                LEVEL_CLEARED,
                ["care_level"],
            ),
            Finding(
                stays_in & F.col("_odd_acuity"),
                F.concat(F.lit("acuity_score "), whole(F.col("_acuity")), F.lit(f" outside {low}-{high}")),
                FIELD_CLEARED,
                [F.col("_acuity").alias("acuity_score")],
            ),
            Finding(
                stays_in & F.col("_future"),
                F.concat(F.lit("future-dated discharge "), F.col("_out").cast("string")),
                DISCHARGE_CLEARED,
                [F.col("_out").alias("discharge_date")],
            ),
            Finding(stays_in & F.col("_reversed"), EARLY_DISCHARGE, REJECTED, raw_columns),
        ],
    )
    mobility = F.col("mobility_status") if "mobility_status" in bronze.columns else F.lit(None).cast("string")
    rows = typed.filter(stays_in & ~F.col("_reversed")).select(
        "resident_id",
        "snapshot_month",
        "community_id",
        "first_name",
        "last_name",
        F.col("_dob").alias("dob"),
        "gender",
        F.col("_admit").alias("admit_date"),
        F.when(~F.col("_future"), F.col("_out")).alias("discharge_date"),
        F.col("_level").alias("care_level"),
        F.when(~F.col("_odd_acuity"), F.col("_acuity")).alias("acuity_score"),
        mobility.alias("mobility_status"),
    )
    current = latest_per_key(rows.filter(F.col("resident_id").isNotNull()), "resident_id", "snapshot_month")
    return Cleaned(rows, log, current.drop("snapshot_month"))


def clean_incidents(bronze: DataFrame) -> Cleaned:
    typed = once_per_row(bronze, _severity=to_number(F.col("severity")))
    bad = F.col("_severity").isNull() | outside(F.col("_severity"), model.SEVERITY_RANGE)
    log = quarantine_log(
        typed,
        "pcc_incidents",
        "incident_id",
        [Finding(bad, ODD_SEVERITY, REJECTED, landed(bronze))],
    )
    rows = keep_last(typed.filter(~holds(bad)), ["incident_id"]).select(
        "incident_id",
        "resident_id",
        "community_id",
        parse_date(F.col("incident_date")).alias("incident_date"),
        "incident_type",
        F.col("_severity").alias("severity"),
        "reported_by",
    )
    return Cleaned(rows, log)


def clean_care_history(bronze: DataFrame) -> Cleaned:
    typed = bronze.select(
        "resident_id",
        parse_date(F.col("change_date")).alias("change_date"),
        canonical(F.col("previous_level"), model.CARE_LEVELS).alias("previous_level"),
        canonical(F.col("new_level"), model.CARE_LEVELS).alias("new_level"),
        "reason",
        *LOAD_ORDER,
    )
    return Cleaned(keep_last(typed, ["resident_id", "change_date", "new_level"]).drop(*LOAD_ORDER))


def clean_units(bronze: DataFrame, communities=None) -> Cleaned:
    """``communities`` are the known ids; by default those of the seeded master rows."""
    known = list(communities) if communities is not None else [c[0] for c in model.COMMUNITIES]
    foreign = ~holds(F.col("community_id").isin(known))
    strangers = keep_first(bronze.filter(foreign), ["unit_id", "community_id"])
    log = quarantine_log(
        strangers,
        "yardi_units",
        "unit_id",
        [
            Finding(
                F.lit(True),
                F.concat(F.lit("unknown community "), F.coalesce("community_id", F.lit("None"))),
                UNIT_QUARANTINED,
                landed(bronze),
            )
        ],
    )
    rows = bronze.filter(~foreign).select(
        "unit_id",
        "community_id",
        "unit_type",
        to_number(F.col("monthly_rent")).alias("monthly_rent"),
        parse_date(F.col("snapshot_date")).alias("snapshot_date"),
    )
    return Cleaned(rows, log, latest_snapshot(rows, "snapshot_date").drop("snapshot_date"))


def clean_leases(bronze: DataFrame) -> Cleaned:
    typed = once_per_row(
        keep_last(bronze, ["lease_id"]),
        _in=parse_date(F.col("move_in_date")),
        _out=parse_date(F.col("move_out_date")),
    )
    bad = holds(F.col("_out") < F.col("_in"))
    rejected = quarantine_log(
        typed, "yardi_leases", "lease_id", [Finding(bad, EARLY_MOVE_OUT, REJECTED, landed(bronze))]
    )
    # distinct keys, a NULL key counting as one, through partial aggregation
    surplus = (
        bronze.groupBy("lease_id")
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.sum(F.col("_n") - 1).alias("duplicates_removed"))
        .filter("duplicates_removed > 0")
    )
    summary = quarantine_rows(
        surplus.select(
            F.concat(F.col("duplicates_removed").cast("string"), F.lit(" rows")).alias("business_key"),
            F.lit(LEASE_REPEATED).alias("reason"),
            F.lit(LEASE_DEDUPLICATED).alias("action_taken"),
            raw_json("duplicates_removed").alias("raw_value"),
        ),
        "yardi_leases",
    )
    rows = typed.filter(~bad).select(
        "lease_id",
        "resident_id",
        "unit_id",
        "community_id",
        F.col("_in").alias("move_in_date"),
        F.col("_out").alias("move_out_date"),
        "move_out_reason",
        to_number(F.col("monthly_rate")).alias("monthly_rate"),
    )
    return Cleaned(rows, summary.unionByName(rejected))


def clean_shifts(bronze: DataFrame) -> Cleaned:
    rate, hours = rate_for_role(F.col("hourly_rate"), F.col("role")), to_number(F.col("hours_worked"))
    no_rate = F.col("_rate").isNull()
    bad_hours = F.col("_hours").isNull() | (F.col("_hours") <= 0) | (F.col("_hours") > model.MAX_SHIFT_HOURS)
    rate_finding = Finding(no_rate, NO_RATE, REJECTED, ["hourly_rate", "role"])
    hours_finding = Finding(~no_rate & bad_hours, ODD_HOURS, REJECTED, landed(bronze))
    typed = bronze.withColumns({"_rate": rate, "_hours": hours})
    log = quarantine_log(typed, "adp_shifts", "shift_id", [rate_finding, hours_finding])
    # rates, which cost more to read, only for rows with usable hours
    timed = once_per_row(bronze, _hours=hours).filter(~holds(bad_hours))
    rows = keep_last(once_per_row(timed, _rate=rate).filter(~no_rate), ["shift_id"]).select(
        "shift_id",
        "community_id",
        "employee_id",
        "role",
        parse_date(F.col("shift_date")).alias("shift_date"),
        F.col("_hours").alias("hours_worked"),
        F.col("_rate").alias("hourly_rate"),
        half_even(F.col("_hours") * F.col("_rate"), 2).alias("labor_cost"),
    )
    return Cleaned(rows, log)


def clean_reviews(bronze: DataFrame) -> Cleaned:
    typed = bronze.withColumn("_rating", to_number(F.col("rating")))
    bad = F.col("_rating").isNull() | outside(F.col("_rating"), model.RATING_RANGE)
    log = quarantine_log(
        typed, "gbp_reviews", "review_id", [Finding(bad, ODD_RATING, REJECTED, landed(bronze))]
    )
    rows = keep_last(typed.filter(~holds(bad)), ["review_id"]).select(
        "review_id",
        "community_id",
        parse_date(F.col("review_date")).alias("review_date"),
        F.col("_rating").alias("rating"),
        "review_text",
        "response_text",
        parse_date(F.col("responded_at")).alias("responded_at"),
    )
    return Cleaned(rows, log)


def clean_leads(bronze: DataFrame) -> Cleaned:
    payload = [c for c in bronze.columns if not c.startswith("_") and c != "lead_id"]
    disputed = conflicting_keys(bronze.filter(F.col("lead_id").isNotNull()), ["lead_id"], payload)
    proof = evidence(
        bronze.join(disputed, "lead_id", "left_semi"),
        "lead_id",
        ["community_id", "status", "_source_file"],
    )
    log = quarantine_rows(
        proof.select(
            F.col("lead_id").alias("business_key"),
            F.lit(LEAD_CONFLICT).alias("reason"),
            F.lit(LEAD_KEPT).alias("action_taken"),
            "raw_value",
        ),
        "hubspot_leads",
    )
    rows = keep_last(bronze, ["lead_id"]).select(
        "lead_id",
        "community_id",
        "lead_source",
        *[parse_date(F.col(c)).alias(c) for c in ("created_date", "tour_date", "deposit_date", "move_in_date")],
        "status",
        "lost_reason",
    )
    return Cleaned(rows, log)


# silver table -> (landed table, cleaner), in the order the log is collected
CLEANERS = {
    "residents_monthly": ("pcc_residents", clean_residents),
    "incidents": ("pcc_incidents", clean_incidents),
    "care_history": ("pcc_care_history", clean_care_history),
    "units_monthly": ("yardi_units", clean_units),
    "leases": ("yardi_leases", clean_leases),
    "shifts": ("adp_shifts", clean_shifts),
    "reviews": ("gbp_reviews", clean_reviews),
    "leads": ("hubspot_leads", clean_leads),
}

# silver tables with one row per entity, taken from a monthly table's cleaner
CURRENT_TABLES = {"residents": "residents_monthly", "units": "units_monthly"}

