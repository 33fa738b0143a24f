"""Validation checks as one DataFrame: (section, check, status, severity, detail, recommended_action).

Every table is scanned once for all the numbers its checks need. The numbers travel as
(name, value) rows, are folded into a single row, and the check rows are derived from it, so
the whole report is one lazy plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import model
from ..operators import temporal
from ..operators.constraints import orphan_rows

# --- Fixed values: sections, actions and compared tables of the report -------------------
ROWS_SECTION = "Row reconciliation"
AGGREGATES_SECTION = "Aggregate reconciliation"
RULES_SECTION = "Business rules"
FIX, RAISE, QUARANTINE = "fix in pipeline", "raise to client", "quarantine"

# landed table -> silver table whose shrinkage is reported
BRONZE_TO_SILVER = {
    "pcc_residents": "residents_monthly",
    "pcc_incidents": "incidents",
    "yardi_units": "units_monthly",
    "yardi_leases": "leases",
    "adp_shifts": "shifts",
    "gbp_reviews": "reviews",
}
SILVER_TO_GOLD = {
    "incidents": "fact_incident",
    "leases": "fact_lease",
    "leads": "fact_lead",
    "reviews": "fact_review",
    "shifts": "fact_shift",
}
# --- End of fixed values ------------------------------------------------------------------


def figures(df: DataFrame, **values: Column) -> DataFrame:
    """Aggregates of one table as (name, value) rows, in one scan."""
    pairs = [F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value")) for n in values]
    return df.agg(*[v.alias(n) for n, v in values.items()]).select(F.inline(F.array(*pairs)))


def fold(parts: list[DataFrame]) -> DataFrame:
    """All (name, value) rows as one map in a single row."""
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    return rows.agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("f"))


def fig(name: str) -> Column:
    return F.try_element_at(F.col("f"), F.lit(name))


def count_of(name: str) -> Column:
    return F.coalesce(fig(name), F.lit(0.0)).cast("bigint")


def check_row(section: str, name: str | Column, status: Column, severity: Column, detail: Column, action: Column):
    return F.struct(
        F.lit(section).alias("section"),
        (F.lit(name) if isinstance(name, str) else name).alias("check"),
        status.alias("status"),
        severity.alias("severity"),
        detail.alias("detail"),
        action.alias("recommended_action"),
    )


def verdict(section: str, name, ok: Column, detail: Column, severity: str, action: str, bad: str = "FAIL"):
    """PASS with severity INFO and no action, or ``bad`` with the rule's own severity and action."""
    return check_row(
        section,
        name,
        F.when(ok, "PASS").otherwise(bad),
        F.when(ok, "INFO").otherwise(severity),
        detail,
        F.when(~ok, F.lit(action)),
    )


def text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# --- row counts -------------------------------------------------------------------------


def landed_rows(registry: DataFrame, bronze: dict[str, DataFrame]) -> DataFrame:
    """Rows recorded at landing against rows in the landed table, per registered table."""
    counts = reduce(
        lambda a, b: a.unionByName(b),
        [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n") for t, df in bronze.items()],
    )
    recorded = registry.groupBy("table_name").agg(F.sum("row_count").alias("expected"))
    found = F.coalesce("n", F.lit(0))
    row = verdict(
        ROWS_SECTION,
        text("source -> bronze: ", F.col("table_name")),
        found == F.col("expected"),
        text("source files ", F.col("expected"), " rows, bronze ", found, " rows"),
        "CRITICAL",
        FIX,
    )
    return recorded.join(counts, "table_name", "left").select(F.inline(F.array(row)))


def row_checks(bronze, silver, gold, quarantine: DataFrame) -> DataFrame:
    """Shrinkage from landed to cleaned rows, and cleaned against fact rows."""
    parts = [figures(bronze[b], **{f"b_{b}": F.count(F.lit(1))}) for b in BRONZE_TO_SILVER]
    parts += [
        figures(silver[s], **{f"s_{s}": F.count(F.lit(1))})
        for s in dict.fromkeys([*BRONZE_TO_SILVER.values(), *SILVER_TO_GOLD])
    ]
    parts += [figures(gold[g], **{f"g_{g}": F.count(F.lit(1))}) for g in SILVER_TO_GOLD.values()]
    parts.append(
        figures(quarantine, **{f"q_{b}": F.count_if(F.col("source_table") == b) for b in BRONZE_TO_SILVER})
    )
    rows = []
    for b, s in BRONZE_TO_SILVER.items():
        before, after = count_of(f"b_{b}"), count_of(f"s_{s}")
        detail = text(
            "bronze ", before, ", silver ", after, ", dropped ", before - after, " (", count_of(f"q_{b}"),
            " quarantine entries explain rejections/dedup)",
        )
        rows.append(verdict(ROWS_SECTION, f"bronze -> silver: {b}", before >= after, detail, "CRITICAL", FIX))
    for s, g in SILVER_TO_GOLD.items():
        cleaned, loaded = count_of(f"s_{s}"), count_of(f"g_{g}")
        near = F.abs(cleaned - loaded) <= F.greatest(F.lit(1.0), cleaned * 0.01)
        detail = text("silver ", cleaned, ", gold ", loaded)
        rows.append(verdict(ROWS_SECTION, f"silver -> gold: {s} -> {g}", near, detail, "CRITICAL", FIX))
    return fold(parts).select(F.inline(F.array(*rows)))


# --- aggregates -------------------------------------------------------------------------


def compare(name: str, base: Column, value: Column, unit: str = ""):
    """Within tolerance of the base value; a base of zero or NULL only warns."""
    empty = base.isNull() | (base == 0)
    value = F.coalesce(value, F.lit(0.0))
    off = F.try_divide(F.abs(value - base), base) * 100
    ok = off <= model.TOLERANCE_PCT
    detail = text(
        "silver ", F.format_number(base, 2), f"{unit} vs gold ", F.format_number(value, 2), f"{unit} (diff ",
        F.format_string("%.3f", off), f"%, tolerance {model.TOLERANCE_PCT}%)",
    )
    return check_row(
        AGGREGATES_SECTION,
        name,
        F.when(empty, "WARN").when(ok, "PASS").otherwise("FAIL"),
        F.when(empty, "MEDIUM").when(ok, "INFO").otherwise("CRITICAL"),
        F.when(empty, "silver value is 0/NULL").otherwise(detail),
        F.when(empty, RAISE).when(~ok, FIX),
    )


def proration_violations() -> Column:
    active, rate, revenue = F.col("active_days"), F.col("monthly_rate"), F.col("revenue")
    wrong = (
        (active < 1) | (active > F.col("days_in_month")) | (revenue < 0)
        | (revenue.cast("double") > rate.cast("double") * 1.01)
    )
    return F.count_if(wrong)


def aggregate_checks(silver, gold, window: DataFrame) -> DataFrame:
    start, end = temporal.window_bounds(window)
    silver_stays = temporal.stay_days(silver["residents"], start, end)
    parts = [
        figures(silver["shifts"], s_hours=F.sum("hours_worked"), s_cost=F.sum("labor_cost")),
        figures(gold["fact_shift"], g_hours=F.sum("hours_worked"), g_cost=F.sum("labor_cost")),
        figures(silver["residents"], s_residents=F.count_distinct("resident_id")),
        figures(gold["dim_resident"], g_residents=F.count(F.lit(1))),
        figures(silver["incidents"], s_incidents=F.count("incident_date")),
        figures(gold["fact_incident"], g_incidents=F.count(F.lit(1))),
        figures(silver_stays, s_days=F.sum("resident_days")),
        figures(gold["fact_resident_day"], g_days=F.count(F.lit(1))),
        figures(gold["fact_monthly_revenue"], g_revenue=F.sum("revenue"), bad_prorate=proration_violations()),
    ]
    bad = count_of("bad_prorate")
    rows = [
        compare("total labor hours", fig("s_hours"), fig("g_hours"), " h"),
        compare("total labor cost", fig("s_cost"), fig("g_cost"), " $"),
        compare("distinct residents", fig("s_residents"), fig("g_residents")),
        compare("total incidents", fig("s_incidents"), fig("g_incidents")),
        compare("total resident-days (independent recompute)", fig("s_days"), fig("g_days")),
        check_row(
            AGGREGATES_SECTION,
            "total prorated revenue (6 months)",
            F.lit("PASS"),
            F.lit("INFO"),
            text(
                "gold total $", F.format_number(F.coalesce(fig("g_revenue"), F.lit(0.0)), 0),
                " — proration verified row-level by active_days/days_in_month bounds check below",
            ),
            F.lit(None).cast("string"),
        ),
        verdict(
            AGGREGATES_SECTION,
            "revenue proration bounds",
            bad == 0,
            text(bad, " rows violate 1 <= active_days <= days_in_month or revenue bounds"),
            "CRITICAL",
            FIX,
        ),
    ]
    return fold(parts).select(F.inline(F.array(*rows)))


# --- business rules ---------------------------------------------------------------------

# Fixed values: (figure, check, severity, action) per rule
HARD_RULES = [
    ("lease_overlaps", "no overlapping leases per resident", "HIGH", RAISE),
    ("odd_occupancy", "no negative or >100% occupancy", "CRITICAL", FIX),
    ("early_discharge", "no discharge before admit", "CRITICAL", QUARANTINE),
    ("future_events", "no future-dated events (post window end)", "HIGH", QUARANTINE),
    ("odd_acuity", "acuity within 1-10", "HIGH", "quarantine + raise to client"),
    ("odd_severity", "incident severity within 1-5", "HIGH", QUARANTINE),
    ("odd_rating", "review rating within 1-5", "MEDIUM", QUARANTINE),
    ("odd_hours", "shift hours within 0-16", "MEDIUM", QUARANTINE),
    ("strangers", "all facts reference known communities", "CRITICAL", QUARANTINE),
    ("range_overlaps", "SCD2 ranges do not overlap per resident", "CRITICAL", FIX),
    ("many_current", "exactly one current SCD2 row per resident", "CRITICAL", FIX),
]
SOFT_RULES = [
    ("early_deposit", "HubSpot funnel chronology (deposit before tour)"),
    ("early_move_in", "HubSpot funnel chronology (move-in before deposit)"),
]
# End of fixed values


def violation_counts(gold, occupancy: DataFrame, window: DataFrame) -> DataFrame:
    """(name, value) rows with the number of violations of each business rule."""
    _, end = temporal.window_bounds(window)
    places = gold["dim_community"]

    def dated(table: str) -> DataFrame:
        return gold[table].withColumn("_end", end)

    def outside(column: str, low, high) -> Column:
        return F.count_if(~F.col(column).between(low, high))

    future = F.count_if(F.col("date_key") > F.col("_end"))
    # cleaned leases hold no reversed ones
    leases = temporal.overlap_pairs(gold["fact_lease"], "resident_id", "move_in_date", "move_out_date", may_reverse=False)
    ranges = temporal.overlap_pairs(
        gold["dim_resident_care_level"], "resident_id", "effective_from", "effective_to", closed=True
    )
    parts = [
        figures(leases, lease_overlaps=F.sum("pairs")),
        figures(occupancy, odd_occupancy=outside("occupancy_pct", 0, 100)),
        figures(
            dated("dim_resident"),
            early_discharge=F.count_if(F.col("discharge_date") < F.col("admit_date")),
            future_discharges=F.count_if(F.col("discharge_date") > F.col("_end")),
            odd_acuity=outside("current_acuity", *model.ACUITY_RANGE),
        ),
        figures(dated("fact_incident"), future_incidents=future, odd_severity=outside("severity", *model.SEVERITY_RANGE)),
        figures(
            dated("fact_shift"),
            future_shifts=future,
            odd_hours=F.count_if((F.col("hours_worked") <= 0) | (F.col("hours_worked") > model.MAX_SHIFT_HOURS)),
        ),
        figures(gold["fact_review"], odd_rating=outside("rating", *model.RATING_RANGE)),
        figures(orphan_rows(gold["fact_shift"], "community_id", places, "community_id"), stray_shifts=F.sum("n")),
        figures(orphan_rows(gold["fact_incident"], "community_id", places, "community_id"), stray_incidents=F.sum("n")),
        figures(ranges, range_overlaps=F.sum("pairs")),
        figures(temporal.multiple_current(gold["dim_resident_care_level"]), many_current=F.count(F.lit(1))),
        figures(
            gold["fact_lead"],
            early_deposit=F.count_if(F.col("deposit_date") < F.col("tour_date")),
            early_move_in=F.count_if(F.col("move_in_date") < F.col("deposit_date")),
        ),
    ]
    combined = {
        "future_discharges": "future_events",
        "future_incidents": "future_events",
        "future_shifts": "future_events",
        "stray_shifts": "strangers",
        "stray_incidents": "strangers",
    }
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    return (
        rows.replace(combined, subset=["name"])
        .groupBy("name")
        .agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("value"))
    )


def rule_rows(counts: DataFrame) -> DataFrame:
    """The check rows for the counted violations."""
    rows = []
    for name, title, severity, action in HARD_RULES:
        n = count_of(name)
        rows.append(verdict(RULES_SECTION, title, n == 0, text(n, " violating rows"), severity, action))
    for name, title in SOFT_RULES:
        n = count_of(name)
        detail = text(
            n, " leads out of order — possibly process reality (deposits without tours), possibly CRM data entry"
        )
        rows.append(verdict(RULES_SECTION, title, n == 0, detail, "MEDIUM", RAISE, bad="WARN"))
    return fold([counts]).select(F.inline(F.array(*rows)))


def business_rule_checks(gold, occupancy: DataFrame, window: DataFrame) -> DataFrame:
    return rule_rows(violation_counts(gold, occupancy, window))


# --- report -----------------------------------------------------------------------------


def all_checks(registry, bronze, silver, gold, quarantine, window, occupancy) -> DataFrame:
    sections = [
        landed_rows(registry, bronze),
        row_checks(bronze, silver, gold, quarantine),
        aggregate_checks(silver, gold, window),
        business_rule_checks(gold, occupancy, window),
    ]
    return reduce(lambda a, b: a.unionByName(b), sections)


def summary(checks: DataFrame) -> DataFrame:
    """One row: checks run, passed, and the names of warnings and failures."""

    def named(status: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("status") == status, F.col("check"))))

    return checks.agg(
        F.count(F.lit(1)).alias("checks_run"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        named("WARN").alias("warnings"),
        named("FAIL").alias("failures"),
    )
