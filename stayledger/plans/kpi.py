"""KPI frames. They return unordered rows; sort at the sink.

Facts carry their date, so the month comes from the date itself and no calendar join is
needed. The monthly census is an input of its own: build it once (or read the stored one)
and share it between KPIs instead of counting resident-days for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import model
from ..functions import ratio, sql_round
from ..operators import temporal

def n_rows() -> Column:
    return F.count(F.lit(1))


def census_by_month(resident_days: DataFrame) -> DataFrame:
    """Resident-days per month and community from the daily fact."""
    month = F.trunc("date_key", "MM").alias("month_start")
    return resident_days.groupBy(month, "community_id").agg(n_rows().alias("resident_days"))


def last_census_day(resident_days: DataFrame) -> Column:
    """The anchor of trailing periods: the latest day in the daily fact."""
    return resident_days.agg(F.max("date_key")).scalar()


def monthly_occupancy(census: DataFrame, units_monthly: DataFrame, communities: DataFrame) -> DataFrame:
    capacity = units_monthly.groupBy(F.trunc("snapshot_date", "MM").alias("month_start"), "community_id").agg(
        n_rows().alias("unit_count")
    )
    offered = F.col("unit_count") * F.day(F.last_day("month_start"))
    return (
        census.join(capacity, ["month_start", "community_id"])
        .join(communities, "community_id")
        .select(
            "month_start",
            "community_id",
            "community_name",
            "region",
            "resident_days",
            "unit_count",
            offered.alias("available_unit_days"),
            ratio(F.col("resident_days"), offered, 1, 100.0).alias("occupancy_pct"),
        )
    )


def length_of_stay(residents: DataFrame, ranges: DataFrame, anchor: Column, months: int = 12) -> DataFrame:
    """Stays discharged in the trailing months, by the level held the day before discharge.

    Equal lengths are counted first, so the exact median works on one row per level and length.
    """
    gone = residents.filter(F.col("discharge_date") > temporal.since_months(anchor, months))
    held = temporal.as_of(
        gone,
        ranges.withColumnRenamed("care_level", "held_level"),
        "resident_id",
        F.date_sub("discharge_date", 1),
        ["held_level"],
    )
    lengths = held.groupBy(
        F.coalesce("held_level", "current_care_level").alias("care_level"),
        F.datediff("discharge_date", "admit_date").alias("days"),
    ).agg(n_rows().alias("n"))
    known = F.when(F.col("days").isNotNull(), F.col("n"))
    return lengths.groupBy("care_level").agg(
        F.sum("n").alias("discharged_residents"),
        ratio(F.sum(F.col("days") * F.col("n")), F.sum(known), 1).alias("avg_length_of_stay_days"),
        sql_round(F.percentile("days", F.lit(0.5), F.col("n")), 1).alias("median_length_of_stay_days"),
    )


def moveout_counts(leases: DataFrame, anchor: Column, months: int) -> DataFrame:
    """Move-outs of the trailing months per community and reason, with the community's total."""
    recent = leases.filter(F.col("move_out_date") > temporal.since_months(anchor, months))
    reason = F.coalesce("move_out_reason", F.lit(model.UNKNOWN)).alias("move_out_reason")
    per_community = Window.partitionBy("community_id")
    return (
        recent.groupBy("community_id", reason)
        .agg(n_rows().alias("reason_count"))
        .withColumn("total_moveouts", F.sum("reason_count").over(per_community))
    )


def top_moveout_reasons(
    leases: DataFrame, communities: DataFrame, anchor: Column, months: int = 12, top: int = 3
) -> DataFrame:
    ranked = Window.partitionBy("community_id").orderBy(F.desc("reason_count"), "move_out_reason")
    return (
        moveout_counts(leases, anchor, months)
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= top)
        .join(communities, "community_id")
        .select(
            "community_id",
            "community_name",
            "rank",
            "move_out_reason",
            "reason_count",
            "total_moveouts",
            ratio(F.col("reason_count"), F.col("total_moveouts"), 1, 100.0).alias("pct_of_moveouts"),
        )
    )


def labor_cost_per_resident_day(shifts: DataFrame, census: DataFrame, communities: DataFrame) -> DataFrame:
    labor = shifts.groupBy(F.trunc("date_key", "MM").alias("month_start"), "community_id").agg(
        F.sum("labor_cost").alias("labor_cost"), F.sum("hours_worked").alias("labor_hours")
    )
    return (
        labor.join(census, ["month_start", "community_id"])
        .join(communities, "community_id")
        .select(
            "month_start",
            "community_id",
            "community_name",
            "region",
            "labor_cost",
            "labor_hours",
            "resident_days",
            ratio(F.col("labor_cost"), F.col("resident_days"), 2).alias("labor_cost_per_resident_day"),
        )
    )


def incident_rate_by_community(incidents: DataFrame, census: DataFrame, communities: DataFrame) -> DataFrame:
    counted = incidents.groupBy(F.trunc("date_key", "MM").alias("month_start"), "community_id").agg(
        n_rows().alias("n")
    )
    happened = F.coalesce("n", F.lit(0))
    return (
        census.join(counted, ["month_start", "community_id"], "left")
        .join(communities, "community_id")
        .select(
            "month_start",
            "community_id",
            "community_name",
            "region",
            happened.alias("incident_count"),
            "resident_days",
            ratio(happened, F.col("resident_days"), 2, 100.0).alias("incidents_per_100_resident_days"),
        )
    )


def census_by_level(resident_days: DataFrame) -> DataFrame:
    return resident_days.groupBy(F.coalesce("care_level", F.lit(model.UNKNOWN)).alias("care_level")).agg(
        n_rows().alias("resident_days")
    )


def census_by_level_from_segments(segments: DataFrame) -> DataFrame:
    """As :func:`census_by_level`, summed over constant-level segments instead of single days."""
    return segments.groupBy(F.coalesce("care_level", F.lit(model.UNKNOWN)).alias("care_level")).agg(
        F.sum(temporal.segment_days()).alias("resident_days")
    )


def incident_rate_by_care_level(incidents: DataFrame, ranges: DataFrame, level_census: DataFrame) -> DataFrame:
    """Incidents by the level held that day. They are counted per resident and day before the
    lookup, so a resident with very many incidents brings at most one row per day to the join."""
    per_day = incidents.groupBy("resident_id", "date_key").agg(n_rows().alias("n"))
    attributed = (
        temporal.as_of(per_day, ranges, "resident_id", F.col("date_key"), ["care_level"])
        .groupBy(F.coalesce("care_level", F.lit(model.UNKNOWN)).alias("care_level"))
        .agg(F.sum("n").alias("n"))
    )
    happened = F.coalesce("n", F.lit(0))
    return level_census.join(attributed, "care_level", "left").select(
        "care_level",
        happened.alias("incident_count"),
        "resident_days",
        ratio(happened, F.col("resident_days"), 2, 100.0).alias("incidents_per_100_resident_days"),
    )


def review_candidates(residents_monthly: DataFrame, residents: DataFrame, communities: DataFrame) -> DataFrame:
    rises = temporal.steepest_rise(residents_monthly, "resident_id", "snapshot_month", "acuity_score")
    return (
        rises.join(residents, "resident_id")
        .join(communities, "community_id")
        .select(
            "resident_id",
            "first_name",
            "last_name",
            "community_id",
            "community_name",
            "current_care_level",
            "from_month",
            "from_acuity",
            "to_month",
            "to_acuity",
            "acuity_increase",
        )
    )


def reviews_summary(reviews: DataFrame, communities: DataFrame) -> DataFrame:
    """Averages come from integer sums, so partial sums cannot change the last digit."""
    monthly = reviews.groupBy(F.trunc("date_key", "MM").alias("month_start"), "community_id").agg(
        n_rows().alias("review_count"),
        ratio(F.sum("rating"), F.count("rating"), 2).alias("avg_rating"),
        F.count_if("was_responded").alias("responded_count"),
        ratio(F.sum("response_days"), F.count("response_days"), 1).alias("avg_response_days"),
    )
    return monthly.join(communities, "community_id").select(
        "month_start",
        "community_id",
        "community_name",
        "region",
        "review_count",
        "avg_rating",
        "responded_count",
        "avg_response_days",
    )


# output order of each KPI, applied where rows are shown or exported
DISPLAY_ORDER = {
    "v_monthly_occupancy": ["month_start", "community_id"],
    "v_avg_los_by_care_level": ["care_level"],
    "v_top_moveout_reasons": ["community_id", "rank"],
    "v_labor_cost_per_resident_day": ["month_start", "community_id"],
    "v_incident_rate_by_community": ["month_start", "community_id"],
    "v_incident_rate_by_care_level": ["care_level"],
    "v_care_level_review_candidates": ["-acuity_increase", "resident_id"],
    "v_reviews_summary": ["month_start", "community_id"],
}


def in_display_order(df: DataFrame, view: str) -> DataFrame:
    keys = [
        F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_last()
        for k in DISPLAY_ORDER[view]
    ]
    return df.orderBy(*keys)


def kpi_frames(gold: dict[str, DataFrame], silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All KPI frames over a built star schema."""
    days, places = gold["fact_resident_day"], gold["dim_community"]
    census = gold["census_monthly"] if "census_monthly" in gold else census_by_month(days)
    anchor = last_census_day(days)
    ranges = gold["dim_resident_care_level"]
    return {
        "v_monthly_occupancy": monthly_occupancy(census, silver["units_monthly"], places),
        "v_avg_los_by_care_level": length_of_stay(gold["dim_resident"], ranges, anchor),
        "v_top_moveout_reasons": top_moveout_reasons(gold["fact_lease"], places, anchor),
        "v_labor_cost_per_resident_day": labor_cost_per_resident_day(gold["fact_shift"], census, places),
        "v_incident_rate_by_community": incident_rate_by_community(gold["fact_incident"], census, places),
        "v_incident_rate_by_care_level": incident_rate_by_care_level(
            gold["fact_incident"], ranges, census_by_level(days)
        ),
        "v_care_level_review_candidates": review_candidates(
            silver["residents_monthly"], gold["dim_resident"], places
        ),
        "v_reviews_summary": reviews_summary(gold["fact_review"], places),
    }


def register_views(frames: dict[str, DataFrame]) -> None:
    """Make the KPI frames available to SQL by name."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
