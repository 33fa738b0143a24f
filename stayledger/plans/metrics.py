"""Parameterised metric queries under row-level scope.

Scope and date range are applied to the facts before anything is aggregated. ``Facts`` holds
the frames a metric may read; which of them are needed depends on the metric.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import model
from ..functions import ratio
from ..operators.temporal import day
from . import access, kpi


@dataclass(frozen=True)
class Facts:
    communities: DataFrame
    resident_days: DataFrame | None = None
    census: DataFrame | None = None
    units_monthly: DataFrame | None = None
    leases: DataFrame | None = None
    shifts: DataFrame | None = None
    incidents: DataFrame | None = None
    reviews: DataFrame | None = None

    def monthly_census(self) -> DataFrame:
        return self.census if self.census is not None else kpi.census_by_month(self.resident_days)


def in_months(column: str, start, end) -> Column:
    """Whole months from that of ``start`` to that of ``end``, on a day or month column."""
    return F.col(column).between(F.trunc(day(start), "MM"), F.last_day(day(end)))


def _scope(facts: Facts, claims: Mapping, community_id) -> DataFrame:
    return access.narrow_to_community(access.scope(facts.communities, claims), community_id)


def occupancy(
    facts: Facts,
    claims: Mapping,
    community_id=None,
    start=model.DEFAULT_WINDOW[0],
    end=model.DEFAULT_WINDOW[1],
) -> DataFrame:
    allowed = _scope(facts, claims, community_id)
    census = access.restrict(facts.monthly_census().filter(in_months("month_start", start, end)), allowed)
    units = access.restrict(facts.units_monthly.filter(in_months("snapshot_date", start, end)), allowed)
    return kpi.monthly_occupancy(census, units, facts.communities).drop("available_unit_days")


def moveout_reasons(
    facts: Facts, claims: Mapping, community_id=None, period: str = "12m", anchor: Column | None = None
) -> DataFrame:
    """All reasons of the trailing period; ``anchor`` defaults to the last day in census."""
    if period not in model.PERIOD_MONTHS:
        raise ValueError(f"period must be one of {', '.join(model.PERIOD_MONTHS)}")
    leases = access.restrict(facts.leases, _scope(facts, claims, community_id))
    if anchor is None:
        anchor = kpi.last_census_day(facts.resident_days)
    return kpi.moveout_counts(leases, anchor, model.PERIOD_MONTHS[period]).select(
        "community_id",
        F.col("move_out_reason").alias("reason"),
        F.col("reason_count").alias("move_outs"),
        ratio(F.col("reason_count"), F.col("total_moveouts"), 1, 100.0).alias("pct_of_moveouts"),
    )


def incidents_summary(
    facts: Facts,
    claims: Mapping,
    region=None,
    start=model.DEFAULT_WINDOW[0],
    end=model.DEFAULT_WINDOW[1],
    census: DataFrame | None = None,
) -> DataFrame:
    """Counts, severity and rate per community over exact days.

    ``census`` may give the resident-days per community of that range (from the closed form);
    otherwise they are counted in the daily fact.
    """
    allowed = access.narrow_to_region(access.scope(facts.communities, claims), facts.communities, region)
    on_days = F.col("date_key").between(day(start), day(end))
    if census is None:
        census = (
            facts.resident_days.filter(on_days)
            .groupBy("community_id")
            .agg(F.count(F.lit(1)).alias("resident_days"))
        )
    happened = (
        access.restrict(facts.incidents.filter(on_days), allowed)
        .groupBy("community_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            ratio(F.sum("severity"), F.count("severity"), 2).alias("avg_severity"),
            F.count_if(F.col("severity") >= 4).alias("severe"),
        )
    )
    n = F.coalesce("n", F.lit(0))
    return (
        access.restrict(census, allowed)
        .join(happened, "community_id", "left")
        .join(facts.communities, "community_id")
        .select(
            "community_id",
            "community_name",
            "region",
            n.alias("incidents"),
            "avg_severity",
            F.coalesce("severe", F.lit(0)).alias("severe_incidents"),
            "resident_days",
            ratio(n, F.col("resident_days"), 2, 100.0).alias("incidents_per_100_resident_days"),
        )
    )


def labor_cost(
    facts: Facts,
    claims: Mapping,
    community_id=None,
    start=model.DEFAULT_WINDOW[0],
    end=model.DEFAULT_WINDOW[1],
) -> DataFrame:
    allowed = _scope(facts, claims, community_id)
    shifts = access.restrict(facts.shifts.filter(in_months("date_key", start, end)), allowed)
    census = access.restrict(facts.monthly_census().filter(in_months("month_start", start, end)), allowed)
    return kpi.labor_cost_per_resident_day(shifts, census, facts.communities)


def reviews_summary(
    facts: Facts,
    claims: Mapping,
    community_id=None,
    start=model.DEFAULT_WINDOW[0],
    end=model.DEFAULT_WINDOW[1],
) -> DataFrame:
    allowed = _scope(facts, claims, community_id)
    reviews = access.restrict(facts.reviews.filter(in_months("date_key", start, end)), allowed)
    return kpi.reviews_summary(reviews, facts.communities)
