"""Known results of a real set of extracts; runs where STAYLEDGER_EXTRACTS names their folder."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from conftest import as_map
from pyspark.sql import functions as F

from stayledger.model import community_seed
from stayledger.operators import temporal
from stayledger.plans import gold, kpi, silver
from stayledger.sources import bronze

FOLDER = os.environ.get("STAYLEDGER_EXTRACTS")
pytestmark = pytest.mark.skipif(not FOLDER, reason="STAYLEDGER_EXTRACTS is not set")


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    report = bronze.land(spark, FOLDER, warehouse, "golden")
    return report, lambda table: bronze.read_bronze(spark, warehouse, table)


def test_landed_rows(landed):
    report, read = landed
    per_table = {}
    for name, n in report.loaded.items():
        per_table[name[:-12]] = per_table.get(name[:-12], 0) + n
    assert {t: per_table[t] for t in ("yardi_units", "yardi_leases", "gbp_reviews", "hubspot_leads")} == {
        "yardi_units": 5490, "yardi_leases": 346, "gbp_reviews": 424, "hubspot_leads": 830,
    }
    assert per_table["pcc_incidents"] == 411 and per_table["pcc_care_history"] == 303
    assert read("yardi_units").count() == 5490


def test_units(landed):
    done = silver.clean_units(landed[1]("yardi_units"))
    assert (done.rows.count(), done.current.count(), done.quarantine.count()) == (5460, 910, 5)
    assert {r.reason for r in done.quarantine.collect()} == {
        f"unknown community C{n}" for n in (905, 934, 936, 951, 969)
    }


def test_leases_and_revenue(landed):
    done = silver.clean_leases(landed[1]("yardi_leases"))
    assert done.rows.count() == 302
    assert [(r.business_key, r.reason) for r in done.quarantine.collect()] == [
        ("44 rows", "lease re-exported in move-out month")
    ]
    revenue = gold.fact_monthly_revenue(done.rows, "2025-01-01", "2025-06-30")
    monthly = revenue.groupBy("month_start").agg(F.count("*").alias("n"), F.sum("revenue").alias("total")).collect()
    assert {r.month_start.month: (r.n, float(r.total)) for r in monthly} == {
        1: (68, 263737.57), 2: (119, 501244.16), 3: (163, 770452.35),
        4: (204, 1044290.16), 5: (228, 1227726.25), 6: (248, 1282692.65),
    }
    assert revenue.filter(~F.col("active_days").between(1, F.col("days_in_month"))).count() == 0
    overlaps = temporal.overlap_pairs(done.rows, "resident_id", "move_in_date", "move_out_date")
    assert overlaps.count() == 0


def test_move_outs(landed, spark):
    leases = gold.fact_lease(silver.clean_leases(landed[1]("yardi_leases")).rows)
    anchor = F.to_date(F.lit("2025-06-30"))
    counts = kpi.moveout_counts(leases, anchor, 12)
    assert counts.agg(F.sum("reason_count")).first()[0] == 75
    top = kpi.top_moveout_reasons(leases, community_seed(spark), anchor).collect()
    assert len(top) == 37 and len({r.community_id for r in top}) == 14
    first = next(r for r in top if (r.community_id, r.rank) == ("C001", 1))
    assert (first.move_out_reason, first.reason_count, first.pct_of_moveouts) == ("Financial", 3, 100.0)


def test_reviews(landed, spark):
    done = silver.clean_reviews(landed[1]("gbp_reviews"))
    assert done.rows.count() == 424 and done.quarantine.count() == 0
    summary = kpi.reviews_summary(gold.fact_review(done.rows), community_seed(spark)).collect()
    assert len(summary) == 84
    first = next(r for r in summary if (r.community_id, r.month_start) == ("C001", dt.date(2025, 1, 1)))
    assert (first.review_count, first.avg_rating, first.responded_count, first.avg_response_days) == (3, 4.0, 2, 4.5)


def test_leads(landed):
    done = silver.clean_leads(landed[1]("hubspot_leads"))
    assert as_map(done.rows.groupBy("status").count(), "status", "count") == {"Lost": 426, "Open": 238, "Won": 165}
    records = done.quarantine.collect()
    assert {r.business_key for r in records} == {"HL385264"} and any('"status":"Won"' in r.raw_value for r in records)
    leads = gold.fact_lead(done.rows)
    early = leads.agg(
        F.count_if(F.col("deposit_date") < F.col("tour_date")), F.count_if(F.col("move_in_date") < F.col("deposit_date"))
    ).first()
    assert tuple(early) == (12, 34)


def test_incidents(landed):
    facts = gold.fact_incident(silver.clean_incidents(landed[1]("pcc_incidents")).rows)
    assert facts.count() == 411 and facts.filter("severity >= 4").count() == 57
    worst = facts.filter("community_id = 'C012'").agg(
        F.count("*").alias("n"), F.round(F.avg("severity"), 2).alias("avg"), F.count_if(F.col("severity") >= 4).alias("severe")
    ).first()
    assert tuple(worst) == (48, 2.29, 8)


def test_history(landed, spark):
    """Every history resident gets a dimension row; the others are stood in for by lease residents."""
    history = silver.clean_care_history(landed[1]("pcc_care_history")).rows
    assert history.count() == 303 and history.select("resident_id").distinct().count() == 285
    leased = silver.clean_leases(landed[1]("yardi_leases")).rows.select("resident_id").distinct()
    residents = history.select("resident_id").union(leased).distinct().select(
        "resident_id",
        F.to_date(F.lit("2020-01-01")).alias("admit_date"),
        F.lit(None).cast("date").alias("discharge_date"),
        F.lit("AL").alias("care_level"),
    )
    ranges = temporal.level_ranges(history, residents)
    reasons = as_map(ranges.groupBy("change_reason").count(), "change_reason", "count")
    assert reasons["Initial level (inferred)"] == 13
    assert reasons["Admission"] + reasons["Acuity Increase"] == 303
    assert temporal.overlap_pairs(ranges, "resident_id", "effective_from", "effective_to", closed=True).count() == 0
    assert temporal.multiple_current(ranges).count() == 0
