"""A full run over small extracts: counts at every layer, checks, reruns and corrections."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import as_map, as_set
from extracts import RESIDENTS, make, write
from pyspark.sql import functions as F

from stayledger import model
from stayledger.plans import access, build, checks, kpi, metrics, silver
from stayledger.sources import bronze


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    folder = make(tmp_path_factory.mktemp("raw"))
    run = build.Run(spark, str(tmp_path_factory.mktemp("warehouse")), "batch-1", brand="Elm")
    exported = tmp_path_factory.mktemp("export")
    result = build.execute(run, str(folder), export_to=str(exported))
    return run, exported, result


def test_landing_report(done):
    run, _, _ = done
    status = {(r.object, r.status) for r in run.metrics().filter("stage = 'bronze'").collect()}
    assert ("notes.csv", "ignored") in status
    assert ("unknown_table_2025_01.csv", "ignored") in status
    assert ("pcc_residents_2025_02.csv", "loaded") in status
    written = {r.object: (r.rows_in, r.row_count, r.logged) for r in run.metrics().filter("stage = 'silver'").collect()}
    assert written["shifts"] == (24, 9, 15) and written["leads"] == (3, 2, 2) and written["care_history"][0] == 2
    counts = as_map(bronze.table_counts(run.spark, run.warehouse), "table_name", "row_count")
    assert counts == {
        "pcc_residents": 18, "pcc_incidents": 4, "pcc_care_history": 2, "yardi_units": 15,
        "yardi_leases": 4, "adp_shifts": 24, "gbp_reviews": 9, "hubspot_leads": 3,
    }


def test_text_survives_landing(done):
    run, _, _ = done
    reviews = as_map(bronze.read_bronze(run.spark, run.warehouse, "gbp_reviews"), "review_id", "review_text")
    assert reviews["G1-1"] == 'Very\nnice, "truly"'
    assert reviews["G1-2"] == "NA"


def test_drift_column_is_null_elsewhere(done):
    run, _, _ = done
    landed = bronze.read_bronze(run.spark, run.warehouse, "pcc_residents")
    seen = as_set(landed.select("_source_file", "mobility_status").distinct())
    assert seen == {
        ("pcc_residents_2025_01.csv", None), ("pcc_residents_2025_02.csv", "Walker"), ("pcc_residents_2025_03.csv", None),
    }


def test_silver(done):
    run, _, _ = done
    monthly = run.table("silver", "residents_monthly")
    # 18 rows: one strayed identity and the reversed stay of R4 in each month leave
    assert monthly.count() == 14
    assert as_set(monthly.filter("resident_id = 'R1'").select("community_id").distinct()) == {("C001",)}
    r3 = monthly.filter("resident_id = 'R3'").select("discharge_date", "acuity_score", "care_level")
    assert as_set(r3) == {(None, None, "MC"), (None, 7.0, "MC")}
    current = as_map(run.table("silver", "residents"), "resident_id", "care_level")
    assert current == {"R1": "IL", "R2": "AL", "R3": "MC", "R5": "MC", "R6": None}
    assert run.table("silver", "incidents").count() == 3
    assert run.table("silver", "units_monthly").count() == 12
    assert run.table("silver", "units").count() == 4
    shifts = run.table("silver", "shifts")
    assert as_set(shifts.filter("shift_id like 'S1-%'").select("shift_id", "hourly_rate", "labor_cost")) == {
        ("S1-0", 16.0, 128.0), ("S1-2", 31.0, 496.0), ("S1-4", 18.25, 146.0),
    }
    leads = as_map(run.table("silver", "leads"), "lead_id", "status")
    assert leads == {"H1": "Won", "H2": "Open"}


def test_quarantine(done):
    run, _, _ = done
    log = run.table("silver", "quarantine").groupBy("source_table", "reason").count()
    found = {(r.source_table, r.reason): r["count"] for r in log.collect()}
    assert found == {
        ("pcc_residents", "duplicate identity in same snapshot (name/community conflict)"): 1,
        ("pcc_residents", "unmappable care level 'Respite'"): 1,
        ("pcc_residents", "acuity_score 99 outside 1-10"): 1,
        ("pcc_residents", "acuity_score -5 outside 1-10"): 1,
        ("pcc_residents", "future-dated discharge 2026-04-28"): 3,
        ("pcc_residents", "discharge before admit"): 3,
        ("pcc_incidents", "severity out of range"): 1,
        ("yardi_units", "unknown community C905"): 1,
        ("yardi_leases", "lease re-exported in move-out month"): 1,
        ("yardi_leases", "move_out before move_in"): 1,
        ("adp_shifts", "hourly_rate not parseable for role"): 6,
        ("adp_shifts", "hours_worked out of range"): 9,
        ("gbp_reviews", "rating out of range"): 3,
        ("hubspot_leads", "conflicting duplicate lead across exports"): 2,
    }


def test_gold(done):
    run, _, _ = done
    scd = run.table("gold", "dim_resident_care_level").orderBy("care_level_key").collect()
    day = dt.date
    assert [(r.care_level_key, r.resident_id, r.care_level, r.effective_from, r.effective_to, r.is_current) for r in scd] == [
        (1, "R1", "IL", day(2024, 6, 1), day(2025, 2, 9), False),
        (2, "R1", "AL", day(2025, 2, 10), None, True),
        (3, "R2", "AL", day(2025, 1, 10), day(2025, 2, 20), True),
        (4, "R3", "MC", day(2025, 2, 1), None, True),
        (5, "R5", "MC", day(2025, 1, 1), None, True),
    ]
    census = as_map(
        run.table("gold", "fact_resident_day").groupBy("resident_id").count(), "resident_id", "count"
    )
    assert census == {"R1": 90, "R2": 41, "R3": 59, "R5": 90}
    revenue = as_set(run.table("gold", "fact_monthly_revenue").select("lease_id", "active_days", F.col("revenue").cast("double")))
    assert revenue == {
        ("L1", 31, 3100.0), ("L1", 28, 3100.0), ("L2", 22, 1987.1), ("L2", 19, 1900.0),
    }
    places = as_map(run.table("gold", "dim_community"), "community_id", "community_name")
    assert places["C002"] == "Elm Cascade" and len(places) == 14
    assert run.table("gold", "dim_date").count() == 2557


def test_checks(done):
    run, _, result = done
    assert result.count() == 39
    found = {r.check: (r.status, r.detail) for r in result.collect()}
    assert found["source -> bronze: adp_shifts"] == ("PASS", "source files 24 rows, bronze 24 rows")
    assert found["bronze -> silver: yardi_units"] == (
        "PASS", "bronze 15, silver 12, dropped 3 (1 quarantine entries explain rejections/dedup)"
    )
    assert found["total resident-days (independent recompute)"][0] == "PASS"
    assert found["total labor cost"] == (
        "PASS", "silver 2,310.00 $ vs gold 2,310.00 $ (diff 0.000%, tolerance 0.5%)"
    )
    assert found["HubSpot funnel chronology (deposit before tour)"][0] == "WARN"
    assert found["no overlapping leases per resident"][0] == "PASS"
    assert build.status(result) == "PASSED_WITH_WARNINGS"
    summary = checks.summary(result).collect()[0]
    assert summary.checks_run == 39 and summary.passed == 37
    assert summary.failures == [] and len(summary.warnings) == 2


def test_kpi_views(done):
    run, _, _ = done
    occupancy = run.spark.table("v_monthly_occupancy").filter("community_id = 'C001'").orderBy("month_start").collect()
    assert [(r.resident_days, r.unit_count, r.available_unit_days, r.occupancy_pct) for r in occupancy] == [
        (53, 2, 62, 85.5), (47, 2, 56, 83.9), (31, 2, 62, 50.0),
    ]
    los = run.spark.table("v_avg_los_by_care_level").collect()
    assert [tuple(r) for r in los] == [("AL", 1, 41.0, 41.0)]
    rate = as_map(run.spark.table("v_incident_rate_by_care_level"), "care_level", "incident_count")
    assert rate == {"IL": 1, "AL": 1, "MC": 1}
    candidates = run.spark.table("v_care_level_review_candidates").collect()
    assert [(r.resident_id, r.from_month, r.to_month, r.acuity_increase) for r in candidates] == [
        ("R1", dt.date(2025, 1, 1), dt.date(2025, 3, 1), 3.0)
    ]


def test_export(done):
    run, exported, _ = done
    objects = {p.name for p in exported.iterdir()}
    assert objects == {*model.STAR_SCHEMA, *kpi.DISPLAY_ORDER} and len(objects) == 20
    back = run.spark.read.option("header", True).csv(str(exported / "fact_lease"))
    assert back.columns == run.table("gold", "fact_lease").columns and back.count() == 2
    (view,) = (exported / "v_top_moveout_reasons").glob("*.csv")
    assert view.read_text().splitlines() == [
        "community_id,community_name,rank,move_out_reason,reason_count,total_moveouts,pct_of_moveouts",
        "C001,Elm Willamette,1,Financial,1,1,100.0",
    ]


def test_metrics_under_scope(done):
    run, _, _ = done
    facts = metrics.Facts(
        communities=run.table("gold", "dim_community"),
        resident_days=run.table("gold", "fact_resident_day"),
        units_monthly=run.table("silver", "units_monthly"),
        leases=run.table("gold", "fact_lease"),
        shifts=run.table("gold", "fact_shift"),
        incidents=run.table("gold", "fact_incident"),
        reviews=run.table("gold", "fact_review"),
    )
    admin = {"sub": "a", "role": access.ADMIN}
    northwest = {"sub": "r", "role": access.REGIONAL, "region": "Pacific Northwest"}
    seventh = {"sub": "e", "role": access.EXECUTIVE, "community_id": "C007"}
    assert access.scope(facts.communities, admin).count() == 14
    assert as_set(access.scope(facts.communities, northwest)) == {(f"C00{i}",) for i in range(1, 6)}
    assert as_set(metrics.occupancy(facts, seventh).select("community_id").distinct()) == {("C007",)}
    assert as_set(metrics.occupancy(facts, northwest, start="2025-02-15").select("month_start").distinct()) == {
        (dt.date(2025, 2, 1),), (dt.date(2025, 3, 1),),
    }
    assert as_set(metrics.moveout_reasons(facts, admin, period="3m")) == {("C001", "Financial", 1, 100.0)}
    summary = {r.community_id: r for r in metrics.incidents_summary(facts, northwest, "Pacific Northwest").collect()}
    assert (summary["C001"].incidents, summary["C001"].severe_incidents, summary["C001"].avg_severity) == (2, 1, 3.0)
    assert (summary["C002"].incidents, summary["C002"].avg_severity) == (0, None)
    assert metrics.labor_cost(facts, admin).count() == 8
    assert metrics.reviews_summary(facts, northwest, community_id="C001").count() == 3
    for claims in ({"role": "visitor"}, {}, {"role": access.REGIONAL, "region": "Atlantis"}, {"role": access.EXECUTIVE}):
        with pytest.raises(PermissionError):
            access.scope(facts.communities, claims)
    with pytest.raises(PermissionError):
        metrics.occupancy(facts, seventh, community_id="C001")
    with pytest.raises(PermissionError):
        metrics.incidents_summary(facts, seventh, region="South")
    with pytest.raises(ValueError):
        metrics.moveout_reasons(facts, admin, period="5m")


def test_rerun_and_corrections(spark, tmp_path):
    folder = make(tmp_path / "raw")
    warehouse = str(tmp_path / "warehouse")
    first = bronze.land(spark, str(folder), warehouse, "b1")
    assert len(first.loaded) == 18 and first.skipped == []
    again = bronze.land(spark, str(folder), warehouse, "b2")
    assert again.loaded == {} and len(again.skipped) == 18
    # a corrected file replaces its rows, another one turns out to be empty, a new one arrives
    write(folder, "pcc_care_history_2025_02.csv", ["resident_id", "change_date", "new_level"], [["R1", "2025-02-11", "AL"]])
    write(folder, "yardi_leases_2025_02.csv", ["lease_id"], [])
    write(folder, "pcc_care_history_2025_03.csv", ["reason", "resident_id"], [["Moved", "R2"], ["", "R3"]])
    third = bronze.land(spark, str(folder), warehouse, "b3")
    assert third.loaded == {
        "pcc_care_history_2025_02.csv": 1, "yardi_leases_2025_02.csv": 0, "pcc_care_history_2025_03.csv": 2,
    }
    history = bronze.read_bronze(spark, warehouse, "pcc_care_history")
    assert as_set(history.select("resident_id", "change_date", "new_level", "reason", "_batch_id")) == {
        ("R1", "2025-02-11", "AL", None, "b3"), ("R2", None, None, "Moved", "b3"), ("R3", None, None, None, "b3"),
    }
    assert bronze.read_bronze(spark, warehouse, "yardi_leases").count() == 3
    # files that leave the folder stay landed
    (folder / "pcc_incidents_2025_02.csv").unlink()
    bronze.land(spark, str(folder), warehouse, "b4")
    assert bronze.read_bronze(spark, warehouse, "pcc_incidents").count() == 4


def test_all_unusable_rates_are_logged(rows):
    header = "shift_id string, community_id string, employee_id string, role string, shift_date string, " \
             "hours_worked string, hourly_rate string, _source_file string, _row_seq long"
    bad = [(f"S{i}", "C001", "E", "Cook", "2025-01-01", "8", "?", "adp_shifts_2025_01.csv", i) for i in range(70)]
    cleaned = silver.clean_shifts(rows(bad, header))
    assert cleaned.quarantine.count() == 70 and cleaned.rows.count() == 0


def test_strict_run_stops_on_broken_references(spark, tmp_path):
    folder = make(tmp_path / "raw")
    write(folder, "pcc_residents_2025_04.csv", RESIDENTS, [["R9", "C777", "a", "b", "", "F", "2025-01-01", "", "IL", "1"]])
    with pytest.raises(ValueError, match="community_id references dim_community"):
        build.execute(build.Run(spark, str(tmp_path / "w"), "b"), str(folder))
