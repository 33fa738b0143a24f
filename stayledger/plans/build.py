"""A full run: land, clean, build the star schema, check and export, all under one warehouse folder."""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import model
from ..operators import constraints, temporal
from ..operators.quality import collect_quarantine
from ..sources import bronze as landing
from ..sources.tables import export_csv, read_table, write_table
from . import checks, gold, kpi, silver

METRICS_SCHEMA = "stage string, object string, row_count bigint, seconds double, status string, rows_in bigint, logged bigint"


@dataclass
class Run:
    """Where a run writes, and what it counted so far."""

    spark: SparkSession
    warehouse: str
    batch_id: str
    brand: str = ""
    rows: list[tuple] = field(default_factory=list)
    files: DataFrame | None = None

    def path(self, layer: str, name: str) -> str:
        return f"{self.warehouse}/{layer}/{name}"

    def table(self, layer: str, name: str) -> DataFrame:
        return read_table(self.spark, self.path(layer, name))

    def save(
        self, layer: str, name: str, df: DataFrame, partition_by: str | None = None, rows_in: int | None = None
    ) -> DataFrame:
        """Write a table and count its rows in the same job; ``rows_in`` is what it was made from."""
        seen = Observation()
        began = time.monotonic()
        write_table(df.observe(seen, F.count(F.lit(1)).alias("n")), self.path(layer, name), partition_by)
        self.rows.append((layer, name, seen.get["n"], time.monotonic() - began, "written", rows_in, None))
        return self.table(layer, name)

    def save_logs(self, logs: dict[str, DataFrame]) -> DataFrame:
        """Write the quarantine from the logs of several tables, and count each of them, in one job."""
        seen = {name: Observation(f"logged {name}") for name in logs}
        counted = [log.observe(seen[name], F.count(F.lit(1)).alias("n")) for name, log in logs.items()]
        stored = self.save("silver", "quarantine", collect_quarantine(counted))
        n = {name: o.get["n"] for name, o in seen.items()}
        self.rows = [(*r[:6], n[r[1]]) if r[0] == "silver" and r[1] in n else r for r in self.rows]
        return stored

    def metrics(self) -> DataFrame:
        """Rows in, rows out, logged rows and seconds per written object, and the files landed, skipped
        and ignored."""
        written = self.spark.createDataFrame(self.rows, METRICS_SCHEMA)
        if self.files is None:
            return written
        landed = self.files.select(F.lit("bronze").alias("stage"), F.col("file_name").alias("object"), "row_count", "status")
        return written.unionByName(landed, allowMissingColumns=True)


def land(run: Run, folder: str) -> dict[str, DataFrame]:
    began = time.monotonic()
    report = landing.land(run.spark, folder, run.warehouse, run.batch_id)
    run.files = report.files
    total = report.files.agg(F.coalesce(F.sum("row_count"), F.lit(0))).first()[0]
    run.rows.append(("bronze", "landing", total, time.monotonic() - began, "landed", None, None))
    return {t: landing.read_bronze(run.spark, run.warehouse, t) for t in model.SOURCE_SYSTEMS}


def clean(run: Run, bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    tables, logs = {}, {}
    current = {monthly: name for name, monthly in silver.CURRENT_TABLES.items()}
    landed = {r.table_name: r.row_count for r in landing.table_counts(run.spark, run.warehouse).collect()}
    for name, (source, cleaner) in silver.CLEANERS.items():
        cleaned = cleaner(bronze[source])
        tables[name] = run.save("silver", name, cleaned.rows, rows_in=landed[source])
        if cleaned.current is not None:
            tables[current[name]] = run.save("silver", current[name], cleaned.current)
        if cleaned.quarantine is not None:
            logs[name] = cleaned.quarantine
    tables["quarantine"] = run.save_logs(logs)
    return tables


def build_star(run: Run, tables: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """All dimensions and facts; facts read the stored dimensions instead of recomputing them."""
    window = temporal.analysis_window(tables["residents_monthly"], "snapshot_month")
    window = run.save("meta", "analysis_window", window)
    start, end = temporal.window_bounds(window)
    star = {
        "dim_date": run.save("gold", "dim_date", gold.dim_date(run.spark)),
        "dim_community": run.save("gold", "dim_community", model.community_seed(run.spark, run.brand)),
        "dim_unit": run.save("gold", "dim_unit", gold.dim_unit(tables["units"])),
        "dim_resident": run.save("gold", "dim_resident", gold.dim_resident(tables["residents"])),
    }
    ranges = gold.dim_resident_care_level(tables["care_history"], tables["residents"])
    star["dim_resident_care_level"] = run.save("gold", "dim_resident_care_level", ranges)
    segments = gold.census_segments(star["dim_resident"], star["dim_resident_care_level"], start, end)
    days = temporal.census_days(run.save("meta", "census_segments", segments))
    days = days.withColumn("month_start", F.trunc("date_key", "MM"))
    stored = run.save("gold", "fact_resident_day", days, partition_by="month_start")
    star["fact_resident_day"] = stored
    star["fact_monthly_revenue"] = run.save(
        "gold", "fact_monthly_revenue", gold.fact_monthly_revenue(tables["leases"], start, end)
    )
    for fact, source, make in (
        ("fact_shift", "shifts", gold.fact_shift),
        ("fact_incident", "incidents", gold.fact_incident),
        ("fact_lease", "leases", gold.fact_lease),
        ("fact_review", "reviews", gold.fact_review),
        ("fact_lead", "leads", gold.fact_lead),
    ):
        star[fact] = run.save("gold", fact, make(tables[source]))
    return star, window


def lost_values(run: Run, tables: dict[str, DataFrame]) -> DataFrame:
    """Values of the cleaned tables that the star schema's declared types can't hold."""
    found = [
        make(tables[source], into=gold.misfits)
        for make, source in (
            (gold.dim_unit, "units"),
            (gold.dim_resident, "residents"),
            (gold.fact_lease, "leases"),
            (gold.fact_shift, "shifts"),
            (gold.fact_incident, "incidents"),
            (gold.fact_review, "reviews"),
        )
    ]
    return reduce(lambda a, b: a.unionByName(b), found)


def store_census(run: Run, star: dict[str, DataFrame]) -> DataFrame:
    """The monthly census, stored once as the KPIs, metrics and checks all start from it."""
    return run.save("gold", "census_monthly", kpi.census_by_month(star["fact_resident_day"]))


def execute(run: Run, folder: str, export_to: str | None = None, strict: bool = True) -> DataFrame:
    """Run every stage and return the checks. ``strict`` stops on violated keys or references, and on
    values that don't fit their declared types."""
    bronze = land(run, folder)
    tables = clean(run, bronze)
    star, window = build_star(run, tables)
    if strict:
        pieces = run.table("meta", "census_segments")
        broken = constraints.star_violations(star, pieces).unionByName(lost_values(run, tables)).collect()
        if broken:
            raise ValueError("; ".join(f"{r.table_name}: {r.rule} ({r.n})" for r in broken))
    frames = kpi.kpi_frames({**star, "census_monthly": store_census(run, star)}, tables)
    kpi.register_views(frames)
    result = run.save(
        "meta",
        "checks",
        checks.all_checks(
            landing.registry(run.spark, run.warehouse),
            bronze,
            tables,
            star,
            tables["quarantine"],
            window,
            frames["v_monthly_occupancy"],
        ),
    )
    if export_to is not None:
        views = [(name, kpi.in_display_order(df, name)) for name, df in frames.items()]
        facts = [(n, df.drop("month_start") if n == "fact_resident_day" else df) for n, df in star.items()]
        export_csv([*facts, *views], export_to)
    return result


def status(result: DataFrame) -> str:
    """Overall status of a run's checks."""
    counts = {r.status: r["count"] for r in result.groupBy("status").count().collect()}
    if counts.get("FAIL"):
        return "FAILED"
    return "PASSED_WITH_WARNINGS" if counts.get("WARN") else "PASSED"
