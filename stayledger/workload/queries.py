"""One query per operator over the sample tables. Column names match the SQL in ``oracles``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import model
from ..functions import (
    canonical,
    half_even,
    month_start,
    parse_date,
    rate_for_role,
    raw_json,
    snapshot_month,
    sql_round,
    to_decimal,
    to_int,
    to_number,
)
from ..operators import constraints, keys, quality, temporal
from ..plans import access, build, checks, gold, kpi, metrics, silver
from ..session import shared_dir
from ..sources import bronze, files, tables
from ..streaming.landing import land_stream
from . import shapes as sh

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

ADMIN = {"sub": "admin", "role": access.ADMIN}
EXECUTIVE = {"sub": "executive", "role": access.EXECUTIVE, "community_id": 7}


def query(build: Callable[[sh.Sample], DataFrame]):
    QUERIES[build.__name__] = lambda spark, folder: build(sh.Sample(spark, folder))
    return build


def shared_query(build: Callable[[sh.Sample], DataFrame]):
    """A query whose parts start from the same shapes: each is derived once and staged."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        s = sh.Sample(spark, folder)
        s.sharing = True
        return build(s)

    QUERIES[build.__name__] = run
    return build


def window(s: sh.Sample):
    bounds = s.keep("window", lambda: temporal.analysis_window(sh.shipping_months(s), "snapshot_date"))
    return temporal.window_bounds(bounds)


def census(s: sh.Sample) -> DataFrame:
    return temporal.monthly_census(sh.stays(s), *window(s))


def anchor(s: sh.Sample):
    """The last day in census, in closed form."""
    return temporal.clip_stays(sh.stays(s), *window(s)).agg(F.max("last_day")).scalar()


def ranges(s: sh.Sample) -> DataFrame:
    """Validity ranges for reports that do not need the surrogate key."""
    built = s.keep("ranges", lambda: temporal.level_ranges(sh.care_history(s), sh.stays(s)))
    return built.withColumn("care_level_key", F.lit(None).cast("bigint"))


def scratch(s: sh.Sample, name: str) -> str:
    return f"{shared_dir(s.spark)}/stayledger/{name}-{uuid.uuid4().hex}"


# --- scalar expressions -------------------------------------------------------------------


@query
def date_parse_multi(s):
    text = sh.date_text(sh.order_day(), F.col("o_orderkey"))
    return s.orders.select("o_orderkey", parse_date(text).alias("parsed"))


@query
def value_map_normalize(s):
    spelled = s.orders.select("o_orderkey", sh.spelling(F.col("o_orderkey")).alias("raw_level"))
    return spelled.select("o_orderkey", canonical(F.col("raw_level"), model.CARE_LEVELS).alias("care_level"))


@query
def numeric_coerce(s):
    """Prices as text, some with blanks, words or NaN around them."""
    price = F.floor("l_extendedprice").cast("string")
    text = (
        F.when(F.col("l_linenumber") == 1, F.concat(F.lit(" "), price, F.lit(" ")))
        .when(F.col("l_linenumber") == 2, F.concat(price, F.lit(" USD")))
        .when(F.col("l_linenumber") == 3, F.lit("NaN"))
        .when(F.col("l_linenumber") == 4, F.lit(""))
        .otherwise(price)
    )
    return s.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", to_number(text).alias("price"))


@query
def rate_from_dict_text(s):
    """Rates by role from plain numbers, plain maps, and maps in any other notation."""
    form = F.pmod(F.col("employee_id").cast("bigint"), F.lit(len(sh.RATE_FORMS))).cast("int")
    other = F.get(F.array(*[F.lit(t) for t in sh.RATE_FORMS]), form)
    text = F.when(F.startswith("hourly_rate", F.lit("{")) & (form > 0), other).otherwise(F.col("hourly_rate"))
    return sh.raw_shifts(s).select("shift_id", "employee_id", rate_for_role(text, F.col("role")).alias("rate"))


@query
def rounding_rules(s):
    share = F.col("l_extendedprice") * (1 - F.col("l_discount")) / 7
    return s.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        sql_round(share, 2).alias("rounded"),
        half_even(share, 2).alias("to_even"),
        to_int(share).cast("bigint").alias("as_int"),
        to_decimal(share, 12, 2).cast("double").alias("as_decimal"),
    )


@query
def raw_row_json(s):
    """Landed values as JSON text, whole, with NULL fields kept."""
    lang = F.when(F.col("lang") != "en", F.col("lang")).alias("lang")
    return s.documents.select("doc_id", raw_json("doc_id", lang, "source", "text").alias("raw_value"))


@query
def snapshot_from_file_name(s):
    """File names built from order months, split back into table, month and status."""
    named = s.orders.select(
        "o_orderkey",
        F.concat(
            F.when(F.col("o_orderstatus") == "P", "vendor_dump").otherwise("pcc_residents"),
            F.date_format(sh.order_day(), "_yyyy_MM"),
            F.when(F.col("o_orderpriority") == "1-URGENT", ".txt").otherwise(".csv"),
        ).alias("file_name"),
    )
    return files.name_parts(named).select(
        "o_orderkey", "table_name", "year", "month", "status", snapshot_month(F.col("file_name")).alias("snapshot_month")
    )


@query
def calendar_dim(s):
    """Calendar over the order dates' span, with the number of orders per day."""
    span = s.orders.agg(F.min(sh.order_day()).alias("a"), F.max(sh.order_day()).alias("b"))
    days = temporal.calendar(span, F.col("a"), F.col("b"))
    placed = s.orders.groupBy(sh.order_day().alias("date_key")).agg(F.count(F.lit(1)).alias("orders_placed"))
    ints = {c: F.col(c).cast("bigint") for c in ("year", "quarter", "month", "day")}
    return days.withColumns(ints).join(placed, "date_key", "left").withColumn(
        "orders_placed", F.coalesce("orders_placed", F.lit(0))
    )


# --- rows: rejects, repairs, duplicates ---------------------------------------------------


def shift_rules():
    hours = to_number(F.col("hours_worked"))
    rate = rate_for_role(F.col("hourly_rate"), F.col("role"))
    return [
        (rate.isNull(), silver.NO_RATE),
        (hours.isNull() | (hours <= 0) | (hours > model.MAX_SHIFT_HOURS), silver.ODD_HOURS),
    ]


@query
def reject_split_good(s):
    good, _ = quality.split_rejects(sh.raw_shifts(s), shift_rules())
    return good.select("shift_id", "employee_id", "role")


@query
def reject_split_bad(s):
    _, bad = quality.split_rejects(sh.raw_shifts(s), shift_rules())
    return bad.select("shift_id", "employee_id", F.col("_reason").alias("reason"))


@query
def field_repair(s):
    scored = sh.raw_residents(s).select(
        F.col("_row_seq").alias("order_id"), to_number(F.col("acuity_score")).alias("acuity_score")
    )
    bad = ~F.col("acuity_score").between(*model.ACUITY_RANGE)
    return quality.repair_field(scored, "acuity_score", bad).withColumnRenamed("_repaired", "repaired")


@query
def dedup_keep_last(s):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]
    return quality.keep_last(s.lineitem, ["l_orderkey", "l_linenumber"], order).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", sh.ship_day().alias("ship_day")
    )


@query
def dedup_keep_first(s):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]
    return quality.keep_first(s.lineitem, ["l_orderkey", "l_linenumber"], order).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", sh.ship_day().alias("ship_day")
    )


@query
def duplicate_members(s):
    rows = s.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return quality.duplicate_members(rows, ["l_orderkey", "l_linenumber"])


@query
def version_counts(s):
    flagged = s.lineitem.select("l_orderkey", "l_returnflag", F.nullif("l_linestatus", F.lit("O")).alias("status"))
    return quality.version_counts(flagged, ["l_orderkey"], ["l_returnflag", "status"])


@query
def conflicting_duplicates(s):
    rows = s.lineitem.select("l_orderkey", "l_returnflag", "l_linestatus", "l_partkey", "l_suppkey", "l_linenumber")
    disputed = quality.conflicting_keys(rows, ["l_orderkey"], ["l_returnflag", "l_linestatus"])
    return quality.evidence(
        rows.join(disputed, "l_orderkey", "left_semi"),
        "l_orderkey",
        ["l_returnflag", "l_linestatus", "l_partkey"],
    )


@query
def most_frequent_value(s):
    return quality.most_frequent(s.orders, "o_custkey", "o_orderpriority", "usual_priority")


@query
def modal_resolution(s):
    raw = sh.raw_residents(s).withColumn("snapshot_month", snapshot_month(F.col("_source_file")))
    return quality.contested_winners(raw, "resident_id", "snapshot_month", "community_id").select(
        "resident_id", "snapshot_month", F.col("_winner._row_seq").alias("kept_order")
    )


@query
def latest_per_key(s):
    monthly = s.orders.groupBy("o_custkey", F.trunc(sh.order_day(), "MM").alias("month")).agg(
        F.max("o_orderkey").alias("last_order")
    )
    return keys.latest_per_key(monthly, "o_custkey", "month")


@query
def latest_snapshot_global(s):
    return keys.latest_snapshot(sh.units_monthly(s), "snapshot_date")


# --- keys and joins -----------------------------------------------------------------------


@query
def dense_surrogate_key(s):
    rows = s.events.select("user_id", F.to_date("ts").alias("day"), "event_id")
    return keys.dense_key(rows, ["user_id", "day", "event_id"], "event_key")


@query
def not_in_null_aware(s):
    """NOT IN against a clean list, a list with a NULL, and an empty list."""
    docs = s.documents.select("doc_id")
    lists = {
        "clean": s.labels.select("doc_id"),
        "with_null": s.labels.select(F.when(F.col("toxic") == 0, F.col("doc_id")).alias("doc_id")),
        "empty": s.labels.filter(F.col("quality") > 1).select("doc_id"),
    }
    parts = [
        keys.not_in(docs, "doc_id", listed, "doc_id").select(F.lit(name).alias("list"), "doc_id")
        for name, listed in lists.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query
def orphan_rows(s):
    """Customers as a dimension of events' users; one market segment is known under other keys."""
    other = F.when(F.col("c_mktsegment") == "BUILDING", -F.col("c_custkey") - 1)
    dim = s.customer.select(F.coalesce(other, F.col("c_custkey")).alias("c_custkey"))
    return constraints.orphan_rows(s.events, "user_id", dim, "c_custkey")


@query
def missing_references(s):
    users = s.events.select(F.when(F.col("event_type") != "view", F.col("user_id")).alias("user_id"))
    other = F.when(F.col("c_acctbal") <= 0, -F.col("c_custkey") - 1)
    dim = s.customer.select(F.coalesce(other, F.col("c_custkey")).alias("c_custkey"))
    return constraints.missing_references(users, "user_id", dim, "c_custkey")


@query
def pk_violations(s):
    return constraints.duplicate_keys(s.lineitem, ["l_orderkey", "l_linenumber"])


@query
def null_violations(s):
    return constraints.null_counts(sh.stays(s), ["resident_id", "community_id", "admit_date", "discharge_date"])


@query
def decimal_misfits(s):
    return constraints.decimal_misfits(s.orders, "o_totalprice", 7, 2).select("o_orderkey", "o_totalprice")


@query
def drift_union(s):
    """Extracts of the same table with different columns, by market segment."""
    old = s.customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")
    new = s.customer.filter(F.col("c_mktsegment") != "BUILDING").select("c_name", "c_custkey", "c_mktsegment")
    return files.drift_union([old, new])


@query
def incremental_skip(s):
    """Documents as files; the labelled ones were landed before, those of low quality changed since."""
    found = s.documents.select(F.col("doc_id").alias("file_name"), F.md5("text").alias("file_hash"), "text")
    seen = found.join(s.labels.withColumnRenamed("doc_id", "file_name"), "file_name").select(
        "file_name",
        F.when(F.col("quality") == 0, F.md5(F.concat("text", F.lit("*")))).otherwise(F.col("file_hash")).alias("file_hash"),
    )
    found = found.drop("text")
    parts = [
        files.pending(found, seen).withColumn("status", F.lit("load")),
        files.already_landed(found, seen).withColumn("status", F.lit("skip")),
    ]
    return parts[0].unionByName(parts[1])


# --- stays, ranges, leases ----------------------------------------------------------------


@query
def analysis_window(s):
    return temporal.analysis_window(sh.shipping_months(s), "snapshot_date")


@query
def scd2_build(s):
    return temporal.scd2(sh.care_history(s), sh.stays(s))


@shared_query
def scd2_point_in_time(s):
    """The care level held on the day of each incident."""
    facts = sh.incident_facts(s)
    return temporal.as_of_sorted(facts, ranges(s), "resident_id", F.col("date_key"), ["care_level"]).select(
        "resident_id", "date_key", F.col("severity").cast("bigint").alias("severity"), "care_level"
    )


@shared_query
def census_days(s):
    """The daily fact over the whole window, summed per day and community."""
    dim = temporal.scd2(sh.care_history(s), sh.stays(s))
    days = temporal.census_days(temporal.census_segments(sh.stays(s), dim, *window(s)))
    return days.groupBy("date_key", "community_id").agg(
        F.count(F.lit(1)).alias("resident_days"),
        F.count("care_level_key").alias("with_level"),
        F.sum("care_level_key").cast("bigint").alias("key_sum"),
    )


@shared_query
def resident_day_digest(s):
    """The daily fact by resident: its days, and a sum that every row's day and key weigh in."""
    dim = temporal.scd2(sh.care_history(s), sh.stays(s))
    days = temporal.census_days(temporal.census_segments(sh.stays(s), dim, *window(s)))
    return digest(days)


def digest(days: DataFrame) -> DataFrame:
    number = F.datediff("date_key", F.to_date(F.lit("1970-01-01"))).cast("bigint")
    by_key = days.groupBy("resident_id", "community_id", "care_level_key").agg(
        F.count(F.lit(1)).alias("days"),
        F.min("date_key").alias("first_day"),
        F.max("date_key").alias("last_day"),
        F.sum(number * number).alias("squares"),
    )
    # keys are as large as the table, so a resident's sum outgrows 64 bits: days are summed per key, and
    # the few products as decimals
    weight = (F.coalesce("care_level_key", F.lit(0)) + 1).cast("decimal(19,0)")
    return by_key.groupBy("resident_id", "community_id").agg(
        F.sum("days").alias("days"),
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
        F.sum(F.col("squares").cast("decimal(19,0)") * weight).cast("double").alias("weighed"),
    )


@query
def lease_month_rows(s):
    """Every row of the revenue fact, those of a lease in one text. Leases are dealt by the fact's key while
    they are one row each, so that their months are gathered without a shuffle."""
    dealt = sh.leases(s).withColumn("lease_id", F.col("lease_id").cast("string")).repartition(F.col("lease_id"))
    rows = gold.fact_monthly_revenue(dealt, *window(s))
    cents = (F.col("revenue") * 100).cast("bigint")
    shown = F.concat_ws(":", F.date_format("month_start", "yyyy-MM"), F.col("active_days").cast("string"), cents.cast("string"))
    return rows.groupBy("lease_id", "community_id").agg(F.array_join(F.array_sort(F.collect_list(shown)), " ").alias("months"))


@query
def census_closed_form(s):
    return temporal.stay_days(sh.stays(s), *window(s))


@query
def census_monthly(s):
    return census(s)


@query
def prorated_revenue(s):
    """Lease months of the whole window, summed per month and community."""
    rows = gold.fact_monthly_revenue(sh.leases(s), *window(s))
    return rows.groupBy("month_start", "community_id").agg(
        F.count(F.lit(1)).alias("lease_months"),
        F.sum("active_days").alias("active_days"),
        F.sum("revenue").cast("double").alias("revenue"),
    )


@query
def lease_overlap_pairs(s):
    return temporal.overlap_pairs(sh.leases(s), "resident_id", "move_in_date", "move_out_date", may_reverse=False)


@query
def lease_overlap_witnesses(s):
    """Each lease that overlaps an earlier one, with the earlier one that ends last."""
    found = temporal.overlap_witnesses(sh.leases(s), "resident_id", "lease_id", "move_in_date", "move_out_date")
    return found.withColumnRenamed("witness", "earlier_lease_id")


@query
def repeated_resident_days(s):
    """Days that two or more leases of a customer share, end days included."""
    pieces = sh.leases(s).select(
        "resident_id", F.col("move_in_date").alias("seg_start"), F.coalesce("move_out_date", F.to_date(F.lit(model.OPEN_END))).alias("seg_end")
    )
    return temporal.repeated_days(pieces.filter("seg_start <= seg_end"))


@query
def events_in_force(s):
    """Each event with the type of its user's last one of an earlier day: users have many of both, and the
    ranges are the spans between a user's days of events."""
    days = s.events.select("user_id", F.to_date("ts").alias("day"), "event_type")
    first = days.groupBy("user_id", "day").agg(F.max("event_type").alias("held"))
    later = F.lead("day").over(Window.partitionBy("user_id").orderBy("day"))
    spans = first.select("user_id", F.date_add("day", 1).alias("effective_from"), later.alias("effective_to"), "held")
    facts = s.events.select("event_id", "user_id", "ts")
    return temporal.as_of_sorted(facts, spans, "user_id", F.to_date("ts"), ["held"]).select("event_id", "user_id", "held")


@query
def closed_overlap_pairs(s):
    """Stays of a customer that share at least one day, end days included."""
    return temporal.overlap_pairs(sh.leases(s), "resident_id", "move_in_date", "move_out_date", closed=True)


@shared_query
def scd2_overlap_pairs(s):
    """Overlaps between validity ranges, as totals next to the number of ranges."""
    built = ranges(s)
    found = temporal.overlap_pairs(built, "resident_id", "effective_from", "effective_to", closed=True)
    total = found.agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("overlaps"))
    return built.agg(F.count(F.lit(1)).alias("ranges")).withColumn("overlaps", total.scalar())


@query
def multi_current(s):
    """Ranges counted as current twice when every open lease of a customer is one."""
    current = sh.leases(s).select("resident_id", F.col("move_out_date").isNull().alias("is_current"))
    return temporal.multiple_current(current)


@query
def trailing_window_filter(s):
    recent = F.col("move_out_date") > temporal.since_months(anchor(s), 6)
    return sh.leases(s).filter(recent).select("lease_id", "move_out_date")


@query
def month_bucket_filter(s):
    days = metrics.in_months("day", "1998-02-10", "1998-07-04")
    return s.orders.withColumn("day", sh.order_day()).filter(days).select("o_orderkey", month_start(F.col("day")).alias("month"))


@query
def response_lag(s):
    return gold.answered(sh.reviews(s)).select(
        "review_id", "date_key", "was_responded", F.col("response_days").cast("bigint").alias("response_days")
    )


@query
def accumulating_snapshot_flags(s):
    return gold.staged(sh.leads(s)).select("lead_id", "community_id", "status", "toured", "deposited", "converted")


@query
def funnel_chronology(s):
    return sh.leads(s).agg(
        F.count_if(F.col("deposit_date") < F.col("tour_date")).alias("early_deposit"),
        F.count_if(F.col("move_in_date") < F.col("deposit_date")).alias("early_move_in"),
    )


# --- KPIs ---------------------------------------------------------------------------------


@query
def occupancy_monthly(s):
    return kpi.monthly_occupancy(census(s), sh.units_monthly(s), sh.communities(s))


@shared_query
def los_by_level(s):
    residents = sh.stays(s).withColumnRenamed("care_level", "current_care_level")
    return kpi.length_of_stay(residents, ranges(s), anchor(s))


@query
def top_reasons(s):
    return kpi.top_moveout_reasons(sh.leases(s), sh.communities(s), anchor(s)).withColumn(
        "rank", F.col("rank").cast("bigint")
    )


@shared_query
def labor_cost_per_day(s):
    result = kpi.labor_cost_per_resident_day(sh.shift_facts(s), census(s), sh.communities(s))
    return as_double(result, "labor_cost", "labor_hours")


def as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


@shared_query
def incident_rate_community(s):
    return kpi.incident_rate_by_community(sh.incident_facts(s), census(s), sh.communities(s))


@shared_query
def incident_rate_level(s):
    segments = temporal.census_segments(sh.stays(s), ranges(s), *window(s))
    return kpi.incident_rate_by_care_level(
        sh.incident_facts(s), ranges(s), kpi.census_by_level_from_segments(segments)
    )


@query
def review_candidates(s):
    return temporal.steepest_rise(sh.scores(s), "user_id", "week", "acuity")


@query
def care_level_candidates(s):
    """Residents whose score rose, with their names, communities and levels."""
    monthly = sh.scores(s).select(F.col("user_id").alias("resident_id"), F.col("week").alias("snapshot_month"), F.col("acuity").alias("acuity_score"))
    names = F.split("c_name", "#")
    residents = s.customer.select(
        F.col("c_custkey").alias("resident_id"), names[0].alias("first_name"), names[1].alias("last_name"),
        F.col("c_nationkey").cast("bigint").alias("community_id"), F.col("c_mktsegment").alias("current_care_level"),
    )
    return kpi.review_candidates(monthly, residents, sh.communities(s))


@query
def reviews_summary(s):
    return kpi.reviews_summary(sh.review_facts(s), sh.communities(s))


# --- scoped metrics -----------------------------------------------------------------------


@query
def scope_by_role(s):
    places = sh.communities(s)
    parts = [access.whoami(places, claims) for claims in (ADMIN, regional(s), EXECUTIVE)]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query
def scope_region_intersection(s):
    places = sh.communities(s)
    granted = access.scope(places, regional(s))
    return access.narrow_to_region(granted, places, regional(s)["region"])


def regional(s) -> dict:
    """A regional director of the alphabetically second region."""
    names = [r.r_name for r in s.region.select("r_name").orderBy("r_name").limit(2).collect()]
    return {"sub": "regional", "role": access.REGIONAL, "region": names[1]}


def facts(s) -> metrics.Facts:
    return metrics.Facts(
        communities=sh.communities(s),
        census=census(s),
        units_monthly=sh.units_monthly(s),
        leases=sh.leases(s),
        shifts=sh.shift_facts(s),
        incidents=sh.incident_facts(s),
        reviews=sh.review_facts(s),
    )


@query
def metric_occupancy_scoped(s):
    return metrics.occupancy(facts(s), regional(s), start="1998-02-10", end="1999-05-20")


def moveouts(s, period: str) -> DataFrame:
    return metrics.moveout_reasons(facts(s), ADMIN, period=period, anchor=anchor(s))


@query
def metric_moveout_3m(s):
    return moveouts(s, "3m")


@query
def metric_moveout_6m(s):
    return moveouts(s, "6m")


@query
def metric_moveout_12m(s):
    return moveouts(s, "12m")


@query
def metric_incidents_region(s):
    start, end = "1998-02-10", "1999-05-20"
    clipped = temporal.clip_stays(sh.stays(s), start, end)
    days = clipped.groupBy("community_id").agg(
        F.sum(F.datediff("last_day", "first_day") + 1).alias("resident_days")
    )
    return metrics.incidents_summary(facts(s), ADMIN, regional(s)["region"], start, end, census=days)


@shared_query
def metric_incidents_daily(s):
    """The same summary as called by default: resident-days are counted in the daily fact."""
    pieces = temporal.census_segments(sh.stays(s), ranges(s), *window(s))
    told = replace(facts(s), resident_days=temporal.census_days(pieces))
    return metrics.incidents_summary(told, ADMIN, regional(s)["region"], "1998-02-10", "1999-05-20")


@query
def metric_labor_scoped(s):
    result = metrics.labor_cost(facts(s), regional(s), start="1998-02-10", end="1999-05-20")
    return as_double(result, "labor_cost", "labor_hours")


@query
def metric_reviews_scoped(s):
    return metrics.reviews_summary(facts(s), EXECUTIVE, community_id=7, start="1998-02-10", end="1999-05-20")


# --- cleaners -----------------------------------------------------------------------------


def cleaned(s, table: str) -> silver.Cleaned:
    """A table's cleaned parts as plans; a query that reads a part more than once keeps it."""
    if table == "yardi_units":
        return silver.clean_units(sh.raw_units(s), sh.KNOWN_NATIONS)
    return next(fn for source, fn in silver.CLEANERS.values() if source == table)(sh.RAW[table](s))


def log_of(s, table: str, *more: str) -> DataFrame:
    return cleaned(s, table).quarantine.select("business_key", "reason", "action_taken", *more)


@query
def clean_residents(s):
    return cleaned(s, "pcc_residents").rows


@query
def clean_residents_current(s):
    return cleaned(s, "pcc_residents").current


@shared_query
def clean_residents_log(s):
    return log_of(s, "pcc_residents")


@query
def clean_incidents(s):
    return cleaned(s, "pcc_incidents").rows


@query
def clean_incidents_log(s):
    return log_of(s, "pcc_incidents", "raw_value")


@query
def clean_care_history(s):
    return cleaned(s, "pcc_care_history").rows


@query
def clean_units(s):
    return cleaned(s, "yardi_units").rows


@query
def clean_units_current(s):
    return cleaned(s, "yardi_units").current


@query
def clean_units_log(s):
    return log_of(s, "yardi_units")


@query
def clean_leases(s):
    return cleaned(s, "yardi_leases").rows


@query
def clean_leases_log(s):
    return log_of(s, "yardi_leases")


@query
def clean_shifts(s):
    return cleaned(s, "adp_shifts").rows


@query
def clean_shifts_log(s):
    return log_of(s, "adp_shifts")


@query
def clean_reviews(s):
    return cleaned(s, "gbp_reviews").rows


@query
def clean_reviews_log(s):
    return log_of(s, "gbp_reviews", "raw_value")


@query
def clean_leads(s):
    return cleaned(s, "hubspot_leads").rows


@query
def clean_leads_log(s):
    return log_of(s, "hubspot_leads", "raw_value")


def all_logs(s) -> DataFrame:
    logs = [cleaned(s, t).quarantine for t in sh.RAW]
    return quality.collect_quarantine([log for log in logs if log is not None])


@shared_query
def quarantine_summary(s):
    return quality.quarantine_summary(all_logs(s))


# --- star schema from cleaned tables ------------------------------------------------------


@query
def dim_unit(s):
    units = cleaned(s, "yardi_units").current
    return as_double(gold.dim_unit(units), "list_rent")


@query
def star_misfits(s):
    """Rents that no decimal(10,2) holds, counted where they would be lost."""
    rents = F.when(F.length("unit_id") % 2 == 0, F.lit(1e17)).otherwise(F.lit(float("inf")))
    units = cleaned(s, "yardi_units").current.withColumn("monthly_rent", rents)
    return gold.dim_unit(units, into=gold.misfits)


@query
def dim_resident(s):
    return gold.dim_resident(cleaned(s, "pcc_residents").current).withColumn(
        "current_acuity", F.col("current_acuity").cast("bigint")
    )


@query
def fact_shift(s):
    built = gold.fact_shift(cleaned(s, "adp_shifts").rows)
    return as_double(built, "hours_worked", "hourly_rate", "labor_cost")


@query
def fact_incident(s):
    return gold.fact_incident(cleaned(s, "pcc_incidents").rows).withColumn("severity", F.col("severity").cast("bigint"))


@query
def fact_lease(s):
    return as_double(gold.fact_lease(cleaned(s, "yardi_leases").rows), "monthly_rate")


@query
def fact_review(s):
    built = gold.fact_review(cleaned(s, "gbp_reviews").rows)
    return built.withColumns({c: F.col(c).cast("bigint") for c in ("rating", "response_days")})


@query
def fact_lead(s):
    return gold.fact_lead(cleaned(s, "hubspot_leads").rows)


# --- reconciliation -----------------------------------------------------------------------


@shared_query
def run_metrics(s):
    """Rows in, out and logged for every cleaner."""
    parts = []
    for name, (source, _) in silver.CLEANERS.items():
        done = cleaned(s, source)
        parts.append(checks.figures(sh.RAW[source](s), **{f"bronze {source}": F.count(F.lit(1))}))
        parts.append(checks.figures(done.rows, **{f"silver {name}": F.count(F.lit(1))}))
    parts.append(checks.figures(all_logs(s), **{"silver quarantine": F.count(F.lit(1))}))
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    return rows.select(F.col("name").alias("object"), F.col("value").cast("bigint").alias("row_count"))


def sample_tables(s):
    """Landed, cleaned and fact frames for the checks."""
    landed = {t: build(s) for t, build in sh.RAW.items()}
    done = {name: cleaned(s, source) for name, (source, _) in silver.CLEANERS.items()}
    layer = {name: c.rows for name, c in done.items()}
    layer["shifts"] = s.keep("shifts", lambda: layer["shifts"])
    layer["residents"] = done["residents_monthly"].current
    star = {
        "fact_shift": gold.fact_shift(layer["shifts"]),
        "fact_incident": gold.fact_incident(layer["incidents"]),
        "fact_lease": gold.fact_lease(layer["leases"]),
        "fact_review": gold.fact_review(layer["reviews"]),
        "fact_lead": gold.fact_lead(layer["leads"]),
    }
    return landed, layer, star


@shared_query
def reconcile_landed(s):
    """Row counts recorded per file against the landed rows; one source lost a row of each file of 1998."""
    landed = {t: build(s) for t, build in sh.RAW.items()}

    def lost(table: str) -> Column:
        missing = F.first("_source_file").contains("_1998_") if table == "gbp_reviews" else F.lit(False)
        return F.when(missing, 1).otherwise(0)

    recorded = reduce(
        lambda a, b: a.unionByName(b),
        [
            df.groupBy("_source_file").agg((F.count(F.lit(1)) + lost(t)).alias("row_count")).withColumn("table_name", F.lit(t))
            for t, df in landed.items()
        ],
    )
    return checks.landed_rows(recorded, landed)


@shared_query
def reconcile_counts(s):
    landed, layer, star = sample_tables(s)
    return checks.row_checks(landed, layer, star, all_logs(s))


# what the census, the ranges and the counts read of a resident
STAY_COLUMNS = ["resident_id", "community_id", "admit_date", "discharge_date", "care_level"]


@shared_query
def reconcile_aggregates(s):
    _, layer, star = sample_tables(s)
    bounds = s.keep("bounds", lambda: temporal.analysis_window(sh.shipping_months(s), "snapshot_date"))
    start, end = temporal.window_bounds(bounds)
    layer["residents"] = s.keep("residents", lambda: layer["residents"].select(*STAY_COLUMNS))
    star["dim_resident"] = layer["residents"]
    segments = temporal.census_segments(layer["residents"], no_ranges(s, layer["residents"]), start, end)
    star["fact_resident_day"] = temporal.census_days(segments)
    star["fact_monthly_revenue"] = gold.fact_monthly_revenue(layer["leases"], start, end)
    return checks.aggregate_checks(layer, star, bounds)


def no_ranges(s, residents: DataFrame) -> DataFrame:
    """Ranges keyed as the raw residents are, built from the raw history's customers."""
    history = s.keep("history", lambda: cleaned(s, "pcc_care_history").rows)
    return temporal.level_ranges(history, residents).withColumn("care_level_key", F.lit(None).cast("bigint"))


@shared_query
def business_rules(s):
    """Violations per rule when the sample shapes stand in for the star schema."""
    built = ranges(s)
    residents = sh.stays(s).withColumn("current_acuity", F.length("care_level") * F.col("community_id"))
    star = {
        # the last community is listed under another key
        "dim_community": sh.communities(s).withColumn("community_id", F.col("community_id") + F.when(F.col("community_id") >= 24, 100).otherwise(0)),
        "dim_resident": residents,
        "dim_resident_care_level": built,
        "fact_lease": sh.leases(s),
        "fact_incident": s.keep("incidents", lambda: sh.incident_facts(s)),
        "fact_shift": sh.shift_facts(s),
        "fact_review": sh.review_facts(s),
        "fact_lead": sh.leads(s),
    }
    bounds = s.orders.agg(F.min(sh.order_day()).alias("window_start"), F.max(sh.order_day()).alias("window_end"))
    occupancy = kpi.monthly_occupancy(census(s), sh.units_monthly(s), sh.communities(s))
    counts = checks.violation_counts(star, occupancy, bounds)
    return counts.select(F.col("name").alias("rule"), F.col("value").cast("bigint").alias("n"))


@shared_query
def business_rule_report(s):
    """The check rows for the same star schema as :func:`business_rules`."""
    counts = business_rules(s).select(F.col("rule").alias("name"), F.col("n").cast("double").alias("value"))
    return checks.rule_rows(counts)


@shared_query
def check_summary(s):
    return checks.summary(business_rule_report(s)).select(
        F.col("checks_run").cast("bigint").alias("checks_run"),
        F.col("passed").cast("bigint").alias("passed"),
        F.size("warnings").cast("bigint").alias("warnings"),
        F.size("failures").cast("bigint").alias("failures"),
    )


@query
def saved_tables(s):
    """Tables a run has stored, plain and by partition: rows counted while writing and when read back."""
    run = build.Run(s.spark, scratch(s, "warehouse"), "sample")
    stored = {
        "orders": run.save("silver", "orders", s.orders),
        "lineitem": run.save("gold", "lineitem", s.lineitem, partition_by="l_returnflag"),
    }
    parts = [df.agg(F.count(F.lit(1)).alias("stored")).withColumn("object", F.lit(n)) for n, df in stored.items()]
    counted = run.metrics().select(F.col("stage").alias("layer"), "object", "row_count", "status")
    return counted.join(parts[0].unionByName(parts[1]), "object")


@query
def views_by_sql(s):
    """A KPI frame asked by name in SQL."""
    kpi.register_views({"v_reviews_summary": kpi.reviews_summary(sh.review_facts(s), sh.communities(s))})
    return s.spark.sql("SELECT region, CAST(sum(review_count) AS BIGINT) AS reviews FROM v_reviews_summary GROUP BY region")


# --- files --------------------------------------------------------------------------------


@query
def replace_by_file(s):
    """Land reviews by file, land corrected 1997 files again, and read the table back."""
    warehouse, rows = scratch(s, "replace"), sh.raw_reviews(s)
    bronze.replace_by_file(files.stamp(rows, "gbp_reviews", "first"), warehouse, "gbp_reviews")
    corrected = rows.filter(F.contains("_source_file", F.lit("_1997_"))).withColumn("rating", F.lit("1"))
    bronze.replace_by_file(files.stamp(corrected, "gbp_reviews", "second"), warehouse, "gbp_reviews")
    back = bronze.read_bronze(s.spark, warehouse, "gbp_reviews")
    return back.groupBy("_source_file", "_batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("rating") == "1").alias("ones")
    ).withColumnsRenamed({"_source_file": "source_file", "_batch_id": "batch_id"})


@query
def export_csv(s):
    """Documents with blanks, quotes and line breaks at their ends, exported and read back."""
    folder = scratch(s, "export")
    text = F.concat(F.lit(' "'), "text", F.lit('"\n'))
    empty = F.when(F.col("doc_id") % 3 == 0, F.lit("")).when(F.col("doc_id") % 3 == 1, F.col("lang"))
    rows = s.documents.select("doc_id", text.alias("text"), empty.alias("lang"), "source", "n_chars")
    tables.export_csv([("documents", rows)], folder)
    return tables.read_csv(s.spark, f"{folder}/documents", "doc_id bigint, text string, lang string, source string, n_chars bigint")


def as_extract(rows: DataFrame, folder: str, name: str) -> None:
    """Write rows as one extract file of that name."""
    target = f"{folder}/.{name}"
    rows.coalesce(1).write.options(**tables.CSV).csv(target)
    jvm = rows.sparkSession._jvm
    source = jvm.org.apache.hadoop.fs.Path(target)
    system = source.getFileSystem(rows.sparkSession._jsc.hadoopConfiguration())
    part = next(f.getPath() for f in system.listStatus(source) if f.getPath().getName().startswith("part-"))
    system.rename(part, jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}"))
    system.delete(source, True)


def order_extracts(s, folder: str) -> None:
    """Orders as monthly extracts, one per status, with drifted headers and quoted line breaks."""
    plain = s.orders.select(*[F.col(c).cast("string").alias(c) for c in ORDER_COLUMNS])
    broken = F.concat("o_orderpriority", F.lit(',\n"x"'))
    turned = plain.select("o_totalprice", "o_orderkey", broken.alias("o_orderpriority"), "o_orderdate", "o_orderstatus", "o_custkey")
    as_extract(plain.filter("o_orderstatus = 'F'"), folder, "hubspot_leads_2025_01.csv")
    as_extract(turned.filter("o_orderstatus = 'O'"), folder, "hubspot_leads_2025_02.csv")
    more = plain.filter("o_orderstatus = 'P'").drop("o_orderpriority").withColumn("extra", F.lit("new"))
    as_extract(more, folder, "hubspot_leads_2025_03.csv")
    as_extract(plain.limit(1), folder, "notes_2025_01.csv")


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def landed_orders(s, warehouse: str) -> DataFrame:
    rows = bronze.read_bronze(s.spark, warehouse, "hubspot_leads")
    typed = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"}
    return rows.select(
        *[F.col(c).cast(typed.get(c, "string")).alias(c) for c in ORDER_COLUMNS if c != "o_orderdate"],
        F.to_date(F.substring("o_orderdate", 1, 10)).alias("o_orderdate"),
        "extra",
        F.col("_source_file").alias("source_file"),
        F.col("_source_system").alias("source_system"),
    )


@query
def landing_rows(s):
    """Orders landed from extracts, one of which is corrected and landed again, and read back."""
    folder, warehouse = scratch(s, "in coming"), scratch(s, "landed")
    order_extracts(s, folder)
    bronze.land(s.spark, folder, warehouse, "first")
    corrected = s.orders.filter("o_orderstatus = 'P'").withColumn("extra", F.lit("newer"))
    files.remove(s.spark, f"{folder}/hubspot_leads_2025_03.csv")
    as_extract(corrected.drop("o_orderpriority"), folder, "hubspot_leads_2025_03.csv")
    bronze.land(s.spark, folder, warehouse, "second")
    return landed_orders(s, warehouse)


@query
def landing_registry(s):
    """What each of three landings did with each file, and how many files it read: the same folder again,
    of which nothing is read, then with the rows of one file in another order."""
    folder, warehouse = scratch(s, "incoming"), scratch(s, "landed")
    order_extracts(s, folder)
    runs = [bronze.land(s.spark, folder, warehouse, str(i)) for i in range(2)]
    files.remove(s.spark, f"{folder}/hubspot_leads_2025_01.csv")
    turned = s.orders.filter("o_orderstatus = 'F'").orderBy(F.desc("o_orderkey"))
    as_extract(turned.select(*[F.col(c).cast("string").alias(c) for c in ORDER_COLUMNS]), folder, "hubspot_leads_2025_01.csv")
    runs.append(bronze.land(s.spark, folder, warehouse, "2"))
    done = [r.files.select(F.lit(i).alias("run"), "file_name", "status", F.lit(r.files_read).cast("bigint").alias("files_read"), F.lit(r.bytes_read > 0).alias("read_any")) for i, r in enumerate(runs)]
    counted = bronze.registry(s.spark, warehouse).select("file_name", "row_count", F.array_join("columns", ",").alias("columns"))
    total = bronze.table_counts(s.spark, warehouse).filter("row_count > 0").select(F.col("row_count").alias("table_rows"))
    return reduce(lambda a, b: a.unionByName(b), done).join(counted, "file_name", "left").withColumn("table_rows", total.scalar())


@query
def stream_landing(s):
    """The same extracts landed as a stream, and read back as the batch's table."""
    folder, warehouse = scratch(s, "in coming"), scratch(s, "landed")
    order_extracts(s, folder)
    land_stream(s.spark, folder, warehouse).awaitTermination()
    return landed_orders(s, warehouse)
