"""The sample tables seen as the domain's tables.

Orders play the residents' stays and leases, line items the care history, shifts and
incidents, suppliers the units, nations the communities, and events the leads and monthly
scores. ``raw_*`` shapes are untyped extracts with the defects the cleaners deal with.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staged

TABLES = ("nation", "region", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels")

# --- Fixed values: the texts the defects are made of --------------------------------------
LEVEL_OF_FLAG = {"A": "AL", "N": "IL", "R": "MC"}
LEVEL_OF_STATUS = {"F": "AL", "O": "IL", "P": "MC"}
SPELLINGS = ["IL", "independent", "Independent Living", "AL", "assisted ", "Assisted Living", "MC", " memory",
             "Memory Care", "Respite"]
RATE_TEXT = "{'A': 16, 'N': 21}"
# rate maps in other notations, by the employee's number modulo their count; the first stands for RATE_TEXT
RATE_FORMS = [
    "", "{'A': (16.5), 'N': [1, 2]}", "{'A': 1_000, 'N': 0x10}", "{'A': True, 'N': '2_1.5', 5: 6}",
    r"{'it\'s': 3, 'N': 21}", "{'A': 4, 'N': foo}", "{'A': {'N': 1}, 'N': (7,)}", "{(1, 2): 3, 'A': 8}",
]


class Sample:
    """The sample tables of one scale factor."""

    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.folder = folder.rstrip("/")
        #: Shapes that several parts of a query start from are derived once and staged.
        self.sharing = False
        self.kept: dict[str, DataFrame] = {}

    def keep(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if not self.sharing:
            return build()
        if name not in self.kept:
            self.kept[name] = staged(build(), name)
        return self.kept[name]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)


def shared(build: Callable[[Sample], DataFrame]) -> Callable[[Sample], DataFrame]:
    """A shape that queries with several parts keep: one that joins or groups its tables. What a scan of
    those gives is cheaper derived again, with the columns that are read, than written as a whole."""

    @wraps(build)
    def once(s: Sample) -> DataFrame:
        return s.keep(build.__name__, lambda: build(s))

    return once


def pick(c: Column, values: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), c)


def ship_day() -> Column:
    return F.to_date("l_shipdate")


def order_day() -> Column:
    return F.to_date("o_orderdate")


def communities(s: Sample) -> DataFrame:
    return s.nation.join(s.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("community_id"),
        F.col("n_name").alias("community_name"),
        F.col("r_name").alias("region"),
    )


def last_shipment(s: Sample) -> DataFrame:
    return s.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max(ship_day()).alias("last_ship"), F.min(ship_day()).alias("first_ship")
    )


@shared
def shipped_orders(s: Sample) -> DataFrame:
    """Orders with their customer's nation and their first and last shipping day. The order's join comes
    last, so that rows lie by order, as most that is made of them is grouped."""
    nation = s.customer.select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("bigint").alias("community_id")
    )
    placed = s.orders.withColumn("admit_date", order_day()).join(nation, "o_custkey")
    return placed.join(last_shipment(s), "o_orderkey", "left")


def discharge() -> Column:
    return F.when(F.col("last_ship") > F.col("admit_date"), F.col("last_ship"))


def stays(s: Sample) -> DataFrame:
    return shipped_orders(s).select(
        F.col("o_orderkey").alias("resident_id"),
        "community_id",
        "admit_date",
        discharge().alias("discharge_date"),
        pick(F.col("o_orderstatus"), LEVEL_OF_STATUS).alias("care_level"),
    )


@shared
def care_history(s: Sample) -> DataFrame:
    """Level changes of a stay: at most one row per order, shipping day and level."""
    return s.lineitem.groupBy(
        F.col("l_orderkey").alias("resident_id"),
        ship_day().alias("change_date"),
        pick(F.col("l_returnflag"), LEVEL_OF_FLAG).alias("new_level"),
    ).agg(
        F.max(F.when(F.col("l_linestatus") == "F", F.lit("AL"))).alias("previous_level"),
        F.min("l_linestatus").alias("reason"),
    )


def shipping_months(s: Sample) -> DataFrame:
    """The snapshot months of the sample, one row per line item, for the analysis window."""
    return s.lineitem.select(F.trunc(ship_day(), "MM").alias("snapshot_date"))


def units_monthly(s: Sample) -> DataFrame:
    """A supplier is offered as a unit in every month it ships in."""
    place = s.supplier.select(
        F.col("s_suppkey").alias("unit_id"), F.col("s_nationkey").cast("bigint").alias("community_id")
    )
    months = s.lineitem.select(
        F.col("l_suppkey").alias("unit_id"), F.trunc(ship_day(), "MM").alias("snapshot_date")
    ).distinct()
    return months.join(place, "unit_id")


def leases(s: Sample) -> DataFrame:
    return shipped_orders(s).select(
        F.col("o_orderkey").alias("lease_id"),
        F.col("o_custkey").alias("resident_id"),
        F.lit(None).cast("bigint").alias("unit_id"),
        "community_id",
        F.col("admit_date").alias("move_in_date"),
        discharge().alias("move_out_date"),
        F.col("o_orderpriority").alias("move_out_reason"),
        F.col("o_totalprice").alias("monthly_rate"),
    )


def shift_facts(s: Sample) -> DataFrame:
    """Line items as worked shifts at the supplier's nation."""
    place = s.supplier.select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("bigint").alias("community_id")
    )
    return s.lineitem.join(place, "l_suppkey").select(
        ship_day().alias("date_key"),
        "community_id",
        F.col("l_quantity").cast("decimal(5,2)").alias("hours_worked"),
        (F.col("l_quantity") * (15 + F.col("l_linenumber"))).cast("decimal(10,2)").alias("labor_cost"),
    )


def incident_facts(s: Sample) -> DataFrame:
    """Line items as incidents of their order's stay."""
    place = shipped_place(s)
    return (
        s.lineitem.select(
            F.col("l_orderkey").alias("resident_id"),
            ship_day().alias("date_key"),
            (1 + F.col("l_linenumber") % 5).alias("severity"),
        )
        .join(place, "resident_id")
    )


def shipped_place(s: Sample) -> DataFrame:
    if s.sharing:  # the same orders, already derived
        return shipped_orders(s).select(F.col("o_orderkey").alias("resident_id"), "community_id")
    nation = s.customer.select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("bigint").alias("community_id")
    )
    return s.orders.select(F.col("o_orderkey").alias("resident_id"), "o_custkey").join(nation, "o_custkey").drop("o_custkey")


def reviews(s: Sample) -> DataFrame:
    """Orders as reviews: the priority's digit is the rating, the first shipment the response."""
    return shipped_orders(s).select(
        F.col("o_orderkey").alias("review_id"),
        "community_id",
        F.col("admit_date").alias("review_date"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("rating"),
        F.when(F.col("first_ship") >= F.col("admit_date"), F.col("first_ship")).alias("responded_at"),
    )


def review_facts(s: Sample) -> DataFrame:
    return reviews(s).select(
        "review_id",
        "community_id",
        F.col("review_date").alias("date_key"),
        "rating",
        F.col("responded_at").isNotNull().alias("was_responded"),
        F.datediff("responded_at", "review_date").alias("response_days"),
    )


def leads(s: Sample) -> DataFrame:
    """Users as leads: the first day of each kind of event is a step of the funnel."""

    def first_day(kind: str) -> Column:
        return F.to_date(F.min(F.when(F.col("event_type") == kind, F.col("ts"))))

    steps = s.events.groupBy("user_id").agg(
        first_day("view").alias("created_date"),
        first_day("click").alias("tour_date"),
        first_day("signup").alias("deposit_date"),
        first_day("purchase").alias("move_in_date"),
        F.max("value").alias("best"),
    )
    nation = s.customer.select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").cast("bigint").alias("community_id")
    )
    return steps.join(nation, "user_id").select(
        F.col("user_id").alias("lead_id"),
        "community_id",
        "created_date",
        "tour_date",
        "deposit_date",
        "move_in_date",
        F.when(F.col("best") > 300, "Won").when(F.col("best") > 150, "Lost").otherwise("Open").alias("status"),
    )


def scores(s: Sample) -> DataFrame:
    """Weekly score of each user: the whole part of the week's largest event value."""
    week = F.to_date(F.date_trunc("week", F.to_date("ts")))
    return s.events.groupBy("user_id", week.alias("week")).agg(
        F.floor(F.max("value")).cast("bigint").alias("acuity")
    )


# --- raw extracts -------------------------------------------------------------------------


def us_text(c: Column) -> Column:
    """M/d/yyyy without padding."""
    return F.concat_ws("/", F.month(c), F.day(c), F.year(c))


def date_text(c: Column, kind: Column) -> Column:
    """A date as ISO text, US text, padded with blanks, or not a date, by ``kind`` % 7."""
    return (
        F.when(kind % 7 == 0, us_text(c))
        .when(kind % 7 == 1, F.concat(F.lit(" "), c.cast("string"), F.lit("\t")))
        .when(kind % 7 == 2, F.lit("n/a"))
        .when(kind % 7 == 3, F.concat(F.year(c).cast("string"), F.lit("-13-01")))
        .otherwise(c.cast("string"))
    )


def file_of(table: str, day: Column) -> Column:
    return F.concat(F.lit(f"{table}_"), F.date_format(day, "yyyy_MM"), F.lit(".csv"))


def spelling(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in SPELLINGS]), (kind % len(SPELLINGS) + 1).cast("int"))


def raw_residents(s: Sample) -> DataFrame:
    """Customers as residents with one row per order in the month of the order."""
    o = F.col("o_orderkey")
    strayed = F.when(F.col("o_orderpriority") == "5-LOW", (F.col("community_id") + 1) % 25).otherwise(
        F.col("community_id")
    )
    acuity = F.floor(F.col("o_totalprice") / 40000).cast("string")
    return shipped_orders(s).select(
        F.col("o_custkey").cast("string").alias("resident_id"),
        strayed.cast("string").alias("community_id"),
        F.concat(F.lit("first "), F.col("o_custkey")).alias("first_name"),
        F.concat(F.lit("last "), o).alias("last_name"),
        us_text(F.add_months("admit_date", -960)).alias("dob"),
        F.col("o_orderstatus").alias("gender"),
        date_text(F.col("admit_date"), o).alias("admit_date"),
        F.when(o % 3 == 0, F.col("last_ship").cast("string")).alias("discharge_date"),
        spelling(o).alias("care_level"),
        F.when(o % 11 == 0, "n/a").otherwise(acuity).alias("acuity_score"),
        file_of("pcc_residents", F.col("admit_date")).alias("_source_file"),
        o.alias("_row_seq"),
    )


def raw_incidents(s: Sample) -> DataFrame:
    """Line items as incidents with repeated ids, severities out of range and text severities."""
    n = F.col("l_linenumber")
    return s.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("incident_id"),
        F.col("l_orderkey").cast("string").alias("resident_id"),
        F.col("l_suppkey").cast("string").alias("community_id"),
        ship_day().cast("string").alias("incident_date"),
        F.col("l_returnflag").alias("incident_type"),
        F.when(F.col("l_linestatus") == "O", (n + F.col("l_quantity").cast("int") % 3 - 1).cast("string"))
        .otherwise(F.lit("severe"))
        .alias("severity"),
        F.col("l_partkey").cast("string").alias("reported_by"),
        file_of("pcc_incidents", ship_day()).alias("_source_file"),
        line_seq().alias("_row_seq"),
    )


def line_seq() -> Column:
    """A row order for line items that is the same in every engine."""
    return F.col("l_partkey") * 1000000000 + F.col("l_suppkey") * 10000 + F.col("l_quantity").cast("bigint") * 100


def raw_care_history(s: Sample) -> DataFrame:
    return s.lineitem.select(
        F.col("l_orderkey").cast("string").alias("resident_id"),
        us_text(ship_day()).alias("change_date"),
        F.when(F.col("l_linestatus") == "F", spelling(F.col("l_partkey"))).alias("previous_level"),
        spelling(F.col("l_suppkey")).alias("new_level"),
        F.col("l_returnflag").alias("reason"),
        file_of("pcc_care_history", ship_day()).alias("_source_file"),
        line_seq().alias("_row_seq"),
    )


@shared
def raw_units(s: Sample) -> DataFrame:
    """Parts shipped by a supplier in a month as unit snapshots; nations above 21 are unknown."""
    place = s.supplier.select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("string").alias("community_id")
    )
    month = F.trunc(ship_day(), "MM")
    return (
        s.lineitem.groupBy("l_suppkey", month.alias("m"))
        .agg(F.count(F.lit(1)).alias("n"))
        .join(place, "l_suppkey")
        .select(
            F.col("l_suppkey").cast("string").alias("unit_id"),
            "community_id",
            F.lit("AL").alias("unit_type"),
            F.when(F.col("n") > 1, (F.col("n") * 100).cast("string")).otherwise("tbd").alias("monthly_rent"),
            us_text(F.col("m")).alias("snapshot_date"),
            file_of("yardi_units", F.col("m")).alias("_source_file"),
            F.col("l_suppkey").alias("_row_seq"),
        )
    )


KNOWN_NATIONS = [str(i) for i in range(22)]


def raw_leases(s: Sample) -> DataFrame:
    """Line items as lease exports: an order's lease is exported again with every line item."""
    o = s.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    return s.lineitem.join(o, "l_orderkey").select(
        F.col("l_orderkey").cast("string").alias("lease_id"),
        F.col("o_custkey").cast("string").alias("resident_id"),
        F.col("l_partkey").cast("string").alias("unit_id"),
        F.col("l_suppkey").cast("string").alias("community_id"),
        order_day().cast("string").alias("move_in_date"),
        us_text(ship_day()).alias("move_out_date"),
        F.col("o_orderpriority").alias("move_out_reason"),
        F.when(F.col("l_linenumber") == 7, "call").otherwise(F.floor("o_totalprice").cast("string")).alias("monthly_rate"),
        file_of("yardi_leases", ship_day()).alias("_source_file"),
        line_seq().alias("_row_seq"),
    )


def raw_shifts(s: Sample) -> DataFrame:
    """Line items as shifts with role-keyed rate text, plain rates, unknown roles and long hours."""
    n = F.col("l_linenumber")
    return s.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("shift_id"),
        F.col("l_suppkey").cast("string").alias("community_id"),
        F.col("l_partkey").cast("string").alias("employee_id"),
        F.col("l_returnflag").alias("role"),
        ship_day().cast("string").alias("shift_date"),
        F.when(n == 6, "all day").otherwise((F.col("l_quantity") - 2).cast("string")).alias("hours_worked"),
        F.when(n == 1, "18.5").when(n == 2, "NaN").otherwise(F.lit(RATE_TEXT)).alias("hourly_rate"),
        file_of("adp_shifts", ship_day()).alias("_source_file"),
        line_seq().alias("_row_seq"),
    )


def raw_reviews(s: Sample) -> DataFrame:
    o = F.col("o_orderkey")
    return shipped_orders(s).select(
        o.cast("string").alias("review_id"),
        F.col("community_id").cast("string").alias("community_id"),
        date_text(F.col("admit_date"), o).alias("review_date"),
        F.when(o % 10 == 0, "five").otherwise((o % 8).cast("string")).alias("rating"),
        F.col("o_orderstatus").alias("review_text"),
        F.lit(None).cast("string").alias("response_text"),
        F.col("first_ship").cast("string").alias("responded_at"),
        file_of("gbp_reviews", F.col("admit_date")).alias("_source_file"),
        o.alias("_row_seq"),
    )


def raw_leads(s: Sample) -> DataFrame:
    """Orders per customer as re-exported leads; each re-export may disagree with the others."""
    o = F.col("o_orderkey")
    return shipped_orders(s).select(
        F.col("o_custkey").cast("string").alias("lead_id"),
        F.col("community_id").cast("string").alias("community_id"),
        F.lit("Web").alias("lead_source"),
        F.lit("2024-01-05").alias("created_date"),
        F.col("first_ship").cast("string").alias("tour_date"),
        us_text(F.col("last_ship")).alias("deposit_date"),
        F.lit(None).cast("string").alias("move_in_date"),
        F.col("o_orderstatus").alias("status"),
        F.lit(None).cast("string").alias("lost_reason"),
        file_of("hubspot_leads", F.col("admit_date")).alias("_source_file"),
        o.alias("_row_seq"),
    )


RAW = {
    "pcc_residents": raw_residents,
    "pcc_incidents": raw_incidents,
    "pcc_care_history": raw_care_history,
    "yardi_units": raw_units,
    "yardi_leases": raw_leases,
    "adp_shifts": raw_shifts,
    "gbp_reviews": raw_reviews,
    "hubspot_leads": raw_leads,
}
