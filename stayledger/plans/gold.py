"""Star schema: dimensions and facts from the cleaned tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import model
from ..functions import to_decimal, to_int
from ..operators import temporal


#: What is made of a table's frame: its rows in declared types, or the values lost by that.
Into = Callable[[DataFrame, str], DataFrame]


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select and cast to the declared types of a star-schema table.

    Doubles are rounded before they become decimals or integers; what does not fit is NULL, and
    :func:`misfits` counts it.
    """
    return df.select(*[value.alias(name) for name, value in converted(df, table).items()])


def converted(df: DataFrame, table: str) -> dict[str, Column]:
    out = {}
    for field in T.StructType.fromDDL(model.STAR_SCHEMA[table]):
        source, target = df.schema[field.name].dataType, field.dataType
        value = F.col(field.name)
        if isinstance(source, T.DoubleType) and isinstance(target, T.DecimalType):
            value = to_decimal(value, target.precision, target.scale)
        elif isinstance(source, T.DoubleType) and isinstance(target, T.IntegerType):
            value = to_int(value)
        elif source != target:
            value = value.try_cast(target)
        out[field.name] = value
    return out


def misfits(df: DataFrame, table: str) -> DataFrame:
    """(table_name, rule, n) for every column with values that the declared type can't hold."""
    types = {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(model.STAR_SCHEMA[table])}
    lost = {c: F.col(c).isNotNull() & v.isNull() for c, v in converted(df, table).items()}
    wide = df.agg(*[F.count_if(x).alias(c) for c, x in lost.items()])
    rules = [F.struct(F.lit(table).alias("table_name"), F.lit(f"{c} fits {types[c]}").alias("rule"), F.col(c).alias("n")) for c in lost]
    return wide.select(F.inline(F.array(*rules))).filter("n > 0")


def dim_date(spark, first: str = model.CALENDAR_RANGE[0], last: str = model.CALENDAR_RANGE[1]) -> DataFrame:
    return conform(temporal.calendar(spark.range(1), first, last), "dim_date")


def dim_unit(units: DataFrame, into: Into = conform) -> DataFrame:
    return into(units.withColumnRenamed("monthly_rent", "list_rent"), "dim_unit")


def dim_resident(residents: DataFrame, into: Into = conform) -> DataFrame:
    renamed = residents.withColumnsRenamed(
        {"care_level": "current_care_level", "acuity_score": "current_acuity"}
    )
    return into(renamed, "dim_resident")


def dim_resident_care_level(history: DataFrame, residents: DataFrame) -> DataFrame:
    return conform(temporal.scd2(history, residents), "dim_resident_care_level")


def fact_resident_day(residents: DataFrame, ranges: DataFrame, start, end) -> DataFrame:
    return temporal.census_days(census_segments(residents, ranges, start, end))


def census_segments(residents: DataFrame, ranges: DataFrame, start, end) -> DataFrame:
    """What the daily fact is laid out from: pieces of stays with one care level."""
    return temporal.census_segments(residents, ranges, start, end)


def fact_monthly_revenue(leases: DataFrame, start, end, into: Into = conform) -> DataFrame:
    return into(temporal.prorate(leases, start, end), "fact_monthly_revenue")


def fact_shift(shifts: DataFrame, into: Into = conform) -> DataFrame:
    dated = shifts.filter(F.col("shift_date").isNotNull()).withColumnRenamed("shift_date", "date_key")
    return into(dated, "fact_shift")


def fact_incident(incidents: DataFrame, into: Into = conform) -> DataFrame:
    dated = incidents.filter(F.col("incident_date").isNotNull()).withColumnRenamed("incident_date", "date_key")
    return into(dated, "fact_incident")


def fact_lease(leases: DataFrame, into: Into = conform) -> DataFrame:
    return into(leases, "fact_lease")


def answered(reviews: DataFrame) -> DataFrame:
    """Dated reviews with whether and after how many days they were answered."""
    return reviews.filter(F.col("review_date").isNotNull()).select(
        "*",
        F.col("review_date").alias("date_key"),
        F.col("responded_at").isNotNull().alias("was_responded"),
        F.datediff("responded_at", "review_date").alias("response_days"),
    )


def fact_review(reviews: DataFrame, into: Into = conform) -> DataFrame:
    return into(answered(reviews), "fact_review")


def staged(leads: DataFrame) -> DataFrame:
    """Leads with the funnel steps they reached."""
    return leads.select(
        "*",
        F.col("tour_date").isNotNull().alias("toured"),
        F.col("deposit_date").isNotNull().alias("deposited"),
        (F.col("status") == "Won").alias("converted"),
    )


def fact_lead(leads: DataFrame, into: Into = conform) -> DataFrame:
    return into(staged(leads), "fact_lead")
