"""Date parsing and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import SPACE

# each text matches one of the two branches, whole; of the second nothing is kept
US_TEXT = rf"(?s)^(?:{SPACE}*(\d{{1,2}})/(\d{{1,2}})/((?!0000)\d{{4}}){SPACE}*|.*)\z"
ISO_TEXT = rf"^{SPACE}*((?!0000)\d{{4}}-\d{{1,2}}-\d{{1,2}}){SPACE}*\z"


def parse_date(c: Column) -> Column:
    """Parse ISO ``yyyy-M-d`` or US ``M/d/yyyy`` text, value by value; anything else is NULL.

    One pattern checks a text's shape, and US parts are put in ISO order, so that the cast's own parser
    does the work and no value pays for a failed formatter. A shape that does not fit leaves no digit,
    which the cast turns into NULL without raising an error.
    """
    in_order = F.regexp_replace(c, US_TEXT, "$3-$1-$2")
    return F.when(F.contains(c, F.lit("/")), in_order).otherwise(F.regexp_extract(c, ISO_TEXT, 1)).try_cast("date")


def snapshot_month(file_name: Column) -> Column:
    """First day of the month that the file name ends with (``..._2025_03.csv``)."""
    stamp = F.regexp_extract(file_name, r"_(\d{4}_\d{2})\.csv", 1)
    return F.replace(stamp, F.lit("_"), F.lit("-")).try_cast("date")


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def month_end(c: Column) -> Column:
    return F.last_day(c)


def days_between(start: Column, end: Column) -> Column:
    """Days from ``start`` up to, not including, ``end``."""
    return F.datediff(end, start)


def calendar_columns(day: Column) -> list[Column]:
    """The nine calendar attributes of a day."""
    return [
        day.alias("date_key"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.trunc(day, "MM").alias("month_start"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.day(day).alias("day"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    ]
