"""Column expressions shared by every layer. All of them stay on the JVM side."""

from .dates import (
    calendar_columns,
    days_between,
    month_end,
    month_start,
    parse_date,
    snapshot_month,
)
from .numbers import half_even, ratio, sql_round, to_decimal, to_int, to_number
from .text import canonical, rate_for_role, raw_json, strip

__all__ = [
    "calendar_columns",
    "canonical",
    "days_between",
    "half_even",
    "month_end",
    "month_start",
    "parse_date",
    "rate_for_role",
    "ratio",
    "raw_json",
    "snapshot_month",
    "sql_round",
    "strip",
    "to_decimal",
    "to_int",
    "to_number",
]
