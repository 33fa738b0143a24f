"""Numeric coercion and the rounding rules results are compared on."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# whitespace of any script, with the separators that text tools strip
SPACE = r"[\s\x1C-\x1F\x85\p{Z}]"
NUMBER_TEXT = rf"(?i)^{SPACE}*([+-]?(?:\d+\.?\d*(?:e[+-]?\d+)?|\.\d+(?:e[+-]?\d+)?|inf|infinity)){SPACE}*\z"
# from here on doubles have no fraction
WHOLE_FROM = 2.0**53
# decimals of so many digits are told apart by doubles
EXACT_DIGITS = 15


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a number (including NaN) becomes NULL.

    The text is used once only, so a costly expression behind it is not repeated, and what is
    not a number never reaches the cast, where it would raise and catch an error per value.
    """
    return F.nullif(F.regexp_extract(c, NUMBER_TEXT, 1), F.lit("")).try_cast("double")


def sql_round(c: Column, digits: int = 0) -> Column:
    """Round half away from zero on the scaled binary value.

    Spark's own ``round`` works on the decimal rendering of a double, so 1.005 becomes
    1.01; SQL engines that scale the binary value give 1.00. Totals are compared on the latter.
    Values so large that they have no fraction, infinities included, come back as they are.
    """
    scale = float(10**digits)
    value = c.cast("double")
    scaled = F.abs(value) * scale
    rounded = half_up(scaled) / F.lit(scale)
    return F.when(scaled < WHOLE_FROM, F.when(value < 0, -rounded).otherwise(rounded)).otherwise(value)


def half_up(c: Column) -> Column:
    """The whole number nearest to one from 0 up to ``WHOLE_FROM``, of two the larger: its halves, counted
    whole, plus one, halved. ``c`` is named once, as it is written out wherever it is named, and what makes
    a method too long for the virtual machine's compiler is interpreted, at ten times the cost."""
    return F.shiftright(F.floor(c * 2) + 1, 1)


def half_even(c: Column, digits: int) -> Column:
    """Round half to even on the scaled binary value, as array libraries do."""
    scale = float(10**digits)
    return F.rint(c * scale) / F.lit(scale)


def ratio(top: Column, bottom: Column, digits: int, factor: float = 1.0) -> Column:
    """``factor * top / bottom`` in double arithmetic, rounded; NULL for a zero denominator."""
    return sql_round(F.try_divide(top.cast("double") * factor, bottom.cast("double")), digits)


def to_decimal(c: Column, precision: int, scale: int) -> Column:
    """Double to decimal after SQL rounding; a value that does not fit becomes NULL.

    Up to ``EXACT_DIGITS``, where a double tells decimals apart, the rounded units are the decimal's digits;
    beyond, it is read from the double's shortest text.
    """
    target = f"decimal({precision},{scale})"
    if precision > EXACT_DIGITS:
        return sql_round(c, scale).try_cast(target)
    value = c.cast("double")
    scaled = F.abs(value) * float(10**scale)
    units = F.when(scaled < WHOLE_FROM, F.when(value < 0, -half_up(scaled)).otherwise(half_up(scaled)))
    return (units.try_cast(f"decimal({precision},0)") * F.lit(Decimal(1).scaleb(-scale))).try_cast(target)


def to_int(c: Column) -> Column:
    """Double to integer by rounding (half to even) rather than by truncation."""
    return F.rint(c).try_cast("int")
