"""Integrity operators: what a database engine enforces, returned as rows to look at."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import model
from . import temporal


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def missing_references(df: DataFrame, column: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Non-NULL values without a dimension row, with the number of rows that use them."""
    used = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(F.col(dim_key).alias("_known"))
    return used.join(known, F.col(column) == F.col("_known"), "left_anti")


def orphan_rows(df: DataFrame, column: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """As :func:`missing_references`, but rows with a NULL reference count as orphans too."""
    used = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(F.col(dim_key).alias("_known"))
    return used.join(known, F.col(column) == F.col("_known"), "left_anti")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, counted in a single pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in columns])
    return wide.select(F.inline(pairs))


def decimal_misfits(df: DataFrame, column: str, precision: int, scale: int) -> DataFrame:
    """Rows whose value does not fit the declared decimal type."""
    return df.filter(
        F.col(column).isNotNull() & F.col(column).try_cast(f"decimal({precision},{scale})").isNull()
    )


def star_violations(tables: dict[str, DataFrame], segments: DataFrame | None = None) -> DataFrame:
    """Every violated key, reference and NOT NULL rule of the star schema: (table, rule, n).

    ``segments`` are the pieces of stays that the daily fact was laid out from. With them, its key is
    proven by testing neighbouring segments, and the references that a segment has are tested there, so
    the daily rows are never shuffled.
    """
    found = []

    def add(df: DataFrame, table: str, rule: str, n=F.count(F.lit(1))) -> None:
        found.append(
            df.agg(F.coalesce(n, F.lit(0)).alias("n")).select(
                F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "n"
            )
        )

    for table, df in tables.items():
        keys = model.PRIMARY_KEYS[table]
        pieces = segments if table == "fact_resident_day" else None
        unique = f"unique ({', '.join(keys)})"
        if pieces is None:
            add(duplicate_keys(df, keys), table, unique)
        else:
            add(temporal.repeated_days(pieces), table, unique, F.sum("days"))
        for column, dim, dim_key in model.FOREIGN_KEYS.get(table, []):
            source = pieces if pieces is not None and column in pieces.columns else df
            add(missing_references(source, column, tables[dim], dim_key), table, f"{column} references {dim}")
        nulls = null_counts(df, [*keys, *model.REQUIRED_COLUMNS.get(table, [])])
        found.append(
            nulls.select(
                F.lit(table).alias("table_name"), F.concat("column_name", F.lit(" not null")).alias("rule"), "n"
            )
        )
    return reduce(lambda a, b: a.unionByName(b), found).filter("n > 0")
