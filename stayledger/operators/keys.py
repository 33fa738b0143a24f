"""Surrogate keys, anti joins with SQL NULL rules, and per-key snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged


def dense_key(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number all rows 1..n in the global ``order`` without sorting them in a single task.

    Rows are written to the shared folder first, as ranges are found in a pass of its own over them, which
    would derive them twice. They are range-partitioned and sorted, and written again with their partition
    and their position in it, as both are only stable once written. A row's key is its position in
    its partition plus the sizes of the partitions before it; only those sizes (one row per
    partition) pass through one task.
    """
    ascending = [F.col(c).asc_nulls_last() for c in order]
    sorted_rows = staged(df, "unnumbered").repartitionByRange(*ascending).sortWithinPartitions(*ascending)
    placed = sorted_rows.select(
        "*",
        F.spark_partition_id().alias("_part"),
        # the lower 33 bits count the rows of a partition
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"),
    )
    placed = staged(placed, "dense-key")
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    key = (F.col("_offset") + F.col("_pos") + 1).cast("bigint").alias(name)
    return placed.join(offsets, "_part").select(key, *df.columns)


def not_in(df: DataFrame, key: str, banned: DataFrame, banned_key: str) -> DataFrame:
    """``key NOT IN (SELECT banned_key ...)`` with SQL's NULL rules, without broadcasting the list.

    One NULL in the list empties the result; a NULL key only passes an empty list.
    """
    listed = banned.select(F.col(banned_key).alias("_banned"))
    sizes = listed.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_banned").isNull()).alias("nulls"))
    is_empty = sizes.select(F.col("n") == 0).scalar()
    no_nulls = sizes.select(F.col("nulls") == 0).scalar()
    unmatched = df.join(listed.filter("_banned is not null"), F.col(key) == F.col("_banned"), "left_anti")
    return unmatched.filter(is_empty | (no_nulls & F.col(key).isNotNull()))


def latest_per_key(df: DataFrame, key: str, period: str) -> DataFrame:
    """Each key's row of its own latest period."""
    wanted = Window.partitionBy(key).orderBy(F.col(period).desc_nulls_last())
    return df.withColumn("_rank", F.row_number().over(wanted)).filter("_rank = 1").drop("_rank")


def latest_snapshot(df: DataFrame, period: str) -> DataFrame:
    """The rows of the one latest period of the whole table; keys missing there disappear."""
    return df.filter(F.col(period) == df.agg(F.max(period)).scalar())
