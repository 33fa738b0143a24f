"""Records of text files whose quoted cells hold line breaks, found by many tasks.

Whether a line begins inside quotes depends on all lines before it, but only through one bit. Each line
is therefore summed up as a function of that bit: whether a cell is still open at its end if none was at
its beginning, and if one was. Functions of one bit compose, so the bit is carried through a split's lines
for both possible beginnings, then through the splits of a file, and each line gets the number of its
record. Lines of the same record are put together again; only records of several lines are grouped.

A quote opens a cell only where the cell begins, and two quotes within a quoted cell stand for one, as in
Spark's own reader.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import staged

# where a reader stands: at a cell's beginning, within a plain cell, within quotes, after a closing quote
_BEGIN, _PLAIN, _QUOTED, _CLOSED = range(4)


def _read(at: Column, text: Column) -> Column:
    """Where a reader stands after text without quotes."""
    return (
        F.when((at == _QUOTED) | (text == ""), at).when(F.endswith(text, F.lit(",")), _BEGIN).otherwise(_PLAIN)
    )


def _quote(at: Column) -> Column:
    """Where a reader stands after a quote."""
    return F.when((at == _BEGIN) | (at == _CLOSED), _QUOTED).when(at == _QUOTED, _CLOSED).otherwise(at)


def left_open(line: Column, inside: bool) -> Column:
    """Whether a quoted cell is open at the line's end; ``inside`` tells whether one was before it."""
    parts = F.split(line, '"', -1)
    first = _read(F.lit(_QUOTED if inside else _BEGIN), F.get(parts, F.lit(0)))
    end = F.aggregate(F.slice(parts, 2, F.size(parts)), first, lambda at, text: _read(_quote(at), text))
    return F.when(F.contains(line, F.lit('"')), end == _QUOTED).otherwise(inside)


def carried(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """``df`` (with the functions ``f0``, ``f1``) and the bit before each row: ``s0`` if the key's first
    row is entered with false, ``s1`` with true.

    The bit is that of the last row before that sets it whatever came in, turned over by each row since
    that turns it over.
    """
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turns = (F.col("f0") & ~F.col("f1")).cast("int")
    sets = F.when(F.col("f0") == F.col("f1"), F.struct(F.col("f0").alias("bit"), F.col("_turns").alias("turns")))
    counted = df.withColumn("_turns", F.sum(turns).over(upto))
    found = counted.withColumns({"_set": F.last(sets, ignorenulls=True).over(earlier), "_before": F.col("_turns") - turns})
    odd = (F.col("_before") - F.coalesce(F.col("_set.turns"), F.lit(0))) % 2 == 1

    def bit(entered: bool) -> Column:
        return F.coalesce(F.col("_set.bit"), F.lit(entered)) != odd

    return found.withColumns({"s0": bit(False), "s1": bit(True)}).drop("_turns", "_set", "_before")


def records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file_name, record, value): the files' records in order, numbered from 1 in each file, without
    blank lines. Line breaks within a record are ``\\n``. A quote that is never closed makes the rest of
    its file one record."""
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place"),  # within the task
        F.regexp_replace("value", r"\r\z", "").alias("value"),
    )
    judged = lines.withColumns({"f0": left_open(F.col("value"), False), "f1": left_open(F.col("value"), True)})
    split = ["file_name", "at"]
    upto = Window.partitionBy(*split).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    after = {f"a{i}": F.when(F.col(f"s{i}"), F.col("f1")).otherwise(F.col("f0")) for i in (0, 1)}
    begun = {f"n{i}": F.sum((~F.col(f"s{i}")).cast("bigint")).over(upto) for i in (0, 1)}
    placed = carried(judged, split, "place").withColumns({**after, **begun}).drop("f0", "f1")
    placed = staged(placed, "quoted-lines")
    splits = placed.groupBy(*split).agg(
        F.max_by("a0", "place").alias("f0"), F.max_by("a1", "place").alias("f1"), F.max("n0").alias("n0"), F.max("n1").alias("n1")
    )
    earlier = Window.partitionBy("file_name").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    own = F.when(F.col("s0"), F.col("n1")).otherwise(F.col("n0"))
    entered = carried(splits, ["file_name"], "at").select(
        *split, F.col("s0").alias("entered"), F.coalesce(F.sum(own).over(earlier), F.lit(0)).alias("records_before")
    )

    def chosen(name: str) -> Column:
        return F.when(F.col("entered"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))

    numbered = placed.join(entered, split).select(
        *split, "place", "value", (F.col("records_before") + chosen("n")).alias("record"), (chosen("s") | chosen("a")).alias("several")
    )
    single = numbered.filter(~F.col("several") & (F.trim("value") != "")).select("file_name", "record", "value")
    pieces = F.array_sort(F.collect_list(F.struct("at", "place", "value")))
    whole = numbered.filter("several").groupBy("file_name", "record").agg(F.array_join(F.transform(pieces, lambda p: p["value"]), "\n").alias("value"))
    return single.unionByName(whole)
