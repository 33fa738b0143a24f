"""Layer tables in Parquet, and the CSV export."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace a table. With a partition column the rows are rebalanced by it first, so a
    partition gets few files and a very large one is split over several tasks."""
    if partition_by is None:
        df.write.mode("overwrite").parquet(path)
    else:
        even = df.hint("rebalance", F.col(partition_by))
        even.write.mode("overwrite").partitionBy(partition_by).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


#: How exports are written and read: quotes are doubled, blanks and line breaks kept, an empty text is
#: told from NULL by its quotes.
CSV = {
    "header": True,
    "escape": '"',
    "multiLine": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "lineSep": "\n",
}


def export_csv(frames: Iterable[tuple[str, DataFrame]], folder: str) -> dict[str, str]:
    """Write each frame as CSV with header into a folder of its own, by as many tasks as it has parts."""
    written = {}
    for name, df in frames:
        target = f"{folder}/{name}"
        df.write.mode("overwrite").options(**CSV).csv(target)
        written[name] = target
    return written


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An exported frame, text for text. A cell without anything is read as a mark that no text holds,
    and so as NULL; an empty text in quotes stays one."""
    return spark.read.schema(schema).options(**CSV, nullValue="\ufdd0", emptyValue="").csv(path)
