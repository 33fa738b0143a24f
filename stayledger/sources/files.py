"""Discovery, fingerprints and raw reads of extract files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import model
from . import quoted

# takes the cells of a row that has more than its header
OVERLONG = "_overlong"


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """CSV files of a folder with the table, year and month their names carry.

    ``status`` is ``ignored`` for names outside the pattern and for unknown tables. File
    content is not read, as only path, length and time are selected. Files of no bytes are not listed.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    return name_parts(described(files))


def described(files: DataFrame) -> DataFrame:
    """What a listing tells of files without reading them."""
    return files.select(
        "path", "length", F.col("modificationTime").alias("modified"), F.element_at(F.split("path", "/"), -1).alias("file_name")
    )


def name_parts(files: DataFrame) -> DataFrame:
    """Split ``file_name`` into table, year and month and mark what is not a known source."""

    def part(i: int):
        return F.nullif(F.regexp_extract("file_name", model.FILE_NAME_PATTERN, i), F.lit(""))

    known = F.coalesce(part(1).isin(list(model.SOURCE_SYSTEMS)), F.lit(False))
    return files.select(
        "*",
        part(1).alias("table_name"),
        part(2).cast("int").alias("year"),
        part(3).cast("int").alias("month"),
        F.when(known, "known").otherwise("ignored").alias("status"),
    )


def profiles(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file_name, file_hash, header, open_quotes, empty) from one pass over the files as text.

    The digest takes every line at its place in the file, so rows that only change places change it.
    It is put together from sums per split: within a split lines are weighed by their place there,
    and the number of lines in earlier splits shifts that weight. So it doesn't depend on how a file
    is split, a huge file is read by many tasks, and the same rule holds for every size.
    """
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place"),  # within the task
        "value",
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    hashed = F.xxhash64("value")
    halves = {"a": hashed.bitwiseAND(0xFFFFFFFF), "b": F.shiftrightunsigned(hashed, 32)}
    sums = [F.sum(h.cast("decimal(12,0)")).alias(f"s{k}") for k, h in halves.items()]
    weighed = [F.sum(h.cast("decimal(12,0)") * F.col("place").cast("decimal(12,0)")).alias(f"w{k}") for k, h in halves.items()]
    splits = lines.groupBy("file_name", "at").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.octet_length("value")).alias("bytes"),
        F.min("place").alias("first"),
        F.min_by("value", "place").alias("header"),
        F.bool_or(quotes % 2 == 1).alias("open_quotes"),
        F.count_if(F.length(F.trim("value")) > 0).alias("filled"),
        *sums,
        *weighed,
    )
    earlier = Window.partitionBy("file_name").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    shift = (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).cast("decimal(13,0)")
    placed = splits.withColumn("shift", shift)
    digest = [F.sum(f"s{k}").cast("string") for k in halves]
    digest += [F.sum(F.col(f"w{k}").cast("decimal(38,0)") + F.col(f"s{k}").cast("decimal(24,0)") * F.col("shift")).cast("string") for k in halves]
    return placed.groupBy("file_name").agg(
        F.md5(F.concat_ws("|", F.sum("n").cast("string"), F.sum("bytes").cast("string"), *digest)).alias("file_hash"),
        F.min_by("header", "at").alias("header"),
        F.bool_or("open_quotes").alias("open_quotes"),
        (F.sum("filled") <= 1).alias("empty"),
    )


def pending(found: DataFrame, registry: DataFrame) -> DataFrame:
    """Files whose current content is not in the registry: new ones and changed ones."""
    return found.join(registry.select("file_name", "file_hash"), ["file_name", "file_hash"], "left_anti")


def already_landed(found: DataFrame, registry: DataFrame) -> DataFrame:
    return found.join(registry.select("file_name", "file_hash"), ["file_name", "file_hash"], "left_semi")


def header_columns(spark: SparkSession, path: str) -> list[str]:
    """The column names a file's header gives."""
    return spark.read.option("header", True).option("escape", '"').csv(path).columns


#: How cells are quoted in extracts.
CELLS = {"escape": '"', "emptyValue": ""}


def read_extract(spark: SparkSession, columns: Sequence[str], open_quotes: bool, paths: Sequence[str]) -> DataFrame:
    """Files that share one header as text columns; empty cells are NULL, "NA" stays text.

    Rows with fewer cells than the header are filled up with NULL. A row with more cells stops the
    read with the file's name, as values would be lost otherwise. ``_row_seq`` keeps the order of the
    rows within a file. Files with line breaks in quoted cells (``open_quotes``) are put together from
    lines, see :mod:`quoted`; either way a large file is read by many tasks.
    """
    cells = [f"c{i}" for i in range(len(columns))]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*cells, OVERLONG)])
    if open_quotes:
        found = quoted.records(spark, paths)
        headers = found.groupBy("file_name").agg(F.min("record").alias("header"))
        rows = found.join(headers, "file_name").filter(F.col("record") > F.col("header"))
        parsed = F.from_csv("value", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), CELLS)
        rows = rows.select(F.col("file_name").alias("_source_file"), F.col("record").alias("_row_seq"), parsed.alias("p")).select("_source_file", "_row_seq", "p.*")
    else:
        read = spark.read.schema(schema).option("header", True).options(**CELLS).csv(list(paths))
        rows = read.select("*", F.col("_metadata.file_name").alias("_source_file"), F.monotonically_increasing_id().alias("_row_seq"))
    more = F.raise_error(F.concat(F.lit("a row has more cells than the header in "), F.col("_source_file"))).cast("string")
    first, *others = [F.nullif(F.col(c), F.lit("")) for c in cells]
    checked = F.when(F.col(OVERLONG).isNull(), first).otherwise(more)
    return rows.select(*[c.alias(n) for n, c in zip(columns, (checked, *others))], "_source_file", "_row_seq")


def drift_union(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns a part lacks are NULL in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def stamp(rows: DataFrame, table: str, batch_id: str) -> DataFrame:
    """Add source system, ingestion time and batch to landed rows."""
    return rows.withColumns(
        {
            "_source_system": F.lit(model.SOURCE_SYSTEMS[table]),
            "_ingested_at": F.current_timestamp(),
            "_batch_id": F.lit(batch_id),
        }
    )


def remove(spark: SparkSession, path: str, folder: bool = False) -> None:
    """Delete one file, or a folder with all it holds, wherever Spark can reach it."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    file.getFileSystem(spark._jsc.hadoopConfiguration()).delete(file, folder)
