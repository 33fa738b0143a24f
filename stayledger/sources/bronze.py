"""Landing: extract files to Parquet, once per content, replaced file by file.

Layout under the warehouse folder:

    bronze/<table>/_load=<id>/     landed rows; a load holds the rows of all files that one run landed
    meta/file_registry/            append-only log of landed files

The registry says which load holds a file's rows, so replacing a file means one more load and one more
entry: nothing that is there is rewritten, and the rows that an older load has of that file no longer
count. A run writes the rows first and the entries last. If it dies in between, its load is in no entry,
so nobody reads it, and the next run lands the same files again. Loads of about the same size are merged
when there are ``FAN`` of them, so their number grows with the logarithm of the table.

The registry also keeps each file's length and time of modification. Files whose name, length and time
are known are skipped without being read.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import model
from ..operators.quality import first_per_key
from ..session import staged
from . import files

REGISTRY_SCHEMA = (
    "file_name string, file_hash string, table_name string, row_count bigint, loaded_at timestamp, "
    "columns array<string>, length bigint, modified timestamp, load string, entered_at timestamp"
)
LINEAGE = ["_row_seq", "_source_system", "_ingested_at", "_batch_id"]
#: Loads of one order of size that are merged into one.
FAN = 8


@dataclass
class Landing:
    """What a landing run did: (file_name, status, row_count) of each listed file, and how much it read."""

    files: DataFrame
    files_read: int = 0
    bytes_read: int = 0

    def named(self, status: str) -> list[str]:
        return sorted(r.file_name for r in self.files.filter(F.col("status") == status).collect())

    @property
    def loaded(self) -> dict[str, int]:
        return {r.file_name: r.row_count for r in self.files.filter("status = 'loaded'").collect()}

    @property
    def skipped(self) -> list[str]:
        return self.named("skipped")

    @property
    def ignored(self) -> list[str]:
        return self.named("ignored")


def table_path(warehouse: str, table: str) -> str:
    return f"{warehouse}/bronze/{table}"


def load_path(warehouse: str, table: str, load: str) -> str:
    return f"{table_path(warehouse, table)}/_load={load}"


def registry_path(warehouse: str) -> str:
    return f"{warehouse}/meta/file_registry"


def registry_log(spark: SparkSession, warehouse: str) -> DataFrame:
    """All entries ever made."""
    try:
        return spark.read.schema(REGISTRY_SCHEMA).parquet(registry_path(warehouse))
    except AnalysisException:
        return spark.createDataFrame([], REGISTRY_SCHEMA)


def registry(spark: SparkSession, warehouse: str) -> DataFrame:
    """The current entry of each landed file; a later entry replaces an earlier one."""
    return first_per_key(registry_log(spark, warehouse), ["file_name"], [F.col("entered_at").desc()])


def enter(entries: DataFrame, warehouse: str) -> None:
    """Append entries to the registry."""
    columns = [f.name for f in T._parse_datatype_string(REGISTRY_SCHEMA).fields]
    entries.withColumn("entered_at", F.current_timestamp()).select(*columns).write.mode("append").parquet(registry_path(warehouse))


def bronze_schema(columns) -> T.StructType:
    fields = [T.StructField(c, T.StringType()) for c in columns]
    fields += [
        T.StructField("_row_seq", T.LongType()),
        T.StructField("_source_system", T.StringType()),
        T.StructField("_ingested_at", T.TimestampType()),
        T.StructField("_batch_id", T.StringType()),
        T.StructField("_source_file", T.StringType()),
    ]
    return T.StructType(fields)


def landed_columns(entries: DataFrame) -> list[str]:
    """The union of the files' columns, in the order in which files (by name) bring them up."""
    each = entries.select("file_name", F.posexplode("columns").alias("nth", "name"))
    first = each.groupBy("name").agg(F.min(F.struct("file_name", "nth")).alias("seen"))
    return [r.name for r in first.orderBy("seen").collect()]


def landed_rows(spark: SparkSession, warehouse: str, table: str, loads: list[str] | None = None) -> DataFrame:
    """The rows that count, of all loads or of some, under the union of the files' columns."""
    log = registry_log(spark, warehouse).filter(F.col("table_name") == table)
    current = first_per_key(log, ["file_name"], [F.col("entered_at").desc()])
    schema = bronze_schema(landed_columns(current))
    live = [r.load for r in current.filter("row_count > 0").select("load").distinct().collect()]
    live = live if loads is None else [x for x in live if x in loads]
    if not live:
        return spark.createDataFrame([], schema)
    read = T.StructType([*schema.fields, T.StructField("_load", T.StringType())])
    rows = spark.read.schema(read).parquet(table_path(warehouse, table)).filter(F.col("_load").isin(live))
    pairs = lambda df: df.select(F.col("file_name").alias("_source_file"), F.col("load").alias("_load"))
    # few rows in a load belong to files that were replaced since: those are taken out
    stale = pairs(log.filter(F.col("load").isin(live))).distinct().join(pairs(current), ["_source_file", "_load"], "left_anti")
    return rows.join(stale, ["_source_file", "_load"], "left_anti").select(*schema.fieldNames())


def read_bronze(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """A landed table. The registry knows the columns, so no footers are merged; rows of files without a
    column have NULL there."""
    return landed_rows(spark, warehouse, table)


def put(rows: DataFrame, found: DataFrame, warehouse: str, table: str) -> DataFrame:
    """Write rows as a new load; returns the entries (not made yet) of the files ``found`` with the number
    of rows each has in it. Their earlier rows count until :func:`enter`."""
    load = uuid.uuid4().hex
    path = load_path(warehouse, table, load)
    rows.write.parquet(path)
    written = rows.sparkSession.read.schema(bronze_schema([])).parquet(path).groupBy("_source_file").agg(F.count(F.lit(1)).alias("n"))
    return found.join(written, F.col("file_name") == F.col("_source_file"), "left").select(
        "file_name", "file_hash", "columns", "length", "modified",
        F.lit(table).alias("table_name"),
        F.coalesce("n", F.lit(0)).alias("row_count"),
        F.current_timestamp().alias("loaded_at"),
        F.lit(load).alias("load"),
    )


def replace_by_file(rows: DataFrame, warehouse: str, table: str) -> None:
    """Land rows that are no extracts: each source file in them replaces its earlier rows."""
    own = [c for c in rows.columns if c not in (*LINEAGE, "_source_file")]
    found = rows.select(F.col("_source_file").alias("file_name")).distinct().withColumns(
        {
            "file_hash": F.lit(None).cast("string"),
            "columns": F.array(*[F.lit(c) for c in own]),
            "length": F.lit(None).cast("bigint"),
            "modified": F.lit(None).cast("timestamp"),
        }
    )
    enter(put(rows, found, warehouse, table), warehouse)
    merge_loads(rows.sparkSession, warehouse, table)


def land(spark: SparkSession, folder: str, warehouse: str, batch_id: str, verify: bool = False) -> Landing:
    """Land the new and changed files of a folder. ``verify`` also reads files that look unchanged."""
    return land_files(spark, files.listing(spark, folder), warehouse, batch_id, verify)


def land_files(spark: SparkSession, found: DataFrame, warehouse: str, batch_id: str, verify: bool = False) -> Landing:
    """Land those of the listed files whose content is new.

    Only files whose name, length and time are not in the registry are read: one pass as text gives their
    digests and headers. Those whose digest is known get a new entry with their time, the others are landed.
    The driver sees the paths of the files to read, which Spark's readers need, and the headers.
    """
    known = registry(spark, warehouse).select(
        "file_name", "table_name", "row_count", "loaded_at", "columns", "load",
        F.col("file_hash").alias("known_hash"), F.col("length").alias("known_length"), F.col("modified").alias("known_time"),
    )
    unread = F.lit(not verify) & (F.col("length") == F.col("known_length")) & (F.col("modified") == F.col("known_time"))
    listed = staged(
        found.select("file_name", "path", "length", "modified", "table_name", "status")
        .join(known.drop("table_name"), "file_name", "left")
        .withColumn("unread", F.coalesce(unread, F.lit(False))),
        "landing-files",
    )
    wanted = listed.filter("status = 'known' and not unread")
    paths = [r.path for r in wanted.select("path").collect()]
    if not paths:
        return Landing(report(listed, None))
    size = wanted.agg(F.sum("length")).first()[0]
    read = staged(wanted.join(files.profiles(spark, paths), "file_name"), "landing-profiles")
    same = F.coalesce(F.col("file_hash") == F.col("known_hash"), F.lit(False))
    made = [read.filter(same).drop("path")]
    fresh = read.filter(~same)
    groups = fresh.groupBy("table_name", "header", "open_quotes").agg(F.collect_list("path").alias("paths")).collect()
    columns = {g.header: files.header_columns(spark, g.paths[0]) if g.header else [] for g in groups}
    for table in sorted({g.table_name for g in groups}):
        own = sorted((g.header, g.open_quotes, sorted(g.paths)) for g in groups if g.table_name == table)
        parts = [files.read_extract(spark, columns[h], q, p) for h, q, p in own if columns[h]]
        rows = files.drift_union(parts) if parts else spark.createDataFrame([], bronze_schema([])).drop(*LINEAGE[1:])
        named = spark.createDataFrame([(h, columns[h]) for h in {h for h, _, _ in own}], "header string, columns array<string>")
        of_table = fresh.filter(F.col("table_name") == table).drop("columns").join(named, "header")
        made.append(put(files.stamp(rows, table, batch_id), of_table, warehouse, table))
    names = ["file_name", "file_hash", "table_name", "row_count", "loaded_at", "columns", "length", "modified", "load"]
    entries = staged(reduce(lambda a, b: a.unionByName(b), [m.select(*names) for m in made]), "landing-entries")
    enter(entries, warehouse)
    result = Landing(report(listed, entries.join(fresh.select("file_name"), "file_name", "left_semi")), len(paths), size)
    for table in sorted({g.table_name for g in groups}):
        merge_loads(spark, warehouse, table)
    return result


def report(listed: DataFrame, landed: DataFrame | None) -> DataFrame:
    """(file_name, status, row_count) of the listed files."""
    skipped = F.when(F.col("status") == "known", "skipped").otherwise("ignored")
    none = F.lit(None).cast("bigint")
    if landed is None:
        return listed.select("file_name", skipped.alias("status"), none.alias("row_count"))
    now = landed.select("file_name", F.col("row_count").alias("_n"))
    status = F.when(F.col("_n").isNotNull(), "loaded").otherwise(skipped)
    return listed.drop("row_count").join(now, "file_name", "left").select("file_name", status.alias("status"), F.col("_n").alias("row_count"))


def merge_loads(spark: SparkSession, warehouse: str, table: str) -> None:
    """Merge loads of one order of size, as long as there are ``FAN`` of them.

    The merged rows are written and entered before the old loads are deleted; a run that dies in between
    leaves loads that are in no entry. The driver sees one row per load.
    """
    while True:
        current = registry(spark, warehouse).filter((F.col("table_name") == table) & (F.col("row_count") > 0))
        sizes = current.groupBy("load").agg(F.sum("row_count").alias("n")).collect()
        classes: dict[int, list[str]] = {}
        for r in sizes:
            classes.setdefault(int(math.log(r.n, FAN)), []).append(r.load)
        crowded = next((loads for _, loads in sorted(classes.items()) if len(loads) >= FAN), None)
        if crowded is None:
            return
        moved = staged(current.filter(F.col("load").isin(crowded)), "merge-entries")
        load = uuid.uuid4().hex
        landed_rows(spark, warehouse, table, crowded).hint("rebalance").write.parquet(load_path(warehouse, table, load))
        enter(moved.withColumn("load", F.lit(load)), warehouse)
        for old in crowded:
            files.remove(spark, load_path(warehouse, table, old), folder=True)


def table_counts(spark: SparkSession, warehouse: str) -> DataFrame:
    """Rows per source table, 0 for tables that never landed."""
    tables = spark.createDataFrame([(t,) for t in model.SOURCE_SYSTEMS], "table_name string")
    landed = registry(spark, warehouse).groupBy("table_name").agg(F.sum("row_count").alias("n"))
    return tables.join(landed, "table_name", "left").select("table_name", F.coalesce("n", F.lit(0)).alias("row_count"))
