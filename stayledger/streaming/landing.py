"""Incremental landing of a folder as a file stream.

The stream finds the files, each micro-batch lands its files as the batch run does: by content, with
drifted headers, quoted line breaks and registry entries. The file source remembers paths, so a
corrected file under an old name is only picked up by the batch run, which compares content.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources import bronze, files

LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """New CSV files of a folder as a stream of names and paths; contents are not read."""
    found = spark.readStream.format("binaryFile").schema(LISTING).option("pathGlobFilter", "*.csv").load(folder)
    return files.described(found)


def land_stream(spark: SparkSession, folder: str, warehouse: str) -> StreamingQuery:
    """Land all files that arrived since the last run, then stop.

    A micro-batch that is run again after a failure finds its files in the registry, or lands them
    again into the same partitions.
    """

    def land_batch(batch: DataFrame, batch_id: int) -> None:
        bronze.land_files(batch.sparkSession, files.name_parts(batch), warehouse, f"stream-{batch_id}")

    return (
        arrivals(spark, folder)
        .writeStream.foreachBatch(land_batch)
        .option("checkpointLocation", f"{warehouse}/meta/stream")
        .trigger(availableNow=True)
        .start()
    )
