"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str, cpus: str = "*", **conf: str) -> SparkSession:
    """A session for tests and local benches; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder stands in only for local masters, where driver and
    executors are the same machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    scratch = tempfile.mkdtemp(prefix="stayledger-")
    spark.conf.set("spark.checkpoint.dir", scratch)
    return scratch


def staged_root(spark: SparkSession) -> str:
    """The parent of everything this application stages."""
    return f"{shared_dir(spark)}/stayledger/{spark.sparkContext.applicationId}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Several plans can then start from the same rows without deriving them again, rows and their order
    within files are fixed, and a lost executor costs no earlier step.
    """
    path = f"{staged_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> None:
    """Delete what this application has staged. Call it when the results have been written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(staged_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
