"""Helpers shared by the training-data operators: tables, staging, and text in Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import staged_root

#: Texts are cut into words in slices of about this many bytes, so that the word list of a very
#: long text is never held as a whole.
SLICE_BYTES = 1 << 20
#: A step gets an Arrow batch in parts of about this many bytes.
PORTION_BYTES = 2 << 20

# Which ASCII bytes stand for a word byte, and what A-Z become.
_WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz"
#: A-Z to a-z, other ASCII bytes outside [0-9a-z] to a blank; bytes from 0x80 on stay.
WORD_TABLE = bytes(
    c if c >= 0x80 else (c + 32 if 0x41 <= c <= 0x5A else (c if c in _WORD_BYTES else 0x20)) for c in range(256)
)
# end of fixed values


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under column names that no operator adds, and the new name of each column. What an
    operator adds beside them leaves the documents' own columns alone; see :func:`together`."""
    names = {c: f"__own{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def together(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, of rows that were set :func:`apart`."""
    return kept.select(*[f"__own{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: what follows starts from files that every
    executor can reach, so a lost executor costs no earlier step. See ``session.clear_staged``."""
    path = staged_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_path(spark: SparkSession, name: str) -> str:
    """A new folder under the application's own."""
    return f"{staged_root(spark)}/{name}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once in a session: functions that run there import it,
    and a cluster's nodes need not have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_stayledger_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="stayledger-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    sc.addPyFile(str(archive))  # Spark hands the file to the executors
    sc._stayledger_shipped = True


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def portions(batch: pa.RecordBatch, size: int = PORTION_BYTES) -> Iterator[pa.RecordBatch]:
    """All rows of a batch, in parts of about ``size`` bytes: Spark's batches are cut by rows, and what a
    step makes of the texts of a whole one stands beside it several times over."""
    rows = max(1, batch.num_rows * size // max(1, batch.nbytes))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def append(
    df: DataFrame,
    inputs: Sequence[Column],
    added: T.StructType,
    make: Callable[[], Callable[..., Sequence[pa.Array]]],
) -> DataFrame:
    """Add the columns ``added``, computed from ``inputs`` by Arrow batch; all columns of ``df`` are
    passed through untouched. A column of ``df`` with the name of an added one is replaced.

    ``make()`` runs once in each task and returns a function from the input arrays to the added ones.
    """
    taken = {f.name.lower() for f in added.fields}
    kept = [c for c in df.columns if c.lower() not in taken]
    schema = T.StructType([df.schema[c] for c in kept] + added.fields)
    n, arrow = len(kept), to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for part in portions(batch):
                out = step(*part.columns[n:])
                yield pa.RecordBatch.from_arrays([*part.columns[:n], *out], names=arrow.names)

    ready = df.select(*[quoted(c) for c in kept], *[c.alias(f"__in{i}") for i, c in enumerate(inputs)])
    return map_batches(ready, run, schema)


def text_bytes(column: Column) -> Column:
    """The UTF-8 bytes of a text; a null text counts as an empty one."""
    return F.coalesce(column, F.lit("")).cast("binary")


def slices(data: bytes, size: int = SLICE_BYTES) -> Iterator[bytes]:
    """``data`` in parts of about ``size`` bytes, cut only at blanks. A word longer than ``size``
    stays whole."""
    start = 0
    while len(data) - start > size:
        end = data.find(b" ", start + size)
        if end < 0:
            break
        yield data[start:end]
        start = end
    yield data[start:] if start else data


def fold(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus
