"""Helpers: slices of long texts, added columns, staged tables."""

from __future__ import annotations

import zlib

import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayledger.llm import common
from stayledger.session import clear_staged, staged_root


@given(st.lists(st.sampled_from([b"a", b"bb", b" ", b"  ", b"\xc3\xa9"]), max_size=60), st.integers(1, 20))
def test_slices_cut_at_blanks_only(parts, size):
    data = b"".join(parts)
    found = list(common.slices(data, size))
    assert b"".join(found) == data
    assert [w for part in found for w in part.split()] == data.split()


def test_append_replaces_clashing_columns(spark):
    frame = spark.createDataFrame([(1, "x", None), (2, None, 3.0)], "`a b` int, Text string, size double")

    def make():
        return lambda texts: [pa.array([len(t) for t in texts.to_pylist()], pa.int64())]

    out = common.append(frame, [common.text_bytes(common.quoted("Text"))], T.StructType([T.StructField("SIZE", T.LongType())]), make)
    assert out.columns == ["a b", "Text", "SIZE"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x", 1), (2, None, 0)]
    assert common.append(frame.limit(0), [common.text_bytes(common.quoted("Text"))], T.StructType([T.StructField("n", T.LongType())]), make).count() == 0


def test_fold_takes_keys_as_text(spark):
    rows = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "k long").select("k", common.fold(F.col("k"), 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(("" if r.k is None else str(r.k)).encode()) % 5 for r in rows)


def test_staged_tables_can_be_cleared(spark):
    table = common.stage(spark.range(3).toDF("id"), "test")
    assert table.count() == 3
    assert common.staged_path(spark, "x").startswith(staged_root(spark))
    clear_staged(spark)
    folder = spark._jvm.org.apache.hadoop.fs.Path(staged_root(spark))
    assert not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
