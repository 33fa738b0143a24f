"""The permutation, the numbering and the shards."""

from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from stayledger.llm import sharding


def plain_permuted(x, n, seed):
    """The same network in plain integers."""
    a, b = sharding.grid(n)
    prime, multipliers, rounds = sharding.PRIME, sharding.MULTIPLIERS, sharding.ROUNDS

    def image(v, k):
        add = (seed * 40503 + k * 7919 + 12345) % prime
        start = (v + add) % prime
        square = (start * start + add) % prime
        return ((square ^ (square >> 15)) * multipliers[k] + start) % prime

    while True:
        left, right = divmod(x, b)
        for k in range(0, rounds, 2):
            left = (left + image(right, k)) % a
            right = (right + image(left, k + 1)) % b
        x = left * b + right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 7, 13, 97, 1009, 4099])
def test_permutation(spark, n):
    rows = spark.range(n).select("id", sharding.permuted(F.col("id"), n, 5).alias("p")).collect()
    assert sorted(r.p for r in rows) == list(range(n))
    assert all(r.p == plain_permuted(r.id, n, 5) for r in rows)


@pytest.mark.parametrize("n", [10**9 + 7, 10**12 + 39])
def test_large_numbers(spark, n):
    a, b = sharding.grid(n)
    assert n <= a * b <= n + a
    numbers = [0, 1, n // 2, n - 2, n - 1]
    rows = spark.createDataFrame([(x,) for x in numbers], "id long").select("id", sharding.permuted(F.col("id"), n, 3).alias("p")).collect()
    assert all(r.p == plain_permuted(r.id, n, 3) for r in rows)


def rows_of(n=300):
    rng = random.Random(4)
    rows = [(i, "t" * rng.randrange(9)) for i in range(n)]
    return rows + [(7, "same")] * 120 + [(None, "x"), (None, None), (None, None), (8, None), (8, "")]


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 16)  # many copies are laid out in steps
    rows = rows_of()
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, slot int, number int")
    for parts in (1, 5):
        found = sharding.assign(frame.repartition(parts), ["doc_id", "text"], 7).collect()
        n = len(rows)
        assert sorted(r.number for r in found) == list(range(n))
        assert all(r.place == plain_permuted(r.number, n, 1) for r in found)
        assert sorted(((r.doc_id, r.text) for r in found), key=repr) == sorted(rows, key=repr)
        for shard in range(7):
            slots = sorted(r.slot for r in found if r.shard == shard)
            assert slots == list(range(len(slots))) and len(slots) in (n // 7, n // 7 + 1)
        layout = sorted((r.doc_id, r.text, r.shard, r.slot) for r in found if r.doc_id is not None and r.text is not None)
        assert layout == test_shards.__dict__.setdefault("layout", layout)  # independent of partitions


def test_empty_table_and_more_shards_than_rows(spark):
    frame = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert [(r.shard, r.slot) for r in sharding.assign(frame, ["doc_id"], 40).collect()] == [(0, 0)]
    assert sharding.assign(frame.limit(0), ["doc_id"], 40).count() == 0
    with pytest.raises(ValueError):
        sharding.assign(frame, ["doc_id"], 0)


def test_query_columns(spark):
    from stayledger.llm import queries

    found = queries.op9_sharding(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(found) == len(texts)
    assert all(r["size"] == len(texts[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in found)
