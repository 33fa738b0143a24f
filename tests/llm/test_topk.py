"""Exact search against plain scoring of all pairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayledger.llm import topk


def plain(rows, k, every, scale=256):
    usable = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.append((i, tuple(math.floor(scale * float(np.float32(x))) for x in v)))
    usable = sorted(set(usable))
    out, asked = [], {}
    for i, v in usable:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    for q, v in asked.items():
        scores = {(-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q and len(w) == len(v)}
        out += [(q, place + 1, i, -s) for place, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def found(frame, **options):
    every = options.pop("every")
    result = topk.top_k(frame, F.col("vec_id") % every == 0, **options)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in result.collect())


def vectors(seed, n=120, size=6):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.25, 0.3, 1.0]) for _ in range(size)]) for i in range(n)]
    rows += [(200 + i, [0.5] * size) for i in range(60)]  # one vector under many ids
    rows += [(20, rows[20][1])] * 9  # repeated rows
    rows += [(300, None), (301, [1.0, None] + [0.0] * (size - 2)), (302, [float("nan")] * size), (303, [float("inf")] * size), (None, [1.0] * size)]
    rows += [(310, [1.0, 2.0]), (311, [3.0, 1.0]), (320, [])]  # other lengths
    return rows


@pytest.mark.parametrize("seed,block,segments", [(1, 16384, 4), (2, 5, 4), (3, 16384, 1)])
def test_all_pairs(spark, monkeypatch, seed, block, segments):
    rows = vectors(seed)
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, score int, rank string").repartition(4)
    assert found(frame, every=10, k=5, block=block, segments=segments) == plain(rows, 5, 10)


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert found(frame, every=1, k=5) == plain(rows, 5, 1)
    assert found(frame.limit(1), every=1, k=5) == []
    assert found(frame.limit(0), every=1, k=5) == []


def test_numbers_beyond_exact_doubles():
    a = topk.whole([[3e9, 1.0]], 256)
    b = topk.whole([[2e9, -1.0]], 256)
    assert topk.partial_scores(a, b, 2).sum(axis=0)[0, 0] == 256 * 256 * (6 * 10**18 - 1)
