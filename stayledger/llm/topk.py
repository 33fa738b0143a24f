"""Exact top-k search by inner product with a three-phase uniform threshold.

A score is the sum of partial scores over segments of the vectors. For each block of queries:

1. Every task lists, per query and segment, its candidates with the highest partial scores, and sends
   the best totals of those. The k-th best total overall is a safe cutoff: k candidates reach it.
2. The cutoffs are broadcast. A candidate whose total reaches the cutoff has some segment whose partial
   score reaches the cutoff divided by the number of segments, as the largest part is no less than the
   mean; only such entries are collected.
3. The scores of those are resolved exactly, and each task sends its k best that reach the cutoff.

Queries are taken in blocks of bounded size, each against all candidates; candidates are never
shuffled. Scores are whole numbers, so they don't depend on the order of summation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, quoted, staged_path

#: Queries that are broadcast at once, and compared with a batch of candidates at once.
BLOCK, TILE = 16384, 512
#: Candidates compared at once.
CHUNK = 2048
SEGMENTS = 4
SCHEMA = "query_id bigint, vec_id bigint, score bigint"


def whole(vectors: list[list[float]], scale: int) -> np.ndarray:
    """floor(scale * x) as a matrix of doubles, or of Python integers where doubles could be inexact."""
    scaled = np.floor(np.array(vectors, np.float64).reshape(len(vectors), -1) * scale)
    largest = np.abs(scaled).max(initial=0)
    if largest * largest * max(1, scaled.shape[1]) < 2.0**53:
        return scaled
    return np.array([[int(x) for x in row] for row in scaled], object).reshape(scaled.shape)


def partial_scores(queries: np.ndarray, candidates: np.ndarray, segments: int) -> np.ndarray:
    """(segment, query, candidate)."""
    edges = [queries.shape[1] * s // segments for s in range(segments + 1)]
    if queries.dtype != candidates.dtype or queries.dtype == object or np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0) * max(1, queries.shape[1]) >= 2.0**53:
        queries, candidates = queries.astype(object), candidates.astype(object)
        queries, candidates = (np.vectorize(int, otypes=[object])(x) if x.size else x for x in (queries, candidates))
    return np.stack([queries[:, a:b] @ candidates[:, a:b].T for a, b in zip(edges, edges[1:])])


class Best:
    """The k best (score, id) of each query, ties to the smaller id; equal entries count once."""

    def __init__(self, queries: np.ndarray, k: int) -> None:
        self.queries, self.k = queries, k
        self.query, self.vec = np.empty(0, np.int64), np.empty(0, np.int64)
        self.score: np.ndarray = np.empty(0, np.int64)

    def add(self, query: np.ndarray, vec: np.ndarray, score: np.ndarray) -> None:
        query, vec, score = (np.concatenate(x) for x in ((self.query, query), (self.vec, vec), (self.score, score)))
        order = np.lexsort((vec, -score, query))
        query, vec, score = query[order], vec[order], score[order]
        new = np.ones(len(query), bool)
        new[1:] = (query[1:] != query[:-1]) | (vec[1:] != vec[:-1]) | (score[1:] != score[:-1])
        query, vec, score = query[new], vec[new], score[new]
        starts = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else np.empty(0, np.int64)
        rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(query)]])))
        self.query, self.vec, self.score = query[rank < self.k], vec[rank < self.k], score[rank < self.k]

    def batch(self) -> pa.RecordBatch:
        columns = (self.queries[self.query], self.vec, self.score)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["query_id", "vec_id", "score"])


def local_lists(block: Broadcast, k: int, scale: int, segments: int, cutoffs: Broadcast | None):
    """The task function of the first phase or, with cutoffs, of the second and third."""

    def listed(parts: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Phase 1: those among the k highest of some segment."""
        chosen = np.zeros(other.shape, bool)
        for part in parts:
            masked = np.where(other, part, part.min(initial=0) - 1)
            top = np.argpartition(-masked, k - 1, axis=1)[:, :k] if masked.shape[1] > k else np.arange(masked.shape[1])[None, :].repeat(len(masked), 0)
            np.put_along_axis(chosen, top, True, axis=1)
        return chosen & other

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, by_size = block.value
        least = None if cutoffs is None else cutoffs.value
        best = Best(ids, k)
        for batch in batches:
            rows = dict.fromkeys((i, tuple(v)) for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for size, (numbers, queries) in by_size.items():
                own = [r for r in rows if len(r[1]) == size]
                for at in range(0, len(own), CHUNK):
                    vec = np.array([i for i, _ in own[at : at + CHUNK]], np.int64)
                    candidates = whole([v for _, v in own[at : at + CHUNK]], scale)
                    for q in range(0, len(numbers), TILE):
                        number = numbers[q : q + TILE]
                        parts = partial_scores(queries[q : q + TILE], candidates, segments)
                        other = ids[number][:, None] != vec[None, :]
                        if least is None:
                            chosen = listed(parts, other)
                        else:
                            chosen = ((parts * segments >= least[number][None, :, None]).any(axis=0)) & other
                        r, c = np.nonzero(chosen)
                        score = parts[:, r, c].sum(axis=0).astype(np.int64)
                        if least is not None:
                            keep = score >= least[number[r]]
                            r, c, score = r[keep], c[keep], score[keep]
                        best.add(number[r], vec[c], score)
        yield best.batch()

    return run


def top_k(
    vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256, segments: int = SEGMENTS, block: int = BLOCK
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the ``k`` best candidates of every row for which
    ``is_query`` holds, among all rows with another key.

    Vectors that are null or hold null or non-finite components, and rows without a key, take no part.
    Vectors are compared with those of equal length only. Equal rows count once; of several vectors
    under one key each is a candidate, and the least in array order is the query. Queries with fewer
    than ``k`` candidates return all. Scores beyond 64 bits raise an error.
    """
    spark = vectors.sparkSession
    typed = vectors.select(quoted(key).cast("bigint").alias("key"), quoted(vector).cast("array<double>").alias("v"), is_query.alias("asks"))
    usable = typed.where(F.col("key").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    candidates = usable.select("key", "v")
    asked = usable.where("asks").groupBy("key").agg(F.min("v").alias("v"))
    blocks = max(1, -(-asked.count() // block))
    path = staged_path(spark, "topk")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b).collect()  # about `block` rows
        if not rows:
            continue
        ids = np.array([r.key for r in rows], np.int64)
        sizes = np.array([len(r.v) for r in rows])
        by_size = {int(s): (np.flatnonzero(sizes == s), whole([rows[i].v for i in np.flatnonzero(sizes == s)], scale)) for s in np.unique(sizes)}
        sent = spark.sparkContext.broadcast((ids, by_size))
        lists = map_batches(candidates, local_lists(sent, k, scale, segments, None), SCHEMA).distinct()
        kth = ranked(lists, k).where(F.col("rank") == k).select("query_id", "score").collect()
        cutoff = {r.query_id: r.score for r in kth}
        least = spark.sparkContext.broadcast(np.array([cutoff.get(int(i), np.iinfo(np.int64).min // 8) for i in ids], np.int64))
        map_batches(candidates, local_lists(sent, k, scale, segments, least), SCHEMA).write.mode("append").parquet(path)
    return ranked(spark.read.schema(SCHEMA).parquet(path).distinct(), k)


def ranked(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
