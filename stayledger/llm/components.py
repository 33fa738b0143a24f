"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _nearest(edges: DataFrame, name: str) -> DataFrame:
    """(u, m): the least of u and its neighbours; counted per task before the shuffle, and staged, so
    that the join that follows can be split where a node has very many neighbours."""
    return stage(edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), name)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = _nearest(both, "star-large")
    moved = both.join(near, "u").where(F.col("v") > F.col("u"))
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _nearest(down, "star-small")
    moved = down.join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = near.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).where("u != v").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) for every node of ``pairs`` (a, b); root is the component's least node. The steps
    end when a whole round changes no edge; each round is staged, so lineage stays short. Edges and
    nodes stay distributed; the driver sees two numbers a round."""
    edges = stage(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "star-edges")
    state = None
    while True:
        edges = stage(_small_star(stage(_large_star(edges), "star-l")), "star-s")
        mark = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(mark) == state:
            break
        state = tuple(mark)
    member = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return member.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
