"""Sharding by a Feistel permutation over global row numbers, in column expressions only.

Rows are numbered 0..n-1 in an order that depends on their keys alone. A Feistel network over a grid
of a x b >= n cells permutes the numbers; a number that lands at n or beyond walks on along its cycle
until it is back inside. The permuted place gives shard (place mod shards) and slot (place div
shards), both computable from the row number without looking at other rows, so shards differ by one
row at most.

The grid is chosen with as few cells beyond n as a short search finds. A walk visits only cells beyond
n, each at most once, so that number of steps always suffices: no walk is cut short.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .common import quoted

#: Rounds of the Feistel network, an even number.
ROUNDS = 6
#: Rows are numbered within this many parts, told apart by a hash of their keys.
PARTS = 4096
#: Divisors tried for a tight grid.
SEARCH = 4096
# A Mersenne prime and odd multipliers of the round function.
PRIME = (1 << 31) - 1
MULTIPLIERS = (1103515245, 22695477, 1664525, 134775813, 214013, 69069)
# end of fixed values
#: Copies of a row that one row of the plan stands for when they are laid out again.
COPIES = 1 << 16


def grid(n: int) -> tuple[int, int]:
    """(a, b) near the root of n with a * b >= n and few cells too many."""
    root = max(1, isqrt(max(n, 1) - 1) + 1)
    return min(((a, -(-n // a)) for a in range(root, max(0, root - SEARCH, root // 2), -1)), key=lambda g: (g[0] * g[1], -g[0]))


def mixed(x: Column, add: Column, factor: Column) -> Column:
    """The round function: 31-bit arithmetic that never overflows a long."""
    start = (x + add) % PRIME
    square = (start * start + add) % PRIME
    return (square.bitwiseXOR(F.shiftright(square, 15)) * factor + start) % PRIME


def div(x: Column, by: int) -> Column:
    """Whole division, exact for all longs."""
    return F.call_function("div", x, F.lit(by).cast("bigint"))


def round_keys(seed: int) -> Column:
    """Constants of the rounds, two rounds in each entry."""
    adds = [(seed * 40503 + k * 7919 + 12345) % PRIME for k in range(ROUNDS)]
    pairs = [(adds[k], MULTIPLIERS[k], adds[k + 1], MULTIPLIERS[k + 1]) for k in range(0, ROUNDS, 2)]
    return F.array(*[F.struct(*[F.lit(v).cast("bigint").alias(n) for n, v in zip("abcd", p)]) for p in pairs])


def feistel(x: Column, a: int, b: int, seed: int) -> Column:
    """One pass over the a x b grid: left and right digits are moved in turn by the other's image."""

    def two_rounds(at: Column, key: Column) -> Column:
        left = (at["left"] + mixed(at["right"], key["a"], key["b"])) % F.lit(a).cast("bigint")
        right = (at["right"] + mixed(left, key["c"], key["d"])) % F.lit(b).cast("bigint")
        return F.struct(left.alias("left"), right.alias("right"))

    begin = F.struct(div(x, b).alias("left"), (x % F.lit(b).cast("bigint")).alias("right"))
    return F.aggregate(round_keys(seed), begin, two_rounds, lambda at: at["left"] * F.lit(b).cast("bigint") + at["right"])


def permuted(x: Column, n: int, seed: int) -> Column:
    """The image of a number below n under a permutation of 0..n-1."""
    a, b = grid(n)
    once = feistel(x, a, b, seed)
    beyond = a * b - n
    if not beyond:
        return once
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(beyond)), once, lambda at, _: F.when(at < n, at).otherwise(feistel(at, a, b, seed)))
    return F.when(once < n, once).otherwise(walk)


def numbered(df: DataFrame, keys: Sequence[str], parts: int = PARTS) -> DataFrame:
    """One row per row of ``df``: ``keys`` and the row number ``number``. Equal rows are counted in
    each task before the shuffle and laid out again afterwards, so a row with very many copies does
    not gather them in one task. The sizes of ``parts`` parts are all that is broadcast."""
    own = [quoted(k) for k in keys]
    counted = df.groupBy(*own).agg(F.count("*").alias("__n"))
    counted = counted.withColumn("__part", F.pmod(F.xxhash64(*own), F.lit(parts)).cast("int"))
    sizes = counted.groupBy("__part").agg(F.sum("__n").alias("__size"))
    before = F.sum("__size").over(_running("__part")) - F.col("__size")
    offsets = sizes.select("__part", before.alias("__before"))  # at most `parts` rows
    inner = F.sum("__n").over(_running(*keys, by="__part")) - F.col("__n")
    placed = counted.withColumn("__inner", inner).join(F.broadcast(offsets), "__part")
    blocks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__n") - 1, F.lit(COPIES).cast("bigint")))
    first = F.col("__before") + F.col("__inner")
    laid = placed.select(*own, first.alias("__first"), "__n", blocks.alias("__block"))
    copies = F.explode(F.sequence("__block", F.least(F.col("__block") + COPIES, F.col("__n")) - 1))
    return laid.select(*own, "__first", copies.alias("__copy")).select(*own, (F.col("__first") + F.col("__copy")).alias("number"))


def _running(*order: str, by: str | None = None) -> WindowSpec:
    base = Window.partitionBy(by) if by else Window.partitionBy()
    return base.orderBy(*[quoted(c) for c in order]).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def assign(df: DataFrame, keys: Sequence[str], shards: int, seed: int = 1) -> DataFrame:
    """One row per row of ``df``: ``keys``, ``number``, ``place``, ``shard`` and ``slot``.

    The result depends on the rows' keys, the number of rows and the seed, not on files or partitions.
    Null keys are values like others; rows equal in all keys are interchangeable and get one number
    each; an empty table gives an empty table. Columns outside ``keys`` are not read.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    n = df.count()
    place = permuted(F.col("number"), max(n, 1), seed)
    spread = numbered(df, keys).withColumn("place", place)
    return spread.withColumns({"shard": (F.col("place") % shards).cast("int"), "slot": div(F.col("place"), shards)})
