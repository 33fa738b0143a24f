"""SimHash near-duplicates, linked with a pigeonring filter.

A fingerprint has one bit for each bit position that is set in over half of the XXH64 values of a
text's word shingles. Two fingerprints link at ``max_bits`` or fewer differing bits; components of
links are the groups of near-duplicates.

Linking. The 64 bits are cut into ``segments`` on a ring. If two fingerprints differ in d <= max_bits
bits, then by the pigeonring principle there is a segment from which every chain of l consecutive
segments has at most l * max_bits / segments differences. As long as that budget is below one, the
chain's segments must be equal: they are the join key. The longer chains are compared in the join
condition, before the full Hamming distance, and a pair is taken only at the first segment that
qualifies, so it is made once. Equal fingerprints are one row before the join. Keys shared by many
fingerprints are split again by the same principle over the bits outside the key.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import apart, append, quoted, slices, stage, text_bytes, together
from .components import components

SEED = 42
#: Segments of the ring; with 2 bits, chains of two segments (25 or 26 bits) must be equal.
SEGMENTS = 5
#: Fingerprints with the same key beyond which the key is split again.
HOT_KEY = 256
# Fixed value: ASCII white space to a blank, as words end at it; A-Z to a-z.
_BLANKS = bytes(0x20 if c in b"\t\n\x0b\x0c\r" else (c + 32 if 0x41 <= c <= 0x5A else c) for c in range(256))


def fingerprint_of(text: bytes, shingle: int) -> int:
    """The fingerprint of one text. Fewer words than ``shingle``: the whole sequence is one shingle;
    no words: zero."""
    ones, total, carry = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for part in slices(text.translate(_BLANKS)):
        words = carry + part.split()
        if len(words) < shingle:
            carry = words
            continue
        grams = zip(*[words[i:] for i in range(shingle)]) if shingle > 1 else ((w,) for w in words)
        hashes = np.fromiter([digest(b" ".join(g), SEED) for g in grams], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
        carry = words[len(words) - shingle + 1 :] if shingle > 1 else []
    if not total:
        return digest(b" ".join(carry), SEED) if carry else 0
    return int(np.packbits(ones * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with the 64-bit fingerprint of each text as the long ``fp``. Null, empty and blank
    texts have fingerprint 0."""

    def make():
        def step(texts):
            values = np.fromiter((fingerprint_of(t, shingle) for t in texts.to_pylist()), np.uint64, len(texts))
            return [pa.array(values.view(np.int64))]

        return step

    return append(docs, [text_bytes(quoted(text))], T.StructType([T.StructField("fp", T.LongType())]), make)


def _ring(segments: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    edges = [64 * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _mask(parts: list[tuple[int, int]]) -> int:
    """The segments' bits, as a signed 64-bit number."""
    bits = sum(((1 << width) - 1) << low for low, width in parts)
    return bits - (1 << 64) if bits >= 1 << 63 else bits


def _chain(segments: int, start: int, length: int) -> int:
    ring = _ring(segments)
    return _mask([ring[(start + k) % segments] for k in range(length)])


def _exact_length(segments: int, max_bits: int) -> int:
    """The longest chain whose budget is below one difference."""
    return max(length for length in range(1, segments + 1) if length * max_bits // segments == 0)


def _holds(diff: Column, start: int, segments: int, max_bits: int) -> Column:
    """Whether every chain from ``start`` keeps its budget in ``diff``."""
    held = F.lit(True)
    for length in range(_exact_length(segments, max_bits), segments + 1):
        within = F.bit_count(diff.bitwiseAND(F.lit(_chain(segments, start, length)))) <= length * max_bits // segments
        held = held & within
    return held


def links(distinct_fp: DataFrame, max_bits: int = 2, segments: int = SEGMENTS, hot: int = HOT_KEY) -> DataFrame:
    """All pairs a < b of distinct fingerprints (column ``fp``) that differ in at most ``max_bits``
    bits, each once, as columns a, b."""
    if segments <= max_bits:
        raise ValueError("the ring needs more segments than differing bits")
    length = _exact_length(segments, max_bits)
    starts = F.explode(
        F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(_chain(segments, i, length))).alias("key")) for i in range(segments)])
    )
    keyed = distinct_fp.select("fp", starts.alias("s")).select("fp", "s.i", "s.key")
    crowded = keyed.groupBy("i", "key").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("i", "key", F.lit(True).alias("hot"))
    keyed = keyed.join(crowded, ["i", "key"], "left")
    # within a crowded key the differences lie in the other bits: the same filter over a ring of those
    inner = _ring_outside(segments, length, max_bits)
    second = F.when(F.col("hot"), inner(F.col("fp"), F.col("i"))).otherwise(
        F.array(F.struct(F.lit(-1).alias("j"), F.lit(0).cast("bigint").alias("rest")))
    )
    keyed = keyed.select("fp", "i", "key", F.explode(second).alias("r")).select("fp", "i", "key", "r.j", "r.rest")
    left, right = keyed.withColumnRenamed("fp", "a"), keyed.withColumnRenamed("fp", "b")
    diff = F.col("a").bitwiseXOR(F.col("b"))
    first = F.when(_holds(diff, 0, segments, max_bits), 0)
    for i in range(1, segments):
        first = first.when(_holds(diff, i, segments, max_bits), i)
    lowest = F.when(F.col("j") < 0, -1)
    for j, masks in enumerate(_inner_masks(segments, length, max_bits)):
        apart = F.lit(False)
        for i, mask in enumerate(masks):
            apart = apart | ((F.col("i") == i) & (diff.bitwiseAND(F.lit(mask)) == 0))
        lowest = lowest.when(apart, j)
    near = F.bit_count(diff) <= max_bits
    return (
        left.join(right, ["i", "key", "j", "rest"])
        .where((F.col("a") < F.col("b")) & near & (first == F.col("i")) & (lowest == F.col("j")))
        .select("a", "b")
    )


def _inner_masks(segments: int, length: int, max_bits: int) -> list[list[int]]:
    """[j][i]: the bits of the j-th chain of a ring laid over the bits outside chain i."""
    ring, parts = _ring(segments), 2 * max_bits + 1
    out = []
    for j in range(parts):
        row = []
        for i in range(segments):
            free = [low + k for s in range(length, segments) for low, width in [ring[(i + s) % segments]] for k in range(width)]
            edges = [len(free) * x // parts for x in range(parts + 1)]
            bits = [b for x in (j, (j + 1) % parts) for b in free[edges[x] : edges[x + 1]]]
            row.append(_mask([(b, 1) for b in bits]))
        out.append(row)
    return out


def _ring_outside(segments: int, length: int, max_bits: int):
    """With 2 * max_bits + 1 segments, two neighbours are free of differences: they are the key."""
    masks = _inner_masks(segments, length, max_bits)

    def expand(fp: Column, i: Column) -> Column:
        rows = []
        for j, by_start in enumerate(masks):
            rest = F.when(i == 0, fp.bitwiseAND(F.lit(by_start[0])))
            for k in range(1, segments):
                rest = rest.when(i == k, fp.bitwiseAND(F.lit(by_start[k])))
            rows.append(F.struct(F.lit(j).alias("j"), rest.alias("rest")))
        return F.array(*rows)

    return expand


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
    segments: int = SEGMENTS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``fingerprint`` (16 hex digits), ``component_id`` (the
    smallest ``key`` reachable over links), ``group_fp`` (one fingerprint that stands for the
    component, as a long) and the columns in ``carry``. Other columns are not read.

    Null and empty texts have fingerprint 0 and link like any other. Repeated rows get the same
    values. A null key is never the smallest; a component of null keys only has a null id, but a
    ``group_fp`` of its own. An empty table gives an empty table.
    """
    named = docs.select(quoted(key).alias("k"), quoted(text).alias("t"), *[quoted(c).alias(f"c{i}") for i, c in enumerate(carry)])
    marked = stage(fingerprints(named, "t", shingle).drop("t"), "simhash-docs")
    least = stage(marked.groupBy("fp").agg(F.min("k").alias("least")), "simhash-least")
    pairs = stage(links(least.select("fp"), max_bits, segments), "simhash-links")
    linked = least.join(components(pairs), F.col("fp") == F.col("node"), "left")
    roots = stage(linked.select("fp", "least", F.coalesce("root", "fp").alias("group_fp")), "simhash-roots")
    ids = stage(roots.groupBy("group_fp").agg(F.min("least").alias("component_id")), "simhash-ids")
    groups = stage(roots.join(ids, "group_fp").select("fp", "group_fp", "component_id"), "simhash-groups")
    return marked.join(groups, "fp").select(
        F.col("k").alias(key),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "group_fp",
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)],
    )


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of each group of near-duplicates, with all columns: the one with the least key (a null
    key comes last); rows that share that key are told apart by a digest of the whole row, and equal
    rows count once."""
    own, name = apart(docs)
    told = [F.array_sort(F.map_entries(c)) if isinstance(own.schema[c].dataType, T.MapType) else F.col(c) for c in own.columns]
    marked = own.withColumn("digest", F.xxhash64(*told))
    grouped = near_duplicates(marked, name[key], name[text], shingle, max_bits, carry=["digest"])
    first = F.min(F.struct(F.col(name[key]).isNull().alias("n"), F.col(name[key]).alias("k"), F.col("digest").alias("d")))
    chosen = stage(grouped.groupBy("group_fp").agg(first.alias("lead")).select("lead.k", "lead.d"), "simhash-leads")
    # equal rows are merged within each task before the shuffle, so many copies of one row don't meet
    single = marked.dropDuplicates([name[key], "digest"])
    kept = single.join(chosen, F.col(name[key]).eqNullSafe(F.col("k")) & (F.col("digest") == F.col("d")), "left_semi")
    return together(kept, docs)
