"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

Test strings are windows of consecutive words of the benchmark's items. A shift table over blocks of
two words says how far the search may jump from a position; only where the shift is zero, the bucket
of windows that end in this block is compared directly. Windows shorter than the usual length (of
short items) have tables of their own, one per length, so they don't shorten the others' jumps.

Items are cut by tasks into overlapping pieces, dealt to blocks of bounded size and written by block.
Only one block at a time is read by the driver and broadcast, as text; the tables are built in the Python
workers, which hold one block's tables each. A benchmark of one block is searched in a single pass without
any shuffle. For a larger one the documents are written once, with what the first block finds; each further
block reads their texts, writes what it finds in the documents that it hits, and frees its broadcast before
the next block is read. Texts are never shuffled by the search, only what was found.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD_TABLE, apart, append, map_batches, quoted, slices, stage, staged_path, text_bytes, together

#: Words in a test string.
WINDOW = 10
#: Bytes of item texts in a block: what is broadcast at once. Its tables take some hundred times as much
#: in a worker if no word repeats.
BLOCK_BYTES = 4 << 20
#: Windows that start in a piece of an item; a block is a number of whole pieces.
PIECE = 4096

PIECES = T.StructType([T.StructField("id", T.StringType()), T.StructField("piece", T.BinaryType(), False)])
STATE = T.StructType(
    [
        T.StructField("n_words", T.LongType(), False),
        T.StructField("spans", T.ArrayType(T.LongType(), False), False),
        T.StructField("items", T.ArrayType(T.StringType(), False), False),
    ]
)


class Tables:
    """Shift table and suffix buckets for windows of one length."""

    def __init__(self, length: int) -> None:
        self.length = length
        self.block = min(2, length)
        self.jump = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list[str]]] = {}

    def add(self, window: tuple[bytes, ...], item: str | None) -> None:
        for end in range(self.block, self.length + 1):
            part, left = window[end - self.block : end], self.length - end
            self.shift[part] = min(left, self.shift.get(part, self.jump))
        ids = self.buckets.setdefault(window[-self.block :], {}).setdefault(window, [])
        if item is not None and item not in ids:
            ids.append(item)

    def search(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """(start, items) of every occurrence of a window."""
        shift, jump, block, length, n = self.shift.get, self.jump, self.block, self.length, len(words)
        at = length
        while at <= n:
            ends = (words[at - 2], words[at - 1]) if block == 2 else (words[at - 1],)
            step = shift(ends, jump)
            if step:
                at += step
                continue
            ids = self.buckets[ends].get(tuple(words[at - length : at]))
            if ids is not None:
                yield at - length, ids
            at += 1


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_TABLE).split()


def build_tables(items: list[tuple[str | None, bytes]], window: int) -> list[Tables]:
    by_length: dict[int, Tables] = {}
    for item, text in items:
        words = words_of(text)
        length = min(window, len(words))
        if length:
            tables = by_length.setdefault(length, Tables(length))
            for i in range(len(words) - length + 1):
                tables.add(tuple(words[i : i + length]), item)
    return list(by_length.values())


def search_text(text: bytes, searchers: list[Tables]) -> tuple[int, list[int], set[str]]:
    """Number of words, the hit words as merged [start, end) spans in a flat list, and the items."""
    carried = max((s.length for s in searchers), default=1) - 1
    found: list[tuple[int, int]] = []
    items: set[str] = set()
    carry: list[bytes] = []
    n = 0  # words before the carried ones
    for part in slices(text.translate(WORD_TABLE)):
        words = carry + part.split()
        for s in searchers:
            for start, ids in s.search(words):
                found.append((n + start, n + start + s.length))
                items.update(ids)
        carry = words[max(0, len(words) - carried) :]
        n += len(words) - len(carry)
    return n + len(carry), merged(found), items


def merged(spans: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += (start, end)
    return out


def cut(text: bytes, window: int, size: int) -> Iterator[bytes]:
    """An item's words in pieces that overlap, so that each window lies in exactly one: the one in which
    it starts. An item with fewer words than a window is one piece; one without words is none."""
    carry: list[bytes] = []
    whole = True
    for part in slices(text.translate(WORD_TABLE)):
        carry += part.split()
        while len(carry) >= size + window - 1:
            yield b" ".join(carry[: size + window - 1])
            carry, whole = carry[size:], False
    if len(carry) >= window or (whole and carry):
        yield b" ".join(carry)


def pieces_of(benchmark: DataFrame, key: str, text: str, window: int, size: int) -> DataFrame:
    """Distinct (id, piece) of all items, staged."""
    items = benchmark.where(quoted(text).isNotNull()).select(quoted(key).cast("string"), text_bytes(quoted(text)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, data in enumerate(batch.column(1)):
                found = list(cut(data.as_py(), window, size))
                ids = pa.array([batch.column(0)[k].as_py()] * len(found), pa.string())
                yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.binary())], names=PIECES.names)

    return stage(map_batches(items, run, PIECES).distinct(), "benchmark-pieces")


def blocks_of(pieces: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The pieces in blocks of about ``block_bytes`` bytes (or one piece), each in a folder of its own.
    Pieces are dealt by hash; they are distinct and short, so that blocks are near equal."""
    size, count = pieces.agg(F.sum(F.length("piece")), F.count("*")).first()
    n = min(count, -(-(size or 0) // block_bytes))
    if n <= 1:
        return [pieces]
    path = staged_path(pieces.sparkSession, "benchmark-blocks")
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("id", "piece"), F.lit(n)).cast("int"))
    dealt.repartition("block").write.partitionBy("block").parquet(path)
    stored = pieces.sparkSession.read.schema(dealt.schema).parquet(path)
    filled = sorted(r.block for r in stored.select("block").distinct().collect())
    return [stored.where(F.col("block") == k) for k in filled]


#: The tables that a Python worker holds: those of the last block that it searched for.
HELD: dict[str, list[Tables]] = {}


def held(name: str, block: Broadcast, window: int) -> list[Tables]:
    if name not in HELD:
        HELD.clear()
        HELD[name] = build_tables(block.value, window)
    return HELD[name]


def searched(block: Broadcast, window: int) -> Callable[[], Callable[[pa.Array], list[pa.Array]]]:
    """What :func:`append` runs to search texts for the windows of one block."""
    name = uuid.uuid4().hex

    def make():
        searchers = held(name, block, window)

        def step(texts):
            found = [search_text(data, searchers) for data in texts.to_pylist()]
            return [
                pa.array([n for n, _, _ in found], pa.int64()),
                pa.array([spans for _, spans, _ in found], pa.list_(pa.int64())),
                pa.array([sorted(items) for _, _, items in found], pa.list_(pa.string())),
            ]

        return step

    return make


def sent(block: DataFrame) -> Broadcast:
    rows = block.select("id", "piece").collect()  # one block
    return block.sparkSession.sparkContext.broadcast([(r.id, bytes(r.piece)) for r in rows])


def search_blocks(docs: DataFrame, text: str, blocks: list[DataFrame], window: int) -> DataFrame:
    """``docs`` with STATE, block after block. What blocks find meets by row number, and a document has
    at most one row of each block there."""
    row = "__row"
    while row in docs.columns:
        row += "_"
    first = sent(blocks[0])
    numbered = append(docs, [text_bytes(quoted(text))], STATE, searched(first, window)).withColumn(row, F.monotonically_increasing_id())
    out = stage(numbered, "decontamination-documents")
    first.destroy()
    path = staged_path(docs.sparkSession, "decontamination-blocks")
    texts = out.select(F.col(row).alias("row"), text_bytes(quoted(text)).alias("text"))
    for k, block in enumerate(blocks[1:], 1):
        tables = sent(block)
        hits = append(texts, [F.col("text")], STATE, searched(tables, window)).where(F.size("spans") > 0)
        hits.select("row", "spans", "items").write.parquet(f"{path}/block={k}")
        tables.destroy()
    later = docs.sparkSession.read.schema("row long, spans array<bigint>, items array<string>, block int").parquet(path)
    own = out.where(F.size("spans") > 0).select(F.col(row).alias("row"), "spans", "items")
    by_row = later.drop("block").union(own).groupBy("row").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("__items"),
    )

    def make():
        return lambda spans: [pa.array([merged(zip(flat[::2], flat[1::2])) for flat in spans.to_pylist()], pa.list_(pa.int64()))]

    spans = T.StructType([T.StructField("__spans", STATE["spans"].dataType, False)])
    by_row = append(by_row.withColumnRenamed("row", "__at"), [F.col("spans")], spans, make).drop("spans")
    none = F.array()
    joined = out.drop("spans", "items").join(by_row, F.col(row) == F.col("__at"), "left")
    return joined.select(
        *[quoted(c) for c in out.columns if c not in (row, "spans", "items")],
        F.coalesce("__spans", none.cast("array<bigint>")).alias("spans"),
        F.coalesce("__items", none.cast("array<string>")).alias("items"),
    )


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (hit words as merged [start, end) in a flat array),
    ``items`` (ids of occurring items, distinct and sorted as strings), ``n_hit``, ``n_items`` and
    ``contaminated``; columns with these names are replaced.

    A null or empty text has no words; a very long one is searched whole. Null or wordless items have no
    windows; an item with a null id hits words without being named. Repeated items count once, repeated
    documents get the same values. With no items nothing is hit; an empty table gives an empty table.
    """
    docs = docs.drop("n_words", "spans", "items")
    blocks = blocks_of(pieces_of(benchmark, item_key, item_text, window, PIECE), block_bytes)
    if len(blocks) == 1:
        out = append(docs, [text_bytes(quoted(text))], STATE, searched(sent(blocks[0]), window))
    else:
        out = search_blocks(docs, text, blocks, window)
    ends = F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    n_hit = F.aggregate(ends, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return out.withColumns({"n_hit": n_hit, "n_items": F.size("items").cast("bigint"), "contaminated": F.size("spans") > 0})


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents without any hit word, with all their columns as they are, whatever their names."""
    own, name = apart(docs)
    return together(find(own, benchmark, text=name[text], **options).where(~F.col("contaminated")), docs)
