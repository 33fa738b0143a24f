"""Mixture-controlled packing by deficit round-robin over source queues.

Each source is a queue of its documents' tokens. A round grants one window (a sequence) of tokens as
credit, shared among the queues that are not empty by their target proportions. A queue sends whole
grains as far as its credit covers them and carries the rest, its deficit, to the next round; the
shares of empty queues go to the others. The grains, in order of round and queue, are one stream,
which is cut into sequences: all are full but the last, and no queue is ever more than a grain away
from its target.

Credit depends only on the queues' totals, so what a round sends has a closed form: every task finds
the places of its own documents' tokens from the queues' totals and the documents' places in their
queues, as if all deficits had been carried from window to window and partition to partition. Token
ids are written once, read once and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import map_batches, quoted, stage
from .tokens import encoder

#: Tokens that a queue sends at a time.
GRAIN = 512
#: Queues; of the sources without targets, those with the fewest tokens beyond that share one.
QUEUES = 1024
#: Bytes of texts or ids that are worked on at once.
BATCH_BYTES = 4 << 20


class Rounds:
    """What each queue has sent after each round, in closed form."""

    def __init__(self, totals: np.ndarray, weights: np.ndarray, window: int, grain: int) -> None:
        self.totals, self.weights, self.window, self.grain = totals, weights, window, grain
        # credit of queue i is weight * virtual time until it is empty; time stands still for nobody
        self.empty_at = totals / weights
        self.times = np.concatenate([[0.0], np.unique(self.empty_at)])
        self.granted = np.array([np.minimum(weights * t, totals).sum() for t in self.times])
        self.granted[-1] = totals.sum()

    def sent(self, queue: np.ndarray, rounds: np.ndarray) -> np.ndarray:
        """Tokens that ``queue`` has sent when ``rounds`` are over."""
        time = np.interp(rounds.astype(np.float64) * self.window, self.granted, self.times)
        whole = np.floor(self.weights[queue] * time / self.grain).astype(np.int64) * self.grain
        return np.where(time >= self.empty_at[queue], self.totals[queue], np.minimum(whole, self.totals[queue]))

    def round_of(self, queue: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The first round after which ``end`` tokens of ``queue`` have been sent."""
        credit = np.interp(end / self.weights[queue], self.times, self.granted)
        k = np.maximum(1, np.ceil(credit / self.window).astype(np.int64))
        while (late := self.sent(queue, k) < end).any():
            k += late
        while (early := (k > 1) & (self.sent(queue, k - 1) >= end)).any():
            k -= early
        return k

    def places(self, queue: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Where in the stream each cell (a grain of a queue) starts."""
        end = np.minimum((cell + 1) * self.grain, self.totals[queue])
        k, out = self.round_of(queue, end), np.empty(len(cell), np.int64)
        number, at = np.arange(len(self.totals)), np.argsort(k, kind="stable")
        for part in np.array_split(at, max(1, len(at) * len(number) >> 20)):
            if len(part):
                rounds, back = np.unique(k[part], return_inverse=True)
                before, after = (self.sent(number[:, None], r[None, :]) for r in (rounds - 1, rounds))
                turns = np.cumsum(after - before, axis=0) - (after - before)
                q = queue[part]
                out[part] = before.sum(axis=0)[back] + turns[q, back] + cell[part] * self.grain - before[q, back]
        return out


def token_table(docs: DataFrame, key: str, text: str, queue: str, tokenizer: str, ranks: str | None, end_id: int) -> DataFrame:
    """key, source, part, start (in the part's tokens of that source), n and ids of every document."""
    kind = T.StructField("key", docs.schema[key].dataType)
    rest = [("source", T.StringType()), ("part", T.IntegerType()), ("start", T.LongType()), ("n", T.LongType()), ("ids", T.BinaryType())]
    schema = T.StructType([kind, *[T.StructField(n, t) for n, t in rest]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, ends = encoder(tokenizer, ranks), TaskContext.get().partitionId(), {}
        close = np.array([end_id], encode.dtype).tobytes()
        width = encode.dtype.itemsize
        for whole in batches:
            for batch in sliced(whole, 2, BATCH_BYTES):
                ids = [encode.encode(t.as_py()) + close for t in batch.column(2)]
                sources, starts, counts = batch.column(1).to_pylist(), [], [len(x) // width for x in ids]
                for source, n in zip(sources, counts):
                    starts.append(ends.get(source, 0))
                    ends[source] = starts[-1] + n
                columns = [pa.array([part] * len(ids), pa.int32()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names=schema.names)

    source = F.coalesce(F.concat(F.lit("="), quoted(queue).cast("string")), F.lit(""))
    ready = docs.select(quoted(key).alias("key"), source.alias("source"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    return stage(map_batches(ready, run, schema), "packing-tokens")


def pack(
    docs: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    queue: str = "source",
    length: int = 2048,
    end_id: int = 1,
    targets: Mapping[str, float] | None = None,
    grain: int = GRAIN,
    queues: int = QUEUES,
) -> DataFrame:
    """The pieces of all documents: ``key``, ``start`` and ``length`` (in the document's tokens, the
    closing ``end_id`` included), ``ids`` (little-endian unsigned 32-bit numbers), ``doc_tokens``,
    ``source``, ``sequence_id`` and ``offset``.

    ``tokenizer`` is the path of a tokenizer's file, ``ranks`` that of the same vocabulary as ranks, if
    there is one. ``targets`` gives the sources' proportions; a source that is not listed, and every source without
    ``targets``, gets its share of all tokens. A null source is a queue of its own. A null or empty
    text is the closing id alone; a very long one is many pieces. Repeated rows are packed each. An empty
    table gives no pieces. Other columns are not read.

    Every source with a target has a queue of its own, then the largest of the others, up to ``queues``;
    the rest share one. More targets than that, and a target that names no source, raise a ValueError.
    """
    spark = docs.sparkSession
    tokens = token_table(docs, key, text, queue, tokenizer, ranks, end_id)
    sums = tokens.groupBy("source", "part").agg(F.sum("n").alias("n"))
    by_source = sums.groupBy("source").agg(F.sum("n").alias("n"))
    share = {f"={k}": float(v) for k, v in (targets or {}).items()}
    if len(share) >= queues:
        raise ValueError(f"{len(share)} targets need more than {queues} queues")
    asked = F.col("source").isin(list(share)) if share else F.lit(False)
    largest = [(r.source, r.n) for r in by_source.orderBy(asked.desc(), F.desc("n"), "source").limit(queues).collect()]
    if missing := sorted(s[1:] for s in share.keys() - {s for s, _ in largest} if largest):
        raise ValueError(f"targets name no source: {', '.join(missing)}")
    rest = (by_source.agg(F.sum("n")).first()[0] or 0) - sum(n for _, n in largest)
    if rest:  # more sources than queues: the smallest share the last queue
        largest, rest = largest[:-1], rest + largest[-1][1]
    totals = np.array([n for _, n in largest] + [rest] * bool(rest), np.int64)
    weights = np.array([share.get(s, n / max(1, totals.sum())) for s, n in largest] + [rest / max(1, totals.sum())] * bool(rest))
    if len(weights) and not (np.isfinite(weights).all() and (weights > 0).all()):
        raise ValueError("target proportions must be positive")
    number = spark.createDataFrame([(s, i) for i, (s, _) in enumerate(largest)], "source string, queue int")  # at most `queues` rows
    placed = sums.join(F.broadcast(number), "source", "left").withColumn("queue", F.coalesce("queue", F.lit(len(largest))))
    order = Window.partitionBy("queue").orderBy("part", "source").rowsBetween(Window.unboundedPreceding, -1)
    bases = stage(placed.select("source", "part", "queue", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base")), "packing-bases")
    ready = tokens.join(bases, ["source", "part"]).select("key", "source", "queue", (F.col("base") + F.col("start")).alias("start"), "n", "ids")
    kind = T.StructField(key, docs.schema[key].dataType)
    plain = [("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()), ("doc_tokens", T.LongType()), ("source", T.StringType()), ("sequence_id", T.LongType()), ("offset", T.LongType())]
    schema = T.StructType([kind, *[T.StructField(n, t) for n, t in plain]])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rounds = Rounds(totals, weights, length, grain)
        for whole in batches:
            for batch in sliced(whole, whole.schema.get_field_index("ids"), BATCH_BYTES):
                yield pieces(batch, rounds, length, arrow)

    return map_batches(ready, run, schema)


def pieces(batch: pa.RecordBatch, rounds: Rounds, length: int, schema: pa.Schema) -> pa.RecordBatch:
    """The pieces of a batch of documents, in order."""
    queue, start, n = (batch.column(c).to_numpy().astype(np.int64) for c in ("queue", "start", "n"))
    grain = rounds.grain
    first, last = start // grain, (start + n - 1) // grain
    # cells of the queue that each document lies in
    doc, step = spread(last - first + 1)
    cell = first[doc] + step
    low = np.maximum(start[doc], cell * grain)
    high = np.minimum(start[doc] + n[doc], (cell + 1) * grain)
    place = rounds.places(queue[doc], cell) + low - cell * grain
    size = high - low
    # cells of a document that follow each other in the stream are one run
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + size[:-1])
    at = np.flatnonzero(new)
    doc, low, place = doc[at], low[at], place[at]
    size = np.add.reduceat(size, at)
    # runs are cut where a sequence ends
    run, step = spread((place + size - 1) // length - place // length + 1)
    sequence = place[run] // length + step
    begin = np.maximum(place[run], sequence * length)
    end = np.minimum(place[run] + size[run], (sequence + 1) * length)
    doc, own = doc[run], low[run] - start[doc[run]] + begin - place[run]
    raw = batch.column("ids").to_pylist()
    width = len(raw[0]) // int(n[0])
    data = np.frombuffer(b"".join(raw), f"<u{width}").astype("<u4").tobytes()
    offsets = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int32) * 4
    ids = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    rows = pa.array(doc)
    names = pa.array([s[1:] if s else None for s in batch.column("source").to_pylist()], pa.string())
    numbers = [pa.array(x, pa.int64()) for x in (own, end - begin, n[doc], sequence, begin - sequence * length)]
    return pa.RecordBatch.from_arrays(
        [batch.column("key").take(rows), *numbers[:2], ids, numbers[2], names.take(rows), *numbers[3:]], schema=schema
    )


def sliced(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``size`` bytes in a column."""
    if batch.num_rows:
        run = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64)) // size
        for rows in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(run)) + 1):
            yield batch.slice(rows[0], len(rows))


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i, counts[i] rows of (i, 0), (i, 1), ..."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
