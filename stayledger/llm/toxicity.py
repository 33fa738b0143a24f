"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Terms are all words of the examples, a bounded sample of labelled rows; document frequencies are counted
over all documents. A term's weight is its inverse document frequency, raised by how surely the examples
tie it to the label: ``ASSOCIATION`` times the lower end of its log odds ratio, which is nothing for
nearly all words. Examples lie in an inverted index whose postings are cut into blocks of neighbouring
examples, each with the highest weight of the term. For a text, blocks are visited in order of their upper
bounds until no other block can hold a nearer example, so the neighbours are exact. They vote with a
weight that grows as their distance falls; the votes are calibrated on the examples themselves, each
without itself.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD_TABLE, append, fold, map_batches, quoted, slices, text_bytes

#: Labelled examples taken of each class.
PER_CLASS = 1500
#: What a term's tie to the label adds to its weight, and how many standard errors are taken off it.
ASSOCIATION, CAUTION = 10.0, 2.0
BLOCK, NEIGHBOURS, EVIDENCE = 1024, 15, 3
#: Terms in at least this share of a block's examples lie there as full rows, the others as postings.
FULL_FROM = 1 / 16
#: Weight, in votes, of the share of toxic rows among all labelled ones.
PRIOR_VOTES = 0.5

Vector = tuple[np.ndarray, np.ndarray]  # terms, ascending, and their weights


def term_counts(text: bytes) -> Counter[bytes]:
    """How often each word occurs in a whole text."""
    words: Counter[bytes] = Counter()
    for part in slices(text.translate(WORD_TABLE)):
        words.update(part.split())
    return words


def known_counts(text: bytes, vocabulary: dict[bytes, int]) -> dict[int, int]:
    """term_counts for the vocabulary's words, by their numbers."""
    counts = term_counts(text)
    found = dict(zip(map(vocabulary.get, counts), counts.values()))
    found.pop(None, None)
    return found


@dataclass
class Index:
    """Examples by term, in blocks, with the highest weight of each block."""

    ids: list[int]
    labels: np.ndarray  # share of toxic ones among the rows that an example stands for
    votes: np.ndarray  # weight of each example's vote: how many labelled rows it stands for
    vectors: list[Vector]  # of length one
    terms: int
    tops: np.ndarray = field(init=False)  # term x block
    blocks: list[tuple[np.ndarray, ...]] = field(init=False)

    def __post_init__(self) -> None:
        self.blocks = []
        self.tops = np.zeros((self.terms, -(-len(self.ids) // BLOCK)))
        for b in range(self.tops.shape[1]):
            part = self.vectors[b * BLOCK : (b + 1) * BLOCK]
            terms = np.concatenate([t for t, _ in part])
            weights = np.concatenate([w for _, w in part])
            rows = np.repeat(np.arange(len(part), dtype=np.int32), [len(t) for t, _ in part])
            np.maximum.at(self.tops[:, b], terms, weights)
            held = np.bincount(terms, minlength=self.terms)
            slots = np.full(self.terms, -1, np.int32)
            frequent = np.flatnonzero(held >= max(2, FULL_FROM * len(part)))
            slots[frequent] = np.arange(len(frequent))
            full, at = np.zeros((len(frequent), BLOCK)), slots[terms]
            full[at[at >= 0], rows[at >= 0]] = weights[at >= 0]
            terms, rows, weights, held[frequent] = terms[at < 0], rows[at < 0], weights[at < 0], 0
            order, starts = np.argsort(terms, kind="stable"), np.zeros(self.terms + 1, np.int32)
            np.cumsum(held, out=starts[1:])
            self.blocks.append((slots, full, starts, rows[order], weights[order]))  # postings of a term lie together

    def cosines(self, b: int, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Of each example of a block."""
        slots, full, starts, rows, held = self.blocks[b]
        slot = slots[terms]
        frequent = slot >= 0
        scores = weights[frequent] @ full[slot[frequent]]
        terms, weights = terms[~frequent], weights[~frequent]
        begin = starts[terms].astype(np.int64)
        sizes = starts[terms + 1] - begin
        at = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return scores + np.bincount(rows[at], held[at] * np.repeat(weights, sizes), minlength=BLOCK)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k nearest with a common term; ties to the earlier example."""
        bounds = weights @ self.tops[terms]
        best_rows, best = np.empty(0, np.int64), np.empty(0)
        for b in np.argsort(-bounds, kind="stable"):
            if bounds[b] <= 0 or (len(best) == k and bounds[b] < best[-1] - 1e-12):
                break
            scores = self.cosines(b, terms, weights)
            if 0 <= without - b * BLOCK < BLOCK:
                scores[without - b * BLOCK] = 0
            # only those that can be among the k nearest are put in order
            least = max(best[-1] if len(best) == k else 0.0, np.partition(scores, -k)[-k] if k <= BLOCK else 0.0)
            rows = np.flatnonzero(scores >= least if least > 0 else scores)
            rows, scores = rows + b * BLOCK, scores[rows]
            rows, scores = np.concatenate([best_rows, rows]), np.concatenate([best, scores])
            order = np.lexsort((rows, -scores))[:k]
            best_rows, best = rows[order], scores[order]
        return best_rows, best


@dataclass
class Model:
    vocabulary: dict[bytes, int]
    weights: np.ndarray  # of each term
    index: Index
    base: float  # share of toxic rows among the labelled ones
    slope: float = 1.0
    shift: float = 0.0

    def vector(self, counts: dict[int, int]) -> Vector:
        return vector(counts, self.weights)

    def vote(self, rows: np.ndarray, cosines: np.ndarray) -> float:
        """Share of toxic votes, each weighted by nearness, with the base share as a weak prior."""
        w = cosines / (1.0 - np.minimum(cosines, 1.0) + 0.1) * self.index.votes[rows]
        return float((PRIOR_VOTES * self.base + (w * self.index.labels[rows]).sum()) / (PRIOR_VOTES + w.sum()))

    def calibrated(self, vote: float) -> float:
        z = self.slope * logit(vote) + self.shift
        return float(1 / (1 + np.exp(-z)))

    def score(self, text: bytes) -> tuple[float, list[int], list[float]]:
        return self.scores([text])[0]

    def scores(self, texts: list[bytes]) -> list[tuple[float, list[int], list[float]]]:
        """Score, nearest examples and their cosines of each text; all words are looked up before the first
        block is visited, as vocabulary and blocks would drive each other out of the processor's cache."""
        vectors = [self.vector(known_counts(text, self.vocabulary)) for text in texts]
        found = [self.index.nearest(*v, NEIGHBOURS) for v in vectors]
        ids = self.index.ids
        return [(self.calibrated(self.vote(rows, cosines)), [ids[i] for i in rows[:EVIDENCE].tolist()], cosines[:EVIDENCE].tolist()) for rows, cosines in found]


def vector(counts: dict[int, int], term_weights: np.ndarray) -> Vector:
    """Weights of a text's terms, scaled to length one."""
    return scaled(np.fromiter(counts, np.int64, len(counts)), np.fromiter(counts.values(), float, len(counts)), term_weights)


def scaled(terms: np.ndarray, counts: np.ndarray, term_weights: np.ndarray) -> Vector:
    """As :func:`vector`, of the terms and how often each occurs."""
    weights = (1 + np.log(counts.astype(float))) * term_weights[terms]
    order = np.argsort(terms)
    size = np.sqrt((weights**2).sum())
    return terms[order], weights[order] / (size or 1.0)


def logit(p: float) -> float:
    p = min(max(p, 1e-4), 1 - 1e-4)
    return float(np.log(p / (1 - p)))


def examples(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, wanted: Column) -> tuple[DataFrame, dict[int, int]]:
    """(id, y, text) of at most PER_CLASS labelled rows of each class, those with the least hashes of
    their ids, and how many rows of each class there are. A document labelled twice counts as toxic if
    one of its labels says so; only ids are looked at until the sample is known."""
    usable = labels.where(quoted(label).isin(0, 1) & wanted & quoted(key).isNotNull())
    single = usable.groupBy(quoted(key).alias("id")).agg(F.max(quoted(label)).cast("int").alias("y"))
    sizes = {r.y: r.n for r in single.groupBy("y").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for y in (0, 1):
        part = single.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(PER_CLASS)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = F.broadcast(chosen)  # at most twice PER_CLASS ids
    texts = docs.select(quoted(key).alias("id"), text_bytes(quoted(text)).alias("text")).join(chosen, "id")
    return texts, sizes


def counted(texts: DataFrame) -> DataFrame:
    """One row per different text of the examples: digest, its words (joined by blanks) and how often each
    occurs (32-bit numbers), the least id, and how many rows of each label have it. Words and counts are one
    value each, as the driver holds all of them at once."""

    def make():
        def step(data):
            counts = [term_counts(t) for t in data.to_pylist()]
            words = pa.array([b" ".join(c) for c in counts], pa.binary())
            return [words, pa.array([np.fromiter(c.values(), "<u4", len(c)).tobytes() for c in counts], pa.binary())]

        return step

    single = texts.dropDuplicates(["id"]).withColumn("digest", F.sha2("text", 256))
    rows = single.groupBy("digest").agg(F.min("id").alias("id"), F.sum("y").alias("toxic"), F.count("*").alias("n"), F.first("text").alias("text"))
    pair = [T.StructField("words", T.BinaryType()), T.StructField("counts", T.BinaryType())]
    return append(rows, [F.col("text")], T.StructType(pair), make).drop("text")


def frequencies(docs: DataFrame, text: str, vocabulary: dict[bytes, int]) -> tuple[np.ndarray, int]:
    """In how many of all documents each term occurs, and the number of documents. Each task sends at
    most one row per term."""
    size = len(vocabulary)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)  # words of at most twice PER_CLASS examples

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, found = sent.value, np.zeros(size + 1, np.int64)  # the last: documents
        for batch in batches:
            found[size] += batch.num_rows
            for data in batch.column(0).to_pylist():
                found[list(known_counts(data, known))] += 1
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(found[at], pa.int64())], names=["at", "n"])

    sums = map_batches(docs.select(text_bytes(quoted(text))), count, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
    out = np.zeros(size + 1, np.int64)
    found = sums.toArrow()  # at most one row per term, as two arrays
    out[found["at"].to_numpy()] = found["n"].to_numpy()
    return out[:size], int(out[size])


def associations(held: list[np.ndarray], labels: np.ndarray, terms: int) -> np.ndarray:
    """For each term, the log ratio of its odds in toxic and in other examples, less CAUTION standard
    errors, and at least 0. Each different text counts once."""
    toxic, other = np.zeros(terms), np.zeros(terms)
    for at, y in zip(held, labels):
        toxic[at] += y
        other[at] += 1 - y
    cells = [x + 0.5 for x in (toxic, labels.sum() - toxic, other, (1 - labels).sum() - other)]
    ratio = np.log(cells[0]) - np.log(cells[1]) - np.log(cells[2]) + np.log(cells[3])
    return np.maximum(0.0, ratio - CAUTION * np.sqrt(sum(1 / c for c in cells)))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", wanted: Column | None = None) -> Model | None:
    """A model learnt from the labelled rows for which ``wanted`` holds (a condition on the labels'
    columns); document frequencies are those of all ``docs``. Rows with one text are one example, with a
    vote for each row. None without a toxic example or without a word in any."""
    texts, sizes = examples(docs, labels, key, text, label, F.lit(True) if wanted is None else wanted)
    rows = counted(texts).collect()  # at most twice PER_CLASS
    different: set[bytes] = set()
    for r in rows:
        different.update(r.words.split())
    vocabulary = {w: i for i, w in enumerate(sorted(different))}
    del different
    if not vocabulary or not any(r.toxic for r in rows):
        return None
    found, n = frequencies(docs, text, vocabulary)
    shares = np.array([r.toxic / r.n for r in rows])
    held = [np.fromiter(map(vocabulary.__getitem__, r.words.split()), np.int64) for r in rows]
    weights = (np.log((n + 1) / (found + 1)) + 1) * (1 + ASSOCIATION * associations(held, shares, len(vocabulary)))
    vectors = [scaled(t, np.frombuffer(r.counts, "<u4"), weights) for t, r in zip(held, rows)]
    del held
    # neighbours in the index share their commonest words, which differ by language, so that blocks of other
    # languages have low bounds; ids and labels have no say in the order, as it decides ties
    commonest = [tuple(t[np.lexsort((t, -found[t]))[:3]].tolist()) for t, _ in vectors]
    order = sorted(range(len(rows)), key=lambda i: (commonest[i], rows[i].digest))
    sampled = {1: sum(r.toxic for r in rows), 0: sum(r.n - r.toxic for r in rows)}
    stands = {y: sizes.get(y, 0) / max(1, sampled[y]) for y in (0, 1)}  # labelled rows for each sampled one
    toxic = np.array([rows[i].toxic for i in order]) * stands[1]
    clean = np.array([rows[i].n - rows[i].toxic for i in order]) * stands[0]
    votes = toxic + clean
    index = Index([rows[i].id for i in order], toxic / votes, votes / max(stands.values()), [vectors[i] for i in order], len(vocabulary))
    return calibrate(Model(vocabulary, weights, index, sizes.get(1, 0) / max(1, sum(sizes.values()))))


def calibrate(model: Model) -> Model:
    """Slope and shift of a logistic curve over the votes each example gets from the others."""
    index = model.index
    x, y = np.empty(len(index.ids)), index.labels
    for i, (terms, weights) in enumerate(index.vectors):
        x[i] = logit(model.vote(*index.nearest(terms, weights, NEIGHBOURS, without=i)))
    index.vectors = []  # the postings hold them
    # Newton steps on the weighted log loss, with a weak pull towards the plain votes
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(index.votes * (p - y) * x).sum() + (a - 1), (index.votes * (p - y)).sum() + b * 0.1])
        w = index.votes * np.maximum(p * (1 - p), 1e-6)
        h = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    model.slope, model.shift = float(max(a, 0.1)), float(b)
    return model


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and the evidence: ``near_ids`` and ``near_cosines`` of the
    nearest examples.

    A null or empty text, and one without a word of the examples, has no neighbour and gets the
    calibrated base share. Very long texts are read whole; equally near examples are taken by their
    commonest words and the digest of their text; repeated rows are scored alike, and an empty table
    gives an empty one. Without a model every score is 0. Columns with these names are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most twice PER_CLASS examples

    def make():
        known = sent.value
        nothing = (0.0, [], []) if known is None else known.score(b"")

        def step(texts):
            found = [nothing] * len(texts) if known is None else known.scores(texts.to_pylist())
            kinds = (pa.float64(), pa.list_(pa.int64()), pa.list_(pa.float64()))
            return [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]

        return step

    added = [("score", T.DoubleType()), ("near_ids", T.ArrayType(T.LongType())), ("near_cosines", T.ArrayType(T.DoubleType()))]
    return append(docs, [text_bytes(quoted(text))], T.StructType([T.StructField(n, t) for n, t in added]), make)


def held_out(key: str = "doc_id") -> Column:
    """Rows whose labels are never learnt: crc32 of the key as text leaves 2 by 4 (a null key: as '')."""
    return fold(quoted(key), 4) == 2
