"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text's subwords are the runs of two to four bytes of its lower-cased letters, with blanks at word
borders. Their hashed embeddings are averaged and a linear softmax gives the languages' probabilities.
The model is trained by stochastic gradient descent in numpy, on a bounded sample for each language;
part of that sample is kept back to fit the temperature and the score below which texts are rejected.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append, fold, quoted, slices, stage

#: Texts of the training sample, over all languages, and at most for one.
SAMPLE, PER_LANGUAGE = 2400, 400
#: Languages share SAMPLE evenly; it grows with their number, so that each gets so many, if it has them.
LEAST = 20
#: More languages than this are an error: the driver holds BUCKETS counts for each text of the sample.
MOST_LANGUAGES = 600
#: Parts in which a language's keys are ranked first.
SLICES = 16
BUCKETS, DIMENSION = 1 << 12, 16
#: Share of rightly named held-back texts that the rejection threshold may cost.
REJECTED_SHARE = 0.001
#: One in so many of a language's texts is kept back.
BACK_EVERY = 5
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
#: ASCII letters stay, other ASCII bytes become blanks, bytes from 0x80 on stay.
LETTERS_ONLY = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def subwords(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in a whole text."""
    counts = np.zeros(buckets, np.int64)
    for part in slices(text.lower().encode("utf-8", "surrogatepass").translate(LETTERS_ONLY)):
        a = np.frombuffer(b" " + b" ".join(part.split()) + b" ", np.uint8).astype(np.uint32)
        h = a
        for n in range(2, 5):
            if len(a) < n:
                break
            h = h[:-1] * np.uint32(0x01000193) + a[n - 1 :]
            mixed = ((h ^ np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(16)
            counts += np.bincount(mixed & np.uint32(buckets - 1), minlength=buckets)
    return counts


def averaged(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(1, counts.sum(axis=-1, keepdims=True))


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # bucket x language: embeddings times the linear layer
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        z = (averaged(counts) @ self.table + self.bias) / self.temperature
        e = np.exp(z - z.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)


def train(counts: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 30, batch: int = 16, rate: float = 0.5, seed: int = 1) -> Model:
    """Minibatch gradient descent on the mean log loss; the step falls linearly to zero."""
    rng = np.random.default_rng(seed)
    x, y = averaged(counts).astype(np.float32), np.eye(len(languages), dtype=np.float32)[labels]
    scale = np.float32(np.sqrt(BUCKETS))  # averages over thousands of buckets are tiny
    x = x * scale
    embed = rng.uniform(-1, 1, (counts.shape[1], DIMENSION)).astype(np.float32) / DIMENSION
    linear = np.zeros((DIMENSION, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps = epochs * -(-len(x) // batch)
    done = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            rows = order[at : at + batch]
            step = np.float32(rate * (1 - done / steps))
            done += 1
            hidden = x[rows] @ embed
            z = hidden @ linear + bias
            e = np.exp(z - z.max(axis=1, keepdims=True))
            error = (e / e.sum(axis=1, keepdims=True) - y[rows]) / len(rows)
            back = error @ linear.T
            linear -= step * (hidden.T @ error)
            bias -= step * error.sum(axis=0)
            embed -= step * (x[rows].T @ back)
    return Model(languages, (embed @ linear * scale).astype(np.float64), bias.astype(np.float64))


def calibrate(model: Model, counts: np.ndarray, labels: np.ndarray) -> Model:
    """The temperature with the least log loss, and the rejection threshold. Each label counts as wrong with
    a weight of one in len(labels) + 2 (Platt's targets): separable texts don't make every score 1."""
    if not len(labels):
        return model

    wrong = 1 / (len(labels) + 2)

    def loss(t: float) -> float:
        model.temperature = t
        p = np.clip(model.probabilities(counts)[np.arange(len(labels)), labels], 1e-12, 1 - 1e-12)
        return float(-((1 - wrong) * np.log(p) + wrong * np.log(1 - p)).mean())

    model.temperature = min((float(t) for t in np.geomspace(0.25, 4, 33)), key=loss)
    p = model.probabilities(counts)
    model.threshold = low_score(p.max(axis=1)[p.argmax(axis=1) == labels])
    return model


def low_score(scores: np.ndarray, share: float = REJECTED_SHARE) -> float:
    """The score below which ``share`` of such texts lie; 0 for fewer than two scores. As a share below
    one in len(scores) lies outside them, the lowest tenth (five at least) is continued as an exponential
    tail of log odds."""
    z = np.sort(np.log(np.maximum(scores, 1e-12)) - np.log(np.maximum(1 - scores, 1e-12)))
    k = min(len(z) - 1, max(5, len(z) // 10))
    if k < 1:
        return 0.0
    low = z[k] - (z[k] - z[:k]).mean() * max(0.0, np.log(k / (len(z) * share)))
    return float(1 / (1 + np.exp(-low)))


def kept_back(labels: np.ndarray) -> np.ndarray:
    """Which rows, sorted by label, are kept back: one in BACK_EVERY of each label, none of a label with fewer."""
    return (np.arange(len(labels)) - np.searchsorted(labels, labels)) % BACK_EVERY == BACK_EVERY - 1


def sample(docs: DataFrame, key: str, text: str, lang: str, wanted: Column) -> DataFrame:
    """(lang, counts) of the training texts: those of each language with the least hashes of their keys,
    as many of each as an even share of the sample allows.

    Ranks are cut in each task before keys are shuffled, then by slices of a language, so that a task sees
    no more than SLICES times PER_LANGUAGE keys of a very common one; texts are read for chosen keys only.
    More than MOST_LANGUAGES languages raise a ValueError."""
    spread = F.xxhash64(quoted(key).cast("string"))
    usable = docs.where(wanted & quoted(text).isNotNull() & quoted(lang).isNotNull()).select(
        quoted(key).cast("string").alias("key"), spread.alias("h"), quoted(lang).cast("string").alias("lang"), quoted(text).alias("text")
    )
    ranked = usable.select("lang", "h", "key", F.pmod(F.xxhash64("h"), F.lit(SLICES)).alias("slice"))
    for parts in (("lang", "slice"), ("lang",)):
        place = F.row_number().over(Window.partitionBy(*parts).orderBy("h", "key"))
        ranked = ranked.withColumn("r", place).where(F.col("r") <= PER_LANGUAGE)
    ranked = stage(ranked, "language-ranks")  # a few small columns, PER_LANGUAGE rows of a language
    n = ranked.where("r = 1").count()
    if n > MOST_LANGUAGES:
        raise ValueError(f"{n} languages are labelled; at most {MOST_LANGUAGES} can be learnt")
    # by rank first: every language has had its r-th text before one gets another
    shared = ranked.orderBy("r", "h", "key", "lang").limit(max(SAMPLE, LEAST * n))
    bounds = shared.groupBy("lang").agg(F.max("h").alias("most"), F.count("*").alias("n"))
    chosen = usable.join(F.broadcast(bounds), "lang").where(F.col("h") <= F.col("most"))  # one row per language
    counts = T.StructType([T.StructField("counts", T.BinaryType())])

    def make():
        return lambda texts: [pa.array([subwords(t).astype("<u4").tobytes() for t in texts.to_pylist()], pa.binary())]

    counted = append(chosen, [F.col("text")], counts, make).select("lang", "h", "key", "counts", "n")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "key", "counts"))  # repeated keys share a hash
    return counted.withColumn("r", place).where((F.col("r") <= F.col("n")) & (F.col("r") <= PER_LANGUAGE)).select("lang", "counts")


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", wanted: Column | None = None) -> Model | None:
    """A model trained on rows for which ``wanted`` holds; None without any labelled text."""
    rows = sample(docs, key, text, lang, F.lit(True) if wanted is None else wanted).collect()
    rows.sort(key=lambda r: (r.lang, bytes(r.counts)))
    if not rows:
        return None
    languages = sorted({r.lang for r in rows})
    labels = np.array([languages.index(r.lang) for r in rows])
    x = np.stack([np.frombuffer(r.counts, "<u4").astype(np.float32) for r in rows])
    back = kept_back(labels)
    return calibrate(train(x[~back], labels[~back], languages), x[back], labels[back])


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (its calibrated probability) and ``rejected``.

    A null text and one without any letter is ``und`` with score 0 and rejected. Without a model every
    text is ``und`` with score 0, and those with a letter are not rejected, as nothing speaks against
    them. A text whose score lies below the model's threshold keeps its most likely language and is
    rejected. Of equally likely languages the first by name is taken; repeated rows get the same values;
    a very long text counts whole; an empty table gives an empty table. Columns with these names are
    replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows, one column per language

    def make():
        known = sent.value

        def step(texts):
            names, scores, rejected = [], [], []
            for t in texts.to_pylist():
                letter = LETTER.search(t) is not None
                if known is None or not letter:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(not letter)
                else:
                    p = known.probabilities(subwords(t))
                    names.append(known.languages[int(p.argmax())])
                    scores.append(float(p.max()))
                    rejected.append(scores[-1] < known.threshold)
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]

        return step

    added = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("rejected", T.BooleanType())]
    return append(docs, [F.coalesce(quoted(text), F.lit(""))], T.StructType([T.StructField(n, t) for n, t in added]), make)


def held_out(key: str = "doc_id") -> Column:
    """Rows that are never learnt from: crc32 of the key as text leaves 0 by 5 (a null key: as '')."""
    return fold(quoted(key), 5) == 0
