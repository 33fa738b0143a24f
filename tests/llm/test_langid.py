"""Language models on held-out documents, and the edges."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayledger.llm import langid

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = langid.fit(docs, wanted=~langid.held_out())
    rows = langid.predict(docs, model).where(langid.held_out()).select("lang", "lang_pred", "score", "rejected").collect()
    assert len(rows) > 100
    assert np.mean([r.lang == r.lang_pred for r in rows]) >= 0.97
    assert np.mean([r.rejected for r in rows]) <= 0.02
    assert all(0 <= r.score <= 1 for r in rows)
    # calibrated: the mean score is near the share of right answers
    assert abs(np.mean([r.score for r in rows]) - np.mean([r.lang == r.lang_pred for r in rows])) < 0.05


def test_subwords_of_slices(monkeypatch):
    text = "Été the 123 of—Ünder " * 30
    whole = langid.subwords(text)
    words = text.lower().encode().translate(langid.LETTERS_ONLY).split()
    wanted = np.zeros_like(whole)
    for w in [b" " + b" ".join(words) + b" "]:
        for n in (2, 3, 4):
            for i in range(len(w) - n + 1):
                h = 0
                for c in w[i : i + n]:
                    h = (h * 0x01000193 + c) & 0xFFFFFFFF
                wanted[(((h ^ n) * 2654435761 & 0xFFFFFFFF) >> 16) & (len(wanted) - 1)] += 1
    assert (whole == wanted).all()
    monkeypatch.setattr(langid.slices, "__defaults__", (50,))
    assert abs(langid.subwords(text).sum() - whole.sum()) < len(words)  # only slices' borders differ


def test_edges(spark):
    rows = [(1, "the cat is on the mat and in the house", "en"), (2, "the dog and the man of the town", "en"), (3, "le chat est sur la table et dans la maison", "fr"),
            (4, "les chiens et les hommes de la ville", "fr"), (4, "les chiens et les hommes de la ville", "fr"), (5, None, "fr"), (6, "", "en"), (7, "12 34 ... !!", None), (None, "the end of the day", None), (8, "le " * 90000, None)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, score int, lang_pred string")
    model = langid.fit(frame)
    assert model.languages == ["en", "fr"]
    got = langid.predict(frame, model)
    assert sorted(got.columns) == sorted([*frame.columns, "rejected"])
    found = {r.doc_id: (r.lang_pred, r.score, r.rejected) for r in got.collect()}
    assert found[5] == found[6] == found[7] == ("und", 0.0, True)
    assert found[8][0] == "fr" and found[1][0] == "en"
    assert langid.fit(frame.limit(0)) is None and langid.fit(frame.where("lang IS NULL")) is None
    assert {r.lang_pred for r in langid.predict(frame, None).collect()} == {"und"}
    assert langid.predict(frame.limit(0), model).count() == 0
    held = frame.select(langid.held_out().alias("h"), "doc_id").collect()
    assert all(r.h is not None for r in held)


def test_rare_languages_keep_their_share(spark):
    rng = random.Random(1)
    words = [["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(40)] for _ in range(20)]
    texts = F.array(*[F.lit(" ".join(rng.choices(w, k=60))) for w in words for _ in range(10)])
    starts = np.cumsum([0, *[30000] * 8, *[100] * 11, 10])
    lang = F.lit(-1)
    for start in starts[:-1]:
        lang = lang + (F.col("id") >= int(start)).cast("int")
    numbered = spark.range(int(starts[-1])).select(F.col("id").alias("doc_id"), lang.alias("n"))
    frame = numbered.select("doc_id", F.format_string("l%02d", "n").alias("lang"), F.get(texts, (F.col("n") * 10 + F.col("doc_id") % 10).cast("int")).alias("text"))
    model = langid.fit(frame)
    assert model.languages == [f"l{i:02}" for i in range(20)]
    rare = langid.predict(frame.where("n >= 8"), model).collect()
    assert np.mean([r.lang == r.lang_pred for r in rare]) > 0.99
    found = Counter(r.lang for r in langid.sample(frame, "doc_id", "text", "lang", F.lit(True)).collect())
    common = [found[f"l{i:02}"] for i in range(8)]
    assert [found[f"l{i:02}"] for i in range(8, 20)] == [100] * 11 + [10]
    assert sum(found.values()) == langid.SAMPLE and max(common) - min(common) <= 1


def test_many_languages(spark):
    frame = spark.range(40 * 130).select(F.col("id").alias("doc_id"), F.concat(F.lit("l"), F.col("id") % 130).alias("lang"), F.lit("word").alias("text"))
    found = Counter(r.lang for r in langid.sample(frame, "doc_id", "text", "lang", F.lit(True)).collect())
    assert len(found) == 130 and set(found.values()) == {langid.LEAST}
    with pytest.raises(ValueError, match="601 languages"):
        langid.fit(spark.range(601).select(F.col("id").alias("doc_id"), F.concat(F.lit("l"), "id").alias("lang"), F.lit("word").alias("text")))


def garbled(spark, n=100):
    rng = random.Random(1)
    return spark.createDataFrame([("".join(rng.choices("abcdefghijklmnopqrstuvwxyz    ", k=400)),) for _ in range(n)], "text string")


def test_a_rare_label_leaves_rejection_on(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(docs.union(spark.createDataFrame([(-1, "the only one of its kind", "aa")], docs.schema)))
    assert model.languages == ["aa", "de", "en", "es", "fr"] and model.threshold > 0.2
    assert langid.predict(garbled(spark), model).where("rejected").count() >= 80
    assert langid.kept_back(np.array([0, 0, 0, 1, 2, 2, 2, 2, 2, 2])).nonzero()[0].tolist() == [8]


def test_rejection_with_two_languages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("lang IN ('en', 'fr')")
    model = langid.fit(docs, wanted=~langid.held_out())
    clean = langid.predict(docs, model).where(langid.held_out() & (F.col("lang_pred") == F.col("lang")))
    assert clean.where("rejected").count() <= 0.02 * clean.count()
    assert langid.predict(garbled(spark), model).where("rejected").count() >= 80


def test_low_score():
    scores = 1 / (1 + np.exp(-(5 + np.random.default_rng(1).exponential(1, 20000) * -1)))
    exact = np.quantile(scores, 0.001)
    for n in (1000, 20000):
        assert abs(np.log(langid.low_score(scores[:n]) / exact)) < 1.5
    assert np.mean(scores < langid.low_score(scores[:100])) <= 0.01
    assert langid.low_score(scores[:0]) == langid.low_score(scores[:1]) == 0.0
