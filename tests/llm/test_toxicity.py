"""Nearest examples against plain cosines, and the model on held-out labels."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np

from stayledger.llm import toxicity

FOLDER = "/root/testdata/sf0.1"


def test_nearest_are_exact():
    rng = np.random.default_rng(1)
    for size, terms in ((1, 3), (50, 5), (700, 20)):
        vectors = rng.random((size, terms)) * (rng.random((size, terms)) < 0.2)
        vectors = np.repeat(vectors, 2, axis=0)  # ties
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        vectors = np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)
        sparse = [(np.flatnonzero(v), v[np.flatnonzero(v)]) for v in vectors]
        index = toxicity.Index(list(range(len(vectors))), np.zeros(len(vectors)), np.ones(len(vectors)), sparse, terms)
        for _ in range(40):
            q = rng.random(terms) * (rng.random(terms) < 0.4)
            at = np.flatnonzero(q)
            w = q[at] / max(1e-9, np.linalg.norm(q))
            cosines = vectors[:, at] @ w
            for without in (-1, 0):
                order = [i for i in np.lexsort((np.arange(len(cosines)), -np.round(cosines, 12))) if cosines[i] > 0 and i != without][:7]
                rows, found = index.nearest(at, w, 7, without)
                assert np.allclose(found, cosines[order])
                assert np.allclose(cosines[rows], cosines[order])


def test_only_possible_neighbours_are_put_in_order(monkeypatch):
    rng = np.random.default_rng(2)
    weights = rng.random((3000, 2)) + 0.1
    weights /= np.linalg.norm(weights, axis=1, keepdims=True)
    index = toxicity.Index(list(range(3000)), np.zeros(3000), np.ones(3000), [(np.arange(2), w) for w in weights], 2)
    plain, sizes = np.lexsort, []
    monkeypatch.setattr(toxicity.np, "lexsort", lambda keys: sizes.append(len(keys[0])) or plain(keys))
    rows, cosines = index.nearest(np.arange(2), np.array([0.6, 0.8]), 15)
    monkeypatch.undo()
    expected = weights @ [0.6, 0.8]
    assert max(sizes) <= 2 * 15 and np.allclose(cosines, np.sort(expected)[::-1][:15])
    assert np.allclose(expected[rows], cosines)


def test_terms():
    text = b"Idiots IDIOTS \xc3\xa9t\xc3\xa9 a-b"
    counts = toxicity.term_counts(text)
    assert counts == {b"idiots": 2, b"\xc3\xa9t\xc3\xa9": 1, b"a": 1, b"b": 1}
    vocabulary = {t: i for i, t in enumerate(counts)}
    assert toxicity.known_counts(text, vocabulary) == {vocabulary[t]: n for t, n in counts.items()}


def test_scores_against_plain_cosines(spark):
    """All terms of all examples, in dictionaries, from the texts to the neighbours and the vote."""
    rng = random.Random(7)
    pool = [f"w{i}" for i in range(300)] + ["é"]
    texts = {i: " ".join(rng.choices(pool, k=rng.randrange(1, 60)) + (["scum"] if i % 5 == 0 else [])) for i in range(400)}
    texts |= {400: texts[0], 401: texts[1], 402: None, 403: "unknown words only"}
    marks = {i: int(i % 5 == 0) for i in range(300)} | {400: 0, 401: 0}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(list(marks.items()), "doc_id long, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}

    bags = {i: Counter((t or "").lower().split()) for i, t in texts.items()}
    by_text: dict[str, list[int]] = {}
    for i in marks:
        by_text.setdefault(texts[i], []).append(i)
    share = {t: sum(marks[i] for i in ids) / len(ids) for t, ids in by_text.items()}
    known = {w for t in by_text for w in t.split()}

    def weight(word):
        a = sum(y for t, y in share.items() if word in t.split())
        b = sum(1 - y for t, y in share.items() if word in t.split())
        cells = [x + 0.5 for x in (a, sum(share.values()) - a, b, len(share) - sum(share.values()) - b)]
        sure = math.log(cells[0] * cells[3] / cells[1] / cells[2]) - 2 * math.sqrt(sum(1 / c for c in cells))
        df = sum(word in bag for bag in bags.values())
        return (math.log((len(bags) + 1) / (df + 1)) + 1) * (1 + 10 * max(0, sure))

    weights = {w: weight(w) for w in known}

    def vector(bag):
        v = {w: (1 + math.log(n)) * weights[w] for w, n in bag.items() if w in weights}
        size = math.sqrt(sum(x * x for x in v.values())) or 1
        return {w: x / size for w, x in v.items()}

    examples = [(min(ids), len(ids), share[t], vector(bags[ids[0]])) for t, ids in by_text.items()]
    base = sum(marks.values()) / len(marks)
    for i, bag in bags.items():
        q = vector(bag)
        near = sorted(((sum(x * e[w] for w, x in q.items() if w in e), k, n, y) for k, n, y, e in examples), reverse=True)
        near = [x for x in near if x[0] > 0][:15]
        assert np.allclose(got[i].near_cosines, [x[0] for x in near[:3]]), i
        power = [c / (1 - min(c, 1) + 0.1) * n for c, _, n, _ in near]
        vote = (0.5 * base + sum(p * x[3] for p, x in zip(power, near))) / (0.5 + sum(power))
        assert abs(got[i].score - model.calibrated(vote)) < 1e-9, i
    assert len({tuple(r.near_ids) for r in got.values()}) > 300  # neutral texts have neighbours of their own


def test_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels, wanted=~toxicity.held_out())
    scored = toxicity.score(docs, model).where(toxicity.held_out()).join(labels, "doc_id").select("score", "toxic").collect()
    assert len(scored) > 500
    predicted = np.array([r.score >= 0.3 for r in scored])
    toxic = np.array([r.toxic == 1 for r in scored])
    assert (predicted & toxic).sum() / toxic.sum() >= 0.9
    assert (predicted & toxic).sum() / predicted.sum() >= 0.9
    assert abs(np.mean([r.score for r in scored]) - toxic.mean()) < 0.03  # calibrated


def test_edges(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["alpha", "beta", "gamma"], k=20)) + (" scumbag" if i % 3 == 0 else "")) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "scumbag alpha"), (102, "scumbag " * 200000), (3, rows[3][1])]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, score int, near_ids string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)] + [(3, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert found[102].score > 0.5 > found[101].score == found[100].score
    assert found[None].score > 0.5 and found[1].score < 0.3
    assert found[0].near_ids and all(i % 3 == 0 for i in found[0].near_ids)
    assert toxicity.fit(docs, labels.limit(0)) is None and toxicity.fit(docs.limit(0), labels) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert found[3].score == toxicity.score(docs.where("doc_id = 3"), model).first().score  # repeated rows


def test_ids_do_not_matter(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=4) + ["scum"] * (i % 4 == 0)) for i in range(80)]
    scores = []
    for shift in (0, 1000):
        keys = [(i * 37 + shift) % 5000 for i in range(80)]
        docs = spark.createDataFrame(list(zip(keys, texts)), "doc_id long, text string")
        labels = spark.createDataFrame([(k, int(i % 4 == 0)) for i, k in enumerate(keys)], "doc_id long, toxic int")
        scored = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
        scores.append({r.text: round(r.score, 12) for r in scored})
    assert scores[0] == scores[1]
