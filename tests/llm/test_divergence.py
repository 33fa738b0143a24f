"""Term counts and divergences against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stayledger.llm import divergence
from stayledger.llm.oracles import _TERMS

TERM = re.compile(_TERMS)
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def plain(rows, min_docs=10, top=10):
    """rows: (lang, source, text)."""
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = Counter(TERM.findall((text or "").translate(LOWER)))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(terms.keys())
    out = set()
    for lang in docs:
        kept = sorted((t for t, n in docs[lang].items() if n >= min_docs), key=lambda t: t.encode())
        mine = {s: counts[lang, s] for own, s in counts if own == lang}

        def share(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: share(c) for s, c in mine.items()}
        q = share(sum(mine.values(), Counter()))
        apart = lambda a, b: (a - b) ** 2 // (a + b)
        for s in mine:
            pairs = [(sum(apart(p[s][t], p[o][t]) for t in kept), o) for o in mine if o != s]
            terms = [(apart(p[s][t], q[t]), t) for t in kept if mine[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(found) if part == "pair" or i < top}
    return out


def sample(seed: int, n: int):
    rnd = random.Random(seed)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(8) for j in range(8)] + ["Ünï", "日本", "É"]
    rows = []
    for _ in range(n):
        lang, source = rnd.choice(["de", "en", "en", None]), rnd.choice(["web", "web", "web", "mail", "é", None])
        chosen = rnd.choices(words, k=rnd.randrange(30)) + rnd.choices(words[:3], k=3)
        rows.append((lang, source, rnd.choice([" ", "\n", "1"]).join(chosen) if rnd.random() > 0.1 else rnd.choice([None, "", "12 34"])))
    return rows


def found(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, source string, text string, term int, `a b` string")
    result = divergence.audit(docs, **options)
    assert result.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in result.collect())


@given(st.text("aBz \n0@[`{é İ日", max_size=40))
def test_terms(text):
    assert {t.decode(): n for t, n in divergence.document_terms(text.encode()).items()} == Counter(TERM.findall(text.translate(LOWER)))


def test_audit(spark):
    rows = sample(1, 400)
    rows += rows[:20] + [("xx", "lonely", "one text only")] + [("yy", s, None) for s in "abc"]
    assert found(spark, rows) == sorted(plain(rows))


def test_small_blocks_and_flushes(spark, monkeypatch):
    rows = sample(2, 150)
    for name, value in (("LEAST_CELLS", 1), ("MOST_CELLS", 7), ("PAIRS", 3)):
        monkeypatch.setattr(divergence, name, value)
    assert found(spark, rows, min_docs=3, top=4) == sorted(plain(rows, 3, 4))
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    whole = sorted(tuple(r) for r in divergence.term_counts(docs).collect())
    monkeypatch.setattr(divergence, "HELD", 5)
    batches = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")], F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    parts = Counter()
    for batch in divergence._count(iter(batches.toArrow().to_batches())):
        for r in batch.to_pylist():
            parts[r["lang"], r["source"], r["term"]] += complex(r["n"], r["docs"])
    assert sorted((*k, int(v.real), int(v.imag)) for k, v in parts.items()) == whole


def test_long_texts_and_empty_tables(spark):
    rows = [("en", "a", "alpha Beta " * 200_000), ("en", "b", "alpha")] * 10
    assert found(spark, rows) == sorted(plain(rows))
    empty = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.audit(empty).count() == 0


def test_counts_beyond_longs(spark):
    big = spark.createDataFrame([(4 * 10**18, 9 * 10**18, 5)], "n long, total long, size long")
    assert big.select(divergence.share(F.col("n"), F.col("total"), F.col("size")).alias("p")).first().p == 1 + 10**9 * (4 * 10**18 + 2) // (9 * 10**18 + 10)
