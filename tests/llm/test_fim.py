"""Boundary sets against plain lists, and cut texts against the regular expression."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stayledger.llm import fim

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_ends(text: str) -> list[int]:
    return [len(text[: m.end()].encode()) for m in TOKEN.finditer(text)]


def plain_cut(key: str, text: str):
    h = hashlib.sha256(f"42:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    tokens = TOKEN.findall(text)
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 80:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize(
    ("low", "kind"),
    [
        (np.arange(0, 65536, 300), fim.ArrayContainer),
        (np.arange(0, 65536, 2), fim.BitmapContainer),
        (np.concatenate((np.arange(5, 9000), np.arange(20000, 65536))), fim.RunContainer),
        (np.array([0]), fim.ArrayContainer),
        (np.array([65535]), fim.ArrayContainer),
        (np.arange(65536), fim.RunContainer),
    ],
)
def test_containers(low, kind):
    held = fim.container(low)
    assert isinstance(held, kind)
    assert [held.select(k) for k in range(len(low))] == low.tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1 << 18), st.integers(1, 9000), st.integers(1, 3)), max_size=6))
def test_sets_of_all_kinds(spans):
    values = sorted({x for start, n, step in spans for x in range(start, start + n * step, step)})
    held, array = fim.BoundarySet(), np.array(values, np.int64)
    for high in sorted({v >> 16 for v in values}):
        held.add(high, array[array >> 16 == high] & 0xFFFF)
    assert len(held) == len(values)
    assert [held.select(k) for k in range(0, len(values), 97)] == values[::97]


@settings(max_examples=200, deadline=None)
@given(st.text("ab \t\né \U0001f600", max_size=60))
def test_boundaries(text):
    ends = fim.boundaries(text.encode())
    assert [ends.select(k) for k in range(len(ends))] == plain_ends(text)


@pytest.mark.parametrize("size", [65535, 65536, 65537, 131072])
def test_boundaries_at_chunk_ends(size):
    for text in ("x" * size, "x" * (size - 1) + " ", "x" * (size - 1) + " y", "a " * (size // 2), " " * size, "é " * (size // 3)):
        ends = fim.boundaries(text.encode())
        assert [ends.select(k) for k in range(len(ends))] == plain_ends(text)


def test_transform_and_back(spark):
    marks = ["<P>", "a <S> b", "x<M", "<P", "S>", "<S", "<", "tail <"]
    texts = [None, "", "   ", "one", "two words", "é    ü\n", *marks] + [f"{m} word{i} of <{i}>\tand  more " for i in range(40) for m in ("<", "M>", "")]
    rows = [(i, t, "kept", 7) for i, t in enumerate(texts)] + [(3, "one", "kept", 7), (None, "no key at all", "kept", 7), (5, "long " * 300_000, "kept", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a b` string, Form int")
    made = fim.transform(docs).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    assert made.columns == ["doc_id", "text", "a b", "n", "form", "prefix_chars", "middle_chars", "output", "back"]
    forms = set()
    for r in made.collect():
        key, text = "" if r.doc_id is None else str(r.doc_id), r.text or ""
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_cut(key, text)
        assert r.back == text and r["a b"] == "kept"
        forms.add(r.form)
    assert forms == {"plain", "psm", "spm"}
    assert fim.transform(docs.limit(0)).count() == 0
    assert {r.form for r in fim.transform(docs, rate=0).collect()} == {"plain"}
