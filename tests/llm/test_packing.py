"""Packing as an exact round trip, and the mixture of its windows."""

from __future__ import annotations

import random
from array import array
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stayledger.llm import packing, tokens

PATHS = {"tokenizer": str(public_tokenizers.path("byte_bpe_50k.json")), "ranks": str(public_tokenizers.path("byte_bpe_50k.tiktoken"))}
SCHEMA = "doc_id long, text string, source string, start int, ids string"


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATHS["tokenizer"])
    t.encode_special_tokens = True
    return t


@pytest.mark.parametrize("ranks", [PATHS["ranks"], None])
@pytest.mark.parametrize("stretch", [1 << 20, 7])
def test_parts_give_the_ids_of_whole_texts(monkeypatch, tokenizer, ranks, stretch):
    monkeypatch.setattr(tokens, "STRETCH", stretch)
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    encoder = tokens.Encoder(PATHS["tokenizer"], ranks)
    rng = random.Random(2)
    bits = ["a", "Word", "é", " ", "  ", "\n", " \n", "\t", "'s", "'ll", "9", "12", "½", "Ω", "漢", " ", " ", ".", "!?", "_", "-", "'", "##"]
    bits += ["<|endoftext|>", "\x1c", "\x85", "́", " ", "don't ", "word,", "x\ny", "\U0001f600"]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randrange(16)))
        assert encoder.encode(text) == array("H", tokenizer.encode(text, add_special_tokens=False).ids).tobytes(), repr(text)


def documents(n=400, seed=1):
    rng = random.Random(seed)
    sources = ["big"] * 5 + ["mid", "mid", "small", None]
    rows = [(i, " ".join(rng.choices(["alpha", "beta", "gamma,", "delta\nx"], k=rng.randrange(200))), rng.choice(sources), 1, "x") for i in range(n)]
    return rows + [(5, rows[5][1], rows[5][2], 1, "x"), (None, "no key", "big", 1, "x"), (900, None, None, 1, "x"), (901, "", "small", 1, "x"), (902, "long " * 9000, "mid", 1, "x")]


def check_round_trip(rows, found, tokenizer, length):
    wanted = Counter()
    for i, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        wanted[(i, np.array(ids, "<u4").tobytes())] += 1
    by_doc = defaultdict(list)
    by_sequence = defaultdict(list)
    for r in found:
        assert len(r.ids) == 4 * r.length and r.length > 0
        by_doc[(r.doc_id, r.doc_tokens)].append(r)
        by_sequence[r.sequence_id].append(r)
    got = Counter()
    for (i, _), pieces in by_doc.items():
        copies = sum(p.start == 0 for p in pieces)
        pieces.sort(key=lambda p: p.start)
        if copies == 1:
            at = 0
            for p in pieces:
                assert p.start == at
                at += p.length
            got[(i, b"".join(bytes(p.ids) for p in pieces))] += 1
        else:  # repeated rows: the same tokens as often
            got.update({k: n for k, n in wanted.items() if k[0] == i})
            assert sum(p.length for p in pieces) == copies * pieces[0].doc_tokens
    assert got == wanted
    last = max(by_sequence, default=-1)
    assert sorted(by_sequence) == list(range(last + 1))
    for number, pieces in by_sequence.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == length or (number == last and at < length)


@pytest.mark.parametrize("targets,queues", [(None, 1024), ({"small": 0.5, "mid": 0.3, "big": 0.2}, 1024), (None, 2)])
def test_round_trip_and_mixture(spark, tokenizer, targets, queues):
    rows = documents()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = packing.pack(frame, **PATHS, length=256, grain=32, targets=targets, queues=queues).collect()
    check_round_trip(rows, found, tokenizer, 256)
    if queues == 1024:
        totals = Counter()
        for r in found:
            totals[r.source] += r.length
        total = sum(totals.values())
        weights = {s: (targets or {}).get(s, n / total) for s, n in totals.items()}
        # while all queues last, no source is more than a grain (and what a round is out of step) off
        lasting = min(totals[s] / weights[s] for s in totals) * sum(weights.values())
        sent, slack = Counter(), 32 * (len(totals) + 1)
        for number in range(int(lasting // 256) - 1):
            sent.update({s: 0 for s in totals})
            for r in found:
                if r.sequence_id == number:
                    sent[r.source] += r.length
            for s in totals:
                assert abs(sent[s] - (number + 1) * 256 * weights[s] / sum(weights.values())) <= slack


def test_small_sources_keep_their_targets(spark):
    words = "some words that are packed again and again " * 4
    rows = [(i, words, f"s{i % 40:02d}", 1, "x") for i in range(800)] + [(1000 + i, words, "tiny", 1, "x") for i in range(8)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = packing.pack(frame, **PATHS, length=256, grain=32, targets={"tiny": 10, "s07": 10}, queues=5).collect()
    early = Counter()
    for r in found:
        if r.sequence_id < 2:
            early[r.source] += r.length
    assert abs(early["tiny"] - early["s07"]) <= 64 and early["tiny"] + early["s07"] > 380
    with pytest.raises(ValueError, match="no source: elsewhere"):
        packing.pack(frame, **PATHS, targets={"elsewhere": 1})
    with pytest.raises(ValueError, match="more than 2 queues"):
        packing.pack(frame, **PATHS, targets={"s01": 1, "s02": 1}, queues=2)


def test_empty_and_tiny_tables(spark, tokenizer):
    assert packing.pack(spark.createDataFrame([], SCHEMA), **PATHS).count() == 0
    rows = [(1, None, None, 1, "x")]
    check_round_trip(rows, packing.pack(spark.createDataFrame(rows, SCHEMA), **PATHS).collect(), tokenizer, 2048)
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame(documents(9), SCHEMA), **PATHS, targets={"big": 0, "mid": 0, "small": -1}).count()
