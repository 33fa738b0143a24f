"""Fingerprints, links and groups against plain Python."""

from __future__ import annotations

import random

import pytest
import xxhash

from stayledger.llm import simhash
from stayledger.llm.components import components


def plain_fingerprint(text, shingle=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, bits=2):
    distinct = sorted(set(prints))
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if bin(a ^ b).count("1") <= bits:
                root[find(a)] = find(b)
    return {p: find(p) for p in distinct}


TEXTS = ["", None, "  \n ", "One", "One two", "ONE Two three", "a b c d a b c d a b c", "é È ñ \xa0 x", "k" * 5000 + " x y z w"]


@pytest.mark.parametrize("size", [1 << 20, 16])
def test_fingerprint(monkeypatch, size):
    monkeypatch.setattr(simhash.slices, "__defaults__", (size,))
    rng = random.Random(3)
    words = ["Lo", "rem", "ip\tsum", "do\x0blor", "sit", "Ünï", "\x1c"]
    texts = TEXTS + [" ".join(rng.choices(words, k=rng.randrange(40))) for _ in range(60)]
    for text in texts:
        for shingle in (1, 3, 5):
            assert simhash.fingerprint_of((text or "").encode(), shingle) == plain_fingerprint(text, shingle)


@pytest.mark.parametrize("bits,segments,hot", [(2, 5, 256), (2, 5, 1), (2, 3, 256), (1, 4, 2), (3, 7, 3)])
def test_links_are_complete_and_single(spark, bits, segments, hot):
    rng = random.Random(bits * 10 + segments)
    prints = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(15):
            p = base
            for b in rng.sample(range(64), rng.randrange(4)):
                p ^= 1 << b
            prints.add(p - (1 << 64) if p >= 1 << 63 else p)
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = [tuple(r) for r in simhash.links(frame, bits, segments, hot).collect()]
    near = {(a, b) for a in prints for b in prints if a < b and bin((a ^ b) & ((1 << 64) - 1)).count("1") <= bits}
    assert len(found) == len(set(found))
    assert set(found) == near


def test_components_of_a_path_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 500)]
    found = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_with_nulls_repeats_and_clashing_columns(spark):
    rng = random.Random(5)
    base = [" ".join(rng.choices("abcdefghij", k=60)) for _ in range(6)]
    rows = [(i, base[i % 6] + (" z" if i % 4 == 0 else "")) for i in range(30)]
    rows += [(3, rows[3][1]), (None, base[0]), (None, "alone and without a key"), (90, None), (91, ""), (92, " \n")]
    frame = spark.createDataFrame([(i, t, 7, "x", 1.5) for i, t in rows], "doc_id long, text string, fp int, component_id string, fingerprint double")
    found = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(frame).collect()]
    prints = [plain_fingerprint(t) for _, t in rows]
    groups = plain_groups(prints)
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[groups[p]] = min(i, least.get(groups[p], i))
    wanted = [(i, f"{p:016x}", least.get(groups[p])) for (i, _), p in zip(rows, prints)]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    kept = simhash.representatives(frame).collect()
    assert sorted(kept[0].asDict()) == sorted(frame.columns)
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(least.values())
    assert len(kept) == len(set(groups.values()))


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(frame).count() == 0
    assert simhash.representatives(frame).count() == 0
