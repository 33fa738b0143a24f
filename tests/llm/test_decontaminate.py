"""Wu-Manber search against plain comparison of all windows."""

from __future__ import annotations

import random
import re

import pytest

from stayledger.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, window=10):
    out = []
    for i, text in docs:
        w, hit, ids = words(text), set(), set()
        for item, body in items:
            b = words(body)
            length = min(window, len(b))
            for at in range(len(b) - length + 1) if length else ():
                for start in range(len(w) - length + 1):
                    if w[start : start + length] == b[at : at + length]:
                        hit.update(range(start, start + length))
                        if item is not None:
                            ids.add(str(item))
        out.append((i, len(w), len(hit), sorted(ids), bool(hit)))
    return sorted(out, key=repr)


def sample(seed):
    rng = random.Random(seed)
    some = lambda n: " ".join(rng.choices(["a", "B", "é", "c1"], k=n))
    items = [(k, some(rng.randrange(0, 14))) for k in range(8)] + [(None, "q r s"), (77, None), (78, " ?! "), (3, "only one")]
    docs = [(k, some(rng.randrange(0, 60))) for k in range(30)]
    docs += [(40, "x " + items[5][1] + ", y " + items[6][1]), (41, None), (42, ""), (42, ""), (None, items[4][1]), (43, "q-r_s. ONLY/one")]
    return docs, items


@pytest.mark.parametrize("seed,block,size", [(1, 1 << 20, 1 << 20), (2, 1, 1 << 20), (3, 30, 12)])
def test_all_occurrences(spark, monkeypatch, seed, block, size):
    monkeypatch.setattr(decontaminate.slices, "__defaults__", (size,))
    docs, items = sample(seed)
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, spans int, n_words string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for window in (4, 10):
        got = decontaminate.find(frame, bench, window=window, block_bytes=block).collect()
        found = [(r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in got]
        assert sorted(found, key=repr) == plain(docs, items, window)
        assert all(r.n_items == len(r["items"]) for r in got)


def test_slices_of_very_long_texts():
    docs, items = sample(4)
    text = " ".join(t for _, t in docs if t) * 40
    searchers = decontaminate.build_tables([(str(i), (t or "").encode()) for i, t in items], 10)
    whole = decontaminate.search_text(text.encode(), searchers)
    assert whole[0] == len(words(text))
    old = decontaminate.slices.__defaults__
    try:
        decontaminate.slices.__defaults__ = (37,)
        assert decontaminate.search_text(text.encode(), searchers) == whole
    finally:
        decontaminate.slices.__defaults__ = old


def test_pieces_hold_each_window_once():
    rng = random.Random(5)
    for n in (0, 1, 3, 4, 5, 11, 40):
        body = [str(rng.randrange(9)) + str(i) for i in range(n)]
        pieces = [p.split() for p in decontaminate.cut(" ".join(body).encode(), 4, 3)]
        windows = [p[i : i + 4] for p in pieces for i in range(max(1, len(p) - 3))]
        wanted = [body[i : i + 4] for i in range(max(min(n, 1), n - 3))]
        assert [[w.decode() for w in x] for x in windows] == wanted


def test_many_blocks_one_at_a_time(spark, monkeypatch):
    """Twenty or more blocks, items in pieces, a window that many items share, columns with the names of
    added ones: as the plain search, and a worker holds one block's tables."""
    monkeypatch.setattr(decontaminate, "PIECE", 3)
    rng = random.Random(6)
    some = lambda n: " ".join(f"w{rng.randrange(40)}" for _ in range(n))
    items = [(k, some(rng.randrange(5, 30))) for k in range(60)]
    items += [(100 + k, "one two three four " + some(2)) for k in range(20)] + [items[0], (None, items[1][1])]
    docs = [(k, " ".join(w for _, t in rng.sample(items, 3) for w in t.split()[: rng.randrange(9)])) for k in range(40)]
    docs += [(50, "x one two three four y"), (50, "x one two three four y"), (51, None), (52, " ".join(t for _, t in items))]
    frame = spark.createDataFrame([(i, t, 7, "x") for i, t in docs], "doc_id long, text string, __row int, items string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    sizes = []
    whole = decontaminate.sent
    monkeypatch.setattr(decontaminate, "sent", lambda block: sizes.append(block.count()) or whole(block))
    found = decontaminate.find(frame, bench, window=4, block_bytes=330)
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in found.collect()]
    assert sorted(got, key=repr) == plain(docs, items, 4)
    assert found.columns == ["doc_id", "text", "__row", "n_words", "spans", "items", "n_hit", "n_items", "contaminated"]
    assert len(sizes) >= 20 and max(sizes) < 0.3 * sum(sizes)
    decontaminate.HELD.clear()
    for name in ("a", "b"):
        decontaminate.held(name, type("Block", (), {"value": [("1", b"a b c d")]}), 4)
    assert list(decontaminate.HELD) == ["b"]


def test_clean_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", 9, "s"), (2, None, 8, "t"), (3, "q", 7, "u")], "doc_id long, text string, n_words int, spans string")
    bench = spark.createDataFrame([(1, "b"), (2, "zz")], "item_id long, text string")
    for size in (1, 1 << 20):
        kept = decontaminate.clean(docs, bench, block_bytes=size)
        assert sorted(map(tuple, kept.collect())) == [(2, None, 8, "t"), (3, "q", 7, "u")]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    row = decontaminate.find(docs, none).first()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (2, 0, 0, False)
    assert decontaminate.find(docs.limit(0), none).count() == 0
    assert decontaminate.clean(docs, none).columns == ["doc_id", "text"]
