"""Prompts, completions and masks against plain Python."""

from __future__ import annotations

import random

from stayledger.llm import chat

SCHEMA = "pair_id long, turn long, role string, text string, start int"


def plain(chosen, rejected):
    def tidy(rows):
        out = {}
        for p, t, role, text, *_ in rows:
            if p is not None and t is not None:
                said = (role or "", text or "")
                out.setdefault(p, {})[t] = min(said, out.get(p, {}).get(t, said))
        return out

    a, b, out = tidy(chosen), tidy(rejected), []
    for p in a.keys() | b.keys():
        c, r = a.get(p, {}), b.get(p, {})
        turns = sorted(c.keys() | r.keys())
        fork = next((t for t in turns if c.get(t) != r.get(t)), None)
        parts = {"prompt": [(t, c[t]) for t in turns if fork is None or t < fork]}
        for part, side in (("chosen", c), ("rejected", r)):
            parts[part] = [(t, side[t]) for t in turns if fork is not None and t >= fork and t in side]
        for part, said in parts.items():
            at = 0
            for t, (role, text) in said:
                segment = f"<|{role}|>\n{text}<|end|>\n"
                learnt = (at + len(role) + 5, at + len(segment)) if part != "prompt" and role == "assistant" else (None, None)
                out.append((p, part, t, role, segment, at, at + len(segment), *learnt))
                at += len(segment)
    return sorted(out, key=repr)


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for p in range(25):
        for t in range(rng.randrange(6)):
            rows.append((p, t, rng.choice(["user", "assistant", None]), rng.choice(["x", "yé\U0001f600", "", None]), 1))
    rows += rng.sample(rows, 5) + [(None, 0, "user", "x", 1), (3, None, "user", "x", 1), (4, 1, "user", "other", 1)]
    return rows


def test_pairs(spark, monkeypatch):
    monkeypatch.setattr(chat, "STRETCH", 2)
    for seed in range(3):
        a, b = conversations(seed), conversations(seed + 50)
        b = [x for x in a if x[0] is not None and x[0] % 2 and (x[1] or 0) < 2] + [x for x in b if x[0] is None or not x[0] % 2 or (x[1] or 0) >= 2]
        got = chat.preferences(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)).collect()
        assert sorted((tuple(r) for r in got), key=repr) == plain(a, b)


def test_empty_tables_and_equal_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([(1, 0, "user", "hi", 0), (1, 1, "assistant", "yes", 0)], SCHEMA)
    assert chat.preferences(none, none).count() == 0
    assert {r.part for r in chat.preferences(one, one).collect()} == {"prompt"}
    assert {r.part for r in chat.preferences(one, none).collect()} == {"chosen"}


def test_swapped_replies(spark):
    rows = [(2, 0, "user", "q"), (2, 1, "assistant", "a"), (2, 2, "user", "later"), (3, 0, "assistant", "b"), (4, 0, "user", "no reply"), (8, 0, "assistant", "c")]
    chosen, rejected = chat.swapped_replies(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert sorted(tuple(r) for r in chosen.collect()) == [(2, 0, "user", "q"), (2, 1, "assistant", "a"), (3, 0, "assistant", "b"), (8, 0, "assistant", "c")]
    found = sorted((r.pair_id, r.turn, r.role, r.text or "") for r in rejected.collect())
    assert found == [(2, 0, "user", "q"), (2, 1, "assistant", "b"), (3, 0, "assistant", "a"), (8, 0, "assistant", "")]
