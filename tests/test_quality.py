from __future__ import annotations

import json
import random

from conftest import as_map, as_set
from pyspark.sql import functions as F

from stayledger.operators import constraints, keys, quality
from stayledger.plans import silver


def test_keep_last_and_first(rows):
    data = [("a", "f1", 1), ("a", "f2", 0), ("a", "f1", 9), (None, "f1", 1), (None, "f2", 2), ("b", "f1", 1)]
    df = rows(data, "k string, _source_file string, _row_seq long")
    assert as_set(quality.keep_last(df, ["k"])) == {("a", "f2", 0), (None, "f2", 2), ("b", "f1", 1)}
    assert as_set(quality.keep_first(df, ["k"])) == {("a", "f1", 1), (None, "f1", 1), ("b", "f1", 1)}


def test_keep_last_cuts_before_the_shuffle(rows):
    df = rows([("a", "f1", 1)], "k string, _source_file string, _row_seq long")
    plan = quality.keep_last(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one below and one above the exchange


def test_split_keeps_every_row_once(rows):
    df = rows([(1,), (5,), (None,), (20,)], "v int")
    good, bad = quality.split_rejects(df, [(F.col("v") > 10, "large"), (F.col("v") > 3, "middling")])
    assert as_set(good) == {(1,), (None,)}
    assert as_set(bad) == {(5, "middling"), (20, "large")}


def test_duplicate_members_with_null_keys(rows):
    df = rows([("a", 1), ("a", 2), (None, 3), (None, 4), ("b", 5)], "k string, v int")
    assert as_set(quality.duplicate_members(df, ["k"])) == {("a", 1), ("a", 2), (None, 3), (None, 4)}


def test_versions_and_conflicts(rows):
    df = rows([("a", 1, None), ("a", 1, None), ("b", 1, None), ("b", 1, "x"), ("c", 1, "x")], "k string, p int, q string")
    assert {tuple(r) for r in quality.version_counts(df, ["k"], ["p", "q"]).collect()} == {("a", 2, 1), ("b", 2, 2), ("c", 1, 1)}
    assert as_set(quality.conflicting_keys(df, ["k"], ["p", "q"])) == {("b",)}


def test_evidence_keeps_every_record_whole(rows):
    data = [("hot", f"v{i}" * 3000, None if i % 7 else "y") for i in range(400)] + [("few", "a", None), ("few", "b", "z")]
    df = rows(data, "k string, p string, q string")
    found = sorted(tuple(r) for r in quality.evidence(df, "k", ["p", "q"]).collect())
    assert found == sorted((k, json.dumps({"p": p, "q": q}, separators=(",", ":"))) for k, p, q in data)


def test_most_frequent(rows):
    df = rows([("a", "y"), ("a", "x"), ("b", None), ("b", "z"), ("c", "q"), ("c", "p"), ("c", "q")], "k string, v string")
    assert as_map(quality.most_frequent(df, "k", "v", "m"), "k", "m") == {"a": "x", "b": "z", "c": "q"}


def test_contested_winners(rows):
    data = [
        ("r1", "m1", "c1", "f", 1), ("r1", "m2", "c2", "f", 2), ("r1", "m2", "c1", "f", 3), ("r1", "m3", "c1", "f", 4),
        ("r2", "m1", "c5", "f", 6), ("r2", "m1", "c6", "f", 5),  # tie: the smaller value is the usual one
        ("r3", "m1", None, "f", 8), ("r3", "m1", None, "f", 7),
        (None, "m1", "c1", "f", 9), (None, "m1", "c1", "f", 10),
    ]
    df = rows(data, "r string, m string, c string, _source_file string, _row_seq long")
    found = quality.contested_winners(df, "r", "m", "c").select("r", "m", "_winner._row_seq")
    assert as_set(found) == {("r1", "m2", 3), ("r2", "m1", 6), ("r3", "m1", 7)}


def test_not_in(rows):
    df = rows([(1,), (2,), (None,)], "k int")
    banned = lambda values: rows([(v,) for v in values], "b int")
    assert as_set(keys.not_in(df, "k", banned([1]), "b")) == {(2,)}
    assert as_set(keys.not_in(df, "k", banned([1, None]), "b")) == set()
    assert as_set(keys.not_in(df, "k", banned([]), "b")) == {(1,), (2,), (None,)}


def test_latest(rows):
    df = rows([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, p int, v string")
    assert as_set(keys.latest_per_key(df, "k", "p")) == {("a", 2, "y"), ("b", 1, "z")}
    assert as_set(keys.latest_snapshot(df, "p")) == {("a", 2, "y")}


def test_constraints(rows):
    df = rows([("a", "d1"), ("a", None), ("b", "d9"), ("c", "d9")], "k string, d string")
    dim = rows([("d1",)], "d string")
    assert as_set(constraints.duplicate_keys(df, ["k"])) == {("a", 2)}
    assert as_set(constraints.missing_references(df, "d", dim, "d")) == {("d9", 2)}
    assert as_set(constraints.orphan_rows(df, "d", dim, "d")) == {("d9", 2), (None, 1)}
    assert as_map(constraints.null_counts(df, ["k", "d"]), "column_name", "n") == {"k": 0, "d": 1}
    money = rows([(1.5,), (1e9,), (None,)], "v double")
    assert as_set(constraints.decimal_misfits(money, "v", 10, 2)) == {(1e9,)}


def test_validate_then_dedup_lets_an_earlier_good_copy_survive(rows):
    schema = "incident_id string, resident_id string, community_id string, incident_date string, incident_type string, " \
             "severity string, reported_by string, _source_file string, _row_seq long"
    df = rows([
        ("I1", "R", "C", "2025-01-01", "Fall", "3", "E", "f1", 1), ("I1", "R", "C", "2025-01-01", "Fall", "7", "E", "f2", 2),
    ], schema)
    done = silver.clean_incidents(df)
    assert [r.severity for r in done.rows.collect()] == [3.0]
    assert [r.business_key for r in done.quarantine.collect()] == ["I1"]


def test_good_and_rejected_cover_the_input(rows):
    rng = random.Random(9)
    schema = "shift_id string, community_id string, employee_id string, role string, shift_date string, " \
             "hours_worked string, hourly_rate string, _source_file string, _row_seq long"
    data = [
        (f"S{i}", "C", "E", rng.choice(["RN", "Cook"]), "2025-01-01", rng.choice(["8", "0", "16", "16.5", "-1", "x", None]),
         rng.choice(["{'RN': 40}", "12.5", "NaN", None, "{bad"]), "f", i)
        for i in range(300)
    ]
    done = silver.clean_shifts(rows(data, schema))
    assert done.rows.count() + done.quarantine.count() == 300
