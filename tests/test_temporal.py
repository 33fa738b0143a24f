"""Interval operators against brute force over random inputs."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter
from itertools import combinations

import pytest
from conftest import as_map, as_set
from pyspark.sql import functions as F

from stayledger import model
from stayledger.operators import constraints, temporal
from stayledger.operators.keys import dense_key

BASE = dt.date(2024, 1, 1)


def on(n):
    return None if n is None else BASE + dt.timedelta(days=n)


def random_stays(rng, n=60, span=120):
    data = []
    for i in range(n):
        admit = rng.choice([None, *range(span)]) if rng.random() < 0.1 else rng.randrange(span)
        out = None if admit is None or rng.random() < 0.3 else admit + rng.randrange(40)
        data.append((f"r{i}", f"c{i % 3}", on(admit), on(out), rng.choice(["IL", "AL", None])))
    return data


STAYS = "resident_id string, community_id string, admit_date date, discharge_date date, care_level string"


def days_of(stay, start, end):
    _, _, admit, out, _ = stay
    if admit is None:
        return []
    days = [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]
    return [d for d in days if admit <= d and (out is None or out > d)]


def test_census(rows):
    stays = random_stays(random.Random(1))
    start, end = on(25), on(95)
    df = rows(stays, STAYS)
    wanted = {}
    for s in stays:
        for d in days_of(s, start, end):
            key = (d.replace(day=1), s[1])
            wanted[key] = wanted.get(key, 0) + 1
    monthly = temporal.monthly_census(df, start.isoformat(), end.isoformat())
    assert {(r.month_start, r.community_id): r.resident_days for r in monthly.collect()} == wanted
    total = temporal.stay_days(df, start.isoformat(), end.isoformat()).first()[0]
    assert total == sum(wanted.values())


def random_history(rng, stays):
    history, seen = [], set()
    for rid, *_ in stays:
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            row = (rid, on(rng.choice([None, *range(0, 140, 7)])), rng.choice([None, "IL", "AL"]),
                   rng.choice([None, "IL", "AL", "MC"]), rng.choice(["x", "y"]))
            if (row[0], row[1], row[3]) not in seen:
                seen.add((row[0], row[1], row[3]))
                history.append(row)
    history.append(("stranger", on(3), None, "IL", "x"))
    return history


HISTORY = "resident_id string, change_date date, previous_level string, new_level string, reason string"


def expected_ranges(stays, history):
    """Ranges by the written rules; ties ordered by date, level and reason."""
    found = []
    known = {s[0]: s for s in stays}
    far = dt.date(9999, 1, 1)
    for rid, (_, _, admit, out, level) in known.items():
        mine = sorted(
            (h for h in history if h[0] == rid), key=lambda h: (h[1] or far, h[3] or "", h[2] or "", h[4])
        )
        events = [(h[1], h[3], h[4]) for h in mine if h[1] is not None and h[3] is not None]
        if mine and mine[0][2] is not None and mine[0][1] is not None and admit is not None and admit < mine[0][1]:
            events.append((admit, mine[0][2], model.REASON_ANCHOR))
        if not mine and level is not None:
            events.append((admit, level, model.REASON_NO_HISTORY))
        events.sort(key=lambda e: (e[0] or far, e[1], e[2]))
        for i, (since, held, why) in enumerate(events):
            later = events[i + 1][0] if i + 1 < len(events) else None
            upto = later - dt.timedelta(days=1) if later is not None else out
            found.append((rid, held, since, upto, later is None, why))
    return found


def test_level_ranges(rows):
    rng = random.Random(5)
    stays = random_stays(rng)
    history = random_history(rng, stays)
    built = temporal.level_ranges(rows(history, HISTORY), rows(stays, STAYS))
    assert sorted(map(tuple, built.collect()), key=repr) == sorted(expected_ranges(stays, history), key=repr)


def test_history_without_resident_blocks_unchanged_levels(rows):
    stays = rows([("a", "c", on(0), None, "IL"), ("b", "c", on(0), None, "IL")], STAYS)
    plain = rows([("a", on(9), "IL", "AL", "x")], HISTORY)
    assert temporal.level_ranges(plain, stays).count() == 3
    with_null = rows([("a", on(9), "IL", "AL", "x"), (None, on(9), "IL", "AL", "x")], HISTORY)
    assert as_set(temporal.level_ranges(with_null, stays).select("resident_id").distinct()) == {("a",)}
    none = rows([], HISTORY)
    assert temporal.level_ranges(none, stays).count() == 2


def test_census_days_carry_the_level_of_the_day(rows):
    rng = random.Random(8)
    stays = random_stays(rng)
    history = random_history(rng, stays)
    start, end = on(20), on(100)
    dim = temporal.scd2(rows(history, HISTORY), rows(stays, STAYS))
    keyed = [tuple(r) for r in dim.collect()]
    assert sorted(r[0] for r in keyed) == list(range(1, len(keyed) + 1))
    wanted = set()
    for s in stays:
        for d in days_of(s, start, end):
            held = [r for r in keyed if r[1] == s[0] and r[3] is not None and r[3] <= d and (r[4] is None or d <= r[4])]
            wanted |= {(d, s[0], s[1], r[0], r[2]) for r in held} or {(d, s[0], s[1], None, None)}
    segments = temporal.census_segments(rows(stays, STAYS), dim, start.isoformat(), end.isoformat())
    days = temporal.census_days(segments)
    assert days.count() == len(wanted) and as_set(days) == wanted
    looked_up = temporal.as_of(
        days.select("date_key", "resident_id"), dim, "resident_id", F.col("date_key"), ["care_level"]
    )
    assert as_set(looked_up) == {(d, r, level) for d, r, _, _, level in wanted}


def test_prorate(rows):
    rng = random.Random(2)
    leases = [
        (f"L{i}", f"r{i % 9}", "u", "c", on(a), None if rng.random() < 0.3 else on(a + rng.randrange(60)), rng.randrange(1000, 9000) / 1.0)
        for i in range(60)
        for a in [rng.randrange(150)]
    ]
    leases += [("Lx", "r", "u", "c", on(5), None, None), ("Ly", "r", "u", "c", None, on(5), 10.0)]
    schema = "lease_id string, resident_id string, unit_id string, community_id string, move_in_date date, " \
             "move_out_date date, monthly_rate double"
    start, end = on(40), on(100)  # both inside a month: whole months count
    months, m = [], start.replace(day=1)
    while m <= end:
        following = (m + dt.timedelta(days=32)).replace(day=1)
        months.append((m, following - dt.timedelta(days=1)))
        m = following
    wanted = set()
    for lid, _, _, _, a, b, rate in leases:
        if a is None or rate is None:
            continue
        for first, last in months:
            if a <= last and (b is None or b > first):
                active = (min(b - dt.timedelta(days=1), last) if b else last) - max(a, first)
                n = (last - first).days + 1
                wanted.add((first, lid, active.days + 1, n, round(rate * (active.days + 1) / n, 2)))
    found = temporal.prorate(rows(leases, schema), start.isoformat(), end.isoformat())
    assert as_set(found.select("month_start", "lease_id", "active_days", "days_in_month", "revenue")) == wanted


def test_overlap_pairs(rows):
    """Counts equal pairing, for half-open and closed ranges, with empty, reversed and open ones."""
    rng = random.Random(11)
    data = []
    for i in range(150):
        a = rng.randrange(40)
        b = rng.choice([None, a, a + 1, a + rng.randrange(15), a - rng.randrange(1, 12)])
        data.append((f"k{rng.randrange(4)}" if i else None, i, on(rng.choice([a, a, a, a])), on(b)))
    data.append(("k0", 999, None, on(3)))
    df = rows(data, "k string, id int, s date, e date")
    far = dt.date(2099, 1, 1)
    for closed in (False, True):
        wanted = {}
        for x, y in combinations([d for d in data if d[2] is not None and d[0] is not None], 2):
            if x[0] != y[0]:
                continue
            (xs, xe), (ys, ye) = (x[2], x[3] or far), (y[2], y[3] or far)
            if (xs <= ye and ys <= xe) if closed else (xs < ye and ys < xe):
                wanted[x[0]] = wanted.get(x[0], 0) + 1
        found = temporal.overlap_pairs(df, "k", "s", "e", closed=closed)
        assert as_map(found, "k", "pairs") == wanted


def test_steepest_rise(rows):
    rng = random.Random(4)
    snaps = [
        (f"k{k}", on(30 * m), float(rng.randrange(1, 11)) if rng.random() < 0.9 else None)
        for k in range(12)
        for m in range(12)
    ]
    wanted = set()
    for key in {s[0] for s in snaps}:
        mine = [s for s in snaps if s[0] == key and s[2] is not None]
        pairs = [
            (-(b[2] - a[2]), b[1], a[1], a[2], b[2])
            for a in mine
            for b in mine
            if a[1] < b[1] <= a[1] + dt.timedelta(days=90) and b[2] - a[2] >= 2
        ]
        if pairs:
            drop, to, since, low, high = min(pairs)
            wanted.add((key, since, low, to, high, -drop))
    df = rows(snaps, "k string, m date, score double")
    assert as_set(temporal.steepest_rise(df, "k", "m", "score")) == wanted


def test_dense_key(rows):
    rng = random.Random(6)
    data = [(rng.choice("abc"), rng.randrange(1000), i) for i in range(500)]
    found = dense_key(rows(data, "a string, b int, i int").repartition(7), ["a", "b", "i"], "key")
    assert [tuple(r) for r in found.orderBy("key").collect()] == [(n + 1, *d) for n, d in enumerate(sorted(data))]


def test_analysis_window(rows):
    months = rows([(dt.date(2025, 2, 1),), (dt.date(2025, 4, 1),)], "m date")
    assert tuple(temporal.analysis_window(months, "m").first()) == (dt.date(2025, 2, 1), dt.date(2025, 4, 30))
    assert tuple(temporal.analysis_window(rows([], "m date"), "m").first()) == (dt.date(2025, 1, 1), dt.date(2025, 6, 30))


def test_reversed_month_spans_are_empty(rows):
    spans = rows([(on(40), on(3)), (None, on(3)), (on(3), on(3))], "a date, b date")
    assert as_set(temporal.explode_months(spans, "a", "b")) == {(on(3), on(3), BASE)}


def test_sorted_lookup_with_a_hot_key(spark, rows):
    rnd = random.Random(3)
    start = dt.date(2000, 1, 1)
    spans, facts = [], []
    for key, n in (("hot", 1500), ("a", 5), ("b", 1), ("c", 0)):
        at = 0
        for i in range(n):
            at += rnd.randrange(1, 4)
            length = rnd.randrange(0, 2)
            spans.append((key, start + dt.timedelta(at), start + dt.timedelta(at + length) if rnd.random() < 0.9 or i < n - 1 else None, f"{key}{i}"))
            at += length
        spans.append((key, start + dt.timedelta(at + 9), start + dt.timedelta(at), "reversed"))
    spans += [(None, start, None, "no key"), ("a", None, None, "no start")]
    for i in range(3000):
        key = rnd.choice(["hot", "hot", "hot", "a", "b", "c", "other", None])
        facts.append((i // 2, key, None if rnd.random() < 0.02 else start + dt.timedelta(rnd.randrange(-3, 4500))))
    ranges = rows(spans, "k string, effective_from date, effective_to date, level string")
    asked = rows(facts, "id int, k string, d date").repartition(7)
    join = ranges.select(F.col("k").alias("resident_id"), "effective_from", "effective_to", "level")
    wanted = temporal.as_of(asked, join, "k", F.col("d"), ["level"])
    found = temporal.as_of_sorted(asked, ranges, "k", F.col("d"), ["level"])
    assert found.columns == wanted.columns == ["id", "k", "d", "level"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, wanted.collect()), key=repr)


@pytest.mark.parametrize("closed", [False, True])
def test_overlap_witnesses_and_repeated_days(rows, closed):
    rnd = random.Random(5)
    start = dt.date(2020, 1, 1)
    spans = []
    for i in range(400):
        s = rnd.randrange(0, 4000)
        spans.append((rnd.choice(["hot", "hot", "hot", "a", "b", "c"]), i, start + dt.timedelta(s), start + dt.timedelta(s + rnd.randrange(-1, 25))))
    spans += [("a", 900, start + dt.timedelta(3990), None), ("b", 901, None, start), (None, 902, start, None)]
    df = rows(spans, "k string, id int, s date, e date")
    found = {(r.k, r.id): r.witness for r in temporal.overlap_witnesses(df, "k", "id", "s", "e", closed).collect()}
    far, extra = dt.date(2099, 1, 1), dt.timedelta(1 if closed else 0)
    usable = [(k, s, (e or far) + extra, i) for k, i, s, e in spans if k and s and s < (e or far) + extra]
    wanted = {}
    for k, s, e, i in usable:
        earlier = [(e2, i2) for k2, s2, e2, i2 in usable if k2 == k and (s2, e2, i2) < (s, e, i) and e2 > s]
        if earlier:
            wanted[k, i] = max(earlier)[1]
    assert found == wanted and len(wanted) > 20
    pieces = df.filter("s <= e").select("k", F.col("s").alias("seg_start"), F.col("e").alias("seg_end"))
    days = Counter((k, s + dt.timedelta(n)) for k, _, s, e in spans if k and s and e for n in range((e - s).days + 1))
    twice = Counter(k for (k, _), n in days.items() if n > 1)
    assert {r.k: r.days for r in temporal.repeated_days(pieces, "k").collect() if r.k} == twice


def test_pairs_are_counted_in_whole_numbers(rows):
    day = dt.date(2020, 1, 1)
    one = rows([("a", day, day + dt.timedelta(5))], "k string, s date, e date")
    plan = temporal.overlap_pairs(one, "k", "s", "e")._jdf.queryExecution().optimizedPlan().toString()
    assert " div 2" in plan and "as double" not in plan


def test_daily_key_is_proven_on_segments(rows):
    day = dt.date(2020, 1, 1)
    seg = "resident_id string, community_id string, seg_start date, seg_end date, care_level_key long, care_level string"
    good = [("R1", "C1", day, day + dt.timedelta(3), 1, "IL"), ("R1", "C1", day + dt.timedelta(4), day + dt.timedelta(9), 2, "AL")]
    stars = {
        "dim_date": rows([(day + dt.timedelta(i), *[1] * 4, "x", 1, "y", False) for i in range(30)], "date_key date, year int, quarter int, month int, day int, month_name string, week int, day_name string, is_weekend boolean"),
        "dim_community": rows([("C1", "n", "s", "r")], "community_id string, community_name string, state string, region string"),
        "dim_resident": rows([("R1", "C1")], "resident_id string, community_id string"),
        "dim_resident_care_level": rows([(i, "R1", "IL", day, True) for i in (1, 2)], "care_level_key long, resident_id string, care_level string, effective_from date, is_current boolean"),
    }

    def broken(pieces):
        segments = rows(pieces, seg)
        days = temporal.census_days(segments)
        needed = {**stars, "fact_resident_day": days}
        wide = {t: df.withColumns({c: F.lit(1) for c in {*model.REQUIRED_COLUMNS.get(t, [])} - {*df.columns}}) for t, df in needed.items()}
        both = [constraints.star_violations(wide, s).filter("table_name = 'fact_resident_day'") for s in (segments, None)]
        found = [{(r.rule, r.n) for r in df.collect()} for df in both]
        assert found[0] == found[1]
        return found[0]

    assert broken(good) == set()
    assert broken([*good, ("R1", "C1", day + dt.timedelta(2), day + dt.timedelta(5), 1, "IL")]) == {("unique (date_key, resident_id)", 4)}
