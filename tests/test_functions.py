from __future__ import annotations

import ast
import datetime as dt
import json
import math
import random
from decimal import Decimal

from pyspark.sql import functions as F

from stayledger import model
from stayledger.functions import (
    canonical,
    half_even,
    parse_date,
    rate_for_role,
    ratio,
    raw_json,
    snapshot_month,
    sql_round,
    strip,
    to_decimal,
    to_int,
    to_number,
)


def results(rows, values, expression, kind="string"):
    df = rows([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", expression(F.col("v"))).orderBy("i").collect()]


def test_parse_date(rows):
    texts = ["2025-01-05", "2025-1-5", " 3/4/2025\t", "03/04/2025", "2025-02-30", "13/01/2025", "25-01-01",
             "2025-01-01x", "2025-01-01 00:00", "", "n/a", None, "\u00a02025-01-05\u3000", "\x1c3/4/2025\x85"]
    assert results(rows, texts, parse_date) == [
        dt.date(2025, 1, 5), dt.date(2025, 1, 5), dt.date(2025, 3, 4), dt.date(2025, 3, 4), *[None] * 8,
        dt.date(2025, 1, 5), dt.date(2025, 3, 4),
    ]


def test_strip_and_canonical(rows):
    assert results(rows, [" \t a b \n", "a", None], strip) == ["a b", "a", None]
    texts = ["IL", " independent living", "Assisted", "MEMORY CARE ", "Respite", "", None]
    assert results(rows, texts, lambda c: canonical(c, model.CARE_LEVELS)) == ["IL", "IL", "AL", "MC", None, None, None]


def test_to_number(rows):
    texts = ["1", " 2.5 ", "-3e2", ".5", "5.", "NaN", "abc", "1d", "0x10", "1 2", "", None, "inf"]
    assert results(rows, texts, to_number) == [
        1.0, 2.5, -300.0, 0.5, 5.0, None, None, None, None, None, None, None, math.inf
    ]


def test_rate_for_role(rows):
    texts = [("{'RN': 46, 'Cook': 16}", "RN"), ("{'RN': '46.5'}", "RN"), ("{'RN': 46}", "Cook"), ("18.5", "RN"),
             ("NaN", "RN"), ("?", "RN"), (None, "RN"), ("{'RN': 46}", None), ("{'RN': 38.5, 'CNA': None}", "RN"),
             ("{'RN': 38.5, 'CNA': None}", "CNA"), ("{'RN': 38.5,}", "RN"), ("{'RN': 1, 'RN': 2}", "RN"), ("{'RN': 1", "RN"),
             ('\u00a0{"RN" : "7", \'LPN\':8 } ', "RN"), ("\u00a012\u2003", "RN"), ("{'RN': 1 'LPN': 2}", "RN"), ("{}", "RN"),
             ("{'RN': 5, 'X': 'RN'}", "RN"), ("{'X': 'RN'}", "RN")]
    df = rows([(i, *t) for i, t in enumerate(texts)], "i int, t string, role string")
    found = [r[1] for r in df.select("i", rate_for_role(F.col("t"), F.col("role"))).orderBy("i").collect()]
    assert found == [46.0, 46.5, None, 18.5, None, None, None, None, 38.5, None, 38.5, 2.0, None, 7.0, 12.0, None, None, 5.0, None]


def python_rate(text, role):
    """What Python's own literals and floats make of it."""
    try:
        return float(text)
    except ValueError:
        pass
    try:
        read = ast.literal_eval(text.strip())
        value = float(read[role]) if isinstance(read, dict) and role in read else None
    except (ValueError, SyntaxError, TypeError):
        return None
    return None if value is None or math.isnan(value) else value


MAPS = [
    "{'RN': (4)}", "{'RN': 4, 'B': [1,2]}", "{'RN': 4, 5: 6}", r"{'R\\'N': 5, 'RN': 4}", "{'RN': 1_000}", "{'RN': 0x10}", "{'RN': True}",
    "{'RN': '1_000.5'}", "1_000", "1__000", "0x10", "{'RN': 0b101, 'X': 0o17}", "{'RN': -0X_ff}", "{'RN': 1__0}", "{'RN': 007}", "{'RN': .5}",
    "{'RN': 1.e3}", "{'RN': ((4))}", "{'RN': (4,)}", "{'RN': (4, 5)}", "{'RN': ()}", "{'RN': [4]}", "{'RN': {'RN': 5}}", "{'A': {'RN': 5}}",
    "{'A': {'RN': 5}, 'RN': 6}", "{'A': {1, 2}, 'RN': 6}", "{'A': {}, 'RN': 6}", "{'A': [], 'RN': 6}", "{'A': [1 2], 'RN': 6}", "{'A': [,], 'RN': 6}",
    "{'A': [1,], 'RN': 6}", "{'RN': 4 5}", "{'RN' 4}", "{'RN': 4", "{'RN': 4}}", "{'RN': 4} x", "{'RN', 'A'}", "{'RN': 4, 'A'}", "{, 'RN': 4}", "{'RN':}",
    "{'RN': foo}", "{'RN': 4, 'A': foo}", "{'A': (1, [2, {'x': (3)}]), 'RN': 7}", "{'A': (1, [2, {'x': (3}]), 'RN': 7}", "{'RN': 3, 'RN': (9)}",
    "{'RN': (9), 'RN': 3}", "{'RN': 'x\\\\', 'A': 1}", "{'A': 'RN', 'RN': [1], 'B': 2}", "{'A': ':', 'RN': +4}", '{"RN": 0x1F, \'A\': "it\\\'s"}', "{'RN': False}",
    "{'RN': 12e2, 'A': 1:2}", "{(1, 2): 3, 'RN': 8}", "{'RN': None, 'A': (1)}", "{'RN': 'abc', 'A': (1)}", "{'RN': '0x10', 'A': (1)}", "{}", "{'RN': 1, }", "{'RN': 'inf', 'A': (1)}",
]


def test_rates_in_any_literal(rows):
    df = rows(list(enumerate(MAPS)), "i int, t string")
    found = [r[1] for r in df.select("i", rate_for_role(F.col("t"), F.lit("RN"))).orderBy("i").collect()]
    assert dict(zip(MAPS, found)) == {t: python_rate(t, "RN") for t in MAPS}
    odd = rows([(r"{'R\'N': 5, 'B': (1)}", "R'N"), ("{'é': (2)}", "é"), ("{'RN': (2)}", None), (None, "RN")], "t string, role string")
    assert [r[0] for r in odd.select(rate_for_role(F.col("t"), F.col("role"))).collect()] == [5.0, 2.0, None, None]


def test_rounding(rows):
    values = [1.005, 0.285, 2.675, -1.005, 0.125, 2.5, -2.5, None]
    assert results(rows, values, lambda c: sql_round(c, 2), "double") == [
        1.0, 0.28, 2.68, -1.0, 0.13, 2.5, -2.5, None
    ]
    assert results(rows, values, lambda c: half_even(c, 2), "double")[4] == 0.12
    huge = [1e17, -1e17, 9.2e16, float(2**53) + 2, math.inf, -math.inf, 1e308, 0.0]
    assert results(rows, huge, lambda c: sql_round(c, 2), "double") == huge
    assert results(rows, [math.inf, 1e17, 12.345], lambda c: to_decimal(c, 10, 2), "double")[:2] == [None, None]
    assert results(rows, [2.5, 3.5, 7.6, -2.5], to_int, "double") == [2, 4, 8, -2]
    assert [float(v) if v is not None else None for v in results(rows, [1.005, 1e12], lambda c: to_decimal(c, 10, 2), "double")] == [1.0, None]


def test_rounding_against_scaled_arithmetic(rows):
    rng = random.Random(3)
    values = [rng.uniform(-5000, 5000) for _ in range(500)] + [k / 1000 for k in range(500)]

    def scaled(x):
        y = abs(x) * 100
        whole = math.floor(y)
        return math.copysign((whole + 1 if y - whole >= 0.5 else whole) / 100, x)

    assert results(rows, values, lambda c: sql_round(c, 2), "double") == [scaled(v) for v in values]


def test_ratio(rows):
    df = rows([(1, 3), (5, 0), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"), 1, 100.0)).collect()] == [33.3, None, None]


def test_raw_json(rows):
    df = rows([("x" * 3000, None)], "a string, b string")
    assert json.loads(df.select(raw_json("a", "b")).first()[0]) == {"a": "x" * 3000, "b": None}
    assert json.loads(rows([("x", None)], "a string, b string").select(raw_json("a", "b")).first()[0]) == {"a": "x", "b": None}


def test_snapshot_month(rows):
    names = ["pcc_residents_2025_03.csv", "pcc_residents.csv", "x_2025_13.csv"]
    assert results(rows, names, snapshot_month) == [dt.date(2025, 3, 1), None, None]


def test_snapshot_month_of_odd_names(rows):
    names = ["x_2025_00.csv", "x_2025_12.csv.gz", "x2025_12.csv", "x_2025-12.csv", "", None, "a_2020_01.csv_2021_02.csv"]
    assert results(rows, names, snapshot_month) == [None, dt.date(2025, 12, 1), None, None, None, None, dt.date(2020, 1, 1)]


def test_parse_date_of_odd_texts(rows):
    texts = ["1/2/0000", "0000-01-02", "1/2/2025\n", "\n1/2/2025", "2025-01-01 1/2", "1/2/2025 2025-01-01", "1/2/20255", "/", "--", "2025-01",
             "1//2025", "x\n1/2/2025", "2/29/2024", "2/29/2023", "0001-1-1", "1/1/0001"]
    assert results(rows, texts, parse_date) == [
        None, None, dt.date(2025, 1, 2), dt.date(2025, 1, 2), *[None] * 8, dt.date(2024, 2, 29), None, dt.date(1, 1, 1), dt.date(1, 1, 1),
    ]


def test_spellings_with_whitespace_around_them(rows):
    texts = [" al　", "memory\t", "memory  care", "\x1cMC\x85", " ", "iL"]
    assert results(rows, texts, lambda c: canonical(c, model.CARE_LEVELS)) == ["AL", "MC", None, "MC", None, "IL"]


def test_decimals_are_the_rounded_units(rows):
    rng = random.Random(5)
    values = [None, math.nan, -math.inf, -0.0, 0.005, -0.005, 99999999.994, 99999999.995, -99999999.995, 9999999999999.99, 2.0**53, 2.0**53 / 100, 1e300]
    values += [rng.choice([-1, 1]) * (rng.randrange(10 ** rng.randint(1, 15)) + 0.5) / 100 for _ in range(300)]
    for precision in (10, 15, 18):
        rounded = results(rows, values, lambda c: sql_round(c, 2), "double")
        fits = [v is not None and abs(v) < 10 ** (precision - 2) for v in rounded]
        wanted = [Decimal(repr(v)).quantize(Decimal("0.01")) if ok else None for v, ok in zip(rounded, fits)]
        assert results(rows, values, lambda c: to_decimal(c, precision, 2), "double") == wanted
