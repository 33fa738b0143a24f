"""What keeps queries within their limits on large tables: no step twice, nothing made that is not read."""

from __future__ import annotations

import datetime
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stayledger.functions import sql_round, to_decimal, to_number
from stayledger.llm import common, toxicity
from stayledger.operators import keys, quality, temporal
from stayledger.workload import queries
from stayledger.workload import shapes as sh

TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string, c_acctbal double",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
    "events": "event_id bigint, user_id bigint, ts timestamp, event_type string, value double",
}


@pytest.fixture
def folder(spark, tmp_path):
    """Empty tables."""
    for name, schema in TABLES.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.fixture
def kept(monkeypatch):
    """The names of the shapes that a query stages."""
    names = []
    monkeypatch.setattr(sh, "staged", lambda df, name: names.append(name) or df)
    return names


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_digest_outgrows_64_bits(rows):
    first = datetime.date(1998, 1, 1)
    data = [(first + datetime.timedelta(n), 1, 2, 3 + 10**13 * (n % 2), "AL") for n in range(4)] + [(first, 1, 2, None, None)]
    days = rows(data, "date_key date, resident_id bigint, community_id bigint, care_level_key bigint, care_level string")
    (found,) = queries.digest(days).collect()
    weighed = sum((d - datetime.date(1970, 1, 1)).days ** 2 * ((k or 0) + 1) for d, _, _, k, _ in data)
    assert weighed > 2**63
    assert tuple(found) == (1, 2, 5, first, first + datetime.timedelta(3), float(weighed))


@pytest.mark.parametrize("name", ["quarantine_summary", "run_metrics", "reconcile_counts", "clean_residents_log"])
def test_cleaners_parts_are_staged_only_if_read_twice(spark, folder, kept, name):
    queries.QUERIES[name](spark, folder)
    assert set(kept) <= {"shipped_orders", "raw_units", "shifts"}
    assert ("shifts" in kept) == (name == "reconcile_counts")


@pytest.mark.parametrize("name", ["los_by_level", "incident_rate_level", "scd2_overlap_pairs"])
def test_facts_that_a_query_does_not_read_are_not_staged(spark, folder, kept, name):
    queries.QUERIES[name](spark, folder)
    assert set(kept) <= {"shipped_orders", "care_history", "ranges", "window"}
    assert kept.count("ranges") == 1


def test_metrics_facts_are_not_staged(spark, folder, kept):
    s = sh.Sample(spark, folder)
    s.sharing = True
    queries.facts(s)
    assert set(kept) <= {"shipped_orders", "window"}


def test_aggregates_start_from_residents_kept_once(spark, folder, kept):
    queries.QUERIES["reconcile_aggregates"](spark, folder)
    assert sorted(kept) == ["bounds", "history", "raw_units", "residents", "shifts", "shipped_orders"]


def test_raw_values_are_made_only_where_read(rows):
    data = rows([("a", 1), ("b", 2), ("c", None)], "k string, v int")
    findings = [quality.Finding(F.col("v") > n, f"above {n}", "none", ["k", "v"]) for n in (0, 1)]
    log = quality.quarantine_log(data, "t", "k", findings)
    found = [tuple(r) for r in log.select("business_key", "reason", "raw_value").collect()]
    assert sorted(found) == [("a", "above 0", '{"k":"a","v":1}'), ("b", "above 0", '{"k":"b","v":2}'), ("b", "above 1", '{"k":"b","v":2}')]
    assert "json" in optimized(log).lower() and "json" not in optimized(quality.quarantine_summary(log)).lower()


def test_winners_need_two_shuffles(rows):
    data = [("e", "p", "x", "f", 1), ("e", "p", "y", "f", 2), ("e", "q", "y", "f", 3), (None, "p", "x", "f", 4), (None, "p", "y", "f", 5)]
    found = quality.contested_winners(rows(data, "e string, p string, v string, _source_file string, _row_seq bigint"), "e", "p", "v")
    assert planned(found).count("Exchange") == 2
    assert [(r.e, r.p, r._winner._row_seq) for r in found.collect()] == [("e", "p", 2)]


def test_numbered_rows_are_derived_once(rows, monkeypatch):
    names = []
    monkeypatch.setattr(keys, "staged", lambda df, name, make=keys.staged: names.append(name) or make(df, name))
    found = keys.dense_key(rows([(3,), (1,), (2,)], "n int"), ["n"], "key")
    assert {(r.key, r.n) for r in found.collect()} == {(1, 1), (2, 2), (3, 3)}
    assert names == ["unnumbered", "dense-key"]


def test_windows_over_ranges_run_in_tasks_of_their_own(rows):
    history = rows([], "resident_id bigint, change_date date, previous_level string, new_level string, reason string")
    stays = rows([], "resident_id bigint, community_id bigint, admit_date date, discharge_date date, care_level string")
    ranges = temporal.level_ranges(history, stays)
    assert re.search(r"hashpartitioning\(resident_id#\d+L?, resident_id#\d+L?,", planned(ranges))
    segments = temporal.census_segments(stays, ranges.withColumn("care_level_key", F.lit(1)), "1998-01-01", "1998-12-31")
    assert len(re.findall(r"hashpartitioning\(resident_id#\d+L?, resident_id#\d+L?,", planned(segments))) == 2


def test_months_of_a_lease_are_not_shuffled(spark, folder):
    plan = planned(queries.QUERIES["lease_month_rows"](spark, folder))
    assert "Generate" in plan and "Exchange" not in plan.split("Generate")[0]


def test_batches_come_in_portions():
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array(["x" * 100] * 1000)], names=["n", "t"])
    parts = list(common.portions(batch, 10_000))
    assert len(parts) > 5 and [n for p in parts for n in p.column(0).to_pylist()] == list(range(1000))
    assert list(common.portions(batch.slice(0, 0))) == [] and len(list(common.portions(batch))) == 1


def test_words_of_examples_come_as_single_values(rows):
    texts = rows([(1, 1, bytearray(b"B a b\x00a a")), (2, 0, bytearray(b""))], "id bigint, y int, text binary")
    found = {r.id: (dict(zip(r.words.split(), memoryview(bytes(r.counts)).cast("I"))), len(r.words)) for r in toxicity.counted(texts).collect()}
    assert found == {1: ({b"a": 3, b"b": 2}, 3), 2: ({}, 0)}


def test_values_of_a_row_are_read_once(spark, folder):
    s = sh.Sample(spark, folder)
    for table in ("pcc_incidents", "adp_shifts", "yardi_leases", "pcc_residents"):
        filters = re.findall(r"Filter .*", optimized(queries.cleaned(s, table).rows))
        assert filters and not [f for f in filters if "regexp" in f]
    data = spark.createDataFrame([("1",), ("7",), ("x",), (None,)], "t string")
    found = quality.once_per_row(data, n=to_number(F.col("t"))).filter("n > 1 or n is null")
    assert found.columns == ["t", "n"] and sorted(map(tuple, found.collect()), key=str) == [("7", 7.0), ("x", None), (None, None)]
    assert quality.once_per_row(data.limit(0), n=F.col("t")).collect() == []


def test_rounding_stays_short(rows):
    twice = rows([], "v double").select(to_decimal(sql_round(F.col("v"), 2), 12, 2).alias("d"))
    assert len(re.findall(r"\bv#\d+", optimized(twice))) <= 25


def test_reconciled_residents_hold_what_is_read(spark, folder, monkeypatch):
    columns = {}
    monkeypatch.setattr(sh, "staged", lambda df, name: columns.update({name: df.columns}) or df)
    found = queries.QUERIES["reconcile_aggregates"](spark, folder).collect()
    assert columns["residents"] == ["resident_id", "community_id", "admit_date", "discharge_date", "care_level"]
    assert len(found) == 7
