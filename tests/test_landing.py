from __future__ import annotations

import os
import random

import pytest
from conftest import as_map, as_set
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stayledger.sources import bronze, files, quoted
from stayledger.streaming.landing import land_stream


def test_digests_follow_content_and_order_but_not_splits(spark, tmp_path):
    path = tmp_path / "b_2025_01.csv"
    lines = [b"%d,%d" % (i, i * i) for i in range(3000)]

    def digest(body, split="128m"):
        path.write_bytes(b"x,y\r\n" + b"\r\n".join(body) + b"\r\n")
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            return as_map(files.profiles(spark, [str(path)]), "file_name", "file_hash")[path.name]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")

    first = digest(lines)
    assert digest(lines, "4k") == digest(lines, "1000") == first
    swapped = [lines[1], lines[0], *lines[2:]]
    assert len({first, digest(swapped), digest(swapped, "4k"), digest(lines[:-1]), digest(lines[::-1]), digest([*lines[:-1], b"x"])}) == 5


def test_listing(spark, tmp_path):
    for name in ("pcc_residents_2025_01.csv", "pcc_residents_25_01.csv", "other_2025_01.csv", "yardi_units_2025_02.txt"):
        (tmp_path / name).write_text("a\n1\n")
    found = files.listing(spark, str(tmp_path)).select("file_name", "table_name", "year", "month", "status")
    assert as_set(found) == {
        ("pcc_residents_2025_01.csv", "pcc_residents", 2025, 1, "known"),
        ("pcc_residents_25_01.csv", None, None, None, "ignored"),
        ("other_2025_01.csv", "other", 2025, 1, "ignored"),
    }


def test_profiles_and_row_order(spark, tmp_path):
    one, two, three = (tmp_path / f"gbp_reviews_2025_0{i}.csv" for i in (1, 2, 3))
    one.write_bytes(b"id,t\r\n" + b"".join(b"%d,v\r\n" % i for i in range(200)))
    two.write_bytes(b'id,t\r\n1,"a\r\nb"\r\n2,""\r\n3\r\n')
    three.write_bytes(b"t,id,z\r\n")
    found = files.profiles(spark, [str(p) for p in (one, two, three)]).select("header", "open_quotes", "empty")
    assert as_set(found) == {("id,t", False, False), ("id,t", True, False), ("t,id,z", False, True)}
    reads = [(["id", "t"], False, one), (["id", "t"], True, two), (["t", "id", "z"], False, three)]
    landed = files.drift_union([files.read_extract(spark, c, m, [str(p)]) for c, m, p in reads])
    assert landed.count() == 203 and set(landed.columns) >= {"id", "t", "z"}
    ordered = landed.filter(F.col("_source_file") == one.name).orderBy("_row_seq").select("id").collect()
    assert [int(r.id) for r in ordered] == list(range(200))
    assert as_set(landed.filter(F.col("_source_file") == two.name).select("id", "t")) == {("1", "a\nb"), ("2", None), ("3", None)}


def test_rows_longer_than_their_header_stop_the_run(spark, tmp_path):
    folder, warehouse = tmp_path / "in", str(tmp_path / "w")
    folder.mkdir()
    (folder / "hubspot_leads_2025_01.csv").write_text("lead_id,status\nH1,Won,extra\n")
    with pytest.raises(Exception, match="more cells than the header in hubspot_leads_2025_01.csv"):
        bronze.land(spark, str(folder), warehouse, "b")
    assert bronze.registry(spark, warehouse).count() == 0


def test_unchanged_files_are_not_read(spark, tmp_path, monkeypatch):
    folder, warehouse = tmp_path / "in", str(tmp_path / "w")
    folder.mkdir()
    for month in (1, 2):
        (folder / f"hubspot_leads_2025_0{month}.csv").write_text(f"lead_id,status\nH{month},Won\n")
    first = bronze.land(spark, str(folder), warehouse, "a")
    assert (first.files_read, first.bytes_read) == (2, 2 * 22)
    read = []
    profiles = files.profiles
    monkeypatch.setattr(files, "profiles", lambda spark, paths: read.append([p.rsplit("/", 1)[-1] for p in paths]) or profiles(spark, paths))
    again = bronze.land(spark, str(folder), warehouse, "b")
    assert (again.files_read, again.bytes_read, again.loaded, len(again.skipped)) == (0, 0, {}, 2) and read == []
    # another time, the same content: read once, then known again
    os.utime(folder / "hubspot_leads_2025_02.csv", (1, 1))
    assert bronze.land(spark, str(folder), warehouse, "c").loaded == {} and read == [["hubspot_leads_2025_02.csv"]]
    assert bronze.land(spark, str(folder), warehouse, "d").files_read == 0
    # the same length and time, but asked to look
    (folder / "hubspot_leads_2025_02.csv").write_text("lead_id,status\nH2,Too\n")
    os.utime(folder / "hubspot_leads_2025_02.csv", (1, 1))
    assert bronze.land(spark, str(folder), warehouse, "e").files_read == 0
    assert bronze.land(spark, str(folder), warehouse, "f", verify=True).loaded == {"hubspot_leads_2025_02.csv": 1}
    assert as_set(bronze.read_bronze(spark, warehouse, "hubspot_leads").select("lead_id", "status")) == {("H1", "Won"), ("H2", "Too")}


def test_loads_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bronze, "FAN", 3)
    folder, warehouse = tmp_path / "in", tmp_path / "w"
    folder.mkdir()
    most = 0
    for i in range(11):
        month = i % 9 + 1  # the first months come again with other rows
        (folder / f"hubspot_leads_2025_0{month}.csv").write_text("lead_id,status\n" + f"H{i},x{i}\n" * (i + 1))
        assert bronze.land(spark, str(folder), str(warehouse), str(i)).loaded == {f"hubspot_leads_2025_0{month}.csv": i + 1}
        most = max(most, len(list((warehouse / "bronze" / "hubspot_leads").glob("_load=*"))))
    landed = bronze.read_bronze(spark, str(warehouse), "hubspot_leads").groupBy("lead_id", "_source_file", "_batch_id").count()
    assert as_set(landed) == {(f"H{i}", f"hubspot_leads_2025_0{i % 9 + 1}.csv", str(i), i + 1) for i in range(2, 11)}
    assert most <= 6 and bronze.table_counts(spark, str(warehouse)).filter("row_count > 0").first().row_count == sum(range(3, 12))


def test_a_load_without_entries_is_not_read(spark, tmp_path):
    rows = spark.createDataFrame([("H1", 1, "hubspot_leads_2025_01.csv")], "lead_id string, _row_seq long, _source_file string")
    stamped = files.stamp(rows, "hubspot_leads", "a")
    bronze.replace_by_file(stamped, str(tmp_path), "hubspot_leads")
    bronze.put(stamped.withColumn("lead_id", F.lit("H2")), spark.createDataFrame([("hubspot_leads_2025_01.csv", "", [], 1, None)], "file_name string, file_hash string, columns array<string>, length long, modified timestamp"), str(tmp_path), "hubspot_leads")
    assert as_set(bronze.read_bronze(spark, str(tmp_path), "hubspot_leads").select("lead_id")) == {("H1",)}


LINE = st.lists(st.sampled_from(['"', '""', ",", "a", " ", 'b"', '"c']), max_size=7).map("".join)


def plain_open(line: str, inside: bool) -> bool:
    """A reader character by character."""
    at = "quoted" if inside else "begin"
    for c in line:
        if c == '"':
            at = {"begin": "quoted", "quoted": "closed", "closed": "quoted", "plain": "plain"}[at]
        elif at != "quoted":
            at = "begin" if c == "," else "plain"
    return at == "quoted"


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(LINE, min_size=40, max_size=40))
def test_open_quotes_of_a_line(spark, lines):
    found = spark.createDataFrame([(x,) for x in lines], "v string").select("v", quoted.left_open(F.col("v"), False).alias("f0"), quoted.left_open(F.col("v"), True).alias("f1"))
    assert [(r.f0, r.f1) for r in found.collect()] == [(plain_open(x, False), plain_open(x, True)) for x in lines]


@pytest.mark.parametrize("split", ["64", "1000", "128m"])
def test_quoted_line_breaks_are_read_by_many_tasks(spark, tmp_path, split):
    rnd = random.Random(7)
    cells = ["plain", "", "with, comma", 'say ""this""', "two\nlines", "three\n\nlines,\n", '""', "5 feet", "é\n日"]
    rows = [[rnd.choice(cells) for _ in range(3)] for _ in range(400)]
    body = "".join(",".join(f'"{c}"' if set(c) & set(',"\n') or rnd.random() < 0.2 else c for c in [str(i), *r]) + "\r\n" + "\r\n" * (i % 50 == 9) for i, r in enumerate(rows))
    path = tmp_path / "gbp_reviews_2025_01.csv"
    path.write_bytes(("id,a,b,c\r\n" + body).encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        names = ["id", "a", "b", "c"]
        found = files.read_extract(spark, names, True, [str(path)])
        tasks = spark.read.option("lineSep", "\n").text(str(path)).rdd.getNumPartitions()
        assert tasks > 4 or split == "128m"
        whole = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(path))
        assert as_set(found.select(*names)) == as_set(whole) and found.count() == 400
        assert [int(r.id) for r in found.orderBy("_row_seq").collect()] == list(range(400))
        assert as_set(found.select("a")) == {(c.replace('""', '"') or None,) for c in cells}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_folder_with_a_space_and_files_without_bytes(spark, tmp_path):
    folder, warehouse = tmp_path / "my in", str(tmp_path / "w")
    folder.mkdir()
    (folder / "hubspot_leads_2025_01.csv").write_text("lead_id,status\nH1,Won\n")
    (folder / "hubspot_leads_2025_02.csv").write_text("")
    assert bronze.land(spark, str(folder), warehouse, "b").loaded == {"hubspot_leads_2025_01.csv": 1}
    assert bronze.read_bronze(spark, warehouse, "hubspot_leads").count() == 1
    assert bronze.land(spark, str(folder), warehouse, "c").loaded == {}


def test_stream_takes_each_file_once(spark, tmp_path):
    folder, warehouse = tmp_path / "in", str(tmp_path / "w")
    folder.mkdir()

    def run():
        land_stream(spark, str(folder), warehouse).awaitTermination()
        return as_set(bronze.read_bronze(spark, warehouse, "hubspot_leads").select("lead_id", "status", "_source_file"))

    (folder / "hubspot_leads_2025_01.csv").write_text("lead_id,status\nH1,Won\nH2,\n")
    (folder / "notes.csv").write_text("lead_id,status\nX,Y\n")
    january = {("H1", "Won", "hubspot_leads_2025_01.csv"), ("H2", None, "hubspot_leads_2025_01.csv")}
    assert run() == january
    assert run() == january
    (folder / "hubspot_leads_2025_02.csv").write_text('status,lead_id,extra\n"N\nA",H3,z\n')
    assert run() == january | {("H3", "N\nA", "hubspot_leads_2025_02.csv")}
    assert bronze.registry(spark, warehouse).count() == 2
    assert bronze.land(spark, str(folder), warehouse, "b").loaded == {}
