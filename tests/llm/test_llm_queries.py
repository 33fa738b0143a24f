"""The queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent / "tools"))

import compare  # noqa: E402
import corpus_pipeline  # noqa: E402
from stayledger.llm import common, decontaminate, langid, toxicity  # noqa: E402
from stayledger.llm.oracles import SQL  # noqa: E402
from stayledger.llm.queries import QUERIES, TOXIC_FROM, tokenizer  # noqa: E402
from test_packing import check_round_trip  # noqa: E402
from test_simhash import plain_fingerprint, plain_groups  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    assert compare.compare(spark, FOLDER, name) is None


def test_simhash_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op2_simhash"](spark, FOLDER).collect()}
    prints = {d.doc_id: plain_fingerprint(d.text) for d in docs}
    groups = plain_groups(prints.values())
    least = {g: min(i for i, p in prints.items() if groups[p] == g) for g in set(groups.values())}
    assert found == {i: (f"{p:016x}", least[groups[p]]) for i, p in prints.items()}


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    results = [docs]
    for name, step in corpus_pipeline.STAGES:
        results.append(common.stage(step(spark, results[-1], FOLDER), name))
    raw, spoken, polite, single, clean, packed = [r.collect() for r in results]
    assert all(r.columns == columns for r in results[:-1])
    model = langid.fit(docs, wanted=~langid.held_out())
    rejected = {r.doc_id for r in langid.predict(docs, model).collect() if r.rejected}
    assert {r.doc_id for r in spoken} == {r.doc_id for r in raw} - rejected
    judge = toxicity.fit(results[1], spark.read.parquet(f"{FOLDER}/labels.parquet"), wanted=~toxicity.held_out())
    score = (lambda t: 0.0) if judge is None else (lambda t: judge.score(t.encode())[0])
    assert {r.doc_id for r in polite} == {r.doc_id for r in spoken if score(r.text) < TOXIC_FROM}
    prints = {r.doc_id: plain_fingerprint(r.text) for r in polite}
    groups = plain_groups(prints.values())
    assert {r.doc_id for r in single} == {min(i for i, p in prints.items() if groups[p] == g) for g in set(groups.values())}
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    searchers = decontaminate.build_tables([(str(r.item_id), r.text.encode()) for r in items], decontaminate.WINDOW)
    assert {r.doc_id for r in clean} == {r.doc_id for r in single if not decontaminate.search_text(r.text.encode(), searchers)[1]}
    from tokenizers import Tokenizer

    whole = {r.doc_id: r.text for r in clean}
    assert {r.doc_id for r in packed} == set(whole)
    plain = Tokenizer.from_file(tokenizer()["tokenizer"])
    counts = {i: len(plain.encode(t, add_special_tokens=False).ids) + 1 for i, t in whole.items()}
    assert all(r.doc_tokens == counts[r.doc_id] for r in packed)
    assert sum(r.length for r in packed) == sum(counts.values())


def test_pipeline_keeps_clashing_columns_and_rows_without_labels(spark, tmp_path):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(120)
    odd = spark.createDataFrame([(9001, None, "en", "web"), (9002, "", None, None), (None, "a text without an id", "en", None), (9003, "9 8 7", "en", "web")], "doc_id long, text string, lang string, source string")
    docs = docs.unionByName(odd, allowMissingColumns=True)
    docs = docs.unionByName(docs.where("doc_id < 20"))
    names = ["score", "rejected", "lang_pred", "near_ids", "near_cosines", "spans", "items", "n_words", "n_hit", "n_items", "contaminated",
             "digest", "__digest", "fp", "k", "d", "h", "fingerprint", "component_id", "group_fp", "__in0", "ids", "start", "form"]
    docs = docs.withColumns({n: F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")) for n in names})
    docs = docs.withColumn("a map", F.create_map(F.lit("id"), F.col("doc_id")))
    common_folder = str(tmp_path)
    spark.read.parquet(f"{FOLDER}/labels.parquet").write.parquet(f"{common_folder}/labels.parquet")
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(f"{common_folder}/benchmark.parquet")
    docs = common.stage(docs, "clashing")
    now = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        before, now = now, common.stage(step(spark, now, common_folder), name)
        assert now.dtypes == docs.dtypes, name
        rows = now.collect()
        assert rows and all(r[n] == (None if r.doc_id is None else f"{n} of {r.doc_id}") and r["a map"] == {"id": r.doc_id} for r in rows for n in names), name
        assert {r.doc_id for r in rows} <= {r.doc_id for r in before.collect()}
    assert corpus_pipeline.packing(spark, now, common_folder).select("doc_id").distinct().count() == now.select("doc_id").distinct().count()
    # without a label: only texts without a letter go
    silent = docs.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.language(spark, silent, common_folder)
    assert kept.count() == docs.where("rlike(text, '[A-Za-z]')").count()
    spark.read.parquet(f"{FOLDER}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.toxic(spark, docs, f"{tmp_path}/none").count() == docs.count()


def test_packing_query(spark):
    import zlib

    from stayledger.llm import packing
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plain = Tokenizer.from_file(tokenizer()["tokenizer"])
    plain.encode_special_tokens = True
    pieces = packing.pack(docs, **tokenizer()).collect()
    check_round_trip([(r.doc_id, r.text) for r in docs.collect()], pieces, plain, 2048)
    digests = {(r.doc_id, r.start): zlib.crc32(bytes(r.ids)) for r in pieces}
    assert {(r.doc_id, r.start): r.ids_crc32 for r in QUERIES["op3_packing"](spark, FOLDER).collect()} == digests


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark", "embeddings", "pages", "conversations"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    for name, build in [*QUERIES.items(), ("pipeline", corpus_pipeline.run)]:
        assert build(spark, str(tmp_path)).count() == 0, name
