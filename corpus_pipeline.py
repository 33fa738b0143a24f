"""The corpus pipeline: language ID, toxicity, near-duplicates, benchmark decontamination, packing.

Every stage takes (spark, docs, sf_dir) and returns what it keeps; all but the last return the columns
of documents, with the values they came with: what an operator adds stands beside them under names of
its own and is left out again. :func:`run` writes each stage's result to the shared folder and reads it
again.

Every stage reads whole texts, however long, takes a null text as an empty one, keeps or drops repeated
rows alike unless it says otherwise, and gives an empty table for an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.llm import decontaminate, langid, queries, simhash, toxicity
from stayledger.llm.common import apart, stage, table, together


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose language is too uncertain. Null texts have no
    letter and go. Equally likely languages are equally uncertain, whichever is named. A null ``lang`` is
    not learnt from; if no text is labelled, only documents without a letter go."""
    model = langid.fit(docs, wanted=~langid.held_out())
    own, name = apart(docs)
    return together(langid.predict(own, model, text=name["text"]).where(~F.col("rejected")), docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents predicted to be toxic: those scored ``queries.TOXIC_FROM`` or more. Null and empty
    texts get the base share of toxic rows as their score; without toxic examples all stay. Null labels
    and labels of null ids are not learnt from."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), wanted=~toxicity.held_out())
    own, name = apart(docs)
    return together(toxicity.score(own, model, text=name["text"]).where(F.col("score") < queries.TOXIC_FROM), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: the one with the smallest id, null ids last. Of rows with the
    same id the one with the least digest of all its columns stays, of equal rows one. Null and empty
    texts are one group."""
    return simhash.representatives(docs, shingle=queries.SHINGLE, max_bits=queries.MAX_BITS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item. Null texts and items hold no windows;
    without items all documents stay."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all that is left into sequences, mixed by source; a null text is one end mark. Columns other
    than id, text and source are not read."""
    return queries.packed(docs)


STAGES = [
    ("language", language),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("packing", packing),
]

#: Trained models, fingerprints and token ids have no SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
