"""The operators over the sample tables, as the queries op1 to op13 and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, divergence, fim, langid, licenses, packing, sharding, simhash, topk, toxicity, urls
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

SHINGLE, MAX_BITS = 3, 2
TOXIC_FROM = 0.3
SHARDS = 40
# The rules of the URL filter.
URL_RULES = (
    urls.Rule(urls.ALLOW, "org", "/"),
    urls.Rule(urls.BLOCK, "example.org", "/es/"),
    urls.Rule(urls.BLOCK, "example.org", "/en/1"),
    urls.Rule(urls.ALLOW, "com", "/fr/"),
    urls.Rule(urls.BLOCK, "com", "/de/"),
)
# end of fixed values


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def tokenizer() -> dict[str, str]:
    import public_tokenizers

    return {"tokenizer": str(public_tokenizers.path("byte_bpe_50k.json")), "ranks": str(public_tokenizers.path("byte_bpe_50k.tiktoken"))}


@query
def op1_preferences(spark, folder):
    turns = table(spark, folder, "conversations")
    return chat.preferences(*chat.swapped_replies(turns))


@query
def op2_simhash(spark, folder):
    found = simhash.near_duplicates(table(spark, folder, "documents"), shingle=SHINGLE, max_bits=MAX_BITS)
    return found.select("doc_id", "fingerprint", "component_id")


def packed(docs: DataFrame) -> DataFrame:
    found = packing.pack(docs, **tokenizer())
    return found.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source"
    )


@query
def op3_packing(spark, folder):
    return packed(table(spark, folder, "documents"))


@query
def op4_licenses(spark, folder):
    return licenses.scan(table(spark, folder, "documents"))


@query
def op5_toxicity(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(docs, labels, wanted=~toxicity.held_out())
    scored = toxicity.score(docs.select("doc_id", "text"), model).withColumn("held_out", toxicity.held_out())
    predicted = (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted")
    return scored.select("doc_id", "held_out", "score", predicted, "near_ids", "near_cosines")


@query
def op6_language(spark, folder):
    docs = table(spark, folder, "documents")
    model = langid.fit(docs, wanted=~langid.held_out())
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.withColumn("held_out", langid.held_out()).select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query
def op7_decontamination(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, table(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


@query
def op8_topk(spark, folder):
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op9_sharding(spark, folder):
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32")
    )
    placed = sharding.assign(docs, ["doc_id", "size", "text_crc32"], SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op10_urls(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urls.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "evidence")


@query
def op11_divergence(spark, folder):
    return divergence.audit(table(spark, folder, "documents"))


def multilingual() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@query
def op12_bpe(spark, folder):
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "text")
    # the ids take the text's place and the decoded text theirs: no column passes a worker unused
    encoded = bpe.encode(docs, multilingual(), public_tokenizers.PATTERN, ids="text").withColumnRenamed("text", "ids")
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256)
    digested = encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), digest.alias("ids_sha256"), "ids")
    decoded = bpe.decode(digested, multilingual(), text="ids")
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("ids").cast("binary"), 256).alias("decoded_sha256"))


@query
def op13_fim(spark, folder):
    made = fim.transform(table(spark, folder, "documents").select("doc_id", "text"), seed=42)
    restored = fim.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored.cast("binary"), 256).alias("restored_sha256"),
    )
