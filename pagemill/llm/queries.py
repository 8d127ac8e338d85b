"""The operators as queries over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import alignment, ann, bpe, language_model, packing, pii, quality, sharding, simhash, spelling, token_counts, toxicity, url_filter
from pagemill.llm.common import stored, table


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(*columns)


URL_RULES = [
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]
PII_KEY = "pagemill"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_pii(_documents(spark, sf_dir, "doc_id", "text"), PII_KEY)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = _documents(spark, sf_dir, "doc_id", "text").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )
    placed = sharding.assign(rows, F.col("size"), "text_hash", "text_crc32")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    marked = stored(simhash.with_fingerprint(docs).select("doc_id", "fp"), "op4-fingerprints")
    found = simhash.components(marked).withColumnRenamed("fp", "of")
    hexadecimal = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return marked.join(found, F.col("fp") == F.col("of")).select("doc_id", hexadecimal.alias("fingerprint"), "component_id")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    made = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return made.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text", "lang", "source")
    counted = stored(quality.with_base_counts(docs).drop("text"), "op8-counts")
    judged = quality.judge(counted, quality.thresholds(counted))
    return judged.select("doc_id", *quality.BASE, "base_failed", "kept")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = url_filter.train(url_filter.labelled_urls(spark).where("not held_out"))
    return url_filter.judge(pages, URL_RULES, model).select("page_id", "host", "path", "rule", "verdict")


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(vectors, F.col("vec_id") % 20 == 0)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = toxicity.score(docs.withColumn("held_out", toxicity.held_out()), model)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.count_words(_documents(spark, sf_dir, "doc_id", "text")))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    return alignment.aligned(docs, *map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")))


def op13_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    return language_model.score(docs, language_model.train(docs))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_sharding": op2_sharding,
    "op3_token_counts": op3_token_counts,
    "op4_simhash": op4_simhash,
    "op5_bpe": op5_bpe,
    "op6_url_filter": op6_url_filter,
    "op7_packing": op7_packing,
    "op8_quality": op8_quality,
    "op9_ann": op9_ann,
    "op10_toxicity": op10_toxicity,
    "op11_spelling": op11_spelling,
    "op12_alignment": op12_alignment,
    "op13_language_model": op13_language_model,
}
ORACLE: dict[str, str] = {}
