"""The pipeline of training documents: toxicity, quality rules, near-duplicates, personal data, packing.

Each stage takes the table that the stage before it kept, stored as Parquet and read again, so a lost executor costs a part of
one stage. All stages but the last return the columns of ``documents``; columns of theirs that have the name of a
column an operator adds are set aside meanwhile. Stages accept nulls in any column, repeated rows and empty tables, with the
results that the operators' modules define.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import packing, pii, quality, simhash, toxicity
from pagemill.llm.common import stored, table

PII_KEY = "pagemill"


def _keeping_columns(docs: DataFrame, added: tuple[str, ...], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of ``work(docs)`` with the columns of ``docs``, those named like ``added`` ones included."""
    aside = {c: f"_own_{c}" for c in docs.columns if c in added}
    done = work(docs.withColumnsRenamed(aside))
    return done.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic. The model learns from the labels of the documents at hand."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")

    def work(own: DataFrame) -> DataFrame:
        return toxicity.score(own, toxicity.train(own, labels)).where("predicted = 0")

    return _keeping_columns(docs, ("score", "predicted"), work)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the thresholds of their language and source."""
    added = (*quality.BASE, *quality.RATIOS, "base_failed", "kept")

    def work(own: DataFrame) -> DataFrame:
        counted = quality.with_base_counts(own)
        return quality.judge(counted, quality.thresholds(counted)).where("kept")

    return _keeping_columns(docs, added, work)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: SimHash of three-word shingles within two bits."""
    return simhash.without_near_duplicates(docs, shingle=simhash.SHINGLE, distance=simhash.DISTANCE)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data; ``n_chars`` follows the text."""

    def work(own: DataFrame) -> DataFrame:
        replaced = pii.replace_pii(own, PII_KEY)
        if "n_chars" not in own.columns:
            return replaced
        changed = F.when(F.col("n_surrogates") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        return replaced.withColumn("n_chars", changed.cast(own.schema["n_chars"].dataType))

    return _keeping_columns(docs, ("n_surrogates",), work)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", keep_quality),
    ("near-duplicates", drop_near_duplicates),
    ("personal data", replace_personal_data),
    ("packing", pack_sequences),
]

#: Hashing, learned trees, sketches and tokenizers have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
