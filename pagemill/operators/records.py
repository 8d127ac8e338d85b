"""Columns of document and index records."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions import text as T
from pagemill.functions.fixed import PREVIEW_CHARS


def flatten_text(df: DataFrame, col: str = "content") -> DataFrame:
    return df.withColumn(col, T.flatten(col))


def preview(df: DataFrame, n: int = PREVIEW_CHARS, col: str = "content") -> DataFrame:
    return df.withColumn(col, T.preview(col, n))


def strip_scheme(df: DataFrame, col: str = "path") -> DataFrame:
    return df.withColumn(col, T.strip_scheme(col))


def output_name(df: DataFrame, out_dir: str, col: str = "path") -> DataFrame:
    """Adds ``output``: the name a document's text gets in one flat folder."""
    return df.withColumn("output", T.output_name(T.strip_scheme(col), out_dir))


def index_record(df: DataFrame, run_ts: datetime, n: int = PREVIEW_CHARS) -> DataFrame:
    """``(filename, classification, date, content)``, one UTC date for the whole run.

    The date is formatted once, on the driver, so it does not depend on the session time zone.
    """
    utc = run_ts.replace(tzinfo=timezone.utc) if run_ts.tzinfo is None else run_ts.astimezone(timezone.utc)
    return df.select(
        F.col("path").alias("filename"),
        F.col("classification"),
        F.lit(utc.strftime("%Y-%m-%dT%H:%M:%SZ")).alias("date"),
        T.preview("content", n).alias("content"),
    )
