"""Row filters, whole-table counts and the ordered head."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions import text as T
from pagemill.functions.fixed import SOURCE_EXTENSION


def filter_extension(df: DataFrame, ext: str = SOURCE_EXTENSION) -> DataFrame:
    """Rows whose ``path`` ends in the extension, ignoring case."""
    return df.where(T.extension("path") == F.lit(ext.lower()))


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` is not the empty string; blanks such as ``' '`` stay."""
    return df.where(F.col(col) != "")


def contains_text(df: DataFrame, needle: str, col: str = "content") -> DataFrame:
    return df.where(F.instr(F.col(col), needle) > 0)


def indexed_only(docs: DataFrame, index: DataFrame) -> DataFrame:
    """Documents that have a record in the index."""
    names = index.select(F.col("filename").alias("path"))
    return docs.join(names, "path", "left_semi")


def first_documents(df: DataFrame, n: int = 1) -> DataFrame:
    """The first ``n`` documents by path: each task keeps its own ``n`` and only those are merged."""
    return df.orderBy("path").limit(n)


def document_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_documents"))
