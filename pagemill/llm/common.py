"""What the operators share: stored intermediate tables and the caches of tokenizing tasks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which the driver and all executors share.

    Where the setting is unset, a temporary folder serves on a local master; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        base = _OWN.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="pagemill-llm-"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written as Parquet once and read back: lineage ends here and no later stage repeats the work."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Aside:
    """``rows``: a table whose columns are renamed to ``own0``, ``own1`` ..., beside the expressions an operator works on, so that
    no name of the caller's meets one of the operator's. ``back`` gives the caller's names again."""

    def __init__(self, df: DataFrame, **needed: Column):
        self.columns = df.columns
        quoted = [F.col(f"`{c.replace('`', '``')}`") for c in self.columns]
        self.own = [f"own{k}" for k in range(len(self.columns))]
        self.rows = df.select(*[c.alias(n) for c, n in zip(quoted, self.own, strict=True)], *[e.alias(n) for n, e in needed.items()])

    def back(self, df: DataFrame, **added: Column) -> DataFrame:
        """The caller's columns, but for those named like ``added`` ones, and these."""
        kept = [F.col(n).alias(c) for c, n in zip(self.columns, self.own, strict=True) if c not in added]
        return df.select(*kept, *[e.alias(n) for n, e in added.items()])
