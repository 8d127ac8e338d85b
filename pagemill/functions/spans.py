"""Numbers over groups of any size, without a task that holds a whole group.

A group is cut into spans. Rows are numbered inside their span and stored, once; then the spans' totals, a row each, are summed up
over the group, and each span adds the sum of those before it. Most groups are one span, and those have nothing to add.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
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
        base = _OWN.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="pagemill-spans-"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """``df`` computed once: written to ``folder``, or to a new shared one, and read back."""
    place = folder or shared_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def with_start(spans: DataFrame, keys: list[str], total: str) -> DataFrame:
    """``spans`` with ``start``, the sum of ``total`` over the earlier spans of the group ``keys``.

    ``spans`` has the columns ``keys`` and ``span`` and any number of rows of a span, all with its total; it is read twice.
    """
    return _started(spans, _starts(spans, keys, total), keys)


def _starts(spans: DataFrame, keys: list[str], total: str) -> DataFrame:
    before = Window.partitionBy(*keys).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    summed = spans.groupBy(*keys, "span").agg(F.max(total).alias("n")).withColumn("start", F.sum("n").over(before))
    return summed.where(F.col("start") > 0).select(*keys, "span", "start")


def _started(spans: DataFrame, starts: DataFrame, keys: list[str]) -> DataFrame:
    return spans.join(starts, [*keys, "span"], "left").withColumn("start", F.coalesce("start", F.lit(0)))


def numbered(rows: DataFrame, keys: list[str], inside: str, name: str, folder: str | None = None) -> DataFrame:
    """``rows`` with ``number``: ``inside`` counts from 1 in each span, ``number`` in the whole group. Rows are stored once.

    So are the starts of later spans, which are few or none: Spark knows their size, and shuffles the rows only where they are many."""
    kept = stored(rows, name, folder)
    starts = stored(_starts(kept, keys, inside), f"{name}-starts", folder and f"{folder.rstrip('/')}-starts")
    return _started(kept, starts, keys).withColumn("number", F.col("start") + F.col(inside)).drop("start")
