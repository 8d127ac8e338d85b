"""Full records as compressed JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.functions.spans import with_start

_SCHEMA = "path string, content string, classification string"
#: Bins of records for each file, and bins that are summed up together.
_BINS, _SPAN = 16, 1024


def archive(df: DataFrame, out_dir: str, run_id: str, max_records: int = 100_000, max_bytes: int = 1 << 28) -> str:
    """Writes ``(path, content, classification)`` as gzip JSON lines to a folder of its own and returns the folder.

    A text of many lines is still one line of the file. Gzip files are read by one task each, so texts of more than ``max_bytes``
    in all are dealt out to files of equal bytes, whatever the texts' lengths: records fall into bins by the hash of their path and text,
    a file takes bins until it is full, and each file is a task of its own. A file also ends after ``max_records`` records. ``df`` is read again for its sizes.
    """
    target = f"{out_dir}/{run_id}"
    size = F.coalesce(F.octet_length("content"), F.lit(0)).cast("long")
    total = df.agg(F.sum(size)).first()[0] or 0
    files = max(1, -(-total // max_bytes))
    records = df.select("path", "content", "classification")
    if files > 1:
        records = _dealt(records, size, total, files)
    writer = records.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", str(max_records))
    (writer.partitionBy("part") if files > 1 else writer).json(target)
    return target


def _dealt(records: DataFrame, size, total: int, files: int) -> DataFrame:
    """``records`` with ``part``, the file that each goes to."""
    binned = records.withColumn("bin", F.pmod(F.xxhash64("path", "content"), F.lit(_BINS * files)))
    sums = binned.groupBy("bin").agg(F.sum(size).alias("bytes")).withColumn("span", F.floor(F.col("bin") / _SPAN).cast("int"))
    inside = Window.partitionBy("span").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    in_span = sums.withColumn("before", F.coalesce(F.sum("bytes").over(inside), F.lit(0))).withColumn(
        "of_span", F.sum("bytes").over(Window.partitionBy("span"))
    )
    starts = with_start(in_span.withColumn("all", F.lit(0)), ["all"], "of_span")
    part = F.floor((F.col("start") + F.col("before")) * F.lit(files) / F.lit(max(1, total))).cast("int")
    parts = starts.select("bin", F.least(F.lit(files - 1), part).alias("part"))
    return binned.join(F.broadcast(parts), "bin").drop("bin").repartitionById(files, F.col("part"))


def read_archive(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).json(target).select("path", "content", "classification")
