"""Folders of files as DataFrames."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.functions.spans import numbered, shared_folder, stored
from pagemill.functions.storage import default_storage, is_folder, list_files, make_folder, qualified, resolver

_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
_PATTERN = re.compile(r"[*?\[\]{}\\]")
#: Bytes of files that a task hands on together.
_READ_BYTES = 1 << 24


def _glob(extension: str | None) -> str:
    """A file glob that ignores case, so that unwanted files drop out while the folder is listed."""
    if extension is None:
        return "*"
    return "*." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in extension)


def scan_documents(
    spark: SparkSession,
    root: str | list[str],
    recursive: bool = True,
    extension: str | None = None,
) -> DataFrame:
    """Every file below ``root`` as ``(path, modificationTime, length, content)``.

    Folders are listed by tasks, a level of sub-folders after the other, when this is called, and the list is stored below
    ``spark.checkpoint.dir``: the driver holds no file's name. One task lists a folder. ``content`` is read only when a query asks for it,
    by tasks that the files are dealt out to; see :func:`deal_out`. As with Spark's own file sources hidden and empty files are no documents.

    Patterns, single files, places that only Spark can read, and folders that are not ``recursive`` are left to Spark's
    source, which lists on the driver.
    """
    roots = [root] if isinstance(root, str) else list(root)
    if not recursive or not all(_is_listed(spark, r) for r in roots) or _PATTERN.search(extension or ""):
        return (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", str(recursive).lower())
            .option("pathGlobFilter", _glob(extension))
            .load(root)
        )
    return with_content(_listed(spark, [qualified(spark, r) for r in roots], extension))


def _is_listed(spark: SparkSession, root: str) -> bool:
    """Whether ``root`` is a folder that tasks can list."""
    if _PATTERN.search(root):
        return False
    try:
        resolver(default_storage(spark))(root)
    except Exception:  # no such storage, or none that Arrow knows
        return False
    return is_folder(spark, root)


def _listed(spark: SparkSession, roots: list[str], extension: str | None) -> DataFrame:
    """``(path, modificationTime, length)`` of the files below ``roots``, stored."""
    resolve = resolver(default_storage(spark))
    ending = None if extension is None else f".{extension.lower()}"

    def entries(folder):
        import os

        from pyarrow import fs

        system, place = resolve(folder)
        if isinstance(system, fs.LocalFileSystem):
            with os.scandir(place) as found:
                for entry in found:
                    try:
                        stat, is_folder = entry.stat(), entry.is_dir()
                        entry.name.encode("utf-8")
                    except (FileNotFoundError, UnicodeEncodeError):  # it went, or no path names it
                        continue
                    yield entry.name, is_folder, stat.st_mtime_ns, stat.st_size
        else:
            for info in system.get_file_info(fs.FileSelector(place)):
                is_folder = info.type == fs.FileType.Directory
                yield info.base_name, is_folder, info.mtime_ns or 0, info.size or 0

    def hidden(name):
        return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")

    def list_folders(frames):
        def frame(rows):
            return pd.DataFrame(rows, columns=["path", "is_folder", "ms", "length"])

        for folders in frames:
            rows = []
            for folder in folders["path"]:
                for name, is_folder, ns, length in entries(folder):
                    wanted = is_folder or (length > 0 and (ending is None or name.lower().endswith(ending)))
                    if wanted and not hidden(name):
                        rows.append((f"{folder.rstrip('/')}/{name}", is_folder, ns // 1_000_000, length))
                    if len(rows) >= 10_000:
                        yield frame(rows)
                        rows = []
            if rows:
                yield frame(rows)

    folders, levels = spark.createDataFrame([(r,) for r in roots], "path string"), []
    while not levels or not folders.isEmpty():
        found = deal_out(folders, None, "path").mapInPandas(list_folders, "path string, is_folder boolean, ms long, length long")
        levels.append(stored(found, "listing"))
        folders = levels[-1].where("is_folder").select("path")
    everything = reduce(DataFrame.unionByName, levels)
    files = everything.where("NOT is_folder").select("path", F.timestamp_millis("ms").alias("modificationTime"), "length")
    return files.dropDuplicates(["path"]) if len(roots) > 1 else files  # folders may overlap


def with_content(files: DataFrame) -> DataFrame:
    """``files`` dealt out, with their ``content``, which is read where a query asks for it."""
    resolve = resolver(default_storage(files.sparkSession))
    held = _READ_BYTES

    @F.pandas_udf("binary")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for paths in batches:
            contents, size = [], 0
            for path in paths:
                system, place = resolve(path)
                with system.open_input_stream(place) as file:
                    contents.append(file.read())
                size += len(contents[-1])
                if size >= held:
                    yield pd.Series(contents, dtype=object)
                    contents, size = [], 0
            if contents:
                yield pd.Series(contents, dtype=object)

    return deal_out(files, None, "path").select("path", "modificationTime", "length", read("path").alias("content"))


def scan_document_stream(
    spark: SparkSession,
    root: str,
    extension: str | None = None,
    max_files: int = 10_000,
) -> DataFrame:
    """The same rows as a stream; ``max_files`` bounds one micro-batch."""
    return (
        spark.readStream.format("binaryFile")
        .schema(_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", _glob(extension))
        .option("maxFilesPerTrigger", str(max_files))
        .load(root)
    )


_LISTED = "path string, modificationTime timestamp, length long"


def list_new_documents(spark: SparkSession, root: str, lists: str, extension: str | None = None, max_files: int = 10_000) -> int:
    """Adds the files below ``root`` that no list in the folder ``lists`` has to new lists there, oldest first; returns their number.

    A list is a Parquet file of ``(path, modificationTime, length)`` of up to ``max_files`` files. All but its number stays with the tasks.
    What a run that failed has not listed, the next one does.
    """
    make_folder(spark, lists)
    files = scan_documents(spark, root, extension=extension).select("path", "modificationTime", "length")
    if list_files(spark, lists):
        files = files.join(spark.read.schema(_LISTED).parquet(lists).select("path"), "path", "left_anti")
    in_order = files.repartitionByRange("modificationTime", "path").withColumn("span", F.spark_partition_id())
    inside = Window.partitionBy("span").orderBy("modificationTime", "path")
    counted = in_order.withColumn("inside", F.row_number().over(inside)).withColumn("all", F.lit(0))
    new = numbered(counted, ["all"], "inside", "new-files")
    n = new.count()
    n_lists = -(-n // max_files)
    if n:
        dealt = new.withColumn("list", F.floor((F.col("number") - 1) / F.lit(max_files)).cast("int")).repartitionById(n_lists, F.col("list"))
        beside = shared_folder(spark, "new-lists")
        dealt.select("path", "modificationTime", "length", "list").write.partitionBy("list").parquet(beside)
    for k in range(n_lists):  # one by one: a stream takes files by their time
        spark.read.schema(_LISTED).parquet(f"{beside}/list={k}").coalesce(1).write.mode("append").parquet(lists)
    return n


def document_list_stream(spark: SparkSession, lists: str) -> DataFrame:
    """The lists of :func:`list_new_documents` as a stream, a list to a micro-batch; :func:`with_content` reads the files."""
    reader = spark.readStream.schema(_LISTED).option("maxFilesPerTrigger", "1").option("maxFileAge", "36500d")
    return reader.parquet(lists)


def deal_out(df: DataFrame, num_partitions: int | None, *keys: str) -> DataFrame:
    """Deals out small rows that stand for much work, such as paths of files to open.

    The number of tasks is fixed (by default four per core and at least ``spark.sql.shuffle.partitions``): going by the
    size of the rows, Spark would put them all in one task.
    """
    if num_partitions is None:
        spark = df.sparkSession
        shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
        num_partitions = max(shuffle, 4 * spark.sparkContext.defaultParallelism)
    return df.repartition(num_partitions, *keys)


def decode_documents(files: DataFrame, encoding: str = "UTF-8") -> DataFrame:
    """Files that already hold text: ``text`` in place of ``content``, the other columns as they are."""
    rest = [c for c in files.columns if c not in ("content", "text")]
    return files.select(*rest, F.decode("content", encoding).alias("text"))


def union_sources(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two scans one after the other; a file found by both is kept twice."""
    return a.unionByName(b)
