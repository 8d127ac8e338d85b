"""Deleting source files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions.storage import default_storage, resolver
from pagemill.operators.filters import indexed_only
from pagemill.sources.documents import deal_out

_REPORT = "path string, deleted boolean, error string"


def remove_sources(
    sources: DataFrame,
    index: DataFrame,
    report_dir: str | None = None,
    dry_run: bool = True,
    num_partitions: int | None = None,
) -> DataFrame:
    """Deletes the sources that have an index record; returns ``(path, deleted, error)``.

    A dry run, the default, only lists them. A real run needs ``report_dir``: the report is written there once and read
    back, so looking at it never deletes anything again. A file that is not found is deleted only if an earlier try with
    the same ``report_dir`` says so; each try adds to the report.
    """
    paths = indexed_only(sources.select("path").distinct(), index)
    if dry_run:
        return paths.select("path", F.lit(False).alias("deleted"), F.lit(None).cast("string").alias("error"))
    if report_dir is None:
        raise ValueError("a real run needs report_dir")

    resolve = resolver(default_storage(sources.sparkSession))

    def remove(frames):
        from pyarrow import fs

        def delete(path):
            system, place = resolve(path)
            kind = system.get_file_info(place).type
            if kind == fs.FileType.Directory:
                system.delete_dir(place)
            elif kind == fs.FileType.NotFound:
                raise FileNotFoundError(place)
            else:
                system.delete_file(place)

        for frame in frames:
            errors = []
            for path in frame["path"]:
                try:
                    delete(path)
                    errors.append(None)
                except Exception as e:  # a file that stays is a row of the report
                    errors.append(f"{type(e).__name__}: {e}")
            yield frame[["path"]].assign(deleted=[e is None for e in errors], error=errors)

    removed = deal_out(paths, num_partitions, "path").mapInPandas(remove, _REPORT)
    removed.write.parquet(f"{report_dir}/try={uuid.uuid4().hex}")
    tries = sources.sparkSession.read.schema(_REPORT).parquet(report_dir)
    deleted = F.bool_or("deleted")
    return tries.groupBy("path").agg(deleted.alias("deleted"), F.when(~deleted, F.max("error")).alias("error"))
