"""The same job as a stream: each file of a folder is handled once, in micro-batches."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from pagemill.functions.fixed import SOURCE_EXTENSION
from pagemill.functions.storage import exists, list_folders
from pagemill.operators.extract import complete_documents, failed_pages
from pagemill.plans.ingest import Classifier, indexed_by, ingest_pages
from pagemill.sinks.removal import remove_sources
from pagemill.sinks.texts import write_texts
from pagemill.sources.documents import document_list_stream, list_new_documents, scan_document_stream, with_content

# (path, modificationTime, length, content) to a page table
Extractor = Callable[[DataFrame], DataFrame]


_PREFIX = "batch"


def _run_id(batch: int) -> str:
    return f"{_PREFIX}{batch:012d}"


def ingest_stream(
    spark: SparkSession,
    root: str,
    out: str,
    checkpoint: str,
    run_ts: Callable[[int], datetime],
    extractor: Extractor,
    classifier: Classifier,
    extension: str | None = SOURCE_EXTENSION,
    max_files: int = 10_000,
    remove: bool = False,
    available_now: bool = True,
    text_dir: str | None = None,
) -> StreamingQuery:
    """Starts the stream. ``run_ts`` gives the date of a micro-batch from its number.

    Every output of a micro-batch goes to a folder named after its number, so a batch that is repeated after a failure
    replaces what it wrote. For the same reason a batch must still find its sources: with ``remove`` they are deleted
    by the batch that follows, once theirs is committed, and those of the last batch by :func:`remove_ingested`. Only
    sources all of whose pages were read are deleted; :func:`failed_documents` lists the others. With ``text_dir`` each
    text is also written to a file, below it as the source is below ``root``.

    With ``available_now`` the files are listed by tasks, into lists of ``max_files`` below ``checkpoint``, and the stream is over the lists,
    so the driver holds no file's name. A stream that goes on watches ``root`` with Spark's source, which lists on
    the driver; so does one whose checkpoint was begun with it.
    """
    lists = f"{checkpoint}/lists"
    by_lists = exists(spark, lists) or (available_now and not exists(spark, f"{checkpoint}/offsets"))
    if by_lists and not available_now:
        raise ValueError("the checkpoint was begun with available_now; a stream that goes on needs a new one")

    def handle(found: DataFrame, batch: int) -> None:
        files = with_content(found) if by_lists else found
        if remove and batch > 0:
            _remove_batch(files.sparkSession, out, _run_id(batch - 1))
        run_id = _run_id(batch)
        write_texts(files.select("path"), f"{out}/sources", run_id)
        pages = write_texts(extractor(files), f"{out}/pages", run_id)
        ingest_pages(pages, out, run_id, run_ts(batch), classifier, text_dir, root)

    if by_lists:
        list_new_documents(spark, root, lists, extension, max_files)
    source = document_list_stream(spark, lists) if by_lists else scan_document_stream(spark, root, extension, max_files)
    writer = (
        source.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _remove_batch(spark: SparkSession, out: str, run_id: str) -> DataFrame:
    complete = complete_documents(spark.read.parquet(f"{out}/pages/run={run_id}"))
    return remove_sources(
        complete, indexed_by(spark, out, run_id), f"{out}/removed/run={run_id}", dry_run=False
    )


def remove_ingested(spark: SparkSession, out: str, query: StreamingQuery) -> DataFrame | None:
    """Deletes the indexed sources of the last committed micro-batch of a stream that has ended."""
    if query.isActive:
        raise ValueError("the stream is still running")
    if query.exception() is not None:
        raise ValueError("the last micro-batch failed; its sources are still needed")
    runs = [n.removeprefix("run=") for n in list_folders(spark, f"{out}/texts") if n.startswith(f"run={_PREFIX}")]
    return _remove_batch(spark, out, max(runs)) if runs else None


def failed_documents(spark: SparkSession, out: str) -> DataFrame:
    """``(path, page_no, error)`` over all micro-batches: pages not read, and sources without any page."""
    pages = spark.read.schema("path string, page_no int, ok boolean, error string, run string").parquet(f"{out}/pages")
    sources = spark.read.schema("path string, run string").parquet(f"{out}/sources")
    without = sources.join(pages.select("path", "run"), ["path", "run"], "left_anti")
    no_page = without.select("path", F.lit(None).cast("int").alias("page_no"), F.lit("no page").alias("error"))
    return no_page.unionByName(failed_pages(pages))
