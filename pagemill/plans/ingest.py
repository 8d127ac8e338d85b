"""Whole jobs: from documents to index records."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions import text as T
from pagemill.functions.fixed import LANGUAGE, MAX_PAGES, SOURCE_EXTENSION
from pagemill.operators.classify import attach_classification, classify_rules
from pagemill.operators.extract import complete_documents, document_page_counts, extract_pages, failed_pages
from pagemill.operators.filters import drop_blank, filter_extension
from pagemill.operators.pages import assemble_document, assemble_paged, assemble_parts, plan_page_batches
from pagemill.operators.records import index_record, preview
from pagemill.sinks.archive import archive
from pagemill.sinks.index import upsert_index
from pagemill.sinks.removal import remove_sources
from pagemill.sinks.texts import write_part_files, write_text_files, write_texts
from pagemill.sources.documents import scan_documents
from pagemill.sources.index import batch_records, read_index

# (path, content, n_pages) to the same with a classification, or to (path, classification)
Classifier = Callable[[DataFrame], DataFrame]


def index_texts(
    docs: DataFrame,
    pages: Column,
    rules: Sequence[tuple[str, str]],
    run_ts: datetime,
    ext: str = SOURCE_EXTENSION,
) -> DataFrame:
    """``(path, text)`` to index records in one stage: no shuffle, no Python.

    Pages, footers, the assembled text and its category are all made inside the row of the document.
    """
    assembled = assemble_paged(filter_extension(docs, ext), pages)
    classified = classify_rules(assembled, rules, col=T.flatten("content"))
    return index_record(drop_blank(classified, "classification"), run_ts)


@dataclass(frozen=True)
class IngestResult:
    """``failed``: ``(path, page_no, error)`` of pages not read, and, without a page number, of documents not loaded."""

    pages: DataFrame
    documents: DataFrame
    index: DataFrame
    archived: str
    removed: DataFrame
    failed: DataFrame


def ingest_pages(
    pages: DataFrame,
    out: str,
    run_id: str,
    run_ts: datetime,
    classifier: Classifier,
    text_dir: str | None = None,
    root: str = "/",
    sequence: int | None = None,
    pages_per_part: int | None = None,
) -> tuple[DataFrame, str]:
    """Page table to texts, index and archive. Returns the texts as stored and the archive's folder.

    With ``pages_per_part`` documents are held in parts, rows ``(path, part_no, content, n_pages)`` of so many pages, from the pages to the
    files, so a document may be longer than a value of Spark. The classifier then gets the parts and answers by path
    (:func:`classify_parts`); the index has one record per document, and the archive one line per part.

    Pages and texts are stored before they are used twice, so extraction and classification run once, and a lost
    executor costs a read and not another recognition. A classifier that adds its column to the documents needs no
    join. One that answers by path is joined to the previews for the index and to the texts for the archive. With
    ``text_dir`` each text is also written to a file.
    """
    if pages_per_part is not None:
        return _ingest_parts(pages, out, run_id, run_ts, classifier, text_dir, root, sequence, pages_per_part)
    assembled = assemble_document(pages)
    answers = classifier(assembled)
    if "content" in answers.columns:
        documents = write_texts(answers, f"{out}/texts", run_id)
        indexed = archived = drop_blank(documents, "classification")
    else:
        documents = write_texts(assembled, f"{out}/texts", run_id)
        categories = write_texts(classifier(documents), f"{out}/categories", run_id)
        known = drop_blank(categories, "classification")
        indexed = attach_classification(preview(documents), known)
        archived = attach_classification(documents, known)
    if text_dir is not None:
        write_text_files(documents, text_dir, f"{out}/text_files/run={run_id}", root)
    upsert_index(index_record(indexed, run_ts), f"{out}/index", run_id, sequence)
    return documents, archive(archived, f"{out}/archive", run_id)


def _ingest_parts(
    pages: DataFrame,
    out: str,
    run_id: str,
    run_ts: datetime,
    classifier: Classifier,
    text_dir: str | None,
    root: str,
    sequence: int | None,
    pages_per_part: int,
) -> tuple[DataFrame, str]:
    spans = f"{out}/spans/run={run_id}"
    parts = write_texts(assemble_parts(pages, pages_per_part, spans), f"{out}/texts", run_id)
    known = drop_blank(write_texts(classifier(parts), f"{out}/categories", run_id), "classification")
    # of a document's first part the beginning, which is all that the index holds
    first = preview(parts).groupBy("path").agg(F.min_by("content", "part_no").alias("content"))
    if text_dir is not None:
        write_part_files(parts, text_dir, f"{out}/text_files/run={run_id}", root)
    upsert_index(index_record(attach_classification(first, known), run_ts), f"{out}/index", run_id, sequence)
    return parts, archive(attach_classification(parts, known), f"{out}/archive", run_id)


def indexed_by(spark: SparkSession, out: str, run_id: str) -> DataFrame:
    """Names one run has put into the index."""
    return batch_records(spark, f"{out}/index", run_id)


def ingest(
    spark: SparkSession,
    root: str | list[str],
    out: str,
    run_id: str,
    run_ts: datetime,
    engine: Callable[[], object],
    classifier: Classifier,
    lang: str = LANGUAGE,
    max_pages: int = MAX_PAGES,
    num_partitions: int | None = None,
    text_dir: str | None = None,
    remove: bool = False,
    ranges_per_task: int = 64,
) -> IngestResult:
    """The batch job: scan a folder, read its pages, store texts, categories, index and archive, then drop sources.

    Sources are deleted only with ``remove``, only when all their pages were read, and only when the index holds their
    record. What could not be read is in ``failed``. Page counts are stored; the number of pages, at
    ``ranges_per_task`` ranges of ``MAX_PAGES`` pages, gives the number of extraction tasks, however small ``max_pages`` is. Until sources are deleted a run may be
    repeated under its ``run_id`` and replaces what it wrote; afterwards its sources are no longer all there, so the
    same ``run_id`` is refused.
    """
    doomed = f"{out}/to_remove"
    if _is_table(spark, f"{doomed}/run={run_id}"):
        raise ValueError(f"run {run_id} has already begun to delete its sources; take a new run_id")
    # Folders may overlap; a file that is listed twice is still one document.
    files = scan_documents(spark, root, extension=SOURCE_EXTENSION).select("path").distinct()
    counts = write_texts(document_page_counts(files, engine, num_partitions), f"{out}/counts", run_id)
    batches = plan_page_batches(counts.select("path", "n_pages"), max_pages)
    if num_partitions is None:
        n_pages = counts.agg(F.sum("n_pages")).first()[0] or 0
        per_task = ranges_per_task * max(max_pages, MAX_PAGES)
        num_partitions = max(spark.sparkContext.defaultParallelism, -(-n_pages // per_task))
    read = extract_pages(batches, engine, lang, num_partitions)
    pages = write_texts(read, f"{out}/pages", run_id)
    base = root if isinstance(root, str) else "/"
    documents, archived = ingest_pages(pages, out, run_id, run_ts, classifier, text_dir, base)
    mine = indexed_by(spark, out, run_id)
    complete = complete_documents(pages)
    removed = remove_sources(complete, mine)
    if remove:
        planned = write_texts(removed.select("path"), doomed, run_id)
        removed = remove_sources(planned, mine, f"{out}/removed/run={run_id}", dry_run=False)
    not_loaded = counts.where(~F.col("ok")).select("path", F.lit(None).cast("int").alias("page_no"), "error")
    failed = not_loaded.unionByName(failed_pages(pages))
    return IngestResult(pages, documents, read_index(spark, f"{out}/index"), archived, removed, failed)


def _is_table(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("path string").parquet(path)
        return True
    except AnalysisException:
        return False
