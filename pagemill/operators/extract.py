"""Page extraction with a user's engine (PDF renderer, OCR, ...) inside Spark tasks.

An engine is any object with

* ``page_count(file) -> int``
* ``render(file, first_page, last_page) -> iterable of images`` for an inclusive, 1-based range
* ``recognize(image, lang, rect) -> str``; ``rect`` is None or ``(x, y, w, h)``, the part of the image to read
* for words: ``words(image, lang, rect, level) -> iterable of (text, confidence, x, y, w, h)``
* for regions: ``regions(image, level) -> iterable of (x, y, w, h)``
* for rasters: ``raster(image) -> iterable of lines of gray values``, and ``image(lines) -> image``
* optionally ``close()``

``file`` is a seekable binary file. A factory for the engine is passed, and called once per task, so that a costly
set-up is paid once and not for each document or batch.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from pagemill.functions.fixed import LANGUAGE
from pagemill.functions.frames import group_blocks
from pagemill.functions.storage import default_storage, resolver
from pagemill.sources.documents import deal_out

PAGE_SCHEMA = "path string, page_no int, page_text string, ok boolean, error string"
_WORD_SCHEMA = (
    "path string, page_no int, word_no int, text string, confidence float, box struct<x:int,y:int,w:int,h:int>, "
    "ok boolean, error string"
)
_REGION_SCHEMA = "path string, page_no int, region_no int, box struct<x:int,y:int,w:int,h:int>, ok boolean, error string"
_RASTER_SCHEMA = "path string, page_no int, y int, v array<int>, ok boolean, error string"
_RECT = ("rx", "ry", "rw", "rh")
_COUNT_SCHEMA = "path string, n_pages int, ok boolean, error string"


def _opener(spark: SparkSession) -> Callable[[str, Any], Any]:
    """How a task gets at a document: the bytes it was handed (an Arrow value), or the file on shared storage."""
    resolve = resolver(default_storage(spark))

    def open_document(path: str, content: Any) -> Any:
        import pyarrow as pa

        if content is not None and content.is_valid:
            return pa.BufferReader(content.as_buffer())
        system, place = resolve(path)
        return system.open_input_file(place)

    return open_document


def _batched() -> Callable[..., Any]:
    """Rows to record batches of bounded size; a row holds a tuple for a struct."""

    def batched(rows, schema):
        import pyarrow as pa

        def column(values, kind):
            if not pa.types.is_struct(kind):
                return pa.array(values, kind)
            missing = (None,) * kind.num_fields
            parts = zip(*[missing if v is None else v for v in values])
            fields = [kind.field(i) for i in range(kind.num_fields)]
            arrays = [pa.array(p, f.type) for p, f in zip(parts, fields)]
            return pa.StructArray.from_arrays(arrays, fields=fields, mask=pa.array([v is None for v in values]))

        def batch(rows):
            return pa.RecordBatch.from_arrays([column(v, f.type) for v, f in zip(zip(*rows), schema)], schema=schema)

        held, n_chars = [], 0
        sized = [i for i, f in enumerate(schema) if pa.types.is_string(f.type) or pa.types.is_list(f.type)]
        for row in rows:
            held.append(row)
            for i in sized:
                if row[i] is not None:
                    n_chars += len(row[i])
            if len(held) >= 2000 or n_chars >= 16_000_000:
                yield batch(held)
                held, n_chars = [], 0
        if held:
            yield batch(held)

    return batched


def document_page_counts(
    df: DataFrame, engine: Callable[[], Any], num_partitions: int | None = None
) -> DataFrame:
    """``(path, n_pages, ok, error)``. A file that cannot be loaded has 0 pages and its error; it stops nothing.

    Rows that carry paths and no bytes are dealt out first; see :func:`extract_pages`.
    """
    open_document, batched = _opener(df.sparkSession), _batched()

    arrow_schema = to_arrow_schema(StructType.fromDDL(_COUNT_SCHEMA))

    def count(batches):
        def counts(reader):
            for batch in batches:
                contents = batch.column("content") if "content" in batch.schema.names else [None] * batch.num_rows
                for path, content in zip(batch.column("path").to_pylist(), contents):
                    try:
                        with open_document(path, content) as file:
                            yield path, int(reader.page_count(file)), True, None
                    except Exception as e:  # a bad document is a row of the report
                        yield path, 0, False, f"{type(e).__name__}: {e}"

        reader = engine()
        try:
            yield from batched(counts(reader), arrow_schema)
        finally:
            getattr(reader, "close", lambda: None)()

    columns = [c for c in ("path", "content") if c in df.columns]
    rows = df.select(*columns)
    if "content" not in columns:
        rows = deal_out(rows, num_partitions, "path")
    return rows.mapInArrow(count, _COUNT_SCHEMA)


def _map_images(
    batches: DataFrame,
    engine: Callable[[], Any],
    num_partitions: int | None,
    schema: str,
    recognized: Callable[..., Any],
    lost: Callable[..., Any],
) -> DataFrame:
    """Renders each page range and maps its images to rows.

    ``recognized(reader, path, page_no, image, rect)`` gives the rows of an image, ``lost(path, page_no, error)`` the
    row of a page without an image.
    """
    open_document, batched = _opener(batches.sparkSession), _batched()
    rect_columns = _RECT
    arrow_schema = to_arrow_schema(StructType.fromDDL(schema))

    def extract(batches):
        def images(reader, row, content):
            page_no, last, error = row["first_page"], row["last_page"], "no image"
            try:
                with open_document(row["path"], content) as file:
                    for image in reader.render(file, page_no, last):
                        yield page_no, image, None
                        page_no += 1
            except Exception as e:
                error = f"{type(e).__name__}: {e}"
            for missing in range(page_no, last + 1):
                yield missing, None, error

        def rows(reader):
            for batch in batches:
                contents = batch.column("content") if "content" in batch.schema.names else [None] * batch.num_rows
                small = batch.select([n for n in batch.schema.names if n != "content"]).to_pylist()
                for row, content in zip(small, contents):
                    rect = tuple(row.get(c) for c in rect_columns)
                    rect = None if None in rect else rect
                    for page_no, image, error in images(reader, row, content):
                        if error is None:
                            yield from recognized(reader, row["path"], page_no, image, rect)
                        else:
                            yield lost(row["path"], page_no, error)

        reader = engine()
        try:
            yield from batched(rows(reader), arrow_schema)
        finally:
            getattr(reader, "close", lambda: None)()

    known = ("path", "content", "first_page", "last_page", *_RECT)
    ranges = batches.select(*[c for c in known if c in batches.columns])
    if "content" not in ranges.columns:
        ranges = deal_out(ranges, num_partitions, "path", "first_page")
    return ranges.mapInArrow(extract, schema)


def extract_pages(
    batches: DataFrame,
    engine: Callable[[], Any],
    lang: str = LANGUAGE,
    num_partitions: int | None = None,
) -> DataFrame:
    """``(path, first_page, last_page[, content][, rx, ry, rw, rh])`` to ``(path, page_no, page_text, ok, error)``.

    Without a ``content`` column each batch opens its file by path. Then page ranges are dealt out to
    ``num_partitions`` tasks (by default four per core and at least ``spark.sql.shuffle.partitions``), one large document
    is worked on by many of them, and its bytes never travel. Rows with bytes stay where they are.

    An error while a page is recognised gives ``''`` for that page. An error while a batch is rendered gives NULL for
    the pages of that batch that are missing.
    """

    def recognized(reader, path, page_no, image, rect):
        try:
            yield path, page_no, reader.recognize(image, lang, rect), True, None
        except Exception as e:
            yield path, page_no, "", False, f"{type(e).__name__}: {e}"

    def lost(path, page_no, error):
        return path, page_no, None, False, error

    return _map_images(batches, engine, num_partitions, PAGE_SCHEMA, recognized, lost)


def recognize_words(
    batches: DataFrame,
    engine: Callable[[], Any],
    level: str = "word",
    lang: str = LANGUAGE,
    num_partitions: int | None = None,
) -> DataFrame:
    """``(path, page_no, word_no, text, confidence, box, ok, error)`` as the engine sees them.

    An error while a page is recognised keeps the words found so far. It, and a page that cannot be rendered, add a row
    with ``ok`` false, the error and nothing else.
    """

    def recognized(reader, path, page_no, image, rect):
        try:
            for n, (text, confidence, x, y, w, h) in enumerate(reader.words(image, lang, rect, level)):
                yield path, page_no, n, text, confidence, (x, y, w, h), True, None
        except Exception as e:
            yield lost(path, page_no, f"{type(e).__name__}: {e}")

    def lost(path, page_no, error):
        return path, page_no, None, None, None, None, False, error

    return _map_images(batches, engine, num_partitions, _WORD_SCHEMA, recognized, lost)


def segment_regions(
    batches: DataFrame, engine: Callable[[], Any], level: str = "line", num_partitions: int | None = None
) -> DataFrame:
    """``(path, page_no, region_no, box, ok, error)`` as the engine sees them; errors as in :func:`recognize_words`."""

    def recognized(reader, path, page_no, image, rect):
        try:
            for n, (x, y, w, h) in enumerate(reader.regions(image, level)):
                yield path, page_no, n, (x, y, w, h), True, None
        except Exception as e:
            yield lost(path, page_no, f"{type(e).__name__}: {e}")

    def lost(path, page_no, error):
        return path, page_no, None, None, False, error

    return _map_images(batches, engine, num_partitions, _REGION_SCHEMA, recognized, lost)


def render_rasters(batches: DataFrame, engine: Callable[[], Any], num_partitions: int | None = None) -> DataFrame:
    """``(path, page_no, y, v, ok, error)``: the pixels of each rendered page, a row per line, for the raster operators.

    The engine gives them with ``raster(image) -> iterable of lines of gray values``. A page without pixels is one row
    with its error.
    """

    def recognized(reader, path, page_no, image, rect):
        try:
            for y, line in enumerate(reader.raster(image)):
                yield path, page_no, y, line, True, None
        except Exception as e:
            yield lost(path, page_no, f"{type(e).__name__}: {e}")

    def lost(path, page_no, error):
        return path, page_no, None, None, False, error

    return _map_images(batches, engine, num_partitions, _RASTER_SCHEMA, recognized, lost)


def recognize_rasters(lines: DataFrame, engine: Callable[[], Any], lang: str = LANGUAGE) -> DataFrame:
    """Lines ``(path, page_no, y, v)``, cleaned for example, to the page table of :func:`extract_pages`.

    The engine makes an image of them with ``image(lines)``. The lines of one page meet in one task, which makes one engine for all
    its pages.
    """
    blocks, columns = group_blocks, ["path", "page_no", "page_text", "ok", "error"]

    def recognize(batches):
        import pandas as pd

        def row(reader, path, page_no, lines):
            try:
                return path, page_no, reader.recognize(reader.image(lines), lang, None), True, None
            except Exception as e:
                return path, page_no, "", False, f"{type(e).__name__}: {e}"

        reader = engine()
        try:
            for frame, starts in blocks(batches, ["path", "page_no"]):
                paths, numbers, lines = (frame[c].to_list() for c in ("path", "page_no", "v"))
                starts = starts.tolist()
                pages = zip(starts, [*starts[1:], len(lines)], strict=True)
                yield pd.DataFrame([row(reader, paths[a], numbers[a], lines[a:b]) for a, b in pages], columns=columns)
        finally:
            getattr(reader, "close", lambda: None)()

    known = F.col("v").isNotNull() & F.col("path").isNotNull() & F.col("page_no").isNotNull()
    rows = lines.where(known).select("path", "page_no", "y", "v")
    in_order = rows.repartition("path", "page_no").sortWithinPartitions("path", "page_no", "y")
    return in_order.mapInPandas(recognize, PAGE_SCHEMA)


def complete_documents(pages: DataFrame) -> DataFrame:
    """``(path)`` of the documents all of whose pages were read."""
    return pages.groupBy("path").agg(F.bool_and("ok").alias("ok")).where("ok").select("path")


def failed_pages(pages: DataFrame) -> DataFrame:
    """What a run could not read: one row per page with its error."""
    return pages.where(~F.col("ok")).select("path", "page_no", "error")
