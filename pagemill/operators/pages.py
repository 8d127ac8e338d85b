"""Pages: batches of page numbers, numbering, footers and whole documents.

A page table is ``(path, page_no, page_text, ...)`` with one row per page. ``page_text`` is ``''`` for a page that could
not be recognised and NULL for a page that was never rendered; the latter has no place in a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions import text as T
from pagemill.functions.fixed import HOCR_FOOTER, HOCR_HEADER, MAX_PAGES
from pagemill.functions.spans import stored, with_start

# Pages that one task numbers together. Results do not depend on it.
_SPAN = 1000


def plan_page_batches(df: DataFrame, max_pages: int = MAX_PAGES) -> DataFrame:
    """``(path, n_pages, ...)`` to ``(path, batch_no, first_page, last_page)``: 1..n without gap or empty batch."""
    size = F.lit(max_pages)
    batch = F.explode(F.sequence(F.lit(0), F.ceil(F.col("n_pages") / size).cast("int") - 1))
    rest = [c for c in df.columns if c not in ("path", "n_pages")]
    return (
        df.where(F.col("n_pages") > 0)
        .select("path", "n_pages", batch.alias("batch_no"), *rest)
        .select(
            "path",
            "batch_no",
            (F.col("batch_no") * size + 1).cast("int").alias("first_page"),
            F.least((F.col("batch_no") + 1) * size, F.col("n_pages")).cast("int").alias("last_page"),
            *rest,
        )
    )


def number_pages(df: DataFrame, texts: str = "texts", first_page: str = "first_page") -> DataFrame:
    """An array of page texts per batch to one row per page, numbered on from the batch's first page."""
    rest = [c for c in df.columns if c not in (texts, first_page)]
    return df.select(*rest, F.col(first_page), F.posexplode(texts).alias("pos", "page_text")).select(
        *rest, (F.col("pos") + F.col(first_page)).cast("int").alias("page_no"), "page_text"
    )


def _explode_pages(df: DataFrame, pages: Column) -> DataFrame:
    # The outer form: for the inner form Spark also computes the array in a filter below it.
    exploded = df.select("path", F.explode_outer(pages).alias("page")).where(F.col("page").isNotNull())
    return exploded.select(
        "path",
        "page.page_no",
        "page.page_text",
        F.lit(True).alias("ok"),
        F.lit(None).cast("string").alias("error"),
    )


def extract_text_pages(df: DataFrame, lines_per_page: int | None = None, mark: str = "\f") -> DataFrame:
    """Built-in extractor for plain text: pages end at a mark, or after a number of lines. No Python, no shuffle."""
    pages = T.pages_by_mark("text", mark) if lines_per_page is None else T.pages_by_lines("text", lines_per_page)
    return _explode_pages(df, pages)


def extract_html_pages(df: DataFrame, col: str = "html") -> DataFrame:
    """Built-in extractor for HTML: one page with the visible text."""
    return _explode_pages(
        df, F.array(F.struct(F.lit(1).alias("page_no"), T.html_text(col).alias("page_text")))
    )


def count_pages(pages: DataFrame) -> DataFrame:
    return pages.groupBy("path").agg(F.count(F.lit(1)).cast("int").alias("n_pages"))


def sort_pages(pages: DataFrame) -> DataFrame:
    """``(path, pages)``: the pages of each document as an array in page order."""
    kept = pages.where(F.col("page_text").isNotNull())
    page = F.struct("page_no", "page_text")
    return kept.groupBy("path").agg(F.array_sort(F.collect_list(page)).alias("pages"))


def _parts(pages: DataFrame, span_size: int, folder: str | None) -> DataFrame:
    """``(path, span, pages, start)``: rendered pages in spans of page numbers, and how many come before a span.

    The pages are computed and shuffled once, into one row per span, and stored; sizes are summed up from what was stored. So no
    task holds more than one span, whatever share of all pages one document has.
    """
    span = F.floor((F.col("page_no") - 1) / F.lit(span_size)).cast("int")
    rest = [c for c in pages.columns if c not in ("path", "page_no", "page_text")]
    # A condition here would be moved below the computation of the text, and compute it again; the list leaves nulls out.
    page = F.when(F.col("page_text").isNotNull(), F.struct("page_no", "page_text", *rest))
    in_order = F.array_sort(
        F.collect_list(page), lambda a, b: F.when(a["page_no"] < b["page_no"], -1).when(a["page_no"] > b["page_no"], 1).otherwise(0)
    )
    grouped = pages.groupBy("path", span.alias("span")).agg(in_order.alias("pages")).where(F.size("pages") > 0)
    spans = stored(grouped, "page-spans", folder)
    return with_start(spans.withColumn("n", F.size("pages")), ["path"], "n").drop("n")


def page_footer(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Appends the numbered footer to each page, and ``footer_no``; the number counts the pages a document really has.

    The pages are evaluated once, here, and stored in ``folder`` or in a new folder below ``spark.checkpoint.dir``.
    """
    rest = [c for c in pages.columns if c not in ("path", "page_no", "page_text")]
    each = _parts(pages, _SPAN, folder).select("path", "start", F.posexplode("pages").alias("k", "p"))
    numbered = each.select("path", "p.*", (F.col("start") + F.col("k") + 1).cast("int").alias("footer_no"))
    footed = F.concat("page_text", T.footer("footer_no")).alias("page_text")
    return numbered.select(*[footed if c == "page_text" else F.col(c) for c in ("path", "page_no", "page_text", *rest)], "footer_no")


def assemble_document(pages: DataFrame) -> DataFrame:
    """``(path, content, n_pages)``: pages in order, each with its footer, as one text.

    One shuffle, on ``path``. A document's text is one value, so its pages have to meet in one row; what does not
    fit one value (2 GB in Spark) is assembled with :func:`assemble_parts`.
    """
    return sort_pages(pages).select(
        "path", T.footed_text("pages").alias("content"), F.size("pages").alias("n_pages")
    )


def assemble_paged(df: DataFrame, pages: Column) -> DataFrame:
    """:func:`assemble_document` for documents whose pages are still in one row. No shuffle."""
    rest = [c for c in df.columns if c not in ("path", "text", "content", "n_pages")]
    document = T.bind(
        pages, lambda p: F.struct(T.footed_text(p).alias("content"), F.size(p).alias("n_pages"))
    )
    return T.once(df.select("path", "text", *rest), "_document", document).select(
        "path", "_document.content", "_document.n_pages", *rest
    )


def assemble_parts(pages: DataFrame, pages_per_part: int = _SPAN, folder: str | None = None) -> DataFrame:
    """``(path, part_no, content, n_pages)``: the text of :func:`assemble_document` cut at page borders.

    Joined in ``part_no`` order the parts are the document. No row or task holds more than one part, so one document
    may be any share of the data. The pages are evaluated once, here, and stored as for :func:`page_footer`; their texts are shuffled once.
    """
    footed = F.transform("pages", lambda p, k: F.concat(p["page_text"], T.footer(F.col("start") + k + 1)))
    return _parts(pages, pages_per_part, folder).select(
        "path", F.col("span").alias("part_no"), F.array_join(footed, "").alias("content"), F.size("pages").alias("n_pages")
    )


def concat_pages(pages: DataFrame, col: str = "page_text", out: str = "content") -> DataFrame:
    """Page texts of a document in order, with nothing between them."""
    kept = pages.where(F.col(col).isNotNull())
    joined = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("page_no", col))), lambda p: p[col]), ""
    )
    return kept.groupBy("path").agg(joined.alias(out))


def render_hocr(fragments: DataFrame, col: str = "fragment") -> DataFrame:
    """``(path, hocr)``: page fragments in order inside the fixed HTML document."""
    body = concat_pages(fragments, col, "body")
    return body.select("path", F.concat(F.lit(HOCR_HEADER), "body", F.lit(HOCR_FOOTER)).alias("hocr"))
