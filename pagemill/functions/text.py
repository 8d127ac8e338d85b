"""Column expressions over paths and texts. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.fixed import (
    FOOTER_AFTER,
    FOOTER_BEFORE,
    PREVIEW_CHARS,
    SOURCE_EXTENSION,
    TEXT_EXTENSION,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extension(path: Column | str) -> Column:
    """Lower-cased text after the last dot; the whole path when it has no dot."""
    return F.lower(F.substring_index(_col(path), ".", -1))


def base_name(path: Column | str) -> Column:
    return F.substring_index(_col(path), "/", -1)


def strip_scheme(path: Column | str) -> Column:
    """``scheme:/x``, ``scheme:///x`` and plain ``/x`` all become ``/x``."""
    return F.regexp_replace(_col(path), r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/")


def text_name(name: Column | str) -> Column:
    """Lower-cased name with every ``.pdf`` turned into ``.txt``."""
    return F.replace(F.lower(_col(name)), F.lit(f".{SOURCE_EXTENSION}"), F.lit(f".{TEXT_EXTENSION}"))


def output_name(path: Column | str, out_dir: str) -> Column:
    return F.concat(F.lit(out_dir), text_name(base_name(path)))


def flatten(text: Column | str) -> Column:
    """One line: line feeds are removed, every other blank stays."""
    return F.replace(_col(text), F.lit("\n"), F.lit(""))


def preview(text: Column | str, n: int = PREVIEW_CHARS) -> Column:
    return F.substring(_col(text), 1, n)


def footer(number: Column | str) -> Column:
    return F.concat(F.lit(FOOTER_BEFORE), _col(number).cast("string"), F.lit(FOOTER_AFTER))


def html_text(html: Column | str) -> Column:
    """Visible text of an HTML page: scripts, styles and comments go, tags become one blank, blanks are squeezed."""
    dropped = F.regexp_replace(_col(html), r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", " ")
    untagged = F.regexp_replace(dropped, r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(untagged, r"[ \t\r\n]+", " "))


def terms(text: Column | str) -> Column:
    """Runs of letters and digits, lower-cased, in order; none for a null text."""
    return F.coalesce(F.regexp_extract_all(F.lower(_col(text)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), F.array().cast("array<string>"))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once per row however often ``body`` names it.

    An expression used inside a lambda is otherwise computed again for each element.
    """
    return F.transform(F.array(value), body)[0]


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once per row, also when it is both filtered on and selected.

    Spark moves a condition on a computed column below the computation by computing the column again. It does not
    move it below a generator, so the value is handed through one that gives exactly one row.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def pages_by_lines(text: Column | str, lines_per_page: int) -> Column:
    """``array<struct<page_no, page_text>>`` with a fixed number of lines on each page."""
    per_page = F.lit(lines_per_page)

    def pages(lines: Column) -> Column:
        last = F.ceil(F.size(lines) / per_page).cast("int") - 1
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.struct(
                (i + 1).alias("page_no"),
                F.array_join(F.slice(lines, i * per_page + 1, per_page), "\n").alias("page_text"),
            ),
        )

    return bind(F.split(_col(text), "\n"), pages)


def pages_by_mark(text: Column | str, mark: str = "\f") -> Column:
    """``array<struct<page_no, page_text>>``, one page between two marks (a form feed by default)."""
    quoted = "\\Q" + mark + "\\E"
    return F.transform(
        F.split(_col(text), quoted),
        lambda t, i: F.struct((i + 1).alias("page_no"), t.alias("page_text")),
    )


def footed_text(pages: Column | str) -> Column:
    """Text of a paged document held in one row: each page is followed by its numbered footer."""
    return F.array_join(
        F.transform(_col(pages), lambda p, i: F.concat(p["page_text"], footer(i + 1))), ""
    )
