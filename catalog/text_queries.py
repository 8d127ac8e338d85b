"""Queries over documents, pages, words and records."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

import pagemill as pm
from catalog import fixtures as fx
from catalog.workspace import new_folder
from pagemill.functions import text as T

FOOTED = fx.FOOTER_SQL.format(n="row_number() OVER (PARTITION BY path ORDER BY page_no)")
FOOTED_PAGES = (
    fx.PAGES
    + f""",
footed AS (
  SELECT path, page_no, page_text || {FOOTED} AS page_text,
         (row_number() OVER (PARTITION BY path ORDER BY page_no))::INTEGER AS footer_no
  FROM pages_in),
assembled AS (
  SELECT path, string_agg(page_text, '' ORDER BY page_no) AS content, count(*)::INTEGER AS n_pages
  FROM footed GROUP BY path)"""
)
EXTENSION = "lower(split_part(path, '.', -1))"


def filter_extension(spark, sf):
    return pm.filter_extension(fx.sources(spark, sf)).select("path", "text")


def drop_blank(spark, sf):
    classified = pm.classify_rules(fx.contents(spark, sf), fx.RULES)
    return pm.drop_blank(classified, "classification").select("path", "classification")


def contains_text(spark, sf):
    assembled = pm.assemble_paged(fx.sources(spark, sf), fx.pages_column())
    return pm.contains_text(assembled, fx.NEEDLE).select("path", "n_pages")


def flatten_text(spark, sf):
    return pm.flatten_text(fx.contents(spark, sf))


def index_record(spark, sf):
    classified = pm.classify_rules(fx.contents(spark, sf), fx.RULES)
    return pm.index_record(classified, fx.FIRST_RUN)


def preview(spark, sf):
    return pm.preview(fx.contents(spark, sf))


def output_name(spark, sf):
    return pm.output_name(fx.sources(spark, sf).select("path"), "/out/")


def strip_scheme(spark, sf):
    pages = fx.table(spark, sf, "pages").select(F.col("url").alias("path"))
    return pm.strip_scheme(fx.sources(spark, sf).select("path").unionByName(pages))


def page_footer(spark, sf):
    return pm.page_footer(fx.pages(spark, sf)).select("path", "page_no", "footer_no", "page_text")


def plan_page_batches(spark, sf):
    return pm.plan_page_batches(pm.count_pages(fx.pages(spark, sf)), fx.MAX_PAGES)


def extract_text_pages(spark, sf):
    return fx.pages(spark, sf).select("path", "page_no", "page_text", "ok")


def extract_marked_pages(spark, sf):
    """Pages end at a mark; the mark here is a full stop with a line feed."""
    return pm.extract_text_pages(fx.sources(spark, sf), mark=".\n").select("path", "page_no", "page_text", "ok")


def extract_html_pages(spark, sf):
    html = fx.table(spark, sf, "pages").select(F.col("url").alias("path"), "html")
    return pm.extract_html_pages(html).select("path", "page_no", "page_text", "ok")


def number_pages(spark, sf):
    """Batches of page texts, numbered on from the first page of their batch."""
    texts = F.transform(fx.pages_column(), lambda p: p["page_text"])
    size = fx.MAX_PAGES
    batches = T.bind(
        texts,
        lambda t: F.transform(
            F.sequence(F.lit(0), F.greatest(F.lit(1), F.ceil(F.size(t) / size).cast("int")) - 1),
            lambda b: F.struct(b.alias("batch_no"), F.slice(t, b * size + 1, F.lit(size)).alias("texts")),
        ),
    )
    dealt = fx.sources(spark, sf).select("path", F.explode(batches).alias("b"))
    first = (F.col("b.batch_no") * size + 1).cast("int").alias("first_page")
    return pm.number_pages(dealt.select("path", "b.batch_no", first, "b.texts"))


def sort_pages(spark, sf):
    order = F.array_join(F.transform("pages", lambda p: p["page_no"].cast("string")), ",")
    texts = F.array_join(F.transform("pages", lambda p: p["page_text"]), "|")
    return pm.sort_pages(fx.pages(spark, sf)).select("path", order.alias("page_order"), texts.alias("page_texts"))


def extract_words(spark, sf):
    return fx.flat_boxes(fx.words(spark, sf))


def extract_lines(spark, sf):
    return fx.flat_boxes(pm.extract_words(fx.pages(spark, sf), "line"))


def extract_blocks(spark, sf):
    return fx.flat_boxes(pm.extract_words(fx.pages(spark, sf), "block"))


def extract_symbols(spark, sf):
    """Characters with ink and their places."""
    symbols = fx.flat_boxes(pm.extract_words(fx.pages(spark, sf), "symbol"))
    return symbols.select("path", "page_no", "text", "x", "y")


def _regions(level):
    def query(spark, sf):
        return fx.flat_boxes(pm.extract_regions(fx.words(spark, sf), level))

    return query


def words_in_rect(spark, sf):
    inside = pm.words_in_rect(fx.words(spark, sf), fx.page_rects(spark, sf))
    return fx.flat_boxes(inside)


def words_in_page_rect(spark, sf):
    """One rectangle per page: the middle half of the page's own region."""
    words = pm.write_texts(fx.words(spark, sf), new_folder(spark, "rect-words"), "1")
    rects = pm.extract_regions(words, "page").select(
        "path",
        "page_no",
        F.col("region_no").alias("rect_id"),
        (F.col("box.x") + F.floor(F.col("box.w") / 4)).cast("int").alias("rx"),
        F.col("box.y").alias("ry"),
        F.floor(F.col("box.w") / 2).cast("int").alias("rw"),
        F.col("box.h").alias("rh"),
    )
    return fx.flat_boxes(pm.words_in_rect(words, rects))


def words_in_large_rect(spark, sf):
    """Words in rectangles from a cell to far beyond any page, narrow and flat ones too, that hold for every page: counted by page."""
    key = F.col("n_nationkey")
    rects = fx.table(spark, sf, "nation").select(
        key.alias("rect_id"),
        (key - 12).alias("rx"),
        (-key).alias("ry"),
        F.pow(F.lit(2), key % 18).cast("int").alias("rw"),
        F.pow(F.lit(3), key % 11).cast("int").alias("rh"),
    )
    inside = pm.words_in_rect(fx.words(spark, sf), rects)
    return inside.groupBy("path", "page_no", "rect_id").agg(
        F.count(F.lit(1)).alias("n_words"), F.sum("box.w").alias("width"), F.max("box.y").alias("last_y")
    )


def render_hocr(spark, sf):
    fragments = fx.pages(spark, sf).withColumn("fragment", F.concat(F.lit("<p>"), "page_text", F.lit("</p>\n")))
    return pm.render_hocr(fragments)


def attach_classification(spark, sf):
    docs = fx.contents(spark, sf)
    cats = pm.classify_rules(docs, fx.RULES).select("path", "classification")
    return pm.drop_blank(pm.attach_classification(docs, cats), "classification").select(
        "path", "classification", "content"
    )


def indexed_only(spark, sf):
    old, new = fx.index_batches(spark, sf)
    return pm.indexed_only(old, pm.index_record(new, fx.SECOND_RUN)).select("path", "classification")


def assemble_document(spark, sf):
    return pm.assemble_document(fx.pages(spark, sf))


def assemble_paged(spark, sf):
    return pm.assemble_paged(fx.sources(spark, sf), fx.pages_column())


def assemble_parts(spark, sf):
    return pm.assemble_parts(fx.pages(spark, sf), pages_per_part=fx.MAX_PAGES)


def concat_pages(spark, sf):
    return pm.concat_pages(fx.pages(spark, sf))


def document_count(spark, sf):
    both = pm.union_sources(fx.sources(spark, sf), fx.sources(spark, sf))
    return pm.document_count(pm.filter_extension(both))


def first_documents(spark, sf):
    return pm.first_documents(pm.concat_pages(fx.pages(spark, sf)), 1)


def union_sources(spark, sf):
    html = fx.table(spark, sf, "pages").select(F.col("url").alias("path"), F.col("html").alias("text"))
    return pm.union_sources(fx.sources(spark, sf), html)


def classify_rules(spark, sf):
    return pm.classify_rules(fx.contents(spark, sf), fx.RULES).select("path", "classification")


def classify_udf(spark, sf):
    def by_length(texts: pd.Series) -> pd.Series:
        return texts.str.len().map(lambda n: "long" if n >= 1000 else "short")

    return pm.classify_udf(fx.contents(spark, sf), by_length).select("path", "classification")


# A program that counts the fields of its line, with the separator it is told.
_COUNT_KEYED = r'{ n = split($2, a, ENVIRON["SEPARATOR"]); print $1 "\t" (n > 20 ? "many" : "few") }'
_COUNT_PLAIN = r'{ n = split($0, a, ENVIRON["SEPARATOR"]); print (n > 20 ? "many" : "few") }'


def pipe_classify(spark, sf):
    return pm.pipe_classify(fx.contents(spark, sf), ["awk", "-F", "\t", _COUNT_KEYED])


def pipe_classify_lines(spark, sf):
    return pm.pipe_classify_lines(fx.contents(spark, sf), ["awk", _COUNT_PLAIN])


def latest_records(spark, sf):
    old, new = fx.index_batches(spark, sf)
    both = pm.index_record(old, fx.FIRST_RUN).unionByName(pm.index_record(new, fx.SECOND_RUN))
    return pm.latest_records(both)


def index_texts(spark, sf):
    return pm.index_texts(fx.sources(spark, sf), fx.pages_column(), fx.RULES, fx.FIRST_RUN)


QUERIES = {
    "index_texts": index_texts,
    "filter_extension": filter_extension,
    "drop_blank": drop_blank,
    "contains_text": contains_text,
    "flatten_text": flatten_text,
    "index_record": index_record,
    "preview": preview,
    "output_name": output_name,
    "strip_scheme": strip_scheme,
    "page_footer": page_footer,
    "plan_page_batches": plan_page_batches,
    "extract_text_pages": extract_text_pages,
    "extract_marked_pages": extract_marked_pages,
    "extract_html_pages": extract_html_pages,
    "number_pages": number_pages,
    "sort_pages": sort_pages,
    "extract_words": extract_words,
    "extract_lines": extract_lines,
    "extract_blocks": extract_blocks,
    "extract_symbols": extract_symbols,
    "extract_regions_word": _regions("word"),
    "extract_regions_line": _regions("line"),
    "extract_regions_block": _regions("block"),
    "extract_regions_page": _regions("page"),
    "words_in_rect": words_in_rect,
    "words_in_page_rect": words_in_page_rect,
    "words_in_large_rect": words_in_large_rect,
    "render_hocr": render_hocr,
    "attach_classification": attach_classification,
    "indexed_only": indexed_only,
    "assemble_document": assemble_document,
    "assemble_paged": assemble_paged,
    "assemble_parts": assemble_parts,
    "concat_pages": concat_pages,
    "document_count": document_count,
    "first_documents": first_documents,
    "union_sources": union_sources,
    "classify_rules": classify_rules,
    "classify_udf": classify_udf,
    "pipe_classify": pipe_classify,
    "pipe_classify_lines": pipe_classify_lines,
    "latest_records": latest_records,
}

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:/*"
_COUNTED = fx.PAGES + ", counted AS (SELECT path, count(*)::INTEGER AS n FROM pages_in GROUP BY path)"
_ASSEMBLED = "WITH " + FOOTED_PAGES + " SELECT path, content, n_pages FROM assembled"
_HTML = (
    "trim(regexp_replace(regexp_replace(regexp_replace(html,"
    " '<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'gis'),"
    " '<[^>]*>', ' ', 'g'), '[ \\t\\r\\n]+', ' ', 'g'))"
)
_BOX = (
    "min(x)::INTEGER AS x, min(y)::INTEGER AS y, (max(x + w) - min(x))::INTEGER AS w,"
    " (max(y + h) - min(y))::INTEGER AS h"
)
BLOCKS = (
    fx.WORDS
    + """,
inked AS (SELECT DISTINCT path, page_no, line_no FROM words_in),
starts AS (
  SELECT *, CASE WHEN lag(line_no) OVER p = line_no - 1 THEN 0 ELSE 1 END AS fresh
  FROM inked WINDOW p AS (PARTITION BY path, page_no ORDER BY line_no)),
blocks AS (
  SELECT *, (sum(fresh) OVER (PARTITION BY path, page_no ORDER BY line_no) - 1)::INTEGER AS region_no FROM starts)"""
)
_FIELDS = "len(string_split(replace(text, chr(10), ''), ','))"

ORACLE = {
    "index_texts": f"""WITH {FOOTED_PAGES},
classified AS (
  SELECT path, content, {fx.category_sql("replace(content, chr(10), '')")} AS classification
  FROM assembled WHERE {EXTENSION} = 'pdf')
SELECT path AS filename, classification, '2024-01-31T08:30:00Z' AS date, substring(content, 1, 300) AS content
FROM classified WHERE classification <> ''""",
    "filter_extension": f"WITH {fx.SRC} SELECT path, text FROM src WHERE {EXTENSION} = 'pdf'",
    "drop_blank": f"""WITH {fx.SRC}, c AS (SELECT path, {fx.category_sql("text")} AS classification FROM src)
SELECT * FROM c WHERE classification <> ''""",
    "contains_text": f"""WITH {FOOTED_PAGES}
SELECT path, n_pages FROM assembled WHERE contains(content, '{fx.NEEDLE}')""",
    "flatten_text": f"WITH {fx.SRC} SELECT path, replace(text, chr(10), '') AS content FROM src",
    "index_record": f"""WITH {fx.SRC}
SELECT path AS filename, {fx.category_sql("text")} AS classification, '2024-01-31T08:30:00Z' AS date,
       substring(text, 1, 300) AS content FROM src""",
    "preview": f"WITH {fx.SRC} SELECT path, substring(text, 1, 300) AS content FROM src",
    "output_name": f"""WITH {fx.SRC}
SELECT path, '/out/' || replace(lower(split_part(path, '/', -1)), '.pdf', '.txt') AS output FROM src""",
    "strip_scheme": f"""WITH {fx.SRC}
SELECT regexp_replace(path, '{_SCHEME}', '/') AS path FROM (SELECT path FROM src UNION ALL SELECT url FROM pages)""",
    "page_footer": f"WITH {FOOTED_PAGES} SELECT path, page_no, footer_no, page_text FROM footed",
    "plan_page_batches": f"""WITH {_COUNTED},
b AS (SELECT path, n, unnest(range((n + {fx.MAX_PAGES - 1}) // {fx.MAX_PAGES}))::INTEGER AS batch_no FROM counted)
SELECT path, batch_no, (batch_no * {fx.MAX_PAGES} + 1)::INTEGER AS first_page,
       least((batch_no + 1) * {fx.MAX_PAGES}, n)::INTEGER AS last_page FROM b""",
    "extract_text_pages": f"WITH {fx.PAGES} SELECT path, page_no, page_text, true AS ok FROM pages_in",
    "extract_marked_pages": f"""WITH {fx.SRC}
SELECT path, unnest(range(1, len(string_split(text, '.' || chr(10))) + 1))::INTEGER AS page_no,
       unnest(string_split(text, '.' || chr(10))) AS page_text, true AS ok FROM src""",
    "extract_html_pages": f"SELECT url AS path, 1 AS page_no, {_HTML} AS page_text, true AS ok FROM pages",
    "number_pages": f"""WITH {fx.PAGES}
SELECT path, ((page_no - 1) // {fx.MAX_PAGES})::INTEGER AS batch_no, page_no, page_text FROM pages_in""",
    "sort_pages": f"""WITH {fx.PAGES}
SELECT path, string_agg(page_no::VARCHAR, ',' ORDER BY page_no) AS page_order,
       string_agg(page_text, '|' ORDER BY page_no) AS page_texts FROM pages_in GROUP BY path""",
    "extract_words": f"WITH {fx.WORDS} SELECT * FROM words_in",
    "extract_lines": f"""WITH {fx.WORDS}
SELECT path, page_no, line_no, 0 AS word_no, trim(line, ' ' || chr(9)) AS text, 100.0::FLOAT AS confidence,
       (length(line) - length(ltrim(line, ' ' || chr(9))))::INTEGER AS x, line_no AS y,
       length(trim(line, ' ' || chr(9)))::INTEGER AS w, 1 AS h
FROM page_lines WHERE trim(line, ' ' || chr(9)) <> ''""",
    "extract_symbols": f"""WITH {fx.WORDS},
c AS (SELECT path, page_no, line_no AS y, unnest(string_split(line, '')) AS text,
             unnest(range(length(line)))::INTEGER AS x FROM page_lines)
SELECT path, page_no, text, x, y FROM c WHERE text NOT IN ('', ' ', chr(9))""",
    "extract_regions_word": f"""WITH {fx.WORDS}
SELECT path, page_no, (row_number() OVER (PARTITION BY path, page_no ORDER BY line_no, word_no) - 1)::INTEGER
       AS region_no, x, y, w, h FROM words_in""",
    "extract_regions_line": f"""WITH {fx.WORDS}
SELECT path, page_no, line_no AS region_no, {_BOX} FROM words_in GROUP BY path, page_no, line_no""",
    "extract_regions_block": f"""WITH {BLOCKS}
SELECT path, page_no, region_no, {_BOX}
FROM words_in JOIN blocks USING (path, page_no, line_no) GROUP BY path, page_no, region_no""",
    "extract_blocks": f"""WITH {BLOCKS},
texts AS (
  SELECT path, page_no, region_no, min(line_no) AS line_no,
         string_agg(trim(line, ' ' || chr(9)), chr(10) ORDER BY line_no) AS text
  FROM page_lines JOIN blocks USING (path, page_no, line_no) GROUP BY path, page_no, region_no),
hulls AS (
  SELECT path, page_no, region_no, {_BOX}
  FROM words_in JOIN blocks USING (path, page_no, line_no) GROUP BY path, page_no, region_no)
SELECT path, page_no, line_no, region_no AS word_no, text, 100.0::FLOAT AS confidence, x, y, w, h
FROM texts JOIN hulls USING (path, page_no, region_no)""",
    "extract_regions_page": f"""WITH {fx.WORDS}
SELECT path, page_no, 0 AS region_no, {_BOX} FROM words_in GROUP BY path, page_no""",
    "words_in_large_rect": f"""WITH {fx.WORDS},
rects AS (
  SELECT n_nationkey AS rect_id, n_nationkey - 12 AS rx, -n_nationkey AS ry, pow(2, n_nationkey % 18)::INTEGER AS rw,
         pow(3, n_nationkey % 11)::INTEGER AS rh FROM nation)
SELECT path, page_no, rect_id, count(*) AS n_words, sum(w)::BIGINT AS width, max(y) AS last_y FROM words_in JOIN rects
  ON x >= rx AND y >= ry AND x + w <= rx + rw AND y + h <= ry + rh GROUP BY path, page_no, rect_id""",
    "words_in_rect": f"""WITH {fx.WORDS}, {fx.RECTS}
SELECT words_in.*, rect_id FROM words_in JOIN rects
ON x >= rx AND y >= ry AND x + w <= rx + rw AND y + h <= ry + rh""",
    "words_in_page_rect": f"""WITH {fx.WORDS},
hull AS (SELECT path, page_no, {_BOX} FROM words_in GROUP BY path, page_no),
rects AS (SELECT path, page_no, x + w // 4 AS rx, y AS ry, w // 2 AS rw, h AS rh FROM hull)
SELECT words_in.*, 0 AS rect_id FROM words_in JOIN rects USING (path, page_no)
WHERE x >= rx AND y >= ry AND x + w <= rx + rw AND y + h <= ry + rh""",
    "render_hocr": f"""WITH {fx.PAGES}
SELECT path, '<!DOCTYPE html PUBLIC "-//W3C//DTD HTML 4.01 Transitional//EN" "http://www.w3.org/TR/html4/loose.dtd">'
  || chr(10) || '<html>' || chr(10) || '<head>' || chr(10) || '<title></title>' || chr(10)
  || '<meta http-equiv="Content-Type" content="text/html;charset=utf-8" />' || chr(10)
  || '<meta name=''ocr-system'' content=''tesseract''/>' || chr(10) || '</head>' || chr(10) || '<body>' || chr(10)
  || string_agg('<p>' || page_text || '</p>' || chr(10), '' ORDER BY page_no)
  || '</body>' || chr(10) || '</html>' || chr(10) AS hocr
FROM pages_in GROUP BY path""",
    "attach_classification": f"""WITH {fx.SRC},
c AS (SELECT path, {fx.category_sql("text")} AS classification, text AS content FROM src)
SELECT * FROM c WHERE classification <> ''""",
    "indexed_only": f"""WITH {fx.BATCHES}
SELECT filename AS path, classification FROM old_batch WHERE filename IN (SELECT filename FROM new_batch)""",
    "assemble_document": _ASSEMBLED,
    "assemble_paged": _ASSEMBLED,
    "assemble_parts": f"""WITH {FOOTED_PAGES}
SELECT path, ((footer_no - 1) // {fx.MAX_PAGES})::INTEGER AS part_no,
       string_agg(page_text, '' ORDER BY footer_no) AS content, count(*)::INTEGER AS n_pages
FROM footed GROUP BY path, (footer_no - 1) // {fx.MAX_PAGES}""",
    "concat_pages": f"""WITH {fx.PAGES}
SELECT path, string_agg(page_text, '' ORDER BY page_no) AS content FROM pages_in GROUP BY path""",
    "document_count": f"""WITH {fx.SRC}, twice AS (SELECT path FROM src UNION ALL SELECT path FROM src)
SELECT count(*) AS n_documents FROM twice WHERE {EXTENSION} = 'pdf'""",
    "first_documents": f"""WITH {fx.PAGES}
SELECT path, string_agg(page_text, '' ORDER BY page_no) AS content FROM pages_in GROUP BY path ORDER BY path LIMIT 1""",
    "union_sources": f"WITH {fx.SRC} SELECT path, text FROM src UNION ALL SELECT url, html FROM pages",
    "classify_rules": f"WITH {fx.SRC} SELECT path, {fx.category_sql('text')} AS classification FROM src",
    "classify_udf": f"""WITH {fx.SRC}
SELECT path, CASE WHEN length(text) >= 1000 THEN 'long' ELSE 'short' END AS classification FROM src""",
    "pipe_classify": f"""WITH {fx.SRC}
SELECT path, CASE WHEN {_FIELDS} > 20 THEN 'many' ELSE 'few' END AS classification FROM src""",
    "pipe_classify_lines": f"""WITH {fx.SRC}
SELECT path, CASE WHEN {_FIELDS} > 20 THEN 'many' ELSE 'few' END AS classification FROM src""",
    "latest_records": f"WITH {fx.BATCHES} SELECT * FROM merged",
}
