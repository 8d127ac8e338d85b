"""Queries that write files or tables below a new folder and return what is read back.

The folder is below ``spark.checkpoint.dir``; the files are made by Spark from the given tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import pagemill as pm
from catalog import fixtures as fx
from catalog import text_queries as tq
from pagemill.functions import text as T
from pagemill.functions.storage import default_storage, resolver
from catalog.workspace import new_folder


def put_files(docs: DataFrame, folder: str) -> int:
    """Writes ``text`` to ``folder/path`` from the tasks; returns the number of files."""
    target = T.strip_scheme("path")

    resolve = resolver(default_storage(docs.sparkSession))

    def put(frames):
        import os

        system, base = resolve(folder)
        for frame in frames:
            for path, text in zip(frame["path"], frame["text"]):
                place = base + path
                system.create_dir(os.path.dirname(place), recursive=True)
                with system.open_output_stream(place) as file:
                    file.write(text.encode("utf-8"))
            yield frame[["path"]]

    return docs.select(target.alias("path"), "text").mapInPandas(put, "path string").count()


def relative(df: DataFrame, folder: str, col: str = "path") -> DataFrame:
    """``col`` as it was before :func:`put_files`."""
    base = T.strip_scheme(F.lit(folder.rstrip("/")))
    bare = F.substring(T.strip_scheme(col), F.length(base) + 1, F.length(col))
    return df.withColumn(col, F.concat(F.lit("hdfs:"), bare))


def text_engine(fails: bool = False):
    """A factory of engines for text files; their pages are lines.

    With ``fails`` a file cannot be loaded if its number of bytes is a multiple of ``fx.BAD_FILE``, and a page cannot be
    recognised if its number of characters is a multiple of ``fx.BAD_PAGE``.
    """
    per_page, bad_file, bad_page = fx.LINES_PER_PAGE, fx.BAD_FILE, fx.BAD_PAGE

    class TextEngine:
        def lines(self, file):
            data = file.read()
            if fails and len(data) % bad_file == 0:
                raise ValueError("a file of this length")
            return data.decode("utf-8").split("\n")

        def check(self, image):
            if fails and len("\n".join(image)) % bad_page == 0:
                raise ValueError("a page of this length")

        def page_count(self, file):
            return -(-len(self.lines(file)) // per_page)

        def render(self, file, first_page, last_page):
            lines = self.lines(file)
            for page in range(first_page - 1, last_page):
                yield lines[page * per_page : (page + 1) * per_page]

        def recognize(self, image, lang, rect):
            self.check(image)
            x, y, w, h = rect or (0, 0, None, None)
            return "\n".join(line[x:][:w] for line in image[y:][:h])

        def words(self, image, lang, rect, level):
            self.check(image)
            for y, line in enumerate(image):
                x = 0
                for word in line.split(" "):
                    if word:
                        yield word, 100.0, x, y, len(word), 1
                    x += len(word) + 1

        def raster(self, image):
            return [[ord(c) for c in line] for line in image]

        def image(self, lines):
            return ["".join(map(chr, line)) for line in lines]

        def regions(self, image, level):
            self.check(image)
            return [(0, y, len(line), 1) for y, line in enumerate(image) if line]

    return TextEngine


def by_rules(documents: DataFrame) -> DataFrame:
    return pm.classify_rules(documents, fx.RULES, col=T.flatten("content"))


def by_rules_and_path(documents: DataFrame) -> DataFrame:
    return by_rules(documents).select("path", "classification")


def scan_documents(spark, sf):
    folder = new_folder(spark, "scan")
    put_files(fx.sources(spark, sf), folder)
    files = pm.scan_documents(spark, folder, extension="pdf")
    return relative(pm.decode_documents(files).select("path", "length", "text"), folder)


def _page_ranges(spark, sf, name):
    folder = new_folder(spark, name)
    put_files(fx.sources(spark, sf), folder)
    files = pm.scan_documents(spark, folder, extension="pdf").select("path")
    counts = pm.document_page_counts(files, text_engine(), num_partitions=8)
    return folder, pm.plan_page_batches(counts.select("path", "n_pages"), fx.MAX_PAGES)


def extract_pages(spark, sf):
    folder, ranges = _page_ranges(spark, sf, "pages")
    pages = pm.extract_pages(ranges, text_engine(), num_partitions=8)
    return relative(pages, folder).select("path", "page_no", "page_text", "ok")


def extract_rect(spark, sf):
    """Of each page the part inside a rectangle."""
    folder, ranges = _page_ranges(spark, sf, "rects")
    x, y, w, h = (F.lit(v) for v in fx.RECT)
    rects = ranges.withColumns({"rx": x, "ry": y, "rw": w, "rh": h})
    pages = pm.extract_pages(rects, text_engine(), num_partitions=8)
    return relative(pages, folder).select("path", "page_no", "page_text")


def recognize_words(spark, sf):
    folder, ranges = _page_ranges(spark, sf, "words")
    found = pm.recognize_words(ranges, text_engine(fails=True), num_partitions=8)
    return relative(fx.flat_boxes(found).drop("error"), folder)


def segment_regions(spark, sf):
    folder, ranges = _page_ranges(spark, sf, "regions")
    found = pm.segment_regions(ranges, text_engine(fails=True), num_partitions=8)
    return relative(fx.flat_boxes(found).drop("error"), folder)


def _rasters(spark, sf, name):
    folder, ranges = _page_ranges(spark, sf, name)
    return folder, pm.render_rasters(ranges, text_engine(), num_partitions=8)


def render_rasters(spark, sf):
    """Each page's lines as gray values: how many, and their sum."""
    folder, lines = _rasters(spark, sf, "rasters")
    total = F.aggregate("v", F.lit(0).cast("long"), lambda s, p: s + p)
    return relative(lines, folder).select("path", "page_no", "y", F.size("v").alias("width"), total.alias("total"), "ok")


def recognize_rasters(spark, sf):
    """Pages to rasters, and the rasters without their even lines to pages."""
    folder, lines = _rasters(spark, sf, "recognized")
    pages = pm.recognize_rasters(lines.where("y % 2 = 0"), text_engine())
    return relative(pages, folder).select("path", "page_no", "page_text", "ok")


def write_texts(spark, sf):
    return pm.write_texts(pm.assemble_document(fx.pages(spark, sf)), new_folder(spark, "texts"), "1")


def write_text_files(spark, sf):
    folder = new_folder(spark, "files")
    return pm.write_text_files(fx.contents(spark, sf), f"{folder}/out", f"{folder}/report", root="/in")


def write_clashing_files(spark, sf):
    """Each document under three names that meet when lower-cased; counts the files and their bytes by folder."""
    folder = new_folder(spark, "clashes")
    name = F.col("path")
    others = F.array(F.lower(name), F.upper(name), F.replace(F.lower(name), F.lit(".pdf"), F.lit("~2.pdf")))
    docs = fx.contents(spark, sf)
    place = F.regexp_replace(name, "[^/]*$", "")
    file = F.concat(F.regexp_replace(F.lower(T.base_name(name)), r"\.[^.]*$", ""), F.lit(".pdf"))
    named = docs.select(place.alias("place"), file.alias("path"), "content").select(
        "place", F.explode(F.array_distinct(others)).alias("file"), "content"
    )
    renamed = named.select(F.concat("place", "file").alias("path"), F.concat("content", "file").alias("content"))
    pm.write_text_files(renamed, f"{folder}/out", f"{folder}/report", root="/in")
    files = pm.scan_documents(spark, f"{folder}/out")
    source = F.substring_index(F.substring_index("path", "/", -2), "/", 1).alias("source")
    return files.groupBy(source).agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))


def _two_batches(spark, sf):
    index = new_folder(spark, "index")
    old, new = fx.index_batches(spark, sf)
    pm.upsert_index(pm.index_record(old, fx.FIRST_RUN), index, "first")
    pm.upsert_index(pm.index_record(new, fx.SECOND_RUN), index, "second")
    return index


def upsert_index(spark, sf):
    return pm.read_index(spark, _two_batches(spark, sf))


def upsert_same_date(spark, sf):
    """The second batch wins although its records have the date of the first and smaller categories."""
    index = new_folder(spark, "index")
    old, new = fx.index_batches(spark, sf)
    pm.upsert_index(pm.index_record(old, fx.FIRST_RUN), index, "008")
    again = new.withColumn("classification", F.lit("a"))
    pm.upsert_index(pm.index_record(again, fx.FIRST_RUN), index, "007")
    return pm.read_index(spark, index)


def read_index(spark, sf):
    return pm.read_index(spark, _two_batches(spark, sf), ["filename", "content"], ("classification", "good"))


def compact_index(spark, sf):
    """The index after a compaction, one more batch, and a compaction of both."""
    index = new_folder(spark, "index")
    old, new = fx.index_batches(spark, sf)
    pm.upsert_index(pm.index_record(old, fx.FIRST_RUN), index, "007")
    pm.compact_index(spark, index)
    pm.upsert_index(pm.index_record(new, fx.SECOND_RUN), index, "008")
    pm.compact_index(spark, index)
    return pm.read_index(spark, index)


def index_late_batches(spark, sf):
    """Late records after a compaction, batches of one sequence, and a batch that is repeated, each in other documents."""
    index = new_folder(spark, "index")
    old, new = fx.index_batches(spark, sf)
    pm.upsert_index(pm.index_record(old, fx.FIRST_RUN), index, "first", sequence=10)
    pm.compact_index(spark, index)
    late = new.withColumn("path", F.when(F.col("classification") == "good", F.col("path")).otherwise(F.concat("path", F.lit("/late"))))
    pm.upsert_index(pm.index_record(late, fx.SECOND_RUN), index, "late", sequence=9)
    for batch, category in (("equal-b", "b"), ("equal-a", "a")):
        equal = new.where("classification = 'poor'").withColumn("classification", F.lit(category))
        pm.upsert_index(pm.index_record(equal, fx.SECOND_RUN), index, batch, sequence=11)
    pm.compact_index(spark, index)
    pm.upsert_index(pm.index_record(late.withColumn("content", F.lit("again")), fx.SECOND_RUN), index, "late", sequence=9)
    return pm.read_index(spark, index)


def index_lookup(spark, sf):
    """One record by its name, the least name of the index."""
    index = _two_batches(spark, sf)
    name = pm.read_index(spark, index, ["filename"]).agg(F.min("filename")).first()[0]
    return pm.read_index(spark, index, ["filename", "classification", "date"], ("filename", name))


def searchable_index(spark, sf, compacted=False):
    """The documents' beginnings, and later parts of the labelled ones in their place."""
    index = new_folder(spark, "search")
    old, new = fx.index_batches(spark, sf)
    pm.upsert_index(pm.index_record(old, fx.FIRST_RUN), index, "first", searchable=True)
    replaced = new.withColumn("content", F.substring("content", 200, 300))
    pm.upsert_index(pm.index_record(replaced, fx.SECOND_RUN), index, "second")
    if compacted:
        pm.compact_index(spark, index)
    return index


def content_queries(spark, sf, first, n):
    """Some words of each document whose number is divisible by 20, as queries against all records."""
    words = T.terms(F.substring("text", 1, 300))
    docs = fx.table(spark, sf, "documents").where("doc_id % 20 = 0")
    return docs.select(F.col("doc_id").alias("query_id"), F.array_join(F.slice(words, first, n), " ").alias("query"))


def _rounded(found):
    return found.withColumn("score", F.round("score", 6))


def search_index(spark, sf):
    return _rounded(pm.search_index(spark, searchable_index(spark, sf), content_queries(spark, sf, 2, 2)))


def search_index_all(spark, sf):
    """All words of the query, after a compaction; the best five."""
    index = searchable_index(spark, sf, compacted=True)
    return _rounded(pm.search_index(spark, index, content_queries(spark, sf, 2, 3), how="all", limit=5))


def search_index_phrase(spark, sf):
    return _rounded(pm.search_index(spark, searchable_index(spark, sf), content_queries(spark, sf, 4, 3), how="phrase"))


def archive(spark, sf):
    classified = pm.classify_rules(fx.contents(spark, sf), fx.RULES)
    return pm.read_archive(spark, pm.archive(classified, new_folder(spark, "archive"), "1"))


def remove_sources(spark, sf):
    """Deletes the files of the documents with a category; says of each file whether it is still there."""
    folder = new_folder(spark, "remove")
    put_files(fx.sources(spark, sf), folder)
    files = pm.scan_documents(spark, folder).select("path")
    before = pm.write_texts(files, f"{folder}-before", "1")
    categories = relative(before.withColumn("original", F.col("path")), folder).join(
        by_rules(fx.contents(spark, sf)), "path"
    )
    index = pm.drop_blank(categories, "classification").select(F.col("original").alias("filename"))
    pm.remove_sources(before, index, f"{folder}-report", dry_run=False)
    after = pm.scan_documents(spark, folder).select("path", F.lit(True).alias("there"))
    state = before.select("path").join(after, "path", "left")
    return relative(state.select("path", F.coalesce("there", F.lit(False)).alias("there")), folder)


def ingest(spark, sf):
    folder = new_folder(spark, "ingest")
    put_files(fx.sources(spark, sf), f"{folder}/in")
    result = pm.ingest(
        spark,
        f"{folder}/in",
        f"{folder}/out",
        "1",
        fx.FIRST_RUN,
        text_engine(),
        by_rules,
        max_pages=fx.MAX_PAGES,
        num_partitions=8,
        remove=True,
    )
    return relative(result.index, f"{folder}/in", "filename")


PAGES_PER_PART = 4


def ingest_parts(spark, sf):
    """Documents in parts of a few pages, to their index records."""
    out = new_folder(spark, "parts")
    pages = fx.pages(spark, sf).where(F.col("path").endswith(".pdf"))
    pm.ingest_pages(
        pages,
        out,
        "1",
        fx.FIRST_RUN,
        lambda parts: pm.classify_parts(parts, fx.RULES, col=T.flatten("content")),
        text_dir=f"{out}/files",
        pages_per_part=PAGES_PER_PART,
    )
    return pm.read_index(spark, f"{out}/index")


def write_part_files(spark, sf):
    """Documents in parts, to one file each, read back."""
    folder = new_folder(spark, "part-files")
    parts = pm.assemble_parts(fx.pages(spark, sf), PAGES_PER_PART)
    pm.write_part_files(parts, f"{folder}/out", f"{folder}/report", root="/in")
    found = pm.scan_documents(spark, f"{folder}/out")
    files = pm.decode_documents(found).where(~F.contains("path", F.lit("/.parts-")))
    return files.select(F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "length")


def _states(spark, folder, out, failed, index):
    """Of each source: what became of it, and whether it is still there."""
    sources = pm.scan_documents(spark, f"{folder}/all", extension="pdf").select("path")
    there = pm.scan_documents(spark, f"{folder}/in", extension="pdf").select("path", F.lit(True).alias("there"))
    lost = failed.groupBy("path").agg(F.bool_or(F.col("page_no").isNull()).alias("unreadable"))
    named = relative(index.select(F.col("filename").alias("path")), f"{folder}/in").withColumn("indexed", F.lit(True))
    state = (
        F.when(F.col("unreadable"), "unreadable")
        .when(~F.col("unreadable"), "pages lost")
        .when(F.col("indexed"), "indexed")
        .otherwise("no category")
    )
    return (
        relative(sources, f"{folder}/all")
        .join(relative(lost, f"{folder}/in"), "path", "left")
        .join(named, "path", "left")
        .join(relative(there, f"{folder}/in"), "path", "left")
        .select("path", state.alias("state"), F.coalesce("there", F.lit(False)).alias("there"))
    )


def ingest_failures(spark, sf):
    """An engine that fails on some files and pages: they are reported, and their sources stay."""
    folder = new_folder(spark, "failures")
    put_files(fx.sources(spark, sf), f"{folder}/in")
    put_files(fx.sources(spark, sf), f"{folder}/all")
    result = pm.ingest(
        spark,
        f"{folder}/in",
        f"{folder}/out",
        "1",
        fx.FIRST_RUN,
        text_engine(fails=True),
        by_rules,
        max_pages=fx.MAX_PAGES,
        remove=True,
    )
    return _states(spark, folder, f"{folder}/out", result.failed, result.index)


def ingest_stream_failures(spark, sf):
    """The same as a stream."""
    folder = new_folder(spark, "stream-failures")
    n_files = put_files(fx.sources(spark, sf), f"{folder}/in")
    put_files(fx.sources(spark, sf), f"{folder}/all")

    def extractor(files: DataFrame) -> DataFrame:
        counts = pm.document_page_counts(files.select("path", "content"), text_engine(fails=True))
        ranges = pm.plan_page_batches(counts.select("path", "n_pages"), fx.MAX_PAGES)
        return pm.extract_pages(ranges, text_engine(fails=True), num_partitions=8)

    query = pm.ingest_stream(
        spark,
        f"{folder}/in",
        f"{folder}/out",
        f"{folder}/checkpoint",
        lambda batch: fx.FIRST_RUN,
        extractor,
        by_rules,
        max_files=-(-n_files // 2),
        remove=True,
        text_dir=f"{folder}/files",
    )
    query.awaitTermination()
    pm.remove_ingested(spark, f"{folder}/out", query)
    failed = pm.failed_documents(spark, f"{folder}/out")
    return _states(spark, folder, f"{folder}/out", failed, pm.read_index(spark, f"{folder}/out/index"))


def ingest_stream(spark, sf):
    folder = new_folder(spark, "stream")
    n_files = put_files(fx.sources(spark, sf), f"{folder}/in")

    def extractor(files: DataFrame) -> DataFrame:
        return pm.extract_text_pages(pm.decode_documents(files), fx.LINES_PER_PAGE)

    query = pm.ingest_stream(
        spark,
        f"{folder}/in",
        f"{folder}/out",
        f"{folder}/checkpoint",
        lambda batch: fx.FIRST_RUN,
        extractor,
        by_rules_and_path,
        max_files=-(-n_files // 2),
        remove=True,
    )
    query.awaitTermination()
    pm.remove_ingested(spark, f"{folder}/out", query)
    return relative(pm.read_index(spark, f"{folder}/out/index"), f"{folder}/in", "filename")


QUERIES = {
    "scan_documents": scan_documents,
    "extract_pages": extract_pages,
    "extract_rect": extract_rect,
    "recognize_words": recognize_words,
    "segment_regions": segment_regions,
    "render_rasters": render_rasters,
    "recognize_rasters": recognize_rasters,
    "write_texts": write_texts,
    "write_text_files": write_text_files,
    "write_clashing_files": write_clashing_files,
    "upsert_index": upsert_index,
    "upsert_same_date": upsert_same_date,
    "read_index": read_index,
    "compact_index": compact_index,
    "index_late_batches": index_late_batches,
    "index_lookup": index_lookup,
    "search_index": search_index,
    "search_index_all": search_index_all,
    "search_index_phrase": search_index_phrase,
    "archive": archive,
    "remove_sources": remove_sources,
    "ingest": ingest,
    "ingest_failures": ingest_failures,
    "ingest_parts": ingest_parts,
    "write_part_files": write_part_files,
    "ingest_stream": ingest_stream,
    "ingest_stream_failures": ingest_stream_failures,
}

_PDF = f"{tq.EXTENSION} = 'pdf'"
_BAD_FILE = f"octet_length(encode(text)) % {fx.BAD_FILE} = 0"
_BAD_PAGE = f"length(page_text) % {fx.BAD_PAGE} = 0"
_NOT_READ = f"({_BAD_PAGE} OR path IN (SELECT path FROM src WHERE {_BAD_FILE}))"
_X, _Y, _W, _H = fx.RECT


def _hashed(name: str, relative: str) -> str:
    """The text name of ``name``, with a hash of ``relative``."""
    named = f"replace(lower({name}), '.pdf', '.txt')"
    stem = f"regexp_replace({named}, '[.][^.]*$', '')"
    return f"{stem} || '~' || substring(sha256({relative}), 1, 16) || substring({named}, length({stem}) + 1)"


_WORDS = "regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+')"


def _search(first: int, n: int) -> str:
    """Postings, queries and scores over the records of ``searchable_index``."""
    return f"""WITH replaced AS (
  SELECT 'hdfs:/in/' || source || '/Doc_' || doc_id AS filename, substring(substring(text, 200, 300), 1, 300) AS content
  FROM documents JOIN labels USING (doc_id)),
records AS (
  SELECT * FROM replaced UNION ALL
  SELECT 'hdfs:/in/' || source || '/Doc_' || doc_id, substring(text, 1, 300) FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
sized AS (SELECT filename, {_WORDS.format(text="content")} AS words FROM records),
corpus AS (SELECT count(*) AS n_docs, avg(len(words)) AS mean_terms FROM sized),
placed AS (SELECT filename, unnest(words) AS term, unnest(range(len(words))) AS k, len(words) AS n_terms FROM sized),
postings AS (SELECT term, filename, any_value(n_terms) AS n_terms, count(*) AS n, list(k) AS positions FROM placed GROUP BY term, filename),
held AS (SELECT term, count(*) AS n_held FROM postings GROUP BY term),
queries AS (SELECT doc_id AS query_id, ({_WORDS.format(text="substring(text, 1, 300)")})[{first}:{first + n - 1}] AS words FROM documents WHERE doc_id % 20 = 0),
wanted AS (SELECT query_id, unnest(words) AS term, unnest(range(len(words))) AS place FROM queries),
weighed AS (
  SELECT DISTINCT query_id, filename, term,
         ln(1 + (n_docs - n_held + 0.5) / (n_held + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * n_terms / mean_terms)) AS weight
  FROM wanted JOIN postings USING (term) JOIN held USING (term), corpus),
answers AS (
  SELECT query_id, filename, count(*)::INTEGER AS n_terms_found, sum(weight) AS score FROM weighed GROUP BY query_id, filename),
complete AS (
  SELECT answers.* FROM answers JOIN (SELECT query_id, count(DISTINCT term) AS n_wanted FROM wanted GROUP BY query_id) USING (query_id)
  WHERE n_terms_found = n_wanted),
begins AS (
  SELECT query_id, filename FROM (
    SELECT query_id, filename, unnest(positions) - place AS begin FROM wanted JOIN postings USING (term))
  GROUP BY query_id, filename, begin HAVING count(*) = {n})
"""


_FAILURES = f"""WITH {fx.PAGES},
footed AS (
  SELECT path, string_agg(page_text || {fx.FOOTER_SQL.format(n="page_no")}, '' ORDER BY page_no) AS content,
         bool_or({_BAD_PAGE}) AS lost
  FROM pages_in GROUP BY path),
states AS (
  SELECT path, CASE WHEN {_BAD_FILE} THEN 'unreadable' WHEN lost THEN 'pages lost'
                    WHEN {fx.category_sql("replace(content, chr(10), '')")} <> '' THEN 'indexed'
                    ELSE 'no category' END AS state
  FROM src JOIN footed USING (path) WHERE {_PDF})
SELECT path, state, state <> 'indexed' AS there FROM states"""

ORACLE = {
    "scan_documents": f"""WITH {fx.SRC}
SELECT path, octet_length(encode(text))::BIGINT AS length, text FROM src WHERE {_PDF}""",
    "extract_pages": f"WITH {fx.PAGES} SELECT path, page_no, page_text, true AS ok FROM pages_in WHERE {_PDF}",
    "extract_rect": f"""WITH {fx.PAGES}
SELECT path, page_no,
       array_to_string([l[{_X} + 1:{_X + _W}] FOR l IN string_split(page_text, chr(10))[{_Y} + 1:{_Y + _H}]], chr(10))
         AS page_text
FROM pages_in WHERE {_PDF}""",
    "recognize_words": f"""WITH {fx.WORDS}
SELECT path, page_no, (row_number() OVER (PARTITION BY path, page_no ORDER BY line_no, word_no) - 1)::INTEGER AS word_no,
       text, confidence, x, y, w, h, true AS ok
FROM words_in JOIN pages_in USING (path, page_no) WHERE {_PDF} AND NOT {_NOT_READ}
UNION ALL SELECT path, page_no, NULL, NULL, NULL, NULL, NULL, NULL, NULL, false FROM pages_in WHERE {_PDF} AND {_NOT_READ}""",
    "segment_regions": f"""WITH {fx.WORDS}
SELECT path, page_no, (row_number() OVER (PARTITION BY path, page_no ORDER BY line_no) - 1)::INTEGER AS region_no,
       0 AS x, line_no AS y, length(line)::INTEGER AS w, 1 AS h, true AS ok
FROM page_lines JOIN pages_in USING (path, page_no) WHERE line <> '' AND {_PDF} AND NOT {_NOT_READ}
UNION ALL SELECT path, page_no, NULL, NULL, NULL, NULL, NULL, false FROM pages_in WHERE {_PDF} AND {_NOT_READ}""",
    "render_rasters": f"""WITH {fx.WORDS}
SELECT path, page_no, line_no AS y, length(line)::INTEGER AS width, true AS ok,
       CASE line WHEN '' THEN 0 ELSE list_sum([unicode(c) FOR c IN string_split(line, '')]) END::BIGINT AS total
FROM page_lines WHERE {_PDF}""",
    "recognize_rasters": f"""WITH {fx.WORDS}
SELECT path, page_no, string_agg(line, chr(10) ORDER BY line_no) AS page_text, true AS ok
FROM page_lines WHERE {_PDF} AND line_no % 2 = 0 GROUP BY path, page_no""",
    "write_texts": tq.ORACLE["assemble_document"],
    "write_text_files": f"""WITH {fx.SRC},
named AS (SELECT path, text, split_part(path, '/', -2) AS folder, split_part(path, '/', -1) AS name FROM src)
SELECT path, folder || '/' || {_hashed("name", "folder || '/' || name")} AS output,
       octet_length(encode(text))::BIGINT AS n_bytes FROM named""",
    "write_clashing_files": """SELECT source, count(*) * 3 AS n_files,
       sum(3 * (octet_length(encode(text)) + length('doc_' || doc_id || '.pdf')) + 2)::BIGINT AS n_bytes
FROM documents GROUP BY source""",
    "upsert_index": tq.ORACLE["latest_records"],
    "upsert_same_date": f"""WITH {fx.BATCHES}
SELECT filename, CASE WHEN filename IN (SELECT filename FROM new_batch) THEN 'a' ELSE classification END AS classification,
       '2024-01-31T08:30:00Z' AS date, content FROM merged""",
    "read_index": f"WITH {fx.BATCHES} SELECT filename, content FROM merged WHERE classification = 'good'",
    "compact_index": tq.ORACLE["latest_records"],
    "index_late_batches": f"""WITH {fx.BATCHES},
late AS (SELECT filename || '/late' AS filename, classification, date, 'again' AS content FROM new_batch WHERE classification = 'poor')
SELECT filename, CASE WHEN filename IN (SELECT filename FROM new_batch WHERE classification = 'poor') THEN 'b' ELSE classification END
         AS classification,
       CASE WHEN filename IN (SELECT filename FROM new_batch WHERE classification = 'poor') THEN '2024-02-29T23:59:59Z' ELSE date END AS date,
       content FROM old_batch
UNION ALL SELECT * FROM late""",
    "index_lookup": f"""WITH {fx.BATCHES}
SELECT filename, classification, date FROM merged WHERE filename = (SELECT min(filename) FROM merged)""",
    "search_index": _search(2, 2) + "SELECT query_id, filename, n_terms_found, round(score, 6) AS score FROM answers",
    "search_index_all": _search(2, 3)
    + """SELECT query_id, filename, n_terms_found, round(score, 6) AS score FROM complete
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, filename) <= 5""",
    "search_index_phrase": _search(4, 3)
    + """SELECT query_id, filename, n_terms_found, round(score, 6) AS score FROM complete
WHERE (query_id, filename) IN (SELECT (query_id, filename) FROM begins)""",
    "archive": f"""WITH {fx.SRC}
SELECT path, text AS content, {fx.category_sql("text")} AS classification FROM src""",
    "remove_sources": f"""WITH {fx.SRC}
SELECT path, {fx.category_sql("replace(text, chr(10), '')")} = '' AS there FROM src""",
    "ingest": tq.ORACLE["index_texts"],
    "ingest_failures": _FAILURES,
    "ingest_parts": f"""WITH {fx.PAGES},
parts AS (
  SELECT path, (page_no - 1) // {PAGES_PER_PART} AS part_no,
         string_agg(page_text || {fx.FOOTER_SQL.format(n="page_no")}, '' ORDER BY page_no) AS content
  FROM pages_in WHERE path LIKE '%.pdf' GROUP BY ALL),
judged AS (
  SELECT path, part_no, content,
         CASE {" ".join(f"WHEN regexp_matches(replace(content, chr(10), ''), '{p}') THEN {k}" for k, (_, p) in enumerate(fx.RULES))}
         ELSE {len(fx.RULES)} END AS rule FROM parts)
SELECT path AS filename, [{", ".join(f"'{c}'" for c, _ in fx.RULES)}][min(rule) + 1] AS classification,
       '2024-01-31T08:30:00Z' AS date, substring(arg_min(content, part_no), 1, 300) AS content
FROM judged GROUP BY path HAVING min(rule) < {len(fx.RULES)}""",
    "write_part_files": f"""WITH {fx.PAGES},
whole AS (
  SELECT path, string_agg(page_text || {fx.FOOTER_SQL.format(n="page_no")}, '' ORDER BY page_no) AS content FROM pages_in GROUP BY path)
SELECT sha256(content) AS digest, octet_length(encode(content))::BIGINT AS length FROM whole""",
    "ingest_stream": tq.ORACLE["index_texts"],
    "ingest_stream_failures": _FAILURES,
}
