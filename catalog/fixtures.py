"""Inputs of the queries, all derived from the given tables, once for Spark and once as SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions import text as T
from pagemill.operators.layout import extract_words
from pagemill.operators.pages import extract_text_pages

LINES_PER_PAGE = 3
MAX_PAGES = 5
FIRST_RUN = datetime(2024, 1, 31, 8, 30, 0)
SECOND_RUN = datetime(2024, 2, 29, 23, 59, 59)
RULES = [
    ("contact", r"[a-z0-9]+@[a-z0-9]+\.[a-z]+"),
    ("license", r"[Ll]icen[cs]e"),
    ("german", r"(^| )(der|die|das) "),
    ("english", r"(^| )(the|and) "),
]
NEEDLE = "ation"
# Files and pages that the failing engine cannot read are those whose length is a multiple of these.
BAD_FILE = 11
BAD_PAGE = 13
RECT = (3, 1, 20, 2)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, text)``: documents under paths whose extension follows from the language."""
    lang = F.col("lang")
    ext = (
        F.when(lang == "en", ".pdf").when(lang == "de", ".PDF").when(lang == "fr", ".Pdf").otherwise(".txt")
    )
    path = F.concat(
        F.lit("hdfs:/in/"), F.col("source"), F.lit("/Doc_"), F.col("doc_id").cast("string"), ext
    )
    return table(spark, sf_dir, "documents").select(path.alias("path"), "text")


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources(spark, sf_dir).withColumnRenamed("text", "content")


def pages_column():
    return T.pages_by_lines("text", LINES_PER_PAGE)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text_pages(sources(spark, sf_dir), LINES_PER_PAGE)


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_words(pages(spark, sf_dir))


def flat_boxes(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "box"]
    return df.select(*rest, "box.x", "box.y", "box.w", "box.h")


def page_rects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rectangles that hold for every page, one per region."""
    key = F.col("r_regionkey")
    return table(spark, sf_dir, "region").select(
        key.alias("rect_id"),
        (key * 20).alias("rx"),
        F.floor(key / 2).cast("int").alias("ry"),
        (key * 10 + 40).alias("rw"),
        F.lit(2).alias("rh"),
    )


def index_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All documents at a first date by language, and the labelled ones again at a second date by label."""
    path = F.concat(F.lit("hdfs:/in/"), F.col("source"), F.lit("/Doc_"), F.col("doc_id").cast("string"))
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    old = docs.select(path.alias("path"), F.col("lang").alias("classification"), F.col("text").alias("content"))
    quality = F.when(F.col("quality") == 1, "good").otherwise("poor")
    new = docs.join(labels, "doc_id").select(
        path.alias("path"), quality.alias("classification"), F.col("text").alias("content")
    )
    return old, new


def gray_values(column: str = "embedding"):
    """Each component of a vector as a gray value."""
    return F.transform(
        column,
        lambda e: F.least(F.lit(255), F.greatest(F.lit(0), F.floor(F.lit(128) + e.cast("double") * 500))).cast("int"),
    )


def square(values, *names: str):
    """64 values as 8 lines of 8, with the place of each line."""
    lines = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda y: F.slice(values, y * 8 + 1, F.lit(8)))
    return F.posexplode(lines).alias(*names)


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each embedding as an image of 8 x 8 pixels."""
    image = F.col("vec_id").alias("image_id")
    return table(spark, sf_dir, "embeddings").select(image, square(gray_values(), "y", "v"))


def tall_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each embedding as one line of 64 pixels, 250 lines to an image."""
    return table(spark, sf_dir, "embeddings").select(
        F.floor(F.col("vec_id") / 250).cast("long").alias("image_id"),
        (F.col("vec_id") % 250).cast("int").alias("y"),
        gray_values().alias("v"),
    )


SRC = """src AS (
  SELECT doc_id, 'hdfs:/in/' || source || '/Doc_' || doc_id ||
         CASE lang WHEN 'en' THEN '.pdf' WHEN 'de' THEN '.PDF' WHEN 'fr' THEN '.Pdf' ELSE '.txt' END AS path, text
  FROM documents)"""
PAGES = (
    SRC
    + f""",
lines_in AS (
  SELECT path, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS n
  FROM src),
pages_in AS (
  SELECT path, (n // {LINES_PER_PAGE} + 1)::INTEGER AS page_no, string_agg(line, chr(10) ORDER BY n) AS page_text
  FROM lines_in GROUP BY path, n // {LINES_PER_PAGE})"""
)
WORDS = (
    PAGES
    + """,
page_lines AS (
  SELECT path, page_no, unnest(string_split(page_text, chr(10))) AS line,
         unnest(range(len(string_split(page_text, chr(10)))))::INTEGER AS line_no
  FROM pages_in),
tokens AS (
  SELECT path, page_no, line_no, unnest(regexp_extract_all(line, '[ \\t]+|[^ \\t]+')) AS token,
         unnest(range(len(regexp_extract_all(line, '[ \\t]+|[^ \\t]+')))) AS k
  FROM page_lines),
placed AS (
  SELECT *, (sum(length(token)) OVER (PARTITION BY path, page_no, line_no ORDER BY k) - length(token))::INTEGER AS x
  FROM tokens),
words_in AS (
  SELECT path, page_no, line_no,
         (row_number() OVER (PARTITION BY path, page_no, line_no ORDER BY k) - 1)::INTEGER AS word_no,
         token AS text, 100.0::FLOAT AS confidence, x, line_no AS y, length(token)::INTEGER AS w, 1::INTEGER AS h
  FROM placed WHERE trim(token, ' ' || chr(9)) <> '')"""
)
RECTS = """rects AS (
  SELECT r_regionkey AS rect_id, r_regionkey * 20 AS rx, r_regionkey // 2 AS ry, r_regionkey * 10 + 40 AS rw, 2 AS rh
  FROM region)"""
BATCHES = """old_batch AS (
  SELECT 'hdfs:/in/' || source || '/Doc_' || doc_id AS filename, lang AS classification,
         '2024-01-31T08:30:00Z' AS date, substring(text, 1, 300) AS content FROM documents),
new_batch AS (
  SELECT 'hdfs:/in/' || source || '/Doc_' || doc_id AS filename,
         CASE quality WHEN 1 THEN 'good' ELSE 'poor' END AS classification,
         '2024-02-29T23:59:59Z' AS date, substring(text, 1, 300) AS content
  FROM documents JOIN labels USING (doc_id)),
merged AS (
  SELECT * FROM new_batch
  UNION ALL
  SELECT * FROM old_batch WHERE filename NOT IN (SELECT filename FROM new_batch))"""
RASTER = """cells AS (
  SELECT vec_id, unnest(range(len(embedding))) AS k, unnest(embedding)::DOUBLE AS e FROM embeddings),
px AS (
  SELECT vec_id AS image_id, (k // 8)::INTEGER AS y, (k % 8)::INTEGER AS x,
         least(255, greatest(0, floor(128 + e * 500)))::INTEGER AS v
  FROM cells)"""
TALL = """cells AS (
  SELECT vec_id, unnest(range(len(embedding))) AS k, unnest(embedding)::DOUBLE AS e FROM embeddings),
px AS (
  SELECT vec_id // 250 AS image_id, (vec_id % 250)::INTEGER AS y, k::INTEGER AS x,
         least(255, greatest(0, floor(128 + e * 500)))::INTEGER AS v
  FROM cells)"""


def category_sql(column: str) -> str:
    cases = " ".join(f"WHEN regexp_matches({column}, '{p}') THEN '{c}'" for c, p in RULES)
    return f"CASE {cases} ELSE '' END"


FOOTER_SQL = (
    "chr(10) || chr(10) || repeat(chr(9), 6) || '########### ' || {n} || ' ###########' || chr(10) || chr(10)"
)
