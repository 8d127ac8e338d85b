"""What the plans have to look like, whatever the size of the data."""

import re

import pytest
from pyspark.sql import functions as F

import pagemill as pm
from catalog import fixtures as fx
from pagemill.functions import text as T


def plan_of(df, run=False):
    if run:
        df.write.format("noop").mode("overwrite").save()
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan ==")[0]


def count(plan, operator):
    return len(re.findall(rf"[+\-:* ()0-9]{operator}\b", plan))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Documents and pages as plain tables."""
    base = str(tmp_path_factory.mktemp("plans"))
    sf = "/root/testdata/sf0.001"
    fx.sources(spark, sf).write.parquet(f"{base}/docs")
    fx.pages(spark, sf).write.parquet(f"{base}/pages")
    fx.raster(spark, sf).write.parquet(f"{base}/raster")
    return lambda name: spark.read.parquet(f"{base}/{name}")


def test_flagship_is_one_stage(stored):
    plan = plan_of(pm.index_texts(stored("docs"), fx.pages_column(), fx.RULES, fx.FIRST_RUN))
    assert count(plan, "Exchange") == 0
    assert plan.count("RLIKE") == len(fx.RULES)
    assert plan.count("split(") == 1
    assert "Python" not in plan and "Arrow" not in plan


def test_words_do_not_shuffle(stored):
    plan = plan_of(pm.extract_words(stored("pages")))
    assert count(plan, "Exchange") == 0
    assert plan.count("regexp_extract_all") == 1


def test_assembling_shuffles_once(stored):
    assert count(plan_of(pm.assemble_document(stored("pages"))), "Exchange") == 1
    assert count(plan_of(pm.assemble_paged(stored("docs"), fx.pages_column())), "Exchange") == 0


def test_parts_do_not_shuffle_texts_again(spark, stored):
    """What was stored is read, and only spans that are not their document's first have a row to join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(pm.assemble_parts(stored("pages"), 5))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "page-spans" in plan and "/pages]" not in plan
    plan = plan_of(pm.assemble_parts(stored("pages"), 5), run=True)
    assert "BroadcastHashJoin" in plan and count(plan, "SortMergeJoin") == 0


def test_categories_are_matched_once(stored):
    docs = stored("docs").withColumnRenamed("text", "content")
    kept = pm.drop_blank(pm.classify_rules(docs, fx.RULES), "classification")
    plan = plan_of(kept)
    assert plan.count("RLIKE") == len(fx.RULES)


def test_extraction_prunes_and_pushes(stored):
    plan = plan_of(pm.document_count(pm.filter_extension(stored("docs"))))
    assert "ReadSchema: struct<path:string>" in plan
    index = pm.latest_records(
        stored("docs").select(
            F.col("path").alias("filename"),
            F.lit("c").alias("classification"),
            F.lit("d").alias("date"),
            F.lit("").alias("content"),
        )
    ).where(F.col("filename") == "x")
    assert "EqualTo(path,x)" in plan_of(index)


def test_joins_leave_the_choice_to_spark(spark, stored):
    docs = stored("docs").withColumnRenamed("text", "content")
    cats = docs.select("path", F.lit("c").alias("classification"))
    index = cats.withColumnRenamed("path", "filename")
    for joined in (pm.attach_classification(docs, cats), pm.indexed_only(docs, index)):
        assert "rightHint" not in joined._jdf.queryExecution().analyzed().toString()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = plan_of(joined.select("*"))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert "SortMergeJoin" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_rectangles_never_need_a_nested_loop(spark, stored):
    words = pm.extract_words(stored("pages"))
    rects = fx.page_rects(spark, "/root/testdata/sf0.001")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(pm.words_in_rect(words, rects))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_mask_is_computed_once(stored):
    plan = plan_of(pm.clean_image(stored("raster"), 100, 2, 4, 2), run=True)
    assert "ReusedExchange" in plan
    assert len(re.findall(r"\bFileScan\b", plan)) == len(re.findall(r"\+- MapInPandas", plan)) == 1


def test_pixels_stay_in_lines(stored):
    plan = plan_of(pm.to_pixels(pm.clean_image(stored("raster"), 100, 2, 4, 2)))
    exploded = [m.start() for m in re.finditer("Generate posexplode", plan)]
    assert len(exploded) == 1 and exploded[0] < plan.index("Exchange")


def test_bound_values_are_computed_once(spark):
    df = spark.createDataFrame([("a b c",)], "text string")
    doubled = T.bind(F.split("text", " "), lambda words: F.concat(words, words))
    plan = plan_of(df.select(doubled.alias("w")))
    assert plan.count("split(") == 1


def test_pandas_classifier_runs_once(stored):
    docs = stored("docs").withColumnRenamed("text", "content")
    classified = pm.classify_udf(docs, lambda texts: texts.str.slice(0, 1))
    plan = plan_of(pm.drop_blank(classified, "classification"))
    assert plan.count("ArrowEvalPython") == 1


def test_symbols_are_made_without_lambdas(spark):
    pages = spark.createDataFrame([("a", 1, "x")], "path string, page_no int, page_text string")
    symbols = pm.extract_words(pages, "symbol").select("path", "page_no", "line_no", "text", "box")
    assert "lambda" not in symbols._jdf.queryExecution().optimizedPlan().toString()


def test_symbols_have_their_places_and_numbers(spark):
    texts = ["ab  c\td\n\n  \n e\U0001f600é \r\f z ", " \t", "", None, "x" * 3000 + " y"]
    pages = spark.createDataFrame([("a", k, t) for k, t in enumerate(texts)], "path string, page_no int, page_text string")
    want = []
    for k, t in enumerate(texts):
        for y, line in enumerate((t or "").split("\n")):
            inked = [(x, c) for x, c in enumerate(line) if c not in " \t\r\f"]
            want += [("a", k, y, n, c, 100.0, (x, y, 1, 1)) for n, (x, c) in enumerate(inked)]
    got = pm.extract_words(pages, "symbol")
    assert got.columns == ["path", "page_no", "line_no", "word_no", "text", "confidence", "box"]
    assert sorted((*r[:6], tuple(r["box"])) for r in got.collect()) == sorted(want)


def test_numbered_rows_are_not_shuffled_again_for_few_later_spans(spark):
    """Only the rows of spans are many; page 0 has lines in a second span."""
    line = F.when(F.col("id") % 1000 == 0, F.col("id") * 5).otherwise(F.col("id") % 7)
    words = spark.range(20_000).select(
        F.lit("a").alias("path"), (F.col("id") % 1000).cast("int").alias("page_no"), line.cast("int").alias("line_no"), F.col("id").cast("int").alias("word_no"),
        F.struct(*[F.col("id").cast("int").alias(c) for c in "xywh"]).alias("box"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "60000")
    try:
        regions = pm.extract_regions(words, "word")
        plan = regions._jdf.queryExecution().executedPlan().toString()
        got = regions.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    numbers = {}
    for r in got:
        numbers.setdefault(r["page_no"], []).append((r["region_no"], r["box"]["x"]))
    want = {p: sorted((i * 5 if i % 1000 == 0 else i % 7, i) for i in range(p, 20_000, 1000)) for p in range(1000)}
    assert {p: sorted(n) for p, n in numbers.items()} == {p: [(k, i) for k, (_, i) in enumerate(o)] for p, o in want.items()}
