"""Scanning, extraction, assembling, classifying, writing and removing on small hand-made files."""

import glob
import hashlib
import importlib
import os
import re
import time
from datetime import datetime, timedelta, timezone

import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import pagemill as pm
from pagemill.functions.fixed import FOOTER_AFTER, FOOTER_BEFORE
from pagemill.operators import layout
from pagemill.operators import pages as pages_module

RUN = datetime(2024, 5, 6, 7, 8, 9)


def put(folder, files):
    for name, data in files.items():
        place = os.path.join(folder, name)
        os.makedirs(os.path.dirname(place), exist_ok=True)
        with open(place, "wb") as f:
            f.write(data if isinstance(data, bytes) else data.encode())


def names(df, folder, col="path"):
    return sorted(r[0].split(folder + "/")[1] for r in df.select(col).collect())


def form_feed_engine():
    class Engine:
        made = 0

        def __init__(self):
            Engine.made += 1

        def page_count(self, file):
            data = file.read()
            if data.startswith(b"broken"):
                raise OSError("not a document")
            return data.count(b"\f") + 1

        def render(self, file, first_page, last_page):
            for page in file.read().decode().split("\f")[first_page - 1 : last_page]:
                if page == "unrenderable":
                    raise RuntimeError("cannot render")
                yield page

        def recognize(self, image, lang, rect):
            if image == "unreadable":
                raise RuntimeError("cannot read")
            return f"{lang}:{image}" if rect is None else f"{lang}:{image[rect[0] : rect[0] + rect[2]]}"

        def words(self, image, lang, rect, level):
            for i, word in enumerate(image.split()):
                if word == "unreadable":
                    raise RuntimeError("cannot read")
                yield word, 50.0 + i, 10 * i, 0, len(word), 1

        def regions(self, image, level):
            if image == "unreadable":
                raise RuntimeError("cannot read")
            return [(0, 0, len(image), 1)]

    return Engine


def test_scan_finds_sub_folders_and_any_case(spark, folder):
    put(folder, {"a/One.PDF": "1", "a/b/two.pdf": "22", "a/three.txt": "333", "a/nopdf": "4444"})
    found = pm.scan_documents(spark, folder, extension="pdf")
    assert names(found, folder) == ["a/One.PDF", "a/b/two.pdf"]
    everything = pm.scan_documents(spark, folder)
    assert names(everything, folder) == ["a/One.PDF", "a/b/two.pdf", "a/nopdf", "a/three.txt"]
    assert names(pm.filter_extension(everything), folder) == ["a/One.PDF", "a/b/two.pdf"]


def test_scan_reads_content_only_when_asked(spark, folder):
    put(folder, {"a.pdf": "x" * 10})
    listed = pm.scan_documents(spark, folder, extension="pdf").select("path", "length")
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_scan_is_listed_by_tasks(spark, folder):
    put(folder, {"a/One.PDF": "1", "b/c/two.pdf": "22", "a/empty.pdf": "", "_h/x.pdf": "3", "a/.y.pdf": "4", "k=v/z.pdf": "ü"})
    found = pm.scan_documents(spark, folder, extension="pdf")
    assert not [f for f in found.inputFiles() if f.lower().endswith("pdf")]
    old = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[pP][dD][fF]").load(folder)
    assert found.schema == old.schema
    assert sorted(map(str, found.collect())) == sorted(map(str, old.collect()))
    # the list is that of the call
    put(folder, {"later.pdf": "5"})
    assert found.count() == 3
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        pm.scan_documents(spark, f"{folder}/none")


def test_files_are_handed_on_in_bounded_batches(spark, folder, monkeypatch):
    monkeypatch.setattr("pagemill.sources.documents._READ_BYTES", 4)
    texts = {f"{i}.pdf": str(i) * (i + 1) for i in range(9)}
    put(folder, texts)
    found = pm.decode_documents(pm.scan_documents(spark, folder)).coalesce(1)
    assert {r.path.split("/")[-1]: r.text for r in found.collect()} == texts


def test_union_of_scans_keeps_both(spark, folder):
    put(folder, {"x/a.pdf": "1", "y/b.pdf": "2", "y/c.txt": "3"})
    both = pm.union_sources(
        pm.scan_documents(spark, f"{folder}/x"), pm.scan_documents(spark, f"{folder}/y")
    )
    assert pm.document_count(pm.filter_extension(both)).first().n_documents == 2
    twice = pm.union_sources(both, both)
    assert pm.document_count(twice).first().n_documents == 6


def test_extension_of_path_without_dot_is_the_path(spark):
    df = spark.createDataFrame([("pdf",), ("a/pdf",), ("a.b/c",), ("x.PdF",)], "path string")
    assert sorted(r.path for r in pm.filter_extension(df).collect()) == ["pdf", "x.PdF"]


def test_pages_are_numbered_from_one(spark):
    df = spark.createDataFrame([("p", "one\ftwo\fthree")], "path string, text string")
    pages = pm.extract_text_pages(df).orderBy("page_no").collect()
    assert [(r.page_no, r.page_text) for r in pages] == [(1, "one"), (2, "two"), (3, "three")]


def test_engine_extraction_with_batches(spark, folder):
    text = "\f".join(f"page{i}" for i in range(1, 8))
    put(folder, {"long.pdf": text, "sub/short.pdf": "only", "with space.pdf": "a\fb"})
    files = pm.scan_documents(spark, folder, extension="pdf").select("path")
    counts = pm.document_page_counts(files, form_feed_engine())
    batches = pm.plan_page_batches(counts.select("path", "n_pages"), 3)
    assert batches.count() == 5
    pages = pm.extract_pages(batches, form_feed_engine(), num_partitions=4)
    got = {(r.path.split("/")[-1], r.page_no): r.page_text for r in pages.collect()}
    want = {("long.pdf", i): f"spa:page{i}" for i in range(1, 8)}
    want |= {("short.pdf", 1): "spa:only", ("with space.pdf", 1): "spa:a", ("with space.pdf", 2): "spa:b"}
    assert got == want


def test_extraction_from_bytes_in_hand(spark):
    df = spark.createDataFrame(
        [("p", bytearray(b"a\fb\fc"), 2, 3)], "path string, content binary, first_page int, last_page int"
    )
    pages = pm.extract_pages(df, form_feed_engine(), lang="eng").orderBy("page_no").collect()
    assert [(r.page_no, r.page_text) for r in pages] == [(2, "eng:b"), (3, "eng:c")]


def test_failures_stay_where_they_happen(spark, folder):
    put(
        folder,
        {
            "unread.pdf": "a\funreadable\fc",
            "unrendered.pdf": "a\fb\funrenderable\fd\fe",
            "broken.pdf": "broken",
        },
    )
    files = pm.scan_documents(spark, folder, extension="pdf").select("path")
    counts = pm.document_page_counts(files, form_feed_engine())
    bad = counts.where(~F.col("ok")).collect()
    assert len(bad) == 1 and "not a document" in bad[0].error and bad[0].n_pages == 0

    pages = pm.extract_pages(pm.plan_page_batches(counts.select("path", "n_pages"), 2), form_feed_engine())
    got = {(r.path.split("/")[-1], r.page_no): (r.page_text, r.ok) for r in pages.collect()}
    assert got == {
        ("unread.pdf", 1): ("spa:a", True),
        ("unread.pdf", 2): ("", False),
        ("unread.pdf", 3): ("spa:c", True),
        ("unrendered.pdf", 1): ("spa:a", True),
        ("unrendered.pdf", 2): ("spa:b", True),
        ("unrendered.pdf", 3): (None, False),
        ("unrendered.pdf", 4): (None, False),
        ("unrendered.pdf", 5): ("spa:e", True),
    }
    assert pm.failed_pages(pages).count() == 3

    # Footers count the pages a document really has.
    documents = {r.path.split("/")[-1]: r for r in pm.assemble_document(pages).collect()}
    assert documents["unrendered.pdf"].n_pages == 3
    assert documents["unrendered.pdf"].content == "".join(
        f"spa:{t}{FOOTER_BEFORE}{i}{FOOTER_AFTER}" for i, t in enumerate("abe", 1)
    )
    footed = pm.page_footer(pages).where(F.col("path").endswith("unrendered.pdf")).orderBy("page_no").collect()
    assert [(r.page_no, r.footer_no) for r in footed] == [(1, 1), (2, 2), (5, 3)]


def one_range(spark, text, first=1, last=1):
    rows = [("p", bytearray(text.encode()), first, last)]
    return spark.createDataFrame(rows, "path string, content binary, first_page int, last_page int")


def test_part_of_an_image(spark):
    ranges = one_range(spark, "abcdef\fghijkl", 1, 2)
    rect = [F.lit(v).alias(n) for n, v in (("rx", 1), ("ry", 0), ("rw", 3), ("rh", 1))]
    pages = pm.extract_pages(ranges.select("*", *rect), form_feed_engine()).orderBy("page_no").collect()
    assert [r.page_text for r in pages] == ["spa:bcd", "spa:hij"]


def test_rows_with_boxes_become_batches_of_bounded_size():
    import pyarrow as pa

    from pagemill.operators.extract import _batched

    box = pa.struct([("x", pa.int32()), ("y", pa.int32())])
    schema = pa.schema([("text", pa.string()), ("box", box), ("n", pa.int32())])
    rows = [("a", (1, 2), 1), (None, None, None), ("b" * 16_000_000, (3, None), 2), ("c", (5, 6), 3)]
    found = list(_batched()(iter(rows), schema))
    assert [b.num_rows for b in found] == [3, 1] and found[0].schema == schema
    assert [r["box"] for b in found for r in b.to_pylist()] == [{"x": 1, "y": 2}, None, {"x": 3, "y": None}, {"x": 5, "y": 6}]
    nothing = list(_batched()(iter([("a", None, 1)] * 2001), schema))
    assert [b.num_rows for b in nothing] == [2000, 1] and nothing[0].column("box").null_count == 2000


def test_engine_words_stop_at_an_error(spark):
    words = pm.recognize_words(one_range(spark, "one two unreadable three\ffour", 1, 2), form_feed_engine())
    rows = words.collect()
    got = [(r.page_no, r.word_no, r.text, r.confidence, tuple(r.box)) for r in rows if r.ok]
    assert got == [
        (1, 0, "one", 50.0, (0, 0, 3, 1)),
        (1, 1, "two", 51.0, (10, 0, 3, 1)),
        (2, 0, "four", 50.0, (0, 0, 4, 1)),
    ]
    failed = [r for r in rows if not r.ok]
    assert [(r.page_no, r.word_no, r.text, r.box) for r in failed] == [(1, None, None, None)] and failed[0].error


def test_engine_regions_report(spark):
    regions = pm.segment_regions(one_range(spark, "one"), form_feed_engine())
    assert [(r.page_no, r.region_no, tuple(r.box)) for r in regions.collect()] == [(1, 0, (0, 0, 3, 1))]
    for text in ("unreadable", "unrenderable"):
        for read in (pm.segment_regions, pm.recognize_words):
            row = read(one_range(spark, text), form_feed_engine()).first()
            assert (row.page_no, row.ok, row.box) == (1, False, None) and "cannot" in row.error


def test_engine_that_gives_too_few_images(spark):
    pages = pm.extract_pages(one_range(spark, "a\fb", 1, 3), form_feed_engine()).orderBy("page_no").collect()
    assert [(r.page_text, r.ok) for r in pages] == [("spa:a", True), ("spa:b", True), (None, False)]


@pytest.mark.parametrize("n, sizes", [(1, [1]), (4, [4]), (5, [5]), (6, [5, 1]), (10, [5, 5]), (11, [5, 5, 1])])
def test_batches_cover_all_pages(spark, n, sizes):
    df = spark.createDataFrame([("p", n)], "path string, n_pages int")
    rows = pm.plan_page_batches(df, 5).orderBy("batch_no").collect()
    assert [r.last_page - r.first_page + 1 for r in rows] == sizes
    assert [p for r in rows for p in range(r.first_page, r.last_page + 1)] == list(range(1, n + 1))


def test_document_without_pages_has_no_batch(spark):
    df = spark.createDataFrame([("p", 0), ("q", None)], "path string, n_pages int")
    assert pm.plan_page_batches(df, 5).count() == 0


def test_assembled_text_is_stored_once(spark):
    pages = spark.createDataFrame(
        [("p", i, f"text {i}") for i in (3, 1, 2)], "path string, page_no int, page_text string"
    )
    row = pm.assemble_document(pages).first()
    assert re.findall(r"#{11} (\d+) #{11}", row.content) == ["1", "2", "3"]
    assert row.content.startswith("text 1\n\n\t\t\t\t\t\t########### 1 ###########\n\ntext 2")


def test_parts_are_the_document(spark):
    rows = [("big", i, f"t{i}") for i in range(1, 2501)] + [("small", 1, "x"), ("gaps", 5, "a"), ("gaps", 2100, "b")]
    pages = spark.createDataFrame(rows, "path string, page_no int, page_text string")
    whole = {r.path: r.content for r in pm.assemble_document(pages).collect()}
    parts = pm.assemble_parts(pages, 400).orderBy("path", "part_no").collect()
    joined = {}
    for r in parts:
        assert r.n_pages <= 400
        joined[r.path] = joined.get(r.path, "") + r.content
    assert joined == whole


def test_words_have_places(spark):
    df = spark.createDataFrame(
        [("p", 1, "  two words\n\nx\tñandú  end")], "path string, page_no int, page_text string"
    )
    got = [(r.text, r.line_no, r.word_no, r.box.x, r.box.y, r.box.w) for r in pm.extract_words(df).collect()]
    assert got == [
        ("two", 0, 0, 2, 0, 3),
        ("words", 0, 1, 6, 0, 5),
        ("x", 2, 0, 0, 2, 1),
        ("ñandú", 2, 1, 2, 2, 5),
        ("end", 2, 2, 9, 2, 3),
    ]
    lines = [(r.text, r.box.x, r.box.w) for r in pm.extract_words(df, "line").collect()]
    assert lines == [("two words", 2, 9), ("x\tñandú  end", 0, 12)]
    symbols = pm.extract_words(df.where(F.lit(True)), "symbol").collect()
    assert "".join(r.text for r in symbols) == "twowordsxñandúend"
    with pytest.raises(ValueError):
        pm.extract_words(df, "chapter")


def test_long_line_of_words(spark):
    text = " ".join(f"w{i}" for i in range(30_000))
    df = spark.createDataFrame([("p", 1, text)], "path string, page_no int, page_text string")
    row = pm.extract_words(df).agg(F.count("*").alias("n"), F.max("box.x").alias("x")).first()
    assert (row.n, row.x) == (30_000, text.rindex(" ") + 1)


def test_rectangles_of_any_size_are_listed_a_few_times(spark):
    rects = [(k, k, -k, 3**k % (2**31), 5**k % (2**31)) for k in range(20)] + [(99, 0, 0, 200_000, 200_000)]
    df = spark.createDataFrame(rects, "rect_id int, rx int, ry int, rw int, rh int")
    counts = {r["rect_id"]: r["count"] for r in layout.list_rects(df, 16).groupBy("rect_id").count().collect()}
    assert len(counts) == len(rects) and max(counts.values()) <= 64


@pytest.mark.parametrize("span", [1, 2, 3, 4096])
def test_blocks_and_words_over_spans(spark, monkeypatch, span):
    """Blocks that begin, end or go on at the border of a span of lines, on several pages."""
    monkeypatch.setattr(layout, "_SPAN", span)
    texts = ["a\nb\nc\n\nd\n\n\ne\nf", "\n\na b\nc d e", "x", "\n".join("yy" if k % 5 else "" for k in range(40))]
    df = spark.createDataFrame([("p", k, t) for k, t in enumerate(texts)], "path string, page_no int, page_text string")
    words = pm.extract_words(df)
    want = []
    for page, text in enumerate(texts):
        blocks, fresh = [], True
        for y, line in enumerate(text.split("\n")):
            if line and fresh:
                blocks.append([y, y, len(line)])
            elif line:
                blocks[-1][1:] = [y, max(blocks[-1][2], len(line))]
            fresh = not line
        want += [(page, k, a, b - a + 1, w) for k, (a, b, w) in enumerate(blocks)]
    got = pm.extract_regions(words, "block").select("page_no", "region_no", "box.y", "box.h", "box.w").collect()
    assert sorted(map(tuple, got)) == want
    numbers = pm.extract_regions(words, "word").select("page_no", "region_no", "box.y", "box.x").collect()
    places = sorted((r.page_no, r.box.y, r.box.x) for r in words.collect())
    of_page = [sum(p[0] == q[0] for q in places[:k]) for k, p in enumerate(places)]
    assert sorted((r.page_no, r.y, r.x, r.region_no) for r in numbers) == [(*p, k) for p, k in zip(places, of_page, strict=True)]


def test_pages_are_evaluated_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def looked_at(text):
        seen.add(1)
        return text

    rows = [("a", k, f"t{k}") for k in range(1, 2301)] + [("b", 1, "x"), ("b", 7, None)]
    pages = spark.createDataFrame(rows, "path string, page_no int, page_text string").repartition(4)
    for work in (pm.page_footer, pm.assemble_parts):
        seen.value = 0
        work(pages.withColumn("page_text", looked_at("page_text"))).collect()
        assert len(rows) - 1 <= seen.value <= len(rows)


def test_footers_over_spans(spark, monkeypatch):
    monkeypatch.setattr(pages_module, "_SPAN", 3)
    rows = [("a", k, f"t{k}", k % 2 == 0) for k in (1, 2, 5, 6, 7, 8, 30, 31)] + [("b", 2, "x", True), ("b", 4, None, False)]
    pages = spark.createDataFrame(rows, "path string, page_no int, page_text string, ok boolean")
    footed = pm.page_footer(pages)
    assert footed.columns == ["path", "page_no", "page_text", "ok", "footer_no"]
    got = sorted((r.path, r.page_no, r.footer_no, r.page_text, r.ok) for r in footed.collect())
    kept = sorted(r for r in rows if r[2] is not None)
    want = [(p, n, sum(q[0] == p and q[1] <= n for q in kept), t, ok) for p, n, t, ok in kept]
    assert got == [(p, n, k, f"{t}{FOOTER_BEFORE}{k}{FOOTER_AFTER}", ok) for p, n, k, t, ok in want]


def test_blocks_end_at_empty_lines(spark):
    df = spark.createDataFrame([("p", 1, "aa\n b\n\n   \ncccc\n")], "path string, page_no int, page_text string")
    words = pm.extract_words(df)
    got = [
        (r.region_no, r.box.x, r.box.y, r.box.w, r.box.h)
        for r in pm.extract_regions(words, "block").orderBy("region_no").collect()
    ]
    assert got == [(0, 0, 0, 2, 2), (1, 0, 4, 4, 1)]
    blocks = pm.extract_words(df, "block").orderBy("word_no").collect()
    texts = [(r.word_no, r.line_no, r.text, tuple(r.box)) for r in blocks]
    assert texts == [(0, 0, "aa\nb", (0, 0, 2, 2)), (1, 4, "cccc", (0, 4, 4, 1))]


@pytest.mark.parametrize("bits, salts", [(0, 1), (2, 4), (4, 16)])
def test_words_in_rect_match_brute_force(spark, monkeypatch, bits, salts):
    monkeypatch.setattr(layout, "_CELL_BITS", bits)
    text = "\n".join(" ".join("ab"[: 1 + (i * j) % 2] * (1 + (i + j) % 5) for j in range(30)) for i in range(12))
    df = spark.createDataFrame([("p", 1, text), ("q", 2, text[::-1])], "path string, page_no int, page_text string")
    words = pm.extract_words(df)
    rects = [(1, 0, 0, 20, 3), (2, 5, 2, 40, 5), (3, 5, 2, 0, 5), (4, 0, 0, 500, 500), (5, 64, 3, 3, 1)]
    rects += [(6, -7, -3, 60, 9), (7, -100_000, -100_000, 200_000, 200_000), (8, 0, 4, 2**31 - 1, 1), (9, 3, -(2**31), 4, 2**31 - 1)]
    keyed = [(10, 0, 0, 50, 6, "p", 1), (11, 0, 0, 50, 6, "p", 2), (12, 3, 3, 30, 4, "q", 2)]
    boxes = [(r.path, r.page_no, r.line_no, r.word_no, tuple(r.box)) for r in words.collect()]

    def inside(box, rect):
        x, y, w, h = box
        _, rx, ry, rw, rh = rect[:5]
        return rw > 0 and rh > 0 and x >= rx and y >= ry and x + w <= rx + rw and y + h <= ry + rh

    want = sorted((*b[:4], r[0]) for b in boxes for r in rects if inside(b[4], r))
    rect_df = spark.createDataFrame(rects, "rect_id int, rx int, ry int, rw int, rh int")
    got = pm.words_in_rect(words, rect_df, salts).select("path", "page_no", "line_no", "word_no", "rect_id")
    assert want and sorted(map(tuple, got.collect())) == want

    want = sorted((*b[:4], r[0]) for b in boxes for r in keyed if b[:2] == r[5:] and inside(b[4], r))
    keyed_df = spark.createDataFrame(
        keyed, "rect_id int, rx int, ry int, rw int, rh int, path string, page_no int"
    )
    got = pm.words_in_rect(words, keyed_df, salts).select("path", "page_no", "line_no", "word_no", "rect_id")
    assert want and sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("few", [0, 1, 2])
def test_rectangles_by_grid_or_one_by_one_are_the_same(spark, monkeypatch, few):
    text = "\n".join(" ".join("ab" * (1 + (i + j) % 5) for j in range(20)) for i in range(9))
    df = spark.createDataFrame([("p", 1, text), ("q", 2, text), ("r", 3, text)], "path string, page_no int, page_text string")
    words = pm.extract_words(df)
    keyed = spark.createDataFrame(
        [(1, 0, 0, 50, 6, "p", 1), (2, 9, 1, 90, 3, "p", 1), (3, 3, 3, 30, 4, "q", 2), (4, 0, 0, 0, 4, "r", 3)],
        "rect_id int, rx int, ry int, rw int, rh int, path string, page_no int",
    )
    for rects in (keyed, keyed.drop("path", "page_no")):
        want = sorted(pm.words_in_rect(words, rects).collect(), key=str)
        with monkeypatch.context() as patched:
            patched.setattr(layout, "_FEW", few)
            assert want and sorted(pm.words_in_rect(words, rects).collect(), key=str) == want


def test_words_of_pages_with_few_rectangles_are_not_multiplied(spark, folder):
    """Neither before the join by page nor for rectangles of many sizes that hold for every page."""
    df = spark.createDataFrame([("p", 1, "a b c d")], "path string, page_no int, page_text string")
    words = pm.write_texts(pm.extract_words(df), folder, "1")
    sizes = F.pow(F.lit(4), F.col("id")).cast("int")
    rects = spark.range(8).select(F.col("id").alias("rect_id"), F.lit(0).alias("rx"), F.lit(0).alias("ry"), sizes.alias("rw"), F.lit(1).alias("rh"))
    for given in (rects, rects.withColumns({"path": F.lit("p"), "page_no": F.lit(1)})):
        found = pm.words_in_rect(words, given)
        assert "grid" not in found._jdf.queryExecution().optimizedPlan().toString()
        assert found.count() == 1 + 2 + 6 * 4  # in a width of 1, of 4 and of more


def test_hocr_wraps_the_fragments(spark):
    df = spark.createDataFrame(
        [("p", 2, "<p>b</p>\n"), ("p", 1, "<p>a</p>\n")], "path string, page_no int, fragment string"
    )
    hocr = pm.render_hocr(df).first().hocr
    assert hocr.startswith("<!DOCTYPE html PUBLIC")
    assert hocr.endswith("<body>\n<p>a</p>\n<p>b</p>\n</body>\n</html>\n")


def test_short_and_long_previews(spark):
    df = spark.createDataFrame([("p", "short"), ("q", "ñ" * 400)], "path string, content string")
    assert {r.path: len(r.content) for r in pm.preview(df).collect()} == {"p": 5, "q": 300}


def test_index_date_is_utc(spark):
    df = spark.createDataFrame([("p", "c", "x")], "path string, classification string, content string")
    local = datetime(2024, 1, 1, 1, 30, tzinfo=timezone(timedelta(hours=2)))
    assert pm.index_record(df, local).first().date == "2023-12-31T23:30:00Z"
    assert pm.index_record(df, RUN).first().date == "2024-05-06T07:08:09Z"


def test_schemes_are_stripped(spark):
    df = spark.createDataFrame(
        [("hdfs://node:8020/a/b.pdf",), ("file:/a/b.pdf",), ("/a/b.pdf",), ("s3a://x/b.pdf",)], "path string"
    )
    assert [r.path for r in pm.strip_scheme(df).collect()] == [
        "/node:8020/a/b.pdf",
        "/a/b.pdf",
        "/a/b.pdf",
        "/x/b.pdf",
    ]


def test_output_names(spark):
    df = spark.createDataFrame([("hdfs:/In/My.PDF",), ("hdfs:/In/a.pdf.pdf",)], "path string")
    assert [r.output for r in pm.output_name(df, "/out/").collect()] == ["/out/my.txt", "/out/a.txt.txt"]


def classified(spark, rows):
    return spark.createDataFrame(rows, "path string, content string")


def test_piped_categories_stay_with_their_path(spark):
    docs = classified(spark, [(f"d{i}", f"text {i}\nsecond\tline") for i in range(50)])
    echo = pm.pipe_classify(docs, ["awk", "-F", "\t", '{ print $1 "\\t" "c-" $1 }'])
    assert {r.path: r.classification for r in echo.collect()} == {f"d{i}": f"c-d{i}" for i in range(50)}
    lossy = pm.pipe_classify(docs, ["awk", "-F", "\t", '$1 != "d7" { print $1 "\\t" "c-" $1 }'])
    attached = pm.attach_classification(docs, lossy).collect()
    assert len(attached) == 49
    assert all(r.classification == f"c-{r.path}" for r in attached)


def test_piped_paths_may_hold_anything(spark):
    rows = [("a\tb'\"", "x"), ("c\nd%09 {e}\\", "y"), ("ñ f", "")]
    answers = pm.pipe_classify(classified(spark, rows), ["awk", "-F", "\t", '{ print $1 "\\t" "<" $2 ">" }'])
    assert {r.path: r.classification for r in answers.collect()} == {p: f"<{t}>" for p, t in rows}


def test_pipe_sets_the_separator(spark):
    docs = classified(spark, [("a", "1;2;3")])
    command = ["awk", "-F", "\t", '{ print $1 "\\t" split($2, x, ENVIRON["SEPARATOR"]) }']
    assert pm.pipe_classify(docs, command, sep=";").first().classification == "3"


def test_pipe_reports_a_failing_program(spark):
    with pytest.raises(Exception):
        pm.pipe_classify(classified(spark, [("a", "x")]), ["sh", "-c", "cat > /dev/null; exit 3"]).collect()


def test_line_program_keeps_blanks_in_place(spark):
    docs = classified(spark, [("a", "one"), ("b", "drop"), ("c", "three\nlines")])
    cats = pm.pipe_classify_lines(docs.coalesce(1), ["awk", '{ print ($0 == "drop" ? "" : "c-" $0) }'])
    assert {r.path: r.classification for r in cats.collect()} == {"a": "c-one", "b": "", "c": "c-threelines"}
    kept = pm.drop_blank(pm.attach_classification(docs, cats), "classification")
    assert {r.path: r.classification for r in kept.collect()} == {"a": "c-one", "c": "c-threelines"}


def test_line_program_must_answer_each_line(spark):
    docs = classified(spark, [("a", "one"), ("b", "drop")]).coalesce(1)
    with pytest.raises(Exception, match="2 documents in, 1 categories out"):
        pm.pipe_classify_lines(docs, ["awk", '$0 != "drop"']).collect()


def test_line_program_starts_once_per_task(spark, folder):
    docs = spark.range(0, 25_000, 1, 2).select(
        F.col("id").cast("string").alias("path"), F.repeat(F.lit("x "), 40).alias("content")
    )
    count = ["sh", "-c", f"echo start >> {folder}/starts; exec cat"]
    cats = pm.pipe_classify_lines(docs, count)
    assert cats.count() == 25_000
    with open(f"{folder}/starts") as f:
        assert len(f.readlines()) == 2
    with pytest.raises(Exception, match="more categories out"):
        pm.pipe_classify_lines(docs.limit(3).coalesce(1), ["sed", "p"]).collect()


def test_copies_do_not_multiply(spark):
    docs = classified(spark, [("a", "x")] * 5 + [("b", "y")])
    cats = spark.createDataFrame([("a", "c")] * 4 + [("b", "d")], "path string, classification string")
    assert pm.attach_classification(docs, cats).groupBy("path").count().orderBy("path").collect() == [
        ("a", 5),
        ("b", 1),
    ]


def test_pandas_classifier(spark):
    def upper(texts: pd.Series) -> pd.Series:
        return texts.str.upper()

    got = pm.classify_udf(classified(spark, [("a", "x"), ("b", "y")]), upper).collect()
    assert {r.path: r.classification for r in got} == {"a": "X", "b": "Y"}


def test_first_rule_wins(spark):
    docs = classified(spark, [("a", "red blue"), ("b", "blue"), ("c", "green")])
    got = pm.classify_rules(docs, [("r", "red"), ("b", "blue")]).collect()
    assert {r.path: r.classification for r in got} == {"a": "r", "b": "b", "c": ""}


def test_drop_blank_keeps_white_space(spark):
    df = spark.createDataFrame([("a", ""), ("b", " "), ("c", "x")], "path string, classification string")
    assert sorted(r.path for r in pm.drop_blank(df, "classification").collect()) == ["b", "c"]


def record(name, date, text="t", cat="c"):
    return (name, cat, date, text)


def records(spark, rows):
    return spark.createDataFrame(rows, "filename string, classification string, date string, content string")


def test_index_keeps_the_newest(spark, folder):
    index = f"{folder}/index"
    pm.upsert_index(records(spark, [record("a", "2024-01"), record("b", "2024-01")]), index, "1")
    pm.upsert_index(records(spark, [record("a", "2024-02", "new"), record("c", "2024-02")]), index, "2")
    pm.upsert_index(records(spark, [record("a", "2023-12", "last written")]), index, "007")
    want = {"a": "last written", "b": "t", "c": "t"}
    assert {r.filename: r.content for r in pm.read_index(spark, index).collect()} == want
    # A batch with a sequence of its own takes its place in the order.
    pm.upsert_index(records(spark, [record("a", "2024-03", "early"), record("d", "2024-03")]), index, "0", sequence=1)
    want["d"] = "t"
    assert {r.filename: r.content for r in pm.read_index(spark, index).collect()} == want
    # Folding changes nothing, with the folded batches still there, and leaves later batches their place.
    old = pm.compact_index(spark, index)
    assert len(old) == 4 and all(os.path.isdir(p) for p in old)
    assert {r.filename: r.content for r in pm.read_index(spark, index).collect()} == want
    assert pm.compact_index(spark, index) == []
    pm.upsert_index(records(spark, [record("b", "2020-01", "later")]), index, "5")
    assert len(pm.compact_index(spark, index)) == 2
    assert len(pm.replaced_folders(spark, index)) == 6
    assert {r.filename: r.content for r in pm.read_index(spark, index).collect()} == {**want, "b": "later"}


def test_index_lookup_reaches_the_scan(spark, folder):
    index = f"{folder}/index"
    pm.upsert_index(records(spark, [record("a", "2024-01"), record("b", "2024-01")]), index, "1")
    one = pm.read_index(spark, index, ["filename"], ("filename", "a"))
    assert [tuple(r) for r in one.collect()] == [("a",)]
    assert "EqualTo(filename,a)" in one._jdf.queryExecution().executedPlan().toString()


def test_archive_keeps_lines_together(spark, folder):
    rows = [("a", "one\ntwo\r\n\"quoted\"", "c"), ("b", "ñ\t\f", "")]
    df = spark.createDataFrame(rows, "path string, content string, classification string")
    target = pm.archive(df, folder, "run")
    assert all(n.endswith(".json.gz") for n in os.listdir(target) if n.startswith("part-"))
    assert sorted(map(tuple, pm.read_archive(spark, target).collect())) == rows


def test_no_task_writes_two_files_of_an_archive(spark):
    """Not even of one document in many parts."""
    rows = spark.range(4000).select(F.lit("p").alias("path"), F.sha2(F.col("id").cast("string"), 256).alias("content"), F.lit("c").alias("classification"))
    dealt = importlib.import_module("pagemill.sinks.archive")._dealt(rows, F.octet_length("content").cast("long"), 64 * 4000, 20)
    of_task = dealt.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("part").alias("parts"), F.count("part").alias("n")).collect()
    assert len(of_task) == 20 and {r.parts for r in of_task} == {1} and max(r.n for r in of_task) < 2 * 4000 / 20


def test_archive_files_are_of_equal_bytes(spark, folder):
    """Texts of a kilobyte and of a hundred: no file is twice as large as another, and nothing is lost."""
    long = (F.col("id") % 40 == 0).cast("int")
    df = spark.range(2000).select(
        F.concat(F.lit("p"), "id").alias("path"),
        F.expr("repeat(sha2(cast(id as string), 256), cast(case when id % 40 = 0 then 1600 else 16 end as int))").alias("content"),
        long.cast("string").alias("classification"),
    )
    target = pm.archive(df, folder, "run", max_bytes=1 << 20)
    got = pm.read_archive(spark, target)
    assert got.columns == ["path", "content", "classification"] and got.exceptAll(df).count() == 0 and got.count() == 2000
    sizes = [r.n for r in got.groupBy(F.input_file_name().alias("file")).agg(F.sum(F.length("content")).alias("n")).collect()]
    assert len(sizes) >= 6 and max(sizes) <= 2 * min(sizes)
    assert pm.read_archive(spark, pm.archive(df, folder, "one")).count() == 2000
    nothing = df.limit(0)
    assert pm.read_archive(spark, pm.archive(nothing, folder, "none")).count() == 0


def test_document_of_many_parts_ends_in_one_file(spark, folder):
    """Parts travel as rows; a document has one file, one record, and the category that any of its parts shows first."""
    rows = [("/in/big.pdf", k, f"page {k} " + ("hammer " if k == 91 else "") + ("apple" if k == 60 else "")) for k in range(1, 101)]
    rows += [("/in/sub/small.pdf", 1, "a hammer"), ("/in/none.pdf", 1, "nothing")]
    pages = spark.createDataFrame(rows, "path string, page_no int, page_text string").repartition(4)
    seen = []

    def by_parts(parts):
        seen.append(parts.columns)
        return pm.classify_parts(parts, [("fruit", "apple|pear"), ("tool", "hammer")])

    parts, archived = pm.ingest_pages(
        pages, f"{folder}/out", "r", RUN, by_parts, text_dir=f"{folder}/text", root="/in", pages_per_part=7
    )
    assert seen == [["path", "part_no", "content", "n_pages"]]
    assert parts.where("path = '/in/big.pdf'").count() == 15
    got = {r.filename: (r.classification, r.content[:8]) for r in pm.read_index(spark, f"{folder}/out/index").collect()}
    assert got == {"/in/big.pdf": ("fruit", "page 1 \n"), "/in/sub/small.pdf": ("tool", "a hammer")}
    whole = {r.path: r.content for r in pm.assemble_document(pages).collect()}
    for path, name in (("/in/big.pdf", "big.txt"), ("/in/sub/small.pdf", "sub/small.txt"), ("/in/none.pdf", "none.txt")):
        with open(f"{folder}/text/{name}", encoding="utf-8", newline="") as file:
            assert file.read() == whole[path]
    assert pm.read_archive(spark, archived).count() == 16


def test_null_text_has_no_file(spark, folder):
    df = spark.createDataFrame([("/a.pdf", "x"), ("/b.pdf", None)], "path string, content string")
    report = pm.write_text_files(df, f"{folder}/out", f"{folder}/report").collect()
    assert {r.path: r.n_bytes for r in report} == {"/a.pdf": 1, "/b.pdf": None}
    assert os.listdir(f"{folder}/out") == ["a.txt"]


def test_text_files_do_not_overwrite_each_other(spark, folder):
    df = classified(
        spark,
        [
            ("file:/in/a/x.pdf", "1"),
            ("file:/in/b/x.pdf", "2"),
            ("file:/in/b/X.PDF", "3"),
            ("file:/in/b/y", "ñ"),
            ("file:/in/b/x~2.pdf", "4"),
            ("file:/in/b/x.txt", "5"),
        ],
    )
    report = pm.write_text_files(df, f"{folder}/out", f"{folder}/report", root="file:/in").collect()
    hashed = {p: hashlib.sha256(p.encode()).hexdigest()[:16] for p in ("b/X.PDF", "b/y", "b/x~2.pdf", "b/x.txt")}
    assert sorted((r.output, r.n_bytes) for r in report) == sorted(
        [
            ("a/x.txt", 1),
            ("b/x.txt", 1),
            (f"b/x~{hashed['b/X.PDF']}.txt", 1),
            (f"b/y~{hashed['b/y']}", 2),
            (f"b/x~2~{hashed['b/x~2.pdf']}.txt", 1),
            (f"b/x~{hashed['b/x.txt']}.txt", 1),
        ]
    )
    found = {}
    for base, _, files in os.walk(f"{folder}/out"):
        for name in files:
            with open(os.path.join(base, name)) as f:
                found[os.path.relpath(os.path.join(base, name), f"{folder}/out")] = f.read()
    assert sorted(found.values()) == sorted("123ñ45")
    assert found["a/x.txt"] == "1"
    # A second run replaces the files.
    pm.write_text_files(classified(spark, [("file:/in/a/x.pdf", "new")]), f"{folder}/out", f"{folder}/report2", "/in")
    with open(f"{folder}/out/a/x.txt") as f:
        assert f.read() == "new"


def test_only_indexed_sources_are_removed(spark, folder):
    put(folder, {"in/a.pdf": "1", "in/b c.pdf": "2", "in/d.pdf": "3"})
    files = pm.write_texts(pm.scan_documents(spark, f"{folder}/in").select("path"), f"{folder}/seen", "1")
    index = files.where(~F.col("path").contains("d.pdf")).select(F.col("path").alias("filename"))
    listed = pm.remove_sources(files, index)
    assert listed.count() == 2 and not any(r.deleted for r in listed.collect())
    assert len(os.listdir(f"{folder}/in")) == 3
    with pytest.raises(ValueError):
        pm.remove_sources(files, index, dry_run=False)
    for _ in range(2):
        report = pm.remove_sources(files, index, f"{folder}/report", dry_run=False).collect()
        assert sorted(r.path.split("/")[-1] for r in report) == ["a.pdf", "b c.pdf"]
        assert all(r.deleted and r.error is None for r in report)
        assert os.listdir(f"{folder}/in") == ["d.pdf"]
    # What is not found was deleted only if an earlier try says so.
    unknown = pm.remove_sources(files, index, f"{folder}/other", dry_run=False).collect()
    assert not any(r.deleted for r in unknown) and all("FileNotFound" in r.error for r in unknown)


def rules(documents):
    cats = pm.classify_rules(documents, [("fruit", "apple|pear"), ("tool", "hammer")])
    return cats.select("path", "classification")


def test_batch_job(spark, folder):
    put(
        f"{folder}/in",
        {"a.pdf": "an apple\fmore", "sub/b.PDF": "a hammer", "c.pdf": "neither", "d.txt": "apple", "e.pdf": "broken"},
    )
    arguments = (spark, f"{folder}/in", f"{folder}/out", "r1", RUN, form_feed_engine(), rules)
    result = pm.ingest(*arguments, text_dir=f"{folder}/text")
    assert names(result.pages.distinct(), f"{folder}/in") == ["a.pdf", "a.pdf", "c.pdf", "sub/b.PDF"]
    got = {r.filename.split("/in/")[1]: r.classification for r in result.index.collect()}
    assert got == {"a.pdf": "fruit", "sub/b.PDF": "tool"}
    assert pm.read_archive(spark, result.archived).count() == 2
    assert not any(r.deleted for r in result.removed.collect())
    digest = hashlib.sha256(b"sub/b.PDF").hexdigest()[:16]
    with open(f"{folder}/text/sub/b~{digest}.txt") as f:
        assert f.read() == f"spa:a hammer{FOOTER_BEFORE}1{FOOTER_AFTER}"

    # The run may be repeated until it deletes sources.
    again = pm.ingest(*arguments, remove=True)
    assert again.index.count() == 2
    assert all(r.deleted for r in again.removed.collect())
    assert names(pm.scan_documents(spark, f"{folder}/in"), f"{folder}/in") == ["c.pdf", "d.txt", "e.pdf"]
    with pytest.raises(ValueError, match="new run_id"):
        pm.ingest(*arguments)


def test_stream_handles_each_file_once(spark, folder):
    put(f"{folder}/in", {"a.pdf": "an apple", "b.pdf": "a hammer\fpear", "x.pdf": "neither"})

    def run():
        query = pm.ingest_stream(
            spark,
            f"{folder}/in",
            f"{folder}/out",
            f"{folder}/checkpoint",
            lambda batch: RUN + timedelta(days=batch),
            lambda files: pm.extract_text_pages(pm.decode_documents(files)),
            rules,
            max_files=2,
            remove=True,
        )
        query.awaitTermination()
        pm.remove_ingested(spark, f"{folder}/out", query)
        return {
            r.filename.split("/in/")[1]: (r.classification, r.date[:10])
            for r in pm.read_index(spark, f"{folder}/out/index").collect()
        }

    first = run()
    assert {k: v[0] for k, v in first.items()} == {"a.pdf": "fruit", "b.pdf": "fruit"}
    assert os.listdir(f"{folder}/in") == ["x.pdf"]
    time.sleep(1)
    put(f"{folder}/in", {"c.pdf": "another pear"})
    second = run()
    assert {k: v for k, v in second.items() if k != "c.pdf"} == first
    assert second["c.pdf"][0] == "fruit"
    assert os.listdir(f"{folder}/in") == ["x.pdf"]


def test_stream_holds_lists_and_no_files(spark, folder):
    put(f"{folder}/in", {f"sub/{i}.pdf": "an apple" for i in range(5)})
    for i in range(5):
        os.utime(f"{folder}/in/sub/{i}.pdf", (1_700_000_000 + i, 1_700_000_000 + i))
    seen = []

    def extractor(files):
        seen.append(sorted(names(files, f"{folder}/in")))
        return pm.extract_text_pages(pm.decode_documents(files))

    def run():
        query = pm.ingest_stream(
            spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", lambda batch: RUN, extractor, rules, max_files=2
        )
        query.awaitTermination()

    run()
    put(f"{folder}/in", {"late.pdf": "a pear"})
    run()
    run()
    assert seen == [["sub/0.pdf", "sub/1.pdf"], ["sub/2.pdf", "sub/3.pdf"], ["sub/4.pdf"], ["late.pdf"]]
    log = glob.glob(f"{folder}/checkpoint/sources/**/*", recursive=True)
    assert log and not any(".pdf" in open(f, errors="replace").read() for f in log if os.path.isfile(f))


def test_overlapping_folders_hold_each_document_once(spark, folder):
    put(folder, {"in/sub/a.pdf": "an apple\fmore"})
    roots = [f"{folder}/in", f"{folder}/in/sub"]
    result = pm.ingest(spark, roots, f"{folder}/out", "r", RUN, form_feed_engine(), rules)
    assert [(r.page_no, r.page_text) for r in result.pages.orderBy("page_no").collect()] == [
        (1, "spa:an apple"),
        (2, "spa:more"),
    ]
    assert result.documents.count() == result.index.count() == 1


def test_ranges_of_one_document_go_to_many_tasks(spark):
    ranges = pm.plan_page_batches(spark.createDataFrame([("p", 500)], "path string, n_pages int"), 5)
    pages = pm.extract_pages(ranges, form_feed_engine())
    tasks = pages.select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks > 8


def test_small_ranges_make_no_more_tasks(spark, folder, monkeypatch):
    put(folder, {"in/a.pdf": "\f".join(["an apple"] * 400)})
    module, asked = importlib.import_module("pagemill.plans.ingest"), []
    extract = module.extract_pages
    monkeypatch.setattr(module, "extract_pages", lambda *a: asked.append(a[-1]) or extract(*a))
    result = pm.ingest(spark, f"{folder}/in", f"{folder}/out", "r", RUN, form_feed_engine(), rules, max_pages=1, ranges_per_task=1)
    assert result.pages.count() == 400 and asked == [spark.sparkContext.defaultParallelism]


def test_empty_folder(spark, folder):
    os.makedirs(f"{folder}/in")
    put(folder, {"in/readme.txt": "not a document"})
    result = pm.ingest(
        spark, f"{folder}/in", f"{folder}/out", "r", RUN, form_feed_engine(), rules, remove=True
    )
    assert result.pages.count() == result.index.count() == result.removed.count() == 0
    assert os.listdir(f"{folder}/in") == ["readme.txt"]


def test_stream_survives_a_failed_batch(spark, folder):
    put(f"{folder}/in", {f"{i}.pdf": "an apple" for i in range(4)})

    def run(classifier):
        query = pm.ingest_stream(
            spark,
            f"{folder}/in",
            f"{folder}/out",
            f"{folder}/checkpoint",
            lambda batch: RUN,
            lambda files: pm.extract_text_pages(pm.decode_documents(files)),
            classifier,
            max_files=2,
            remove=True,
        )
        try:
            query.awaitTermination()
        except Exception:
            assert query.exception() is not None
            with pytest.raises(ValueError):
                pm.remove_ingested(spark, f"{folder}/out", query)
            return
        pm.remove_ingested(spark, f"{folder}/out", query)

    calls = []

    def fails_in_second_batch(documents):
        calls.append(1)
        if len(calls) > 2:
            raise RuntimeError("no classifier")
        return rules(documents)

    run(fails_in_second_batch)
    # The first batch is through and its sources went when the second began; those of the second are still there.
    assert len(os.listdir(f"{folder}/in")) == 2
    run(rules)
    assert os.listdir(f"{folder}/in") == []
    assert pm.read_index(spark, f"{folder}/out/index").count() == 4
    assert spark.read.parquet(f"{folder}/out/texts").count() == 4


def test_storage_places():
    from pyarrow import fs

    from pagemill.functions.storage import resolver

    resolve = resolver("file:///")
    assert resolve("file:/a/b c.pdf")[1] == resolve("file:///a/b c.pdf")[1] == resolve("/a/b c.pdf")[1] == "/a/b c.pdf"
    # A path without a scheme lies on the default file system.
    asked = []
    original = fs.FileSystem.from_uri
    try:
        fs_class = type("Fake", (), {"from_uri": staticmethod(lambda uri: asked.append(uri) or ("system", "/"))})
        fs.FileSystem, kept = fs_class, fs.FileSystem
        assert resolver("hdfs://name:9000")("/out/a") == ("system", "/out/a")
    finally:
        fs.FileSystem = kept
    assert asked == ["hdfs://name:9000/"] and fs.FileSystem.from_uri == original


def test_sources_with_lost_pages_survive(spark, folder):
    put(f"{folder}/in", {"good.pdf": "an apple\fmore", "lost.pdf": "apple\funrenderable\fpear", "bad.pdf": "broken"})
    arguments = (spark, f"{folder}/in", f"{folder}/out", "r", RUN, form_feed_engine(), rules)
    result = pm.ingest(*arguments, max_pages=1, remove=True)
    assert sorted(os.listdir(f"{folder}/in")) == ["bad.pdf", "lost.pdf"]
    failed = {(r.path.split("/")[-1], r.page_no) for r in result.failed.collect()}
    assert failed == {("bad.pdf", None), ("lost.pdf", 2)}
    assert names(result.pages.select("path").distinct(), f"{folder}/in") == ["good.pdf", "lost.pdf"]


def test_part_files_share_a_file_for_each_task(spark, folder, monkeypatch):
    """Parts of many documents lie in one file, and are found there again: in order, over several files, with any buffer."""
    import os

    from pagemill.sinks import texts

    monkeypatch.setattr(texts, "_OPEN_FILES", 2)
    rows = [(f"hdfs:/in/d{k % 3}/f{k}.pdf", p, f"{k}ä{p}" * (k * p % 5)) for k in range(40) for p in range(1 + k % 4)]
    rows += [("hdfs:/in/none.pdf", 0, None), ("hdfs:/in/d0/f1.pdf", 1, None), ("hdfs:/in/empty.pdf", 0, "")]
    parts = spark.createDataFrame(rows, "path string, part_no int, content string").repartition(5)
    for buffer in (1, 7, 1 << 20):
        out = f"{folder}/out-{buffer}"
        report = {r["path"]: r for r in pm.write_part_files(parts, out, f"{out}-report", root="/in", buffer=buffer).collect()}
        want = {}
        for path, _, content in sorted((r for r in rows if r[2] is not None), key=lambda r: r[:2]):
            want[path] = want.get(path, "") + content
        assert {p: r["n_bytes"] for p, r in report.items()} == {p: len(t.encode()) for p, t in want.items()}
        for path, text in want.items():
            with open(f"{out}/{report[path]['output']}", encoding="utf-8") as file:
                assert file.read() == text
        (held,) = [f for f in os.listdir(out) if f.startswith(".parts-")]
        assert 1 <= len([f for f in os.listdir(f"{out}/{held}") if not f.startswith(".")]) <= 5
