"""The pipeline's stages, and that queries cover their contracts' columns."""

from helpers import OTHER, PROSE, no_documents, odd_documents, with_clash, write_tables
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from pagemill.llm import simhash

LABELS = "doc_id long, quality int, toxic int"


def test_every_operator_is_registered():
    names = entry_point.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert names["pipeline"] is corpus_pipeline.run
    assert [k for k, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "near-duplicates", "personal data", "packing"]


def test_stages_keep_the_columns_of_their_input(spark, folder):
    docs = with_clash(odd_documents(spark), "score", "kept", "fp", "n_surrogates", "text_crc32")
    sf_dir = write_tables(f"{folder}-t", docs, labels=spark.createDataFrame([(1, 1, 0), (6, 1, 1), (7, None, 1)], LABELS))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert {r["kept"] for r in out.collect()} <= {"own"}
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() >= docs.count()


def test_run(spark, folder):
    """Clean documents pass, copies and junk go, personal data is replaced, all tokens are packed."""
    rows = [(k, f"{PROSE} Number{k} {OTHER if k % 2 else ''} " + " ".join(f"w{k}x{j}" for j in range(40)), "en", "a", 1) for k in range(40)]
    rows.append((100, rows[3][1], "en", "b", 1))
    rows.append((101, " ".join(w + "###" for w in OTHER.split()), "en", "a", 1))
    rows.append((102, rows[5][1].replace("Number5", "mail ann@mail.example.com"), "en", "a", 1))
    docs = spark.createDataFrame(rows, odd_documents(spark).schema)
    sf_dir = write_tables(f"{folder}-t", docs, labels=spark.createDataFrame([], LABELS))
    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).collect()}
    clean = {r["component_id"] for r in simhash.near_duplicates(docs.where("doc_id <> 101")).collect()}
    assert kept == clean and 100 not in kept and 101 not in kept
    replaced = corpus_pipeline.replace_personal_data(spark, docs, sf_dir).where("doc_id = 102").first()
    assert "ann@mail" not in replaced["text"] and replaced["n_chars"] == len(replaced["text"])
    assert corpus_pipeline.run(spark, write_tables(f"{folder}-e", no_documents(spark), labels=spark.createDataFrame([], LABELS))).count() == 0
    assert docs.where(F.col("doc_id") == 100).count() == 1
