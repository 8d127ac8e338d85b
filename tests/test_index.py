"""The index: snapshots, writers at the same time, buckets, and search by content."""

import math
import os
import re
import threading
from collections import Counter

import pytest
from pyspark.sql import functions as F

import pagemill as pm
from pagemill.functions import snapshots, storage
from pagemill.sources.index import LOG, entries


def records(spark, *rows):
    rows = [(name, "c", "2024", text) for name, text in rows]
    return spark.createDataFrame(rows, "filename string, classification string, date string, content string")


def contents(spark, index):
    rows = pm.read_index(spark, index, ["filename", "content"]).collect()
    assert len(rows) == len({r.filename for r in rows})
    return {r.filename: r.content for r in rows}


def test_late_record_after_a_compaction_appears(spark, folder):
    index = f"{folder}/index"
    pm.upsert_index(records(spark, ("a", "ten")), index, "1", sequence=10)
    pm.upsert_index(records(spark, ("a", "eleven")), index, "2", sequence=11)
    pm.compact_index(spark, index)
    pm.upsert_index(records(spark, ("a", "nine"), ("b", "nine")), index, "3", sequence=9)
    assert contents(spark, index) == {"a": "eleven", "b": "nine"}
    pm.compact_index(spark, index)
    assert contents(spark, index) == {"a": "eleven", "b": "nine"}


def test_equal_sequences_give_one_record(spark, folder):
    index = f"{folder}/index"
    for batch in ("y", "z", "x"):
        pm.upsert_index(records(spark, ("a", batch), (f"own-{batch}", batch)), index, batch, sequence=5)
    want = {"a": "z", "own-x": "x", "own-y": "y", "own-z": "z"}
    assert contents(spark, index) == want
    pm.compact_index(spark, index)
    pm.upsert_index(records(spark, ("a", "w")), index, "w", sequence=5)
    assert contents(spark, index) == want


def test_repeated_batch_replaces_itself(spark, folder):
    index = f"{folder}/index"
    pm.upsert_index(records(spark, ("a", "half"), ("b", "half")), index, "1", sequence=5)
    pm.upsert_index(records(spark, ("a", "whole")), index, "1", sequence=5)
    assert contents(spark, index) == {"a": "whole"}
    assert sorted(r.filename for r in pm.batch_records(spark, index, "1").collect()) == ["a"]
    pm.compact_index(spark, index)
    pm.upsert_index(records(spark, ("a", "again")), index, "1", sequence=5)
    assert contents(spark, index) == {"a": "again"}


def test_writers_at_the_same_time_lose_nothing(spark, folder):
    index = f"{folder}/index"
    pm.upsert_index(records(spark, ("first", "x")), index, "first")
    errors = []

    def run(work):
        try:
            work()
        except Exception as e:
            errors.append(e)

    def upsert(k):
        return lambda: pm.upsert_index(records(spark, (f"own{k}", str(k)), ("shared", str(k))), index, f"b{k}", sequence=100 + k)

    jobs = [upsert(k) for k in range(6)]
    jobs[2:2] = [lambda: pm.compact_index(spark, index)] * 2
    threads = [threading.Thread(target=run, args=(j,)) for j in jobs]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    want = {"first": "x", "shared": "5"} | {f"own{k}": str(k) for k in range(6)}
    assert contents(spark, index) == want
    pm.compact_index(spark, index)
    assert contents(spark, index) == want
    _, state = snapshots.last_state(spark, f"{index}/{LOG}")
    assert [e.batch for e in entries(state)] == [None]
    assert len(pm.replaced_folders(spark, index)) >= 7


def test_compaction_while_a_batch_is_repeated(spark, folder, monkeypatch):
    """A batch that replaces itself between a compaction's reading and its commit still counts."""
    from pagemill.sinks import index as sink

    index = f"{folder}/index"
    pm.upsert_index(records(spark, ("a", "old"), ("gone", "old")), index, "1", sequence=5)
    pm.upsert_index(records(spark, ("b", "old")), index, "2", sequence=6)
    write = sink._write

    def slow(rows, at, kind, name, buckets):
        write(rows, at, kind, name, buckets)
        if name.startswith("0-"):
            monkeypatch.setattr(sink, "_write", write)
            pm.upsert_index(records(spark, ("a", "new")), index, "1", sequence=5)
            pm.upsert_index(records(spark, ("c", "new")), index, "3", sequence=1)

    monkeypatch.setattr(sink, "_write", slow)
    assert len(pm.compact_index(spark, index)) == 2
    # what only the folded form of the batch held stays: it was in the index when it was folded
    assert contents(spark, index) == {"a": "new", "b": "old", "c": "new", "gone": "old"}


def test_only_one_writer_gets_a_version(spark, folder):
    place = f"{folder}/log/1.json"
    got = []
    threads = [threading.Thread(target=lambda k=k: got.append((storage.create_new(spark, place, str(k)), k))) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    winners = [k for done, k in got if done]
    assert len(winners) == 1 and storage.read_text(spark, place) == str(winners[0])
    assert storage.list_files(spark, f"{folder}/log") == ["1.json"] and storage.list_files(spark, f"{folder}/none") == []
    assert storage.create_new(spark, f"file:{folder}/log/2.json", "ü") and storage.read_text(spark, f"{folder}/log/2.json") == "ü"
    assert not snapshots.commit(spark, f"{folder}/log2", lambda state: None)
    assert snapshots.last_state(spark, f"{folder}/log2") == (0, {})


def test_index_without_records(spark, folder):
    index = f"{folder}/index"
    assert pm.read_index(spark, index).count() == 0 and pm.compact_index(spark, index) == []
    pm.upsert_index(records(spark).limit(0), index, "1", searchable=True)
    assert pm.read_index(spark, index).count() == 0
    assert pm.search_index(spark, index, "word").count() == 0
    with pytest.raises(ValueError, match="begun"):
        pm.upsert_index(records(spark), index, "2", searchable=False)
    plain = f"{folder}/plain"
    pm.upsert_index(records(spark, ("a", None)), plain, "1")
    assert contents(spark, plain) == {"a": None}
    with pytest.raises(ValueError, match="searchable"):
        pm.search_index(spark, plain, "word")


def test_merging_needs_no_shuffle_and_lookups_few_files(spark, folder):
    index = f"{folder}/index"
    rows = spark.range(2000).select(
        F.concat(F.lit("f"), "id").alias("filename"), F.lit("c").alias("classification"), F.lit("d").alias("date"), F.lit("x").alias("content")
    )
    for k in range(3):
        pm.upsert_index(rows.where(F.col("filename") != f"f{k}").withColumn("content", F.lit(str(k))), index, f"b{k}", buckets=8)
    whole = pm.read_index(spark, index)
    assert "Exchange" not in whole._jdf.queryExecution().executedPlan().toString()
    assert Counter(r.content for r in whole.collect()) == {"2": 1999, "1": 1}
    one = pm.read_index(spark, index, match=("filename", "f7"))
    assert [r.content for r in one.collect()] == ["2"]
    assert "EqualTo(filename,f7)" in one._jdf.queryExecution().executedPlan().toString()
    pm.compact_index(spark, index)
    assert contents(spark, index)["f2"] == "1"
    # a lookup does not open the files of other buckets
    one = pm.read_index(spark, index, match=("filename", "f7"))
    _, state = snapshots.last_state(spark, f"{index}/{LOG}")
    place = f"{index}/records/{entries(state)[0].folder}"
    found = spark.read.parquet(place).where("filename = 'f7'").select("_metadata.file_name").first()[0]
    others = [n for n in os.listdir(place) if n.endswith(".parquet") and not n.startswith(".") and n != found]
    assert len(others) == 7
    for name in others:
        with open(f"{place}/{name}", "wb") as file:
            file.write(b"not a table")
    assert [r.content for r in one.collect()] == ["2"]


TEXTS = {
    "a": "The red fox and the red hen",
    "b": "red, red, RED hen! the fox",
    "c": "a fox; no bird 42",
    "d": "",
    "e": None,
    "f": "the the the the the the the the the the",
    "g": "Äpfel und größe äpfel",
}


def brute_search(texts, query, how):
    split = {k: re.findall(r"[^\W_]+", (t or "").lower()) for k, t in texts.items()}
    mean = sum(map(len, split.values())) / len(split)
    wanted = re.findall(r"[^\W_]+", query.lower())
    out = {}
    for name, words in split.items():
        found = sorted({w for w in wanted if w in words})
        if not found or how != "any" and len(found) < len(set(wanted)):
            continue
        if how == "phrase" and not any(words[k : k + len(wanted)] == wanted for k in range(len(words))):
            continue
        score = 0.0
        for w in found:
            held, n = sum(w in x for x in split.values()), words.count(w)
            score += math.log(1 + (len(split) - held + 0.5) / (held + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(words) / mean))
        out[name] = (len(found), round(score, 9))
    return out


@pytest.mark.parametrize("compacted", [False, True])
def test_search_matches_brute_force(spark, folder, compacted):
    index = f"{folder}/index"
    pm.upsert_index(records(spark, *((k, "fox hen bird 42 stale") for k in "abcx")), index, "0", searchable=True, buckets=4)
    pm.upsert_index(records(spark, *TEXTS.items(), ("x", "the hen")), index, "1")
    if compacted:
        pm.compact_index(spark, index)
    texts = {**TEXTS, "x": "the hen"}
    queries = ["red hen", "the red", "red red", "the the the", "fox 42 none", "ÄPFEL", "stale", "", "!?", "hen the fox"]
    df = spark.createDataFrame(list(enumerate(queries)), "query_id int, query string")
    for how in ("any", "all", "phrase"):
        got = {}
        for r in pm.search_index(spark, index, df, how).collect():
            got.setdefault(r.query_id, {})[r.filename] = (r.n_terms_found, round(r.score, 9))
        assert got == {k: w for k, q in enumerate(queries) if (w := brute_search(texts, q, how))}, how
    best = pm.search_index(spark, index, "red fox", limit=1).collect()
    want = brute_search(texts, "red fox", "any")
    assert [r.filename for r in best] == [min(want, key=lambda k: (-want[k][1], k))]
    with pytest.raises(ValueError, match="unknown"):
        pm.search_index(spark, index, "red", "some")


def test_search_reads_the_buckets_of_its_terms(spark, folder):
    index = f"{folder}/index"
    pm.upsert_index(records(spark, *((f"f{k}", f"w{k} common") for k in range(200))), index, "0", searchable=True, buckets=8)
    found = pm.search_index(spark, index, "w7")
    assert [r.filename for r in found.collect()] == ["f7"]


def test_answers_to_a_search_are_not_shuffled(spark, folder, monkeypatch):
    """They are as many as queries times records; the number of tasks grows with them and changes nothing."""
    docs = spark.range(60).select(
        F.concat(F.lit("p"), "id").alias("filename"), F.lit("c").alias("classification"), F.lit("2024-01-01").alias("date"),
        F.expr("concat('all of them ', repeat('some ', cast(id % 3 as int)), id % 7)").alias("content"),
    )
    pm.upsert_index(docs, folder, "a", searchable=True, buckets=2)
    queries = spark.createDataFrame([(1, "all some"), (2, "3 of"), (3, "none"), (4, "them them")], "query_id int, query string")
    found = pm.search_index(spark, folder, queries)
    want = sorted(map(tuple, found.collect()))
    assert len(want) == 180
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(query_id#\d+, filename", plan)
    monkeypatch.setattr("pagemill.sources.index._ANSWERS", 7)
    assert sorted(map(tuple, pm.search_index(spark, folder, queries).collect())) == want


@pytest.mark.parametrize("how", ["all", "phrase"])
def test_queries_of_all_terms_are_tried_on_their_rarest(spark, folder, how):
    """Frequent terms make no row for each query and record; terms that are nowhere, that come twice or alone change nothing."""
    texts = {f"f{k}": f"all of them {'some ' * (k % 3)}{k % 7} the end of all" for k in range(40)}
    pm.upsert_index(records(spark, *texts.items()), folder, "a", searchable=True, buckets=2)
    asked = ["all of them 3", "of them", "of", "none of them", "the end of all", "all all", "them some some", "some 5", "end the", ""]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id int, query string")
    found = pm.search_index(spark, folder, queries.union(queries.where("query_id = 1")), how)
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, {})[r.filename] = (r.n_terms_found, round(r.score, 9))
    assert got == {k: w for k, q in enumerate(asked) if (w := brute_search(texts, q, how))}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Aggregate \[query_id#\d+, filename", plan)


def test_records_of_a_repeated_batch_do_not_fail_a_search(spark, folder):
    for _ in range(2):  # once folded, once beside it
        pm.upsert_index(records(spark, ("a", "red hen"), ("b", "red fox")), folder, "0", sequence=1, searchable=True, buckets=2)
        if _ == 0:
            pm.compact_index(spark, folder)
            pm.upsert_index(records(spark, ("c", "red hen")), folder, "1", sequence=2)
    for how in ("all", "phrase"):
        assert "c" in {r.filename for r in pm.search_index(spark, folder, "red hen", how).collect()}
