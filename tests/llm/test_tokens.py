"""Token counts, the BPE codec and packing against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from helpers import PROSE, no_documents, odd_documents, with_clash, write_tables
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pagemill.llm import alignment, bpe, packing, queries, token_counts, toxicity

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}
ODD_TEXTS = st.lists(
    st.sampled_from([*"abcdefgh ABCÀİΣ '\n\t\r.,;!?#%0123456789²½éßñ漢😀\x1c\x1d\x85\xa0\u3000\u0301", "<|endoftext|>", "'ll", " the", "  "]),
    max_size=60,
).map("".join)


def ids(path, text):
    return LIBRARY[path].encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(ODD_TEXTS)
def test_codec_is_exact(text):
    codec = bpe.codec(BYTE)
    want = ids(BYTE, text)
    assert codec.encode(text).tolist() == want
    assert codec.decode(np.array(want, np.int64)) == LIBRARY[BYTE].decode(want, skip_special_tokens=False) == text
    assert token_counts.count_text(text, BYTE) == (len(want), 0)
    assert token_counts.count_text(text, BYTE, 7, 2)[0] == len(want)


@settings(max_examples=300, deadline=None)
@given(ODD_TEXTS)
def test_words_are_tokenized_one_by_one(text):
    assert np.frombuffer(packing.document_ids(text, WORD), "<u4").tolist() == ids(WORD, text)


def test_long_runs_without_white_space():
    random_ = random.Random(3)
    for text in ("a" * 20_000, "".join(random_.choice("abcdxyz") for _ in range(20_000)), "1" * 5_000, "=-" * 4_000):
        assert bpe.codec(BYTE).encode(text).tolist() == ids(BYTE, text)


def test_copies_of_a_long_text_are_encoded_once(spark, monkeypatch):
    taken, long_counts = [], token_counts._long_counts

    def spy(texts, *args):
        taken.append(texts.count())
        return long_counts(texts, *args)

    monkeypatch.setattr(token_counts, "_long_counts", spy)
    texts = [f"{'some words of a text ' * 60}{k}" for k in range(2)]
    docs = spark.createDataFrame([(k, texts[k % 10 == 0]) for k in range(40)], "doc_id long, text string")
    got = token_counts.count_tokens(docs, BYTE, chunk_chars=600, overlap=16, spread_chars=600).collect()
    assert taken[0] == 2
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got) == [(k, len(ids(BYTE, texts[k % 10 == 0]))) for k in range(40)]


def test_all_tokens_are_their_own_encoding():
    codec = bpe.codec(BYTE)
    assert len(codec.ids) == LIBRARY[BYTE].get_vocab_size() - 1
    for data, token in list(codec.ids.items())[::97]:
        assert codec.encode_bytes(data) == [token]


def test_decode_column(spark):
    path = BYTE
    encoded = bpe.encode_documents(odd_documents(spark).select("text"), path)
    for row in bpe.decode_documents(encoded, path).collect():
        assert row["ids"] == ids(BYTE, row["text"])
        assert row["decoded"] == (row["text"] or "")


def test_splice_widens_until_a_boundary_is_common(spark):
    texts = [PROSE * 60, "x" * 3_000 + " " + PROSE * 5 + "y" * 5_000, "é漢 " * 2_000, " " * 4_000, "a\x1cb " * 1_500, "word " * 7 + "z" * 700]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(9, texts[0])], "doc_id long, text string")
    got = token_counts.count_tokens(docs, BYTE, chunk_chars=600, overlap=16, spread_chars=600).collect()
    inside = token_counts.count_tokens(docs, BYTE, chunk_chars=600, overlap=16).collect()
    assert len(got) == len(inside) == 7
    for row in got:
        assert row["n_tokens"] == len(ids(BYTE, row["text"])), row["doc_id"]
    # the same splices, whether chunks are rows or not, but for texts that have no common boundary at all
    counts = [{r["doc_id"]: (r["n_tokens"], r["n_splices"]) for r in rows} for rows in (got, inside)]
    assert counts[0][0] == counts[1][0] and counts[0][0][1] == -(-len(texts[0]) // 600) - 1
    assert {k: v[0] for k, v in counts[0].items()} == {k: v[0] for k, v in counts[1].items()}


def test_given_documents_are_spliced(spark):
    """Texts above a chunk go through chunks; their counts are the library's."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = token_counts.count_tokens(docs, BYTE).collect()
    assert all(r["n_tokens"] == len(ids(BYTE, r["text"])) for r in rows)
    for r in rows:
        assert (r["n_splices"] > 0) == (len(r["text"] or "") > token_counts.CHUNK_CHARS)
    assert sum(r["n_splices"] > 0 for r in rows) >= 20


def test_op3_and_op5(spark, folder):
    docs = odd_documents(spark)
    sf_dir = write_tables(f"{folder}-t", docs)
    want = sorted(
        ((r["doc_id"], len((r["text"] or "").encode()), len(ids(BYTE, r["text"])), len(ids(BYTE, r["text"])) > 512) for r in docs.collect()),
        key=str,
    )
    got = queries.op3_token_counts(spark, sf_dir)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, got.collect()), key=str) == want

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = sorted(((r["doc_id"], len(ids(BYTE, r["text"])), digest(",".join(map(str, ids(BYTE, r["text"])))), digest(r["text"] or "")) for r in docs.collect()), key=str)
    assert sorted(map(tuple, queries.op5_bpe(spark, sf_dir).collect()), key=str) == want


def test_clashing_columns_and_empty_tables(spark):
    docs = with_clash(odd_documents(spark), "n_tokens", "over_limit", "ids", "key", "k", "_key", "of_key", "whole", "own1", "made", "_round_trip")
    assert {r["_round_trip"] + r["made"] + r["own1"] for r in bpe.round_trip(docs, BYTE).collect()} == {"ownownown"}
    counted = token_counts.count_tokens(docs, BYTE, chunk_chars=500, spread_chars=1000)
    assert counted.count() == docs.count() and dict(counted.dtypes)["n_tokens"] == "bigint"
    assert {r["key"] for r in counted.collect()} == {"own"}
    assert token_counts.count_tokens(no_documents(spark), BYTE).count() == 0
    assert bpe.round_trip(no_documents(spark), BYTE).count() == 0
    assert packing.pack(no_documents(spark), WORD).count() == 0


def check_packed(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_op7(spark, folder):
    docs = odd_documents(spark)
    rows = queries.op7_packing(spark, write_tables(f"{folder}-t", docs)).collect()
    want = []
    for r in docs.collect():
        data = np.array([*ids(WORD, r["text"]), 1], "<u4")
        for k, at in enumerate(range(0, len(data), 4096)):
            part = data[at : at + 4096]
            want.append((r["doc_id"], k, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=str) == sorted(want, key=str)
    n = check_packed(rows, 4096)
    assert n == -(-sum(w[3] for w in want) // 4096)


def fewest(lengths, capacity):
    """Fewest sequences by search, for a handful of pieces."""
    best = len(lengths)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(lengths):
            best = len(rooms)
            return
        for at in range(len(rooms)):
            if rooms[at] >= lengths[k] and rooms[at] not in rooms[:at]:
                place(k + 1, [*rooms[:at], rooms[at] - lengths[k], *rooms[at + 1 :]])
        place(k + 1, [*rooms, capacity - lengths[k]])

    place(0, [])
    return best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_reduction_keeps_an_optimum(lengths):
    counts = {w: lengths.count(w) for w in lengths}
    plan = packing._Plan(dict(counts))
    packing.reduce_dominated(plan, 20)
    rest = sorted((w for w, n in plan.open.items() for _ in range(n)), reverse=True)
    assert plan.sequences + fewest(rest, 20) == fewest(sorted(lengths, reverse=True), 20)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=30))
def test_ranges_place_each_piece_once(counts):
    ranges, sequences = packing.pack_lengths(counts, 64)
    numbers, rows = {}, []
    for length, first, count, sequence, offset in ranges:
        numbers.setdefault(length, []).extend(range(first, first + count))
        rows += [{"sequence_id": sequence + k, "offset": offset, "length": length} for k in range(count)]
    assert {w: sorted(n) for w, n in numbers.items()} == {w: list(range(n)) for w, n in counts.items()}
    assert check_packed(rows, 64) == sequences
    assert sequences <= 2 * sum(w * n for w, n in counts.items()) / 64 + 1  # two sequences at most half full would be one


@pytest.mark.parametrize("text", ["no cut here", "two  spaces", "\nstart", "end \n"])
def test_segments_join_to_the_text(text):
    from pagemill.llm.segments import segments

    assert "".join(segments(text)) == text


def _kept_by_workers(spark):
    """Results that the Python processes of a session hold between tasks, and whether the library may use threads in them."""

    def look(batches):
        import gc
        import os

        from pagemill.llm.segments import Memo

        for _ in batches:
            pass
        kept = sum(len(m.young) + len(m.old) for m in gc.get_objects() if type(m) is Memo)
        yield pd.DataFrame({"kept": [kept], "threads": [os.environ.get("TOKENIZERS_PARALLELISM", "")]})

    return spark.range(0, 64, 1, 64).mapInPandas(look, "kept long, threads string").collect()


@pytest.mark.parametrize(
    "work",
    [
        lambda docs: token_counts.count_tokens(docs, BYTE),
        lambda docs: token_counts.count_tokens(docs, BYTE, spread_chars=100),
        lambda docs: packing.pack(docs, WORD),
        lambda docs: bpe.round_trip(docs, BYTE),
        lambda docs: bpe.encode_documents(docs, BYTE),
        lambda docs: alignment.aligned(docs, BYTE, public_tokenizers.path("piece_bpe_32k.model")),
        lambda docs: toxicity.featured(docs, {0: {"boats": 1.0}}),
    ],
    ids=["counts", "long counts", "packing", "round trip", "encoding", "alignment", "toxicity"],
)
def test_workers_keep_no_results_between_tasks(spark, work):
    work(odd_documents(spark).repartition(8)).collect()
    assert {r["kept"] for r in _kept_by_workers(spark)} == {0}


def test_tasks_encode_in_their_own_thread(spark):
    token_counts.count_tokens(odd_documents(spark).repartition(8), BYTE).collect()
    assert "false" in {r["threads"] for r in _kept_by_workers(spark)}
