"""Spelling variants, aligned tokenizers and the language model against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from helpers import OTHER, PROSE, no_documents, odd_documents, with_clash, write_tables

from pagemill.llm import alignment, language_model, queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def edited(word, alphabet):
    """All words one edit away."""
    out = set()
    for k in range(len(word) + 1):
        out |= {word[:k] + c + word[k:] for c in alphabet}
        if k < len(word):
            out.add(word[:k] + word[k + 1 :])
            out |= {word[:k] + c + word[k + 1 :] for c in alphabet}
    return out - {word}


def brute_variants(docs):
    counts = Counter()
    for r in docs:
        for run in RUN.findall(r["text"] or ""):
            run = run.translate(CAPITALS)
            h = zlib.crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    alphabet = {c for w in counts for c in w}
    near = {w: sorted(edited(w, alphabet) & counts.keys()) for w in counts} if sum(map(len, counts)) < 2e5 else None
    form = {}
    for w, found in near.items():
        best = max(found, key=lambda t: (counts[t], [-ord(c) for c in t]), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=str)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def variant_rows(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_op11(spark, folder):
    """Chains of forms, ties, letters beyond ASCII, runs of one letter, nested words, long words."""
    base = "abcdefgh abcdefg abcdefghi bbcdefgh abcdefhg aaaaaaaa aaaaaaa aaaaaaaaa Aaaaaaab ÄÀÿöüßé äàÿöüßé çàÿöüßé Zähleräte zähleräten".split()
    texts = [" ".join([w] * (1 if k % 3 else 40)) for k, w in enumerate(base)] + [" ".join(base * 2)] * 3
    texts += [("lettersss " * 300), "letterss " * 29 + "letterss", "letters " * 2, "numberéd " * 500, "numberxd " * 40, "numberzd " * 40, "numberd " * 3, "x" * 3000 + " " + "x" * 3000 + " " + "x" * 2999 + "y " + "x" * 2999 + "y"]
    docs = odd_documents(spark).unionByName(
        spark.createDataFrame([(100 + k, t, "en", "a", 1) for k, t in enumerate(texts)], odd_documents(spark).schema)
    )
    got = queries.op11_spelling(spark, write_tables(f"{folder}-t", with_clash(docs, "word", "n", "id", "node")))
    assert got.columns == list(COLUMNS)
    want = brute_variants(docs.collect())
    assert variant_rows(got) == want
    forms = [r for r in want if r[1] is not None]
    assert len(forms) > 3 and any(r[2] != r[1] for r in forms) and any(r[4] > 1 for r in forms)
    assert queries.op11_spelling(spark, write_tables(f"{folder}-e", no_documents(spark))).count() == 0


def test_neighbours_of_given_documents(spark):
    """All pairs of the words of a given table, from a set of all their edits."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = spelling.count_words(docs)
    counts = {r["word"]: r["n"] for r in words.collect()}
    alphabet = {c for w in counts for c in w}
    want = {(w, t) for w in counts for t in edited(w, alphabet) & counts.keys()}
    got = spelling.neighbours(words).collect()
    assert len(want) > 100 and len(got) == len(want) and {tuple(r) for r in got} == want


def test_nodes_of_equal_prefixes_are_equal():
    nodes, starts = spelling.prefix_nodes(["", "abc", "abd", "b"], 0)
    a, b = nodes[starts[1] : starts[2]], nodes[starts[2] : starts[3]]
    assert starts.tolist() == [0, 1, 5, 9, 11] and (a[:3] == b[:3]).all() and a[3] != b[3] and nodes[0] == a[0] and nodes[10] != a[1]
    assert not set(nodes[starts[1] : starts[2]]) & set(spelling.prefix_nodes(["abc"], 1)[0])


A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def brute_alignment(rows):
    """Whole texts by the libraries, links from all pairs of tokens."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    back = {c: bytes([k]) for c, k in alignment.byte_alphabet().items()}
    docs, counts = [], Counter()
    for name, text in rows:
        of_a = [(i, b"".join(back[c] for c in a.id_to_token(i))) for i in (a.encode(" " + text, add_special_tokens=False).ids if text else [])]
        of_b = []
        for i in b.encode(text or ""):
            piece = b.id_to_piece(i)
            of_b.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("\u2581", " ").encode()))
        whole = (" " + (text or "")).encode()
        if not text or b"".join(x for _, x in of_a) != whole or b"".join(x for _, x in of_b) != whole:
            of_a, of_b = [], []
        spans = []
        for tokens in (of_a, of_b):
            ends = np.cumsum([len(x) for _, x in tokens]).tolist()
            spans.append([(i, e - len(x), e) for (i, x), e in zip(tokens, ends, strict=True)])
        links = [(i, j) for i, s, e in spans[0] for j, s2, e2 in spans[1] if s < e2 and s2 < e]
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups = [
            "|".join(",".join(str(i) for i, s, _ in side if low <= s < high) for side in spans)
            for low, high in zip([0, *cuts[:-1]], cuts, strict=True)
        ] if cuts else []
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if of_a else ""
        docs.append((name, len(of_a), len(of_b), len(groups), links, digest))
        counts.update(set(links))
    highest = Counter()
    for (i, _), n in counts.items():
        highest[i] = max(highest[i], n)
    return [
        (name, n_a, n_b, n_groups, len(links), sum(counts[x] == highest[x[0]] for x in links), sum(counts[x] for x in links), digest)
        for name, n_a, n_b, n_groups, links, digest in docs
    ]


def aligned_rows(df):
    return sorted((tuple(r[c] for c in ("doc_id", *alignment.RESULTS, "groups_sha256")) for r in df.collect()), key=str)


def test_op12(spark, folder):
    odd = [" a  b \n c\n\n d\t e", "a\u2581b", "\u2581", " ", "  ", "\x1c x \x1f y", "naïve café — “quoted” 12345 don't", "<s> x</s> <unk> <|endoftext|>",
           "\u3000wide \u00a0no-break", "émoji 😀😀 x", "a" * 500, "e\u0301 e \u0301x"]
    docs = odd_documents(spark).unionByName(
        spark.createDataFrame([(50 + k, t, "en", "a", 1) for k, t in enumerate(odd)] + [(2**60 + 1, PROSE, "en", "a", 1)], odd_documents(spark).schema)
    )
    got = queries.op12_alignment(spark, write_tables(f"{folder}-t", with_clash(docs, "chunk", "n_a", "code", "id")))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["text"] is None or len(r["text"]) < 8000]
    everything = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert len(rows) < len(everything)  # the long text is repetitive: its links are counted below, not pair by pair
    docs = docs.where("text is null or length(text) < 8000")
    got = aligned_rows(alignment.aligned(docs, A, B))
    assert got == sorted(brute_alignment(rows), key=str)
    assert sum(r[1] == 0 for r in got) > 4 and any(r[5] < r[4] for r in got)
    assert queries.op12_alignment(spark, write_tables(f"{folder}-e", no_documents(spark))).count() == 0


def test_alignment_of_texts_that_end_with_a_space(spark):
    rows = list(enumerate(["a ", "two words ", "sign, ", "two spaces  ", "tab\t ", "e\u0301 ", " a ", "a b", "a \n", "a \u00a0"]))
    got = aligned_rows(alignment.aligned(spark.createDataFrame(rows, "doc_id long, text string"), A, B))
    assert got == sorted(brute_alignment(rows), key=str)
    assert all(r[1] for r in got)


def test_chunks_do_not_change_alignment(spark, folder):
    """Few rows or links to a chunk, and many documents of one text."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60)
    docs = docs.unionByName(spark.range(1000, 1300).selectExpr("id as doc_id", "'the same words the same' as text"))
    docs.write.parquet(f"{folder}-d")
    docs = spark.read.parquet(f"{folder}-d")
    want = sorted(brute_alignment([(r["doc_id"], (r["text"] or "")) for r in docs.collect()]), key=str)
    assert aligned_rows(alignment.aligned(docs, A, B)) == want
    assert aligned_rows(alignment.aligned(docs, A, B, chunk_rows=3)) == want
    assert aligned_rows(alignment.aligned(docs, A, B, chunk_links=1000)) == want


def test_bitmaps():
    random = np.random.default_rng(3)
    for size in (0, 1, 5, 2000, 2047, 2048, 20_000, alignment.CHUNK_ROWS):
        places = np.sort(random.choice(alignment.CHUNK_ROWS, size, replace=False))
        packed = alignment.pack(places)
        assert len(packed) <= alignment.PLAIN and alignment.popcount(packed) == size
        assert alignment.places_of(packed).tolist() == places.tolist()
        assert alignment.merge([packed, alignment.pack(np.arange(3))]) == alignment.pack(np.unique(np.r_[places, 0, 1, 2]))


def test_postings_of_a_chunk():
    """Bitmaps and planes give back each document's number of links."""
    random, held, want = np.random.default_rng(4), alignment.Postings(), {}
    for place in range(5000):
        codes = random.integers(0, 4, random.integers(0, 12))
        held.add(codes)
        for code, n in Counter(codes.tolist()).items():
            want[code, place] = n
    got = {}
    for r in held.lists().itertuples():
        assert r.n_docs == alignment.popcount(r.docs)
        for p in alignment.places_of(r.docs):
            got[r.code, p] = 1
        for bit, plane in enumerate(r.planes):
            for p in alignment.places_of(plane):
                got[r.code, p] += 1 << bit
    assert got == want


BLANKS = re.compile("[^\x20\x09-\x0d]+")


def lm_tokens(text):
    return [*BLANKS.findall((text or "").translate(CAPITALS)), ""]


def lm_fold(name):
    return None if name is None else zlib.crc32(str(name).encode()) % 10


def brute_lm(rows):
    """Base values from exact counts, and the model's formula with exact counts of bigrams, words and followers."""
    learn = [lm_tokens(t) for i, t in rows if lm_fold(i) not in (0, None)]
    words = Counter(w for x in learn for w in x)
    pairs = Counter(p for x in learn for p in zip(["", *x], x, strict=False))
    followers = Counter(u for u, _ in pairs)
    n, v = sum(words.values()), len(words)
    once, twice = (sum(c == k for c in pairs.values()) for k in (1, 2))
    d = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
    out = []
    for name, text in rows:
        tokens = lm_tokens(text)
        alone = {w: (words[w] + 0.1) / (n + 0.1 * (v + 1)) for w in tokens}
        total = 0.0
        for u, w in zip(["", *tokens], tokens, strict=False):
            p = alone[w]
            if words[u]:
                p = max(pairs[u, w] - d, 0) / words[u] + d * followers[u] / words[u] * p
            total += math.log10(p)
        out.append((name, lm_fold(name) == 0, len(tokens), sum(words[w] > 0 for w in tokens), n, sum(math.log10(alone[w]) for w in tokens), total))
    return out


def lm_rows(df):
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_op13(spark, folder):
    docs = odd_documents(spark).unionByName(
        spark.createDataFrame([(100 + k, f"{PROSE if k % 3 else OTHER} Tail{k % 7} \x1c\u00a0", "en", "a", 1) for k in range(60)], odd_documents(spark).schema)
    )
    got = lm_rows(queries.op13_language_model(spark, write_tables(f"{folder}-t", with_clash(docs, "row", "n_tokens", "score", "word"))))
    want = sorted(brute_lm([(r["doc_id"], r["text"]) for r in docs.collect()]), key=str)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    # counts of the model are quantised: within a fifth, so 0.1 a token for each of three counts
    assert all(abs(a[6] - b[6]) <= 0.3 * a[2] and a[6] <= 0 for a, b in zip(got, want, strict=True))
    held = [r for r in got if r[1] and (r[0] or 0) >= 100]
    assert len(held) > 3 and all(r[6] > r[5] / 2 for r in held)  # texts like those learned from are far likelier than their words
    empty = write_tables(f"{folder}-e", no_documents(spark))
    assert queries.op13_language_model(spark, empty).count() == 0
    nothing = docs.where("doc_id is null or text is null")
    assert all(r[6] == 0 for r in lm_rows(language_model.score(nothing, language_model.train(nothing.where("false")))))


def test_filters_in_segments(spark):
    """Small segments, blocks and lists of words, filters that stay where they are: the same scores, and exact base values."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = sorted(brute_lm(rows), key=str)
    model = language_model.train(docs, segment_tokens=3000, segment_words=700)
    assert model.bigram_segments > 3 and model.word_segments > 1 and model.filter_bytes > 0
    near = lm_rows(language_model.score(docs, model))
    far = lm_rows(language_model.score(docs, model, filter_bytes=0, hot_words=20))
    for got in (near, far):
        assert [r[:5] for r in got] == [r[:5] for r in want]
        assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    assert np.allclose([r[6] for r in near], [r[6] for r in far], rtol=1e-9)
    errors = [abs(a[6] - b[6]) / a[2] for a, b in zip(near, want, strict=True)]
    assert max(errors) < 0.2 and np.mean(errors) < 0.1


def test_log_bloom():
    """Counts are never too small, rarely too large, and within their level."""
    random = np.random.default_rng(6)
    keys = random.integers(0, 1 << 63, 20_000).astype(np.uint64)
    counts = np.ceil(random.pareto(0.7, len(keys)) * 2 + 0.5).clip(1, 1e9)
    made = language_model.LogBloom.of(keys, counts)
    got = made.counts(keys)
    level = language_model.levels(counts)
    assert (language_model.levels(got) >= level).all() and (language_model.levels(got) == level).mean() > 0.98
    other = random.integers(0, 1 << 63, 20_000).astype(np.uint64)
    assert (made.counts(other) > 0).mean() < 0.02
    small = counts <= 3
    assert (got[small] == counts[small]).mean() > 0.98


def test_blocks_of_long_texts(monkeypatch):
    """A text over several blocks and lists has its tokens once, each with the word before it."""
    monkeypatch.setattr(language_model, "_TEXT_BYTES", 50)
    texts = [(0, PROSE * 3), (1, ""), (2, " \n"), (3, "x" * 200 + " " + OTHER)]
    got = {}
    for block in language_model.blocks(iter(texts), 30):
        for u, w, k in zip(block.before, block.token, block.owner, strict=True):
            got.setdefault(int(k), []).append((block.words[u].decode(), block.words[w].decode()))
    assert got == {k: list(zip(["", *lm_tokens(t)], lm_tokens(t), strict=False)) for k, t in texts}


def test_a_task_counts_bounded_blocks_of_tokens():
    from pagemill.llm import language_model

    found = list(language_model.blocks((k, "a b " * 50_000) for k in range(10)))
    sizes = [len(block.token) for block in found]
    assert sum(sizes) == 10 * 100_001 and max(sizes) <= 700_000


def _filter_of(keys, counts, n):
    parts = [language_model.LogBloom.of(keys[keys % np.uint64(n) == k], counts[keys % np.uint64(n) == k]).bits for k in range(n)]
    return parts, language_model.Segmented(b"".join(p.tobytes() for p in parts), [len(p) for p in parts])


def test_segments_are_probed_together(monkeypatch):
    random_ = np.random.default_rng(5)
    keys = random_.integers(0, 1 << 63, 5_000).astype(np.uint64)
    counts = random_.integers(1, 200, 5_000)
    asked = np.concatenate([keys, random_.integers(0, 1 << 63, 5_000).astype(np.uint64)])
    steps, mixed = [], language_model.mixed
    monkeypatch.setattr(language_model, "mixed", lambda x: steps.append(len(x)) or mixed(x))
    passes = []
    for n in (1, 64):
        parts, whole = _filter_of(keys, counts, n)
        of = asked % np.uint64(n)
        want = np.empty(len(asked))
        for k, bits in enumerate(parts):
            want[of == k] = language_model.LogBloom(bits).counts(asked[of == k])
        steps.clear()
        assert (whole.counts(asked) == want).all()
        passes.append(len(steps))
    assert passes[1] <= 2 * passes[0]  # not once for each segment


def test_remembered_counts_are_those_of_the_filter():
    random_ = np.random.default_rng(6)
    keys = np.concatenate([random_.integers(0, 1 << 63, 3_000), [0, 1, 2]]).astype(np.uint64)
    _, whole = _filter_of(keys, random_.integers(1, 200, len(keys)), 7)
    asked = []
    counts = whole.counts
    whole.counts = lambda k, within=None: asked.append(len(k)) or counts(k, within)
    recalled = language_model.Recalled(whole, 1 << 8)  # many keys share a place
    for _ in range(4):
        some = np.append(np.unique(random_.choice(keys, 100)), np.uint64(3))
        assert (recalled.counts(some) == counts(some)).all()
        assert (recalled.counts(some, some) == counts(some, some)).all()
    assert asked[1] < asked[0] / 2  # what was asked for last is not looked up again


def test_filters_are_read_by_tasks_and_not_broadcast(spark, monkeypatch):
    """Neither the driver nor idle Python processes hold a filter; on storage that tasks cannot open the filters stay where they are."""
    from pyspark import SparkContext

    docs = spark.createDataFrame([(k, f"{PROSE if k % 3 else OTHER} tail{k % 7}") for k in range(60)], "doc_id long, text string")
    model = language_model.train(docs, segment_tokens=500, segment_words=20)
    assert model.bigram_segments > 3 and model.word_segments > 1
    sent, broadcast = [], SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: sent.append(value) or broadcast(self, value))
    near = lm_rows(language_model.score(docs, model))
    assert len(sent) == 1 and isinstance(sent[0], dict)  # the frequent words
    monkeypatch.setattr(language_model, "_files", lambda filters: ["unknown://store/part-0"])
    far = lm_rows(language_model.score(docs, model))
    assert [r[:5] for r in near] == [r[:5] for r in far] and np.allclose([r[5:] for r in near], [r[5:] for r in far], rtol=1e-9)


def test_large_filters_are_read_a_segment_at_a_time(spark, monkeypatch):
    """Above the limit tasks gather keys of several slices and texts and go through the segments; no row of keys is made for each token."""
    docs = spark.createDataFrame(
        [(k, f"{PROSE if k % 3 else OTHER} tail{k % 7}" * (1 + 40 * (k == 9))) for k in range(60)] + [(99, None), (100, "")], "doc_id long, text string"
    )
    model = language_model.train(docs, segment_tokens=500, segment_words=20)
    assert model.bigram_segments > 3 and model.word_segments > 1
    near = lm_rows(language_model.score(docs, model))
    joined = lm_rows(language_model.score(docs, model, filter_bytes=0, streamed_bytes=0))
    monkeypatch.setattr(language_model, "_scores_of_terms", None)
    for tokens in (1, 700, 1 << 20):
        monkeypatch.setattr(language_model, "STREAMED_TOKENS", tokens)
        monkeypatch.setattr(language_model, "SCORED_TOKENS", 300)
        streamed = lm_rows(language_model.score(docs, model, filter_bytes=0))
        for other in (near, joined):
            assert [r[:5] for r in streamed] == [r[:5] for r in other]
            assert np.allclose([r[5:] for r in streamed], [r[5:] for r in other], rtol=1e-9)


def test_slices_of_texts_are_bounded(monkeypatch):
    monkeypatch.setattr(language_model, "_TEXT_BYTES", 50)
    texts = ["x" * k for k in (0, 10, 45, 200, 0, 3, 49, 7, 0)]
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(t, pa.string())}) for t in (texts, [], texts[:1])]
    found = [b["text"].to_pylist() for b in language_model._slices(iter(batches))]
    assert sum(found, []) == [*texts, ""] and all(found)
    assert all(len("".join(b[1:])) < 50 for b in found)  # besides the first text, which may be of any size


def test_frequent_words_are_all_down_to_a_count(spark):
    """Not so many of each task: the driver is sent no more than asked for."""
    words = spark.createDataFrame([("", 9), ("a", 5), ("b", 5), ("c", 5), ("d", 1), ("x" * 100, 50)], "word string, n long")
    for most, want in ((0, ""), (1, " "), (3, " "), (4, " abc"), (5, " abcd"), (9, " abcd")):
        found = language_model.frequent_words(words, most)
        assert sorted(r["word"] or " " for r in found.collect()) == sorted(want)
        assert "TakeOrdered" not in found._jdf.queryExecution().executedPlan().toString()


def test_blocks_number_words_in_order_of_use():
    """Any blanks, texts without words, words of other scripts: tokens as ``bytes.split`` finds them, numbered from the end token on."""
    texts = ["", " \t\n\x0b\x0c\r ", "A b\x1ca  b", "  Straße STRASSE 世界 A", "one\n\none", "\x00 \x00"]
    tokens = [[*t.encode().lower().split(), b""] for t in texts]
    (block,) = language_model.blocks(enumerate(texts))
    assert block.words == list(dict.fromkeys(w for of in tokens for w in [b"", *of]))
    assert [block.words[k] for k in block.token] == [w for of in tokens for w in of]
    assert [block.words[k] for k in block.before] == [w for of in tokens for w in [b"", *of[:-1]]]
    assert block.owner.tolist() == [k for k, of in enumerate(tokens) for _ in of]
    assert list(language_model.blocks(iter([]))) == []
