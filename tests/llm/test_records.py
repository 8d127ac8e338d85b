"""PII surrogates, shards, url filter, nearest neighbours and toxicity."""

import math
import heapq
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import OTHER, PROSE, no_documents, odd_documents, with_clash, write_tables
from pyspark.sql import functions as F

from pagemill.llm import ann, pii, queries, sharding, toxicity, url_filter

TEXTS = [
    "Write to Anna.Smith+x@Mail8.example.com or ANNA.SMITH+X@MAIL8.EXAMPLE.COM, not bob@b.org.",
    "Call +1 (614) 555-8001 or +16145558001 190.137.223.204 from 10.0.0.1.",
    "Card 4111 1111 1111 1111, again 4111111111111111, and 1234567812345678; ssn 123-45-6789.",
    'token = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b" and password=18a0165473c0330cab, TOKEN = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"!!',
    "Mr. John Carter met Mrs. Mary Carter and Mr. Carter. Господин Иван Петров пришёл. IBAN DE89 3704 0044 0532 0130 00.",
    "Version 2.0 of the licence costs 12.50 in 2024: nothing to hide here, 100 percent.",
]
SECRETS = ["anna.smith", "bob@", "555-8001", "5558001", "190.137.223.204", "10.0.0.1", "4111 1111", "4111111111111111", "1234567812345678", "123-45-6789", "9233a8ec", "18a01654", "john", "mary", "carter", "петров", "3704 0044"]


def luhn(digits):
    return sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits))) % 10


def replaced(spark, texts, key="k"):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    return {r["doc_id"]: r["text"] for r in pii.replace_pii(docs, key).collect()}


def test_surrogates_are_consistent(spark):
    got = replaced(spark, TEXTS)
    assert not [s for s in SECRETS for t in got.values() if s in t.lower()]
    assert got[5] == TEXTS[5]
    lower, upper, bob = re.findall(r"\S+@\S+?(?=[ ,.]* |,|\.$)", got[0])
    assert lower.lower() == upper.lower() != bob and upper == upper.upper() and bob.endswith(".example.org")
    plus, plain = re.search(r"\+1 (\(\d{3}\) \d{3}-\d{4}) or \+1(\d{10})", got[1]).groups()
    assert re.sub(r"\D", "", plus) == plain
    ips = re.findall(r"\d+\.\d+\.\d+\.\d+", got[1])
    assert len(set(ips)) == 2 and all(0 < int(o) < 256 for ip in ips for o in ip.split("."))
    spaced, joined, other = re.search(r"Card (\d{4} \d{4} \d{4} \d{4}), again (\d{16}), and (\d{16});", got[2]).groups()
    assert spaced.replace(" ", "") == joined and luhn(joined) == 0 and luhn(other) != 0
    first, last = re.findall(r'(?i)token = "([0-9a-f]{40})"', got[3])
    assert first == last.lower() and last == last.upper()
    names = re.match(r"Mr\. (\w+) (\w+) met Mrs\. (\w+) (\w+) and Mr\. (\w+)\. Господин (\w+) (\w+) пришёл\.", got[4]).groups()
    assert names[1] == names[3] == names[4]
    assert names[0] in pii.NAMES["male", "latin"] and names[2] in pii.NAMES["female", "latin"]
    assert names[5] in pii.NAMES["male", "cyrillic"] and re.fullmatch("[А-Я][а-я]+", names[6])
    assert replaced(spark, TEXTS) == got != replaced(spark, TEXTS, "other key")


def test_texts_with_any_entity_are_searched(spark):
    """Each pattern's match holds what texts are searched for, and secrets are replaced to their end."""
    secrets = ["set token=/aB3dE5fG7hJ9kL2m now", 'password: "+x9Qw7Er5Ty3Ui1Op" here', "secret = -Zk81mQpLr", "api_key=.hidden7file", "token=_abcde7"]
    others = ["a@b.cd", "DE89370400440532", "1.2.3.4", "1234567890123", "123-45-6789", "+1(2)34", "+12345", "(123) 456 7890", "Mr Ab", "Frau. Él"]
    shown = spark.createDataFrame([(t,) for t in secrets + others], "t string")
    assert shown.where(F.col("t").rlike(pii.ANY)).count() == len(secrets + others)
    assert [r["t"] for r in shown.where(F.col("t").rlike(pii.ANY) & ~F.col("t").rlike(pii.HINT)).collect()] == []
    got = replaced(spark, secrets)
    assert all(re.search(r"[=:] ?\"?(\S+?)(\"|\s|$)", t)[1] not in got[k] for k, t in enumerate(secrets))
    values = ["aB3/" * 2500, "x" * 5000 + "7"]
    for k, value in enumerate(values):
        out = replaced(spark, [f"token={value} end"])[0]
        assert len(out) == len(f"token={value} end") and value[-24:] not in out and out.endswith(" end"), k


def test_distinct_entities_stay_distinct(spark):
    ips = [f"10.{a}.{b}.7" for a in range(40) for b in range(50)]
    names = [f"Mr. {x}{y}" for x in ("Al", "Be", "Ce", "Do", "Em", "Fa") for y in "abcdefghijklmnopqrstuvwxyz"]
    got = replaced(spark, ips + names + ips)
    new_ips, new_names = [got[k] for k in range(len(ips))], [got[k] for k in range(len(ips), len(ips) + len(names))]
    assert len(set(new_ips)) == len(ips) and not set(new_ips) & set(ips)
    assert len(set(new_names)) == len(names) and not set(new_names) & set(names)
    assert [got[len(ips) + len(names) + k] for k in range(len(ips))] == new_ips


def test_collisions_are_drawn_again(spark, monkeypatch):
    """Surrogates that depend on the draw alone meet until each entity has one of its own."""
    monkeypatch.setattr(pii, "surrogate", lambda canon, kind, key, draw: F.concat(F.lit("s"), draw.cast("string")))
    entities = spark.createDataFrame([("ip", f"s{k}") for k in (2, 3, 8)] + [("ip", "x"), ("email", "s0")], "kind string, canon string")
    got = pii.draw_surrogates(entities, "k").collect()
    by_kind = {}
    for r in got:
        by_kind.setdefault(r["kind"], []).append(r["surrogate"])
    assert sorted(by_kind["ip"]) == ["s0", "s1", "s4", "s5"] and by_kind["email"] == ["s1"]


def test_pii_of_odd_documents(spark):
    docs = with_clash(odd_documents(spark), "n_surrogates", "kind", "list", "_x")
    got = pii.replace_pii(docs, "k")
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter((r["doc_id"], r["text"]) for r in docs.collect())
    assert {r["kind"] for r in got.collect()} == {"own"}
    assert pii.replace_pii(no_documents(spark), "k").count() == 0


def test_pii_runs_no_python(spark):
    plan = pii.replace_pii(odd_documents(spark), "k")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_op2(spark, folder):
    docs = odd_documents(spark)
    many = spark.range(3000).select(
        (F.col("id") + 100).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit(PROSE)).otherwise(F.concat(F.lit(OTHER), F.col("id").cast("string"))).alias("text"),
        F.lit("en").alias("lang"), F.lit("a").alias("source"), F.lit(1).cast("long").alias("n_chars"),
    )
    docs = docs.union(many)
    rows = queries.op2_sharding(spark, write_tables(f"{folder}-t", docs)).collect()
    texts = sorted(((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in docs.collect()), key=str)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=str) == texts
    sums, slots, groups = Counter(), {}, {}
    for r in rows:
        sums[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        groups.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert set(sums) == set(range(16))
    assert max(sums.values()) - min(sums.values()) <= 2 * max(r["size"] for r in rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(max(s) - min(s) + 1 == len(s) for s in groups.values())
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}


def test_shards_of_few_and_no_rows(spark):
    few = spark.createDataFrame([(1, 5), (2, None), (2, None)], "doc_id long, size long")
    assert sharding.assign(few, F.col("size"), "doc_id", shards=4).count() == 3
    assert sharding.assign(few.limit(0), F.col("size"), "doc_id").count() == 0
    one = sharding.assign(spark.createDataFrame([(1, 5)] * 40, "doc_id long, size long"), F.col("size"), "doc_id", shards=4)
    assert Counter(r["shard"] for r in one.collect()) == {0: 10, 1: 10, 2: 10, 3: 10}


def test_overfull_ranges_are_subdivided():
    high = np.array([1] * 500 + list(range(2, 102)))
    low = np.arange(600)
    cuts = sharding.weighted_splitters(high, low, np.ones(600), 12)
    assert cuts == sorted(set(cuts)) and sum(c[0] == 1 for c in cuts) >= 9
    assert sharding.weighted_splitters(high[:0], low[:0], np.zeros(0), 12) == []


URLS = [
    None, "", "no scheme", "http://", "https://WWW.Example.com/en/x?y#z", "http://a.example.com/en/1", "http://example.com/en", "http://example.com",
    "http://x.net/es/1", "http://x.net/es", "https://casino-poker.example.org/de/1", "https://cheap-pills.example.net/en/2", "http://a.b#c/d", "x://h?://y/",
    "http://newsjournal.example.org/en/5", "http://anexample.com/en/1", "http://a\nb/c\nd?e",
]


def brute_url(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    fits = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best


def test_op6(spark, folder):
    pages = spark.createDataFrame([(k, u, "h", "own") for k, u in enumerate([*URLS, URLS[4]])], "page_id long, url string, html string, host string")
    pages.write.parquet(f"{folder}-t/pages.parquet")
    rows = queries.op6_url_filter(spark, f"{folder}-t").collect()
    assert len(rows) == len(URLS) + 1
    verdicts = {}
    for r in rows:
        host, path, rule = brute_url([*URLS, URLS[4]][r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule.name if rule else None)
        if rule:
            assert r["verdict"] == rule.action
        verdicts[r["page_id"]] = r["verdict"]
    assert verdicts[10] == verdicts[11] == "block"
    assert {verdicts[k] for k in (0, 1, 2, 3, 9, 14)} == {"allow"}


def test_url_scores_equal_brute_force(spark):
    model = url_filter.train(url_filter.labelled_urls(spark))
    hashing, regression = model.stages
    weights, bias = regression.coefficients.toArray(), regression.intercept
    hosts = ["casino.example.org", "tionther.example.net", "", "news-bets.org"]
    df = spark.createDataFrame([(f"http://{h}/p/1",) for h in hosts], "url string")
    got = {r["host"]: r["block_score"] for r in url_filter.judge(df, [], model).collect()}
    for host in hosts:
        grams = {m + s[k : k + n] for m, s in (("h:", f"^{host}$" if host else ""), ("p:", "^/p/1$")) for n in url_filter.GRAMS for k in range(len(s) - n + 1)}
        places = {hashing.indexOf(g) for g in grams}
        assert got[host] == pytest.approx(1 / (1 + math.exp(-(bias + sum(weights[p] for p in places)))), abs=1e-9)
    assert url_filter.judge(df.limit(0), [], model).count() == 0


def test_held_out_urls(spark):
    """Blocking on the part of the table that was not learned from, and no words of it that the given tables' hosts are made of."""
    labelled = url_filter.labelled_urls(spark)
    model = url_filter.train(labelled.where("not held_out"))
    precision, recall = url_filter.measured(labelled.where("held_out"), model)
    assert precision >= 0.95 and recall >= 0.8
    assert labelled.where("held_out").count() > 150
    assert min(map(len, url_filter.ORDINARY)) >= 3 and {"ther", "tion", "ing"}.isdisjoint(url_filter.ORDINARY)


def inner(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=True):
        total += x * y
    return total


def brute_neighbours(rows, k=20):
    clean = {(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, a in clean:
        if q % 20 == 0:
            found = {}
            for i, b in clean:
                if i != q and len(a) == len(b):
                    found[i] = max(found.get(i, -math.inf), inner(a, b))
            out[q] = sorted(((i, s) for i, s in found.items()), key=lambda x: (-x[1], x[0]))[:k]
    return out


def test_names_without_their_title_follow(spark):
    """Bare full names and surnames of a document get the surrogate of the titled name, in that document only."""
    rows = [
        (1, "Mr John Smith came. Later Smith left and John Smith slept; Smithson and smith did not. SMITH?"),
        (2, "Dr. Ana Lopez-Ruiz met Mrs Smith, Prof. Smith and Ana Lopez-Ruiz. Lopez-Ruiz left."),
        (3, "John Smith without a title, Smith too."),
        (4, "Version 1.2.3.4 and release 10.0.0.1 came with order number 12; call 0171 555 1234 from 10.0.0.1."),
        (5, "Господин Иван Петров пришёл. Петров ушёл."),
    ]
    docs = with_clash(spark.createDataFrame(rows, "doc_id long, text string"), "mentions", "salt", "list", "new", "own0", "_mentions", "kind")
    got = {r["doc_id"]: r for r in pii.replace_pii(docs, "k").collect()}
    assert {r["mentions"] + r["salt"] + r["list"] + r["own0"] for r in got.values()} == {"ownownownown"}
    one = re.fullmatch(r"Mr (\w+) (\w+) came\. Later (\w+) left and (\w+) (\w+) slept; Smithson and smith did not\. SMITH\?", got[1]["text"])
    assert one and one[2] == one[3] == one[5] and one[1] == one[4] and "Smith" not in (one[2], one[1]) and got[1]["n_surrogates"] == 3
    two = re.fullmatch(r"Dr\. (\w+) ([\w-]+) met Mrs (\w+), Prof\. (\w+) and (\w+) ([\w-]+)\. ([\w-]+) left\.", got[2]["text"])
    assert two and two[1] == two[5] and two[2] == two[6] == two[7] and two[3] == two[4] == one[2] and "Lopez" not in got[2]["text"]
    assert got[3]["text"] == rows[2][1] and got[3]["n_surrogates"] == 0
    assert got[4]["text"].startswith(rows[3][1][:60]) and "0171" not in got[4]["text"] and got[4]["n_surrogates"] == 2
    assert "Петров" not in got[5]["text"]


def test_op9_recall(spark, folder):
    random = np.random.default_rng(8)
    rows = [(k, [float(np.float32(x)) for x in random.standard_normal(64)]) for k in range(1500)]
    rows += [(2000 + k, rows[7][1]) for k in range(300)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{folder}-t/embeddings.parquet")
    got = {}
    for r in queries.op9_ann(spark, f"{folder}-t").orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    want = brute_neighbours([(i, tuple(v)) for i, v in rows])
    assert got.keys() == want.keys()
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9
    for q in (2000, 2020):
        assert [i for i, _ in got[q]] == [7, *[i for i in range(2000, 2021) if i != q]][:20]
    scores = {(q, i): s for q, found in want.items() for i, s in found}
    assert all(scores.get((q, i), s) == s for q, found in got.items() for i, s in found)


def test_neighbours_of_odd_vectors(spark):
    nan = float("nan")
    rows = [(0, [1.0, 2.0]), (20, None), (40, [0.0, 0.0]), (60, [nan, 1.0]), (80, [None, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (None, [9.0, 9.0]), (2, [2.0]), (100, [3.0]), (3, [float("inf"), 0.0])]
    items = spark.createDataFrame([(i, v, "own") for i, v in rows], "vec_id long, embedding array<double>, rank string")
    got = ann.search(items, F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, got.collect())) == [(0, 1, 1, 3.0), (100, 1, 2, 6.0)]
    assert ann.search(items.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_many_shards_and_blocks(spark):
    """All shares of the vectors, over several forests and blocks, give brute force's result; the forests' order is a queue's."""
    random = np.random.default_rng(12)
    rows = [(k, [float(x) for x in random.standard_normal(3 if k % 7 == 0 else 8)]) for k in range(900)] + [(900 + k, [1.0] * 8) for k in range(60)]
    items = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute_neighbours([(i, tuple(v)) for i, v in rows])
    for shard_rows, query_block in ((90, 7), (500, 16), (5000, 5000)):
        got = {}
        for r in ann.search(items, F.col("vec_id") % 20 == 0, share=1.0, shard_rows=shard_rows, query_block=query_block).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert got == want
    vectors = random.standard_normal((500, 6))
    forest = ann.Forest(vectors, trees=3, leaf_rows=10)
    searcher = ann.Searcher(vectors, **forest.packed())
    query = random.standard_normal((1, 6))
    margins = (searcher.planes @ query[0] - searcher.offsets).tolist()
    queue, order = [(-np.inf, r) for r in searcher.roots.tolist()], []
    heapq.heapify(queue)
    while queue:
        worst, node = heapq.heappop(queue)
        if node < 0:
            order.append(~node)
        else:
            left, right = searcher.children[node].tolist()
            heapq.heappush(queue, (max(worst, margins[node]), left))
            heapq.heappush(queue, (max(worst, -margins[node]), right))
    places = searcher.queue(query)[:, 0]
    assert sorted(order) == list(range(forest.n_leaves)) and (np.diff(places[order]) >= -1e-6).all()


def test_recall_on_given_vectors(spark):
    items = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    want = brute_neighbours([(r["vec_id"], tuple(r["embedding"])) for r in items.collect()])
    hits = 0
    for r in ann.search(items, F.col("vec_id") % 20 == 0, shard_rows=700, query_block=40).collect():
        hits += r["vec_id"] in {i for i, _ in want[r["query_id"]]}
    assert hits >= 0.9 * sum(map(len, want.values()))


def toxic_tables(spark, n=600):
    random = np.random.default_rng(4)
    words = [w.strip(".,") for w in (PROSE + " " + OTHER).split()]
    rows, labels = [], []
    for k in range(n):
        text = [words[x] for x in random.integers(0, len(words), 60)]
        toxic = k % 4 == 0
        if toxic:
            for _ in range(4):
                text[int(random.integers(0, 60))] = ["grumbug", "snarlot", "vilefen"][int(random.integers(0, 3))] + ["", "ist", "o"][int(random.integers(0, 3))]
        rows.append((k, " ".join(text), "en", "a", 1))
        labels.append((k, 1, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_op10_held_out_accuracy(spark, folder):
    docs, labels = toxic_tables(spark)
    odd = odd_documents(spark).where("doc_id is null or doc_id > 0").withColumn("doc_id", F.col("doc_id") + 5000)
    sf_dir = write_tables(f"{folder}-t", docs.union(odd), labels=labels.union(spark.createDataFrame([(None, 1, 1), (3, None, None), (4, 1, 1)], "doc_id long, quality int, toxic int")))
    rows = queries.op10_toxicity(spark, sf_dir).collect()
    assert len(rows) == 612
    held = [r for r in rows if r["held_out"] and r["doc_id"] < 600]
    assert {r["doc_id"] for r in held} == {k for k in range(600) if zlib.crc32(str(k).encode()) % 5 == 0}
    right = sum(r["predicted"] == (r["doc_id"] % 4 == 0) for r in held)
    assert right / len(held) >= 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert all(r["predicted"] == 0 for r in rows if r["doc_id"] is None or r["doc_id"] >= 5000)


def test_toxicity_without_labels(spark):
    docs = with_clash(odd_documents(spark), "score", "label", "toxic", "probability")
    for labels, want in (([], 0.0), ([(1, 0), (2, 0)], 0.0), ([(1, 1), (2, 1)], 1.0)):
        model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        scored = toxicity.score(docs, model)
        assert {r["score"] for r in scored.collect()} == {want} and scored.count() == docs.count()
    empty = toxicity.score(no_documents(spark), toxicity.Model({}, None, None, 0.5))
    assert empty.count() == 0


@pytest.mark.parametrize(
    ("word", "plain"), [("Idiot,", "idiot"), ("1d10t!!", "idiot"), ("s.t.u.p.i.d", "stupid"), ("stuuuupid", "stupid"), ("***", ""), ("2024", "2024"), ("ÜBER", "über")]
)
def test_plain_words(word, plain):
    assert toxicity.plain_word(word)[0] == plain
