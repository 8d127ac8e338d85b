"""Spelling variants: words one edit apart, found by a frontier of states that walks a trie held as a table.

The trie's edge table has a row per edge: node, label, child. Chains without a branch are one edge, so a level of the walk is a
branch of the trie and not a letter. A state is (word, position, node, edits). States without an edit are those of the word's own path,
of all levels; at each node they take every edge but their own, by replacing a letter or by inserting one. The frontier of states with
one edit then joins the edge table level by level, along its own letters only. States that end with one edit where a word ends are neighbours.
Deletions are insertions seen from the other word. An edge also has a signature, bits of hashes of all that follows it in
any word; a state whose remaining letters are not among them cannot end and is not made.

Of two neighbours, half of the letters at least agree before the edit or behind it. So the walk is done for the words and for
the reversed words, each time from the node in the middle of the word: the top of a trie, where every word meets every edge, is
never walked, and no node is a hot key for it. Nodes are named by 64 bits of a hash of their letters; two nodes of one name
would only add states, as each neighbour is verified on the two words.

Then each word gets as its form the neighbour with the largest count, if that is ``RATIO`` times its own, and as its root the
last of the forms that follow one another (found by pointer doubling; counts grow along the way, so there are no circles).

Words are counted per batch before they are shuffled; words below ``LEAST_LENGTH`` letters or ``LEAST_COUNT`` occurrences are not compared.

Defined results: null and empty texts have no words; a null id is written as nothing in the hash that decides on thinned words; repeated
rows count again; equal counts of neighbours are decided by code points; an empty table gives an empty table. Other columns are
not read. A word of any length is a few edges; deep chains of nested words cost a level each.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import stored

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
#: Longs of a signature.
_SIGNATURE = 4
#: A run of a document loses a letter if this divides its hash.
THIN = 31


def count_words(docs: DataFrame, id: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, thin: int = THIN) -> DataFrame:
    """``(word, n)``: letter runs of whole texts, A-Z lower-cased. With ``thin``, a run of a document loses one letter if ``thin``
    divides the CRC-32 of ``<id>:<run>``; 0 leaves all runs as they are."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Latin-1 has one byte for each letter of a run; characters beyond it become signs and end a run.
        runs = re.compile(b"[a-z\xc0-\xff]{%d,}" % least_length)
        for batch in batches:
            found: Counter[bytes] = Counter()
            for name, content in zip(batch["id"], batch["text"], strict=True):
                of_text = Counter(runs.findall(content.encode("latin-1", "replace").lower()))
                if not thin:
                    found.update(of_text)
                    continue
                begin = zlib.crc32(name.encode() + b":")
                for run, n in of_text.items():
                    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), begin)
                    if h % thin == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                    found[run] += n
            kept = [(w.decode("latin-1"), n) for w, n in found.items() if len(w) >= least_length]
            yield pd.DataFrame(kept, columns=["word", "n"])

    name = F.coalesce(F.col(id).cast("string"), F.lit(""))
    given = docs.where(F.col(text).isNotNull()).select(name.alias("id"), F.col(text).alias("text"))
    summed = given.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return summed.where(F.col("n") >= least_count)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers mixed (the finalizer of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_nodes(spellings: list[str], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of all prefixes of all spellings, from the empty one on, one after the other; and where each spelling's begin.

    A name is the sum over the letters of a hash of letter and place, so it is made in one pass over any length."""
    sizes = np.array([len(s) for s in spellings], np.int64)
    code = np.frombuffer("".join(spellings).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum(sizes)
    place = (np.arange(len(code)) - np.repeat(ends - sizes, sizes)).astype(np.uint64)
    letter = _mixed(code + _mixed(place * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letter, dtype=np.uint64)])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    at = np.arange(starts[-1]) - np.repeat(np.arange(len(sizes)), sizes + 1)  # letters of all spellings up to this prefix
    nodes = total[at] - np.repeat(total[ends - sizes], sizes + 1)
    return _mixed(nodes + np.uint64(2 * seed + 1)).view(np.int64), starts


def _paths(words: DataFrame) -> DataFrame:
    """``(spelling, back, first, nodes)``: of each word and its reverse the nodes that a walk can meet, from the depth ``first``, a letter
    before its middle, on."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for back in (False, True):
                spellings = [w[::-1] for w in batch["word"]] if back else batch["word"].to_list()
                if not spellings:
                    continue
                nodes, starts = prefix_nodes(spellings, int(back))
                rows = [
                    (s, back, (len(s) - 1) // 2, nodes[a + (len(s) - 1) // 2 : b])
                    for s, a, b in zip(spellings, starts[:-1].tolist(), starts[1:].tolist(), strict=True)
                ]
                yield pd.DataFrame(rows, columns=["spelling", "back", "first", "nodes"])

    return words.select("word").mapInPandas(place, "spelling string, back boolean, first int, nodes array<long>")


def _places(paths: DataFrame) -> DataFrame:
    """``(spelling, back, d, node, next, start)``: a row per node of a path; ``next`` is the letter that follows ('' at the end), ``start``
    holds where the word's own walk begins."""
    each = paths.select("spelling", "back", "first", F.posexplode("nodes").alias("k", "node"))
    placed = each.select("spelling", "back", (F.col("first") + F.col("k")).cast("int").alias("d"), "node")
    return placed.withColumns(
        {"next": F.expr("substring(spelling, d + 1, 1)"), "start": F.col("d") == F.floor(F.char_length("spelling") / 2)}
    )


def _rest_bit(spelling: str, place: str) -> str:
    """The bit of a signature for the letters from a place on."""
    return f"pmod(xxhash64(substring({spelling}, {place} + 1)), {64 * _SIGNATURE})"


def states_without_edit(places: DataFrame) -> DataFrame:
    """``(spelling, back, d, node)``: of each path the branches, the ends of words and the starts of walks that it passes."""
    shape = places.groupBy("node").agg(F.min("next").alias("low"), F.max("next").alias("high"), F.max("start").alias("start"))
    kept = shape.where((F.col("low") != F.col("high")) | (F.col("low") == "") | F.col("start")).select("node")
    return places.select("spelling", "back", "d", "node").join(kept, "node").select("spelling", "back", "d", "node")


def edge_table(states: DataFrame) -> DataFrame:
    """``(node, letter, label, child, s0, s1, ...)``: the edges between the nodes of ``states``, with the signature of what follows the
    child in any word."""
    ways = states.groupBy("spelling", "back").agg(F.sort_array(F.collect_list(F.struct("d", "node"))).alias("way"))
    steps = F.expr(
        "transform(sequence(1, size(way) - 1), i -> struct(way[i - 1].node as node, way[i].node as child, way[i].d as place, "
        "substring(spelling, way[i - 1].d + 1, way[i].d - way[i - 1].d) as label))"
    )
    each = ways.where(F.size("way") > 1).select("spelling", F.explode(steps).alias("e")).select("spelling", "e.*")
    bits = each.withColumn("bit", F.expr(_rest_bit("spelling", "place")))
    signature = [
        F.bit_or(F.expr(f"case when bit div 64 = {k} then shiftleft(1L, cast(bit % 64 as int)) else 0L end")).alias(f"s{k}")
        for k in range(_SIGNATURE)
    ]
    edges = bits.groupBy("node", "child", "label").agg(*signature)
    return edges.withColumn("letter", F.substring("label", 1, 1))


def neighbours(words: DataFrame) -> DataFrame:
    """``(word, near)``: all ordered pairs of the distinct ``words`` that differ by one inserted, deleted or replaced letter."""
    paths = stored(_paths(words), "spelling-paths")
    unedited = stored(states_without_edit(_places(paths)), "spelling-level0")
    edges = stored(edge_table(unedited), "spelling-edges")
    own = F.when(F.col("back"), F.reverse("spelling")).otherwise(F.col("spelling"))
    ends = paths.select(F.element_at("nodes", -1).alias("node"), own.alias("near"))
    size = "char_length(label)"

    def follows(place: str) -> str:
        """Whether some word below the child goes on as the spelling does from a place on, as far as the signature tells."""
        bit = _rest_bit("spelling", place)
        part = " ".join(f"when {k} then s{k}" for k in range(_SIGNATURE))
        return f"(shiftrightunsigned(case {bit} div 64 {part} end, cast({bit} % 64 as int)) & 1) = 1"

    replaced = (
        f"letter > substring(spelling, pos + 1, 1) and pos < char_length(spelling) "
        f"and substring(label, 2) = substring(spelling, pos + 2, {size} - 1) and {follows(f'pos + {size}')}"
    )
    inserted = (
        f"letter <> substring(spelling, pos + 1, 1) "
        f"and substring(label, 2) = substring(spelling, pos + 1, {size} - 1) and {follows(f'pos + {size} - 1')}"
    )
    # the states without an edit of all levels take each edge but their own, by an edit
    ways = F.expr(
        f"filter(array(struct(pos + {size} as pos, {replaced} as fits), struct(pos + {size} - 1 as pos, {inserted} as fits)), m -> m.fits)"
    )
    branched = (
        unedited.where(F.col("d") >= F.floor(F.char_length("spelling") / 2))
        .withColumnRenamed("d", "pos")
        .join(edges, "node")
        .where(f"({replaced}) or ({inserted})")
        .select("spelling", "back", F.explode(ways).alias("m"), F.col("child").alias("node"))
        .select("spelling", "back", "m.pos", "node")
    )
    states, found, level = stored(branched, "spelling-level1"), None, 1
    while not states.isEmpty():
        at_end = F.col("pos") == F.char_length("spelling")
        met = states.where(at_end).join(ends, "node").select("spelling", "back", "near")
        found = met if found is None else found.unionByName(met)
        level += 1
        onward = (
            states.where(~at_end)
            .withColumn("letter", F.expr("substring(spelling, pos + 1, 1)"))
            .join(edges, ["node", "letter"])
            .where(f"label = substring(spelling, pos + 1, {size}) and {follows(f'pos + {size}')}")
            .select("spelling", "back", F.expr(f"pos + {size}").alias("pos"), F.col("child").alias("node"))
        )
        states = stored(onward, f"spelling-level{level}")
    if found is None:
        found = states.select("spelling", "back", F.col("spelling").alias("near"))
    word = F.when(F.col("back"), F.reverse("spelling")).otherwise(F.col("spelling"))
    pairs = found.select(word.alias("word"), "near").where(F.levenshtein("word", "near", 1) == 1)
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near")))
    return both.distinct()


def follow(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``forms`` ``(word, form)``, a forest: the last of the forms that follow from a word."""
    links = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = links.select(F.col("word").alias("via"), F.col("root").alias("beyond"))
        hop = stored(links.join(onward, F.col("root") == F.col("via"), "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "spelling-roots")
        links = hop.select("word", "root")
        if hop.where("moved").isEmpty():
            return links


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of ``words`` ``(word, n)``."""
    words = stored(words.select("word", "n"), "spelling-words")
    near = neighbours(words)
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("of_near"))
    best = F.min(F.struct((-F.col("of_near")).alias("less"), F.col("near").alias("near")))
    grouped = near.join(counts, "near").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(grouped, "word", "left")
    is_form = -F.col("best.less") >= F.col("n") * ratio
    formed = stored(
        joined.select(
            "word",
            F.when(is_form, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, -F.col("best.less")).cast("long").alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = follow(formed.where(F.col("form").isNotNull()))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
