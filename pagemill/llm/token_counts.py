"""Token counts of whole texts, huge ones included, by overlap resynchronisation.

A text is cut into chunks of ``chunk_chars``; each is encoded with ``overlap`` characters of both neighbours, and with the offsets of
its cuts. In the zone that two chunks share, a cut is a common boundary if a token ends there in both encodings and the text proves it
stable (see ``segments``): what follows such a cut is encoded alike in the chunk and in the whole text. The chunks are spliced at the
first common boundary of each zone. Where a zone has none (a word longer than the overlap) the text is taken again with
a wider overlap, until the overlap is as long as the text. A text of one chunk has nothing to splice.

Texts up to ``SPREAD_CHARS`` are encoded chunk by chunk inside their row. Of longer ones each chunk is a row, which any task may
take, and copies of them are encoded once; the same functions encode and splice their chunks, so the results are the same.

Defined results: a null text counts as empty; the empty text has 0 tokens; special strings inside a text are what the
library makes of them by default; rows with equal ids stay rows of their own; other columns stay under any names, and ``n_bytes``,
``n_tokens`` and ``over_limit`` replace input columns of those names. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import Aside, stored
from pagemill.llm.segments import ODD, Memo, library_tokenizer, segments, task_memory

CHUNK_CHARS = 8_000
OVERLAP = 256
#: Longer texts are dealt out chunk by chunk. Results do not depend on it.
SPREAD_CHARS = 1_000_000
WIDEN = 8
LIMIT = 512


_tokenizer = lru_cache(maxsize=2)(library_tokenizer)


@lru_cache(maxsize=2)
def _counts(path: str) -> Memo:
    encode = _tokenizer(path).encode_batch_fast
    return Memo(lambda texts: [len(e) for e in encode(texts, add_special_tokens=False)])


def encode_chunk(text: str, start: int, end: int, zone: tuple[int, int, int, int], path: str) -> tuple[list[int], list[int]]:
    """Stable boundaries of a chunk in the zones ``(a, b, c, d)`` at its ends, as offsets in ``text``, and tokens before each.

    ``start`` and ``end`` are the chunk's borders that are borders of the document (else -1): they count as boundaries. Cuts
    between segments are where a token ends whatever stands around; between two of them the chunk's tokens are those of the
    whole text. The tokens of what the chunk's borders have cut off are counted with it and lie outside of any two boundaries.
    """
    if ODD.search(text):  # not cut into segments; the library says where tokens end
        ends = [b for _, b in _tokenizer(path).encode(text, add_special_tokens=False).offsets]
        tokens = dict(zip(ends, range(1, len(ends) + 1), strict=True)) | {0: 0, len(text): len(ends)}  # of one end the last token
        at, before = list(tokens), list(tokens.values())
    else:
        parts = segments(text)
        at = list(accumulate(map(len, parts), initial=0))
        before = list(accumulate(_counts(path).of(parts), initial=0))
    a, b, c, d = zone
    kept = [
        k for k, x in enumerate(at)
        if x == start or x == end or 0 < x < len(text) and (a <= x <= b or c <= x <= d) and text[x] in " \n" and not text[x - 1].isspace()
    ]
    kept.sort(key=at.__getitem__)
    return [at[k] for k in kept], [before[k] for k in kept]


def _zone(k: int, chunk: int, overlap: int, low: int) -> tuple[int, int, int, int]:
    """The zones that chunk ``k`` shares with its neighbours, as offsets in its text, which begins at ``low``."""
    a, b = k * chunk - low, (k + 1) * chunk - low
    return a - overlap, a + overlap, b - overlap, b + overlap


def _zones(n: int, chunk: int, overlap: int) -> list[tuple[int, int]]:
    return [(k * chunk - overlap, k * chunk + overlap) for k in range(1, n)]


def count_text(text: str | None, path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP) -> tuple[int, int]:
    """Tokens of one text, and the splices they were counted with."""
    if not text:
        return 0, 0
    while len(text) > max(chunk, 2 * overlap):
        size = max(chunk, 2 * overlap)
        n, chunks = -(-len(text) // size), []
        for k in range(n):
            low = max(0, k * size - overlap)
            piece = text[low : (k + 1) * size + overlap]
            cuts, before = encode_chunk(piece, 0 if k == 0 else -1, len(text) - low if k == n - 1 else -1, _zone(k, size, overlap, low), path)
            chunks.append((low, [low + x for x in cuts], before))
        found = splice(chunks, _zones(n, size, overlap))
        if found is not None:
            return found, n - 1
        overlap *= WIDEN
    return sum(_counts(path).of(segments(text))), 0


def splice(chunks: list[tuple[int, list[int], list[int]]], zones: list[tuple[int, int]]) -> int | None:
    """Tokens of a text from its chunks ``(first offset, boundaries, tokens before each)``; None where a zone has no common
    boundary. ``zones`` are the shared zones in offsets of the whole text, each between two chunks."""
    total, begin = 0, 0
    for k, (_, cuts, before) in enumerate(chunks):
        at = dict(zip(cuts, before, strict=True))
        if k < len(zones):
            following = set(chunks[k + 1][1])
            low, high = zones[k]
            common = [x for x in cuts if low <= x <= high and x in following and x > begin]
            if not common:
                return None
            finish = common[0]
        else:
            finish = cuts[-1]
        if begin not in at:
            return None
        total += at[finish] - at[begin]
        begin = finish
    return total


def _long_counts(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """``(key, n)`` of ``texts`` ``(key, text)``; n is null where the overlap was too short."""
    size = F.char_length("text")
    pieces = (
        texts.withColumn("size", size.cast("long"))
        .withColumn("k", F.explode(F.sequence(F.lit(0), ((F.col("size") - 1) / chunk).cast("int"))))
        .withColumn("low", F.greatest(F.lit(0), F.col("k") * chunk - overlap).cast("int"))
        .withColumn("piece", F.expr(f"substring(text, low + 1, k * {chunk} + {chunk + overlap} - low)"))
        .select("key", "size", "k", "low", "piece")
        .repartition("key", "k")
    )

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with task_memory():
            for batch in batches:
                out = []
                for key, n, k, low, text in batch.itertuples(index=False):
                    last = (k + 1) * chunk >= n
                    cuts, before = encode_chunk(text, 0 if k == 0 else -1, n - low if last else -1, _zone(k, chunk, overlap, low), path)
                    out.append((key, k, low, [low + c for c in cuts], before))
                yield pd.DataFrame(out, columns=["key", "k", "low", "cuts", "before"])

    encoded = pieces.mapInPandas(encode, "key string, k int, low long, cuts array<long>, before array<long>")

    def join(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("k")
        chunks = [(low, list(c), list(b)) for low, c, b in zip(group["low"], group["cuts"], group["before"], strict=True)]
        n = splice(chunks, _zones(len(chunks), chunk, overlap))
        return pd.DataFrame({"key": [group["key"].iloc[0]], "n": pd.array([n], dtype="Int64")})

    return encoded.groupBy("key").applyInPandas(join, "key string, n long")


def count_tokens(
    docs: DataFrame,
    path: str,
    text: str = "text",
    limit: int = LIMIT,
    chunk_chars: int = CHUNK_CHARS,
    overlap: int = OVERLAP,
    spread_chars: int = SPREAD_CHARS,
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens``, ``over_limit`` and ``n_splices`` for the tokenizer file at ``path``.

    ``n_splices``: where the chunks of the text were joined; 0 for texts of one chunk.
    """

    @F.pandas_udf("n long, splices int")
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        with task_memory():
            for batch in batches:
                yield pd.DataFrame([count_text(t, path, chunk_chars, overlap) for t in batch], columns=["n", "splices"])

    aside = Aside(docs, whole=F.coalesce(F.col(text), F.lit("")))
    is_long = F.char_length("whole") > spread_chars

    def finish(df: DataFrame, n_tokens: Column, n_splices: Column) -> DataFrame:
        return aside.back(
            df, n_bytes=F.octet_length("whole").cast("long"), n_tokens=n_tokens, over_limit=n_tokens > limit, n_splices=n_splices
        )

    counted = aside.rows.where(~is_long).withColumn("counted", counts("whole"))
    short = finish(counted, F.col("counted.n"), F.col("counted.splices"))
    long_rows = aside.rows.where(is_long).withColumn("of_key", F.sha2(F.col("whole").cast("binary"), 256))
    copies = long_rows.select(F.col("of_key").alias("key"), F.col("whole").alias("text"))
    texts = stored(copies.dropDuplicates(["key"]), "token-texts")  # each text is encoded once
    done = None
    while True:
        chunk = max(chunk_chars, 2 * overlap)
        result = stored(_long_counts(texts, path, chunk, overlap), "token-counts").withColumn("chunk", F.lit(chunk))
        good = result.where("n is not null")
        done = good if done is None else done.unionByName(good)
        open_keys = result.where("n is null").select("key")
        if open_keys.isEmpty():
            break
        overlap *= WIDEN
        texts = texts.join(open_keys, "key", "left_semi")
    spliced = F.floor((F.char_length("whole") - 1) / F.col("chunk")).cast("int")
    return short.unionByName(finish(long_rows.join(done, F.col("of_key") == F.col("key")), F.col("n"), spliced))
