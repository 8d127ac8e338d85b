"""Scores of a bigram language model whose counts lie, quantised, in a log-frequency Bloom filter.

Learning counts words exactly, and bigrams in segments of a hash: tasks count blocks of tokens, and send each segment its keys packed in
one row. Each segment writes the counts of its keys into a filter of its own: a count of level ``j`` (``BASE`` to the power ``j - 1``
and more) puts the key in with each of the marks 1 to ``j``. The count of a key is read by probing for mark 1, 2 ... until one
is missing, so a count is never read too small, and too large by a level with the filter's small rate of false answers. A second
filter of the same kind holds for each word its count and its number of different followers.

The probability of a word ``w`` after ``u`` is ``max(c(uw) - D, 0) / c(u) + D f(u) / c(u) p(w)`` with the followers ``f``, the discount
``D = n1 / (n1 + 2 n2)`` from the numbers of bigrams that occur once and twice, and ``p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1))``; all counts
here are those that the filter gives. A text begins and ends with the end token.

The filters grow with the corpus. Up to ``FILTER_BYTES`` a task reads them from where they are stored, holds them until it ends, and scores
a text in one pass. Of larger ones, up to ``STREAMED_BYTES``, a task holds one segment at a time: it gathers the keys of ``STREAMED_TOKENS`` tokens
and reads the filters once for all of these. Still larger ones, and those on storage that pyarrow does not know, stay in their segments: the
different keys of the texts are sent to them, and the counts joined back. The results are the same. Texts are scored in slices of bounded size.

The base score uses exact counts: those of the ``HOT_WORDS`` most frequent words (of up to ``HOT_BYTES`` bytes) are broadcast, the others,
of which each is rare, are joined by word.

Defined results: words are runs of other characters than the six ASCII blanks, A-Z lower-cased; a null text is empty and holds the end
token only. A null id neither learns nor is held out. Repeated rows learn and are scored again. Nothing to learn from
gives each token the probability 1 of an empty vocabulary's one unknown word, so scores of 0. An empty table gives an empty table. Only the id is
carried. Texts of any length are cut into blocks of tokens.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import unquote

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.storage import default_storage, resolver
from pagemill.llm.common import stored

FOLDS = 10
PRIOR = 0.1
BASE = 1.5
BITS_PER_MARK = 10
PROBES = 6
#: Tokens that a task counts, and scores, at once.
BLOCK_TOKENS = 600_000
SCORED_TOKENS = 250_000
#: Tokens of the corpus for each segment of bigrams, words for each segment of words.
SEGMENT_TOKENS = 2_000_000
SEGMENT_WORDS = 200_000
FILTER_BYTES = 192 << 20
STREAMED_BYTES = 4 << 30
#: Tokens for which larger filters are read once.
STREAMED_TOKENS = 2_500_000
#: Counts of each filter that a task remembers, a power of two; 16 bytes each.
REMEMBERED = 1 << 20
HOT_WORDS = 200_000
HOT_BYTES = 64
END = b""
_TEXT_BYTES = 1 << 22
_BLANK = re.compile(rb"[\t-\r ]")
#: Whether a byte belongs to a word.
_INK = np.array([not _BLANK.fullmatch(bytes([b])) for b in range(256)])

_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Words' hashes are told apart from their followers' and from one another's by these.
_COUNT, _FOLLOWERS = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers mixed (the finalizer of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Least count of each level, and the count that a level stands for: the middle of its range.
_LEAST = np.ceil(BASE ** np.arange(100))
_MIDDLE = np.concatenate([[0.0], (_LEAST[:-1] + _LEAST[1:] - 1) / 2])


def levels(counts: np.ndarray) -> np.ndarray:
    """Level of each count from 1 on."""
    return np.searchsorted(_LEAST, counts, side="right")


def _mark(level: int, probe: int) -> np.uint64:
    return np.uint64((level * PROBES + probe) * int(_GOLD) % (1 << 64))


def _levels_found(bits: np.ndarray, keys: np.ndarray, sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Levels of keys, each in its filter of ``sizes`` bits from bit ``starts`` on."""
    found = np.zeros(len(keys), np.int64)
    there = None  # all of them
    level = 1
    while len(keys) and level < len(_MIDDLE):
        for probe in range(PROBES):
            at = starts + mixed(keys + _mark(level, probe)) % sizes
            kept = np.flatnonzero(bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1)
            if len(kept) < len(keys):
                there = kept if there is None else there[kept]
                keys, sizes, starts = keys[kept], sizes[kept], starts[kept]
        found[slice(None) if there is None else there] = level
        level += 1
    return found


class LogBloom:
    """Counts by key. ``bits``: the filter as bytes; its number of bits is a multiple of eight."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.size = np.uint64(8 * len(bits))

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray) -> LogBloom:
        marks = levels(counts)
        made = cls(np.zeros(int(marks.sum()) * BITS_PER_MARK // 8 + 8, np.uint8))
        bits = np.zeros(int(made.size), bool)
        level = 1
        while len(keys):
            for probe in range(PROBES):
                bits[made._at(keys, level, probe)] = True
            level += 1
            more = marks >= level
            keys, marks = keys[more], marks[more]
        made.bits = np.packbits(bits, bitorder="little")
        return made

    def _at(self, keys: np.ndarray, level: int, probe: int) -> np.ndarray:
        return mixed(keys + _mark(level, probe)) % self.size

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """The count that each key's level stands for; 0 for keys that are not there."""
        sizes = np.full(len(keys), self.size)
        return _MIDDLE[_levels_found(self.bits, keys, sizes, np.zeros(len(keys), np.uint64))]


class Segmented:
    """A filter in segments by the key's remainder. ``bits``: the segments' bytes one after another; ``sizes``: the bytes of each.

    All segments are probed at once, so that a lookup costs the same for any number of them."""

    def __init__(self, bits: bytes | np.ndarray, sizes: np.ndarray):
        self.bits = np.frombuffer(bits, np.uint8)
        self.sizes = 8 * np.asarray(sizes, np.uint64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def counts(self, keys: np.ndarray, within: np.ndarray | None = None) -> np.ndarray:
        """Counts by key; ``within``: the keys that the segments hold in place of ``keys``."""
        of = (keys % np.uint64(len(self.sizes))).astype(np.int64)
        return _MIDDLE[_levels_found(self.bits, keys if within is None else within, self.sizes[of], self.starts[of])]


class Streamed:
    """A stored filter that is read anew for each lookup, a segment at a time, so that a task never holds more than one."""

    def __init__(self, files: list[str], n: int, storage: str):
        self.files, self.n, self.storage = files, n, storage

    def counts(self, keys: np.ndarray, within: np.ndarray | None = None) -> np.ndarray:
        of = (keys % np.uint64(self.n)).astype(np.int32)
        order = np.argsort(of, kind="stable")
        ends = np.cumsum(np.bincount(of, minlength=self.n))
        keys, out = keys if within is None else within, np.zeros(len(keys))
        for segment, bits in _segments(self.files, self.storage):
            at = order[ends[segment - 1] if segment else 0 : ends[segment]]
            out[at] = LogBloom(bits).counts(keys[at])
        return out


class Recalled:
    """Counts of a filter, and a memory of those it gave last: ``slots`` places, each for the last key asked for of those that share
    it. Words and pairs that return in block after block have the highest counts, so the most marks, and are looked up once."""

    def __init__(self, filter: Segmented, slots: int = REMEMBERED):
        self.filter, self.mask = filter, np.uint64(slots - 1)
        self.keys = np.arange(slots, dtype=np.uint64) ^ np.uint64(1)  # keys of other places, so none is found
        self.held = np.zeros(slots)

    def counts(self, keys: np.ndarray, within: np.ndarray | None = None) -> np.ndarray:
        at = (keys & self.mask).astype(np.int64)
        out = self.held[at]
        new = np.flatnonzero(self.keys[at] != keys)
        out[new] = self.filter.counts(keys[new], None if within is None else within[new])
        self.keys[at[new]], self.held[at[new]] = keys[new], out[new]  # of equal places the last key stays, in both
        return out


def _pieces(text: str) -> Iterator[tuple[bytes, bool]]:
    """A lower-cased text in pieces of bounded size, cut at blanks where there are any, and whether it is the last one."""
    data, start = text.encode(), 0
    while len(data) - start > _TEXT_BYTES:
        blank = _BLANK.search(data, start + _TEXT_BYTES)
        if not blank:
            break
        yield data[start : blank.start()].lower(), False
        start = blank.start()
    yield data[start:].lower(), True


def word_lists(text: str) -> Iterator[list[bytes]]:
    """The tokens of a text in lists of bounded size; the last one ends with the end token."""
    for piece, last in _pieces(text):
        yield piece.split() + [END] * last


class Block(NamedTuple):
    """Tokens of some texts: the different words, their hashes, each token's word and the word before it, and its text."""

    words: list[bytes]
    hashes: np.ndarray
    token: np.ndarray
    before: np.ndarray
    owner: np.ndarray

    def bigrams(self) -> np.ndarray:
        return mixed(self.hashes[self.before] * _GOLD + self.hashes[self.token])


def _objects(words: pa.LargeBinaryArray) -> list[bytes]:
    """What ``to_pylist`` gives, without an Arrow value for each; ``words`` are whole, so their first offset is 0."""
    _, places, values = words.buffers()
    edges, data = np.frombuffer(places, np.int64, len(words) + 1).tolist(), values.to_pybytes() if values else b""
    return [data[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def blocks(texts: Iterator[tuple[int, str]], tokens: int = BLOCK_TOKENS) -> Iterator[Block]:
    """Blocks of about so many tokens of ``(number, text)``; a text may go on in the next block.

    Words are found by their edges and numbered by Arrow in order of their first use, so that a token is never an object of its own."""
    from xxhash import xxh64_intdigest

    inks, lengths, owners, size = [], [], [], 0  # each part begins with the word before it

    def block() -> Block:
        ends = np.cumsum(np.concatenate([[0], *lengths]), dtype=np.int64)
        buffers = [None, pa.py_buffer(ends), pa.py_buffer(np.concatenate(inks))]
        encoded = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, buffers).dictionary_encode()
        numbers, words = encoded.indices.to_numpy(), _objects(encoded.dictionary)
        sizes = np.array([len(x) for x in lengths])
        at = np.delete(np.arange(len(numbers)), np.cumsum(sizes) - sizes)
        hashes = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
        return Block(words, hashes, numbers[at], numbers[at - 1], np.repeat(owners, sizes - 1))

    for number, text in texts:
        before = END
        for piece, last in _pieces(text):
            raw = np.frombuffer(piece, np.uint8)
            ink = _INK[raw]
            around = np.concatenate([[False], ink, [False]])
            edges = np.flatnonzero(around[1:] != around[:-1])
            starts, ends = edges[::2], edges[1::2]
            if n := len(starts) + last:
                inks += [np.frombuffer(before, np.uint8), raw[ink]]
                lengths.append(np.concatenate([[len(before)], ends - starts, [len(END)] * last]).astype(np.int64))
                owners.append(number)
                size += n
            if not last and len(starts):
                before = piece[starts[-1] : ends[-1]]
            if size >= tokens:
                yield block()
                inks, lengths, owners, size = [], [], [], 0
    if size:
        yield block()


def _pack(keys: np.ndarray, size: int) -> bytes:
    """The lower ``size`` bytes of each key."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _unpack(data: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(data) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8).reshape(-1, size)
    return out.reshape(-1).view("<u8")


#: Bytes of a packed key (the rest follows from its segment with all but certainty), of a context's tag, and of a count.
_KEY, _TAG = 6, 5
_TAG_SHIFT = np.uint64(24)


def count_key(hashes: np.ndarray) -> np.ndarray:
    return mixed(hashes ^ _COUNT)


def followers_key(tags: np.ndarray) -> np.ndarray:
    """Of the tags of words, the upper bits of their hashes."""
    return mixed(tags ^ _FOLLOWERS)


def bigram_key(bigrams: np.ndarray, segments: int) -> np.ndarray:
    """Keys within a segment: what ``_pack`` leaves of them."""
    return (bigrams // np.uint64(segments)) & np.uint64((1 << 8 * _KEY) - 1)


def _learns(id: str) -> Column:
    return F.pmod(F.crc32(F.col(id).cast("string").cast("binary")), F.lit(FOLDS)) != 0


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, str]]:
    for batch in batches:
        yield from ((0, t) for t in batch["text"])


def word_counts(training: DataFrame) -> DataFrame:
    """``(word, n)`` of the tokens of ``training`` ``(text)``; the end token is the empty word."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: Counter[bytes] = Counter()
            for text in batch["text"]:
                for words in word_lists(text):
                    found.update(words)
            yield pd.DataFrame({"word": [w.decode() for w in found], "n": list(found.values())}, columns=["word", "n"])

    return training.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _by_segment(keys: np.ndarray, segments: int, /, **values: tuple[np.ndarray, int]) -> pd.DataFrame:
    """One row per segment with its values packed."""
    of = (keys % np.uint64(segments)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    present, first = np.unique(of[order], return_index=True)
    last = np.append(first[1:], len(of))
    return pd.DataFrame(
        {"segment": present}
        | {name: [_pack(v[order[a:b]], size) for a, b in zip(first, last, strict=True)] for name, (v, size) in values.items()}
    )


def _joined(rows: pd.Series, size: int) -> np.ndarray:
    return _unpack(b"".join(rows), size)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys, the place of one of each, and the sums of their counts."""
    found, first, back = np.unique(keys, return_index=True, return_inverse=True)
    return found, first, np.bincount(back, counts, len(found))


class Model(NamedTuple):
    """``words`` ``(word, n)``: exact counts. ``of_bigrams`` and ``of_words`` ``(segment, bits)``: the filters."""

    words: DataFrame
    tokens: int
    vocabulary: int
    discount: float
    of_bigrams: DataFrame
    of_words: DataFrame
    bigram_segments: int
    word_segments: int
    filter_bytes: int


def train(docs: DataFrame, id: str = "doc_id", text: str = "text", segment_tokens: int = SEGMENT_TOKENS, segment_words: int = SEGMENT_WORDS) -> Model:
    """The model of the documents whose ``crc32(id) mod 10`` is not 0."""
    training = docs.where(_learns(id)).select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    words = stored(word_counts(training), "lm-words")
    total = words.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("vocabulary")).first()
    tokens, vocabulary = total["tokens"] or 0, total["vocabulary"]
    n_bigrams, n_words = max(1, -(-tokens // segment_tokens)), max(1, -(-vocabulary // segment_words))

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(_texts(batches)):
            keys, first, n = _summed(block.bigrams(), np.ones(len(block.token)))
            tags = block.hashes[block.before[first]] >> _TAG_SHIFT
            yield _by_segment(
                keys, n_bigrams, keys=(bigram_key(keys, n_bigrams), _KEY), tags=(tags, _TAG), counts=(n.astype(np.uint64), 4)
            )

    def bigram_filter(group: pd.DataFrame) -> pd.DataFrame:
        keys, first, n = _summed(_joined(group["keys"], _KEY), _joined(group["counts"], 4))
        tags, _, followers = _summed(_joined(group["tags"], _TAG)[first], np.ones(len(first)))
        bits = LogBloom.of(keys, n).bits.tobytes()
        parts = _by_segment(followers_key(tags), n_words, tags=(tags, _TAG), counts=(followers.astype(np.uint64), 4))
        own = {"bits": [bits], "once": [int((n == 1).sum())], "twice": [int((n == 2).sum())], "segment": [group["segment"].iloc[0]]}
        return pd.concat([pd.DataFrame(own).assign(tags=None, counts=None), parts.assign(bits=None, once=None, twice=None)], ignore_index=True).astype(
            {"once": "Int64", "twice": "Int64"}
        )

    packed = training.mapInPandas(pairs, "segment long, keys binary, tags binary, counts binary")
    made = stored(
        packed.groupBy("segment").applyInPandas(bigram_filter, "segment long, bits binary, once long, twice long, tags binary, counts binary"),
        "lm-bigrams",
    )

    def of_word(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            if len(batch):
                keys = count_key(np.array([xxh64_intdigest(w.encode()) for w in batch["word"]], np.uint64))
                yield _by_segment(keys, n_words, keys=(keys, 8), counts=(batch["n"].to_numpy(np.uint64), 8)).assign(tags=None)

    def word_filter(group: pd.DataFrame) -> pd.DataFrame:
        own, of_tags = group[group["keys"].notna()], group[group["tags"].notna()]
        tags, _, followers = _summed(_joined(of_tags["tags"], _TAG), _joined(of_tags["counts"], 4))
        keys = np.concatenate([_joined(own["keys"], 8), followers_key(tags)])
        made = LogBloom.of(keys, np.concatenate([_joined(own["counts"], 8), followers]))
        return pd.DataFrame({"segment": [group["segment"].iloc[0]], "bits": [made.bits.tobytes()]})

    own = words.mapInPandas(of_word, "segment long, keys binary, tags binary, counts binary")
    of_tags = made.where("tags is not null").select("segment", F.lit(None).cast("binary").alias("keys"), "tags", "counts")
    of_words = stored(own.unionByName(of_tags).groupBy("segment").applyInPandas(word_filter, "segment long, bits binary"), "lm-word-filter")
    of_bigrams = made.where("bits is not null")
    size = F.sum(F.octet_length("bits")).alias("size")
    seen = of_bigrams.agg(size, F.sum("once").alias("once"), F.sum("twice").alias("twice")).first()
    once, twice = seen["once"] or 0, seen["twice"] or 0
    discount = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
    filter_bytes = (seen["size"] or 0) + (of_words.agg(size).first()["size"] or 0)
    return Model(words, tokens, vocabulary, discount, of_bigrams.select("segment", "bits"), of_words, n_bigrams, n_words, filter_bytes)


class Probabilities:
    """log10 probabilities of tokens from counts that the filters give."""

    def __init__(self, model: Model):
        self.discount = model.discount
        self.norm = model.tokens + PRIOR * (model.vocabulary + 1)

    def logs(self, pair: np.ndarray, context: np.ndarray, followers: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Of counts of the bigram, its first word, that word's followers, and its second word."""
        alone = (word + PRIOR) / self.norm
        known = context > 0
        of = np.where(known, context, 1.0)
        pair, followers = np.minimum(pair, of), np.minimum(followers, of)
        after = np.maximum(pair - self.discount, 0) / of + self.discount * followers / of * alone
        # a context is known by its followers, too; without any the word stands alone
        return np.log10(np.minimum(1.0, np.where(known & (followers > 0), after, alone)))


def _sizes(filters: DataFrame, n: int) -> np.ndarray:
    """The bytes of each segment of a filter."""
    sizes = np.full(n, 8)
    for r in filters.select("segment", F.octet_length("bits").alias("size")).collect():
        sizes[r["segment"]] = r["size"]
    return sizes


def _files(filters: DataFrame) -> list[str]:
    return [unquote(f) for f in filters.inputFiles()]


def _reachable(files: list[str], storage: str) -> bool:
    """Whether tasks can open the files themselves."""
    try:
        resolve = resolver(storage)
        return all(system.get_file_info(place).is_file for system, place in map(resolve, files[:1]))
    except Exception:  # a scheme that pyarrow does not know, or whose library is missing
        return False


def _segments(files: list[str], storage: str) -> Iterator[tuple[int, np.ndarray]]:
    """The segments of a stored filter, one after another."""
    import pyarrow.parquet as pq

    resolve = resolver(storage)
    for name in files:
        system, place = resolve(name)
        with system.open_input_file(place) as file:
            for batch in pq.ParquetFile(file, buffer_size=1 << 20).iter_batches(1, columns=["segment", "bits"], use_threads=False):
                for segment, bits in zip(batch["segment"].to_pylist(), batch["bits"], strict=True):
                    if bits.is_valid:
                        yield segment, np.frombuffer(bits.as_buffer(), np.uint8)


def _read(files: list[str], sizes: np.ndarray, storage: str) -> Segmented:
    """A stored filter in a task. Broadcast, it would stay in all Python processes of an executor, of which there are more than tasks."""
    ends = np.cumsum(sizes)
    data = np.zeros(int(ends[-1]), np.uint8)
    for segment, bits in _segments(files, storage):
        end = int(ends[segment])
        data[end - len(bits) : end] = bits
    return Segmented(data, sizes)


_SCORED = (
    "row long, id string, held_out boolean, n_tokens long, hot_known long, hot_sum double, score double, "
    "rare array<string>, times array<int>, pairs array<long>, contexts array<long>, followers array<long>, words array<long>, counts array<int>"
)
_SCORED_NAMES = re.findall(r"(\w+) \w+(?:<\w+>)?(?:, |$)", _SCORED)
_TERMS = ("pairs", "contexts", "followers", "words")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole rows whose texts have about ``_TEXT_BYTES`` bytes."""
    for batch in batches:
        filled = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64))
        cuts = np.flatnonzero(np.diff(filled // _TEXT_BYTES)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(filled)], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def _per_row(owners: list[np.ndarray], values: list[pa.Array], kind: pa.DataType, rows: int) -> pa.ListArray:
    """Lists of the ``values`` that belong to each row; ``owners``, the rows of each array of them, never fall."""
    ends = np.searchsorted(np.concatenate([np.zeros(0, np.int64), *owners]), np.arange(rows + 1))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays([pa.array([], kind), *values]))


class _Waiting(NamedTuple):
    """A block whose bigrams are not yet looked up: the different ones, the words of each, each token's bigram and text, and where to add."""

    hashes: np.ndarray
    pairs: np.ndarray
    u: np.ndarray
    w: np.ndarray
    which: np.ndarray
    owner: np.ndarray
    total: np.ndarray


def frequent_words(words: DataFrame, most: int = HOT_WORDS) -> DataFrame:
    """At most so many of the most frequent words: all down to some count. So few words go to the driver, whatever the number of tasks."""
    short = words.where(F.octet_length("word") <= HOT_BYTES)
    # different counts are fewer than the root of twice the tokens
    by_count = short.groupBy("n").agg(F.count(F.lit(1)).alias("of")).orderBy(F.col("n").desc()).collect()
    reached = np.cumsum([r["of"] for r in by_count])
    fit = int(np.searchsorted(reached, most, side="right"))
    return short.where(F.col("n") >= by_count[fit - 1]["n"]) if fit else short.where("false")


def _remainder(key: Column, n: int) -> Column:
    """The remainder of a key, a long that stands for 64 bits without a sign."""
    return ((F.shiftrightunsigned(key, 1) % n) * 2 + key.bitwiseAND(F.lit(1).cast("long"))) % n


def _looked_up(keys: DataFrame, filters: DataFrame, n: int, of_bigrams: bool) -> DataFrame:
    """``(key, count)`` of the different keys of ``keys``, by the segments they lie in."""

    def look(asked: pd.DataFrame, segment: pd.DataFrame) -> pd.DataFrame:
        raw = asked["key"].to_numpy(np.int64)
        if not len(raw) or not len(segment):
            return pd.DataFrame({"key": raw, "count": np.zeros(len(raw))})
        keys = raw.view(np.uint64)
        part = LogBloom(np.frombuffer(segment["bits"].iloc[0], np.uint8))
        return pd.DataFrame({"key": raw, "count": part.counts(bigram_key(keys, n) if of_bigrams else keys)})

    asked = keys.distinct().withColumn("segment", _remainder(F.col("key"), n))
    return asked.groupBy("segment").cogroup(filters.groupBy("segment")).applyInPandas(look, "key long, count double")


def _scores_of_terms(scored: DataFrame, model: Model) -> DataFrame:
    """``(row, score)`` where the filters stay in their segments."""
    probabilities = Probabilities(model)
    zipped = scored.select("row", F.explode(F.arrays_zip(*_TERMS, "counts")).alias("t")).select("row", "t.*")
    of_words = [zipped.select(F.col(c).alias("key")) for c in _TERMS[1:]]
    words = stored(_looked_up(of_words[0].union(of_words[1]).union(of_words[2]), model.of_words, model.word_segments, False), "lm-word-counts")
    pairs = stored(_looked_up(zipped.select(F.col("pairs").alias("key")), model.of_bigrams, model.bigram_segments, True), "lm-pair-counts")
    joined = zipped
    for c, counts in zip(_TERMS, (pairs, words, words, words), strict=True):
        of = counts.select(F.col("key").alias(f"key_{c}"), F.col("count").alias(f"count_{c}"))
        joined = joined.join(of, F.col(c) == F.col(f"key_{c}")).drop(f"key_{c}")

    @F.pandas_udf("double")
    def logs(pair: pd.Series, context: pd.Series, followers: pd.Series, word: pd.Series) -> pd.Series:
        return pd.Series(probabilities.logs(*(x.to_numpy(np.float64) for x in (pair, context, followers, word))))

    log = logs(*[F.col(f"count_{c}") for c in _TERMS])
    return joined.groupBy("row").agg(F.sum(log * F.col("counts")).alias("of_terms"))


def score(
    docs: DataFrame,
    model: Model,
    id: str = "doc_id",
    text: str = "text",
    filter_bytes: int = FILTER_BYTES,
    hot_words: int = HOT_WORDS,
    streamed_bytes: int = STREAMED_BYTES,
) -> DataFrame:
    """``(<id>, held_out, n_tokens, n_known, train_tokens, base_score, score)``, a row per row of ``docs``."""
    context = docs.sparkSession.sparkContext
    storage, stored_filters = default_storage(docs.sparkSession), []
    held = model.filter_bytes <= filter_bytes
    if fits := model.filter_bytes <= max(filter_bytes, streamed_bytes):
        parts = ((model.of_bigrams, model.bigram_segments), (model.of_words, model.word_segments))
        stored_filters = [(_files(filters), _sizes(filters, n) if held else n) for filters, n in parts]
        fits = all(_reachable(files, storage) for files, _ in stored_filters)
    frequent = frequent_words(model.words, hot_words)
    hot = context.broadcast({r["word"].encode(): r["n"] for r in frequent.collect()})  # hot_words words of HOT_BYTES bytes at most
    probabilities, n_bigrams = Probabilities(model), model.bigram_segments

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = hot.value
        of_bigrams, of_words = None, None
        waiting: list[_Waiting] = []  # and their slices, which are given out once all blocks before them are looked up
        slices: list[tuple[list, np.ndarray, list]] = []
        n_waiting = 0

        def logs(pairs: np.ndarray, u: np.ndarray, w: np.ndarray, words: np.ndarray, tags: np.ndarray, counts: np.ndarray | None = None) -> np.ndarray:
            """log10 probabilities of different bigrams."""
            counts = of_bigrams.counts(pairs, bigram_key(pairs, n_bigrams)) if counts is None else counts
            return probabilities.logs(counts, words[u], tags[u], words[w])

        def look_up() -> None:
            nonlocal n_waiting
            hashes, back = np.unique(np.concatenate([x.hashes for x in waiting]), return_inverse=True)
            found = of_words.counts(np.concatenate([count_key(hashes), followers_key(hashes >> _TAG_SHIFT)]))
            words, tags = found[: len(hashes)], found[len(hashes) :]
            pairs, place = np.unique(np.concatenate([x.pairs for x in waiting]), return_inverse=True)
            counts = of_bigrams.counts(pairs, bigram_key(pairs, n_bigrams))[place]  # those that return have the most marks
            at = first = 0
            for x in waiting:
                of = back[first : first + len(x.hashes)]
                log = logs(x.pairs, of[x.u], of[x.w], words, tags, counts[at : at + len(x.pairs)])
                x.total[:] += np.bincount(x.owner, log[x.which], len(x.total))
                at, first = at + len(x.pairs), first + len(x.hashes)
            waiting.clear()
            n_waiting = 0

        def given_out() -> Iterator[pa.RecordBatch]:
            for before, total, after in slices:
                yield pa.RecordBatch.from_arrays([*before, pa.array(total), *after], _SCORED_NAMES)
            slices.clear()

        for batch in _slices(batches):
            if fits and of_bigrams is None:
                opened = [Recalled(_read(*f, storage)) if held else Streamed(*f, storage) for f in stored_filters]
                of_bigrams, of_words = opened
            n = batch.num_rows
            n_tokens, hot_known, hot_sum, total = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            owners: dict[str, list[np.ndarray]] = {"rare": [], "terms": []}
            values: dict[str, list[pa.Array]] = {c: [] for c in ("rare", "times", *_TERMS, "counts")}
            for block in blocks(enumerate(batch["text"].to_pylist()), SCORED_TOKENS):
                known = np.array([exact.get(w, -1) for w in block.words], np.float64)
                log = np.log10(np.maximum(known, 0) + PRIOR)
                is_hot = known[block.token] >= 0
                owner, token = block.owner[is_hot], block.token[is_hot]
                n_tokens += np.bincount(block.owner, minlength=n)
                hot_known += np.bincount(owner, minlength=n)
                hot_sum += np.bincount(owner, log[token], n)
                both, often = np.unique(block.owner[~is_hot] * len(block.words) + block.token[~is_hot], return_counts=True)
                owners["rare"].append(both // len(block.words))
                values["rare"].append(pa.array(block.words, pa.binary()).take(pa.array(both % len(block.words))).cast(pa.string()))
                values["times"].append(pa.array(often, pa.int32()))
                pairs, first, which = np.unique(block.bigrams(), return_index=True, return_inverse=True)
                u, w = block.before[first], block.token[first]
                if fits and held:
                    words, tags = of_words.counts(count_key(block.hashes)), of_words.counts(followers_key(block.hashes >> _TAG_SHIFT))
                    total += np.bincount(block.owner, logs(pairs, u, w, words, tags)[which], n)
                    continue
                if fits:
                    small = (x.astype(np.int32) for x in (u, w, which, block.owner))
                    waiting.append(_Waiting(block.hashes, pairs, *small, total))
                    n_waiting += len(block.token)
                    if n_waiting >= STREAMED_TOKENS:
                        look_up()
                    continue
                both, often = np.unique(block.owner * len(pairs) + which, return_counts=True)
                pair = both % len(pairs)
                u, w = block.hashes[u[pair]], block.hashes[w[pair]]
                owners["terms"].append(both // len(pairs))
                for c, of in zip(_TERMS, (pairs[pair], count_key(u), followers_key(u >> _TAG_SHIFT), count_key(w)), strict=True):
                    values[c].append(pa.array(of.view(np.int64)))
                values["counts"].append(pa.array(often, pa.int32()))
            kinds = {c: pa.int64() for c in _TERMS} | {"rare": pa.string(), "times": pa.int32(), "counts": pa.int32()}
            lists = [_per_row(owners["rare" if c in ("rare", "times") else "terms"], x, kinds[c], n) for c, x in values.items()]
            slices.append(([batch["row"], batch["id"], batch["held_out"], *map(pa.array, (n_tokens, hot_known, hot_sum))], total, lists))
            if not waiting:
                yield from given_out()
        if waiting:
            look_up()
        yield from given_out()

    given = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id).cast("string").alias("id"),
        F.coalesce(~_learns(id), F.lit(False)).alias("held_out"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    scored = stored(given.mapInArrow(run, _SCORED), "lm-scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", "r.*")
    of_rare = rare.join(model.words, rare["rare"] == model.words["word"], "left").select("row", "times", F.coalesce("n", F.lit(0)).alias("n"))
    summed = of_rare.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10(F.col("n") + F.lit(PRIOR))).alias("rare_sum"),
    )
    whole = scored.drop("rare", "times", *_TERMS, "counts").join(summed, "row", "left")
    if not fits:
        whole = whole.drop("score").join(_scores_of_terms(scored, model).withColumnRenamed("of_terms", "score"), "row")
    base = F.col("hot_sum") + F.coalesce("rare_sum", F.lit(0.0)) - F.col("n_tokens") * F.log10(F.lit(float(probabilities.norm)))
    return whole.select(
        F.col("id").cast(docs.schema[id].dataType).alias(id),
        "held_out",
        "n_tokens",
        (F.col("hot_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )
