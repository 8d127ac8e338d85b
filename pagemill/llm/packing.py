"""Packing of tokenized documents into sequences of fixed capacity: dominance reduction, then best fit.

Each document is its tokens and one end token; only documents longer than a sequence are cut. All that packing needs to
know is how many pieces there are of each length, so it runs on that histogram (at most ``capacity`` rows, whatever the
corpus) and places whole counts at a time. Its result is a list of ranges, "pieces number r to r + n of length w go to
sequences b to b + n at offset o", which Spark joins back to the pieces.

Reduction (Martello and Toth): for the longest open length, the longest partner that fits beside it dominates every other
set that could stand beside it if no other such set holds more tokens. That is proved where the two fill the sequence, and where
no two pieces fit beside the longest at all; sets of two that fit and hold less are not told from those that hold more, so what they
leave open goes to best fit. Proved sequences are closed for good. Best fit places what remains, longest first,
each piece into the fullest sequence that can take it.

Defined results: a null text counts as empty and yields the end token alone. Rows with equal ids are packed each for
itself. No rows give no sequences. Other columns are dropped from the pieces but for the id.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.bpe import byte_alphabet
from pagemill.llm.common import stored
from pagemill.llm.segments import Memo, library_tokenizer, task_memory, words

CAPACITY = 4096
END_TOKEN = 1
#: Buckets in which pieces of one length are numbered; a bucket of one length is sorted in one task.
BUCKETS = 1024


#: Words without characters past U+017F, for which there is nothing to compose and lower case is one to one.
_PLAIN = re.compile("[^\u0180-\U0010ffff\x1c-\x1f\u0130]*")
_LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f"
_DIGITS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_PARTS = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{_LETTERS}]+|[{_DIGITS}]|[^\s{_LETTERS}{_DIGITS}]+")


def tokenizer_parts(word: str) -> list[str] | None:
    """The tokenizer's own pieces of a word (runs of letters, single digits, runs of signs) in lower case; None for a word
    with characters of which only the tokenizer knows what it makes."""
    if "<|" not in word and _PLAIN.fullmatch(word):
        return _PARTS.findall(word.lower())
    return None


@lru_cache(maxsize=2)
def _word_ids(path: str) -> Memo:
    """Ids of words, from the ids of their parts, which many words share."""
    tokenizer = library_tokenizer(path)
    merge = tokenizer.model.tokenize
    shown = {byte: character for character, byte in byte_alphabet().items()}

    def of_parts(parts: list[str]) -> list[bytes]:
        written = [p.encode().decode("latin-1").translate(shown) for p in parts]
        return [array("I", [t.id for t in merge(w)]).tobytes() for w in written]

    known = Memo(of_parts, entries=300_000)

    def of_words(pieces: list[str]) -> list[bytes]:
        cut = [tokenizer_parts(p) for p in pieces]
        ids = iter(known.of([x for parts in cut if parts for x in parts]))
        return [
            array("I", tokenizer.encode(p, add_special_tokens=False).ids).tobytes()
            if parts is None
            else b"".join([next(ids) for _ in parts])
            for p, parts in zip(pieces, cut, strict=True)
        ]

    return Memo(of_words, entries=500_000)


def document_ids(text: str, path: str) -> bytes:
    """Ids of a text as little-endian 32-bit integers."""
    return b"".join(_word_ids(path).of(words(text)))


def tokenized_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END_TOKEN, id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids`` (binary)."""
    kind = "array<struct<piece:int,start:long,length:long,ids_crc32:long" + (",ids:binary" if with_ids else "") + ">>"
    tail = np.array([end], "<u4").tobytes()

    @F.pandas_udf(kind)
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with task_memory():
            for batch in batches:
                rows = []
                for t in batch:
                    data = document_ids(t, path) + tail
                    parts = []
                    for k, at in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[at : at + 4 * capacity]
                        one = {"piece": k, "start": at // 4, "length": len(part) // 4, "ids_crc32": zlib.crc32(part)}
                        parts.append(one | {"ids": part} if with_ids else one)
                    rows.append(parts)
                yield pd.Series(rows)

    return docs.select(F.col(id), F.explode(cut(F.coalesce(F.col(text), F.lit("")))).alias("p")).select(id, "p.*")


class _Plan:
    """Open pieces by length, and the ranges placed so far."""

    def __init__(self, counts: dict[int, int]):
        self.open = {w: n for w, n in counts.items() if n > 0}
        self.lengths = sorted(self.open)
        self.placed = dict.fromkeys(self.open, 0)
        self.ranges: list[tuple[int, int, int, int, int]] = []  # length, first number, count, first sequence, offset
        self.sequences = 0

    def place(self, length: int, count: int, sequence: int, offset: int) -> None:
        self.ranges.append((length, self.placed[length], count, sequence, offset))
        self.placed[length] += count
        self.open[length] -= count
        if not self.open[length]:
            del self.open[length]
            self.lengths.remove(length)

    def at_most(self, limit: int, without: int) -> int | None:
        """The longest open length up to ``limit``; the last piece of length ``without`` does not count."""
        k = bisect_right(self.lengths, limit) - 1
        if k >= 0 and self.lengths[k] == without and self.open[without] < 2:
            k -= 1
        return self.lengths[k] if k >= 0 else None


def _two_fit(plan: _Plan, room: int, without: int) -> bool:
    """Whether any two open pieces fit into ``room`` beside one of ``without``; only then can a larger set hold more than one partner."""
    smallest = [w for w in plan.lengths[:3] for _ in range(min(2, plan.open[w] - (w == without)))][:2]
    return len(smallest) == 2 and sum(smallest) <= room


def reduce_dominated(plan: _Plan, capacity: int) -> None:
    """Closes every sequence that provably dominates its alternatives, from the longest length down, until none is left."""
    changed = True
    while changed:
        changed = False
        for length in sorted(plan.lengths, reverse=True):
            while length in plan.open:
                room = capacity - length
                partner = plan.at_most(room, length)
                if partner is None:
                    count = plan.open[length] if length > room else 1
                    plan.place(length, count, plan.sequences, 0)
                elif partner == room or not _two_fit(plan, room, length):
                    same = partner == length
                    count = plan.open[length] // 2 if same else min(plan.open[length], plan.open[partner])
                    first = plan.sequences
                    plan.place(length, count, first, 0)
                    plan.place(partner, count, first, length)
                else:
                    break
                plan.sequences += count
                changed = True


def best_fit(plan: _Plan, capacity: int) -> None:
    """Places the open pieces, longest first, into the fullest sequence of its own that can take them, else into a new one."""
    rooms: list[int] = []  # sorted, distinct
    groups: dict[int, list[tuple[int, int]]] = {}  # room: ranges of sequences (first, count)

    def keep(room: int, first: int, count: int) -> None:
        if room:
            if room not in groups:
                groups[room] = []
                insort(rooms, room)
            groups[room].append((first, count))

    for length in sorted(plan.lengths, reverse=True):
        while length in plan.open:
            k = bisect_right(rooms, length - 1)
            if k < len(rooms):
                room = rooms[k]
                first, there = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    rooms.pop(k)
            else:
                room, first = capacity, plan.sequences
                there = -(-plan.open[length] // (capacity // length))
                plan.sequences += there
            fit = min(room // length, -(-plan.open[length] // there))
            for level in range(fit):  # the sequences of a range take one piece each, then the next one
                left = plan.open.get(length, 0)
                count = min(left, there)
                if not count:
                    break
                plan.place(length, count, first, capacity - room)
                if count < there:
                    keep(room, first + count, there - count)
                there, room = count, room - length
            keep(room, first, there)


def pack_lengths(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Ranges ``(length, first number, count, first sequence, offset)`` and the number of sequences."""
    plan = _Plan(counts)
    reduce_dominated(plan, capacity)
    best_fit(plan, capacity)
    return plan.ranges, plan.sequences


def numbered(pieces: DataFrame, id: str = "doc_id", buckets: int = BUCKETS) -> DataFrame:
    """``pieces`` with ``number``: 0, 1, 2.. among those of equal length. No length is ever gathered in one task."""
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64(id, "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    within = Window.partitionBy("_bucket", "length").orderBy(id, "piece", "ids_crc32")
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(
        dealt.groupBy("_bucket", "length").agg(F.count(F.lit(1)).alias("n")).withColumn("_first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"),
        "packing-starts",
    )
    local = dealt.withColumn("_local", F.row_number().over(within) - 1)
    return local.join(starts, ["_bucket", "length"]).withColumn("number", (F.col("_first") + F.col("_local")).cast("long")).drop("_bucket", "_first", "_local")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END_TOKEN, id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """``tokenized_pieces`` of ``docs`` with ``sequence_id`` and ``offset``."""
    spark = docs.sparkSession
    pieces = stored(tokenized_pieces(docs, path, capacity, end, id, text, with_ids), "packing-pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    ranges, _ = pack_lengths(counts, capacity)
    table = np.array(sorted(ranges), np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(table)  # grows with the number of lengths, not with the corpus

    @F.pandas_udf("sequence_id long, offset long")
    def locate(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        t = shared.value
        keys = t[:, 0] * (1 << 48) + t[:, 1]
        at = np.searchsorted(keys, length.to_numpy() * (1 << 48) + number.to_numpy(), side="right") - 1
        return pd.DataFrame({"sequence_id": t[at, 3] + number.to_numpy() - t[at, 1], "offset": t[at, 4]})

    found = numbered(pieces, id).withColumn("_place", locate("length", "number"))
    return found.select(*pieces.columns, "_place.sequence_id", "_place.offset")
