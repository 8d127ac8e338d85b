"""Two tokenizers aligned on the bytes of a text, and how often their tokens meet, by inverted bitmaps.

A document's text, with a space before it, is encoded by a byte-level BPE file (A) and a sentencepiece model (B) that adds that space.
Both cut the same bytes into tokens: where tokens of both end, a group ends; an A and a B token whose byte ranges overlap are a
link. Between a character that is not white space and a space neither of them joins bytes, so a text is aligned in segments that
start with such a space (but for one at its end), and tasks keep the alignments of segments they have seen (a bounded memory).

Each task deals its documents into chunks of up to ``CHUNK_ROWS`` rows and ``CHUNK_LINKS`` id pairs. For each id pair linked in a
chunk there is one posting: a compressed bitmap of the chunk's documents (sorted 16-bit places, or plain bits where they are
shorter), and multiplicity planes, bitmaps of the documents in whose number of links, less one, the bit of the plane is set. The
bitmaps of a pair are OR-merged: those of one chunk by their bits (``merge``), those of different chunks by standing side by
side, as their documents differ. Their population counts add up to the number of documents that hold the pair linked. These
counts are the pairs' scores; those of a chunk's pairs go to the chunk, where the postings return them to its documents, each link by
its multiplicity. So a frequent pair is one row a chunk, not one row a document, and a task holds one chunk.

Defined results: texts that are null, empty, or not cut into the same bytes by both (U+2581 in a text, for example) have no tokens: zeros
and an empty digest. Repeated rows and ids are documents of their own. An empty table gives an empty table. Columns other than the id are
not carried. Texts without a space are one segment, as long as the text is.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.bpe import PRE_TOKEN, byte_alphabet
from pagemill.llm.common import stored
from pagemill.llm.segments import Memo, library_tokenizer, task_memory

CHUNK_ROWS = 1 << 15
CHUNK_LINKS = 2_000_000
#: Bytes of a bitmap of plain bits; fewer places than half of it are held as sorted places of two bytes.
PLAIN = CHUNK_ROWS // 8
#: A space at the end of a text stays in the segment before it: B gives an empty segment no tokens.
CUT = re.compile(r" (?<=\S )(?!\Z)")
_SIGNS, _LETTERS = ".,;:!?)", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZßàáâäæçèéêëíîïñóôöœúûü"
_SHIFT = 20
#: Texts, and characters of them, that are encoded at once.
_AT_ONCE, _CHARS_AT_ONCE = 64, 1 << 20
RESULTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class Piece(NamedTuple):
    """The alignment of a segment. ``codes``: its links, A id times 2**20 + B id. ``joined``: bytes of both, if they are not the segment's."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str
    codes: bytes
    joined: tuple[bytes, bytes] | None


def align(a: list[int], a_sizes: list[int], b: list[int], b_sizes: list[int]) -> tuple[int, str, list[int]]:
    """Number of groups, the groups as text and the codes of the links of two sequences of tokens over the same bytes; sizes are
    the tokens' bytes."""
    groups, codes = [], []
    start_a = start_b = end_a = end_b = ka = kb = 0
    while ka < len(a):
        if end_a <= end_b:  # both ended at one place, or A lies behind
            if ka > start_a:
                codes.append(a[ka] << _SHIFT | b[kb - 1])  # it begins inside of the last token of B
            end_a += a_sizes[ka]
            ka += 1
        while end_b < end_a:
            codes.append(a[ka - 1] << _SHIFT | b[kb])
            end_b += b_sizes[kb]
            kb += 1
        if end_a == end_b:
            groups.append(f"{','.join(map(str, a[start_a:ka]))}|{','.join(map(str, b[start_b:kb]))}")
            start_a, start_b = ka, kb
    return len(groups), ";".join(groups), codes


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor

        self.a = library_tokenizer(path_a)
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, special = spec["model"]["vocab"], {t["content"] for t in spec["added_tokens"]}
        of_token = {token: bytes(alphabet[c] for c in token) for token in vocabulary if token not in special}
        self.bytes_a = {vocabulary[token]: data for token, data in of_token.items()}
        self.ranked = self._ranked(spec, vocabulary, of_token)
        self.b = SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = {i: len(x) for i, x in self.bytes_a.items()}, list(map(len, self.bytes_b))
        self.length_a, self.length_b = np.zeros(max(self.size_a) + 1, np.int64), np.array(self.size_b, np.int64)
        self.length_a[list(self.size_a)] = list(self.size_a.values())
        most = max(len(self.length_a), len(pieces))
        self.shown = [[f"{i}{mark}" for i in range(most)] for mark in ",|;"]
        side_by_side = {p[k : k + 2] for i, p in enumerate(pieces) if not self.b.is_byte(i) for k in range(len(p) - 1)}
        self.cuts = not any(x[0] != "▁" and x[1] == "▁" for x in side_by_side)
        # A sign behind a letter that no piece of B has side by side is a token of its own in both.
        signs = {c: (of_token.get(c), self.b.piece_to_id(c)) for c in _SIGNS}
        self.signs = {c: self._piece(c.encode(), [vocabulary[c]], [i]) for c, (data, i) in signs.items() if data and self.bytes_b[i] == data}
        self.apart = {x + c for x in _LETTERS for c in self.signs} - side_by_side
        self.stems = Memo(self._encoded, entries=100_000, longest=48)
        self.pieces = Memo(self._aligned, entries=150_000, longest=48)

    @staticmethod
    def _ranked(spec: dict, vocabulary: dict[str, int], of_token: dict[str, bytes]):
        """The vocabulary as ranks, for a faster encoder, where ids grow with the order of merges; else None."""
        import tiktoken

        made = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in spec["model"]["merges"]]
        ids = [vocabulary[m] for m in made]
        first = len(of_token) - len(ids)
        if ids != list(range(first, first + len(ids))) or spec.get("normalizer"):
            return None
        ranks = {data: vocabulary[token] for token, data in of_token.items()}
        return tiktoken.Encoding("own", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})

    def _ids(self, texts: list[str]) -> list[list[int]]:
        if self.ranked:
            return [self.ranked.encode_ordinary(t) for t in texts]
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded(self, segments: list[str]) -> list[Piece]:
        """Alignments of many segments, as those of one text that they make up: both tokenizers cut between them."""
        data = [(" " + s).encode() for s in segments]
        of_a, of_b = self._ids([" " + s for s in segments]), self.b.encode(segments, num_threads=1)
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (of_a, of_b))
        a, b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (of_a, of_b))
        whole, border = b"".join(data), np.cumsum([len(d) for d in data])
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        last_a, last_b = np.cumsum(n_a), np.cumsum(n_b)
        if (
            b"".join(map(self.bytes_a.__getitem__, a.tolist())) != whole
            or b"".join(map(self.bytes_b.__getitem__, b.tolist())) != whole
            or (ends_a[last_a - 1] != border).any()
            or (ends_b[last_b - 1] != border).any()
        ):
            return [self._piece(d, x, y) for d, x, y in zip(data, of_a, of_b, strict=True)]
        # links: the tokens of B from the one that holds the first byte of a token of A to the one that holds its last
        first = np.searchsorted(ends_b, ends_a - self.length_a[a], side="right")
        n_links = np.searchsorted(ends_b, ends_a, side="left") - first + 1
        of_link = np.repeat(np.arange(len(a)), n_links)
        upto = np.cumsum(n_links)
        codes = a[of_link] << _SHIFT | b[np.arange(upto[-1]) - (upto - n_links - first)[of_link]]
        # groups: tokens of A, then of B, up to each common end
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        side = np.concatenate([2 * np.searchsorted(common, ends_a), 2 * np.searchsorted(common, ends_b) + 1])
        order = np.argsort(side, kind="stable")
        side, ids = side[order], np.concatenate([a, b])[order]
        mark = np.where(np.append(side[1:] != side[:-1], True), 1 + side % 2, 0)
        shown = self.shown
        texts = [shown[m][i] for m, i in zip(mark.tolist(), ids.tolist(), strict=True)]
        n_groups = np.diff(np.searchsorted(common, border, side="right"), prepend=0)
        raw, of_code = codes.tobytes(), 8 * np.append(0, upto[last_a - 1])
        of_text = np.append(0, last_a + last_b)
        return [
            Piece(x, y, n, "".join(texts[t0:t1])[:-1], raw[c0:c1], None)
            for x, y, n, t0, t1, c0, c1 in zip(
                n_a.tolist(), n_b.tolist(), n_groups.tolist(), of_text[:-1].tolist(), of_text[1:].tolist(),
                of_code[:-1].tolist(), of_code[1:].tolist(), strict=True,
            )
        ]

    def _aligned(self, segments: list[str]) -> list[Piece]:
        apart, signs = self.apart, self.signs
        stems = [s[:-1] if s[-2:] in apart else s for s in segments]
        return [
            p if len(stem) == len(s) else _joined(p, signs[s[-1]], s[-1])
            for s, stem, p in zip(segments, stems, self.stems.of(stems), strict=True)
        ]

    def _piece(self, data: bytes, a: list[int], b: list[int]) -> Piece:
        bytes_a, bytes_b = self.bytes_a, self.bytes_b
        joined = b"".join([bytes_a[i] for i in a]), b"".join([bytes_b[i] for i in b])
        if joined != (data, data):
            return Piece(0, 0, 0, "", b"", joined)
        if len(a) == len(b) == 1:
            return Piece(1, 1, 1, f"{a[0]}|{b[0]}", (a[0] << _SHIFT | b[0]).to_bytes(8, sys.byteorder), None)
        size_a, size_b = self.size_a, self.size_b
        n, groups, codes = align(a, [size_a[i] for i in a], b, [size_b[i] for i in b])
        return Piece(len(a), len(b), n, groups, array("q", codes).tobytes(), None)

    def of_texts(self, texts: list[str]) -> list[tuple[int, int, int, str, np.ndarray] | None]:
        """For each text its tokens of A and B, groups, the groups' digest and the codes of its links; None if it has no tokens."""
        segments = [(CUT.split(t) if self.cuts else [t]) if t else [] for t in texts]
        found, at, out = self.pieces.of([s for of_text in segments for s in of_text]), 0, []
        for of_text in segments:
            pieces = found[at : at + len(of_text)]
            at += len(of_text)
            # a segment that differs is longer or shorter in its tokens than it is, and so is the text
            out.append(None if not pieces or any([p[5] for p in pieces]) else _summary(pieces))
        return out


def _summary(pieces: list[Piece]) -> tuple[int, int, int, str, np.ndarray]:
    n_a, n_b, n_groups, groups, codes, _ = zip(*pieces, strict=True)
    digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
    return sum(n_a), sum(n_b), sum(n_groups), digest, np.frombuffer(b"".join(codes), np.int64)


def _joined(stem: Piece, sign: Piece, c: str) -> Piece:
    if stem.joined:
        return stem._replace(joined=(stem.joined[0] + c.encode(), stem.joined[1] + c.encode()))
    return Piece(stem.n_a + 1, stem.n_b + 1, stem.n_groups + 1, f"{stem.groups};{sign.groups}", stem.codes + sign.codes, None)


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def pack(places: np.ndarray) -> bytes:
    """The compressed bitmap of sorted distinct places."""
    if 2 * len(places) < PLAIN:
        return places.astype("<u2").tobytes()
    bits = np.zeros(CHUNK_ROWS, bool)
    bits[places] = True
    return np.packbits(bits, bitorder="little").tobytes()


def places_of(bitmap: bytes) -> np.ndarray:
    if len(bitmap) < PLAIN:
        return np.frombuffer(bitmap, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little"))


def popcount(bitmap: bytes) -> int:
    return len(bitmap) // 2 if len(bitmap) < PLAIN else int.from_bytes(bitmap).bit_count()


def merge(bitmaps: list[bytes]) -> bytes:
    """The OR of bitmaps of one chunk."""
    if len(bitmaps) == 1:
        return bitmaps[0]
    return pack(np.unique(np.concatenate([places_of(b) for b in bitmaps])))


class Postings:
    """Postings of a chunk, gathered document by document."""

    def __init__(self):
        self.codes: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.links = 0

    @property
    def rows(self) -> int:
        return len(self.codes)

    def add(self, codes: np.ndarray) -> None:
        """The links of the next document."""
        found, times = np.unique(codes, return_counts=True)
        self.codes.append(found)
        self.times.append(times.astype(np.int32))
        self.links += len(found)

    def lists(self) -> pd.DataFrame:
        """``code``, ``docs`` (bitmap), ``planes`` (bitmaps of the bits of the number of links less one) and ``n_docs``."""
        code = np.concatenate([*self.codes, np.zeros(0, np.int64)])
        place = np.repeat(np.arange(self.rows), [len(c) for c in self.codes])
        more = np.concatenate([*self.times, np.zeros(0, np.int32)]) - 1
        order = np.argsort(code, kind="stable")  # places stay in order
        code, place, more = code[order], place[order], more[order]
        first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, np.int64)
        last = np.r_[first[1:], len(code)] if len(code) else first
        short, width = place.astype("<u2").tobytes(), PLAIN // 2
        docs = [short[2 * a : 2 * b] if b - a < width else pack(place[a:b]) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
        planes: list[list[bytes]] = [[]] * len(docs)
        most = np.maximum.reduceat(more, first) if len(code) else more
        for k in np.flatnonzero(most).tolist():
            a, b = first[k], last[k]
            planes[k] = [pack(place[a:b][more[a:b] >> bit & 1 == 1]) for bit in range(int(most[k]).bit_length())]
        whole = {"docs": pd.Series(docs, dtype=object), "planes": pd.Series(planes, dtype=object)}
        return pd.DataFrame({"code": code[first], **whole, "n_docs": np.fromiter(map(popcount, docs), np.int64, len(docs))})


_ROWS = "chunk long, place int, id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_LISTS = "code long, docs binary, planes array<binary>, n_docs long"


def chunks(docs: DataFrame, path_a: str, path_b: str, id: str, text: str, chunk_rows: int = CHUNK_ROWS, chunk_links: int = CHUNK_LINKS) -> DataFrame:
    """Both of rows of documents (``code`` is null) and postings (``place`` is null), chunk by chunk; texts are encoded once."""
    at_once, chars_at_once = _AT_ONCE, _CHARS_AT_ONCE
    of_rows, of_lists = ([c.split()[0] for c in x.split(", ")] for x in (_ROWS, _LISTS))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        aligned = aligner(path_a, path_b)
        chunk = TaskContext.get().partitionId() << 32
        held, rows = Postings(), []

        def ended() -> Iterator[pd.DataFrame]:
            yield pd.DataFrame(rows, columns=of_rows).assign(**{c: None for c in of_lists})
            if held.links:
                yield held.lists().assign(**{c: None for c in of_rows} | {"chunk": chunk})

        def encoded() -> Iterator[tuple]:
            names, texts, chars = [], [], 0
            for batch in batches:
                for name, content in zip(batch["id"], batch["text"], strict=True):
                    names.append(name)
                    texts.append(content)
                    chars += len(content)
                    if len(texts) >= at_once or chars >= chars_at_once:
                        yield from zip(names, aligned.of_texts(texts), strict=True)
                        names, texts, chars = [], [], 0
            yield from zip(names, aligned.of_texts(texts), strict=True)

        none = (0, 0, 0, "", np.zeros(0, np.int64))
        with task_memory():
            for name, found in encoded():
                n_a, n_b, n_groups, digest, codes = found or none
                rows.append((chunk, held.rows, name, n_a, n_b, n_groups, len(codes), digest))
                held.add(codes)
                if held.rows >= chunk_rows or held.links >= chunk_links:
                    yield from ended()
                    chunk, held, rows = chunk + 1, Postings(), []
            if rows:
                yield from ended()

    given = docs.select(F.col(id).cast("string").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return given.mapInPandas(run, f"{_ROWS}, {_LISTS}")


def pair_counts(made: DataFrame) -> DataFrame:
    """``(code, count, best)``: documents that hold the id pair linked, and whether no pair of its A id has more."""
    counts = stored(made.where("code is not null").groupBy("code").agg(F.sum("n_docs").alias("count")), "alignment-counts")
    of_a = F.shiftright("code", _SHIFT)
    highest = counts.groupBy(of_a.alias("a")).agg(F.max("count").alias("highest"))  # a row per id of A's vocabulary
    return counts.join(highest, of_a == F.col("a")).select("code", "count", (F.col("count") == F.col("highest")).alias("best"))


def _returned(docs: pd.DataFrame, lists: pd.DataFrame) -> pd.DataFrame:
    """Documents of a chunk with the scores that its postings return."""
    best, total = np.zeros(CHUNK_ROWS, np.int64), np.zeros(CHUNK_ROWS, np.int64)
    if len(lists):
        of_scores = lists["docs"].isna()
        given, scored = (x.sort_values("code") for x in (lists[~of_scores], lists[of_scores]))  # each code once in both
        sizes = np.fromiter(map(popcount, given["docs"]), np.int64, len(given))
        place = np.concatenate([places_of(b) for b in given["docs"]])
        count, is_best = scored["count"].to_numpy(np.int64), scored["best"].to_numpy(bool)
        # sums of whole numbers below 2**53 are exact in double precision
        total += np.bincount(place, np.repeat(count, sizes), CHUNK_ROWS).astype(np.int64)
        best += np.bincount(place, np.repeat(is_best, sizes), CHUNK_ROWS).astype(np.int64)
        for planes, score, is_b in zip(given["planes"], count.tolist(), is_best.tolist(), strict=True):
            for bit, bitmap in enumerate(() if planes is None else planes):
                at = places_of(bitmap)
                total[at] += score << bit
                best[at] += is_b << bit
    places = docs["place"].to_numpy(np.int64)
    return docs.drop(columns=["chunk", "place"]).assign(n_best=best[places], count_sum=total[places])


def aligned(docs: DataFrame, path_a: str, path_b: str, id: str = "doc_id", text: str = "text", chunk_rows: int = CHUNK_ROWS, chunk_links: int = CHUNK_LINKS) -> DataFrame:
    """``(<id>, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, a row per row of ``docs``."""
    made = stored(chunks(docs, path_a, path_b, id, text, chunk_rows, chunk_links), "alignment-chunks")
    postings = made.where("code is not null").select(F.col("chunk").alias("of_chunk"), "code", "docs", "planes")
    # only the codes of a chunk travel to their scores; bitmaps are shuffled once, to their chunk
    scores = postings.select("of_chunk", "code").join(pair_counts(made), "code").select("of_chunk", "code", "count", "best")
    scored = postings.unionByName(scores, allowMissingColumns=True)
    rows = made.where("place is not null").select("chunk", "place", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    returned = _returned
    schema = "id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    done = rows.groupBy("chunk").cogroup(scored.groupBy("of_chunk")).applyInPandas(lambda x, y: returned(x, y), schema)
    return done.select(F.col("id").cast(docs.schema[id].dataType).alias(id), *RESULTS, "groups_sha256")
