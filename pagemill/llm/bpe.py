"""Byte-pair encoding by backtracking, and decoding by an offset table.

Encoding a run of bytes: an Aho-Corasick automaton gives the longest token at each place. The tokens are laid from left to
right, longest first; a token may follow another only if merging could not have crossed their border, which the table of
merges decides for the pair; where no token fits, the last one is taken back and a shorter one tried. A place from which no
way leads on is never tried again, so the time is linear. Results are exactly those of merging by rank.

Decoding: all tokens' bytes lie in one buffer; a table gives each id's place and length in it.

Defined results: null and empty texts have no tokens and decode to the empty text. Special strings become their ids.
Other columns stay; the added columns replace input columns of the same names.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import Aside
from pagemill.llm.segments import Memo, segments, task_memory

PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PAIR_ENTRIES = 1_000_000
_NO_MERGE = 1 << 40


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters for themselves, the
    others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class BacktrackingBpe:
    """Encoder and decoder of a byte-level vocabulary file without normalizer."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        vocabulary = spec["model"]["vocab"]
        as_bytes = {token: bytes(alphabet[c] for c in token) for token in vocabulary}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocabulary.values(), *special.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for token, i in vocabulary.items():
            self.token_bytes[i] = as_bytes[token]
        for token, i in special.items():
            self.token_bytes[i] = token.encode()
        self.special = special
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
        if not all(token.startswith("<") for token in special):
            raise ValueError("special tokens that do not start with '<'")
        self.pre_token = regex.compile(PRE_TOKEN)

        self.rank = [-1] * size
        self.left, self.right = list(range(size)), list(range(size))
        self.merges: dict[tuple[int, int], int] = {}
        for order, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, made = vocabulary[a], vocabulary[b], vocabulary[a + b]
            self.merges[x, y] = order
            if self.rank[made] < 0:
                self.rank[made], self.left[made], self.right[made] = order, x, y
        self.pairs: dict[tuple[int, int], bool] = {}

        self.automaton = ahocorasick.Automaton()
        self.ids: dict[bytes, int] = {}
        for token, i in vocabulary.items():
            made_of = self.rank[i]
            if made_of < 0 and len(as_bytes[token]) > 1:
                continue  # no merge makes it
            if made_of >= 0 and self._crossed(self.left[i], self.right[i], made_of):
                continue  # an earlier merge always prevents it
            self.ids[as_bytes[token]] = i
            self.automaton.add_word(as_bytes[token].decode("latin-1"), (i, len(as_bytes[token])))
        self.automaton.make_automaton()
        self.shorter: dict[int, int] = {}

        lengths = np.array([len(b) for b in self.token_bytes], np.int64)
        self.lengths, self.places = lengths, np.cumsum(lengths) - lengths
        self.sizes = lengths.tolist()
        self.buffer = np.frombuffer(b"".join(self.token_bytes), np.uint8)
        self.decimal = [str(i) for i in range(size)]
        self.encoded = Memo(lambda pieces: [np.array(self._encode_segment(p), np.uint32).tobytes() for p in pieces])

    def _crossed(self, a: int, b: int, below: int = _NO_MERGE) -> bool:
        """Whether a merge of a rank under ``below`` joins the end of token ``a`` to the beginning of token ``b``.

        Goes back in time: ``a`` and ``b`` are what stands at the border; the one made later is replaced by its part there.
        A part exists only until the merge that used it; of equal merges the left one comes first.
        """
        until_a = until_b = below
        while True:
            rank = self.merges.get((a, b), _NO_MERGE)
            if rank < until_a and rank <= until_b and rank < below:
                return True
            rank_a, rank_b = self.rank[a], self.rank[b]
            if rank_a < 0 and rank_b < 0:
                return False
            if rank_a >= rank_b:
                until_a, a = rank_a, self.right[a]
            else:
                until_b, b = rank_b, self.left[b]

    def fits(self, a: int, b: int) -> bool:
        """Whether token ``b`` can stand after token ``a``."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > PAIR_ENTRIES:
                self.pairs.clear()
            known = self.pairs[a, b] = not self._crossed(a, b)
        return known

    def next_shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of ``token``; -1 if there is none."""
        found = self.shorter.get(token)
        if found is None:
            data = self.token_bytes[token]
            found = next((self.ids[data[:n]] for n in range(len(data) - 1, 0, -1) if data[:n] in self.ids), -1)
            self.shorter[token] = found
        return found

    def encode_bytes(self, data: bytes) -> list[int]:
        n = len(data)
        longest = [-1] * n
        for end, (token, length) in self.automaton.iter(data.decode("latin-1")):
            longest[end - length + 1] = token  # ends ascend, so the last one is the longest
        dead: set[int] = set()
        tokens: list[int] = []
        sizes, known, shorter = self.sizes, self.pairs.get, self.shorter
        place, last, token = 0, -1, longest[0] if n else -1
        while place < n:
            while token >= 0:
                after = place + sizes[token]
                if after not in dead:
                    if last < 0:
                        break
                    fit = known((last, token))
                    if fit or fit is None and self.fits(last, token):
                        break
                token = shorter[token] if token in shorter else self.next_shorter(token)
            if token >= 0:
                tokens.append(token)
                last, place = token, after
                if place < n:
                    token = longest[place]
            else:
                dead.add(place)
                if not tokens:
                    raise ValueError("bytes that the vocabulary cannot express")
                dropped = tokens.pop()
                place -= sizes[dropped]
                last = tokens[-1] if tokens else -1
                token = self.next_shorter(dropped)
        return tokens

    def _encode_segment(self, segment: str) -> list[int]:
        ids: list[int] = []
        for k, part in enumerate(self.split_special.split(segment) if "<" in segment else (segment,)):
            if k % 2:
                ids.append(self.special[part])
                continue
            one = part.isalpha() or part[:1] == " " and part[1:].isalpha()
            for word in (part,) if one else self.pre_token.findall(part):
                data = word.encode()
                token = self.ids.get(data)
                if token is None:
                    ids += self.encode_bytes(data)
                else:
                    ids.append(token)
        return ids

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self.encoded.of(segments(text))), np.uint32)

    def decode_bytes(self, ids: np.ndarray, block: int = 1 << 18) -> bytes:
        out = []
        for k in range(0, len(ids), block):
            part = ids[k : k + block]
            lengths = self.lengths[part]
            ends = np.cumsum(lengths)
            total = int(ends[-1])
            out.append(self.buffer[np.arange(total) + np.repeat(self.places[part] - ends + lengths, lengths)].tobytes())
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> BacktrackingBpe:
    return BacktrackingBpe(path)


def encode_documents(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the column ``ids`` (array of int) of the whole text."""

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with task_memory():
            for batch in batches:
                yield pd.Series([codec(path).encode(t or "").astype(np.int32) for t in batch], dtype=object)

    return docs.withColumn(ids, run(F.coalesce(F.col(text), F.lit(""))))


def decode_documents(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the column ``text`` decoded from the ids; null ids give the empty text."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([codec(path).decode(np.asarray([] if x is None else x, np.int64)) for x in batch], dtype=object)

    return docs.withColumn(text, run(ids))


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and the SHA-256 of the ids (decimal, by commas) and of the text decoded from them.

    Ids do not leave the task: they are several times the text.
    """

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        with task_memory():
            for batch in batches:
                bpe, rows = codec(path), []
                for t in batch:
                    ids = bpe.encode(t)
                    decimal = ",".join(map(bpe.decimal.__getitem__, ids.tolist()))
                    rows.append((
                        len(ids),
                        hashlib.sha256(decimal.encode()).hexdigest(),
                        hashlib.sha256(bpe.decode(ids).encode()).hexdigest(),
                    ))
                yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    aside = Aside(docs, made=run(F.coalesce(F.col(text), F.lit(""))))
    return aside.back(aside.rows, **{c: F.col(f"made.{c}") for c in ("n_tokens", "ids_sha256", "decoded_sha256")})
