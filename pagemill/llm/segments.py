"""Cuts of a text at which a tokenizer's result cannot change.

A pre-tokenizer of the kind used here never matches a white space character after another character: a match is one
optional space and a run of one kind, or a run of white space. So a cut between a character that is not white space and
one that is always is a boundary between tokens, and what follows it is tokenized without regard to what stands before.
Added special tokens hold no white space, so no cut falls inside one.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakSet

#: Python counts these as white space and Unicode's White_Space does not; texts that hold one are not cut.
ODD = re.compile("[\x1c-\x1f]")
SEGMENT = re.compile(r"\s*\S+|\s+")

#: Entries of each of a cache's two generations. The bound costs time and changes no result.
CACHE_ENTRIES = 450_000


def segments(text: str) -> list[str]:
    """Pieces of ``text`` that can be tokenized one by one; joined they are the text. The empty text has none."""
    if ODD.search(text):
        return [text]
    return SEGMENT.findall(text)


def words(text: str) -> list[str]:
    """Pieces between white space, for tokenizers that drop it."""
    if ODD.search(text):
        return [text]
    return text.split()


def library_tokenizer(path: str):
    """The tokenizers library's tokenizer of whole texts. It encodes in the task's own thread: a task has one core, and each
    thread of the library's own takes memory and waits for work."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Memo:
    """Results by piece; missing ones are computed by ``batch``, a function of a list of pieces.

    Two generations bound the memory: when the young one is full it becomes the old one, and what is used again moves up.
    """

    def __init__(self, batch, entries: int = CACHE_ENTRIES, longest: int = 256):
        self.batch, self.entries, self.longest = batch, entries, longest
        self.young: dict = {}
        self.old: dict = {}
        _MEMOS.add(self)

    def clear(self) -> None:
        self.young, self.old = {}, {}

    def of(self, pieces: list[str]) -> list:
        """Results in order; ``batch`` never gives None. Those of pieces over ``longest`` characters are not kept."""
        young = self.young
        results = list(map(young.get, pieces))
        if None not in results:
            return results
        places = [k for k, found in enumerate(results) if found is None]
        old, missing, fresh = self.old, [], {}
        for p in dict.fromkeys([pieces[k] for k in places]):
            found = old.get(p)
            if found is None:
                missing.append(p)
            else:
                young[p] = fresh[p] = found
        for p, found in zip(missing, self.batch(missing) if missing else (), strict=True):
            fresh[p] = found
            if len(p) <= self.longest:
                young[p] = found
        for k in places:
            results[k] = fresh[pieces[k]]
        if len(young) > self.entries:
            self.young, self.old = {}, young
        return results


_MEMOS: WeakSet[Memo] = WeakSet()


@contextmanager
def task_memory() -> Iterator[None]:
    """Around the work of a task: forgets all results at its end. Spark keeps a task's Python process for later tasks, and may hold
    more of them than run at once; each would keep the results it has seen, those of other operators included."""
    try:
        yield
    finally:
        for memo in list(_MEMOS):
            memo.clear()
