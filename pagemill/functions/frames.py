"""Helpers inside tasks that work on pandas frames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd


def group_blocks(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Frames of whole groups, and the rows at which a group begins, from batches that are sorted by ``keys``; keys are not null.

    A frame holds all groups that end with its batch, so that small groups are worked on together. What of a group is still to
    come is put together once.
    """
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = held[-1].iloc[-1:] if held else batch.iloc[:0]
        of_key = pd.concat([last[keys], batch[keys]], ignore_index=True) if held else batch[keys]
        starts = np.flatnonzero((of_key != of_key.shift()).any(axis=1))
        starts = starts[1:] - 1 if held else starts[1:]  # of groups that begin in this batch, but for the first row of all
        if len(starts):
            whole = pd.concat([*held, batch.iloc[: starts[-1]]], ignore_index=True)
            before = len(whole) - starts[-1]
            yield whole, np.append(0, starts[:-1] + before).astype(np.int64)
            held = []
        held.append(batch.iloc[starts[-1] :] if len(starts) else batch)
    if held:
        yield pd.concat(held, ignore_index=True), np.zeros(1, np.int64)
