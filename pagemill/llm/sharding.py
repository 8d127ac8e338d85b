"""Sharding by sampled splitters: shards are ranges of a key, of near equal bytes.

Keys are drawn in proportion to size: a row is in the sample with probability ``rate * size`` (always, where that exceeds 1,
and then with that weight), so the sample's quantiles are quantiles of bytes. They cut the keys into ranges; ranges are
measured over all rows, and one that holds too much is sampled again by itself and subdivided, until all are small. Ranges
are then laid end to end: a row's place in bytes and in rows is its range's start plus its place within the range, and
shards are cut from that line, so shard sizes differ by one row's size at most, and slots are gapless.

The key is a hash of the grouping columns (equal texts stand together) followed by a hash of the row, so a group that holds
a third of all rows is cut like any other range. What goes to the driver are splitters and range sums; their number is
total bytes / ``RANGE_BYTES``, ``LEAST_RANGES`` at least.

Defined results: a size of null counts as 1; rows equal in all columns are rows of their own; empty tables give empty
tables; with fewer rows than shards some shards are empty. Added columns replace input columns of the same names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.common import Aside, stored

SHARDS = 16
RANGE_BYTES = 1 << 30
LEAST_RANGES = 1024
#: Keys drawn per range.
DRAWS = 24
#: A range of more than this many times its due is subdivided.
OVERFULL = 2.0
ROUNDS = 4


def _packed(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Pairs of 64-bit integers as fixed strings that sort like the pairs."""
    both = np.empty((len(high), 2), ">u8")
    both[:, 0] = high.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    both[:, 1] = low.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return np.ascontiguousarray(both).view("S16").ravel()


def weighted_splitters(high: np.ndarray, low: np.ndarray, weights: np.ndarray, pieces: int) -> list[tuple[int, int]]:
    """Keys at which the sampled weight is cut into ``pieces`` equal parts, in order and distinct."""
    if not len(high):
        return []
    order = np.lexsort((low, high))
    line = np.cumsum(weights[order])
    at = np.searchsorted(line, line[-1] * np.arange(1, pieces) / pieces)
    return sorted({(int(high[order[k]]), int(low[order[k]])) for k in at})


def _with_range(keyed: DataFrame, splitters: list[tuple[int, int]]) -> DataFrame:
    """``keyed`` with ``_range``: the number of splitters up to the row's key."""
    pairs = np.array(splitters, np.int64).reshape(-1, 2)
    shared = keyed.sparkSession.sparkContext.broadcast(_packed(pairs[:, 0], pairs[:, 1]))

    @F.pandas_udf("int")
    def locate(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for high, low in batches:
            yield pd.Series(np.searchsorted(shared.value, _packed(high.to_numpy(), low.to_numpy()), side="right"), dtype="int32")

    return keyed.withColumn("_range", locate("_high", "_low"))


def _draw(keyed: DataFrame, draws_per_byte: Column | float, seed: int) -> list:
    chance = F.col("_size") * draws_per_byte
    uniform = (F.shiftrightunsigned(F.xxhash64("_high", "_low", F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    drawn = keyed.withColumn("_weight", F.greatest(F.lit(1.0), chance)).where(uniform < chance)
    return drawn.select(*[c for c in ("_range",) if c in keyed.columns], "_high", "_low", "_weight").collect()


def _columns(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (
        np.array([r["_high"] for r in rows], np.int64),
        np.array([r["_low"] for r in rows], np.int64),
        np.array([r["_weight"] for r in rows], float),
    )


def _ranges(keyed: DataFrame, total: int, pieces: int) -> tuple[list[tuple[int, int]], dict[int, tuple[int, int]]]:
    """Splitters of ranges none of which is overfull, and bytes and rows of each range."""
    splitters = weighted_splitters(*_columns(_draw(keyed, DRAWS * pieces / total, 0)), pieces)
    due = total / pieces
    for round_ in range(1, ROUNDS + 1):
        ranged = _with_range(keyed, splitters)
        sums = {
            r["_range"]: (r["bytes"], r["rows"])
            for r in ranged.groupBy("_range").agg(F.sum("_size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()
        }
        overfull = {k: b for k, (b, n) in sums.items() if b > OVERFULL * due and n > 1}
        if not overfull or round_ == ROUNDS:
            break
        rows = _draw(ranged.where(F.col("_range").isin(list(overfull))), DRAWS / due, round_)
        by_range: dict[int, list] = {k: [] for k in overfull}
        for r in rows:
            by_range[r["_range"]].append(r)
        more = {s for k, own in by_range.items() for s in weighted_splitters(*_columns(own), 1 + int(overfull[k] / due))}
        if more <= set(splitters):
            break
        splitters = sorted(set(splitters) | more)
    return splitters, sums


def assign(rows: DataFrame, size: Column, *group: str, shards: int = SHARDS, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards`` - 1, near equal sums of ``size``) and ``slot`` (0, 1, 2.. within a shard).

    Rows equal in the columns ``group`` follow each other. Shards end at rows, by the law of bytes alone, so a group of any size that
    lies across the end of a shard (at most ``shards`` - 1 of them) goes on in the next one.
    """
    aside = Aside(
        rows,
        _size=F.greatest(F.lit(1), F.coalesce(size.cast("long"), F.lit(1))),
        _high=F.xxhash64(*group) if group else F.lit(0).cast("long"),
        _low=F.xxhash64(F.monotonically_increasing_id(), *group),
    )
    keyed = stored(aside.rows, "sharding-keys")
    keys = keyed.select("_size", "_high", "_low")
    total = keys.agg(F.sum("_size")).first()[0] or 0
    pieces = max(LEAST_RANGES, -(-total // range_bytes))
    splitters, sums = _ranges(keys, total, pieces) if total else ([], {})
    starts, at_byte, at_row = np.zeros((len(splitters) + 1, 2), np.int64), 0, 0
    for k in range(len(splitters) + 1):
        starts[k] = at_byte, at_row
        b, n = sums.get(k, (0, 0))
        at_byte, at_row = at_byte + b, at_row + n
    shared = rows.sparkSession.sparkContext.broadcast(starts)

    @F.pandas_udf("bytes long, rows long")
    def start_of(ranges: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(shared.value[ranges.to_numpy()], columns=["bytes", "rows"])

    within = Window.partitionBy("_range").orderBy("_high", "_low")
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        _with_range(keyed, splitters)
        .withColumn("_upto", F.sum("_size").over(running))
        .withColumn("_row", F.row_number().over(within) - 1)
        .withColumn("_start", start_of("_range"))
        .withColumn("_middle", 2 * (F.col("_start.bytes") + F.col("_upto")) - F.col("_size"))
        .withColumn("shard", F.least(F.lit(shards - 1), F.expr(f"_middle * {shards} div {2 * max(total, 1)}")).cast("int"))
        .withColumn("_place", F.col("_start.rows") + F.col("_row"))
        .select(*aside.own, "_range", "shard", "_place")
    )
    placed = stored(placed, "sharding-places")
    firsts = {r["shard"]: r["first"] for r in placed.groupBy("shard").agg(F.min("_place").alias("first")).collect()}
    first = F.element_at(F.array(*[F.lit(firsts.get(k, 0)).cast("long") for k in range(shards)]), F.col("shard") + 1)
    return aside.back(placed, shard=F.col("shard"), slot=F.col("_place") - first)
