"""Near-duplicates by SimHash, found with the generalised pigeonhole principle.

A fingerprint's 64 bits are dealt into partitions, correlated bits together. If thresholds ``t`` of the partitions sum to
``distance - partitions + 1``, two fingerprints within ``distance`` bits differ in at most ``t`` bits in some partition (a
threshold of -1 leaves a partition out). The number of partitions and the thresholds are chosen by dynamic programming
on candidate counts (hot values counted at the cost of their own way, below) estimated from a bounded sample of
fingerprints; they decide the cost, never the result. Each
fingerprint is indexed by its bits in a partition and probes all values within the threshold; candidates are verified.

Values shared by more than ``HOT`` entries are not paired. Their fingerprints emit every value within one bit of
themselves: two fingerprints are within two bits exactly if they share such a value, and at most 65 can share one. So a
group of near copies of any size costs 65 rows a fingerprint, and no link is lost. For a distance of one bit those values are
joined with the fingerprints themselves.

Equal fingerprints are one node of the graph. Components are found by alternating large and small stars, each round
stored in the shared folder.

Defined results: words are runs of other characters than the six ASCII blanks, A-Z lower-cased; fewer words than a shingle
are one shingle; a null or blank text has the fingerprint zero and is linked like any other. Repeated rows are members of
their component. ``component_id`` is the smallest id reachable, nulls last. An empty table gives an empty table. Other columns
stay under any names; added ones replace input columns of the same names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb, inf

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import Aside, stored

BITS = 64
DISTANCE = 2
SHINGLE = 3
SEED = 42
#: Fingerprints that estimates are made from.
SAMPLE = 2048
HOT = 64
MOST_PARTITIONS = 5
_BLOCK = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of one text as a signed 64-bit integer."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # bytes: only A-Z change, and only ASCII blanks split
    if not words:
        return 0
    shingles = zip(*(words[k:] for k in range(shingle)), strict=False) if len(words) >= shingle else [words]
    hashes = np.array([xxh64_intdigest(b" ".join(s), seed) for s in shingles], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), _BLOCK):
        part = hashes[k : k + _BLOCK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with ``fp`` (long)."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(t, shingle) for t in batch], dtype="int64")

    return docs.withColumn("fp", run(F.coalesce(F.col(text), F.lit(""))))


def group_bits(sample: np.ndarray, partitions: int) -> list[list[int]]:
    """Bits dealt into ``partitions`` groups of near equal size, each grown from its seed by correlation."""
    bits = (sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)
    centred = bits.astype(float) - bits.mean(axis=0)
    spread = np.sqrt((centred**2).sum(axis=0))
    spread[spread == 0] = 1
    alike = np.abs((centred / spread).T @ (centred / spread))
    open_bits, groups = set(range(BITS)), []
    for k in range(partitions):
        size = (BITS - sum(map(len, groups))) // (partitions - k)
        rest = sorted(open_bits)
        group = [max(rest, key=lambda b: (alike[b, rest].sum(), -b))]
        open_bits.remove(group[0])
        while len(group) < size:
            best = max(sorted(open_bits), key=lambda b: (alike[b, group].sum(), -b))
            group.append(best)
            open_bits.remove(best)
        groups.append(sorted(group))
    return groups


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def choose_partitions(sample: np.ndarray, total: int, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """``(bits, threshold)`` of the partitions of least estimated cost. ``sample``: unsigned fingerprints of ``total``."""
    best: tuple[float, list[tuple[list[int], int]]] = (inf, [(list(range(BITS)), distance)])
    scale = total / max(1, len(sample))
    for partitions in range(1, MOST_PARTITIONS + 1):
        groups = group_bits(sample, partitions)
        costs = []
        for group in groups:
            masked = sample & np.uint64(_mask(group))
            apart = np.array([np.bitwise_count(masked ^ x) for x in masked], np.uint8)
            of_group = {-1: 0.0}
            for t in range(min(distance, len(group)) + 1):
                probes = sum(comb(len(group), k) for k in range(t + 1))
                partners = (np.count_nonzero(apart <= t, axis=1) - 1) * scale  # of each fingerprint of the sample
                candidates = np.where(partners > HOT, BITS + 1, partners / 2).sum() * scale
                by_chance = min(HOT, total * probes / 2 ** len(group)) / 2 * total
                of_group[t] = total * (probes + 1) + max(candidates, by_chance)
            costs.append(of_group)
        target = distance - partitions + 1
        states: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for of_group in costs:
            following: dict[int, tuple[float, list[int]]] = {}
            for spent, (cost, chosen) in states.items():
                for t, more in of_group.items():
                    if cost + more < following.get(spent + t, (inf, []))[0]:
                        following[spent + t] = (cost + more, [*chosen, t])
            states = following
        if target in states and states[target][0] < best[0]:
            best = (states[target][0], list(zip(groups, states[target][1], strict=True)))
    return [(group, t) for group, t in best[1] if t >= 0]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _within(fp: Column, bits: list[int], t: int) -> Column:
    """All values within ``t`` changed ``bits`` of ``fp``, itself first."""
    masks = [_signed(_mask(list(c))) for k in range(t + 1) for c in combinations(bits, k)]
    return F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: fp.bitwiseXOR(m))


def links(fps: DataFrame, distance: int = DISTANCE, hot: int = HOT) -> DataFrame:
    """Edges ``(a, b)``, a < b, of fingerprints ``fp`` (distinct) within ``distance`` <= 2 bits: all pairs within small
    buckets, and for hot ones edges whose components are those of all pairs."""
    if distance > 2:
        raise ValueError("hot values are resolved for distances up to 2")
    total = fps.count()
    if total < 2:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    sample = np.array([r["fp"] for r in fps.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()], np.int64).view(np.uint64)
    plan = choose_partitions(sample, total, distance)
    entries = None
    for k, (bits, t) in enumerate(plan):
        value = F.col("fp").bitwiseAND(F.lit(_signed(_mask(bits))).cast("long"))
        part = fps.select("fp", F.lit(k).alias("k"), F.posexplode(_within(value, bits, t)).alias("probe", "value"))
        entries = part if entries is None else entries.unionByName(part)
    entries = stored(entries, "simhash-entries")
    of_value = entries.groupBy("k", "value").agg(F.count(F.lit(1)).alias("n"), F.min("probe").alias("first"))
    sizes = stored(of_value.where("n > 1 and first = 0").drop("first"), "simhash-buckets")
    shared = stored(entries.join(sizes, ["k", "value"]), "simhash-shared")
    small = shared.where(F.col("n") <= hot)
    a, b = small.alias("a"), small.where("probe = 0").alias("b")
    near = (
        (F.col("a.k") == F.col("b.k"))
        & (F.col("a.value") == F.col("b.value"))
        & (F.col("a.fp") < F.col("b.fp"))
        & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= distance)
    )
    paired = a.join(b, near).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))

    crowded = shared.where(F.col("n") > hot).select("fp").distinct()
    around = crowded.select("fp", F.explode(_within(F.col("fp"), list(range(BITS)), min(1, distance))).alias("value"))
    if distance < 2:  # a pair is a fingerprint and one of the values around another
        met = around.join(fps.select(F.col("fp").alias("value")), "value").where(F.col("fp") != F.col("value"))
        star = met.select(F.least("fp", "value").alias("a"), F.greatest("fp", "value").alias("b"))
    else:
        groups = around.groupBy("value").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
        star = groups.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a < b")
    return stored(paired.unionByName(star).distinct(), "simhash-links")


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of the nodes of ``edges`` ``(a, b)``: root is the smallest node of the component."""

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    current = edges
    before = state(current)
    while before[0]:
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            current.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = stored(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "stars-least")
        large = stored(
            both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct(), "stars-large"
        )
        least = stored(large.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m")), "stars-least")
        moved = large.select(F.col("b").alias("u"), F.col("a").alias("v")).join(least, "u")
        small = moved.select(F.col("m").alias("a"), F.explode(F.array("u", "v")).alias("b")).where("a < b").distinct()
        current = stored(small, "stars-small")
        after = state(current)
        if after == before:
            break
        before = after
    leaves = current.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return leaves.unionByName(current.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def components(marked: DataFrame, id: str = "doc_id", distance: int = DISTANCE) -> DataFrame:
    """``(fp, component_id, kept_fp)`` of each fingerprint of ``marked`` ``(id, fp)``; the row of ``component_id`` with the
    fingerprint ``kept_fp`` stands for the component."""
    ranked = F.struct(F.col(id).isNull().alias("none"), F.col(id).alias("id"), F.col("fp").alias("fp"))
    by_fp = stored(marked.groupBy("fp").agg(F.min(ranked).alias("first")), "simhash-fingerprints")
    roots = stored(connected_components(links(by_fp.select("fp"), distance)), "simhash-roots")
    linked = by_fp.join(roots, by_fp.fp == roots.node).select("fp", "first", "root")
    least = stored(linked.groupBy("root").agg(F.min("first").alias("least")), "simhash-least")
    moved = roots.join(least, "root").select("node", "least")
    first = F.coalesce(F.col("least"), F.col("first"))
    joined = by_fp.join(moved, by_fp.fp == moved.node, "left")
    return stored(
        joined.select("fp", first["id"].alias("component_id"), first["fp"].alias("kept_fp")), "simhash-components"
    )


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """``docs`` with ``fingerprint`` (hexadecimal), ``component_id`` and ``component_kept`` (true for one row's key of each
    component).

    The text is read once; give only the columns that are needed.
    """
    aside = Aside(docs, id=F.col(id), text=F.col(text))
    marked = stored(with_fingerprint(aside.rows, "text", shingle).drop("text"), "simhash-documents")
    found = components(marked, "id", distance).withColumnRenamed("fp", "of")
    return aside.back(
        marked.join(found, F.col("fp") == F.col("of")),
        fingerprint=F.lower(F.lpad(F.hex("fp"), 16, "0")),
        component_id=F.col("component_id"),
        component_kept=(F.col("fp") == F.col("kept_fp")) & F.col("id").eqNullSafe(F.col("component_id")),
    )


def without_near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """One row of each component, with the columns of ``docs``: that of the smallest id. Of repeated rows of it one stays."""
    aside = Aside(docs, id=F.col(id), text=F.col(text))
    kept = near_duplicates(aside.rows, "id", "text", shingle, distance).where("component_kept")
    return aside.back(kept.dropDuplicates(["id", "fingerprint"]))
