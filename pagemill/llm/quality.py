"""Quality rules with adaptive thresholds.

Each document gets base counts and ratios. Per language and source, per language and over the corpus, KLL sketches of the ratios are built:
partial sketches on the map side are merged after the shuffle, so a source that holds a third of all rows is no burden.

Words' length, which every document has, is rejected above ``outer quantile + SPREAD * (outer quantile - median + least spread)``.
The other ratios are of things that most documents have none of. They are sketched over the documents that have any, and cut where
the sketch shows a valley: of the steps between neighbouring quantiles, from one occurrence in a text of middle length on, the
widest on a logarithmic scale, if it is ``VALLEY`` wide and at most ``MOST`` of the group's documents lie above it. The threshold
lies two thirds up the step. Without such a valley documents are of one kind, and only what is ``VALLEY`` above the largest is rejected. So both
sides of a threshold come from the sketches; what is ordinary in a source stays, whatever its rate.

Quantiles of a group of n documents (with any) are mixed with those of its language, ``n² : SMALL²``, and these with the corpus's. Thresholds are
joined back by language and source.

Defined results: a null or blank text has no words and fails the base rules; null languages and sources are groups of
their own; a ratio without words is 0. Equal rows are judged alike. An empty table gives an empty table. Columns of any other name
stay; added columns replace input columns of equal names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from operator import eq

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import Aside, stored

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Ratios that every document has, with outer quantile and least spread: the mean word of ten varies by about a letter.
SPREADS = {"word_length": (0.75, 1.25)}
#: Ratios of things that most documents have none of.
RARE = ("symbols_per_word", "dup_lines_per_word", "repeated_share", "echo_share")
RATIOS = (*RARE, *SPREADS)
SPREAD = 4.0
#: Quantiles between which valleys are looked for, the least width of one (a factor), and the largest share of documents above it.
STEPS = (0.01, 0.02, 0.05, *(k / 10 for k in range(1, 10)), 0.95, 0.98, 0.99, 0.995, 0.999, 1.0)
VALLEY = 3.0
MOST = 1 / 3
#: Documents at which a group counts as much as what it is a part of.
SMALL = 50
SMALL_RARE = 10
SKETCH_K = 400
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

_BLANKS = b" \t\n\v\f\r"
_SYMBOLS = b"#*$%&|<>"
_NO_BLANK = bytes(b for b in range(256) if b not in _BLANKS)
_NO_SYMBOL = bytes(b for b in range(256) if b not in _SYMBOLS)
_WINDOW = 5


def base_counts(text: str) -> tuple[int, int, int, int, int, int]:
    """The counts of ``BASE`` for one text, and its words that equal the word before them."""
    data = text.encode()
    words = data.split()
    blanks = len(data.translate(None, _NO_BLANK))
    symbols = len(data.translate(None, _NO_SYMBOL))
    lines = [line for line in data.split(b"\n") if line.strip()]
    repeated = 0
    windows = list(zip(*(words[k:] for k in range(_WINDOW)), strict=False))
    if len(set(windows)) < len(windows):
        seen: set = set()
        twice = {w for w in windows if w in seen or seen.add(w)}
        covered = 0  # words before this place are counted
        for k, window in enumerate(windows):
            if window in twice:
                repeated += k + _WINDOW - max(k, covered)
                covered = k + _WINDOW
    echoes = sum(map(eq, words, words[1:]))
    return len(words), len(text) - blanks, symbols, len(lines) - len(set(lines)), repeated, echoes


def with_base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns ``BASE``, the ratios of ``RATIOS`` and ``base_failed``."""

    columns = [*BASE, "echoes"]

    @F.pandas_udf(", ".join(f"{c} long" for c in columns))
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([base_counts(t) for t in batch], columns=columns, dtype="int64")

    n = F.col("base.n_words")

    def per_word(column: str) -> Column:
        return F.when(n > 0, F.col(f"base.{column}") / n).otherwise(F.lit(0.0))

    aside = Aside(docs, base=count(F.coalesce(F.col(text), F.lit(""))))
    return aside.back(
        aside.rows,
        **{c: F.col(f"base.{c}") for c in BASE},
        symbols_per_word=per_word("n_symbols"),
        dup_lines_per_word=per_word("n_dup_lines"),
        word_length=per_word("word_chars"),
        repeated_share=per_word("n_repeat_words"),
        echo_share=per_word("echoes"),
        base_failed=(n < MIN_WORDS) | (100 * F.col("base.n_repeat_words") > MAX_REPEAT_PERCENT * n),
    )


def _of_rare(ratio: str) -> str:
    return f"n_{ratio}"


def sketches(counted: DataFrame, *keys: str) -> DataFrame:
    """Mergeable sketches by ``keys``: of words' number and length, and of each rare ratio over the documents that have any; and
    the numbers of documents, in all and with any."""

    def sketch(value: Column, name: str) -> Column:
        return F.kll_sketch_agg_double(value, F.lit(SKETCH_K)).alias(name)

    return counted.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_docs"),
        sketch(F.col("n_words").cast("double"), "words"),
        *[sketch(F.col(r), r) for r in SPREADS],
        *[sketch(F.when(F.col(r) > 0, F.col(r)), r) for r in RARE],
        *[F.count(F.when(F.col(r) > 0, 1)).alias(_of_rare(r)) for r in RARE],
    )


def merged(parts: DataFrame, *keys: str) -> DataFrame:
    """Sketches of groups merged to those of coarser groups, or sketches of several days to one."""
    return parts.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("n_docs", *map(_of_rare, RARE))],
        *[F.kll_merge_agg_double(r, F.lit(SKETCH_K)).alias(r) for r in ("words", *RATIOS)],
    )


def _quantiles(parts: DataFrame, prefix: str) -> list[Column]:
    """Numbers and quantiles of sketches, those of rare ratios as logarithms."""

    def quantile(name: str, q: float) -> Column:
        return F.kll_sketch_get_quantile_double(name, F.lit(q))

    return [
        *[F.col(c).alias(f"{prefix}_{c}") for c in ("n_docs", *map(_of_rare, RARE))],
        quantile("words", 0.5).alias(f"{prefix}_words"),
        *[F.array(quantile(r, outer), quantile(r, 0.5)).alias(f"{prefix}_{r}") for r, (outer, _) in SPREADS.items()],
        *[
            F.when(F.col(_of_rare(r)) > 0, F.array(*[F.ln(quantile(r, q)) for q in STEPS])).alias(f"{prefix}_{r}")
            for r in RARE
        ],
    ]


def _mixed(own: str, coarse: str, n: str, small: float) -> Column:
    """Values of a group and of what it is a part of, ``n² : small²``; a side that has none leaves it to the other."""
    weight = F.pow(F.col(n).cast("double"), F.lit(2)) / (F.pow(F.col(n).cast("double"), F.lit(2)) + small**2)
    both = F.zip_with(own, coarse, lambda a, b: weight * a + (1 - weight) * b)
    return F.coalesce(both, F.col(own), F.col(coarse))


def _shrunk(df: DataFrame, fine: str, coarse: str) -> DataFrame:
    """The values of ``fine`` mixed with those of ``coarse``."""
    weight = F.pow(F.col(f"{fine}_n_docs").cast("double"), F.lit(2)) / (
        F.pow(F.col(f"{fine}_n_docs").cast("double"), F.lit(2)) + SMALL**2
    )
    return df.withColumns(
        {f"{fine}_{r}": _mixed(f"{fine}_{r}", f"{coarse}_{r}", f"{fine}_n_docs", SMALL) for r in SPREADS}
        | {f"{fine}_{r}": _mixed(f"{fine}_{r}", f"{coarse}_{r}", f"{fine}_{_of_rare(r)}", SMALL_RARE) for r in RARE}
        | {f"{fine}_words": weight * F.col(f"{fine}_words") + (1 - weight) * F.col(f"{coarse}_words")}
    )


def _valley(steps: Column, share: Column, one: Column) -> Column:
    """The threshold of a rare ratio from its quantiles' logarithms, the share of documents that have any, and one occurrence."""
    least = math.log(VALLEY)
    points = F.concat(F.array(one), F.transform(steps, lambda x: F.greatest(x, one)))
    above = F.array(F.lit(1.0), *[F.lit(1 - q) for q in STEPS])

    def step(i: Column) -> Column:
        low, high = F.get(points, i), F.get(points, i + 1)
        fits = (high - low >= least) & (F.get(above, i) * share <= MOST)
        return F.when(fits, F.struct((high - low).alias("width"), (low + (high - low) * 2 / 3).alias("at")))

    widest = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(len(STEPS) - 1)), step))
    return F.exp(F.coalesce(widest["at"], F.element_at(points, -1) + least))


def thresholds(counted: DataFrame) -> DataFrame:
    """``lang``, ``source`` and one threshold ``max_<ratio>`` per ratio, from the documents that pass the base rules."""
    parts = stored(sketches(counted.where(~F.col("base_failed")), "lang", "source"), "quality-sketches")
    languages, corpus = merged(parts, "lang"), merged(parts)
    by_source = parts.select("lang", "source", *_quantiles(parts, "own"))
    by_language = languages.select(F.col("lang").alias("of_lang"), *_quantiles(languages, "lang"))
    whole = corpus.select(*_quantiles(corpus, "all"))
    of_language = _shrunk(by_language.join(F.broadcast(whole), F.lit(True)), "lang", "all")  # one row
    both = _shrunk(by_source.join(of_language, F.col("lang").eqNullSafe(F.col("of_lang"))), "own", "lang")

    def spread(ratio: str, least: float) -> Column:
        high, mid = F.col(f"own_{ratio}")[0], F.col(f"own_{ratio}")[1]
        return high + SPREAD * (high - mid + least)

    def rare(ratio: str) -> Column:
        one = F.ln(1 / F.col("own_words"))
        cut = _valley(F.col(f"own_{ratio}"), F.col(f"own_{_of_rare(ratio)}") / F.col("own_n_docs"), one)
        return F.when(F.col(f"own_{ratio}").isNull(), F.exp(one) * VALLEY).otherwise(cut)  # nobody has any

    return stored(
        both.select(
            F.col("lang").alias("of_lang"),
            F.col("source").alias("of_source"),
            *[spread(r, least).alias(f"max_{r}") for r, (_, least) in SPREADS.items()],
            *[rare(r).alias(f"max_{r}") for r in RARE],
        ),
        "quality-thresholds",
    )


def judge(counted: DataFrame, limits: DataFrame) -> DataFrame:
    """``counted`` with ``kept``. The join is left to Spark: broadcast where the thresholds are few, else by shuffle."""
    aside = Aside(counted, **{c: F.col(c) for c in ("lang", "source", "base_failed", *RATIOS)})
    matches = F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source"))
    within = F.lit(True)
    for ratio in RATIOS:
        within = within & (F.col(ratio) <= F.col(f"max_{ratio}"))
    return aside.back(aside.rows.join(limits, matches, "left"), kept=~F.col("base_failed") & F.coalesce(within, F.lit(False)))
