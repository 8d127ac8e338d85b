"""Toxicity scores: gradient-boosted trees over dense features of whole texts, calibrated by isotonic regression.

Learning uses a bounded sample of labelled rows (``SAMPLE_ROWS``) of the folds 1 to 4 of ``crc32(id) mod 5``:

* a lexicon of words and word beginnings that toxic documents hold far more often than others, each with a weight (log
  odds shrunk towards none where evidence is thin), counted once per distinct text; at most ``LEXICON_TERMS`` terms;
* trees (folds 1 to 3) over lexicon densities, nearness to second-person words, capitals, punctuation and obfuscation. A
  training row is described with a lexicon that did not see its own fold;
* the calibration of the trees' probability (fold 4).

Scoring reads each text once. Labels, language, source and id are no inputs of a score.

Defined results: null and blank texts have all features zero and get the score of such a row; without labels of both kinds
there is nothing to learn and each score is the share of toxic labels in the sample (0 without any). Of several labels of
one id the largest counts; labels with a null id or class are left out. Equal texts have equal scores. Other columns
stay; added ones replace input columns of the same names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import Aside, stored
from pagemill.llm.segments import Memo, task_memory

FOLDS = 5
HELD_OUT = 0
CALIBRATION = 4
SAMPLE_ROWS = 12_000
LEXICON_TERMS = 5_000
PREFIXES = (3, 4, 5, 6)
#: Documents whose evidence weighs as much as the prior.
SHRINK = 4.0
LEAST_DOCUMENTS = 3
WEAK, STRONG = 1.5, 4.0
NEAR = 6
FEATURES = (
    "strong_density", "weak_density", "strong_hits", "top_weight", "top_three", "you_near_hits", "you_density",
    "capital_words", "exclamations", "punctuation", "obfuscated", "stretched", "length",
)

SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein ihr euch tu te toi ton vous votre tú ti usted vos".split())
_CHANGED = str.maketrans("013457@$!|", "oieastasii")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[\W_]+")
_STRETCHED = re.compile(r"(.)\1{2,}")
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_NO_PUNCTUATION = bytes(b for b in range(256) if b not in _PUNCTUATION)
_NOT_LATE = bytes(b for b in range(256) if b != ord("!"))


def plain_word(word: str) -> tuple[str, bool, bool]:
    """A word in lower case without signs around it, changed letters put back; whether any were, and whether it was stretched."""
    core = _EDGES.sub("", word.lower())
    if core.isalpha():
        bare, changed = core, False
    elif not any(map(str.isalpha, core)):
        return core, False, False
    else:
        back = _EDGES.sub("", word.lower().rstrip(".,;:!?\"')")).translate(_CHANGED)
        bare = _INNER.sub("", back)
        changed = bare.isalpha()
    squeezed = _STRETCHED.sub(r"\1", bare)
    return squeezed, changed, squeezed != bare


def terms(word: str) -> list[str]:
    """What the lexicon knows of a word: itself, and its beginnings marked by a hyphen."""
    return [word, *(word[:n] + "-" for n in PREFIXES if len(word) > n)] if word.isalpha() else []


class Lexicon:
    """Weights of terms, and what a text shows of them."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.words = Memo(lambda words: [self._word(w) for w in words], entries=250_000, longest=64)

    def _word(self, word: str) -> tuple:
        """Weight, second person, capitals, obfuscated, stretched; empty for a word that shows none of them."""
        plain, changed, stretched = plain_word(word)
        weight = max((self.weights.get(t, 0.0) for t in terms(plain)), default=0.0)
        capital = len(word) > 2 and word.isupper()
        found = (weight, plain in SECOND_PERSON, capital, changed, stretched)
        return found if any(found) else ()

    def features(self, text: str) -> tuple[float, ...]:
        words = text.split()
        n = len(words)
        if not n:
            return (0.0,) * len(FEATURES)
        shown = [(k, f) for k, f in enumerate(self.words.of(words)) if f]
        strong = [k for k, f in shown if f[0] >= STRONG]
        weak = sum(WEAK <= f[0] < STRONG for _, f in shown)
        top = sorted((f[0] for _, f in shown if f[0]), reverse=True)[:3]
        you = [k for k, f in shown if f[1]]
        near, at = 0, 0
        for k in strong:
            while at < len(you) and you[at] < k - NEAR:
                at += 1
            near += at < len(you) and you[at] <= k + NEAR
        data = text.encode()
        return (
            len(strong) / n,
            weak / n,
            math.log1p(len(strong)),
            top[0] if top else 0.0,
            sum(top) / 3,
            near / len(strong) if strong else 0.0,
            len(you) / n,
            sum(f[2] for _, f in shown) / n,
            len(data.translate(None, _NOT_LATE)) / n,
            len(data.translate(None, _NO_PUNCTUATION)) / n,
            sum(f[3] for _, f in shown) / n,
            sum(f[4] for _, f in shown) / n,
            math.log1p(n),
        )


class Model(NamedTuple):
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    base_rate: float


def _fold(id: str):
    return F.pmod(F.crc32(F.col(id).cast("string")), F.lit(FOLDS)).cast("int")


def weigh(counts: dict[str, tuple[float, float]], toxic: float, clean: float) -> dict[str, float]:
    """Weights of terms from the toxic and clean documents that hold them, of so many in all. The heaviest terms are kept."""
    share = toxic / (toxic + clean) if toxic else 0.0
    if not 0 < share < 1:
        return {}
    prior = math.log(share / (1 - share))
    weights = {}
    for term, (bad, good) in counts.items():
        if bad >= LEAST_DOCUMENTS:
            p = (bad + SHRINK * share) / (bad + good + SHRINK)
            weight = math.log(p / (1 - p)) - prior
            if weight >= WEAK:
                weights[term] = weight
    return dict(sorted(weights.items(), key=lambda x: (-x[1], x[0]))[:LEXICON_TERMS])


def _term_counts(sample: DataFrame) -> list:
    """Documents by term, fold and class, for terms of at least ``LEAST_DOCUMENTS`` toxic documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, list[str]] = {}
        found: Counter = Counter()
        for batch in batches:
            for text, toxic, fold in batch.itertuples(index=False):
                of_text: set[str] = set()
                for word in set((text or "").split()):
                    if word not in cache:
                        cache[word] = terms(plain_word(word)[0])
                    of_text.update(cache[word])
                found.update((t, fold, toxic) for t in of_text)
        yield pd.DataFrame([(*k, n) for k, n in found.items()], columns=["term", "fold", "toxic", "n"])

    once = sample.groupBy("text").agg(F.max("toxic").alias("toxic"), F.min("fold").alias("fold"))
    by_fold = once.mapInPandas(count, "term string, fold int, toxic int, n long")
    toxic_n, clean_n = (
        F.map_from_entries(F.collect_list(F.when(F.col("toxic") == k, F.struct("fold", "n")))) for k in (1, 0)
    )
    summed = by_fold.groupBy("term", "fold", "toxic").agg(F.sum("n").alias("n"))
    wide = summed.groupBy("term").agg(toxic_n.alias("bad"), clean_n.alias("good"), F.sum(F.when(F.col("toxic") == 1, F.col("n"))).alias("all_bad"), F.sum("n").alias("all"))
    # half of the documents at least, as thinner terms cannot reach the weight of a weak one at usual shares
    return wide.where((F.col("all_bad") >= LEAST_DOCUMENTS) & (F.col("all_bad") * 3 >= F.col("all"))).orderBy(
        (F.col("all_bad") / F.col("all")).desc(), F.col("all_bad").desc(), "term"
    ).limit(4 * LEXICON_TERMS).collect()


def featured(docs: DataFrame, lexicons: dict[int, dict[str, float]], fold: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` with the column ``_features`` (array of double), by the lexicon of the row's fold, else by lexicon 0."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicons)  # at most LEXICON_TERMS terms each

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known = {k: Lexicon(w) for k, w in shared.value.items()}
        with task_memory():
            for texts, folds in batches:
                yield pd.Series([known[k].features(t) for t, k in zip(texts, folds, strict=True)], dtype=object)

    return docs.withColumn("_features", run(F.coalesce(F.col(text), F.lit("")), F.col(fold) if fold else F.lit(0)))


def _as_vector(df: DataFrame, keep: list[str]) -> DataFrame:
    columns = [F.col("_features")[k].alias(f"_f{k}") for k in range(len(FEATURES))]
    flat = df.select(*keep, *columns)
    return VectorAssembler(inputCols=[f"_f{k}" for k in range(len(FEATURES))], outputCol="_x").transform(flat).select(*keep, "_x")


def _probability(trees: GBTClassificationModel, df: DataFrame) -> DataFrame:
    return trees.transform(df).withColumn("_p", vector_to_array("_probability")[1]).drop("_raw", "_probability", "_guess")


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learns from up to ``sample_rows`` labelled documents outside the held-out fold."""
    known = (
        labels.where(F.col(id).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(id).alias("_id"))
        .agg(F.max(label).cast("int").alias("toxic"))
        .withColumn("fold", _fold("_id"))
        .where(F.col("fold") != HELD_OUT)
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(sample_rows)
    )
    own = docs.select(F.col(id).alias("_id"), F.col(text).alias("text")).join(F.broadcast(known), "_id")  # sample_rows at most
    sample = stored(own.select("text", "toxic", "fold"), "toxicity-sample")
    sizes = {(r["fold"], r["toxic"]): r["n"] for r in sample.groupBy("fold", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = (sum(n for (_, t), n in sizes.items() if t == k) for k in (1, 0))
    if not bad or not good:
        return Model({}, None, None, bad / (bad + good) if bad + good else 0.0)

    counted = _term_counts(sample)
    lexicons = {}
    for without in range(FOLDS):
        counts = {
            r["term"]: tuple(float(sum(n for f, n in (r[c] or {}).items() if f != without or not without)) for c in ("bad", "good"))
            for r in counted
        }
        left_out = [sizes.get((without, k), 0) if without else 0 for k in (1, 0)]
        lexicons[without] = weigh(counts, bad - left_out[0], good - left_out[1])

    rows = stored(
        _as_vector(featured(sample, lexicons, "fold"), ["toxic", "fold"]).withColumn("label", F.col("toxic").cast("double")), "toxicity-rows"
    )
    to_fit = rows.where(F.col("fold") != CALIBRATION)
    if to_fit.select("toxic").distinct().count() < 2:
        to_fit = rows
    trees = GBTClassifier(
        featuresCol="_x", labelCol="label", predictionCol="_guess", maxIter=20, maxDepth=3, stepSize=0.3, seed=7
    ).fit(to_fit.coalesce(2))
    trees = trees.setProbabilityCol("_probability").setRawPredictionCol("_raw")
    scored = _probability(trees, rows.where(F.col("fold") == CALIBRATION)).select("_p", "label")
    calibration = None
    if scored.select("label").distinct().count() == 2:
        calibration = IsotonicRegression(featuresCol="_p", labelCol="label", predictionCol="_score").fit(scored)
    return Model(lexicons[0], trees, calibration, bad / (bad + good))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    aside = Aside(docs, text=F.col(text))
    if model.trees is None:
        scored = aside.rows.withColumn("_score", F.lit(model.base_rate))
    else:
        vectors = _as_vector(featured(aside.rows, {0: model.lexicon}), aside.own)
        scored = _probability(model.trees, vectors)
        if model.calibration is None:
            scored = scored.withColumn("_score", F.col("_p"))
        else:
            scored = model.calibration.transform(scored)
    bounded = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("_score")))
    return aside.back(scored.withColumn("bounded", bounded), score=F.col("bounded"), predicted=(F.col("bounded") >= 0.5).cast("int"))


def held_out(id: str = "doc_id"):
    """Whether a row's fold takes no part in learning."""
    return F.coalesce(_fold(id) == HELD_OUT, F.lit(False))
