"""URL filter: host and path rules first, then logistic regression on hashed character n-grams.

Only DataFrame functions and ``pyspark.ml`` run: one map over the urls, without a shuffle, whatever the hosts' shares.

The model is trained from a small table of labelled urls, made by rule from the word lists below: hosts of one or two words
under the same frames (subdomains, endings, paths) in both classes, so that only the words can tell them apart. A fifth of the
table is held out to measure precision and recall.
n-grams of host and path are hashed apart.

Defined results: null urls and urls without ``://`` have an empty host and path, fit no rule and have no n-grams; the model
decides on its bias (allowed). Repeated urls are judged alike; an empty table gives an empty table. Added columns replace
input columns of the same names.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import Aside

BUCKETS = 1 << 16
GRAMS = (3, 4, 5)

#: Names and path words of hosts to be blocked, and of ordinary ones, as they stand in plain word lists.
BLOCKED = (
    "casino poker bets betting jackpot slots roulette gamble bingo blackjack sportsbook wager pills viagra cialis pharma pharmacy meds steroids "
    "cheap discount replica rolex knockoff bargain free winner prize lottery sweepstakes giveaway loan payday credit lender forex crypto "
    "bitcoin trading xxx porn adult sexy erotic nude escort webcam camgirls hookup dating ads adserver track tracker tracking click "
    "clicks popup banner doubleclick affiliate sponsor pixel beacon spam malware virus phishing warez crack cracked keygen serial torrent "
    "pirate nulled hacks"
).split()
ORDINARY = (
    "news daily times journal gazette tribune herald school university college academy library museum archive science research laboratory "
    "health clinic hospital garden kitchen recipes travel weather sports football cycling music film cinema books poetry history nature "
    "forest river mountain island house design studio software data cloud systems network open public city council county parliament "
    "ministry court police market store shop fashion family children parents learning language dictionary grammar energy water climate art "
    "gallery theatre church monastery radio press review magazine forum wiki blog photo video games chess puzzles engineering bridge railway "
    "airport medical legal finance bank insurance hotel restaurant bakery coffee winter summer green north south east west old new first "
    "centre institute foundation society union group partners brothers works tools maps guide atlas almanac letters notes papers thesis "
    "project community workshop farm orchard harvest village bridgeport lakeside hillview printing housing building knitting cooking fishing running "
    "reading writing planning clothing shipping teaching painting walking something everything"
).split()
_TOP = ("com", "org", "net", "info", "example.com", "example.org")
_SUB = ("", "www.", "m.", "blog.")
_PATHS = ("/", "/en/{}/{}", "/de/77.html", "/fr/9021/", "/es/5", "/{}", "")
#: Every so many rows of the table are not learned from.
HELD_OUT = 5


class Rule(NamedTuple):
    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty where there is no ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct ``(rule, action)`` of the longest fitting rule, else null. Of rules of one length the first one counts."""
    found = None
    for rule in sorted(rules, key=lambda r: -len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.action).alias("action"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found if found is not None else F.lit(None).cast("struct<rule:string,action:string>")


def n_grams(host: Column, path: Column) -> Column:
    """Character n-grams with word edges: of the host after ``h:``, of the path after ``p:``."""

    def grams(text: Column, mark: str) -> list[Column]:
        edged = F.concat(F.lit("^"), text, F.lit("$"))

        def of_length(n: int) -> Column:
            last = F.char_length(edged) - (n - 1)
            places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
            return F.transform(places, lambda k: F.concat(F.lit(mark), F.substring(edged, k, F.lit(n))))

        out = [of_length(n) for n in GRAMS]
        return [F.when(text == "", F.array().cast("array<string>")).otherwise(g) for g in out]

    return F.concat(*grams(host, "h:"), *grams(path, "p:"))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``(host, path, label, held_out)``: the table that the model learns from, and a fifth of it by which it is measured.

    Hosts of one or two words and paths under the same frames in both classes, so that only the words can tell them apart. A word of the
    held-out part may stand in the other part beside another word.
    """
    rows = []
    for label, words in ((1.0, BLOCKED), (0.0, ORDINARY)):
        n = len(words)
        for k, word in enumerate(words):
            for j in range(4):
                other, third = words[(7 * k + 3 * j + 1) % n], words[(11 * k + 5 * j + 2) % n]
                if label and j == 3:
                    other = ORDINARY[(5 * k) % len(ORDINARY)]  # a blocked word decides
                name = (word, f"{word}-{other}", f"{word}{other}", f"{other}{word}")[j]
                host = f"{_SUB[(k + j) % 4]}{name}.{_TOP[(k + 2 * j) % 6]}"
                path = _PATHS[(k + 3 * j) % 7].format(third, other)
                rows.append((host, path, label, (k + j) % HELD_OUT == 0))
    return spark.createDataFrame(rows, "host string, path string, label double, held_out boolean")


def measured(labelled: DataFrame, model: PipelineModel) -> tuple[float, float]:
    """Precision and recall of blocking on labelled hosts and paths."""
    scored = model.transform(labelled.select(n_grams(F.col("host"), F.col("path")).alias("_grams"), "label"))
    blocked = vector_to_array("_probability")[1] >= 0.5
    hits = F.sum(F.when(blocked & (F.col("label") == 1), 1).otherwise(0))
    n = scored.agg(hits.alias("hits"), F.sum(blocked.cast("int")).alias("blocked"), F.sum("label").alias("bad")).first()
    return n["hits"] / max(1, n["blocked"] or 0), n["hits"] / max(1, n["bad"] or 0)


def train(labelled: DataFrame, buckets: int = BUCKETS) -> PipelineModel:
    """Logistic regression from ``(host, path, label)``; label 1 is to be blocked. Both classes weigh the same."""
    hashing = HashingTF(inputCol="_grams", outputCol="_x", numFeatures=buckets, binary=True)
    regression = LogisticRegression(
        featuresCol="_x", labelCol="label", weightCol="weight", predictionCol="_guess", probabilityCol="_probability", rawPredictionCol="_raw",
        maxIter=60, regParam=0.0005, standardization=False,
    )
    n = labelled.agg(F.count(F.lit(1)).alias("all"), F.sum("label").alias("bad")).first()
    weight = F.when(F.col("label") == 1, F.lit((n["all"] - n["bad"]) / max(1.0, n["bad"]))).otherwise(F.lit(1.0))
    grams = labelled.select(n_grams(F.col("host"), F.col("path")).alias("_grams"), "label", weight.alias("weight"))
    return Pipeline(stages=[hashing, regression]).fit(grams.coalesce(1))


def judge(urls: DataFrame, rules: list[Rule], model: PipelineModel, url: str = "url") -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule``, ``block_score`` and ``verdict`` (allow or block)."""
    host, path = host_and_path(F.col(url))
    aside = Aside(urls, host=host, path=path)
    ruled = aside.rows.withColumn("_rule", fitting_rule(F.col("host"), F.col("path"), rules))
    scored = model.transform(ruled.withColumn("_grams", n_grams(F.col("host"), F.col("path"))))
    score = vector_to_array("_probability")[1]
    by_model = F.when(score >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return aside.back(
        scored,
        host=F.col("host"),
        path=F.col("path"),
        rule=F.col("_rule.rule"),
        block_score=score,
        verdict=F.coalesce(F.col("_rule.action"), by_model),
    )
