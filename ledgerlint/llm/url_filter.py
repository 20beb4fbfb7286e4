"""URL filters (operator 2): rules first, then a classifier on hashed character n-grams.

A rule is (action, host, path prefix) and fits its host and all subdomains when
the url's path starts with the rule's path; the longest fitting rule string
decides.  All other urls are judged by a logistic regression on hashed character
n-grams of host and path, trained from a small labelled table of urls.

Defined results: a null url, or one without ``://``, has an empty host and path
and is judged by the classifier; repeated rows are judged alike; an empty table
gives no rows; extra columns are ignored.  Only the url column is read; there is
no shuffle, and the model (one weight per bucket, ``BUCKETS``) has a fixed size.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Feature buckets of the hashed n-grams.
BUCKETS = 1 << 14
#: Rows of the labelled table that a fit reads at most (a bounded training sample).
MAX_TRAIN_ROWS = 100_000

#: Rules of the registered query: (action, host and path prefix).
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/"))

#: Seed table: hand-labelled urls, 1 = unwanted.
LABELLED = (
    (1, "http://casino-win.test/play/1"), (1, "https://www.best-casino.test/bonus"), (1, "http://casino-slots.test/en/7"),
    (1, "http://cheap-pills.test/buy"), (1, "https://blog.pills-online.test/en/12"), (1, "http://cheap-meds.test/de/4"),
    (1, "http://spam-farm.test/fr/99"), (1, "https://m.link-farm.test/page"), (1, "http://www.spam-links.test/x"),
    (1, "http://adult-x.test/en/5"), (1, "https://adult-video.test/watch"), (1, "http://xxx-adult.test/de/3"),
    (1, "http://free-bets.test/now"), (1, "https://www.bets-win.test/es/8"), (1, "http://free-spins.test/go"),
    (1, "http://ads-track.test/click?id=1"), (1, "https://m.track-ads.test/pixel"), (1, "http://popup-ads.test/fr/6"),
    (1, "http://win-prize.test/claim"), (1, "https://cheap-loans.test/apply"),
    (0, "https://www.university.test/en/research/12"), (0, "http://library.test/de/books/4"),
    (0, "https://blog.gardening.test/fr/tomatoes"), (0, "http://news.test/en/2021/05/10"),
    (0, "https://m.weather.test/es/today"), (0, "http://www.museum.test/en/10"), (0, "https://kitchen.test/de/recipes/7"),
    (0, "http://blog.astronomy.test/en/825"), (0, "https://www.teacher.test/fr/65.html"), (0, "http://history.test/es/978/"),
    (0, "https://m.theatre.test/en/25#top"), (0, "http://www.science.test/de/612"), (0, "https://nation.test/en/770"),
    (0, "http://blog.mathematics.test/fr/533"), (0, "https://there.test/en/455"), (0, "http://www.station.test/de/14"),
    (0, "https://m.thing.test/es/11"), (0, "http://together.test/en/96"), (0, "https://another.test/fr/148.html"),
    (0, "http://blog.reading.test/en/369"),
)


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; empty for null or without ``://``."""
    has = F.coalesce(url.contains("://"), F.lit(False))
    rest = F.regexp_replace(url, r"(?s)^.*?://", "")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return F.when(has, host).otherwise(F.lit("")), F.when(has, path).otherwise(F.lit(""))


def match_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct<rule, action> of the longest fitting rule, else null."""
    fits = []
    for action, text in sorted(rules, key=lambda r: (-len(r[1]), r[1], r[0])):
        rule_host, slash, rule_path = text.partition("/")
        on = (host == rule_host) | host.endswith("." + rule_host)
        fits.append(F.when(on & path.startswith(slash + rule_path), F.struct(F.lit(text).alias("rule"), F.lit(action).alias("action"))))
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,action:string>")


def _ngrams(text: Column, tag: str, n: int) -> Column:
    """Character n-grams of ``^text$``, tagged; none if it is too short."""
    framed = F.concat(F.lit("^"), text, F.lit("$"))
    last = F.char_length(framed) - (n - 1)
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
                                         lambda i: F.concat(F.lit(tag), framed.substr(i, F.lit(n))))
                  ).otherwise(F.array().cast("array<string>"))


def features(urls: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Adds host, path and the hashed n-gram vector ``features`` to rows with a url column."""
    host, path = host_path(F.col("url"))
    grams = F.concat(*(_ngrams(F.col("host"), "h", n) for n in (3, 4, 5)), *(_ngrams(F.col("path"), "p", n) for n in (3, 4)))
    urls = urls.withColumn("host", host).withColumn("path", path).withColumn("grams", grams)
    return HashingTF(numFeatures=buckets, binary=True, inputCol="grams", outputCol="features").transform(urls).drop("grams")


def fit(labelled: DataFrame, buckets: int = BUCKETS) -> LogisticRegressionModel:
    """Fit on (label 0/1, url) rows: at most ``MAX_TRAIN_ROWS``, smallest url hash first."""
    rows = labelled.where("label is not null").select(F.col("label").cast("double").alias("label"), "url")
    rows = rows.orderBy(F.xxhash64("url"), "url", "label").limit(MAX_TRAIN_ROWS)
    return LogisticRegression(regParam=0.02, elasticNetParam=0.0, maxIter=60, standardization=False).fit(features(rows, buckets))


def judge(pages: DataFrame, model: LogisticRegressionModel, rules=RULES, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, score (the classifier's probability of unwanted)."""
    scored = model.transform(features(pages.select("page_id", "url"), model.numFeatures))
    score = vector_to_array("probability")[1]
    rule = match_rule(F.col("host"), F.col("path"), rules)
    return scored.select("page_id", "host", "path", rule.alias("hit"), score.alias("score")).select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.action", F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "score")


def seed_model(spark: SparkSession) -> LogisticRegressionModel:
    return fit(spark.createDataFrame(list(LABELLED), "label int, url string"))
