"""URL filter: host and path rules first, then a linear model (DataFrame
functions and Spark ML only).

The model is a logistic regression on hashed character n-grams of host and
path, fitted on a small labelled URL table.  Rules are (host, path) pairs: a
rule fits its host and all subdomains if the path starts with the rule's path;
the longest fitting rule decides, otherwise the model's probability does.

Defined results: a null url or one without ``://`` has an empty host and path
and is judged by the model like any other url; rules are compared literally
(a port is part of the host); equal rows give equal results.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURES = 1 << 14
GRAM = (3, 4)

#: (verdict, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

#: The labelled URL table: 1 = block.
LABELLED_URLS = (
    (1, "http://spam-farm.example.com/en/1"),
    (1, "https://www.spam-farm.example.org/fr/2931?page=2"),
    (1, "https://spam-links.example.org/en/buy-now"),
    (1, "http://link-farm.example.com/seo/backlinks-cheap"),
    (1, "http://casino-bonus.example.com/free-spins"),
    (1, "https://online-casino.example.org/poker/win-money"),
    (1, "http://cheap-pills.example.com/buy/viagra"),
    (1, "https://pharmacy-discount.example.org/order/pills-online"),
    (1, "http://adult-cams.example.com/live/xxx"),
    (1, "https://xxx-videos.example.org/porn/hot"),
    (1, "http://free-money.example.com/get-rich-quick"),
    (1, "https://payday-loans.example.org/apply-now/cash"),
    (1, "http://win-prize.example.com/claim/iphone-free"),
    (1, "https://secure-login.example.org/verify-account/paypal"),
    (1, "http://account-verify.example.com/update-password.php"),
    (1, "https://cracked-software.example.org/download/keygen.exe"),
    (1, "http://torrent-warez.example.com/full-movie-free"),
    (1, "https://bet-now.example.org/odds/casino"),
    (1, "http://replica-watches.example.com/rolex-cheap"),
    (1, "https://crypto-doubler.example.org/send-bitcoin-win"),
    (0, "https://www.example.com/en/12"),
    (0, "https://blog.example.org/en/2021/spring-notes"),
    (0, "http://m.example.com/fr/77"),
    (0, "https://news.example.org/world/article-8821.html"),
    (0, "https://www.example.com/de/impressum"),
    (0, "https://docs.example.org/guide/installation"),
    (0, "http://library.example.com/catalog/item/5521"),
    (0, "https://university.example.org/courses/physics-101"),
    (0, "https://www.example.org/es/341/"),
    (0, "http://weather.example.com/forecast/today"),
    (0, "https://recipes.example.org/soup/tomato.html"),
    (0, "https://forum.example.com/thread/92?page=3"),
    (0, "https://museum.example.org/exhibits/modern-art"),
    (0, "http://www.example.com/about"),
    (0, "https://blog.example.com/en/853/"),
    (0, "https://city.example.org/transport/bus-lines"),
    (0, "https://health.example.org/articles/sleep"),
    (0, "http://sports.example.com/results/2020"),
    (0, "https://www.example.org/en/685#top"),
    (0, "https://wiki.example.org/wiki/Logistic_regression"),
)


def _lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z folded) and path; both empty for null or without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url.cast("string"), F.lit(""))
    return _lower_ascii(F.regexp_extract(url, pattern, 1)), F.regexp_extract(url, pattern, 2)


def best_rule(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """Struct (rule, verdict) of the longest fitting rule; null without one."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):  # longer ones are tested first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _gram_at(mark: str, text: Column, n: int):
    return lambda i: F.concat(F.lit(mark), F.substr(text, i, F.lit(n)))


def url_grams(host: Column, path: Column) -> Column:
    """Character n-grams of the bounded host and path, marked by their part."""
    parts = []
    for mark, part in (("h", host), ("p", path)):
        text = F.concat(F.lit("^"), part, F.lit("$"))
        for n in GRAM:
            starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1)).otherwise(
                F.array().cast("array<int>")
            )
            parts.append(F.transform(starts, _gram_at(mark, text, n)))
    return F.concat(*parts)


def _vectors(df: DataFrame) -> DataFrame:
    hashed = HashingTF(numFeatures=FEATURES, binary=True, inputCol="__grams", outputCol="__features")
    return hashed.transform(df.withColumn("__grams", url_grams(F.col("__host"), F.col("__path")))).drop("__grams")


def train_url_model(spark: SparkSession, labelled: tuple = LABELLED_URLS) -> LogisticRegressionModel:
    """Fits on a table of (label, url); the table is small by contract."""
    df = spark.createDataFrame([(float(y), u) for y, u in labelled], "label double, url string").coalesce(1)
    host, path = split_url(F.col("url"))
    rows = _vectors(df.withColumn("__host", host).withColumn("__path", path))
    return LogisticRegression(
        featuresCol="__features", labelCol="label", regParam=0.01, maxIter=50, standardization=False
    ).fit(rows)


def judge_urls(
    pages: DataFrame,
    model: LogisticRegressionModel,
    rules: tuple = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    threshold: float = 0.5,
) -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict,
    block_score`` (the model's probability of block)."""
    host, path = split_url(F.col("__url"))
    rows = (
        pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("__url"))
        .withColumn("__host", host)
        .withColumn("__path", path)
    )
    own = model.copy().setFeaturesCol("__features").setPredictionCol("").setRawPredictionCol("").setProbabilityCol("__p")
    scored = own.transform(_vectors(rows)).withColumn("__rule", best_rule(F.col("__host"), F.col("__path"), rules))
    score = vector_to_array("__p")[1]
    return scored.select(
        "page_id",
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.col("__rule.rule").alias("rule"),
        F.coalesce(F.col("__rule.verdict"), F.when(score >= threshold, "block").otherwise("allow")).alias("verdict"),
        score.alias("block_score"),
    )
