"""URL filters by expressions: host suffixes times path prefixes, matched by digest.

A rule (host, path, verdict) fits its host and all subdomains if the URL's path starts with the rule's path. Each distinct
URL is expanded into every host suffix (at dots) with every path prefix of a length that some rule has; an expression's
SHA-256 is looked up by its first PREFIX hex digits, as a client of a shared list would, and the full digest confirms. Of the rules
that fit, the longest (host and path together) wins, then the one with the longer host, then block.

Rules of at most BROADCAST_RULES rows are broadcast; more are joined by salted prefixes, so that a common
host such as a top-level domain spreads over tasks.

Cases: a null url, or one without "://", has an empty host and path and fits no rule. Repeated URLs are judged once and joined
back. An empty rule table gives the default verdict everywhere. Rules with a null or empty host fit nothing. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .runtime import shuffle_partitions, stage

PREFIX = 8
BROADCAST_RULES = 100_000
SALTS = 32
DEFAULT = "allow"
#: (host, path, verdict)
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def rest(url: Column) -> Column:
    """What follows the first "://"; empty without it."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; only A-Z are lower-cased."""
    r = rest(url)
    host = F.translate(F.regexp_extract(r, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(r, r"^[^/?#]*([^?#]*)", 1)


def suffixes(host: Column) -> Column:
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), ".")))


def prefixes(path: Column, lengths: list[int]) -> Column:
    fitting = F.filter(F.array(*[F.lit(x) for x in lengths]), lambda n: n <= F.length(path))
    return F.transform(fitting, lambda n: F.substring(path, F.lit(1), n))


def expression(host: Column, path: Column) -> Column:
    """A rule or a part of a URL as text; the blank can't stand in a host."""
    return F.concat(host, F.lit(" "), path)


def default_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, "host string, path string, verdict string")


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """urls: any column ``url``. (url, host, path, rule, verdict) of each distinct URL."""
    own = rules.where("host is not null and host != ''").select(
        F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), F.col("verdict").alias("rule_verdict")
    )
    own = own.withColumn("digest", F.sha2(expression(F.col("rule_host"), F.col("rule_path")), 256)).withColumn("short", F.substring("digest", 1, PREFIX))
    few = own.count() <= BROADCAST_RULES
    lengths = sorted(r.n for r in own.select(F.length("rule_path").alias("n")).distinct().collect())  # no more than a path has characters
    host, path = parts(F.col("url"))
    distinct = urls.select(urls[url].alias("url")).distinct().select("url", host.alias("host"), path.alias("path"))
    # Expanding is the work here; a fixed number of parts keeps it spread where few bytes would be put together.
    distinct = stage(distinct.repartition(shuffle_partitions(urls.sparkSession, 0, 1)), "urls")
    digests = F.flatten(F.transform(suffixes(F.col("host")), lambda h: F.transform(prefixes(F.col("path"), lengths), lambda p: F.sha2(expression(h, p), 256))))
    asked = distinct.select("url", F.explode(digests).alias("asked")) if lengths else distinct.select("url", F.lit("").alias("asked")).limit(0)
    asked = asked.withColumn("ask_short", F.substring("asked", 1, PREFIX))
    if few:
        met = asked.join(F.broadcast(own), F.col("ask_short") == F.col("short"))
    else:
        salted = own.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = asked.withColumn("ask_salt", F.pmod(F.xxhash64("url"), F.lit(SALTS))).join(salted, (F.col("ask_short") == F.col("short")) & (F.col("ask_salt") == F.col("salt")))
    met = met.where(F.col("asked") == F.col("digest"))
    rank = F.struct(F.length("rule_host") + F.length("rule_path"), F.length("rule_host"), (F.col("rule_verdict") == "block"))
    best = met.groupBy("url").agg(F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict")), rank).alias("b")).select(F.col("url").alias("url2"), "b")
    return distinct.join(best, F.col("url") == F.col("url2"), "left").select("url", "host", "path", F.col("b.rule").alias("rule"), F.coalesce("b.verdict", F.lit(default)).alias("verdict"))


def filter_pages(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", default: str = DEFAULT) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page."""
    own = pages.select(pages[page_id].alias("page_id"), pages[url].alias("url1"))
    verdicts = judge(pages.where(pages[url].isNotNull()), rules, url, default)
    met = own.where("url1 is not null").join(verdicts, F.col("url1") == F.col("url"), "left").select("page_id", "host", "path", "rule", "verdict")
    none = own.where("url1 is null").select("page_id", F.lit("").alias("host"), F.lit("").alias("path"), F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    return met.unionByName(none)
