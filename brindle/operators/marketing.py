"""Send times, offer bandits, subject lines, customer segments."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.functions.exprs import clip, first_match, hour_of_week

from .ranking import best

BUCKETS = 56
DEFAULT_ZONE = "America/New_York"
#: Fixed values.
URGENCY = ["today", "now", "last", "ends", "hurry", "final", "hours", "tonight", "only", "limited"]
ARMS = ["free_shipping", "pct10_bedding", "bundle_discount", "none"]
DISCOUNT_ARMS = ["pct10_bedding", "bundle_discount"]
SEGMENT_RULES = [
    ("Lapsed high spenders", [("spend", ">", 0.5), ("recency", ">", 0.75)]), ("VIP regulars", [("spend", ">", 1.0), ("orders", ">", 1.0)]),
    ("New & curious", [("recency", "<", -0.5), ("orders", "<", -0.25)]), ("Dormant one-timers", [("recency", ">", 0.5), ("orders", "<", -0.25)]),
]
DEFAULT_SEGMENT = "Steady mainstream"


def local_bucket(ts: Column, zone: Column) -> Column:
    """Three-hour slot of the week on the customer's clock; a missing or malformed zone is the default one."""
    z = F.when(F.contains(zone, F.lit("/")), zone).otherwise(DEFAULT_ZONE)
    return hour_of_week(F.from_utc_timestamp(ts.cast("timestamp"), z))


def bucket_counts(sends: DataFrame) -> DataFrame:
    return sends.groupBy("customer_id", "bucket").agg(F.count("*").alias("sends"), F.sum("opened").alias("opens"))


def bucket_priors(counts: DataFrame, cap: float = 50.0) -> DataFrame:
    """(bucket, mu, alpha, beta) for all BUCKETS: a Beta prior by moments around each bucket's rate; buckets without data take the medians."""
    g = counts.groupBy("bucket").agg(((F.sum("opens") + 1) / (F.sum("sends") + 2)).alias("mu"))
    r = counts.where("sends >= 3").groupBy("bucket").agg(F.var_samp(F.col("opens") / F.col("sends")).alias("var"), F.avg("sends").alias("n_bar"))
    m = F.col("mu") * (1 - F.col("mu"))
    between = F.greatest(F.lit(1e-5), F.coalesce("var", F.lit(0.0)) - m / F.coalesce("n_bar", F.lit(3.0)))
    p = g.join(r, "bucket", "left").withColumn("kappa", clip(m / between - 1, 2.0, cap)).select("bucket", "mu", (F.col("mu") * F.col("kappa")).alias("a"), ((1 - F.col("mu")) * F.col("kappa")).alias("b"))
    med = F.broadcast(p.agg(F.median("a").alias("ma"), F.median("b").alias("mb")))  # one row
    grid = counts.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    return grid.join(p, "bucket", "left").join(med).select("bucket", "mu", F.coalesce("a", "ma").alias("alpha"), F.coalesce("b", "mb").alias("beta"))


def posteriors(counts: DataFrame, priors: DataFrame) -> DataFrame:
    """(customer_id, bucket, a, b, mean) for every customer and bucket; the grid is BUCKETS rows a customer."""
    grid = counts.select("customer_id").distinct().join(F.broadcast(priors))  # 56 rows
    j = grid.join(counts, ["customer_id", "bucket"], "left")
    a = F.col("alpha") + F.coalesce("opens", F.lit(0))
    b = F.col("beta") + F.coalesce(F.col("sends") - F.col("opens"), F.lit(0))
    return j.select("customer_id", "bucket", a.alias("a"), b.alias("b"), (a / (a + b)).alias("mean"))


def send_times(post: DataFrame, customers: DataFrame, score: str = "mean", least: int = 8) -> DataFrame:
    """(customer_id, bucket, mean, method). customers: customer_id, segment, sends. Thin histories take their segment's best bucket."""
    own = best(post, ["customer_id"], [F.desc(F.round(score, 9)), F.asc("bucket")]).select("customer_id", F.col("bucket").alias("own"), F.col("mean").alias("own_mean"))
    seg = post.join(customers, "customer_id").groupBy("segment", "bucket").agg((F.sum("a") / (F.sum("a") + F.sum("b"))).alias("m"))
    seg = best(seg, ["segment"], [F.desc(F.round("m", 9)), F.asc("bucket")]).select("segment", F.col("bucket").alias("theirs"), F.col("m").alias("their_mean"))
    j = customers.join(own, "customer_id").join(seg, "segment", "left")
    thin = F.col("sends") < least
    return j.select("customer_id", F.when(thin, F.col("theirs")).otherwise(F.col("own")).alias("bucket"), F.when(thin, F.col("their_mean")).otherwise(F.col("own_mean")).alias("mean"), F.when(thin, "segment_fallback").otherwise("personal").alias("method"))


def bits(key: np.ndarray, at: int) -> np.ndarray:
    """Uniform in (0, 1): the at-th number of each key's own sequence (the finalizer of splitmix64 over key and place)."""
    z = key + np.uint64((2 * at + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0**53 + 2.0**-54


def gamma_draws(key: np.ndarray, shape: np.ndarray, start: int = 0) -> np.ndarray:
    """One draw of each row, by squeezing cubes of normals (Marsaglia and Tsang); a batch is drawn together, and what is refused is tried again."""
    k = np.where(shape < 1, shape + 1, shape) - 1 / 3
    out, left, at = np.zeros(len(key)), np.arange(len(key)), start + 1
    while len(left):
        u, v, w = (bits(key[left], at + i) for i in range(3))
        x = np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v)
        cube = (1 + x / np.sqrt(9 * k[left])) ** 3
        safe = np.maximum(cube, 1e-300)
        good = (cube > 0) & (np.log(w) < x * x / 2 + k[left] * (1 - safe + np.log(safe)))
        out[left[good]] = (k[left] * cube)[good]
        left, at = left[~good], at + 3
    return out * np.where(shape < 1, bits(key, start) ** (1 / np.maximum(shape, 1e-12)), 1.0)


def thompson(post: DataFrame, seed: int = 0) -> DataFrame:
    """Adds draw: one Beta draw per row, from numbers that depend on the seed and the row's key only, whatever the partitioning."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            key = pdf["_key"].to_numpy().view(np.uint64)
            a, b = gamma_draws(key, pdf.a.to_numpy(dtype=float)), gamma_draws(key, pdf.b.to_numpy(dtype=float), 1 << 20)
            yield pdf.drop(columns="_key").assign(draw=a / (a + b))

    return post.withColumn("_key", F.xxhash64(F.lit(seed), "customer_id", "bucket")).mapInPandas(run, T.StructType([*post.schema.fields, T.StructField("draw", T.DoubleType())]))


def bandit_statistics(log: DataFrame, context: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Sufficient statistics of a linear bandit: (arm, i, j, value) of X'X and (arm, i, value) of X'r. One aggregate each."""
    x = F.array(*[F.col(c).cast("double") for c in context])
    e = log.select("arm", "reward", x.alias("x")).select("arm", "reward", "x", F.posexplode("x").alias("i", "xi"))
    b = e.groupBy("arm", "i").agg(F.sum(F.col("xi") * F.col("reward")).alias("value"))
    a = e.select("arm", "i", "xi", F.posexplode("x").alias("j", "xj")).groupBy("arm", "i", "j").agg(F.sum(F.col("xi") * F.col("xj")).alias("value"))
    return a, b


def bandit_scores(rows: DataFrame, a: DataFrame, b: DataFrame, context: Sequence[str], key: str, arms: Sequence[str] = ARMS, alpha: float = 0.5, ridge: float = 1.0) -> DataFrame:
    """(key, arm, mean, ucb). The statistics are arms x d x d numbers; their inverses are made on the driver and sent along."""
    d = len(context)
    inv, theta = {}, {}
    xx = {(r.arm, r.i, r.j): r.value for r in a.collect()}
    xr = {(r.arm, r.i): r.value for r in b.collect()}
    for arm in arms:
        m = np.eye(d) * ridge + np.array([[xx.get((arm, i, j), 0.0) for j in range(d)] for i in range(d)])
        inv[arm] = np.linalg.inv(m)
        theta[arm] = inv[arm] @ np.array([xr.get((arm, i), 0.0) for i in range(d)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf[list(context)].to_numpy(dtype=float)
            parts = []
            for arm in arms:
                mean = x @ theta[arm]
                width = np.sqrt(np.maximum(np.einsum("ni,ij,nj->n", x, inv[arm], x), 0))
                parts.append(pd.DataFrame({key: pdf[key], "arm": arm, "mean": mean, "ucb": mean + alpha * width}))
            yield pd.concat(parts)

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, *context).mapInPandas(run, f"{key} {kind}, arm string, mean double, ucb double")


def choose_offers(scores: DataFrame, recent: DataFrame, key: str, epsilon: float = 0.05, most: int = 2, seed: int = 0) -> DataFrame:
    """(key, arm, propensity, n_allowed): the best allowed arm with probability 1 - epsilon, any allowed one with the rest; the draw is a hash of the key.
    recent: key, discounts lately. Discounts stop at ``most`` a week; "none" is always allowed."""
    j = scores.join(recent.select(key, "discounts"), key, "left")
    j = j.where(~F.col("arm").isin(DISCOUNT_ARMS) | (F.coalesce("discounts", F.lit(0)) < most))
    w = Window.partitionBy(key)
    place = F.element_at(F.create_map(*[F.lit(x) for i, a in enumerate(ARMS) for x in (a, i)]), F.col("arm"))
    j = j.withColumn("place", place).withColumn("n", F.count("*").over(w)).withColumn("r", F.row_number().over(w.orderBy(F.desc(F.round("ucb", 9)), "place")))
    j = j.withColumn("p", F.lit(epsilon) / F.col("n") + F.when(F.col("r") == 1, 1 - epsilon).otherwise(0.0))
    u = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) / float(1 << 30)
    j = j.withColumn("upto", F.sum("p").over(w.orderBy("place"))).where((u < F.col("upto")) & (u >= F.col("upto") - F.col("p")))
    return j.select(key, "arm", F.col("p").alias("propensity"), F.col("n").alias("n_allowed"))


def subject_features(c: Column) -> dict[str, Column]:
    w = F.regexp_extract_all(F.lower(c), F.lit("([a-z']+)"), F.lit(1))
    letters = F.length(F.regexp_replace(c, "[^A-Za-z]", ""))
    flag = lambda rx: c.rlike(rx).cast("int")
    return {
        "n_chars": F.length(c), "n_words": F.size(w), "has_emoji": flag("[\\x{1F300}-\\x{1FAFF}\\x{2600}-\\x{27BF}]"), "has_name": flag(r"(?i)\{\{\s*(first_name|name|city)\s*\}\}|%FNAME%"),
        "n_urgency": F.size(F.filter(w, lambda x: x.isin(URGENCY))), "has_question": F.contains(c, F.lit("?")).cast("int"), "has_percent": flag(r"\d+\s*%"),
        "caps": F.length(F.regexp_replace(c, "[^A-Z]", "")) / F.greatest(letters, F.lit(1)),
    }


def segment_names(profiles: DataFrame, segment: str, columns: Sequence[str]) -> DataFrame:
    """(segment, name): the first rule that the segment's mean z-scores satisfy."""
    stats = F.broadcast(profiles.agg(*[F.avg(c).alias(f"{c}_m") for c in columns], *[F.stddev_pop(c).alias(f"{c}_s") for c in columns]))  # one row
    z = profiles.join(stats).select(segment, *[((F.col(c) - F.col(f"{c}_m")) / F.when(F.col(f"{c}_s") == 0, 1.0).otherwise(F.col(f"{c}_s"))).alias(c) for c in columns])
    mean = z.groupBy(segment).agg(*[F.avg(c).alias(c) for c in columns])
    holds = lambda c, op, t: F.col(c) > t if op == ">" else F.col(c) < t
    rules = []
    for name, conds in SEGMENT_RULES:
        cond = F.lit(True)
        for c, op, t in conds:
            cond = cond & holds(c, op, t)
        rules.append((cond, name))
    return mean.withColumn("name", first_match(rules, DEFAULT_SEGMENT))
