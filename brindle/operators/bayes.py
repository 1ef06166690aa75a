"""Multinomial naive Bayes from counts: fitting is one aggregate, scoring one join on terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def fit(docs: DataFrame, alpha: float, prior: str = "smoothed", most: int | None = None) -> dict[str, DataFrame]:
    """docs: label, weight, terms. Tables of classes (label, log_prior, log_unseen, total) and terms (label, term, c). most: only so many terms count, those with the largest weight
    (of equal ones, the first in the alphabet)."""
    per = docs.groupBy("label").agg(F.sum("weight").alias("w"))
    c = docs.select("label", "weight", F.explode("terms").alias("term")).groupBy("label", "term").agg(F.sum("weight").alias("c"))
    if most is not None:
        c = c.join(c.groupBy("term").agg(F.sum("c").alias("_n")).orderBy(F.desc("_n"), "term").limit(most).select("term"), "term", "left_semi").select("label", "term", "c")
    v = F.broadcast(c.select("term").distinct().agg(F.count("*").alias("v")))  # one row
    all_w = F.broadcast(per.agg(F.sum("w").alias("all_w"), F.count("*").alias("k")))  # one row
    classes = per.join(c.groupBy("label").agg(F.sum("c").alias("n")), "label").join(v).join(all_w)
    p = (F.col("w") + 1) / (F.col("all_w") + F.col("k")) if prior == "smoothed" else F.col("w") / F.col("all_w")
    total = F.col("n") + alpha * F.col("v")
    return {"classes": classes.select("label", F.log(p).alias("log_prior"), total.alias("total")), "terms": c, "alpha": alpha}


def predict(docs: DataFrame, model: dict, key: str) -> DataFrame:
    """(key, label, p, rank) of every class. docs: key, terms. Terms not seen in training count for nothing.

    A term meets one row with its weights in all classes, so that a document's words are not multiplied by the classes before they are summed up."""
    terms, classes, alpha = model["terms"], model["classes"], model["alpha"]
    labels = [r[0] for r in classes.select("label").orderBy("label").collect()]  # classes
    t = docs.select(key, F.explode_outer("terms").alias("term")).groupBy(key, "term").agg(F.count("*").alias("m"))
    gain = lambda c: F.log(F.col("c") + alpha) - F.log(F.lit(float(alpha)))
    rows = terms.groupBy("term").agg(*[F.coalesce(F.max(F.when(F.col("label") == x, gain("c"))), F.lit(0.0)).alias(f"g{i}") for i, x in enumerate(labels)])
    t = t.join(rows, "term", "left").withColumn("m", F.when(F.col("g0").isNotNull(), F.col("m")).otherwise(0))
    # Every class starts from all its terms unseen; the terms it has add what they differ.
    per = t.groupBy(key).agg(F.sum("m").alias("n_terms"), *[F.sum(F.when(F.col("m") > 0, F.col("m") * F.col(f"g{i}")).otherwise(0.0)).alias(f"g{i}") for i in range(len(labels))])
    gains = F.array(*[F.struct(F.lit(x).alias("label"), F.col(f"g{i}").alias("gain")) for i, x in enumerate(labels)])
    grid = per.select(key, "n_terms", F.explode(gains).alias("x")).select(key, "n_terms", "x.label", "x.gain").join(classes, "label")
    s = grid.withColumn("s", F.col("log_prior") + F.col("n_terms") * (F.log(F.lit(float(alpha))) - F.log("total")) + F.col("gain"))
    w = Window.partitionBy(key)
    s = s.withColumn("e", F.exp(F.col("s") - F.max("s").over(w)))
    s = s.withColumn("p", F.col("e") / F.sum("e").over(w))
    return s.withColumn("rank", F.row_number().over(w.orderBy(F.desc(F.round("p", 9)), "label"))).select(key, "label", "p", "rank")


def accuracy(pred: DataFrame, label: str = "label", guess: str = "guess", weight: str | None = None) -> DataFrame:
    """(label, accuracy, n): the share of each class's rows, or of their weight, that are told right."""
    w = F.col(weight) if weight else F.lit(1.0)
    return pred.groupBy(label).agg((F.sum(F.when(F.col(label) == F.col(guess), w).otherwise(0.0)) / F.sum(w)).alias("accuracy"), F.count("*").alias("n"))
