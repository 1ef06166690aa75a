"""Association rules between items bought together, and cart recommendations from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranking import top_k


def baskets(lines: DataFrame, item: str, largest: int | None = 30) -> DataFrame:
    """(order_id, item) of orders with 2 to ``largest`` distinct items (None: any number from 2). A bound is applied before pairs are made, so pairs per order are bounded."""
    d = lines.select("order_id", F.col(item).alias("item")).distinct()
    return d.withColumn("n", F.count("*").over(Window.partitionBy("order_id"))).where(F.col("n") >= 2 if largest is None else F.col("n").between(2, largest)).drop("n")


#: Orders of more items are paired in cells, CELL_ITEMS items of each side a cell, so that no row or task holds all pairs of one.
WIDE, CELL_ITEMS = 30, 512


def _cell_pairs(wide: DataFrame) -> DataFrame:
    """(a, b) for each two items of an order: an item meets the order's others cell by cell. wide: order_id, item, n."""
    cells = F.ceil(F.col("n") / CELL_ITEMS).cast("long")
    own, other = F.pmod(F.xxhash64("item"), cells), F.explode(F.sequence(F.lit(0).cast("long"), cells - 1))
    left = wide.select("order_id", F.col("item").alias("a"), own.alias("_i"), other.alias("_j"))
    right = wide.select("order_id", F.col("item").alias("b"), own.alias("_j"), other.alias("_i"))
    return left.join(right, ["order_id", "_i", "_j"]).where("a < b").select("a", "b")


def rules(b: DataFrame, support: int, confidence: float, lift: float) -> DataFrame:
    """(antecedent, consequent, support, confidence, lift) in both directions."""
    sized = b.withColumn("n", F.count("*").over(Window.partitionBy("order_id")))
    orders = sized.where(F.col("n") <= WIDE).groupBy("order_id").agg(F.array_sort(F.collect_list("item")).alias("items"))
    # All pairs of an order's sorted items, without a join.
    pair = F.flatten(F.transform("items", lambda x, i: F.transform(F.slice("items", i + 2, F.size("items")), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    each = orders.select(F.explode(pair).alias("p")).select("p.a", "p.b").unionByName(_cell_pairs(sized.where(F.col("n") > WIDE)))
    pairs = each.groupBy("a", "b").agg(F.count("*").alias("n_pair")).where(F.col("n_pair") >= support)
    both = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))).alias("r"), "n_pair").select("r.x", "r.y", "n_pair")
    single = b.groupBy("item").agg(F.count("*").alias("n"))
    total = b.select("order_id").distinct().agg(F.count("*").alias("n_all"))
    j = both.join(single.select(F.col("item").alias("x"), F.col("n").alias("nx")), "x").join(single.select(F.col("item").alias("y"), F.col("n").alias("ny")), "y").join(F.broadcast(total))  # one row
    conf = F.col("n_pair") / F.col("nx")
    out = j.select(F.col("x").alias("antecedent"), F.col("y").alias("consequent"), (F.col("n_pair") / F.col("n_all")).alias("support"), conf.alias("confidence"), (conf / (F.col("ny") / F.col("n_all"))).alias("lift"))
    return out.where((F.col("confidence") >= confidence) & (F.col("lift") >= lift))


def with_backoff(lines: DataFrame, item_rules: DataFrame, category_rules: DataFrame, sparse: int = 40, sellers: int = 3, damp: float = 0.8, top: int = 20) -> DataFrame:
    """Items with few orders inherit their category's rules, filled with the target category's best sellers; substitutes (same category) go;
    the best rule of a pair and the first ``top`` of an item stay."""
    dim = lines.groupBy("sku").agg(F.min("category").alias("category"), F.count_distinct("order_id").alias("orders"))
    best = top_k(dim, ["category"], [F.desc("orders"), F.asc("sku")], sellers, "_r").select(F.col("category").alias("consequent"), F.col("sku").alias("target"))
    few = dim.where(F.col("orders") < sparse).select("sku", F.col("category").alias("antecedent"))
    back = few.join(category_rules.where("antecedent != consequent"), "antecedent").join(best, "consequent")
    back = back.select(F.col("sku").alias("antecedent"), F.col("target").alias("consequent"), "support", "confidence", (F.col("lift") * damp).alias("lift"), F.lit("category").alias("level"))
    every = item_rules.withColumn("level", F.lit("item")).unionByName(back)
    cat = lambda c: dim.select(F.col("sku").alias(c), F.col("category").alias(f"{c}_cat"))
    every = every.join(cat("antecedent"), "antecedent").join(cat("consequent"), "consequent").where("antecedent_cat != consequent_cat")
    one = top_k(every, ["antecedent", "consequent"], [F.desc("lift"), F.asc("level")], 1, "_r").drop("_r")
    return top_k(one, ["antecedent"], [F.desc("lift"), F.asc("consequent")], top, "rank").drop("antecedent_cat", "consequent_cat")


def cart_addons(carts: DataFrame, rule_table: DataFrame, categories: DataFrame, k: int = 4, backoff_weight: float = 0.5) -> DataFrame:
    """carts: (cart_id, sku). Summed lifts of the rules of a cart's items; nothing in the cart or its categories; one item per category; the first k."""
    carts = carts.distinct()
    w = F.when(F.col("level") == "item", F.col("lift")).otherwise(backoff_weight * F.col("lift"))
    hits = carts.join(rule_table, carts.sku == rule_table.antecedent).groupBy("cart_id", "consequent").agg(F.sum(w).alias("score"))
    hits = hits.join(categories.select(F.col("sku").alias("consequent"), "category"), "consequent")
    taken = carts.join(categories, "sku").select("cart_id", "category").distinct()
    free = hits.join(taken, ["cart_id", "category"], "left_anti").join(carts.select("cart_id", F.col("sku").alias("consequent")), ["cart_id", "consequent"], "left_anti")
    order = [F.desc(F.round("score", 9)), F.asc("consequent")]
    return top_k(top_k(free, ["cart_id", "category"], order, 1, "_r").drop("_r"), ["cart_id"], order, k)
