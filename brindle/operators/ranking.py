"""Top-k, best and latest rows, bands, and greedy diversification."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.exprs import rank_band

from .graph import _checkpoint


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group in a total order, ranked. Spark prunes each task to k rows a group before the shuffle."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= k)


def best(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_k(df, by, order, 1, "_rank").drop("_rank")


def running_sums(df: DataFrame, by: Sequence[str], order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    """Adds, for each name in sums, its running sum over the group in this order (the row included; the order is total inside a group), and its total as
    ``<name>_all``. Rows are dealt by ranges of group and order, so that no group comes to one task; the parts' sums are joined back."""
    cut = df.withColumns(sums).repartitionByRange(*by, *order).withColumn("_p", F.spark_partition_id())
    # Both uses below must see the same parts.
    cut = _checkpoint(cut)
    local = Window.partitionBy("_p", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    part = cut.groupBy("_p", *by).agg(*[F.sum(c).alias(c) for c in sums])
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = group.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row a part and group
    base = part.select(F.col("_p").alias("_p2"), *[F.col(c).alias(f"_by_{c}") for c in by], *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_before_{c}") for c in sums], *[F.sum(c).over(group).alias(f"{c}_all") for c in sums])
    on = F.col("_p") == F.col("_p2")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    met = cut.withColumns({c: F.sum(c).over(local) for c in sums}).join(base, on)
    return met.withColumns({c: F.col(c) + F.col(f"_before_{c}") for c in sums}).drop("_p", "_p2", *[f"_by_{c}" for c in by], *[f"_before_{c}" for c in sums])


def running_least(df: DataFrame, by: Sequence[str], order: Sequence[Column], least: dict[str, Column]) -> DataFrame:
    """Adds, for each name in least, its smallest value in the group up to this row (included), as ``running_sums`` adds sums."""
    cut = _checkpoint(df.withColumns(least).repartitionByRange(*by, *order).withColumn("_p", F.spark_partition_id()))
    local = Window.partitionBy("_p", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    part = cut.groupBy("_p", *by).agg(*[F.min(c).alias(c) for c in least])
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = group.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row a part and group
    base = part.select(F.col("_p").alias("_p2"), *[F.col(c).alias(f"_by_{c}") for c in by], *[F.min(c).over(before).alias(f"_before_{c}") for c in least])
    on = F.col("_p") == F.col("_p2")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    met = cut.withColumns({c: F.min(c).over(local) for c in least}).join(base, on)
    return met.withColumns({c: F.least(F.col(c), F.col(f"_before_{c}")) for c in least}).drop("_p", "_p2", *[f"_by_{c}" for c in by], *[f"_before_{c}" for c in least])


def price_bands(products: DataFrame, bands: int = 4, group: str = "category", price: str = "price", key: str = "sku") -> DataFrame:
    """Quantile band of the price in its group; groups with fewer distinct prices than bands are one band."""
    kinds = products.groupBy(F.col(group).alias("_g")).agg(F.count_distinct(price).alias("_kinds"))
    placed = running_sums(products, [group], [F.col(price), F.col(key)], {"_n": F.lit(1)})
    met = placed.join(kinds, F.col(group).eqNullSafe(F.col("_g")))
    return met.withColumn("band", F.when(F.col("_kinds") < bands, 0).otherwise(rank_band(F.col("_n"), F.col("_n_all"), bands))).select(*products.columns, "band")


def listing_attributes(products: DataFrame, bands: int = 4) -> DataFrame:
    """(sku, brand, color, band): what lists are told apart by; products without a brand are ``_unbranded``, without a colour ``_multi``."""
    p = price_bands(products, bands)
    fill = lambda c, to: F.coalesce(F.when(F.trim(c) != "", F.col(c)), F.lit(to)).alias(c)
    return p.select("sku", fill("brand", "_unbranded"), fill("color", "_multi"), "band")


def minmax(c: Column, by: Sequence[str]) -> Column:
    """Scaled to 0..1 in its group; all 1 if constant."""
    w = Window.partitionBy(*by)
    span = F.max(c).over(w) - F.min(c).over(w)
    return F.when(span < 1e-12, 1.0).otherwise((c - F.min(c).over(w)) / span)


def diversify(rows: DataFrame, group: str, item: str, relevance: str, attributes: dict[str, float], lam: float = 0.7, k: int = 24, pin: int = 0, pool: int | None = 48) -> DataFrame:
    """Greedy marginal relevance: lam * relevance - (1 - lam) * highest similarity to those chosen, where similarity is the weight of
    attributes in common. Each group's pool is cut to ``pool`` rows first, so a group fits a task (None: it is as large as its group). (group, item, position, original_position, score)"""
    names, weights = list(attributes), list(attributes.values())
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_rank", kind="stable").reset_index(drop=True)
        rel = pdf[relevance].astype(float).tolist()
        attrs = list(pdf[names].itertuples(index=False, name=None))
        close = [0.0] * len(pdf)
        left, out = list(range(len(pdf))), []
        for step in range(min(k, len(pdf))):
            gain = {i: lam * rel[i] - (1 - lam) * close[i] for i in left}
            j = step if step < pin else max(left, key=lambda i: (gain[i], -i))
            out.append((pdf[group][j], pdf[item][j], step + 1, j + 1, rel[j] if step < pin else gain[j]))
            left.remove(j)
            for i in left:
                close[i] = max(close[i], sum(w for w, a, b in zip(weights, attrs[i], attrs[j], strict=True) if a == b))
        return pd.DataFrame(out, columns=[group, item, "position", "original_position", "score"])

    pruned = top_k(rows, [group], [F.desc(relevance), F.asc(item)], (1 << 31) - 1 if pool is None else pool, "_rank")
    return pruned.groupBy(group).applyInPandas(run, f"{group} {kinds[group]}, {item} {kinds[item]}, position int, original_position int, score double")


def list_metrics(ranked: DataFrame, relevant: DataFrame, group: str, item: str, k: int) -> DataFrame:
    """Precision at k per group. ranked: group, item, position; relevant: group, item."""
    hit = ranked.where(F.col("position") <= k).join(relevant.select(group, item).distinct().withColumn("_hit", F.lit(1)), [group, item], "left")
    return hit.groupBy(group).agg((F.count("_hit") / k).alias("precision_at_k"))


def diversity(ranked: DataFrame, group: str, item: str, attributes: dict[str, float]) -> DataFrame:
    """Mean distance of the pairs of a list. Lists are short; pairs stay inside one."""
    a, b = ranked.alias("a"), ranked.alias("b")
    same = sum((F.when(F.col(f"a.{n}") == F.col(f"b.{n}"), w).otherwise(0.0) for n, w in attributes.items()), F.lit(0.0))
    pairs = a.join(b, (F.col(f"a.{group}") == F.col(f"b.{group}")) & (F.col(f"a.{item}") < F.col(f"b.{item}")))
    return pairs.groupBy(F.col(f"a.{group}").alias(group)).agg(F.avg(1 - same).alias("diversity"))


def catalogue_coverage(ranked: DataFrame, catalogue: DataFrame, item: str) -> DataFrame:
    """One row: the share of the catalogue's items that stand in any list."""
    shown = ranked.select(item).distinct().join(catalogue.select(item).distinct(), item, "left_semi").agg(F.count("*").alias("shown"))
    return catalogue.agg(F.count_distinct(item).alias("items")).join(F.broadcast(shown)).select("shown", "items", (F.col("shown") / F.col("items")).alias("coverage"))  # one row


def distinct_shares(ranked: DataFrame, group: str, attributes: Sequence[str]) -> DataFrame:
    """Per list and attribute, different values over rows."""
    return ranked.groupBy(group).agg(*[(F.count_distinct(a) / F.count("*")).alias(f"{a}_share") for a in attributes])


def trade_offs(rows: DataFrame, group: str, item: str, relevance: str, attributes: dict[str, float], grid: Sequence[float], relevant: DataFrame | None = None, k: int = 24, pin: int = 0, pool: int = 48) -> DataFrame:
    """A row for each weight of relevance: mean diversity of the lists, mean relevance and what it loses against the order by relevance alone, precision on ``relevant`` (group, item),
    the share of places that changed, and the mean share of different values of each attribute."""
    out = None
    for lam in grid:
        r = _checkpoint(diversify(rows, group, item, relevance, attributes, lam, k, pin, pool).join(rows.select(group, item, relevance, *attributes), [group, item]))
        first = r.groupBy(group).agg(F.max("position").alias("n")).join(rows, group)
        plain = top_k(first, [group], [F.desc(relevance), F.asc(item)], k, "_r").where(F.col("_r") <= F.col("n")).groupBy(group).agg(F.avg(relevance).alias("plain"))
        per = r.groupBy(group).agg(F.avg(relevance).alias("relevance"), F.avg((F.col("position") != F.col("original_position")).cast("double")).alias("moved"), *[(F.count_distinct(a) / F.count("*")).alias(f"{a}_distinct") for a in attributes])
        per = per.join(plain, group).join(diversity(r, group, item, attributes), group, "left")
        if relevant is not None:
            hit = list_metrics(r, relevant, group, item, k).join(relevant.select(group).distinct(), group, "left_semi")
            per = per.join(hit, group, "left")
        names = ["diversity", "relevance", "moved", *[f"{a}_distinct" for a in attributes], *(["precision_at_k"] if relevant is not None else [])]
        one = per.agg(*[F.avg(F.coalesce(c, F.lit(0.0)) if c == "diversity" else F.col(c)).alias(c) for c in names], F.avg(F.col("plain") - F.col("relevance")).alias("relevance_loss"))
        one = one.select(F.lit(float(lam)).alias("lam"), "*")
        out = one if out is None else out.unionByName(one)
    return out
