"""Customer and product features as of a time: windows, recency and value, decayed mixes, histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.exprs import AGGREGATES, age_days, clip, half_life
from brindle.sources.config import Aggregation, FeatureView, Source


def _aggregate(a: Aggregation, inside: Column) -> Column:
    v = F.when(inside, F.col(a.column))
    return AGGREGATES[a.function](v)


def window_features(rows: DataFrame, source: Source, entity: str, as_of: str, windows: tuple[int, ...]) -> DataFrame:
    """All aggregates over all look-back windows [as_of - w days, as_of) in one pass: conditional aggregates, one shuffle."""
    end = F.lit(as_of).cast("timestamp_ntz")
    start = lambda w: end - F.expr(f"INTERVAL {w} DAYS")
    ts = F.col(source.timestamp)
    df = rows.where((ts >= start(max(windows))) & (ts < end) & F.col(entity).isNotNull())
    df = df.where(F.expr(source.filter)) if source.filter else df
    return df.groupBy(entity).agg(*[_aggregate(a, ts >= start(w)).alias(f"{a.alias}_{w}d") for w in windows for a in source.aggregations])


def materialize(view: FeatureView, tables: dict[str, DataFrame], as_of: str) -> DataFrame:
    """One row per entity seen in any source; missing values are 0; static columns and validity dates follow."""
    out = None
    for s in view.sources:
        part = window_features(tables[s.table], s, view.entity, as_of, view.windows)
        out = part if out is None else out.join(part, view.entity, "full_outer")
    out = out.fillna(0)
    if view.static_table:
        out = out.join(tables[view.static_table].select(view.entity, *view.static_columns), view.entity, "left")
    day = F.lit(as_of).cast("date")
    return out.withColumn("as_of_date", day).withColumn("expires_at", F.date_add(day, view.ttl_days))


def order_values(lines: DataFrame) -> DataFrame:
    return lines.groupBy("customer_id", "order_id").agg(F.min("order_ts").alias("order_ts"), F.sum("net_revenue").alias("order_value"), F.sum("quantity").alias("n_items"))


def rfm(lines: DataFrame, as_of: str) -> DataFrame:
    """Recency, frequency, value, and gaps between orders. Line -> order -> customer."""
    prev = F.lag("order_ts").over(Window.partitionBy("customer_id").orderBy("order_ts", "order_id"))
    orders = order_values(lines).withColumn("gap", age_days(as_of, prev) - age_days(as_of, "order_ts")).withColumn("age", age_days(as_of, "order_ts"))
    g = orders.groupBy("customer_id").agg(
        F.min("age").alias("recency_days"), F.max("age").alias("tenure_days"), F.count("order_id").alias("frequency"),
        F.sum("order_value").alias("monetary_total"), F.avg("order_value").alias("monetary_mean"), F.avg("n_items").alias("items_mean"),
        F.avg("gap").alias("gap_mean"), F.stddev_samp("gap").alias("gap_std"),
    )
    return g.withColumns({
        "log_recency": F.log1p("recency_days"), "log_frequency": F.log1p("frequency"),
        "log_monetary_total": F.log1p(clip(F.col("monetary_total"), 0.0)), "log_monetary_mean": F.log1p(clip(F.col("monetary_mean"), 0.0)),
        "orders_per_month": F.col("frequency") / clip(F.col("tenure_days") / 30, 1.0),
        "recency_over_gap": F.col("recency_days") / clip(F.coalesce("gap_mean", "recency_days"), 1.0),
    })


def category_mix(lines: DataFrame, as_of: str, categories: list[str], life: float = 90.0) -> DataFrame:
    """Shares of decayed spend per category (others pooled), their entropy and the total. The pivot's columns are given, so it is one pass."""
    w = half_life(age_days(as_of, "order_ts"), life) * clip(F.col("net_revenue"), 0.0)
    cat = F.when(F.col("category").isin(categories), F.col("category")).otherwise("other")
    names = [*categories, "other"]
    wide = lines.select("customer_id", cat.alias("cat"), w.alias("w")).groupBy("customer_id").agg(*[F.coalesce(F.sum(F.when(F.col("cat") == c, F.col("w"))), F.lit(0.0)).alias(c) for c in names])
    total = sum((F.col(c) for c in names), F.lit(0.0))
    share = lambda c: F.when(total > 0, F.col(c) / total).otherwise(0.0)
    p = lambda c: clip(share(c), 1e-12, 1.0)
    entropy = -sum((p(c) * F.log(p(c)) for c in names), F.lit(0.0))
    return wide.select("customer_id", *[share(c).alias(f"share_{i}") for i, c in enumerate(names)], entropy.alias("cat_entropy"), total.alias("decayed_spend"))


def sessions(events: DataFrame, as_of: str, windows: tuple[int, ...] = (7, 30, 90)) -> DataFrame:
    """Event -> session -> customer: recency, counts in look-back windows, and their trend."""
    s = events.where("customer_id is not null").groupBy("customer_id", "session_id").agg(
        F.min("event_ts").alias("start"), F.count("*").alias("n_events"), F.count_if(F.col("event_type") == "click").alias("n_clicks")
    )
    s = s.withColumn("days_ago", age_days(as_of, "start"))
    out = s.groupBy("customer_id").agg(
        F.min("days_ago").alias("session_recency_days"), F.count("session_id").alias("sessions_total"), F.avg("n_events").alias("events_per_session"),
        F.sum("n_clicks").alias("clicks_total"), *[F.count_if(F.col("days_ago") <= w).alias(f"sessions_{w}d") for w in windows],
    )
    return out.withColumn("visit_trend", (F.col("sessions_30d") + 1) / (F.col("sessions_90d") / 3 + 1)).withColumn("log_session_recency", F.log1p("session_recency_days"))


def repeat_summary(lines: DataFrame, as_of: str) -> DataFrame:
    """Repeat purchases on distinct days, in weeks: frequency, recency, age, and mean value of repeat days."""
    days = lines.groupBy("customer_id", F.to_date("order_ts").alias("day")).agg(F.sum("net_revenue").alias("value"))
    first = F.min("day").over(Window.partitionBy("customer_id"))
    d = days.withColumn("first", first)
    return d.groupBy("customer_id").agg(
        (F.count("*") - 1).alias("frequency"), (F.datediff(F.max("day"), F.min("day")) / 7).alias("recency"),
        (F.datediff(F.lit(as_of).cast("date"), F.min("day")) / 7).alias("T"), F.coalesce(F.avg(F.when(F.col("day") > F.col("first"), F.col("value"))), F.lit(0.0)).alias("monetary"),
    )


def customer_vectors(lines: DataFrame, as_of: str, categories: list[str], life: float = 90.0) -> DataFrame:
    """(customer_id, recency, frequency and value components, normalised decayed category counts)."""
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date("order_ts"))
    w = half_life(age, life)
    g = lines.groupBy("customer_id").agg(F.min(age).alias("r"), F.count("*").alias("f"), F.sum("net_revenue").alias("m"), *[F.sum(F.when(F.col("category") == c, w).otherwise(0.0)).alias(f"c{i}") for i, c in enumerate(categories)])
    total = sum((F.col(f"c{i}") for i in range(len(categories))), F.lit(0.0))
    return g.select("customer_id", F.exp(-F.col("r") / 30).alias("v_recency"), F.log1p("f").alias("v_frequency"), F.log1p("m").alias("v_monetary"), *[F.when(total > 0, F.col(f"c{i}") / total).otherwise(0.0).alias(f"v_cat_{i}") for i in range(len(categories))])


def send_history(sends: DataFrame, customer: str = "customer_id", ts: str = "sent_at", key: str = "send_id") -> DataFrame:
    """Point-in-time features of each send from the customer's earlier sends only. sends: customer, ts, key, discount, redeemed 0/1."""
    before = Window.partitionBy(customer).orderBy(ts, key).rowsBetween(Window.unboundedPreceding, -1)
    order = Window.partitionBy(customer).orderBy(ts, key)
    last = F.last(F.when(F.col("redeemed") == 1, F.col(ts)), ignorenulls=True).over(before)
    return sends.withColumns({
        "prior_sends": F.row_number().over(order) - 1,
        "prior_redemptions": F.coalesce(F.sum("redeemed").over(before), F.lit(0)),
        "avg_redeemed_depth": F.avg(F.when(F.col("redeemed") == 1, F.col("discount"))).over(before),
        "days_since_redeem": F.datediff(F.col(ts), last),
    }).withColumn("prior_redeem_rate", (F.col("prior_redemptions") + 1) / (F.col("prior_sends") + 4))


def scoring_grid(state: DataFrame, depths: list[int], name: str = "discount") -> DataFrame:
    """Each row once per depth: a literal array, exploded, instead of a join."""
    return state.drop(name).withColumn(name, F.explode(F.array(*[F.lit(d) for d in depths])))


def has_order_in(lines: DataFrame, customers: DataFrame, start: str, end: str) -> DataFrame:
    """(customer_id, churned): 1 for those without an order in [start, end)."""
    ts = F.col("order_ts")
    buyers = lines.where((ts >= F.lit(start).cast("timestamp_ntz")) & (ts < F.lit(end).cast("timestamp_ntz"))).select("customer_id").distinct()
    return customers.join(buyers.withColumn("_b", F.lit(1)), "customer_id", "left").select("customer_id", F.when(F.col("_b").isNull(), 1).otherwise(0).alias("churned"))
