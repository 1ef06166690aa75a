"""The canonical tables, as views over the raw parquet tables.

Every view is lazy and only a projection or a join on keys, so filters and column pruning reach the scans.
Dimension joins carry no hint: the optimizer broadcasts a side when its statistics are below the session's threshold.
"""

from __future__ import annotations

import re
from functools import cached_property
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


LINES_A_TASK = 250_000


def reachable(spark: SparkSession) -> SparkSession:
    """Lets Python workers that start from now on import this package from where the driver has it. A cluster whose machines
    don't share that path gets the package with --py-files."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        env["PYTHONPATH"] = ":".join([root, *paths])
    return spark


def parse_bytes(text: str) -> int:
    """Bytes of a Spark size such as 10485760b, 256k or 10MB."""
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgt]?)b?", text.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        reachable(spark)
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        # Rows of a compressed file, or of a shuffle, take many times its bytes as a broadcast table, and that passes through the driver.
        spark.conf.set("spark.sql.sources.fileCompressionFactor", "10")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "1MB")
        # Keys are stored so densely that the estimate of a scan still is a third of its bytes or less: five broadcasts of a million keys were 216 MB.
        if parse_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold")) > 1 << 20:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1MB")
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines: one row per line item."""
        li, o, p = self.raw("lineitem"), self.raw("orders"), self.raw("part")
        # Tasks that sort or count lines hold some LINES_A_TASK, however many there are; Spark merges small ones again.
        initial, parts = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", -(-li.count() // LINES_A_TASK)
        if parts > int(self.spark.conf.get(initial, None) or self.spark.conf.get("spark.sql.shuffle.partitions")):
            self.spark.conf.set(initial, str(parts))
        return li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey).select(
            o.o_custkey.alias("customer_id"), li.l_partkey.alias("sku"), li.l_orderkey.alias("order_id"), li.l_linenumber.alias("line_no"),
            o.o_orderdate.alias("order_ts"), li.l_quantity.alias("quantity"), (li.l_extendedprice * (1 - li.l_discount)).alias("net_revenue"),
            (li.l_extendedprice / li.l_quantity).alias("unit_price"), p.p_type.alias("category"), p.p_brand.alias("brand"),
            li.l_suppkey.alias("warehouse_id"), (li.l_returnflag == "R").alias("is_return"), o.o_orderstatus.alias("status"),
        )

    @cached_property
    def products(self) -> DataFrame:
        p = self.raw("part")
        return p.select(F.col("p_partkey").alias("sku"), F.col("p_name").alias("title"), F.col("p_brand").alias("brand"), F.col("p_type").alias("category"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"))

    @cached_property
    def events(self) -> DataFrame:
        """Session events; a session is a customer's day."""
        e = self.raw("events")
        return e.select(
            "event_id", F.col("ts").alias("event_ts"), F.col("user_id").alias("customer_id"), "event_type", "value",
            F.get_json_object("props", "$.k").cast("int").alias("sku"),
            F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("session_id"),
        )

    @cached_property
    def reviews(self) -> DataFrame:
        """Documents as reviews, with quality and toxicity labels where there are any."""
        d, lab = self.raw("documents"), self.raw("labels")
        return d.join(lab, "doc_id", "left").select(F.col("doc_id").alias("review_id"), F.col("source").alias("sku"), F.col("text").alias("body"), "lang", "quality", "toxic")

    @cached_property
    def bodies(self) -> DataFrame:
        """The reviews' texts alone, not exchanged for labels."""
        return self.raw("documents").select(F.col("doc_id").alias("review_id"), F.col("text").alias("body"))

    @cached_property
    def queries(self) -> DataFrame:
        """A search log: the first two words of each document; a click where the document is labelled good."""
        r = self.reviews
        toks = F.filter(F.split(F.lower("body"), r"[^a-z0-9]+"), lambda x: x != "")
        q = F.array_join(F.slice(toks, 1, 2), " ")
        day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("review_id") % 60).cast("int"))
        return r.select(F.col("review_id").alias("query_id"), q.alias("query_text"), day.alias("event_date"), (F.coalesce("quality", F.lit(0)) == 1).alias("clicked"), F.col("sku").alias("category_id"))
