"""Streaming forms of batch jobs. All use event time with watermarks, so state is bounded; sources and sinks are the caller's."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brindle.operators.recs import WEIGHTS


def read_events(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """A folder of parquet files as a stream."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def activity_windows(events: DataFrame, hours: int = 48, late: str = "2 hours", item: str = "sku", ts: str = "event_ts") -> DataFrame:
    """(item, start, end, weight, n): weighted activity per item in tumbling windows."""
    w = F.element_at(F.create_map(*[F.lit(x) for kv in WEIGHTS.items() for x in kv]), F.col("event_type"))
    g = events.withColumn("w", w).where("w is not null").withColumn("at", F.col(ts).cast("timestamp")).withWatermark("at", late)
    g = g.groupBy(F.window("at", f"{hours} hours"), item).agg(F.sum("w").alias("weight"), F.count("*").alias("n"))
    return g.select(item, F.col("window.start").alias("start"), F.col("window.end").alias("end"), "weight", "n")


def burst_windows(events: DataFrame, by: str, hours: int = 48, slide: int = 1, least: int = 4, late: str = "2 hours", ts: str = "event_ts") -> DataFrame:
    """(by, start, end, n): sliding windows that hold ``least`` events."""
    g = events.withColumn("at", F.col(ts).cast("timestamp")).withWatermark("at", late)
    g = g.groupBy(F.window("at", f"{hours} hours", f"{slide} hours"), by).agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return g.select(by, F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n")


def first_alerts(findings: DataFrame, hours: int = 24, ts: str = "created_at") -> DataFrame:
    """Findings without those whose key was seen within the window."""
    f = findings.withColumn("at", F.col(ts).cast("timestamp")).withWatermark("at", f"{hours} hours")
    return f.dropDuplicatesWithinWatermark(["model", "feature", "metric"]).drop("at")


def session_counts(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours", ts: str = "event_ts") -> DataFrame:
    """(customer_id, start, end, views, clicks): sessions that a gap ends."""
    e = events.withColumn("at", F.col(ts).cast("timestamp")).withWatermark("at", late)
    g = e.groupBy(F.session_window("at", gap), "customer_id").agg(F.count_if(F.col("event_type") == "view").alias("views"), F.count_if(F.col("event_type") == "click").alias("clicks"))
    return g.select("customer_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "views", "clicks")


def merge_statistics(log: DataFrame, context: list[str], state: str, checkpoint: str) -> StreamingQuery:
    """Keeps a bandit's sufficient statistics under ``state``: each batch adds a part; the state is the sum of the parts, and a part written twice
    (after a failure) replaces itself."""
    from brindle.operators.marketing import bandit_statistics

    def add(batch: DataFrame, epoch: int) -> None:
        a, b = bandit_statistics(batch, context)
        part = a.unionByName(b.withColumn("j", F.lit(-1)).select(*a.columns))
        part.write.mode("overwrite").parquet(str(Path(state) / f"part={epoch}"))

    return log.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_statistics(spark: SparkSession, state: str) -> tuple[DataFrame, DataFrame]:
    s = spark.read.parquet(state).groupBy("arm", "i", "j").agg(F.sum("value").alias("value"))
    return s.where("j >= 0"), s.where("j < 0").drop("j")


def run_to_end(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """All there is now, to parquet; returns what was written."""
    q = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.read.parquet(path)
