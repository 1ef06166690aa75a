"""Queries that go through a reader, a sink or a stream: what is written and read again, or streamed to the end, equals what SQL says of the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.operators.graph import _checkpoint
from brindle.operators.recs import WEIGHTS
from brindle.sources import io
from brindle.sources.tables import Tables
from brindle.streaming import jobs

from .content import _BANDIT, bandit_log
from .customers import _round
from .measures import _FIND, found
from .registry import EVENTS, query


def folder(t: Tables, name: str) -> str:
    """A new folder in the one that the cluster shares."""
    _checkpoint(t.spark.range(0))  # sets a folder where none is set
    return f"{t.spark.sparkContext.getCheckpointDir()}/inout/{uuid.uuid4().hex}/{name}"


@query("SELECT CAST(c_custkey AS VARCHAR) AS customer_id FROM customer WHERE c_custkey % 10 <> 3")
def csv_seed_list(t: Tables) -> DataFrame:
    """Ids from a CSV file without a column of the asked name: its first column counts, nulls don't."""
    at = folder(t, "seeds")
    t.raw("customer").select(F.when(F.col("c_custkey") % 10 != 3, F.col("c_custkey")).alias("id"), "c_name").write.csv(at, header=True)
    return io.read_csv_ids(t.spark, at, "customer_id")


@query("SELECT p_name AS line, count(*) AS n FROM part WHERE p_partkey % 10 <> 0 GROUP BY 1")
def text_lines(t: Tables) -> DataFrame:
    """Lines of a text file, trimmed, without blank ones."""
    at = folder(t, "lines")
    t.raw("part").select(F.when(F.col("p_partkey") % 10 == 0, "   ").otherwise(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("value")).write.text(at)
    return io.read_lines(t.spark, at).groupBy("line").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, p_name FROM part WHERE p_size > 10 ORDER BY p_size DESC, p_partkey LIMIT 100")
def configured_scan(t: Tables) -> DataFrame:
    """A scan that a configuration describes, with a limit in a stated order."""
    t.raw("part").createOrReplaceTempView("brindle_part")
    return io.scan(t.spark, "brindle_part", ["p_partkey", "p_name", "p_size"], "p_size > 10", 100, [F.desc("p_size"), "p_partkey"]).drop("p_size")


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderpriority = '1-URGENT' GROUP BY 1")
def parameterised_sql(t: Tables) -> DataFrame:
    """SQL text with parameters by name."""
    t.raw("orders").createOrReplaceTempView("brindle_orders")
    sql = "SELECT o_orderstatus AS status, count(*) AS n FROM brindle_orders WHERE o_orderdate >= CAST(:since AS TIMESTAMP_NTZ) AND o_orderpriority = :kind GROUP BY 1"
    return io.run_sql(t.spark, sql, {"since": "1997-01-01 00:00:00", "kind": "1-URGENT"})


@query("SELECT o_orderkey AS order_id, o_orderstatus AS status FROM orders WHERE o_orderstatus IN ('O', 'F')")
def sink_append(t: Tables) -> DataFrame:
    """A table that is replaced, then appended to; an empty frame replaces nothing."""
    at, o = folder(t, "orders"), t.raw("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"))
    io.write(o, at)
    io.write(o.where("status = 'O'"), at)
    io.write(o.where("status = 'none'"), at)
    io.write(o.where("status = 'F'"), at, mode="append")
    return t.spark.read.parquet(at)


@query("SELECT c_custkey AS customer_id, c_mktsegment AS segment, CASE WHEN c_mktsegment = (SELECT min(c_mktsegment) FROM customer) THEN 2 ELSE 1 END AS version FROM customer")
def sink_partitions(t: Tables) -> DataFrame:
    """A partitioned table of which one partition is written anew."""
    at, c = folder(t, "customers"), t.raw("customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"))
    io.write(c.withColumn("version", F.lit(1)), at, partition="segment")
    least = c.agg(F.min("segment")).first()[0]
    io.write(c.where(F.col("segment") == least).withColumn("version", F.lit(2)), at, partition="segment")
    return t.spark.read.parquet(at)


def streamed(t: Tables) -> DataFrame:
    """The events as a stream of one step."""
    at = folder(t, "events")
    t.events.write.parquet(at)
    return jobs.read_events(t.spark, at, 1000)


def to_end(t: Tables, df: DataFrame) -> DataFrame:
    out = jobs.run_to_end(df, folder(t, "out"), folder(t, "state"))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


_CLOSED = "(SELECT max(event_ts) - INTERVAL 2 HOUR FROM ev)"
_WEIGHT = "CASE event_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS.items()) + " END"


@query(f"""WITH {EVENTS}, w AS (SELECT sku, time_bucket(INTERVAL 48 HOUR, event_ts, TIMESTAMP '1970-01-01') AS "start", {_WEIGHT} AS w FROM ev) SELECT sku, "start", "start" + INTERVAL 48 HOUR AS "end", round(sum(w), 4) + 0.0 AS weight, count(*) AS n FROM w WHERE w IS NOT NULL AND "start" + INTERVAL 48 HOUR <= (SELECT max(event_ts) - INTERVAL 2 HOUR FROM ev WHERE {_WEIGHT} IS NOT NULL) GROUP BY 1, 2, 3""")
def stream_activity(t: Tables) -> DataFrame:
    """Weighted activity in windows of 48 hours, of all that the watermark has closed."""
    return _round(to_end(t, jobs.activity_windows(streamed(t))))


@query(f"""WITH {EVENTS}, s AS (SELECT customer_id, event_ts, unnest(range(0, 2)) AS k FROM ev), w AS (SELECT customer_id, time_bucket(INTERVAL 24 HOUR, event_ts, TIMESTAMP '1970-01-01') - k * INTERVAL 24 HOUR AS "start" FROM s) SELECT customer_id, "start", "start" + INTERVAL 48 HOUR AS "end", count(*) AS n FROM w WHERE "start" + INTERVAL 48 HOUR <= {_CLOSED} GROUP BY 1, 2, 3 HAVING count(*) >= 3""")
def stream_bursts(t: Tables) -> DataFrame:
    """Sliding windows with three events of a customer."""
    return to_end(t, jobs.burst_windows(streamed(t), "customer_id", 48, 24, 3))


@query(f"""WITH {EVENTS}, g AS (SELECT *, CASE WHEN event_ts - lag(event_ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM ev WINDOW w AS (PARTITION BY customer_id ORDER BY event_ts, event_id)), s AS (SELECT *, sum(fresh) OVER (PARTITION BY customer_id ORDER BY event_ts, event_id) AS s FROM g)
SELECT customer_id, min(event_ts) AS "start", max(event_ts) + INTERVAL 30 MINUTE AS "end", count(*) FILTER (WHERE event_type = 'view') AS views, count(*) FILTER (WHERE event_type = 'click') AS clicks FROM s GROUP BY customer_id, s HAVING max(event_ts) + INTERVAL 30 MINUTE <= {_CLOSED}""")
def stream_sessions(t: Tables) -> DataFrame:
    """Sessions that a gap of half an hour ends."""
    return to_end(t, jobs.session_counts(streamed(t)))


@query(_BANDIT + " SELECT arm, CAST(i AS INT) AS i, round(sum(x[i + 1] * reward), 4) + 0.0 AS value FROM e GROUP BY 1, 2")
def stream_bandit(t: Tables) -> DataFrame:
    """The bandit's state after a log in four files, each a batch that adds its part."""
    log, state = folder(t, "log"), folder(t, "state")
    bandit_log(t).repartition(4).write.parquet(log)
    jobs.merge_statistics(jobs.read_events(t.spark, log, 1), ["bias", "value", "tier"], state, folder(t, "seen")).awaitTermination()
    return _round(jobs.read_statistics(t.spark, state)[1])


@query(f"WITH {_FIND} SELECT DISTINCT model, feature, metric FROM fi")
def stream_alerts(t: Tables) -> DataFrame:
    """Findings of one step without those whose key was there before."""
    at = folder(t, "findings")
    found(t).write.parquet(at)
    return jobs.run_to_end(jobs.first_alerts(jobs.read_events(t.spark, at, 1000)), folder(t, "out"), folder(t, "state")).select("model", "feature", "metric")
