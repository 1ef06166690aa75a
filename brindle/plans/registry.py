"""Where the modules of this package register their queries, and the common parts of their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brindle.functions.exprs import NUDGE
from brindle.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a function of Tables under its name, with the DuckDB SQL for the same rows."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            # "round(x, 4) + 0.0" in the SQL stands for rounded().
            ORACLES[f.__name__] = sql.replace(", 4) + 0.0", f" + {NUDGE}, 4) + 0.0")
        return f

    return add


#: CTEs for the canonical tables.
LINES = """lines AS (
  SELECT o.o_custkey AS customer_id, l.l_partkey AS sku, l.l_orderkey AS order_id, l.l_linenumber AS line_no, o.o_orderdate AS order_ts,
         l.l_quantity AS quantity, l.l_extendedprice * (1 - l.l_discount) AS net_revenue, l.l_extendedprice / l.l_quantity AS unit_price,
         p.p_type AS category, p.p_brand AS brand, l.l_suppkey AS warehouse_id, l.l_returnflag = 'R' AS is_return, o.o_orderstatus AS status
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey)"""
EVENTS = """ev AS (
  SELECT event_id, ts AS event_ts, user_id AS customer_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INT) AS sku,
         CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS session_id
  FROM events)"""
REVIEWS = """reviews AS (
  SELECT d.doc_id AS review_id, d.source AS sku, d.text AS body, d.lang, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
SEARCHES = (
    REVIEWS
    + """, searches AS (
  SELECT review_id AS query_id,
         array_to_string(list_filter(regexp_split_to_array(lower(body), '[^a-z0-9]+'), lambda x: x <> '')[1:2], ' ') AS query_text,
         DATE '2024-01-01' + CAST(review_id % 60 AS INT) AS event_date, coalesce(quality, 0) = 1 AS clicked, sku AS category_id
  FROM reviews)"""
)
