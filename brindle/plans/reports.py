"""Queries about reports on searches, lists and features, and small functions on JSON, paths and paired arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions import exprs
from brindle.functions import text as tx
from brindle.operators import drift, models, ranking, recs, search, supply
from brindle.sources.tables import Tables

from .customers import _round
from .registry import LINES, SEARCHES, query
from .supply import _WEEKS, KEYS, panel


@query("""WITH p AS (SELECT CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END AS y, value / 100.0 AS p FROM events) SELECT round(avg(abs(y - p)), 4) + 0.0 AS mae, round(avg((y - p) * (y - p)), 4) + 0.0 AS brier, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 4) + 0.0 AS r2 FROM p""")
def prediction_errors(t: Tables) -> DataFrame:
    return _round(models.errors(t.events.select((F.col("event_type") == "purchase").cast("double").alias("y"), (F.col("value") / 100).alias("p")), "y", "p"))


@query("""SELECT 'l_linenumber' AS feature, count(DISTINCT l_linenumber) AS distinct_values, count(DISTINCT l_linenumber) > 20 AS continuous FROM lineitem UNION ALL SELECT 'l_suppkey', count(DISTINCT l_suppkey), count(DISTINCT l_suppkey) > 20 FROM lineitem
UNION ALL SELECT 'l_quantity', count(DISTINCT l_quantity), true FROM lineitem UNION ALL SELECT 'l_discount', count(DISTINCT l_discount), true FROM lineitem""")
def feature_kinds(t: Tables) -> DataFrame:
    d = t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_quantity").cast("double").alias("l_quantity"), F.col("l_discount").cast("double").alias("l_discount"), "l_returnflag")
    return drift.feature_kinds(d, leave_out=("l_orderkey",))


@query("""WITH f AS (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n_day FROM events GROUP BY 1, 2) SELECT event_id, e.user_id AS customer_id, n_day FROM events e LEFT JOIN f ON f.user_id = e.user_id AND f.d = CAST(e.ts AS DATE) AND f.n_day > 1 WHERE event_type = 'purchase'""")
def point_in_time_features(t: Tables) -> DataFrame:
    daily = t.events.groupBy("customer_id", F.to_date("event_ts").alias("as_of_date")).agg(F.count("*").alias("n_day")).where("n_day > 1")
    p = t.events.where("event_type = 'purchase'").select("event_id", "customer_id", F.col("event_ts").alias("predicted_at"))
    return drift.with_features(p, daily, "customer_id").select("event_id", "customer_id", "n_day")


_FALL = f"WITH {SEARCHES}, n AS (SELECT query_text AS query, count(*) AS n, min(query_id) AS i, min(category_id) AS category FROM searches GROUP BY 1), f AS (SELECT query, category, CASE i % 4 WHEN 0 THEN 'relaxed' WHEN 1 THEN 'category' WHEN 2 THEN 'global' END AS strategy FROM n WHERE i % 4 < 3)"


def fallbacks(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(query, category, strategy) of three of four queries, by their first id, and (query, n) of all."""
    n = t.queries.groupBy(F.col("query_text").alias("query")).agg(F.count("*").alias("n"), F.min("query_id").alias("i"), F.min("category_id").alias("category"))
    s = F.get(F.array(F.lit("relaxed"), F.lit("category"), F.lit("global")), (F.col("i") % 4).cast("int"))
    return n.where("i % 4 < 3").select("query", "category", s.alias("strategy")), n.select("query", "n")


@query(_FALL + ", g AS (SELECT coalesce(strategy, 'none') AS strategy, count(*) AS queries, CAST(sum(n) AS BIGINT) AS searches FROM n LEFT JOIN f ON n.query = f.query GROUP BY 1) SELECT strategy, queries, searches, round(searches / sum(searches) OVER (), 4) + 0.0 AS share FROM g")
def strategy_shares(t: Tables) -> DataFrame:
    return _round(search.strategy_shares(*fallbacks(t)))


_TREND = ", tr AS (SELECT source AS category, doc_id AS sku, CAST(n_chars % 1000 AS DOUBLE) AS score FROM documents WHERE doc_id % 2 = 1), rc AS (SELECT category, sku, row_number() OVER (PARTITION BY category ORDER BY score DESC, sku) AS rank FROM tr), rg AS (SELECT sku, row_number() OVER (ORDER BY score DESC, sku) AS rank FROM tr)"


@query(_FALL + _TREND + " SELECT query, sku, rank FROM f JOIN rc ON rc.category = f.category WHERE strategy = 'category' AND rank <= 5 UNION ALL SELECT query, sku, rank FROM f, rg WHERE strategy = 'global' AND rank <= 5")
def fallback_products(t: Tables) -> DataFrame:
    """Of two snapshots the later one (odd ids) counts."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 2).cast("int"))
    trend = t.raw("documents").select(day.alias("snapshot_date"), F.col("source").alias("category"), F.col("doc_id").alias("sku"), (F.col("n_chars") % 1000).cast("double").alias("score"))
    return search.fallback_products(fallbacks(t)[0], trend, 5).withColumn("rank", F.col("rank").cast("long"))


_LISTS = "WITH l AS (SELECT lower(p_name) AS query, p_partkey AS sku, p_brand AS brand, p_type AS category, row_number() OVER (PARTITION BY lower(p_name) ORDER BY p_size DESC, p_partkey) AS rank FROM part), k AS (SELECT * FROM l WHERE rank <= 3)"


def short_lists(t: Tables) -> DataFrame:
    return ranking.top_k(t.products.withColumn("query", F.lower("title")), ["query"], [F.desc("size"), F.asc("sku")], 3)


@query(_LISTS + " SELECT count(DISTINCT k.sku) AS shown, (SELECT count(DISTINCT p_partkey) FROM part) AS items, round(count(DISTINCT k.sku) / (SELECT count(DISTINCT p_partkey) FROM part), 4) + 0.0 AS coverage FROM k")
def catalogue_coverage(t: Tables) -> DataFrame:
    return _round(ranking.catalogue_coverage(short_lists(t), t.products, "sku"))


@query(_LISTS + " SELECT query, round(count(DISTINCT brand) / count(*), 4) + 0.0 AS brand_share, round(count(DISTINCT category) / count(*), 4) + 0.0 AS category_share FROM k GROUP BY 1")
def list_distinct_shares(t: Tables) -> DataFrame:
    return _round(ranking.distinct_shares(short_lists(t), "query", ["brand", "category"]))


@query(_LISTS + " SELECT query, round(count(*) FILTER (WHERE sku % 3 = 0) / 3.0, 4) + 0.0 AS precision_at_k FROM k GROUP BY 1")
def list_precision(t: Tables) -> DataFrame:
    ranked = short_lists(t).withColumn("position", F.col("rank"))
    return _round(ranking.list_metrics(ranked, t.products.where("sku % 3 = 0").select(F.lower("title").alias("query"), "sku"), "query", "sku", 3))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k, to_json({'id': event_id, 'type': event_type}) AS encoded, concat_ws(' > ', event_type, CASE WHEN event_id % 2 = 0 THEN 'even' END, 'leaf') AS path,
 CASE WHEN event_id % 3 <> 0 THEN array_to_string(['a' || event_type, 'b' || CAST(event_id AS VARCHAR)], ',') END AS pairs FROM events""")
def json_paths_and_pairs(t: Tables) -> DataFrame:
    kind, n = F.col("event_type"), F.col("event_id").cast("string")
    left, right = F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.when(F.col("event_id") % 3 != 0, F.array(kind, n, kind)).otherwise(F.array(kind))
    pairs = F.array_join(F.transform(exprs.paired(left, right, 2), lambda x: F.concat(x["a"], x["b"])), ",")
    return t.raw("events").select(
        "event_id", F.element_at(exprs.from_json_map(F.col("props")), "k").alias("k"), F.to_json(F.struct(F.col("event_id").alias("id"), kind.alias("type"))).alias("encoded"),
        exprs.path_of(kind, F.when(F.col("event_id") % 2 == 0, "even"), F.lit("leaf")).alias("path"), pairs.alias("pairs"),
    )


@query("""SELECT p_partkey AS sku, lower(p_name || ' ' || p_name || ' ' || p_type) AS training_text, list_sort(list_transform(list_filter(['small', 'red', 'green', 'blue', 'small red'], lambda w: regexp_matches(lower(p_name), '\\b' || w || '\\b')), lambda w: {'n': -length(w), 'w': w}))[1].w AS longest FROM part""")
def title_texts(t: Tables) -> DataFrame:
    return t.products.select("sku", tx.weighted_title(F.col("title"), F.col("category")).alias("training_text"), tx.longest_known(F.col("title"), ["small", "red", "green", "blue", "small red"]).alias("longest"))


@query(f"""WITH {_WEEKS}, o AS (SELECT unnest(['2000-03-27', '2000-09-25', '2001-03-26']) AS origin), fc AS (SELECT origin, category, size, avg(units) AS p50, quantile_cont(units, 0.1) AS q1, quantile_cont(units, 0.9) AS q9 FROM pa JOIN o ON week_start <= CAST(origin AS DATE) AND week_start > CAST(origin AS DATE) - 56 GROUP BY 1, 2, 3),
j AS (SELECT fc.*, units FROM fc JOIN pa ON fc.category = pa.category AND fc.size = pa.size AND (week_start - CAST(origin AS DATE)) % 7 = 0 AND (week_start - CAST(origin AS DATE)) // 7 BETWEEN 1 AND 12)
SELECT origin, round(sum(abs(units - p50)) / sum(abs(units)), 4) + 0.0 AS wape, round((sum(p50) - sum(units)) / sum(units), 4) + 0.0 AS bias, round(avg(CASE WHEN units BETWEEN least(q1, p50) AND greatest(q9, p50) THEN 1.0 ELSE 0.0 END), 4) + 0.0 AS coverage, count(*) AS n FROM j GROUP BY 1""")
def rolling_backtest(t: Tables) -> DataFrame:
    return _round(supply.rolling_backtest(panel(t), KEYS, ["2000-03-27", "2000-09-25", "2001-03-26"]))


_HOME = f"""WITH {LINES}, s5 AS (SELECT sku, category, q, row_number() OVER (PARTITION BY category ORDER BY q DESC, sku) AS r FROM (SELECT sku, category, sum(quantity) AS q FROM lines GROUP BY 1, 2)), tr AS (SELECT sku, category, ln(1 + q) - 3 AS z FROM s5 WHERE r <= 5),
md AS (SELECT DISTINCT p_type AS category, CASE WHEN length(p_type) % 2 = 0 THEN 'for you' ELSE 'popular' END AS module FROM part), po AS (SELECT module, u.sku, u.category, coalesce(z, 0) AS z FROM (SELECT module, sku, tr.category FROM md JOIN tr ON md.category = tr.category UNION SELECT 'small things', p_partkey, p_type FROM part WHERE p_size = 1) u LEFT JOIN tr ON tr.sku = u.sku),
af AS (SELECT customer_id, category, count(*) / (count(*) + 3) AS a FROM lines GROUP BY 1, 2), pr AS (SELECT category, avg(quantity) / 100 AS p FROM lines GROUP BY 1),
x AS (SELECT c_custkey AS customer_id, module, sku, po.category, 0.65 * greatest(coalesce(a, 0), coalesce(p, 0)) + 0.35 / (1 + exp(-z / 2)) AS rel FROM customer CROSS JOIN po LEFT JOIN af ON af.customer_id = c_custkey AND af.category = po.category LEFT JOIN pr ON pr.category = po.category),
y AS (SELECT *, row_number() OVER (PARTITION BY customer_id, module, category ORDER BY rel DESC, sku) > 1 AS again FROM x), k AS (SELECT *, row_number() OVER (PARTITION BY customer_id, module ORDER BY round(0.7 * rel - CASE WHEN again THEN 0.3 ELSE 0 END, 12) DESC, rel DESC, sku) AS position FROM y),
m AS (SELECT customer_id, module, row_number() OVER (PARTITION BY customer_id ORDER BY round(avg(rel), 9) DESC, module) AS module_rank FROM k WHERE position <= 12 GROUP BY 1, 2)
SELECT k.customer_id, k.module, module_rank, sku, position, round(rel, 4) + 0.0 AS relevance FROM k JOIN m ON m.customer_id = k.customer_id AND m.module = k.module WHERE position <= 12"""


@query(_HOME)
def home_modules(t: Tables) -> DataFrame:
    """Three modules for every customer, from what is bought most and a feed of small parts."""
    sold = ranking.top_k(t.lines.groupBy("sku", "category").agg(F.sum("quantity").alias("q")), ["category"], [F.desc("q"), F.asc("sku")], 5)
    trend = sold.select("sku", "category", (F.log1p("q") - 3).alias("z"))
    names = t.products.select("category").distinct()
    modules = names.select(F.when(F.length("category") % 2 == 0, "for you").otherwise("popular").alias("module"), "category")
    feed = t.products.where("size = 1").select(F.lit("small things").alias("module"), "sku", "category")
    affinity = t.lines.groupBy("customer_id", "category").agg(F.count("*").alias("n")).withColumn("affinity", F.col("n") / (F.col("n") + 3))
    prior = t.lines.groupBy("category").agg((F.avg("quantity") / 100).alias("prior"))
    customers = t.raw("customer").select(F.col("c_custkey").alias("customer_id"))
    page = recs.home_page(customers, affinity, recs.candidate_pool(modules, feed, trend), prior)
    return _round(page.withColumns({c: F.col(c).cast("long") for c in ("module_rank", "position")}))
