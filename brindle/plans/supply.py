"""Queries about demand, prices, stock and forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.exprs import cut, rounded
from brindle.operators import models, supply
from brindle.sources.tables import Tables

from .customers import _round
from .registry import LINES, query

KEYS = ["category", "size"]
_WEEKS = """wk AS (SELECT p_type AS category, p_size % 5 AS size, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start, sum(l_quantity) AS units FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE o_orderdate >= TIMESTAMP '1999-01-04' GROUP BY 1, 2, 3),
gr AS (SELECT c.*, CAST(w.w AS DATE) AS week_start FROM (SELECT DISTINCT category, size FROM wk) c CROSS JOIN (SELECT unnest(generate_series((SELECT min(week_start) FROM wk), (SELECT max(week_start) FROM wk), INTERVAL 7 DAY)) AS w) w),
pa AS (SELECT gr.*, coalesce(units, 0.0) AS units FROM gr LEFT JOIN wk ON gr.category = wk.category AND gr.size = wk.size AND gr.week_start = wk.week_start)"""


def panel(t: Tables) -> DataFrame:
    p = t.raw("part").select(F.col("p_partkey").alias("sku"), (F.col("p_size") % 5).alias("size"))
    lines = t.lines.where(F.col("order_ts") >= F.lit("1999-01-04").cast("timestamp_ntz")).join(p, "sku")
    return supply.densify(supply.weekly(lines, KEYS), KEYS)


@query(f"WITH {_WEEKS} SELECT * FROM pa")
def weekly_panel_dense(t: Tables) -> DataFrame:
    return panel(t)


@query(f"""WITH {_WEEKS} SELECT category, size, week_start, units, {', '.join(f'lag(units, {n}) OVER w AS lag_{n}' for n in (1, 2, 4, 52))}, {', '.join(f'round(avg(units) OVER (PARTITION BY category, size ORDER BY week_start ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING), 4) + 0.0 AS roll_mean_{n}' for n in (4, 8, 13))},
round(stddev_samp(units) OVER (PARTITION BY category, size ORDER BY week_start ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING), 4) + 0.0 AS roll_std_8, round(avg(units) OVER (PARTITION BY category, size ORDER BY week_start ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) / (lag(units, 52) OVER w + 1), 4) + 0.0 AS yoy_ratio FROM pa WINDOW w AS (PARTITION BY category, size ORDER BY week_start)""")
def lag_roll_features(t: Tables) -> DataFrame:
    f = supply.lag_features(panel(t), KEYS)
    keep = ["units", "lag_1", "lag_2", "lag_4", "lag_52"]
    rest = [c for c in f.columns if c not in [*KEYS, "week_start", *keep]]
    return f.select(*KEYS, "week_start", *keep, *[rounded(F.col(c)).alias(c) for c in rest])


@query("""WITH d AS (SELECT DISTINCT CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start FROM orders), w AS (SELECT *, CAST(weekofyear(week_start) AS INT) AS n FROM d)
SELECT week_start, n AS week_of_year, round(sin(2 * pi() * n / 52.0), 4) + 0.0 AS woy_sin, round(cos(2 * pi() * n / 52.0), 4) + 0.0 AS woy_cos, CAST(n IN (21, 22) AS INT) AS hol_memorial_day, CAST(n = 27 AS INT) AS hol_july_4, CAST(n = 36 AS INT) AS hol_labor_day, CAST(n IN (47, 48) AS INT) AS hol_black_friday, CAST(n IN (50, 51, 52) AS INT) AS hol_holiday_season, CAST(n IN (1, 2) AS INT) AS hol_white_sale FROM w""")
def calendar_features(t: Tables) -> DataFrame:
    return _round(supply.calendar_features(t.raw("orders").select(supply.week("o_orderdate").alias("week_start")).distinct()))


def price_history(t: Tables) -> DataFrame:
    return t.lines.select("sku", "category", F.col("order_ts").alias("effective_date"), F.col("unit_price").alias("price"))


_PANEL = f"""WITH {LINES}, u AS (SELECT sku, CAST(date_trunc('week', order_ts) AS DATE) AS week_start, sum(quantity) AS units, sum(quantity * unit_price) AS revenue FROM lines WHERE NOT is_return GROUP BY 1, 2), p AS (SELECT sku, CAST(date_trunc('week', order_ts) AS DATE) AS week_start, avg(unit_price) AS lp, max(category) AS category FROM lines GROUP BY 1, 2)"""


@query(_PANEL + " SELECT u.sku, category, u.week_start, CAST(weekofyear(u.week_start) AS INT) AS week_of_year, units, round(coalesce(revenue / nullif(units, 0), lp), 4) + 0.0 AS avg_price FROM u JOIN p ON u.sku = p.sku AND u.week_start = p.week_start WHERE units > 0")
def elasticity_panel(t: Tables) -> DataFrame:
    p = supply.elasticity_panel(t.lines, price_history(t))
    return p.withColumn("avg_price", rounded(F.col("avg_price")))


@query()
def elasticity_fit(t: Tables) -> DataFrame:
    return _round(supply.shrink(supply.fit_elasticity(supply.elasticity_panel(t.lines, price_history(t)))))


_STOCK = """fc AS (SELECT p_partkey AS sku, p_partkey % 7 AS warehouse_id, h AS horizon, (p_size + h) * 0.5 AS p10, p_size + h * 1.0 AS p50, (p_size + h) * 1.7 AS p90 FROM part, range(1, 13) r(h)),
st AS (SELECT p_partkey AS sku, p_partkey % 7 AS warehouse_id, p_size * 2 AS on_hand, p_partkey % 11 AS on_order, p_partkey % 5 AS allocated, (p_partkey * 31 % 97) / 100.0 AS margin FROM part),
tm AS (SELECT p_partkey AS sku, 'v' || (p_partkey % 13) AS vendor_id, 10 + p_partkey % 30 AS lead_days, 6 + p_partkey % 4 AS case_pack, 50 + p_partkey % 100 AS moq, p_retailprice / 10 AS unit_cost FROM part)"""


def stock_inputs(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    p, k = t.raw("part"), F.col("p_partkey")
    f = p.select(k.alias("sku"), (k % 7).alias("warehouse_id"), "p_size", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("horizon"))
    n = F.col("p_size") + F.col("horizon")
    fc = f.select("sku", "warehouse_id", "horizon", (n * 0.5).alias("p10"), n.cast("double").alias("p50"), (n * 1.7).alias("p90"))
    st = p.select(k.alias("sku"), (k % 7).alias("warehouse_id"), (F.col("p_size") * 2).alias("on_hand"), (k % 11).alias("on_order"), (k % 5).alias("allocated"), (k * 31 % 97 / 100).alias("margin"))
    tm = p.select(k.alias("sku"), F.concat(F.lit("v"), (k % 13).cast("string")).alias("vendor_id"), (10 + k % 30).alias("lead_days"), (6 + k % 4).alias("case_pack"), (50 + k % 100).alias("moq"), (F.col("p_retailprice") / 10).alias("unit_cost"))
    return fc, st, tm


def _level(weeks: str) -> str:
    w = f"CASE WHEN i < floor({weeks}) THEN 1.0 WHEN i = floor({weeks}) THEN {weeks} - floor({weeks}) ELSE 0.0 END"
    return f"sum({w} * p50) + 1.645 * sqrt(sum({w} * pow(greatest(p90 - p10, 0) / 2.563, 2)))"


_ORDER = f"""WITH {_STOCK}, f AS (SELECT fc.*, tm.vendor_id, lead_days / 7 AS lt, case_pack, moq, unit_cost, row_number() OVER (PARTITION BY fc.sku, warehouse_id ORDER BY horizon) - 1 AS i FROM fc JOIN tm ON fc.sku = tm.sku),
g AS (SELECT sku, warehouse_id, {_level('lt')} AS s, {_level('(lt + 1)')} AS su, any_value(vendor_id) AS vendor_id, any_value(case_pack) AS cp, any_value(moq) AS moq, any_value(unit_cost) AS unit_cost FROM f GROUP BY 1, 2),
j AS (SELECT g.*, on_hand + on_order - allocated AS ip, margin FROM g JOIN st ON g.sku = st.sku AND g.warehouse_id = st.warehouse_id), q AS (SELECT *, CAST(CASE WHEN su <= ip THEN 0 ELSE greatest(ceil((su - ip) / cp) * cp, ceil(moq / cp) * cp) END AS BIGINT) AS qty FROM j WHERE ip <= s), o AS (SELECT *, qty * unit_cost AS cost FROM q WHERE qty > 0)"""


@query(_ORDER + " SELECT sku, warehouse_id, vendor_id, round(s, 4) + 0.0 AS reorder_point, round(su, 4) + 0.0 AS order_up_to, ip AS position, qty AS order_qty, round(unit_cost, 4) + 0.0 AS unit_cost, round(margin, 4) + 0.0 AS margin, round(cost, 4) + 0.0 AS cost FROM o")
def reorder_policy(t: Tables) -> DataFrame:
    return _round(supply.reorder(*stock_inputs(t)))


@query(_ORDER + ", r AS (SELECT *, sum(cost) OVER (ORDER BY margin DESC, sku, warehouse_id ROWS UNBOUNDED PRECEDING) AS rc FROM o) SELECT sku, warehouse_id, qty AS order_qty, round(cost, 4) + 0.0 AS cost, round(rc, 4) + 0.0 AS running_cost FROM r WHERE rc <= 750000")
def reorder_within_budget(t: Tables) -> DataFrame:
    return _round(supply.within_budget(supply.reorder(*stock_inputs(t)), 750_000.0).select("sku", "warehouse_id", "order_qty", "cost", "running_cost"))


def season_stock(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    s = t.raw("part").select(k.alias("sku"), F.col("p_type").alias("category"), (F.col("p_size") * 10).alias("on_hand"), F.col("p_retailprice").alias("price"), (5 + k % 40).alias("weekly_units"), F.date_add(F.lit("2001-01-01").cast("date"), (k % 90).cast("int")).alias("season_end"))
    return supply.excess_stock(s, "2001-01-01")


@query("""SELECT p_partkey AS sku, p_type AS category, p_size * 10 AS on_hand, 5 + p_partkey % 40 AS weekly_units, CAST((p_partkey % 90) // 7 AS INT) AS weeks_left FROM part WHERE (p_partkey % 90) // 7 > 0 AND p_size * 10 > (5 + p_partkey % 40) * ((p_partkey % 90) // 7)""")
def excess_stock(t: Tables) -> DataFrame:
    return season_stock(t).select("sku", "category", "on_hand", "weekly_units", "weeks_left")


@query()
def markdown_dp(t: Tables) -> DataFrame:
    fits = supply.shrink(supply.fit_elasticity(supply.elasticity_panel(t.lines, price_history(t)))).select("category", "elasticity")
    return _round(supply.markdown_plan(season_stock(t), fits))


def _scored(t: Tables) -> DataFrame:
    p = panel(t)
    fc = supply.seasonal_forecast(p, KEYS, "2001-03-26")
    return fc.join(p, [*KEYS, "week_start"]).withColumn("h_bucket", cut(F.col("horizon").cast("double"), [0, 4, 8, 12], ["1-4", "5-8", "9-12"]))


@query(f"""WITH {_WEEKS}, fc0 AS (SELECT category, size, avg(units) AS p50, quantile_cont(units, 0.1) AS q1, quantile_cont(units, 0.9) AS q9 FROM pa WHERE week_start <= DATE '2001-03-26' AND week_start > DATE '2001-03-26' - 56 GROUP BY 1, 2),
fc AS (SELECT category, size, CAST(DATE '2001-03-26' + CAST(h * 7 AS INT) AS DATE) AS week_start, h, least(q1, p50) AS p10, p50, greatest(q9, p50) AS p90 FROM fc0, range(1, 13) r(h)), j AS (SELECT fc.*, units, CASE WHEN h <= 4 THEN '1-4' WHEN h <= 8 THEN '5-8' ELSE '9-12' END AS hb FROM fc JOIN pa ON fc.category = pa.category AND fc.size = pa.size AND fc.week_start = pa.week_start)
SELECT category, hb AS h_bucket, round(sum(abs(units - p50)) / sum(abs(units)), 4) + 0.0 AS wape, round((sum(p50) - sum(units)) / sum(units), 4) + 0.0 AS bias, round(avg(CASE WHEN units BETWEEN p10 AND p90 THEN 1.0 ELSE 0.0 END), 4) + 0.0 AS coverage, count(*) AS n FROM j GROUP BY 1, 2""")
def backtest_metrics(t: Tables) -> DataFrame:
    return _round(supply.forecast_scores(_scored(t), ["category", "h_bucket"]))


ORIGINS = ["2000-03-27", "2000-06-26", "2000-09-25", "2000-12-25", "2001-03-26"]


@query(f"""WITH {_WEEKS}, x AS (SELECT *, avg(units) OVER (PARTITION BY category, size ORDER BY week_start ROWS BETWEEN 19 PRECEDING AND 12 PRECEDING) AS level, count(*) OVER (PARTITION BY category, size ORDER BY week_start ROWS BETWEEN 19 PRECEDING AND 12 PRECEDING) AS k FROM pa),
o AS (SELECT unnest({ORIGINS}) AS origin), f AS (SELECT origin, regr_slope(units, level) AS b, regr_intercept(units, level) AS a FROM o JOIN x ON week_start <= CAST(origin AS DATE) WHERE k > 0 GROUP BY 1),
j AS (SELECT f.origin, CASE WHEN h <= 4 THEN '1-4' WHEN h <= 8 THEN '5-8' ELSE '9-12' END AS h_bucket, units, greatest(a + b * level, 0) AS p FROM (SELECT *, (week_start - CAST(origin AS DATE)) // 7 AS h FROM x, o WHERE k > 0) y JOIN f ON f.origin = y.origin WHERE h BETWEEN 1 AND 12)
SELECT origin, h_bucket, round(sum(abs(units - p)) / sum(abs(units)), 4) + 0.0 AS wape, round((sum(p) - sum(units)) / sum(units), 4) + 0.0 AS bias, count(*) AS n FROM j GROUP BY 1, 2""")
def expanding_backtest(t: Tables) -> DataFrame:
    """A linear model of the level twelve weeks before, fitted anew at each origin."""
    w = Window.partitionBy(*KEYS).orderBy("week_start").rowsBetween(-19, -12)
    x = panel(t).withColumn("level", F.avg("units").over(w))
    out = supply.expanding_backtest(x, KEYS, ["level"], "units", "week_start", ORIGINS)
    out = out.withColumn("h_bucket", cut(F.col("horizon").cast("double"), [0, 4, 8, 12], ["1-4", "5-8", "9-12"])).withColumn("p10", F.col("p50")).withColumn("p90", F.col("p50"))
    return _round(supply.forecast_scores(out, ["origin", "h_bucket"]).drop("coverage"))


FEATURES = ["lag_1", "lag_2", "lag_4", "roll_mean_4", "roll_mean_8", "roll_mean_13", "roll_std_8", "woy_sin", "woy_cos"]


def demand_features(df: DataFrame) -> DataFrame:
    return supply.calendar_features(supply.lag_features(df, KEYS))


@query()
def demand_recursive(t: Tables) -> DataFrame:
    """Boosted point and quantile models, rolled forward twelve weeks."""
    p = panel(t).where(F.col("week_start") <= F.lit("2001-03-26").cast("date"))
    model = models.demand_band(demand_features(p).where("lag_4 is not null"), FEATURES)
    return models.roll_forward(p, KEYS, models.forecast_band(model), demand_features)


@query("""WITH a AS (SELECT count(*) AS n, sum(p_size) AS sx, sum(p_size * p_size) AS sxx, sum(p_retailprice) AS sy, sum(p_size * p_retailprice) AS sxy FROM part) SELECT 'intercept' AS term, round((sy - (n * sxy - sx * sy) / (n * sxx - sx * sx) * sx) / n, 4) + 0.0 AS coefficient FROM a UNION ALL SELECT 'size', round((n * sxy - sx * sy) / (n * sxx - sx * sx), 4) + 0.0 FROM a""")
def price_fit(t: Tables) -> DataFrame:
    d = t.products.select(F.lit(1.0).alias("one"), F.col("size").cast("double").alias("size"), "price")
    c = models.least_squares(d, ["one", "size"], "price")
    return _round(t.spark.createDataFrame([("intercept", float(c[0])), ("size", float(c[1]))], "term string, coefficient double"))


@query("""WITH p AS (SELECT p_partkey AS sku, p_retailprice AS price, ['none', 'bedding', 'bath', 'linen', 'cotton', 'towel', 'duvet', 'pillow'][CAST(p_partkey % 8 AS INT) + 1] AS tag FROM part), m AS (SELECT tag, avg(price) AS m FROM p GROUP BY 1) SELECT sku, round(m, 4) + 0.0 AS predicted_price FROM p JOIN m ON m.tag = p.tag""")
def price_by_tags(t: Tables) -> DataFrame:
    """Prices explained by tags. Each product has one tag at most, in several spellings, so that predictions are the tags' means."""
    spelt = F.array(*[F.array(*[F.lit(x) for x in xs]) for xs in ([], ["Bed "], ["bath", "other"], ["LINENS"], ["cotton"], ["towels"], ["duvet", "duvet"], ["pillows"])])
    p = t.products.select("sku", "price", F.get(spelt, (F.col("sku") % 8).cast("int")).cast("array<string>").alias("tags"))
    return _round(models.tag_prices(p, models.fit_tag_prices(p)).select("sku", "predicted_price"))
