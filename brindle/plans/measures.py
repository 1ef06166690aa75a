"""Queries about experiments, uplift, drift and alerts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions.exprs import NUDGE
from brindle.operators import drift, experiments, holdout
from brindle.sources.tables import Tables

from .customers import _round
from .registry import EVENTS, query

_EXP = f"""WITH {EVENTS}, un AS (SELECT DISTINCT 1 AS experiment_id, customer_id AS unit_id, CASE WHEN customer_id % 2 = 0 THEN 'control' ELSE 'v1' END AS variant FROM ev),
pv AS (SELECT customer_id, CASE WHEN event_type IN ('purchase', 'click', 'view') THEN event_type ELSE 'any' END AS metric, avg(CASE WHEN event_ts >= TIMESTAMP '2024-01-16' THEN value END) AS value, avg(CASE WHEN event_ts < TIMESTAMP '2024-01-16' THEN value END) AS pre FROM ev GROUP BY 1, 2),
me AS (SELECT 1 AS experiment_id, un.unit_id, variant, metric, CASE WHEN metric = 'any' THEN 'binary' ELSE 'continuous' END AS metric_type, CASE WHEN metric = 'any' THEN CASE WHEN pv.value > 50 THEN 1.0 ELSE 0.0 END ELSE pv.value END AS value, pre AS pre_value FROM pv JOIN un ON pv.customer_id = un.unit_id WHERE pv.value IS NOT NULL)"""


def units(t: Tables) -> DataFrame:
    return t.events.select(F.lit(1).alias("experiment_id"), F.col("customer_id").alias("unit_id"), F.when(F.col("customer_id") % 2 == 0, "control").otherwise("v1").alias("variant")).distinct()


def metrics(t: Tables) -> DataFrame:
    late = F.col("event_ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    metric = F.when(F.col("event_type").isin("purchase", "click", "view"), F.col("event_type")).otherwise("any")
    g = t.events.groupBy("customer_id", metric.alias("metric")).agg(F.avg(F.when(late, F.col("value"))).alias("v"), F.avg(F.when(~late, F.col("value"))).alias("pre_value")).where("v is not null")
    binary = F.col("metric") == "any"
    return g.select(F.lit(1).alias("experiment_id"), F.col("customer_id").alias("unit_id"), "metric", F.when(binary, "binary").otherwise("continuous").alias("metric_type"), F.when(binary, F.when(F.col("v") > 50, 1.0).otherwise(0.0)).otherwise(F.col("v")).alias("value"), "pre_value")


_CUPED = _EXP + """, fx AS (SELECT *, coalesce(pre_value, avg(pre_value) OVER (PARTITION BY metric)) AS x FROM me), st AS (SELECT metric, covar_samp(x, value) AS c, var_samp(x) AS v, avg(x) AS m, avg(CASE WHEN pre_value IS NULL THEN 0.0 ELSE 1.0 END) AS cover FROM fx GROUP BY 1),
ad AS (SELECT fx.*, CASE WHEN cover >= 0.5 AND v > 0 THEN c / v ELSE 0.0 END AS theta, value - CASE WHEN cover >= 0.5 AND v > 0 THEN c / v ELSE 0.0 END * (x - m) AS adjusted FROM fx JOIN st ON fx.metric = st.metric)"""


@query(_CUPED + " SELECT unit_id, metric, round(theta, 4) + 0.0 AS theta, round(adjusted, 4) + 0.0 AS adjusted FROM ad")
def cuped_adjustment(t: Tables) -> DataFrame:
    m = metrics(t).join(units(t), ["experiment_id", "unit_id"])
    return _round(experiments.cuped(m).select("unit_id", "metric", "theta", "adjusted"))


_CMP = _EXP + """, a AS (SELECT metric, metric_type, variant, count(value) AS n, avg(value) AS mean, var_samp(value) AS var, sum(value) AS tot FROM me GROUP BY 1, 2, 3),
j AS (SELECT t.metric, t.metric_type, t.variant, c.n AS cn, t.n AS tn, c.mean AS cm, t.mean AS tm, c.var AS cv, t.var AS tv, c.tot AS ct, t.tot AS tt FROM a t JOIN a c ON t.metric = c.metric AND c.variant = 'control' WHERE t.variant <> 'control'),
r AS (SELECT *, (tt + ct) / (tn + cn) AS pl, tv / tn AS a, cv / cn AS b FROM j), s AS (SELECT *, CASE WHEN metric_type = 'binary' THEN CASE WHEN pl * (1 - pl) = 0 THEN 0.0 ELSE (tm - cm) / sqrt(pl * (1 - pl) * (1.0 / tn + 1.0 / cn)) END ELSE (tm - cm) / sqrt(a + b) END AS stat, 1.959963984540054 * sqrt(tv / (tn * cm * cm) + tm * tm * cv / (cn * cm * cm * cm * cm)) AS half FROM r)"""


@query(_CMP + """ SELECT 1 AS experiment_id, metric, metric_type, variant, cn AS n_control, tn AS n_treatment, round(cm, 4) + 0.0 AS mean_control, round(tm, 4) + 0.0 AS mean_treatment, round(tm / cm - 1, 4) + 0.0 AS lift, round(tm / cm - 1 - half, 4) + 0.0 AS lift_low, round(tm / cm - 1 + half, 4) + 0.0 AS lift_high, round(stat, 4) + 0.0 AS statistic, round(CASE WHEN metric_type <> 'binary' THEN (a + b) * (a + b) / (a * a / (tn - 1) + b * b / (cn - 1)) END, 4) + 0.0 AS df FROM s""")
def ab_test_stats(t: Tables) -> DataFrame:
    m = metrics(t).join(units(t), ["experiment_id", "unit_id"])
    return _round(experiments.compare(experiments.arm_stats(m)))


@query()
def ab_test_results(t: Tables) -> DataFrame:
    return _round(experiments.analyse(units(t), metrics(t)))


@query(_EXP + ", n AS (SELECT variant, count(DISTINCT unit_id) AS n FROM un GROUP BY 1) SELECT 1 AS experiment_id, round(sum((n - (SELECT avg(n) FROM n)) ** 2 / (SELECT avg(n) FROM n)), 4) + 0.0 AS chi2, count(*) - 1 AS df FROM n")
def sample_ratio(t: Tables) -> DataFrame:
    return _round(experiments.arm_sizes(units(t)))


@query("""WITH p AS (SELECT o_orderstatus AS family, o_orderkey AS metric, (o_orderkey * 7919 % 10007) / 10007 AS p_value FROM orders), r AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY p_value, metric) AS r, count(*) OVER (PARTITION BY family) AS n FROM p),
q AS (SELECT *, min(p_value * n / r) OVER (PARTITION BY family ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS q FROM r) SELECT family, metric, round(least(1.0, q), 4) + 0.0 AS p_adjusted FROM q""")
def bh_adjust(t: Tables) -> DataFrame:
    o = t.raw("orders").select(F.col("o_orderstatus").alias("family"), F.col("o_orderkey").alias("metric"), (F.col("o_orderkey") * 7919 % 10007 / 10007).alias("p_value"))
    return _round(experiments.adjust_p(o, ["family"]).select("family", "metric", "p_adjusted"))


_UPLIFT = """WITH d AS (SELECT event_id AS unit_id, event_id % 2 AS treated, CASE WHEN event_type IN ('purchase', 'click') THEN 1 ELSE 0 END AS converted, (event_id * 7919 % 10007) / 10007 AS uplift FROM events), w AS (SELECT *, row_number() OVER o AS rank, count(*) OVER () AS total, sum(treated) OVER o AS n_t, sum(1 - treated) OVER o AS n_c, sum(converted * treated) OVER o AS yt, sum(converted * (1 - treated)) OVER o AS yc FROM d WINDOW o AS (ORDER BY uplift DESC, unit_id)),
q AS (SELECT unit_id, treated, converted, uplift, rank, total, rank / total AS frac, CAST(n_t AS BIGINT) AS n_t, CAST(n_c AS BIGINT) AS n_c, yt - CASE WHEN n_c > 0 THEN yc * n_t / n_c ELSE 0.0 END AS qini FROM w)"""


def scored(t: Tables) -> DataFrame:
    i = F.col("event_id")
    return t.events.select(i.alias("unit_id"), (i % 2).alias("treated"), F.col("event_type").isin("purchase", "click").cast("long").alias("converted"), (i * 7919 % 10007 / 10007).alias("uplift"))


@query(_UPLIFT + " SELECT unit_id, rank, round(frac, 4) + 0.0 AS frac, n_t, n_c, round(qini, 4) + 0.0 AS qini, round(uplift, 4) + 0.0 AS score FROM q")
def qini_curve(t: Tables) -> DataFrame:
    return _round(experiments.qini(scored(t)).withColumn("rank", F.col("rank").cast("long")))


@query(_UPLIFT + """, o AS (SELECT *, (SELECT qini FROM q ORDER BY rank DESC LIMIT 1) AS tq FROM q), a AS (SELECT (sum(qini - frac * tq) - (SELECT qini - frac * tq FROM o ORDER BY rank LIMIT 1) / 2 - 0.0) / max(total) AS area, max(total) AS n FROM o),
b AS (SELECT frac, uplift, qini * 1200000 / total * 22.0 - frac * 1200000 * 1.8 AS profit FROM o ORDER BY round(profit, 6) DESC, rank LIMIT 1)
SELECT round(area, 4) + 0.0 AS area, round(area / n, 4) + 0.0 AS area_per_unit, round(frac, 4) + 0.0 AS target_frac, round(uplift, 4) + 0.0 AS threshold, round(profit, 4) + 0.0 AS profit FROM a, b""")
def qini_summary(t: Tables) -> DataFrame:
    return _round(experiments.qini_summary(experiments.qini(scored(t)), 1_200_000, 22.0, 1.8))


@query(_UPLIFT + """ SELECT CAST(greatest(0, ceil((rank - 1) * 10 / (total - 1)) - 1) AS INT) + 1 AS band, round(avg(CASE WHEN treated = 0 THEN converted END), 4) + 0.0 AS rate_control, round(avg(CASE WHEN treated = 1 THEN converted END), 4) + 0.0 AS rate_treated, round(avg(uplift), 4) + 0.0 AS predicted_uplift, round(avg(CASE WHEN treated = 1 THEN converted END) - avg(CASE WHEN treated = 0 THEN converted END), 4) + 0.0 AS observed_uplift FROM q GROUP BY 1""")
def uplift_bands(t: Tables) -> DataFrame:
    return _round(experiments.band_table(scored(t)))


_VALUES = f"""WITH {EVENTS}, v AS (SELECT 'value' AS feature, CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS value, event_ts < TIMESTAMP '2024-01-25' AS is_ref FROM ev UNION ALL SELECT 'sku', CAST(sku AS DOUBLE), event_ts < TIMESTAMP '2024-01-25' FROM ev UNION ALL SELECT 'squared', value * value / CASE WHEN event_ts < TIMESTAMP '2024-01-25' THEN 100 ELSE 90 END, event_ts < TIMESTAMP '2024-01-25' FROM ev)"""


def values(t: Tables) -> DataFrame:
    ref = F.col("event_ts") < F.lit("2024-01-25").cast("timestamp_ntz")
    wide = t.events.select(F.when(F.col("event_id") % 17 != 0, F.col("value")).alias("value"), "sku", (F.col("value") * F.col("value") / F.when(ref, 100).otherwise(90)).alias("squared"), ref.alias("is_ref"))
    return drift.unpivot(wide.withColumnRenamed("value", "v").withColumnRenamed("v", "value"), ["value", "sku", "squared"], ["is_ref"])


_PSI = _VALUES + """, nn AS (SELECT * FROM v WHERE value IS NOT NULL), ed AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))) AS e, min(value) AS lo, max(value) AS hi FROM nn WHERE is_ref GROUP BY 1), ee AS (SELECT feature, list_filter(e, lambda x: x > lo AND x < hi) AS e FROM ed),
b AS (SELECT nn.feature, is_ref, len(list_filter(e, lambda x: x <= value)) AS bin FROM nn JOIN ee ON nn.feature = ee.feature), c AS (SELECT feature, bin, count(*) FILTER (WHERE is_ref) AS r, count(*) FILTER (WHERE NOT is_ref) AS c FROM b GROUP BY 1, 2),
n AS (SELECT feature, count(*) FILTER (WHERE is_ref) AS nr, count(*) FILTER (WHERE NOT is_ref) AS nc FROM b GROUP BY 1), g AS (SELECT ee.feature, unnest(range(0, len(e) + 1)) AS bin FROM ee), s AS (SELECT g.feature, greatest(1e-6, coalesce(r, 0) / nr) AS r, greatest(1e-6, coalesce(c, 0) / nc) AS c, nr, nc FROM g JOIN n ON g.feature = n.feature LEFT JOIN c ON c.feature = g.feature AND c.bin = g.bin)
SELECT feature, round(sum((c - r) * ln(c / r)), 4) + 0.0 AS psi, max(nr) AS n_ref, max(nc) AS n_cur FROM s GROUP BY 1"""


@query(_PSI)
def psi_drift(t: Tables) -> DataFrame:
    return _round(drift.psi(values(t)))


_KS = _VALUES + """, k AS (SELECT feature, value, count(*) FILTER (WHERE is_ref) AS r, count(*) FILTER (WHERE NOT is_ref) AS c FROM v WHERE value IS NOT NULL GROUP BY 1, 2), d AS (SELECT feature, abs(sum(r) OVER w / sum(r) OVER e - sum(c) OVER w / sum(c) OVER e) AS d, CAST(sum(r) OVER e AS BIGINT) AS nr, CAST(sum(c) OVER e AS BIGINT) AS nc FROM k WINDOW w AS (PARTITION BY feature ORDER BY value), e AS (PARTITION BY feature))
SELECT feature, round(max(d), 4) + 0.0 AS d, max(nr) AS n_ref, max(nc) AS n_cur FROM d GROUP BY 1"""


@query(_KS)
def ks_statistic(t: Tables) -> DataFrame:
    return _round(drift.ks(values(t)))


_SHIFT = _VALUES + """ SELECT feature, round(avg(CASE WHEN NOT is_ref THEN CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END END) - avg(CASE WHEN is_ref THEN CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END END), 4) + 0.0 AS null_rate_delta, round((avg(CASE WHEN NOT is_ref THEN value END) - avg(CASE WHEN is_ref THEN value END)) / (stddev_samp(CASE WHEN is_ref THEN value END) + 1e-6), 4) + 0.0 AS mean_shift_sd FROM v GROUP BY 1"""


@query(_SHIFT)
def null_and_mean_shift(t: Tables) -> DataFrame:
    v = values(t)
    return _round(drift.null_rates(v).join(drift.mean_shift(v), "feature"))


def _exact(sql: str) -> str:
    """The same figures before they are rounded."""
    return re.sub(r"round\((.*?), 4\) \+ 0\.0 AS", r"\1 AS", sql)


@query(f"""WITH p0 AS ({_exact(_PSI)}), k0 AS ({_exact(_KS)}), s0 AS ({_exact(_SHIFT)}), k1 AS (SELECT feature, d, sqrt(n_ref * n_cur / (n_ref + n_cur)) AS en FROM k0), k2 AS (SELECT feature, d, (en + 0.12 + 0.11 / en) * d AS lam FROM k1),
k3 AS (SELECT feature, CASE WHEN d <= 0 OR lam <= 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * list_sum(list_transform(range(1, 101), lambda i: CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END * exp(-2.0 * i * i * lam * lam))))) END AS ks_p FROM k2),
f AS (SELECT feature, 'psi' AS metric, psi AS value FROM p0 UNION ALL SELECT feature, 'ks_p', ks_p FROM k3 UNION ALL SELECT feature, 'null_rate_delta', null_rate_delta FROM s0 UNION ALL SELECT feature, 'mean_shift_sd', mean_shift_sd FROM s0)
SELECT feature, metric, round(value, 4) + 0.0 AS value, CASE WHEN metric = 'psi' AND value > 0.2 THEN 'alert' WHEN metric = 'psi' AND value > 0.1 THEN 'warn' WHEN metric = 'ks_p' AND value < 0.001 THEN 'alert' WHEN metric = 'null_rate_delta' AND value > 0.05 THEN 'alert' WHEN metric = 'mean_shift_sd' AND abs(value) > 0.5 THEN 'warn' END AS severity FROM f""")
def drift_findings(t: Tables) -> DataFrame:
    return _round(drift.findings(values(t)).withColumn("severity", drift.severity()))


_FIND = """fi AS (SELECT event_id AS finding_id, 'm' || (user_id % 3) AS model, event_type AS feature, ['psi', 'ks_p', 'null_rate_delta', 'mean_shift_sd'][CAST(event_id % 4 AS INT) + 1] AS metric, value / 200 - 0.1 AS value, ts AS created_at FROM events)"""


def found(t: Tables) -> DataFrame:
    i = F.col("event_id")
    names = F.array(*[F.lit(m) for m in ("psi", "ks_p", "null_rate_delta", "mean_shift_sd")])
    return t.events.select(i.alias("finding_id"), F.concat(F.lit("m"), (F.col("customer_id") % 3).cast("string")).alias("model"), F.col("event_type").alias("feature"), F.get(names, (i % 4).cast("int")).alias("metric"), (F.col("value") / 200 - 0.1).alias("value"), F.col("event_ts").alias("created_at"))


_ALERTS = f"""WITH {_FIND}, se AS (SELECT *, CASE WHEN metric = 'psi' AND value > 0.2 THEN 'alert' WHEN metric = 'psi' AND value > 0.1 THEN 'warn' WHEN metric = 'ks_p' AND value < 0.001 THEN 'alert' WHEN metric = 'null_rate_delta' AND value > 0.05 THEN 'alert' WHEN metric = 'mean_shift_sd' AND abs(value) > 0.5 THEN 'warn' END AS severity FROM fi),
r AS (SELECT *, row_number() OVER (PARTITION BY model, feature, metric ORDER BY created_at, finding_id) AS r FROM se WHERE severity IS NOT NULL AND created_at >= TIMESTAMP '2024-01-16' AND NOT EXISTS (SELECT 1 FROM fi f WHERE f.created_at < TIMESTAMP '2024-01-01 06:00:00' AND f.model = se.model AND f.feature = se.feature AND f.metric = se.metric))
SELECT finding_id, model, feature, metric, severity FROM r WHERE r = 1"""


@query(_ALERTS)
def alert_dedup(t: Tables) -> DataFrame:
    f = found(t)
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    recent = f.where(F.col("created_at") < ts("2024-01-01 06:00:00"))
    return drift.alerts(f.where(F.col("created_at") >= ts("2024-01-16")), recent).select("finding_id", "model", "feature", "metric", "severity")


@query(_ALERTS.replace("SELECT finding_id, model, feature, metric, severity FROM r WHERE r = 1", """, a AS (SELECT *, CASE WHEN severity = 'alert' THEN ':red_circle:' ELSE ':large_yellow_circle:' END || ' `' || model || '` / `' || feature || '` ' || metric || '=' || format('{:.4g}', value + """ + f"{NUDGE}" + """) AS line FROM r WHERE r = 1)
SELECT '*Model drift report 2024-01-30* (' || count(*) || ' alerts)' || chr(10) || string_agg(line, chr(10) ORDER BY severity <> 'alert', model, feature, metric) AS text FROM a"""))
def alert_message(t: Tables) -> DataFrame:
    """What the alerts say, as one text. A nudge on both sides keeps exact halves apart."""
    f = found(t)
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    return drift.message(drift.alerts(f.where(F.col("created_at") >= ts("2024-01-16")), f.where(F.col("created_at") < ts("2024-01-01 06:00:00"))).withColumn("value", F.col("value") + NUDGE), "2024-01-30")


_RANK = "CAST('0x' || substring(md5('0:' || {}), 1, 15) AS BIGINT)"


@query(f"""SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {_RANK.format('doc_id')}) <= floor(count(*) OVER (PARTITION BY lang) * 0.2 + 0.5) AS held FROM documents""")
def stratified_holdout(t: Tables) -> DataFrame:
    """A fifth of the documents of each language, to the row."""
    return holdout.hold_out(t.raw("documents").select("doc_id", "lang"), "doc_id", "lang", 0.2)


@query(f"""WITH u AS (SELECT c_custkey AS k, c_mktsegment AS s FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)), h AS (SELECT k, row_number() OVER (PARTITION BY s ORDER BY {_RANK.format('k')}) <= floor(count(*) OVER (PARTITION BY s) * 0.25 + 0.5) AS held FROM u)
SELECT o_orderkey AS order_id, o_custkey AS customer_id, held FROM orders JOIN h ON k = o_custkey""")
def grouped_holdout(t: Tables) -> DataFrame:
    """A quarter of the customers of each segment, with all their orders."""
    o, c = t.raw("orders"), t.raw("customer")
    rows = o.join(c, o.o_custkey == c.c_custkey).select(o.o_orderkey.alias("order_id"), o.o_custkey.alias("customer_id"), c.c_mktsegment.alias("segment"))
    return holdout.hold_out(rows, "order_id", "segment", 0.25, "customer_id").drop("segment")
