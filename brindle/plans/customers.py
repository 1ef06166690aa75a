"""Queries about customers: feature windows, recency and value, mixes, sessions, sends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions.exprs import rounded
from brindle.operators import features, marketing
from brindle.operators.ranking import best
from brindle.sources.config import feature_views
from brindle.sources.io import latest
from brindle.sources.tables import Tables

from .registry import EVENTS, LINES, query

EVENTS_END, ORDERS_END = "2024-01-31", "2000-01-01"
CATEGORIES = ["STANDARD", "ECONOMY", "MEDIUM", "PROMO"]

VIEWS = """
defaults: {ttl_days: 2, windows: [7, 30, 90]}
feature_views:
  - name: customer_daily
    entity: customer_id
    sources:
      - table: events
        timestamp_column: event_ts
        filter: "event_type in ('view', 'click')"
        aggregations:
          - {column: session_id, function: count_distinct, alias: sessions}
          - {column: event_id, function: count, alias: events}
          - {column: value, function: sum, alias: value}
          - {column: value, function: avg, alias: avg_value}
  - name: customer_orders
    entity: customer_id
    sources:
      - table: lines
        timestamp_column: order_ts
        aggregations:
          - {column: order_id, function: count_distinct, alias: orders}
          - {column: net_revenue, function: sum, alias: revenue}
      - table: returns
        timestamp_column: order_ts
        filter: "is_return = true"
        aggregations:
          - {column: quantity, function: sum, alias: returned}
    windows: [90, 365]
    static: {table: customers, columns: [segment]}
"""


def _round(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded as in the SQL; ranks as wide as there."""

    def one(name: str, kind: str):
        c = F.col(name)
        return rounded(c, digits).alias(name) if kind == "double" else c.cast("long").alias(name) if name == "rank" else c

    return df.select(*[one(f.name, f.dataType.typeName()) for f in df.schema])


def _windows_sql() -> str:
    cols = []
    for w in (7, 30, 90):
        c = f"event_ts >= TIMESTAMP '2024-01-31' - INTERVAL {w} DAY"
        cols += [f"count(DISTINCT CASE WHEN {c} THEN session_id END) AS sessions_{w}d", f"count(CASE WHEN {c} THEN event_id END) AS events_{w}d", f"round(coalesce(sum(CASE WHEN {c} THEN value END), 0), 4) + 0.0 AS value_{w}d", f"round(coalesce(avg(CASE WHEN {c} THEN value END), 0), 4) + 0.0 AS avg_value_{w}d"]
    return f"WITH {EVENTS} SELECT customer_id, {', '.join(cols)}, DATE '2024-01-31' AS as_of_date, DATE '2024-02-02' AS expires_at FROM ev WHERE event_ts >= TIMESTAMP '2024-01-31' - INTERVAL 90 DAY AND event_ts < TIMESTAMP '2024-01-31' AND event_type IN ('view', 'click') AND customer_id IS NOT NULL GROUP BY customer_id"


@query(_windows_sql())
def feature_windows(t: Tables) -> DataFrame:
    return _round(features.materialize(feature_views(VIEWS)[0], {"events": t.events}, EVENTS_END))


@query(f"""WITH {LINES}, a AS (
  SELECT customer_id, {', '.join(f"count(DISTINCT CASE WHEN order_ts >= TIMESTAMP '2000-01-01' - INTERVAL {w} DAY THEN order_id END) AS orders_{w}d, round(coalesce(sum(CASE WHEN order_ts >= TIMESTAMP '2000-01-01' - INTERVAL {w} DAY THEN net_revenue END), 0), 4) + 0.0 AS revenue_{w}d, coalesce(sum(CASE WHEN is_return AND order_ts >= TIMESTAMP '2000-01-01' - INTERVAL {w} DAY THEN quantity END), 0.0) AS returned_{w}d" for w in (90, 365))}
  FROM lines WHERE order_ts >= TIMESTAMP '2000-01-01' - INTERVAL 365 DAY AND order_ts < TIMESTAMP '2000-01-01' GROUP BY customer_id)
SELECT a.*, c.c_mktsegment AS segment, DATE '2000-01-01' AS as_of_date, DATE '2000-01-03' AS expires_at FROM a LEFT JOIN customer c ON a.customer_id = c.c_custkey""")
def feature_view_two_sources(t: Tables) -> DataFrame:
    customers = t.raw("customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"))
    return _round(features.materialize(feature_views(VIEWS)[1], {"lines": t.lines, "returns": t.lines, "customers": customers}, ORDERS_END))


_AGE = "(epoch_us(TIMESTAMP '2002-01-01') - epoch_us({})) / 8.64e10"


@query(f"""WITH {LINES}, o AS (SELECT customer_id, order_id, min(order_ts) AS ts, sum(net_revenue) AS v, sum(quantity) AS n FROM lines GROUP BY 1, 2),
g AS (SELECT *, {_AGE.format('ts')} AS age, {_AGE.format('lag(ts) OVER w')} - {_AGE.format('ts')} AS gap FROM o WINDOW w AS (PARTITION BY customer_id ORDER BY ts, order_id)),
c AS (SELECT customer_id, min(age) AS r, max(age) AS t, count(order_id) AS f, sum(v) AS m, avg(v) AS mm, avg(n) AS im, avg(gap) AS gm, stddev_samp(gap) AS gs FROM g GROUP BY 1)
SELECT customer_id, round(r, 4) + 0.0 AS recency_days, round(t, 4) + 0.0 AS tenure_days, f AS frequency, round(m, 4) + 0.0 AS monetary_total, round(mm, 4) + 0.0 AS monetary_mean, round(im, 4) + 0.0 AS items_mean,
 round(gm, 4) + 0.0 AS gap_mean, round(gs, 4) + 0.0 AS gap_std, round(ln(1 + r), 4) + 0.0 AS log_recency, round(ln(1 + f), 4) + 0.0 AS log_frequency, round(ln(1 + greatest(m, 0)), 4) + 0.0 AS log_monetary_total, round(ln(1 + greatest(mm, 0)), 4) + 0.0 AS log_monetary_mean,
 round(f / greatest(t / 30, 1), 4) + 0.0 AS orders_per_month, round(r / greatest(coalesce(gm, r), 1), 4) + 0.0 AS recency_over_gap FROM c""")
def rfm_features(t: Tables) -> DataFrame:
    return _round(features.rfm(t.lines, "2002-01-01"))


def _mix_sql() -> str:
    cats = [*CATEGORIES, "other"]
    case = "CASE WHEN category IN (" + ", ".join(f"'{c}'" for c in CATEGORIES) + ") THEN category ELSE 'other' END"
    sums = ", ".join(f"coalesce(sum(CASE WHEN cat = '{c}' THEN w END), 0.0) AS c{i}" for i, c in enumerate(cats))
    share = lambda i: f"CASE WHEN tot > 0 THEN c{i} / tot ELSE 0.0 END"
    p = lambda i: f"least(greatest({share(i)}, 1e-12), 1.0)"
    return f"""WITH {LINES}, x AS (SELECT customer_id, {case} AS cat, pow(0.5, {_AGE.format('order_ts')} / 90.0) * greatest(net_revenue, 0) AS w FROM lines),
s AS (SELECT customer_id, {sums} FROM x GROUP BY 1), u AS (SELECT *, 0.0 + {' + '.join(f'c{i}' for i in range(len(cats)))} AS tot FROM s)
SELECT customer_id, {', '.join(f'round({share(i)}, 4) + 0.0 AS share_{i}' for i in range(len(cats)))}, round(-(0.0 + {' + '.join(f'{p(i)} * ln({p(i)})' for i in range(len(cats)))}), 4) + 0.0 AS cat_entropy, round(tot, 4) + 0.0 AS decayed_spend FROM u"""


@query(_mix_sql())
def category_mix_entropy(t: Tables) -> DataFrame:
    return _round(features.category_mix(t.lines, "2002-01-01", CATEGORIES))


@query(f"""WITH {EVENTS}, s AS (SELECT customer_id, session_id, (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(min(event_ts))) / 8.64e10 AS d, count(*) AS n, count(*) FILTER (WHERE event_type = 'click') AS k FROM ev GROUP BY 1, 2),
g AS (SELECT customer_id, min(d) AS r, count(session_id) AS c, avg(n) AS e, CAST(sum(k) AS BIGINT) AS k, {', '.join(f'count(*) FILTER (WHERE d <= {w}) AS s{w}' for w in (7, 30, 90))} FROM s GROUP BY 1)
SELECT customer_id, round(r, 4) + 0.0 AS session_recency_days, c AS sessions_total, round(e, 4) + 0.0 AS events_per_session, k AS clicks_total, s7 AS sessions_7d, s30 AS sessions_30d, s90 AS sessions_90d,
 round((s30 + 1) / (s90 / 3 + 1), 4) + 0.0 AS visit_trend, round(ln(1 + r), 4) + 0.0 AS log_session_recency FROM g""")
def session_features(t: Tables) -> DataFrame:
    return _round(features.sessions(t.events, EVENTS_END))


@query(f"""WITH {LINES}, d AS (SELECT customer_id, CAST(order_ts AS DATE) AS day, sum(net_revenue) AS v FROM lines GROUP BY 1, 2), f AS (SELECT *, min(day) OVER (PARTITION BY customer_id) AS first FROM d)
SELECT customer_id, count(*) - 1 AS frequency, round(date_diff('day', min(day), max(day)) / 7, 4) + 0.0 AS recency, round(date_diff('day', min(day), DATE '2002-01-01') / 7, 4) + 0.0 AS "T", round(coalesce(avg(CASE WHEN day > first THEN v END), 0.0), 4) + 0.0 AS monetary FROM f GROUP BY 1""")
def clv_rfm_summary(t: Tables) -> DataFrame:
    return _round(features.repeat_summary(t.lines, "2002-01-01"))


@query(f"""WITH {LINES}, b AS (SELECT DISTINCT customer_id FROM lines WHERE order_ts >= TIMESTAMP '2000-01-01' AND order_ts < TIMESTAMP '2000-03-31'), a AS (SELECT DISTINCT customer_id FROM lines WHERE order_ts < TIMESTAMP '2000-01-01')
SELECT a.customer_id, CASE WHEN b.customer_id IS NULL THEN 1 ELSE 0 END AS churned FROM a LEFT JOIN b ON a.customer_id = b.customer_id""")
def churn_labels(t: Tables) -> DataFrame:
    known = t.lines.where(F.col("order_ts") < F.lit(ORDERS_END).cast("timestamp_ntz")).select("customer_id").distinct()
    return features.has_order_in(t.lines, known, ORDERS_END, "2000-03-31")


@query(f"""WITH {LINES}, x AS (SELECT *, date_diff('day', CAST(order_ts AS DATE), DATE '2002-01-01') AS age FROM lines),
g AS (SELECT customer_id, min(age) AS r, count(*) AS f, sum(net_revenue) AS m, {', '.join(f"sum(CASE WHEN category = '{c}' THEN pow(0.5, age / 90.0) ELSE 0.0 END) AS c{i}" for i, c in enumerate(CATEGORIES))} FROM x GROUP BY 1)
SELECT customer_id, round(exp(-r / 30), 4) + 0.0 AS v_recency, round(ln(1 + f), 4) + 0.0 AS v_frequency, round(ln(1 + m), 4) + 0.0 AS v_monetary, {', '.join(f'round(CASE WHEN c0 + c1 + c2 + c3 > 0 THEN c{i} / (c0 + c1 + c2 + c3) ELSE 0.0 END, 4) + 0.0 AS v_cat_{i}' for i in range(4))} FROM g""")
def customer_vectors(t: Tables) -> DataFrame:
    return _round(features.customer_vectors(t.lines, "2002-01-01", CATEGORIES))


_SENDS = """sends AS (SELECT event_id AS send_id, user_id AS customer_id, ts AS sent_at, 10 + 5 * (event_id % 4) AS discount, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS redeemed FROM events WHERE event_type IN ('view', 'purchase'))"""


def sends(t: Tables) -> DataFrame:
    e = t.events.where(F.col("event_type").isin("view", "purchase"))
    return e.select(F.col("event_id").alias("send_id"), "customer_id", F.col("event_ts").alias("sent_at"), (10 + 5 * (F.col("event_id") % 4)).alias("discount"), (F.col("event_type") == "purchase").cast("int").alias("redeemed"))


@query(f"""WITH {_SENDS}, w AS (SELECT *, row_number() OVER o - 1 AS prior_sends, coalesce(sum(redeemed) OVER b, 0) AS pr, avg(CASE WHEN redeemed = 1 THEN discount END) OVER b AS depth, max(CASE WHEN redeemed = 1 THEN sent_at END) OVER b AS last
 FROM sends WINDOW o AS (PARTITION BY customer_id ORDER BY sent_at, send_id), b AS (PARTITION BY customer_id ORDER BY sent_at, send_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT send_id, customer_id, CAST(prior_sends AS BIGINT) AS prior_sends, CAST(pr AS BIGINT) AS prior_redemptions, round(depth, 4) + 0.0 AS avg_redeemed_depth, CAST(date_diff('day', CAST(last AS DATE), CAST(sent_at AS DATE)) AS BIGINT) AS days_since_redeem, round((pr + 1) / (prior_sends + 4), 4) + 0.0 AS prior_redeem_rate FROM w""")
def coupon_history_features(t: Tables) -> DataFrame:
    h = features.send_history(sends(t)).drop("sent_at", "discount", "redeemed")
    return _round(h.withColumns({c: F.col(c).cast("long") for c in ("prior_sends", "prior_redemptions", "days_since_redeem")}))


@query(f"""WITH {_SENDS}, l AS (SELECT customer_id, discount AS last_discount, row_number() OVER (PARTITION BY customer_id ORDER BY sent_at DESC, send_id DESC) AS r FROM sends)
SELECT customer_id, CAST(last_discount AS BIGINT) AS last_discount, d AS discount FROM l, (VALUES (10), (15), (20), (25)) AS v(d) WHERE r = 1""")
def coupon_scenarios(t: Tables) -> DataFrame:
    last = best(sends(t), ["customer_id"], [F.desc("sent_at"), F.desc("send_id")]).select("customer_id", F.col("discount").alias("last_discount"))
    return features.scoring_grid(last, [10, 15, 20, 25])


@query("""SELECT event_id, user_id AS customer_id, event_type, value FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def latest_snapshot(t: Tables) -> DataFrame:
    return latest(t.events.withColumn("day", F.to_date("event_ts")), "day").select("event_id", "customer_id", "event_type", "value")


_ZONE = "CASE customer_id % 3 WHEN 0 THEN 'Europe/Paris' WHEN 1 THEN 'America/Los_Angeles' ELSE 'bad' END"


def opened(t: Tables) -> DataFrame:
    zone = F.when(F.col("customer_id") % 3 == 0, "Europe/Paris").when(F.col("customer_id") % 3 == 1, "America/Los_Angeles").otherwise("bad")
    e = t.events.where(F.col("event_type").isin("view", "click", "error"))
    return e.select("customer_id", marketing.local_bucket(F.col("event_ts"), zone).alias("bucket"), (F.col("event_type") == "click").cast("int").alias("opened"))


# January only: the zones' winter offsets hold (Paris +1, New York -5, Los Angeles -8 hours).
_OPENED = """op AS (SELECT user_id AS customer_id, CAST((isodow(l) - 1) * 8 + hour(l) // 3 AS INT) AS bucket, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS opened
 FROM (SELECT *, ts + CASE user_id % 3 WHEN 0 THEN INTERVAL 1 HOUR WHEN 1 THEN INTERVAL (-8) HOUR ELSE INTERVAL (-5) HOUR END AS l FROM events WHERE event_type IN ('view', 'click', 'error'))),
cb AS (SELECT customer_id, bucket, count(*) AS sends, sum(opened) AS opens FROM op GROUP BY 1, 2),
g AS (SELECT bucket, (sum(opens) + 1) / (sum(sends) + 2) AS mu FROM cb GROUP BY 1), rt AS (SELECT bucket, var_samp(opens / sends) AS var, avg(sends) AS nb FROM cb WHERE sends >= 3 GROUP BY 1),
p0 AS (SELECT g.bucket, mu, least(50.0, greatest(2.0, mu * (1 - mu) / greatest(1e-5, coalesce(var, 0.0) - mu * (1 - mu) / coalesce(nb, 3.0)) - 1)) AS k FROM g LEFT JOIN rt ON g.bucket = rt.bucket),
p1 AS (SELECT bucket, mu * k AS a, (1 - mu) * k AS b FROM p0),
pr AS (SELECT CAST(r.i AS INT) AS bucket, coalesce(a, (SELECT median(a) FROM p1)) AS alpha, coalesce(b, (SELECT median(b) FROM p1)) AS beta FROM range(56) r(i) LEFT JOIN p1 ON p1.bucket = r.i),
po AS (SELECT c.customer_id, pr.bucket, alpha + coalesce(opens, 0) AS a, beta + coalesce(sends - opens, 0) AS b FROM (SELECT DISTINCT customer_id FROM cb) c CROSS JOIN pr LEFT JOIN cb ON cb.customer_id = c.customer_id AND cb.bucket = pr.bucket)"""


@query(f"WITH {_OPENED} SELECT customer_id, bucket, round(a, 4) + 0.0 AS a, round(b, 4) + 0.0 AS b, round(a / (a + b), 4) + 0.0 AS mean FROM po")
def send_time_posterior(t: Tables) -> DataFrame:
    c = marketing.bucket_counts(opened(t))
    return _round(marketing.posteriors(c, marketing.bucket_priors(c)))


@query(f"""WITH {_OPENED}, cu AS (SELECT customer_id, customer_id % 4 AS segment, count(*) AS sends FROM op GROUP BY 1),
own AS (SELECT customer_id, bucket, a / (a + b) AS m, row_number() OVER (PARTITION BY customer_id ORDER BY round(a / (a + b), 9) DESC, bucket) AS r FROM po),
s0 AS (SELECT segment, bucket, sum(a) / (sum(a) + sum(b)) AS m FROM po JOIN cu ON po.customer_id = cu.customer_id GROUP BY 1, 2), sg AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY round(m, 9) DESC, bucket) AS r FROM s0)
SELECT cu.customer_id, CASE WHEN sends < 40 THEN sg.bucket ELSE own.bucket END AS bucket, round(CASE WHEN sends < 40 THEN sg.m ELSE own.m END, 4) + 0.0 AS mean, CASE WHEN sends < 40 THEN 'segment_fallback' ELSE 'personal' END AS method
FROM cu JOIN own ON own.customer_id = cu.customer_id AND own.r = 1 LEFT JOIN sg ON sg.segment = cu.segment AND sg.r = 1""")
def send_times(t: Tables) -> DataFrame:
    o = opened(t)
    c = marketing.bucket_counts(o)
    people = o.groupBy("customer_id").agg(F.count("*").alias("sends")).withColumn("segment", F.col("customer_id") % 4)
    return _round(marketing.send_times(marketing.posteriors(c, marketing.bucket_priors(c)), people, least=40))


@query()
def send_time_draws(t: Tables) -> DataFrame:
    c = marketing.bucket_counts(opened(t))
    d = marketing.thompson(marketing.posteriors(c, marketing.bucket_priors(c)))
    return best(d, ["customer_id"], [F.desc("draw"), F.asc("bucket")])
