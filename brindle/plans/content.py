"""Queries about reviews, returns, tags, catalogue texts and marketing models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.operators import bayes, boosting, catalog, classify, features, images, lifetime, marketing, models, reviews, search
from brindle.operators.graph import _checkpoint as checkpoint
from brindle.sources.tables import Tables

from .customers import ORDERS_END, _round, sends
from .registry import EVENTS, REVIEWS, query

_WORDS = "string_split_regex(regexp_replace(regexp_replace(lower({}), 'http\\S+', '{}', 'g'), '[^a-z{}\\s]', ' ', 'g'), '\\s+')"


@query(f"""WITH {REVIEWS} SELECT review_id, CASE WHEN contains(regexp_replace(regexp_replace(lower(body), 'http\\S+', ' <url> ', 'g'), '[^a-z<>\\s]', ' ', 'g'), '<url>') THEN 'spam_link' WHEN len(list_intersect({_WORDS.format('body', ' <url> ', '<>')}, ['scam', 'garbage', 'idiot'])) > 0 THEN 'profanity'
 WHEN length(regexp_replace(body, '[^A-Za-z]', '', 'g')) > 0 AND length(regexp_replace(body, '[^A-Z]', '', 'g')) / length(regexp_replace(body, '[^A-Za-z]', '', 'g')) > 0.7 THEN 'shouting' END AS reason FROM reviews""")
def moderation_flags(t: Tables) -> DataFrame:
    return t.reviews.select("review_id", reviews.moderation(F.col("body")).alias("reason"))


def product_reviews(t: Tables) -> DataFrame:
    """Short reviews made from product names: a template per part, so that lexicon words occur."""
    k = F.col("p_partkey")
    texts = ["Very soft and great color, love it", "Not great: scratchy, the color faded and it shrank", "Good quality, fits well; shipping was late but fine", "Terrible smell, fell apart after a week", "Really nice price, size is perfect", "http://x.example a bit rough, pilling"]
    body = F.get(F.array(*[F.lit(x) for x in texts]), (k % len(texts)).cast("int"))
    return t.raw("part").select(k.alias("review_id"), F.col("p_brand").alias("sku"), body.alias("body"), (k % 5 + 1).alias("rating"))


_TEXTS = """pr AS (SELECT p_partkey AS review_id, p_brand AS sku, ['Very soft and great color, love it', 'Not great: scratchy, the color faded and it shrank', 'Good quality, fits well; shipping was late but fine', 'Terrible smell, fell apart after a week', 'Really nice price, size is perfect', 'http://x.example a bit rough, pilling'][CAST(p_partkey % 6 AS INT) + 1] AS body, p_partkey % 5 + 1 AS rating FROM part)"""


@query(f"""WITH {_TEXTS}, w AS (SELECT sku, w, count(*) AS n FROM (SELECT sku, unnest({_WORDS.format('body', '', '')}) AS w FROM pr) WHERE w IN ('soft', 'scratchy', 'color', 'size', 'shrink', 'warm', 'quality', 'price', 'pilling') GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY n DESC, w) AS r FROM w),
s AS (SELECT sku, string_agg(w, ', ' ORDER BY r) AS ws FROM r WHERE r <= 3 GROUP BY 1), a AS (SELECT sku, avg(rating) AS m FROM pr GROUP BY 1) SELECT a.sku, round(m, 4) + 0.0 AS avg_rating, 'Customers mention: ' || coalesce(ws, 'n/a') AS summary FROM a LEFT JOIN s ON a.sku = s.sku""")
def aspect_summary(t: Tables) -> DataFrame:
    return _round(reviews.summaries(product_reviews(t)))


@query()
def aspect_sentiment(t: Tables) -> DataFrame:
    return _round(reviews.aspect_sentiment(product_reviews(t)))


@query("""WITH r AS (SELECT p_brand AS sku, unnest(['Linen', ' bed', 'Towels', 'sale!!', 'home decor', p_type]) AS tag FROM part), n AS (SELECT sku, replace(lower(trim(tag)), ' ', '-') AS t FROM r), m AS (SELECT sku, CASE t WHEN 'linens' THEN 'linen' WHEN 'linen-blend' THEN 'linen' WHEN 'towels' THEN 'towel' WHEN 'pillows' THEN 'pillow' WHEN 'bed' THEN 'bedding' WHEN 'home-decor' THEN 'decor' ELSE t END AS tag FROM n)
SELECT DISTINCT sku, tag FROM m WHERE tag IN ('bedding', 'bath', 'linen', 'cotton', 'towel', 'duvet', 'pillow', 'decor', 'kitchen')""")
def tag_normalise(t: Tables) -> DataFrame:
    raw = t.raw("part").select(F.col("p_brand").alias("sku"), F.explode(F.array(*[F.lit(x) for x in ("Linen", " bed", "Towels", "sale!!", "home decor")], F.col("p_type"))).alias("tag"))
    return reviews.valid_tags(raw)


def return_comments(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    texts = ["It arrived broken, order # 123", "Delivered too late for the party", "too small for my bed", "Colour is different from the photo", "the fabric is poor and thin", "changed my mind, do not need it", ""]
    labels = ["DAMAGED", "LATE", "TOO_SMALL", "COLOR_DIFFERENT", "QUALITY", "CHANGED_MIND", "QUALITY"]
    get = lambda xs: F.get(F.array(*[F.lit(x) for x in xs]), (k % 7).cast("int"))
    return t.raw("part").select(k.alias("return_id"), F.concat(get(texts), F.when(k % 7 != 6, F.concat(F.lit(" "), F.col("p_name"))).otherwise("")).alias("comment"), get(labels).alias("label"))


_RET = """rt AS (SELECT p_partkey AS return_id, ['It arrived broken, order # 123', 'Delivered too late for the party', 'too small for my bed', 'Colour is different from the photo', 'the fabric is poor and thin', 'changed my mind, do not need it', ''][CAST(p_partkey % 7 AS INT) + 1] || CASE WHEN p_partkey % 7 <> 6 THEN ' ' || p_name ELSE '' END AS comment, ['DAMAGED', 'LATE', 'TOO_SMALL', 'COLOR_DIFFERENT', 'QUALITY', 'CHANGED_MIND', 'QUALITY'][CAST(p_partkey % 7 AS INT) + 1] AS label FROM part),
cl AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(comment), 'https?://\\S+|\\S+@\\S+', ' ', 'g'), '\\border\\s*#?\\s*\\d+\\b', ' ', 'g'), '[^a-z'' ]+', ' ', 'g'), '\\s+', ' ', 'g')) AS s FROM rt),
tk0 AS (SELECT return_id, label, list_transform(list_filter(string_split(s, ' '), lambda x: length(x) > 1 AND NOT (x IN ({stop}))), lambda x: regexp_replace(regexp_replace(x, '^''+', ''), '''+$', '')) AS w FROM cl), tk AS (SELECT return_id, label, list_concat(w, CASE WHEN len(w) < 2 THEN [] ELSE list_transform(range(1, len(w)), lambda i: w[i] || '_' || w[i + 1]) END) AS terms FROM tk0)""".replace("{stop}", ", ".join(f"'{w}'" for w in reviews.COMMENT_STOPWORDS))


@query(f"""WITH {_RET}, tr AS (SELECT label, count(*) * 1.0 AS w FROM tk WHERE return_id % 2 = 0 GROUP BY 1), c AS (SELECT label, term, count(*) * 1.0 AS c FROM (SELECT label, unnest(terms) AS term FROM tk WHERE return_id % 2 = 0) GROUP BY 1, 2), v AS (SELECT count(DISTINCT term) AS v FROM c),
k AS (SELECT tr.label, ln((w + 1) / ((SELECT sum(w) FROM tr) + (SELECT count(*) FROM tr))) AS lp, (SELECT sum(c) FROM c WHERE c.label = tr.label) + (SELECT v FROM v) AS total FROM tr), ids AS (SELECT return_id FROM tk WHERE return_id % 2 = 1), te AS (SELECT return_id, term, count(*) AS m FROM (SELECT return_id, unnest(terms) AS term FROM tk WHERE return_id % 2 = 1) WHERE term IN (SELECT term FROM c) GROUP BY 1, 2),
s AS (SELECT i.return_id, k.label, lp + coalesce(sum(m * (ln(coalesce(c.c, 0) + 1) - ln(total))), 0) AS s FROM ids i CROSS JOIN k LEFT JOIN te ON te.return_id = i.return_id LEFT JOIN c ON c.label = k.label AND c.term = te.term GROUP BY i.return_id, k.label, lp),
e AS (SELECT *, exp(s - max(s) OVER (PARTITION BY return_id)) AS e FROM s), p AS (SELECT return_id, label, e / sum(e) OVER (PARTITION BY return_id) AS p FROM e), b AS (SELECT *, row_number() OVER (PARTITION BY return_id ORDER BY round(p, 9) DESC, label) AS r FROM p),
ru AS (SELECT return_id, s = '' AS em, CASE WHEN regexp_matches(s, '\\b(arrived|came) (broken|torn|ripped|cracked|damaged)\\b') THEN 'DAMAGED' WHEN regexp_matches(s, '\\b(arrived|came|delivered) (too )?late\\b') THEN 'LATE' WHEN regexp_matches(s, '\\btoo (small|short|narrow)\\b') THEN 'TOO_SMALL' WHEN regexp_matches(s, '\\b(colou?r|shade) (is |was )?(different|off|not the same)\\b') THEN 'COLOR_DIFFERENT' END AS ru FROM cl WHERE return_id % 2 = 1)
SELECT ru.return_id, CASE WHEN em THEN 'UNKNOWN' WHEN ru IS NOT NULL THEN ru WHEN p < 0.55 THEN 'UNKNOWN' ELSE label END AS reason, round(CASE WHEN em THEN 0.0 WHEN ru IS NOT NULL THEN 1.0 ELSE p END, 4) + 0.0 AS confidence, CASE WHEN em THEN 'empty' WHEN ru IS NOT NULL THEN 'rule' WHEN p < 0.55 THEN 'nb_low_conf' ELSE 'nb' END AS method FROM ru JOIN b ON ru.return_id = b.return_id AND b.r = 1""")
def returns_nb(t: Tables) -> DataFrame:
    c = return_comments(t).withColumn("terms", reviews.comment_terms(F.col("comment")))
    m = bayes.fit(c.where("return_id % 2 = 0").select("label", F.lit(1.0).alias("weight"), "terms"), 1.0)
    new = c.where("return_id % 2 = 1")
    return _round(reviews.return_reasons(new.select("return_id", "comment"), bayes.predict(new.select("return_id", "terms"), m, "return_id")))


_BANDIT = f"""WITH {EVENTS}, l AS (SELECT ['free_shipping', 'pct10_bedding', 'bundle_discount', 'none'][CAST(event_id % 4 AS INT) + 1] AS arm, CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END AS reward, [1.0, value / 100, (customer_id % 10) / 10] AS x FROM ev), e AS (SELECT arm, reward, x, unnest(range(0, 3)) AS i FROM l)"""


def bandit_log(t: Tables) -> DataFrame:
    i = F.col("event_id")
    return t.events.select("customer_id", F.get(F.array(*[F.lit(a) for a in marketing.ARMS]), (i % 4).cast("int")).alias("arm"), (F.col("event_type") == "purchase").cast("double").alias("reward"), F.lit(1.0).alias("bias"), (F.col("value") / 100).alias("value"), (F.col("customer_id") % 10 / 10).alias("tier"))


@query(_BANDIT + ", f AS (SELECT *, unnest(range(0, 3)) AS j FROM e) SELECT arm, CAST(i AS INT) AS i, CAST(j AS INT) AS j, round(sum(x[i + 1] * x[j + 1]), 4) + 0.0 AS value FROM f GROUP BY 1, 2, 3")
def linucb_stats(t: Tables) -> DataFrame:
    return _round(marketing.bandit_statistics(bandit_log(t), ["bias", "value", "tier"])[0])


@query(_BANDIT + " SELECT arm, CAST(i AS INT) AS i, round(sum(x[i + 1] * reward), 4) + 0.0 AS value FROM e GROUP BY 1, 2")
def linucb_rewards(t: Tables) -> DataFrame:
    return _round(marketing.bandit_statistics(bandit_log(t), ["bias", "value", "tier"])[1])


@query()
def offers(t: Tables) -> DataFrame:
    log, x = bandit_log(t), ["bias", "value", "tier"]
    people = log.groupBy("customer_id").agg(*[F.avg(c).alias(c) for c in x])
    scores = marketing.bandit_scores(people, *marketing.bandit_statistics(log, x), x, "customer_id")
    recent = log.where(F.col("arm").isin(marketing.DISCOUNT_ARMS) & (F.col("value") > 0.95)).groupBy("customer_id").agg(F.count("*").alias("discounts"))
    return _round(marketing.choose_offers(scores, recent, "customer_id"))


@query(f"""WITH {REVIEWS}, s AS (SELECT review_id, string_split(body, chr(10))[1] AS s FROM reviews), w AS (SELECT *, regexp_extract_all(lower(s), '([a-z'']+)', 1) AS w FROM s)
SELECT review_id, CAST(length(s) AS INT) AS n_chars, CAST(len(w) AS INT) AS n_words, CAST(len(list_filter(w, lambda x: x IN ('today', 'now', 'last', 'ends', 'hurry', 'final', 'hours', 'tonight', 'only', 'limited'))) AS INT) AS n_urgency, CAST(contains(s, '?') AS INT) AS has_question, CAST(regexp_matches(s, '\\d+\\s*%') AS INT) AS has_percent, round(length(regexp_replace(s, '[^A-Z]', '', 'g')) / greatest(length(regexp_replace(s, '[^A-Za-z]', '', 'g')), 1), 4) + 0.0 AS caps FROM w""")
def subject_features(t: Tables) -> DataFrame:
    f = marketing.subject_features(F.get(F.split("body", "\n"), F.lit(0)))
    return _round(t.reviews.select("review_id", *[f[k].alias(k) for k in ("n_chars", "n_words", "n_urgency", "has_question", "has_percent", "caps")]))


@query(r"""SELECT doc_id AS review_id, CAST(regexp_matches(s, '[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}]') AS INT) AS has_emoji, CAST(regexp_matches(s, '(?i)\{\{\s*(first_name|name|city)\s*\}\}|%FNAME%') AS INT) AS has_name FROM (SELECT doc_id, string_split(text, chr(10))[1] || CASE doc_id % 4 WHEN 0 THEN ' ☀' WHEN 1 THEN ' {{ First_Name }}' WHEN 2 THEN ' %fname% 🎁' ELSE '' END AS s FROM documents)""")
def subject_flags(t: Tables) -> DataFrame:
    """Subject lines with pictures or the reader's name."""
    end = F.get(F.array(F.lit(" ☀"), F.lit(" {{ First_Name }}"), F.lit(" %fname% 🎁"), F.lit("")), (F.col("review_id") % 4).cast("int"))
    f = marketing.subject_features(F.concat(F.get(F.split("body", "\n"), F.lit(0)), end))
    return t.reviews.select("review_id", f["has_emoji"].alias("has_emoji"), f["has_name"].alias("has_name"))


@query()
def subject_scores(t: Tables) -> DataFrame:
    """Predicted open rates of subject lines by weighted ridge regression on their words and hand-made features."""
    f = marketing.subject_features(F.col("s"))
    d = t.reviews.select("review_id", F.coalesce(F.get(F.split("body", "\n"), F.lit(0)), F.lit("")).alias("s"), (F.coalesce("quality", F.lit(0)) * 0.5 + 0.1).alias("open_rate"), F.sqrt(F.length("body").cast("double")).alias("w"))
    d = d.select("review_id", F.lower("s").alias("s"), "open_rate", "w", *[v.cast("double").alias(k) for k, v in f.items()])
    p = classify.text_ridge(d, "review_id", "s", list(f), "open_rate", "w")
    return _round(p.select("review_id", F.least(F.lit(1.0), F.greatest(F.lit(0.0), "predicted")).alias("predicted")).orderBy(F.desc("predicted"), "review_id"))


@query()
def segments_kmeans(t: Tables) -> DataFrame:
    return _round(models.segments(t.raw("embeddings"), "vec_id", "embedding", range(4, 11)), 3)


@query("""WITH s AS (SELECT o_custkey AS customer_id, sum(o_totalprice) AS spend, count(*) * 1.0 AS orders, date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2002-01-01') * 1.0 AS recency FROM orders GROUP BY 1), z AS (SELECT customer_id % 6 AS segment, (spend - avg(spend) OVER ()) / stddev_pop(spend) OVER () AS spend, (orders - avg(orders) OVER ()) / stddev_pop(orders) OVER () AS orders, (recency - avg(recency) OVER ()) / stddev_pop(recency) OVER () AS recency FROM s), m AS (SELECT segment, avg(spend) AS spend, avg(orders) AS orders, avg(recency) AS recency FROM z GROUP BY 1)
SELECT segment, round(spend, 4) + 0.0 AS spend, round(orders, 4) + 0.0 AS orders, round(recency, 4) + 0.0 AS recency, CASE WHEN spend > 0.5 AND recency > 0.75 THEN 'Lapsed high spenders' WHEN spend > 1.0 AND orders > 1.0 THEN 'VIP regulars' WHEN recency < -0.5 AND orders < -0.25 THEN 'New & curious' WHEN recency > 0.5 AND orders < -0.25 THEN 'Dormant one-timers' ELSE 'Steady mainstream' END AS name FROM m""")
def segment_names(t: Tables) -> DataFrame:
    o = t.raw("orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(F.sum("o_totalprice").alias("spend"), F.count("*").cast("double").alias("orders"), F.datediff(F.lit("2002-01-01").cast("date"), F.to_date(F.max("o_orderdate"))).cast("double").alias("recency"))
    return _round(marketing.segment_names(o.withColumn("segment", F.col("customer_id") % 6), "segment", ["spend", "orders", "recency"]))


def _snapshot(t: Tables, cutoff: str) -> DataFrame:
    lines = t.lines.where(F.col("order_ts") < F.lit(cutoff).cast("timestamp_ntz"))
    return features.rfm(lines, cutoff).fillna(0.0)


CHURN = ["recency_days", "tenure_days", "frequency", "monetary_total", "monetary_mean", "gap_mean", "gap_std", "orders_per_month", "recency_over_gap"]


@query()
def churn_gbt(t: Tables) -> DataFrame:
    def labelled(cutoff: str, end: str) -> DataFrame:
        s = _snapshot(t, cutoff)
        return s.join(features.has_order_in(t.lines, s.select("customer_id"), cutoff, end), "customer_id")

    return _round(models.calibrated_gbt(labelled("1998-07-01", "1998-09-29"), labelled("1999-06-01", "1999-08-30"), _snapshot(t, ORDERS_END), CHURN, "churned", "customer_id"))


@query()
def uplift_tlearner(t: Tables) -> DataFrame:
    d = t.events.select("event_id", (F.col("event_id") % 2).alias("treated"), (F.col("event_type") == "purchase").cast("int").alias("converted"), "value", F.hour("event_ts").alias("hour"), "sku")
    return _round(models.t_learner(d.where(models.bucket(F.col("event_id")) < 75), d.where(models.bucket(F.col("event_id")) >= 75), ["value", "hour", "sku"], "event_id"))


@query()
def coupon_logistic(t: Tables) -> DataFrame:
    cols = ["prior_sends", "prior_redemptions", "prior_redeem_rate", "discount", "days_since_redeem", "avg_redeemed_depth"]
    h = models.with_missing_flags(features.send_history(sends(t)), cols)
    late = F.col("sent_at") >= F.lit("2024-01-20").cast("timestamp_ntz")
    m = models.logistic(cols, "redeemed").fit(models.balanced(h.where(~late), "redeemed"))
    return _round(m.transform(h.where(late).withColumn("weight", F.lit(1.0))).select("send_id", "redeemed", models.p1().alias("p_redeem")))


def _paths(t: Tables) -> DataFrame:
    """Texts with two levels of labels: the language, and inside it what the labels say of the text. The first line counts as title."""
    kind = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    title = F.substring_index("body", "\n", 1)
    rest = F.substr("body", F.length(title) + 2)
    return t.reviews.select("review_id", classify.weighted_text(title, rest).alias("text"), F.col("lang").alias("label"), F.concat_ws("/", "lang", kind).alias("path"), kind.isNotNull().alias("labelled"))


@query()
def text_classifier(t: Tables) -> DataFrame:
    """The first level alone, over all documents: words, pairs and character n-grams."""
    d = _paths(t)
    test = models.bucket(F.col("review_id"), 5) == 0
    m = classify.fit_paths(d.where(~test), "review_id", "text", "label", "label", iterations=25)
    p = m.predict(d.where(test), "review_id", "text", 0.0).select("review_id", F.col("l1").alias("guess"))
    return d.where(test).select("review_id", "label").join(p, "review_id", "left")


@query()
def category_paths(t: Tables) -> DataFrame:
    """Both levels, fitted on four fifths of the labelled documents and told for the others."""
    d = _paths(t).where("labelled")
    test = models.bucket(F.col("review_id"), 5) == 0
    m = classify.fit_paths(d.where(~test), "review_id", "text", "label", "path", iterations=25)
    p = m.predict(d.where(test), "review_id", "text", 0.0).withColumnsRenamed({"l1": "guess_l1", "l2": "guess_l2"})
    return _round(d.where(test).select("review_id", F.col("label").alias("l1"), F.col("path").alias("l2")).join(p, "review_id", "left"))


@query("""WITH p AS (SELECT doc_id, lang AS label, CASE WHEN doc_id % 10 = 0 THEN 'en' ELSE lang END AS guess FROM documents), c AS (SELECT DISTINCT label AS c FROM p), m AS (SELECT c, (SELECT count(*) FROM p WHERE label = c AND guess = c) AS tp, (SELECT count(*) FROM p WHERE label = c) AS r, (SELECT count(*) FROM p WHERE guess = c) AS s FROM c) SELECT round(avg(2 * tp / (r + s)), 4) + 0.0 AS macro_f1 FROM m""")
def macro_f1(t: Tables) -> DataFrame:
    d = t.raw("documents").select(F.col("lang").alias("label"), F.when(F.col("doc_id") % 10 == 0, "en").otherwise(F.col("lang")).alias("guess"))
    return _round(models.macro_f1(d))


@query("""WITH d AS (SELECT CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y, CAST(floor(value) AS INT) AS p FROM events), g AS (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM d GROUP BY 1), w AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g) SELECT round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 4) + 0.0 AS auc FROM w""")
def auc(t: Tables) -> DataFrame:
    d = t.events.select((F.col("event_type") == "purchase").cast("int").alias("y"), F.floor("value").cast("int").alias("p"))
    return _round(models.auc(d, "y", "p"))


@query()
def search_ranker(t: Tables) -> DataFrame:
    """Pointwise ranking scores of each title's products, trained on weighted clicks."""
    p = t.products.withColumn("clicked", ((F.col("sku") * 7919 % 100) < F.col("size")).cast("int")).withColumn("weight", 1 + F.col("clicked") * 0.5)
    return _round(models.ranker(p.where("sku % 4 != 0"), p.where("sku % 4 = 0"), ["size", "price"], "clicked", "weight").select("sku", F.lower("title").alias("query"), "clicked", "rank_score"))


def shown_lists(t: Tables) -> DataFrame:
    """Result lists for a ranker: a customer's order lines as they came, with clicks that follow quantity and position."""
    w = Window.partitionBy("customer_id").orderBy("order_ts", "order_id", "line_no")
    k = F.col("order_id") * 8 + F.col("line_no")
    d = t.lines.select(F.col("customer_id").alias("query_id"), k.alias("line_id"), "sku", "quantity", "unit_price", (F.col("net_revenue") / F.col("quantity") / F.col("unit_price")).alias("paid_share"), F.to_date("order_ts").alias("event_date"), F.row_number().over(w).alias("position"))
    wanted, seen = (F.col("sku") * 7919 + F.col("line_id") * 31) % 100 < F.col("quantity") * 2, (F.col("line_id") * 17) % 100 < 100 / F.sqrt("position")
    price = (F.col("unit_price") - F.avg("unit_price").over(Window.partitionBy("query_id"))).alias("price_gap")
    return d.select("*", price, (wanted & seen).cast("int").alias("clicked"))


RANKED = ["quantity", "unit_price", "paid_share", "price_gap"]


@query()
def listwise_ranker(t: Tables) -> DataFrame:
    """Scores of held-out lists by trees on pair gradients, clicks weighted by inverse propensity."""
    d = checkpoint(boosting.impressions(shown_lists(t), "query_id", "position", 48, 2))  # read for the curve, the bins, the trees and the scores
    held = models.bucket(F.col("query_id"), 4) == 0
    train = d.where(~held)
    weighed = boosting.click_weights(train, search.position_propensity(train))
    m = boosting.listwise_ranker(weighed, RANKED, "query_id", "clicked", "line_id", "weight", rounds=10, depth=3)
    return _round(m.predict(d.where(held), ["rank_score"]).select("query_id", "line_id", "position", "clicked", "rank_score"))


@query()
def clv_values(t: Tables) -> DataFrame:
    s = checkpoint(features.repeat_summary(t.lines, "2002-01-01"))
    return _round(lifetime.lifetime_values(s, lifetime.fit_bgnbd(s), lifetime.fit_gamma_gamma(s)))


def described(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    get = lambda xs: F.get(F.array(*[F.lit(x) for x in xs]), (k % len(xs)).cast("int"))
    title = F.concat_ws(" ", get(["Queen", "Twin XL", "King", "California King"]), get(["Linen", "Egyptian Cotton", "Velvet"]), F.col("p_name"), get(["400 thread count", "striped", "90 x 92 in", "SALE!!"]))
    desc = get(["<p>55% linen 45% cotton</p>, machine wash cold", "Dry clean only. Floral print", "Plain, 100% wool", "50 x 60 cm, tumble dry low"])
    return t.raw("part").select(k.alias("sku"), title.alias("title"), desc.alias("description"), F.col("p_brand").alias("brand"), get(["Sheets", "Duvet Covers", "Towels", "Rugs", "Other"]).alias("category_l2"), get(["oat", "sage", None]).alias("color"))


@query()
def attributes_extract(t: Tables) -> DataFrame:
    return catalog.attributes(described(t))


@query()
def seo_titles(t: Tables) -> DataFrame:
    d = described(t)
    a = catalog.attributes(d).select("sku", F.regexp_replace(F.regexp_replace("material", ":[0-9]+", ""), ",", "-").alias("material"), "size", "pattern", F.concat(F.col("thread_count").cast("string"), F.lit(" Thread Count")).alias("thread_count"), F.concat_ws("x", F.round("width_cm").cast("int"), F.concat(F.round("length_cm").cast("int").cast("string"), F.lit("cm"))).alias("dimensions"))
    return catalog.seo_titles(d.join(a, "sku").withColumn("product_type", F.when(F.col("sku") % 9 != 0, F.col("category_l2"))))


@query("""WITH p AS (SELECT p_partkey AS sku, ['Bedding > Sheets > Flat Sheets', 'Bath > Towels > Hand Towels', 'Bath > Sheets > Flat Sheets', 'Decor > Rugs'][CAST(p_partkey % 4 AS INT) + 1] AS category_path FROM part) SELECT sku, category_path, trim(string_split(category_path, '>')[1]) AS l1, trim(string_split(category_path, '>')[2]) AS l2, trim(string_split(category_path, '>')[3]) AS l3 FROM p WHERE sku % 4 < 2""")
def taxonomy_paths(t: Tables) -> DataFrame:
    paths = ["Bedding > Sheets > Flat Sheets", "Bath > Towels > Hand Towels", "Bath > Sheets > Flat Sheets", "Decor > Rugs"]
    p = t.raw("part").select(F.col("p_partkey").alias("sku"), F.get(F.array(*[F.lit(x) for x in paths]), (F.col("p_partkey") % 4).cast("int")).alias("category_path"))
    return catalog.valid_paths(p).select("sku", "category_path", "l1", "l2", "l3")


@query("""WITH s AS (SELECT p_partkey AS sku, unnest([('Bedding', 1, 0.5 + (p_partkey % 5) / 20), ('Bath', 1, 0.5 - (p_partkey % 5) / 20), ('Sheets', 2, 0.1 + (p_partkey % 7) / 20), ('Duvet Covers', 2, 0.3), ('Towels', 2, 0.2)]) AS r FROM part), p AS (SELECT sku, r[1] AS label, r[2] AS lv, r[3] AS p FROM s),
t AS (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY round(p, 9) DESC, label) AS r FROM p WHERE lv = 1), c AS (SELECT p.*, t.label AS l1, t.p AS c1 FROM p JOIN t ON p.sku = t.sku AND t.r = 1 WHERE p.lv = 2 AND ((p.label = 'Towels') = (t.label = 'Bath'))), d AS (SELECT *, p / sum(p) OVER (PARTITION BY sku) AS sh, row_number() OVER (PARTITION BY sku ORDER BY round(p, 9) DESC, label) AS r FROM c)
SELECT sku, l1, CASE WHEN sh >= 0.55 THEN label END AS l2, round(c1, 4) + 0.0 AS conf_l1, round(sh, 4) + 0.0 AS conf_l2 FROM d WHERE r = 1""")
def constrained_categories(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    row = lambda label, level, p: F.struct(F.lit(label).alias("label"), F.lit(level).alias("level"), p.alias("p"))
    rows = F.array(row("Bedding", 1, 0.5 + k % 5 / 20), row("Bath", 1, 0.5 - k % 5 / 20), row("Sheets", 2, 0.1 + k % 7 / 20), row("Duvet Covers", 2, F.lit(0.3)), row("Towels", 2, F.lit(0.2)))
    s = t.raw("part").select(k.alias("sku"), F.explode(rows).alias("r")).select("sku", "r.label", "r.level", "r.p")
    parents = catalog.taxonomy(t.spark).select(F.col("l2").alias("label"), F.col("l1").alias("parent")).distinct()
    return _round(models.constrained_path(s, parents, "sku"))


def pictures(t: Tables) -> DataFrame:
    """Small synthetic images: a coloured square on white, one per part."""
    k = F.col("p_partkey")
    px = F.transform(F.sequence(F.lit(0), F.lit(24 * 24 - 1)), lambda i: F.when((i % 24).between(6, 17) & (i / 24).between(6, 18), F.concat(F.lpad(F.hex(k % 200), 2, "0"), F.lpad(F.hex(k * 7 % 220), 2, "0"), F.lpad(F.hex(k * 13 % 210), 2, "0"))).otherwise("FFFFFF"))
    return t.raw("part").select(F.concat(F.lit("i"), k.cast("string")).alias("image_id"), F.col("p_brand").alias("sku"), F.unhex(F.array_join(px, "")).alias("pixels"), F.lit(24).alias("height"), F.lit(24).alias("width"))


@query()
def image_quality(t: Tables) -> DataFrame:
    return _round(images.quality_scores(pictures(t)))


@query()
def dominant_colours(t: Tables) -> DataFrame:
    return _round(images.dominant_colours(pictures(t)))
