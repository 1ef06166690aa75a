"""Queries about recommendations, similarity and graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions.exprs import clip, rounded, sigmoid
from brindle.functions.text import words
from brindle.operators import ann, baskets, graph, ranking, recs, vectors
from brindle.sources.tables import Tables

from .customers import _round
from .registry import EVENTS, LINES, REVIEWS, query

_BASKET = f"""WITH {LINES}, b0 AS (SELECT DISTINCT order_id, {{item}} AS item FROM lines), b1 AS (SELECT *, count(*) OVER (PARTITION BY order_id) AS n FROM b0), b AS (SELECT order_id, item FROM b1 WHERE {{size}}),
pr AS (SELECT x.item AS a, y.item AS b, count(*) AS c FROM b x JOIN b y ON x.order_id = y.order_id AND x.item < y.item GROUP BY 1, 2 HAVING count(*) >= {{support}}), sg AS (SELECT item, count(*) AS n FROM b GROUP BY 1), tt AS (SELECT count(DISTINCT order_id) AS n FROM b),
d AS (SELECT a AS x, b AS y, c FROM pr UNION ALL SELECT b, a, c FROM pr), ru AS (SELECT x AS antecedent, y AS consequent, c / tt.n AS support, c / sx.n AS confidence, (c / sx.n) / (sy.n / tt.n) AS lift FROM d JOIN sg sx ON sx.item = x JOIN sg sy ON sy.item = y, tt)"""


@query(_BASKET.format(item="brand", support=15, size="n >= 2") + " SELECT antecedent, consequent, round(support, 4) + 0.0 AS support, round(confidence, 4) + 0.0 AS confidence, round(lift, 4) + 0.0 AS lift FROM ru WHERE confidence >= 0.02 AND lift >= 1.0")
def basket_rules(t: Tables) -> DataFrame:
    return _round(baskets.rules(baskets.baskets(t.lines, "brand", None), 15, 0.02, 1.0))


def rule_table(t: Tables, largest: int | None = None) -> DataFrame:
    items = baskets.rules(baskets.baskets(t.lines, "sku", largest), 3, 0.02, 1.5)
    cats = baskets.rules(baskets.baskets(t.lines, "category", largest), 15, 0.02, 0.9)
    return baskets.with_backoff(t.lines, items, cats)


def _rules_sql(size: str) -> str:
    """Rules with back-off, of orders whose number of items n fits ``size``."""
    return (
        _BASKET.format(item="sku", support=3, size=size)
        + f""", cb0 AS (SELECT DISTINCT order_id, category AS item FROM lines), cb1 AS (SELECT *, count(*) OVER (PARTITION BY order_id) AS n FROM cb0), cb AS (SELECT order_id, item FROM cb1 WHERE {size}),
cpr AS (SELECT x.item AS a, y.item AS b, count(*) AS c FROM cb x JOIN cb y ON x.order_id = y.order_id AND x.item < y.item GROUP BY 1, 2 HAVING count(*) >= 15), csg AS (SELECT item, count(*) AS n FROM cb GROUP BY 1), ctt AS (SELECT count(DISTINCT order_id) AS n FROM cb),
cd AS (SELECT a AS x, b AS y, c FROM cpr UNION ALL SELECT b, a, c FROM cpr), cru0 AS (SELECT x AS antecedent, y AS consequent, c / ctt.n AS support, c / sx.n AS confidence, (c / sx.n) / (sy.n / ctt.n) AS lift FROM cd JOIN csg sx ON sx.item = x JOIN csg sy ON sy.item = y, ctt), cru AS (SELECT * FROM cru0 WHERE confidence >= 0.02 AND lift >= 0.9),
dim AS (SELECT sku, min(category) AS category, count(DISTINCT order_id) AS orders FROM lines GROUP BY 1), bs AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY orders DESC, sku) AS r FROM dim),
ev0 AS (SELECT *, 'item' AS level FROM ru WHERE confidence >= 0.02 AND lift >= 1.5 UNION ALL SELECT dim.sku, bs.sku, support, confidence, lift * 0.8, 'category' FROM dim JOIN cru ON cru.antecedent = dim.category JOIN bs ON bs.category = cru.consequent AND bs.r <= 3 WHERE dim.orders < 40),
ev1 AS (SELECT e.*, row_number() OVER (PARTITION BY antecedent, consequent ORDER BY lift DESC, level) AS r FROM ev0 e JOIN dim a ON a.sku = antecedent JOIN dim c ON c.sku = consequent WHERE a.category <> c.category),
rl0 AS (SELECT antecedent, consequent, support, confidence, lift, level, row_number() OVER (PARTITION BY antecedent ORDER BY lift DESC, consequent) AS rank FROM ev1 WHERE r = 1), rl AS (SELECT * FROM rl0 WHERE rank <= 20)"""
    )


@query(_rules_sql("n >= 2") + " SELECT antecedent, consequent, round(support, 4) + 0.0 AS support, round(confidence, 4) + 0.0 AS confidence, round(lift, 4) + 0.0 AS lift, level, rank FROM rl")
def basket_rules_backoff(t: Tables) -> DataFrame:
    return _round(rule_table(t))


@query(
    _rules_sql("n BETWEEN 2 AND 30") + """, ca AS (SELECT DISTINCT customer_id AS cart_id, sku FROM lines WHERE order_ts >= TIMESTAMP '2001-06-01'), h AS (SELECT cart_id, consequent, sum(CASE WHEN level = 'item' THEN lift ELSE 0.5 * lift END) AS score FROM ca JOIN rl ON ca.sku = rl.antecedent GROUP BY 1, 2),
f AS (SELECT h.*, dim.category FROM h JOIN dim ON dim.sku = h.consequent WHERE NOT EXISTS (SELECT 1 FROM ca JOIN dim d2 ON d2.sku = ca.sku WHERE ca.cart_id = h.cart_id AND (d2.category = dim.category OR ca.sku = h.consequent))),
o AS (SELECT *, row_number() OVER (PARTITION BY cart_id, category ORDER BY round(score, 9) DESC, consequent) AS r FROM f), z AS (SELECT cart_id, category, consequent, score, row_number() OVER (PARTITION BY cart_id ORDER BY round(score, 9) DESC, consequent) AS rank FROM o WHERE r = 1)
SELECT cart_id, category, consequent, round(score, 4) + 0.0 AS score, rank FROM z WHERE rank <= 4"""
)
def cart_addons(t: Tables) -> DataFrame:
    carts = t.lines.where(F.col("order_ts") >= F.lit("2001-06-01").cast("timestamp_ntz")).select(F.col("customer_id").alias("cart_id"), "sku")
    dim = t.lines.groupBy("sku").agg(F.min("category").alias("category"))
    return _round(baskets.cart_addons(carts, rule_table(t, 30), dim).select("cart_id", "category", "consequent", "score", "rank"))


_TREND = f"""WITH {EVENTS}, e AS (SELECT sku % 10 AS category, sku, CASE event_type WHEN 'view' THEN 1.0 WHEN 'click' THEN 4.0 ELSE 10.0 END AS w, (epoch_us(TIMESTAMP '2024-01-30') - epoch_us(event_ts)) / 1e6 AS age FROM ev WHERE event_type IN ('view', 'click', 'purchase')),
e2 AS (SELECT *, CASE WHEN age <= 172800 THEN -1 ELSE least(floor((age - 172800) / 172800), 12) END AS win FROM e WHERE age >= 0 AND age <= 28 * 86400), p AS (SELECT category, sku, win, sum(w) AS v, sum(CASE WHEN win < 0 THEN w * pow(0.5, age / 3600 / 6.0) END) AS d, count(*) AS n FROM e2 GROUP BY 1, 2, 3),
g AS (SELECT category, sku, coalesce(sum(v) FILTER (WHERE win >= 0), 0) / 13.0 AS mu, coalesce(sum(v * v) FILTER (WHERE win >= 0), 0) / 13.0 AS sq, sum(d) AS d, sum(n) FILTER (WHERE win < 0) AS rn, coalesce(sum(n) FILTER (WHERE win >= 0), 0) AS bn FROM p GROUP BY 1, 2),
z AS (SELECT category, sku, d / (6.0 / ln(2) / 48 * (1 - pow(0.5, 8))) AS cur, mu, sq, rn, bn FROM g), y AS (SELECT *, (cur - mu) / sqrt(greatest(sq - mu * mu, 0) + mu + 1) AS z FROM z), r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY round(z, 9) DESC, sku) AS rank FROM y WHERE rn >= 2 AND bn >= 5 AND z > 0)
SELECT category, sku, rank, round(z, 4) + 0.0 AS z, round(cur, 4) + 0.0 AS "current", round(mu, 4) + 0.0 AS baseline FROM r WHERE rank <= 50"""


@query(_TREND)
def trending_velocity(t: Tables) -> DataFrame:
    e = t.events.withColumn("category", F.col("sku") % 10)
    return _round(recs.trending(e, "2024-01-30", least_recent=2, least_base=5))


_HASH = """tok AS (SELECT p_partkey AS sku, unnest(list_filter(string_split(replace(lower(p_name || ' ' || p_brand || ' ' || p_type), ',', ' '), ' '), lambda x: length(x) > 2)) AS t FROM part),
hs AS (SELECT sku, ('0x' || substring(md5(t), 31, 2))::INT % 128 AS slot, sum(CASE WHEN ('0x' || substring(md5(t), 29, 2))::INT % 2 = 1 THEN 1.0 ELSE -1.0 END) AS v FROM tok GROUP BY 1, 2), ln AS (SELECT sku, sqrt(sum(v * v)) AS len FROM hs WHERE v <> 0 GROUP BY 1), em AS (SELECT hs.sku, slot, v / len AS value FROM hs JOIN ln ON hs.sku = ln.sku WHERE v <> 0)"""


def embedded(t: Tables) -> DataFrame:
    return vectors.hash_embedding(t.products, "sku", words(F.concat_ws(" ", "title", "brand", "category")))


@query(f"WITH {_HASH} SELECT sku, slot, round(value, 4) + 0.0 AS value FROM em")
def hash_embedding(t: Tables) -> DataFrame:
    return _round(embedded(t))


@query(f"WITH {_HASH}, s AS (SELECT a.sku, b.sku AS other, sum(a.value * b.value) AS score FROM em a JOIN em b ON a.slot = b.slot AND a.sku <> b.sku GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY round(score, 9) DESC, other) AS rank FROM s) SELECT sku, other, round(score, 4) + 0.0 AS score, rank FROM r WHERE rank <= 5")
def i2i_topk(t: Tables) -> DataFrame:
    return _round(vectors.sparse_neighbours(embedded(t), "sku", 5))


@query(
    f"WITH {_HASH}, h AS (SELECT DISTINCT o_custkey AS customer_id, l_partkey AS sku FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate >= TIMESTAMP '2001-07-01'), s0 AS (SELECT a.sku, b.sku AS other, sum(a.value * b.value) AS score FROM em a JOIN em b ON a.slot = b.slot AND a.sku <> b.sku GROUP BY 1, 2), r0 AS (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY round(score, 9) DESC, other) AS rank FROM s0), "
    "s AS (SELECT customer_id, other AS sku, sum(score) AS score FROM h JOIN r0 ON h.sku = r0.sku WHERE rank <= 5 GROUP BY 1, 2), f AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.customer_id = s.customer_id AND h.sku = s.sku)), r AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY round(score, 9) DESC, sku) AS rank FROM f) SELECT customer_id, sku, round(score, 4) + 0.0 AS score, rank FROM r WHERE rank <= 12"
)
def because_you_bought(t: Tables) -> DataFrame:
    h = t.lines.where(F.col("order_ts") >= F.lit("2001-07-01").cast("timestamp_ntz"))
    return _round(recs.from_history(h, vectors.sparse_neighbours(embedded(t), "sku", 5, asked=h), 12))


_UNIT = """u AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), n AS (SELECT vec_id, label, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM u)"""


@query(f"WITH {_UNIT}, s AS (SELECT a.vec_id AS query, b.vec_id AS other, list_dot_product(a.v, b.v) AS score FROM n a JOIN n b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0), r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, other) AS rank FROM s) SELECT query, other, round(score, 4) + 0.0 AS score, rank FROM r WHERE rank <= 10")
def vector_neighbours(t: Tables) -> DataFrame:
    e = t.raw("embeddings")
    return _round(vectors.neighbours(e, e.where("vec_id % 20 = 0"), 10))


@query()
def vector_index_neighbours(t: Tables) -> DataFrame:
    """The same neighbours from the index: all vectors indexed, recall measured in the tests."""
    e = t.raw("embeddings")
    coder = ann.fit(e, "vec_id", "embedding")
    return _round(ann.search(ann.index(e, "vec_id", "embedding", coder), coder, e.where("vec_id % 20 = 0"), 10, "vec_id", "embedding"))


@query(
    f"""WITH {_UNIT}, sd AS (SELECT * FROM n WHERE label = 0), c0 AS (SELECT list(m ORDER BY i) AS c FROM (SELECT i, avg(x) AS m FROM (SELECT unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM sd) GROUP BY i)), c1 AS (SELECT list_transform(c, lambda x: x / sqrt(list_dot_product(c, c))) AS c FROM c0),
k0 AS (SELECT vec_id, v, list_dot_product(v, c) AS s FROM sd, c1), kp AS (SELECT v FROM k0 WHERE s >= (SELECT quantile_cont(s, 0.1) FROM k0) - 1e-12), d0 AS (SELECT list(m ORDER BY i) AS c FROM (SELECT i, avg(x) AS m FROM (SELECT unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM kp) GROUP BY i)), d1 AS (SELECT list_transform(c, lambda x: x / sqrt(list_dot_product(c, c))) AS c FROM d0)
SELECT vec_id, round(list_dot_product(v, c), 4) + 0.0 AS similarity FROM n, d1 WHERE label <> 0 AND list_dot_product(v, c) >= 0.0"""
)
def lookalike_audience(t: Tables) -> DataFrame:
    e = t.raw("embeddings")
    return _round(vectors.lookalikes(e, e.where("label = 0").select("vec_id"), least=0.0))


@query(f"""WITH {EVENTS}, v AS (SELECT session_id, count(*) FILTER (WHERE event_type = 'view') AS views, count(*) FILTER (WHERE event_type = 'click') AS clicks, coalesce(sum(value) FILTER (WHERE event_type = 'view'), 0.0) AS dwell FROM ev GROUP BY 1),
p AS (SELECT session_id, avg(e.embedding[1]) AS m FROM ev JOIN embeddings e ON e.vec_id = ev.sku WHERE event_type = 'view' GROUP BY 1)
SELECT v.session_id, round(1 / (1 + exp(-(0.3 * views + 1.5 * clicks + 0.2 * ln(1 + dwell) + coalesce(m, 0) - 3.0))), 4) + 0.0 AS p FROM v LEFT JOIN p ON v.session_id = p.session_id""")
def session_conversion(t: Tables) -> DataFrame:
    """Counts, dwell and the mean of the viewed items' vectors, in a logistic score with given weights."""
    is_view = F.col("event_type") == "view"
    v = t.events.groupBy("session_id").agg(F.count_if(is_view).alias("views"), F.count_if(F.col("event_type") == "click").alias("clicks"), F.coalesce(F.sum(F.when(is_view, F.col("value"))), F.lit(0.0)).alias("dwell"))
    e = t.raw("embeddings")
    seen = t.events.where(is_view).join(e, F.col("sku") == F.col("vec_id")).select("session_id", F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    pooled = vectors.mean_vector(seen, F.col("e"), ["session_id"])
    x = 0.3 * F.col("views") + 1.5 * F.col("clicks") + 0.2 * F.log1p("dwell") + F.coalesce(F.get("centroid", F.lit(0)), F.lit(0.0)) - 3.0
    return v.join(pooled, "session_id", "left").select("session_id", rounded(sigmoid(x)).alias("p"))


_BAND = """WITH w AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice, p_partkey) AS rn, count(*) OVER (PARTITION BY p_type) AS n, (SELECT count(DISTINCT p_retailprice) FROM part q WHERE q.p_type = part.p_type) AS k FROM part)
SELECT p_partkey AS sku, p_type AS category, CASE WHEN k < 4 THEN 0 ELSE CAST(greatest(0, ceil((rn - 1) * 4 / greatest(n - 1, 1)) - 1) AS INT) END AS band FROM w"""


@query(_BAND)
def price_band_within_category(t: Tables) -> DataFrame:
    return ranking.price_bands(t.products).select("sku", "category", "band")


@query(f"WITH b AS ({_BAND}) SELECT sku, CASE WHEN sku % 6 = 0 THEN '_unbranded' ELSE p_brand END AS brand, CASE sku % 4 WHEN 0 THEN 'oat' WHEN 1 THEN 'sage' ELSE '_multi' END AS color, band FROM b JOIN part ON p_partkey = sku")
def listing_attributes(t: Tables) -> DataFrame:
    k = F.col("sku")
    p = t.products.withColumn("brand", F.when(k % 6 != 0, F.col("brand"))).withColumn("color", F.when(k % 4 == 0, "oat").when(k % 4 == 1, "sage").when(k % 4 == 2, ""))
    return ranking.listing_attributes(p)


@query(f"WITH {_UNIT}, p AS (SELECT a.vec_id, list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS s, sqrt(list_sum(list_transform(a.v, lambda x: x * x))) * sqrt(list_sum(list_transform(b.v, lambda x: x * x))) AS n FROM u a JOIN u b ON b.vec_id = a.vec_id + 1) SELECT vec_id, round(s / (n + 1e-9), 4) + 0.0 AS cosine FROM p")
def pair_cosines(t: Tables) -> DataFrame:
    """Each vector with the next one."""
    e = t.raw("embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("a"))
    return _round(vectors.pair_cosine(e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b")), "vec_id"), "a", "b").select("vec_id", "cosine"))


def served(t: Tables) -> DataFrame:
    """Result lists: a title's products, by size."""
    p = ranking.price_bands(t.products)
    return p.withColumn("query", F.lower("title")).withColumn("relevance", ranking.minmax(F.col("size").cast("double"), ["query"]))


@query()
def mmr_rerank(t: Tables) -> DataFrame:
    return _round(ranking.diversify(served(t), "query", "sku", "relevance", {"brand": 0.45, "category": 0.35, "band": 0.20}, 0.7, 24, 1))


@query()
def mmr_sweep(t: Tables) -> DataFrame:
    """What several trade-offs between relevance and diversity give and cost, with clicks on every fifth product."""
    rows = served(t)
    return _round(ranking.trade_offs(rows, "query", "sku", "relevance", {"brand": 0.45, "category": 0.35, "band": 0.20}, (1.0, 0.85, 0.7, 0.55), rows.where("sku % 5 = 0"), 24, 1))


STOP = ["the", "and", "of", "in", "with", "for"]


def mailed(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    desc = F.concat(F.lit("<p>"), "p_brand", F.lit("</p> "), ((k % 9 + 2) * 100).cast("string"), F.lit(" thread count, the "), "p_type", F.lit(" of "), (F.col("p_size") % 7).cast("string"), F.lit("0 cm"))
    return t.raw("part").select(k.alias("sku"), F.col("p_name").alias("title"), desc.alias("description"), (k % 7 != 0).alias("is_active"), (k % 5 != 1).alias("in_stock"))


@query(f"""WITH {LINES}, tx AS (SELECT p_partkey AS sku, p_partkey % 7 <> 0 AND p_partkey % 5 <> 1 AS ok, regexp_replace(lower(p_name), '[^a-z0-9 ]+', ' ', 'g') AS a, regexp_replace(lower(p_brand || ' threadcount the ' || p_type || ' of ' || (p_size % 7) || '0 cm'), '[^a-z0-9 ]+', ' ', 'g') AS b FROM part),
ws AS (SELECT sku, ok, list_filter(regexp_split_to_array(trim(a || ' ' || a || ' ' || b), ' +'), lambda x: length(x) >= 2 AND x NOT IN ('the', 'and', 'of', 'in', 'with', 'for')) AS w FROM tx),
g AS (SELECT sku, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM ws), tf AS (SELECT sku, term, count(*) AS tf FROM g GROUP BY 1, 2), n AS (SELECT count(*) AS n FROM part), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
v AS (SELECT sku, tf.term, (1 + ln(tf)) * (ln((n + 1) / (df + 1)) + 1) AS v FROM tf JOIN df ON tf.term = df.term, n WHERE df >= 2 AND df <= 0.5 * n), le AS (SELECT sku, sqrt(sum(v * v)) AS le FROM v GROUP BY 1), x AS (SELECT v.sku, term, v / le AS v FROM v JOIN le ON v.sku = le.sku),
pa AS (SELECT customer_id, sku, order_ts FROM lines WHERE order_ts < TIMESTAMP '2001-08-01' AND order_ts >= TIMESTAMP '2001-08-01' - INTERVAL 730 DAY), la AS (SELECT customer_id, arg_max(sku, (order_ts, sku)) AS anchor FROM pa WHERE order_ts >= TIMESTAMP '2001-08-01' - INTERVAL 30 DAY GROUP BY 1),
s AS (SELECT a.sku AS anchor, b.sku, sum(a.v * b.v) AS s FROM x a JOIN x b ON a.term = b.term AND a.sku <> b.sku JOIN ws ON ws.sku = b.sku AND ok WHERE a.sku IN (SELECT anchor FROM la) GROUP BY 1, 2), nb AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY round(s, 9) DESC, sku) AS r FROM s),
c AS (SELECT la.customer_id, la.anchor, nb.sku, s FROM la JOIN nb ON nb.anchor = la.anchor AND r <= 24 AND s >= 0.08 WHERE NOT EXISTS (SELECT 1 FROM pa WHERE pa.customer_id = la.customer_id AND pa.sku = nb.sku)), k AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY round(s, 9) DESC, sku) AS rank FROM c)
SELECT customer_id, anchor, sku, round(s, 4) + 0.0 AS similarity, rank FROM k WHERE rank <= 6""")
def mail_recommendations(t: Tables) -> DataFrame:
    return _round(recs.mail_recommendations(mailed(t), t.lines, "2001-08-01", STOP))


def listings(t: Tables) -> DataFrame:
    p = t.products
    return p.select((F.col("sku") + 1_000_000).alias("listing_id"), F.concat(F.lit("shop"), (F.col("sku") % 3).cast("string")).alias("competitor"), F.concat("title", F.lit(" sale")).alias("title"), "brand", "category", (F.col("price") * (0.9 + (F.col("sku") % 5) / 20)).alias("price"))


@query()
def competitor_match(t: Tables) -> DataFrame:
    return _round(recs.match_listings(t.products, listings(t), 0.6))


@query()
def duplicate_listings(t: Tables) -> DataFrame:
    """Pairs of different listings by their smallest products, and each copy with the smallest of its title and price: no link lost."""
    return _round(recs.duplicate_listings(t.products, 0.97, expand=False))


_SHINGLES = rf"""tk AS (SELECT review_id, regexp_extract_all(lower(body), '([a-z0-9'']+)', 1) AS t FROM reviews), sh AS (SELECT review_id, list_distinct(CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 3 THEN [array_to_string(t, ' ')] ELSE list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]) END) AS s FROM tk)"""
_JACCARD = f"""WITH {REVIEWS}, {_SHINGLES}, x AS (SELECT review_id, unnest(s) AS g, len(s) AS n FROM sh), pr AS (SELECT a.review_id AS a, b.review_id AS b, count(*) / (max(a.n) + max(b.n) - count(*)) AS jaccard FROM x a JOIN x b ON a.g = b.g AND a.review_id < b.review_id GROUP BY 1, 2), cl AS (SELECT reviews.review_id, min(reviews.review_id) OVER (PARTITION BY body) AS c FROM reviews JOIN sh ON reviews.review_id = sh.review_id WHERE len(s) > 0)"""


@query(
    _JACCARD
    + """ SELECT a, b, round(jaccard, 4) + 0.0 AS jaccard FROM pr WHERE jaccard >= 0.6 AND a IN (SELECT c FROM cl) AND b IN (SELECT c FROM cl)
UNION ALL SELECT c AS a, review_id AS b, CAST(1 AS DOUBLE) AS jaccard FROM cl WHERE c <> review_id"""
)
def near_duplicate_docs(t: Tables) -> DataFrame:
    """Pairs of different texts by their smallest documents, and each copy with the smallest of its text: linear in the copies, no link lost."""
    return _round(graph.exact_jaccard(t.bodies, "review_id", "body", expand=False))


@query()
def minhash_candidates(t: Tables) -> DataFrame:
    return _round(graph.jaccard_pairs(t.bodies, "review_id", "body", expand=False))


_EDGES = f"WITH RECURSIVE {EVENTS}, o AS (SELECT DISTINCT customer_id, CAST(sku AS VARCHAR) || strftime(event_ts, '-%Y-%m-%d-%H') AS device FROM ev WHERE sku IS NOT NULL), k AS (SELECT device, min(customer_id) AS a, count(*) AS n FROM o GROUP BY 1 HAVING count(*) >= 2), e AS (SELECT DISTINCT k.a, o.customer_id AS b FROM o JOIN k ON o.device = k.device WHERE o.customer_id <> k.a)"


def devices(t: Tables) -> DataFrame:
    """Who used which device: an item in an hour. All of them count; a fan-out limit is for shared IP addresses."""
    return t.events.select("customer_id", F.concat(F.col("sku").cast("string"), F.date_format("event_ts", "-yyyy-MM-dd-HH")).alias("device"))


@query(_EDGES + ", s AS (SELECT a AS u, b AS v FROM e UNION SELECT b, a FROM e), r(node, c) AS (SELECT u, u FROM s UNION SELECT s.v, r.c FROM r JOIN s ON s.u = r.node) SELECT node, min(c) AS component FROM r GROUP BY 1")
def reviewer_components(t: Tables) -> DataFrame:
    return graph.components(graph.star_edges(devices(t), "device", "customer_id"))


@query(f"""WITH {EVENTS}, w AS (SELECT customer_id, event_ts, count(*) OVER b AS n, min(event_ts) OVER b AS start, epoch_us(event_ts) AS us FROM ev WHERE event_type = 'purchase' WINDOW b AS (PARTITION BY customer_id ORDER BY epoch_us(event_ts) RANGE BETWEEN 172800000000 PRECEDING AND CURRENT ROW)), r AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY us, n DESC) AS r FROM w WHERE n >= 4)
SELECT customer_id, start, event_ts AS "end", n FROM r WHERE r = 1""")
def burst_windows(t: Tables) -> DataFrame:
    return graph.bursts(t.events.where("event_type = 'purchase'"), ["customer_id"], "event_ts", 48, 4)


@query(_EDGES + """, s AS (SELECT a AS u, b AS v FROM e UNION SELECT b, a FROM e), r(node, c) AS (SELECT u, u FROM s UNION SELECT s.v, r.c FROM r JOIN s ON s.u = r.node), co AS (SELECT node, min(c) AS component FROM r GROUP BY 1),
sz AS (SELECT component, count(*) AS members FROM co GROUP BY 1 HAVING count(*) >= 3), rv AS (SELECT sz.component, members, customer_id, sku % 5 AS sku, event_ts, epoch_us(event_ts) AS us FROM ev JOIN co ON node = customer_id JOIN sz ON sz.component = co.component WHERE event_type IN ('purchase', 'click')),
bu AS (SELECT DISTINCT component, sku FROM (SELECT component, sku, count(*) OVER (PARTITION BY component, sku ORDER BY us RANGE BETWEEN 172800000000 PRECEDING AND CURRENT ROW) AS n FROM rv) WHERE n >= 4), nb AS (SELECT component, count(*) AS bursts FROM bu GROUP BY 1),
ag AS (SELECT component, customer_id, (min(us) - epoch_us(TIMESTAMP '2023-12-20')) // 86400000000 AS days FROM rv GROUP BY 1, 2), ns AS (SELECT component, avg(CASE WHEN days <= 30 THEN 1.0 ELSE 0.0 END) AS new_share FROM ag GROUP BY 1)
SELECT sz.component, members, bursts, round(new_share, 4) + 0.0 AS new_share FROM sz JOIN nb ON nb.component = sz.component JOIN ns ON ns.component = sz.component WHERE new_share >= 0.5""")
def suspicious_rings(t: Tables) -> DataFrame:
    comp = graph.components(graph.star_edges(devices(t), "device", "customer_id"))
    r = t.events.where("event_type in ('purchase', 'click')").select(F.col("customer_id").alias("reviewer_id"), (F.col("sku") % 5).alias("sku"), F.lit(5).alias("rating"), F.col("event_ts").alias("created_at"), F.lit("2023-12-20").cast("timestamp_ntz").alias("account_created_at"))
    return _round(graph.rings(comp, r))


@query("""WITH z AS (SELECT p_partkey AS sku, p_type AS category, (p_size - 25.0) / 10 AS z, p_retailprice / 1000 AS aff FROM part) SELECT sku, round(0.65 * greatest(aff, 0.2) + 0.35 / (1 + exp(-z / 2)), 4) + 0.0 AS relevance FROM z""")
def module_relevance(t: Tables) -> DataFrame:
    z, aff = (F.col("size") - 25.0) / 10, F.col("price") / 1000
    return t.products.select("sku", rounded(recs.relevance(clip(aff, 0.0), F.lit(0.2), z)).alias("relevance"))
