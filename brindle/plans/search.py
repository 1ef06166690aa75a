"""Queries about search: suggestions, intents, synonyms, relevance, clicks, query categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions import text as tx
from brindle.operators import bayes, retrieval, search, vectors
from brindle.sources.tables import Tables

from .customers import _round
from .registry import REVIEWS, SEARCHES, query

#: SQL of text expressions.
_PLAIN = r"trim(regexp_replace(regexp_replace(lower({}), '[^a-z0-9 ''&\-]', ' ', 'g'), '\s+', ' ', 'g'))"


def _singular(x: str, keep: str = "(ss|us)$", short: int = 3) -> str:
    return f"CASE WHEN regexp_matches({x}, 'ies$') AND length({x}) > 4 THEN substring({x}, 1, length({x}) - 3) || 'y' WHEN regexp_matches({x}, '(ches|shes|sses|xes)$') THEN substring({x}, 1, length({x}) - 2) WHEN regexp_matches({x}, 's$') AND NOT regexp_matches({x}, '{keep}') AND length({x}) > {short} THEN substring({x}, 1, length({x}) - 1) ELSE {x} END"


def _stem(x: str) -> str:
    return f"CASE WHEN length({x}) <= 3 OR regexp_matches({x}, '^[0-9]+$') THEN {x} ELSE {_singular(x, '(ss|us|is)$', 0)} END"


def _tokens(x: str, stop: bool = False) -> str:
    t = f"regexp_extract_all(lower({x}), '([a-z0-9]+)', 1)"
    return f"list_filter({t}, lambda x: NOT (x IN ({', '.join(repr(w) for w in tx.STOPWORDS)})))" if stop else t


_AUTO = f"""WITH {SEARCHES}, q0 AS (SELECT {_PLAIN.format('trim(query_text)')} AS q, event_date, count(*) AS n, count(*) FILTER (WHERE clicked) AS c FROM searches GROUP BY 1, 2),
q1 AS (SELECT q, sum(n * w) AS ws, sum(c * w) AS wc FROM (SELECT *, pow(0.5, greatest(date_diff('day', event_date, DATE '2024-03-01'), 0) / 14.0) AS w FROM q0 WHERE length(q) BETWEEN 2 AND 60) GROUP BY 1 HAVING sum(n * w) >= 0.2),
q2 AS (SELECT *, ln(1 + ws) * (0.4 + 0.6 * (wc + 1) / (ws + 2)) AS score, array_to_string(list_transform(list_filter(string_split(replace(q, '-', ' '), ' '), lambda x: x <> ''), lambda x: {_singular('x')}), ' ') AS key FROM q1),
q3 AS (SELECT q, sum(score) OVER (PARTITION BY key) AS pooled, row_number() OVER (PARTITION BY key ORDER BY round(score, 9) DESC, q) AS r FROM q2),
p AS (SELECT substring(q, 1, i) AS prefix, q AS suggestion, pooled AS score FROM (SELECT q, pooled, unnest(range(1, least(length(q), 20) + 1)) AS i FROM q3 WHERE r = 1)),
k AS (SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY round(score, 9) DESC, suggestion) AS rank FROM p)
SELECT prefix, suggestion, round(score, 4) + 0.0 AS score, rank FROM k WHERE rank <= 8"""


@query(_AUTO)
def autocomplete_index(t: Tables) -> DataFrame:
    return _round(search.autocomplete(t.queries, "2024-03-01", least=0.2))


@query(f"WITH a AS ({_AUTO}) SELECT prefix, string_agg(suggestion, '|' ORDER BY rank) AS suggestions, max(score) AS best, count(*) AS n FROM a GROUP BY 1")
def autocomplete_rows(t: Tables) -> DataFrame:
    """The index, flat: a row a prefix."""
    r = search.suggestion_rows(_round(search.autocomplete(t.queries, "2024-03-01", least=0.2)))
    return r.select("prefix", F.array_join(F.transform("suggestions", lambda x: x["text"]), "|").alias("suggestions"), F.array_max(F.transform("suggestions", lambda x: x["score"])).alias("best"), F.size("suggestions").cast("long").alias("n"))


_LEET = "translate({}, '" + "".join(tx.LEET) + "', '" + "".join(tx.LEET.values()) + "')"
_SPOILED = ["", " sh1t", " d1ck sale", " n a z i", " p0rnhub", " dickens", "$lut"]


@query(f"""WITH q AS (SELECT p_partkey AS sku, lower(p_name) || (['{"', '".join(_SPOILED)}'])[CAST(p_partkey % {len(_SPOILED)} AS INT) + 1] AS q FROM part), r AS (SELECT sku, {_LEET.format('q')} AS r FROM q)
SELECT sku, regexp_matches(' ' || r || ' ', ' (?:{'|'.join(tx.BLOCKED)}) ') OR regexp_matches(replace(r, ' ', ''), '{'|'.join(w for w in tx.BLOCKED if len(w) >= 5)}') AS blocked FROM r""")
def blocked_titles(t: Tables) -> DataFrame:
    """Titles with words that must not be suggested, in digits and signs, too."""
    ends = F.array(*[F.lit(x) for x in _SPOILED])
    return t.products.select("sku", tx.blocked(F.concat(F.lower("title"), F.get(ends, (F.col("sku") % len(_SPOILED)).cast("int")))).alias("blocked"))


_FIRST = "WITH " + SEARCHES + ", w1 AS (SELECT string_split(query_text, ' ')[1] AS query_text, category_id, clicked, query_id FROM searches WHERE query_text <> '')"
_SHARES = ", s0 AS (SELECT query_text, category_id, count(*) + 1.0 AS w FROM w1 WHERE query_id % 2 = 0 GROUP BY 1, 2), s1 AS (SELECT *, w / sum(w) OVER (PARTITION BY query_text) AS share FROM s0), sh AS (SELECT query_text, category_id, share, row_number() OVER (PARTITION BY query_text ORDER BY share DESC, category_id) AS rank FROM s1 WHERE share >= 0.05)"


def first_words(t: Tables) -> DataFrame:
    return t.queries.where("query_text != ''").withColumn("query_text", F.get(F.split("query_text", " "), F.lit(0)))


@query(_FIRST + _SHARES + " SELECT query_text, category_id, round(share, 4) + 0.0 AS share, rank FROM sh WHERE rank <= 3")
def query_intents(t: Tables) -> DataFrame:
    return _round(search.category_shares(first_words(t).where("query_id % 2 = 0")))


@query(
    f"WITH {SEARCHES}, w1 AS (SELECT query_text, category_id, query_id FROM searches WHERE query_text <> '')" + _SHARES
    + """, k AS (SELECT * FROM sh WHERE rank <= 3), bw AS (SELECT w, category_id, sum(share) AS s FROM (SELECT unnest(string_split(query_text, ' ')) AS w, category_id, share FROM k) GROUP BY 1, 2),
nw AS (SELECT DISTINCT query_text FROM w1 WHERE query_text NOT IN (SELECT query_text FROM k)), h AS (SELECT n.query_text, category_id, sum(s) AS s FROM (SELECT query_text, unnest(string_split(query_text, ' ')) AS w FROM nw) n JOIN bw ON n.w = bw.w GROUP BY 1, 2),
z AS (SELECT query_text, category_id, s / sum(s) OVER (PARTITION BY query_text) AS share FROM h), r AS (SELECT *, row_number() OVER (PARTITION BY query_text ORDER BY round(share, 9) DESC, category_id) AS rank FROM z)
SELECT query_text, category_id, round(share, 4) + 0.0 AS share, rank FROM r WHERE rank <= 3"""
)
def intent_backoff(t: Tables) -> DataFrame:
    q = t.queries.where("query_text != ''")
    return _round(search.token_backoff(search.category_shares(q.where("query_id % 2 = 0")), q))


_TURNS = """log AS (SELECT conv_id AS session_id, array_to_string(w[3 * i + 1 : 3 * i + 3], ' ') AS query_text, TIMESTAMP '2024-01-01' + to_seconds(turn * 100000 + i * 30) AS event_ts, i % 2 = 1 AS clicked FROM (SELECT *, unnest(range(0, (len(w) + 2) // 3)) AS i FROM (SELECT conv_id, turn, regexp_extract_all(lower(text), '([a-z0-9]+)', 1) AS w FROM conversations)))"""


def turn_log(t: Tables) -> DataFrame:
    """A search log: a turn's words by threes, half a minute apart; every second one is clicked."""
    c = t.raw("conversations").withColumn("w", tx.tokens(F.col("text")))
    i = F.explode(F.sequence(F.lit(0), F.floor((F.size("w") + 2) / 3).cast("int") - 1))
    c = c.where(F.size("w") > 0).select("conv_id", "turn", "w", i.alias("i"))
    ts = (F.lit("2024-01-01").cast("timestamp").cast("long") + F.col("turn") * 100_000 + F.col("i") * 30).cast("timestamp")
    q = F.array_join(F.slice("w", 3 * F.col("i") + 1, F.lit(3)), " ")
    return c.select(F.col("conv_id").alias("session_id"), q.alias("query_text"), ts.alias("event_ts"), (F.col("i") % 2 == 1).alias("clicked"))


_SWAPS = f"""WITH {_TURNS}, st AS (SELECT session_id, query_text, min(event_ts) AS ts, max(CAST(clicked AS INT)) AS clicked FROM log GROUP BY 1, 2),
nx AS (SELECT clicked, query_text, ts, lead(clicked) OVER w AS c2, lead(query_text) OVER w AS q2, lead(ts) OVER w AS t2 FROM st WINDOW w AS (PARTITION BY session_id ORDER BY ts, query_text)),
rf AS (SELECT list_transform({_tokens('query_text', True)}, lambda x: {_stem('x')}) AS before, list_transform({_tokens('q2', True)}, lambda x: {_stem('x')}) AS after FROM nx WHERE clicked = 0 AND c2 = 1 AND (epoch_us(t2) - epoch_us(ts)) / 1e6 <= 120),
r2 AS (SELECT *, list_filter(before, lambda x: NOT list_contains(after, x)) AS gone, list_filter(after, lambda x: NOT list_contains(before, x)) AS came FROM rf WHERE len(before) > 0 AND len(after) > 0 AND before <> after),
sw AS (SELECT CASE WHEN len(gone) = len(came) THEN list_zip(gone, came) ELSE [(array_to_string(gone, ' '), array_to_string(came, ' '))] END AS ps FROM r2 WHERE len(gone) BETWEEN 1 AND 2 AND len(came) BETWEEN 1 AND 2 AND (len(list_intersect(before, after)) > 0 OR (len(before) = 1 AND len(after) = 1))),
pr AS (SELECT p[1] AS a, p[2] AS b FROM (SELECT unnest(ps) AS p FROM sw))"""


@query(_SWAPS + " SELECT a, b, count(*) AS n FROM pr GROUP BY 1, 2")
def reformulation_pairs(t: Tables) -> DataFrame:
    return search.term_swaps(search.reformulations(turn_log(t))).groupBy("a", "b").agg(F.count("*").alias("n"))


_PAIRS = f"""WITH {REVIEWS}, tk AS (SELECT review_id, {_tokens('body')} AS t FROM reviews), pr AS (SELECT t[i] AS a, t[i + 1] AS b FROM (SELECT t, unnest(range(1, len(t))) AS i FROM tk)),"""


@query(
    _PAIRS + """ j0 AS (SELECT a, b, count(*) AS n FROM pr GROUP BY 1, 2), j1 AS (SELECT *, sum(n) OVER (PARTITION BY a) AS na, sum(n) OVER (PARTITION BY b) AS nb, (SELECT count(*) FROM pr) AS tot FROM j0),
j2 AS (SELECT a, b, n, ln(n * tot / (na * nb)) AS pmi, ln(n * tot / (na * nb)) / -ln(n / tot) AS npmi FROM j1 WHERE n >= 8 AND greatest(length(a), length(b)) / greatest(1, least(length(a), length(b))) <= 3
  AND NOT (levenshtein(a, b) < least(3, greatest(1, least(length(a), length(b)) // 3))) AND replace(a, ' ', '') <> replace(b, ' ', '')),
j3 AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY least(a, b), greatest(a, b)) > 1 THEN 'both' ELSE 'one_way' END AS direction, row_number() OVER (PARTITION BY least(a, b), greatest(a, b) ORDER BY round(npmi, 9) DESC, a) AS r FROM j2 WHERE npmi >= 0.15),
j4 AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(npmi, 9) DESC, b) AS rank FROM j3 WHERE r = 1)
SELECT a AS term, b AS synonym, n AS support, round(pmi, 4) + 0.0 AS pmi, round(npmi, 4) + 0.0 AS npmi, direction, rank FROM j4 WHERE rank <= 5"""
)
def synonym_pmi(t: Tables) -> DataFrame:
    k = tx.tokens(F.col("body"))
    pairs = t.reviews.select(F.explode(tx.bigrams(k, " ")).alias("p")).select(F.get(F.split("p", " "), F.lit(0)).alias("a"), F.get(F.split("p", " "), F.lit(1)).alias("b"))
    return _round(search.synonym_scores(pairs))


@query(f"WITH {REVIEWS}, tk AS (SELECT DISTINCT review_id, unnest({_tokens('body')}) AS term FROM reviews), d AS (SELECT term, count(*) AS df FROM tk GROUP BY 1) SELECT term, df, round(ln(((SELECT count(*) FROM reviews) + 1) / (df + 1)) + 1, 4) + 0.0 AS idf FROM d")
def query_idf_table(t: Tables) -> DataFrame:
    return _round(search.idf_table(t.reviews, tx.tokens(F.col("body"))))


_BM = f"""WITH {SEARCHES}, d AS (SELECT review_id AS doc_id, {_tokens('body')} AS terms FROM reviews), q AS (SELECT DISTINCT query_id, unnest(string_split(query_text, ' ')) AS t FROM searches WHERE query_id % 20 = 0 AND query_text <> ''),
st AS (SELECT count(*) AS n, avg(len(terms)) AS avgdl FROM d), tf AS (SELECT doc_id, len, t, count(*) AS tf FROM (SELECT doc_id, len(terms) AS len, unnest(terms) AS t FROM d) GROUP BY 1, 2, 3), df AS (SELECT t, count(*) AS df FROM tf GROUP BY 1)
SELECT query_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / avgdl))), 4) + 0.0 AS score FROM q JOIN df ON q.t = df.t JOIN tf ON q.t = tf.t, st GROUP BY 1, 2"""


@query(_BM)
def bm25_scores(t: Tables) -> DataFrame:
    # A stated set of queries against all documents.
    q = t.queries.where("query_id % 20 = 0 and query_text != ''").select("query_id", F.split("query_text", " ").alias("terms"))
    return _round(search.bm25(q, t.reviews.select(F.col("review_id").alias("doc_id"), tx.tokens(F.col("body")).alias("terms"))))


@query(_BM.replace("SELECT query_id, doc_id, round(sum(", "SELECT query_id, doc_id, round(s, 4) + 0.0 AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, doc_id) AS rank FROM (SELECT query_id, doc_id, sum(").replace("))), 4) + 0.0 AS score FROM q JOIN", "))) AS s FROM q JOIN") + ")) WHERE rank <= 100")
def bm25_topk(t: Tables) -> DataFrame:
    """The best hundred documents of the same queries, from the index."""
    q = t.queries.where("query_id % 20 = 0 and query_text != ''").select("query_id", F.split("query_text", " ").alias("terms"))
    docs = t.reviews.select(F.col("review_id").alias("doc_id"), tx.tokens(F.col("body")).alias("terms"))
    lists = retrieval.index(docs, terms=q.select(F.explode("terms").alias("term")))
    return _round(retrieval.search(lists, q, 100).drop("read", "postings"))


@query("""WITH p AS (SELECT DISTINCT p_partkey AS doc_id, unnest(string_split(lower(p_name), ' ')) AS term FROM part), q AS (SELECT DISTINCT p_name AS query_id, unnest(string_split(lower(p_name), ' ')) AS term FROM part), n AS (SELECT query_id, count(*) AS n FROM q GROUP BY 1)
SELECT q.query_id, doc_id FROM q JOIN p ON q.term = p.term JOIN n ON n.query_id = q.query_id GROUP BY 1, 2, n HAVING count(*) = n""")
def title_tokens_inverted_and(t: Tables) -> DataFrame:
    words = F.split(F.lower("title"), " ")
    post = t.products.select(F.col("sku").alias("doc_id"), F.explode(F.array_distinct(words)).alias("term"))
    return search.match_all(t.products.select(F.col("title").alias("query_id"), words.alias("terms")).distinct(), post)


@query("WITH " + SEARCHES + ", g AS (SELECT query_text, category_id, count(*) FILTER (WHERE clicked) AS clicks, count(*) AS impressions FROM searches GROUP BY 1, 2) SELECT *, round((clicks + 2) / (impressions + 40), 4) + 0.0 AS ctr FROM g")
def smoothed_ctr(t: Tables) -> DataFrame:
    return _round(search.smoothed_ctr(t.queries))


@query("""WITH l AS (SELECT (event_id % 20) + 1 AS position, event_type IN ('click', 'purchase') AND (event_id // 20) % ((event_id % 20) + 1) < 3 AS clicked FROM events), c AS (SELECT position, avg(CAST(clicked AS DOUBLE)) AS ctr FROM l GROUP BY 1),
s AS (SELECT position, avg(ctr) OVER (ORDER BY position ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS smooth FROM c), p AS (SELECT position, greatest(0.02, smooth / first_value(smooth) OVER (ORDER BY position)) AS p FROM s)
SELECT position, round(p, 4) + 0.0 AS propensity, round(least(20.0, greatest(1.0, 1 / p)), 4) + 0.0 AS click_weight FROM p""")
def position_propensity(t: Tables) -> DataFrame:
    pos = F.col("event_id") % 20 + 1
    clicked = F.col("event_type").isin("click", "purchase") & (F.floor(F.col("event_id") / 20) % pos < 3)
    return _round(search.position_propensity(t.events.select(pos.alias("position"), clicked.alias("clicked"))))


_NB = f"""WITH {REVIEWS}, d AS (SELECT review_id, lang AS label, list_filter({_tokens('body')}, lambda x: length(x) >= 2) AS terms, review_id % 5 = 0 AS test FROM reviews),
tr AS (SELECT label, count(*) * 1.0 AS w FROM d WHERE NOT test GROUP BY 1), c AS (SELECT label, term, count(*) * 1.0 AS c FROM (SELECT label, unnest(terms) AS term FROM d WHERE NOT test) GROUP BY 1, 2),
v AS (SELECT count(DISTINCT term) AS v FROM c), cl AS (SELECT tr.label, ln((w + 1) / ((SELECT sum(w) FROM tr) + (SELECT count(*) FROM tr))) AS lp, (SELECT sum(c) FROM c WHERE c.label = tr.label) + (SELECT v FROM v) AS total FROM tr),
te AS (SELECT review_id, term, count(*) AS m FROM (SELECT review_id, unnest(terms) AS term FROM d WHERE test) WHERE term IN (SELECT term FROM c) GROUP BY 1, 2),
ids AS (SELECT DISTINCT review_id FROM d WHERE test), s AS (SELECT i.review_id, cl.label, lp + coalesce(sum(m * (ln(coalesce(c.c, 0) + 1) - ln(total))), 0) AS s FROM ids i CROSS JOIN cl LEFT JOIN te ON te.review_id = i.review_id LEFT JOIN c ON c.label = cl.label AND c.term = te.term GROUP BY i.review_id, cl.label, lp),
e AS (SELECT *, exp(s - max(s) OVER (PARTITION BY review_id)) AS e FROM s), p AS (SELECT review_id, label, e / sum(e) OVER (PARTITION BY review_id) AS p FROM e),
r AS (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY round(p, 9) DESC, label) AS rank FROM p)
SELECT review_id, label, round(p, 4) + 0.0 AS p, rank FROM r"""


def text_labels(t: Tables) -> DataFrame:
    return t.reviews.select("review_id", F.col("lang").alias("label"), F.lit(1.0).alias("weight"), tx.tokens(F.col("body"), 2).alias("terms"))


@query(_NB)
def text_class_nb(t: Tables) -> DataFrame:
    d = text_labels(t)
    return _round(bayes.predict(d.where("review_id % 5 = 0"), bayes.fit(d.where("review_id % 5 != 0"), 1.0), "review_id"))


@query(_NB.replace("SELECT review_id, label, round(p, 4) + 0.0 AS p, rank FROM r", "SELECT d.label, round(avg(CASE WHEN r.label = d.label THEN 1.0 ELSE 0.0 END), 4) + 0.0 AS accuracy, count(*) AS n FROM r JOIN d ON d.review_id = r.review_id WHERE rank = 1 GROUP BY 1"))
def class_accuracy(t: Tables) -> DataFrame:
    """How many of each class's held-out texts are told right."""
    d = text_labels(t)
    p = bayes.predict(d.where("review_id % 5 = 0"), bayes.fit(d.where("review_id % 5 != 0"), 1.0), "review_id").where("rank = 1")
    return _round(bayes.accuracy(p.select("review_id", F.col("label").alias("guess")).join(d.select("review_id", "label"), "review_id")))


_QNB = """WITH q AS (SELECT lower(p_name) AS q, lower(p_type) AS label, count(*) AS n FROM part GROUP BY 1, 2), sh AS (SELECT q, label, ln(1 + n) AS weight FROM (SELECT *, n / sum(n) OVER (PARTITION BY q) AS s FROM q) WHERE s >= 0.18),
g AS (SELECT label, weight, unnest(flatten([list_transform(range(1, length(' ' || q || ' ') - n + 2), lambda i: substring(' ' || q || ' ', i, n)) for n in [2, 3, 4]])) AS term FROM sh),
c AS (SELECT label, term, sum(weight) AS c FROM g GROUP BY 1, 2) SELECT label, term, round(c, 4) + 0.0 AS c FROM c"""


@query(_QNB)
def query_category_nb(t: Tables) -> DataFrame:
    """The weighted n-gram counts of the query classifier."""
    q = t.products.groupBy(F.lower("title").alias("q"), F.lower("category").alias("label")).agg(F.count("*").alias("n"))
    from pyspark.sql import Window

    q = q.withColumn("s", F.col("n") / F.sum("n").over(Window.partitionBy("q"))).where("s >= 0.18")
    m = bayes.fit(q.select("label", F.log1p("n").alias("weight"), tx.char_ngrams(F.col("q")).alias("terms")), 0.3, "share")
    return _round(m["terms"].select("label", "term", "c"))


@query("""WITH q AS (SELECT DISTINCT lower(p_name) AS q, lower(p_type) AS label FROM part), g AS (SELECT q, label, unnest(flatten([list_transform(range(1, length(' ' || q || ' ') - n + 2), lambda i: substring(' ' || q || ' ', i, n)) for n in [2, 3, 4]])) AS term FROM q),
c AS (SELECT label, term, count(*) * 1.0 AS c FROM g GROUP BY 1, 2), v AS (SELECT count(DISTINCT term) AS v FROM c), cl AS (SELECT label, ln(count(*) / (SELECT count(*) FROM q)) AS lp FROM q GROUP BY 1), tt AS (SELECT label, sum(c) + 0.3 * (SELECT v FROM v) AS total FROM c GROUP BY 1),
te AS (SELECT q, term, count(*) AS m FROM (SELECT DISTINCT q, label, term, k FROM (SELECT q, label, term, row_number() OVER (PARTITION BY q, label, term) AS k FROM g WHERE label = (SELECT min(label) FROM q q2 WHERE q2.q = g.q))) GROUP BY 1, 2),
s AS (SELECT te.q, cl.label, any_value(lp) + sum(m * (ln(coalesce(c.c, 0) + 0.3) - ln(total))) AS s FROM te CROSS JOIN cl JOIN tt ON tt.label = cl.label LEFT JOIN c ON c.label = cl.label AND c.term = te.term GROUP BY 1, 2),
e AS (SELECT *, exp(s - max(s) OVER (PARTITION BY q)) AS e FROM s), p AS (SELECT q, label, e / sum(e) OVER (PARTITION BY q) AS p FROM e), r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(p, 9) DESC, label) AS rank FROM p)
SELECT q, max(label) FILTER (WHERE rank = 1) AS best, round(max(p) FILTER (WHERE rank = 1), 4) + 0.0 AS p, max(label) FILTER (WHERE rank = 2) AS second FROM r GROUP BY 1""")
def query_categories(t: Tables) -> DataFrame:
    """Best and second category of each product title, with its n-gram classifier."""
    q = t.products.select(F.lower("title").alias("q"), F.lower("category").alias("label")).distinct()
    m = bayes.fit(q.select("label", F.lit(1.0).alias("weight"), tx.char_ngrams(F.col("q")).alias("terms")), 0.3, "share")
    p = bayes.predict(q.select("q").distinct().withColumn("terms", tx.char_ngrams(F.col("q"))), m, "q")
    return _round(p.where("rank <= 2").groupBy("q").agg(F.max(F.when(F.col("rank") == 1, F.col("label"))).alias("best"), F.max(F.when(F.col("rank") == 1, F.col("p"))).alias("p"), F.max(F.when(F.col("rank") == 2, F.col("label"))).alias("second")))


@query("""WITH v AS (SELECT word, count(*) AS n FROM (SELECT unnest(string_split(lower(p_name), ' ')) AS word FROM part) GROUP BY 1), wr AS (SELECT DISTINCT unnest([substring(word, 2, 50), substring(word, 1, 2) || 'z' || substring(word, 3, 50)]) AS word FROM v), k AS (SELECT * FROM v WHERE n >= 3),
c AS (SELECT wr.word, k.word AS cand, n, damerau_levenshtein(wr.word, k.word) AS dist FROM wr, k WHERE NOT regexp_matches(wr.word, '^[0-9]+$') AND length(wr.word) > 2 AND wr.word NOT IN (SELECT word FROM k)), d AS (SELECT *, min(dist) OVER (PARTITION BY word) AS closest FROM c WHERE dist = 1 OR (dist = 2 AND length(word) > 4)),
r AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY round(ln(n / (SELECT sum(n) FROM k) + 1e-12) + CASE WHEN dist = 1 THEN ln(0.08) ELSE ln(0.004) END, 9) DESC, cand) AS r FROM d WHERE dist = closest) SELECT word, cand AS best, CAST(dist AS INT) AS dist FROM r WHERE r = 1""")
def spell_corrections(t: Tables) -> DataFrame:
    words = t.products.select(F.explode(F.split(F.lower("title"), " ")).alias("word"))
    vocab = words.groupBy("word").agg(F.count("*").alias("n"))
    wrong = vocab.select(F.explode(F.array(F.concat(F.substring("word", 2, 50), F.lit("")), F.concat(F.substring("word", 1, 2), F.lit("z"), F.substring("word", 3, 50)))).alias("word"))
    return search.corrections(wrong, vocab)


_ZERO = """WITH pr AS (SELECT p_partkey AS sku, p_type AS category, list_distinct(string_split(lower(p_name), ' ')) AS ts FROM part), ix AS (SELECT sku, category, unnest(ts) AS term FROM pr), n AS (SELECT count(*) AS n FROM pr), kn AS (SELECT term, ln(((SELECT n FROM n) + 1) / (count(*) + 1)) + 1 AS idf FROM ix GROUP BY 1),
q AS (SELECT DISTINCT lower(p_name) || ' zzz ' || lower(p_brand) AS query FROM part), w AS (SELECT query, string_split(query, ' ') AS ws FROM q), t0 AS (SELECT query, term, min(pos) AS pos FROM (SELECT query, unnest(ws) AS term, unnest(range(0, len(ws))) AS pos FROM w) GROUP BY 1, 2),
t AS (SELECT t0.*, idf, row_number() OVER (PARTITION BY query ORDER BY idf IS NOT NULL, t0.term IN ('king', 'queen', 'twin', 'full'), round(idf, 9), pos) AS gone, count(*) OVER (PARTITION BY query) AS n, count(*) FILTER (WHERE idf IS NULL) OVER (PARTITION BY query) AS unknown FROM t0 LEFT JOIN kn ON kn.term = t0.term),
tr AS (SELECT * FROM (SELECT *, unnest(range(least(unknown, n - 1), greatest(least(unknown, n - 1), least(n - 1, 3)) + 1)) AS cut FROM t) WHERE gone > cut), hi AS (SELECT query, cut, sku FROM tr JOIN ix ON ix.term = tr.term GROUP BY query, cut, n, sku HAVING count(*) = n - cut),
en AS (SELECT query, min(cut) AS cut FROM (SELECT query, cut, count(*) AS m FROM hi GROUP BY 1, 2) WHERE m >= 4 AND cut > 0 GROUP BY 1), ke AS (SELECT t.query, string_agg(term, ' ' ORDER BY pos) AS relaxed FROM t JOIN en ON en.query = t.query WHERE gone > cut GROUP BY 1),
vo AS (SELECT query, category, count(*) AS v FROM t JOIN ix ON ix.term = t.term GROUP BY 1, 2 HAVING count(*) >= 3), tp AS (SELECT query, category FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY v DESC, category) AS r FROM vo) WHERE r = 1)
SELECT q.query, CASE WHEN relaxed IS NOT NULL THEN 'relaxed' WHEN category IS NOT NULL THEN 'category' ELSE 'global' END AS strategy, relaxed, CASE WHEN relaxed IS NULL THEN category END AS category FROM q LEFT JOIN ke ON ke.query = q.query LEFT JOIN tp ON tp.query = q.query"""


def zero_results(t: Tables) -> tuple[DataFrame, DataFrame]:
    p = t.products.select("sku", "category", F.split(F.lower("title"), " ").alias("terms"))
    q = t.products.select(F.concat_ws(" ", F.lower("title"), F.lit("zzz"), F.lower("brand")).alias("query")).distinct()
    return q.select("query", F.split("query", " ").alias("terms")), p


@query(_ZERO)
def zero_result_fallbacks(t: Tables) -> DataFrame:
    return search.zero_result_fallbacks(*zero_results(t))


@query(_ZERO.replace("SELECT q.query, CASE WHEN relaxed", ", fb AS (SELECT q.query, CASE WHEN relaxed", 1) + """), tn AS (SELECT p_partkey AS sku, p_type AS category, p_retailprice % 97 AS score FROM part WHERE p_type <> (SELECT min(p_type) FROM part)),
rg AS (SELECT sku, row_number() OVER (ORDER BY round(score, 9) DESC, sku) AS place FROM tn QUALIFY place <= 5), rc AS (SELECT category, sku, row_number() OVER (PARTITION BY category ORDER BY round(score, 9) DESC, sku) AS rank FROM tn QUALIFY rank <= 5),
g AS (SELECT query, CASE WHEN strategy = 'category' AND category NOT IN (SELECT category FROM rc) THEN 'global' ELSE strategy END AS strategy, relaxed, category FROM fb), rt AS (SELECT DISTINCT query, unnest(string_split(relaxed, ' ')) AS term FROM g WHERE relaxed IS NOT NULL),
mm AS (SELECT query, sku FROM rt JOIN ix ON ix.term = rt.term GROUP BY query, sku HAVING count(*) = (SELECT count(*) FROM rt r2 WHERE r2.query = rt.query)), ow AS (SELECT query, mm.sku, row_number() OVER (PARTITION BY query ORDER BY place NULLS LAST, mm.sku) AS rank FROM mm LEFT JOIN rg ON rg.sku = mm.sku QUALIFY rank <= 5),
sh AS (SELECT query, list(sku ORDER BY rank) AS products FROM (SELECT * FROM ow UNION ALL SELECT query, sku, rank FROM g JOIN rc ON rc.category = g.category WHERE strategy = 'category') GROUP BY 1)
SELECT g.query, strategy, CAST(to_json({'strategy': strategy, 'relaxed': relaxed, 'category': CASE WHEN strategy = 'category' THEN category END, 'products': coalesce(products, (SELECT list(sku ORDER BY place) FROM rg))}) AS VARCHAR) AS payload FROM g LEFT JOIN sh ON sh.query = g.query""")
def zero_result_rows(t: Tables) -> DataFrame:
    """Each query without results with what it shows instead, as a row of JSON; one category has no trend."""
    least = t.products.agg(F.min("category")).first()[0]
    trend = t.products.where(F.col("category") != F.lit(least)).select(F.lit("2024-01-01").alias("snapshot_date"), "category", "sku", (F.col("price") % 97).alias("score"))
    return search.fallback_rows(*zero_results(t), trend, 5)


@query(r"""SELECT doc_id, CASE WHEN regexp_matches(q, '\$(\d+)\s*-\s*\$?(\d+)') THEN CAST(regexp_extract(q, '\$(\d+)\s*-\s*\$?(\d+)', 1) AS DOUBLE) END AS min_price, CASE WHEN regexp_matches(q, '\$(\d+)\s*-\s*\$?(\d+)') THEN CAST(regexp_extract(q, '\$(\d+)\s*-\s*\$?(\d+)', 2) AS DOUBLE) WHEN regexp_matches(q, '\b(?:under|below|less than)\s*\$?(\d+)') THEN CAST(regexp_extract(q, '\b(?:under|below|less than)\s*\$?(\d+)', 1) AS DOUBLE) END AS max_price,
 CASE WHEN regexp_matches(q, '(^|[^\p{L}\p{N}_])queen([^\p{L}\p{N}_]|$)') THEN 'queen' END AS size, CASE WHEN regexp_matches(q, '(^|[^\p{L}\p{N}_])linen([^\p{L}\p{N}_]|$)') THEN 'linen' END AS material
FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'linen sheets under $' || n_chars WHEN 1 THEN 'queen duvet $20 - $' || n_chars ELSE lower(text) END AS q FROM documents)""")
def query_filters(t: Tables) -> DataFrame:
    d, n = t.raw("documents"), F.col("n_chars").cast("string")
    q = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("linen sheets under $"), n)).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("queen duvet $20 - $"), n)).otherwise(F.lower("text"))
    d = d.select("doc_id", q.alias("q"))
    return d.select("doc_id", *[c.alias(k) for k, c in search.query_filters(F.col("q")).items()])


_TF = f"""WITH {REVIEWS}, tk AS (SELECT review_id, unnest(list_filter({_tokens('body')}, lambda x: length(x) >= 4)) AS term FROM reviews), tf AS (SELECT review_id, term, count(*) AS tf FROM tk GROUP BY 1, 2), n AS (SELECT count(*) AS n FROM reviews),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1), w AS (SELECT review_id, tf.term, (1 + ln(tf)) * (ln((n + 1) / (df + 1)) + 1) AS w FROM tf JOIN df ON tf.term = df.term, n WHERE df >= 2 AND df <= 0.5 * n), l AS (SELECT review_id, sqrt(sum(w * w)) AS len FROM w GROUP BY 1), x AS (SELECT w.review_id, term, w / len AS v FROM w JOIN l ON w.review_id = l.review_id),
s AS (SELECT a.review_id, b.review_id AS other, sum(a.v * b.v) AS score FROM x a JOIN x b ON a.term = b.term AND a.review_id <> b.review_id WHERE a.review_id % 20 = 0 GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY round(score, 9) DESC, other) AS rank FROM s)
SELECT review_id, other, round(score, 4) + 0.0 AS score, rank FROM r WHERE rank <= 6 AND score >= 0.08"""


@query(_TF)
def tfidf_neighbours(t: Tables) -> DataFrame:
    """Of a stated set of documents, the nearest among all."""
    w = vectors.tfidf(t.reviews, "review_id", tx.tokens(F.col("body"), 4))
    return _round(vectors.tfidf_neighbours(w, "review_id", 6, queries=F.col("review_id") % 20 == 0))


@query()
def normalized_queries(t: Tables) -> DataFrame:
    return t.reviews.select("review_id", tx.normalize_query(F.col("body")).alias("query_norm"))
