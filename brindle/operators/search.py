"""Search: suggestions, intents, synonyms, fallbacks, relevance and click statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions import text as tx
from brindle.functions.exprs import beta_smoothed, clip, half_life, idf, micros

from brindle.sources.io import latest

from .graph import _checkpoint
from .ranking import best, top_k


def autocomplete(log: DataFrame, as_of: str, life: float = 14.0, least: float = 3.0, success: float = 0.6, k: int = 8, longest: int | None = 20) -> DataFrame:
    """(prefix, rank, suggestion, score). log: query_text, event_date, clicked. Counts decay by age; score = ln(1 + searches) * (0.4 + 0.6 * smoothed
    success); spellings of one query pool their scores under the best; every prefix, of up to ``longest`` characters
    (None: of any length), keeps its k best."""
    q = log.groupBy(tx.plain(F.trim("query_text")).alias("q"), "event_date").agg(F.count("*").alias("n"), F.count_if("clicked").alias("c"))
    q = q.where(F.length("q").between(2, 60) & ~tx.blocked(F.col("q")))
    w = half_life(clip(F.datediff(F.lit(as_of).cast("date"), "event_date").cast("double"), 0.0), life)
    q = q.groupBy("q").agg(F.sum(F.col("n") * w).alias("ws"), F.sum(F.col("c") * w).alias("wc")).where(F.col("ws") >= least)
    score = F.log1p("ws") * ((1 - success) + success * (F.col("wc") + 1) / (F.col("ws") + 2))
    q = q.withColumn("score", score).withColumn("key", tx.variant_key(F.col("q")))
    q = q.withColumn("pooled", F.sum("score").over(Window.partitionBy("key")))
    one = best(q, ["key"], [F.desc(F.round("score", 9)), F.asc("q")]).select("q", "pooled")
    n = F.length("q") if longest is None else F.least(F.length("q"), F.lit(longest))
    prefix = F.explode(F.transform(F.sequence(F.lit(1), n), lambda i: F.substring("q", F.lit(1), i)))
    rows = one.select(prefix.alias("prefix"), F.col("q").alias("suggestion"), F.col("pooled").alias("score"))
    return top_k(rows, ["prefix"], [F.desc(F.round("score", 9)), F.asc("suggestion")], k)


def suggestion_rows(index: DataFrame) -> DataFrame:
    """(prefix, suggestions): one row a prefix, with its suggestions and scores, the best first. index: as from ``autocomplete``."""
    kept = F.array_sort(F.collect_list(F.struct("rank", F.col("suggestion").alias("text"), "score")))  # k of them
    return index.groupBy("prefix").agg(F.transform(kept, lambda x: F.struct(x["text"].alias("text"), x["score"].alias("score"))).alias("suggestions"))


def suggest(index: DataFrame, prefix: str) -> DataFrame:
    """(suggestion, score, rank) of what somebody has typed so far: a filter that reaches the scan of a written index."""
    plain = index.sparkSession.range(1).select(tx.plain(F.lit(prefix))).first()[0]
    return index.where(F.col("prefix") == plain).select("suggestion", "score", "rank").orderBy("rank")


def category_shares(clicks: DataFrame, prior: float = 1.0, least: float = 0.05, k: int = 3) -> DataFrame:
    """(query_text, category_id, share, rank). clicks: query_text, category_id, one row a click. Smoothed shares, small ones dropped."""
    g = clicks.groupBy("query_text", "category_id").agg((F.count("*") + prior).alias("w"))
    g = g.withColumn("share", F.col("w") / F.sum("w").over(Window.partitionBy("query_text"))).where(F.col("share") >= least)
    return top_k(g.drop("w"), ["query_text"], [F.desc("share"), F.asc("category_id")], k)


def token_backoff(shares: DataFrame, queries: DataFrame, k: int = 3) -> DataFrame:
    """Shares for queries without any: those of all queries that have a word in common, summed and scaled. queries: query_text."""
    word = F.explode(F.split("query_text", " "))
    by_word = shares.select(word.alias("w"), "category_id", "share").groupBy("w", "category_id").agg(F.sum("share").alias("s"))
    new = queries.select("query_text").distinct().join(shares.select("query_text").distinct(), "query_text", "left_anti")
    hit = new.select("query_text", word.alias("w")).join(by_word, "w").groupBy("query_text", "category_id").agg(F.sum("s").alias("s"))
    hit = hit.withColumn("share", F.col("s") / F.sum("s").over(Window.partitionBy("query_text"))).drop("s")
    return top_k(hit, ["query_text"], [F.desc(F.round("share", 9)), F.asc("category_id")], k)


#: Sizes and materials that a query may name, first match wins.
SIZES = ["twin xl", "twin", "full", "queen", "california king", "king"]
MATERIALS = ["linen", "cotton", "percale", "sateen", "bamboo", "silk", "wool", "velvet", "jute"]


def query_filters(q: Column) -> dict[str, Column]:
    """min_price, max_price, size and material that a query states."""
    num = lambda rx, g=1: F.when(q.rlike(rx), F.regexp_extract(q, rx, g).cast("double"))
    span = r"\$(\d+)\s*-\s*\$?(\d+)"
    named = lambda values: F.coalesce(*[F.when(q.rlike(rf"\b{v}\b"), F.lit(v)) for v in values])
    return {
        "min_price": F.coalesce(num(span, 1), num(r"\b(?:over|above|more than)\s*\$?(\d+)")), "max_price": F.coalesce(num(span, 2), num(r"\b(?:under|below|less than)\s*\$?(\d+)")),
        "size": named(SIZES), "material": named(MATERIALS),
    }


def corrections(words: DataFrame, vocabulary: DataFrame, least: int = 3) -> DataFrame:
    """(word, best). words: word; vocabulary: word, n. Candidates share a key when each drops up to two letters (one for words of up to four), so
    candidates come from an equi-join; they are ranked by frequency and edit penalty. Known, short and numeric words stay."""
    vocab = vocabulary.where(F.col("n") >= least)
    total = F.broadcast(vocab.agg(F.sum("n").alias("total")))  # one row
    fixed = F.col("word").rlike("^[0-9]+$") | (F.length("word") <= 2)
    new = words.select("word").distinct().where(~fixed).join(vocab.select("word"), "word", "left_anti")

    def drops(df: DataFrame, name: str) -> DataFrame:
        one = lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))
        first = df.withColumn("_d1", one(F.col("word")))
        two = F.when(F.length("word") > 3, F.flatten(F.transform("_d1", one))).otherwise(F.array().cast("array<string>"))
        return first.select(F.col("word").alias(name), *[c for c in df.columns if c != "word"], F.explode(F.array_distinct(F.concat(F.array("word"), F.col("_d1"), two))).alias("key"))

    near = drops(new, "word").join(drops(vocab, "cand"), "key").select("word", "cand", "n").distinct()
    near = near.withColumn("dist", tx.edit_distance("word", "cand")).where((F.col("dist") == 1) | ((F.col("dist") == 2) & (F.length("word") > 4)))
    near = near.withColumn("closest", F.min("dist").over(Window.partitionBy("word"))).where("dist = closest").join(total)
    score = F.log(F.col("n") / F.col("total") + 1e-12) + F.when(F.col("dist") == 1, F.log(F.lit(0.08))).otherwise(F.log(F.lit(0.004)))
    return best(near.withColumn("score", score), ["word"], [F.desc(F.round("score", 9)), F.asc("cand")]).select("word", F.col("cand").alias("best"), "dist")


def reformulations(log: DataFrame, gap_s: int = 120) -> DataFrame:
    """(before, after) token lists of consecutive queries of a session, the first without and the second with a click, soon after.
    log: session_id, query_text, event_ts, clicked. Repeated rows of a query are one step."""
    steps = log.groupBy("session_id", "query_text").agg(F.min("event_ts").alias("ts"), F.max(F.col("clicked").cast("int")).alias("clicked"))
    w = Window.partitionBy("session_id").orderBy("ts", "query_text")
    nxt = lambda c: F.lead(c).over(w)
    stems = lambda c: F.transform(tx.tokens(c, stop=tx.STOPWORDS), lambda t: tx.stem(t))
    pairs = steps.select("clicked", nxt("clicked").alias("c2"), ((micros(nxt("ts")) - micros("ts")) / 1e6).alias("gap"), stems(F.col("query_text")).alias("before"), stems(nxt("query_text")).alias("after"))
    return pairs.where((F.col("clicked") == 0) & (F.col("c2") == 1) & (F.col("gap") <= gap_s) & (F.size("before") > 0) & (F.size("after") > 0) & (F.col("before") != F.col("after"))).select("before", "after")


def term_swaps(refs: DataFrame, most: int = 2) -> DataFrame:
    """(a, b): terms replaced for each other; lists of equal length pair up in order, others as phrases."""
    r = refs.select("before", "after", F.filter("before", lambda t: ~F.array_contains("after", t)).alias("gone"), F.filter("after", lambda t: ~F.array_contains("before", t)).alias("came"))
    kept = (F.size(F.array_intersect("before", "after")) > 0) | ((F.size("before") == 1) & (F.size("after") == 1))
    r = r.where(F.size("gone").between(1, most) & F.size("came").between(1, most) & kept)
    zipped = F.arrays_zip(F.col("gone").alias("a"), F.col("came").alias("b"))
    phrase = F.array(F.struct(F.array_join("gone", " ").alias("a"), F.array_join("came", " ").alias("b")))
    return r.select(F.explode(F.when(F.size("gone") == F.size("came"), zipped).otherwise(phrase)).alias("p")).select("p.a", "p.b")


def synonym_scores(pairs: DataFrame, support: int = 8, least_npmi: float = 0.15, edits: int = 3, ratio: float = 3.0, top: int = 5) -> DataFrame:
    """(term, synonym, support, pmi, npmi, direction). Pairs that look like typos or differ much in length go; of a pair seen both ways the stronger stays."""
    n = F.broadcast(pairs.agg(F.count("*").alias("total")))  # one row
    j = pairs.groupBy("a", "b").agg(F.count("*").alias("n"))
    # Sums by word are aggregates, joined back: a frequent word's pairs need not meet.
    side = lambda c: j.groupBy(c).agg(F.sum("n").alias(f"n{c}"))
    j = j.join(side("a"), "a").join(side("b"), "b").join(n)
    pmi = F.log(F.col("n") * F.col("total") / (F.col("na") * F.col("nb")))
    p = F.col("n") / F.col("total")
    la, lb = F.length("a"), F.length("b")
    limit = F.least(F.lit(edits), F.greatest(F.lit(1), F.floor(F.least(la, lb) / 3).cast("int")))
    typo = (F.levenshtein("a", "b") < limit) | (F.replace("a", F.lit(" "), F.lit("")) == F.replace("b", F.lit(" "), F.lit("")))
    j = j.where((F.col("n") >= support) & (F.greatest(la, lb) / F.greatest(F.lit(1), F.least(la, lb)) <= ratio) & ~typo)
    j = j.withColumn("pmi", pmi).withColumn("npmi", F.when(p < 1, pmi / -F.log(p)).otherwise(1.0)).where(F.col("npmi") >= least_npmi)
    w = Window.partitionBy(F.least("a", "b"), F.greatest("a", "b"))
    j = j.withColumn("direction", F.when(F.count("*").over(w) > 1, "both").otherwise("one_way")).withColumn("_r", F.row_number().over(w.orderBy(F.desc(F.round("npmi", 9)), "a"))).where("_r = 1")
    return top_k(j, ["a"], [F.desc(F.round("npmi", 9)), F.asc("b")], top).select(F.col("a").alias("term"), F.col("b").alias("synonym"), F.col("n").alias("support"), "pmi", "npmi", "direction", "rank")


def idf_table(docs: DataFrame, terms: Column) -> DataFrame:
    """(term, df, idf) over distinct terms per document."""
    n = F.broadcast(docs.agg(F.count("*").alias("n_docs")))  # one row
    df = docs.select(F.explode(F.array_distinct(terms)).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return df.join(n).select("term", "df", idf(F.col("n_docs"), F.col("df")).alias("idf"))


#: Pairs of a query and a document that a task scores, and queries that are broadcast at a time.
PAIRS, ASKED = 2_000_000, 50_000


def bm25(queries: DataFrame, docs: DataFrame, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(query_id, doc_id, score). queries: query_id, terms; docs: doc_id, terms. Query terms count once each.

    Queries with the same terms are scored once. Postings are dealt by document, so finely that a task has some PAIRS pairs, and the queries come to them in blocks: pairs, which
    grow with queries times documents, are never exchanged."""
    stats = F.broadcast(docs.agg(F.count("*").alias("n"), F.avg(F.size("terms")).alias("avgdl")))  # one row
    q = queries.select("query_id", F.explode(F.array_distinct("terms")).alias("t")).groupBy("query_id").agg(F.sort_array(F.collect_list("t")).alias("terms"))  # a query's words
    first = q.groupBy("terms").agg(F.min("query_id").alias("class"))
    names = _checkpoint(q.join(first, "terms").withColumn("block", F.xxhash64("terms")).select("query_id", "class", "terms", "block"))
    parts = _checkpoint(names.select("class", "terms", "block").distinct().select("class", "block", F.explode("terms").alias("t")))
    # Only words that a query has are counted.
    asked = docs.select("doc_id", F.size("terms").alias("len"), F.explode("terms").alias("t")).join(parts.select("t").distinct(), "t", "left_semi")
    tf = _checkpoint(asked.groupBy("doc_id", "len", "t").agg(F.count("*").alias("tf")))
    df = _checkpoint(tf.groupBy("t").agg(F.count("*").alias("df")))
    pairs = parts.groupBy("t").agg(F.count("*").alias("k")).join(df, "t").agg(F.sum(F.col("k") * F.col("df"))).first()[0] or 0
    w = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = w * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("len") / F.col("avgdl")))
    n = max(1, -(-names.count() // ASKED))
    of_doc = tf.join(df, "t").join(stats).select("doc_id", "t", part.alias("part")).repartition(max(2, -(-pairs // PAIRS // n)), "doc_id")
    out = None
    for i in range(n):
        here = F.pmod("block", F.lit(n)) == i
        own = of_doc.join(F.broadcast(parts.where(here).select("t", "class")), "t").groupBy("doc_id", "class").agg(F.sum("part").alias("score"))
        rows = own.join(F.broadcast(names.where(here).select("class", "query_id")), "class").select("query_id", "doc_id", "score")
        out = rows if out is None else out.unionByName(rows)
    return out


def match_all(queries: DataFrame, postings: DataFrame) -> DataFrame:
    """(query_id, doc_id) where the document has all distinct terms. queries: query_id, terms; postings: term, doc_id, distinct.

    Documents with the same terms are one class, and so are queries; classes meet by term, and documents and queries are joined to those that match."""
    d = postings.where("term is not null").groupBy("doc_id").agg(F.sort_array(F.collect_list("term")).alias("of_doc"))  # a document's terms
    q = queries.select("query_id", F.sort_array(F.array_distinct("terms")).alias("asked"))
    classes = q.select("asked").distinct().select("asked", F.size("asked").alias("n"), F.explode("asked").alias("term"))
    held = d.select("of_doc").distinct().select("of_doc", F.explode("of_doc").alias("term"))
    met = classes.join(held, "term").groupBy("asked", "n", "of_doc").agg(F.count("*").alias("k")).where("k = n").select("asked", "of_doc")
    return d.join(met, "of_doc").join(q, "asked").select("query_id", "doc_id")


def smoothed_ctr(log: DataFrame, clicks: float = 2.0, impressions: float = 40.0) -> DataFrame:
    g = log.groupBy("query_text", "category_id").agg(F.count_if("clicked").alias("clicks"), F.count("*").alias("impressions"))
    return g.withColumn("ctr", beta_smoothed(F.col("clicks"), F.col("impressions"), clicks, impressions))


def position_propensity(log: DataFrame, floor: float = 0.02) -> DataFrame:
    """(position, propensity, click_weight): click rates by position, smoothed over three positions, relative to the first; a click's weight is the inverse, 1..20."""
    curve = log.groupBy("position").agg(F.avg(F.col("clicked").cast("double")).alias("ctr"))
    w = Window.orderBy("position")  # one row a position
    smooth = curve.withColumn("smooth", F.avg("ctr").over(w.rowsBetween(-1, 1)))
    p = F.greatest(F.lit(floor), F.col("smooth") / F.first("smooth").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return smooth.withColumn("propensity", p).select("position", "propensity", clip(1 / F.col("propensity"), 1.0, 20.0).alias("click_weight"))


def zero_result_fallbacks(queries: DataFrame, products: DataFrame, protected: list[str] = ("king", "queen", "twin", "full"), matches: int = 4, drops: int = 3, votes: int = 3) -> DataFrame:
    """(query, strategy, relaxed, category). queries: query, terms; products: sku, terms, category.

    Each query's terms in the order in which they may go: unknown ones, then by rising idf, protected ones last. All its prefixes of
    dropped terms are tried at once, as rows; the first that matches enough products wins. Else the category with most votes of its terms; else global."""
    # Products with the same terms are one class, and a term's products count by category: no query meets single products.
    classes = products.groupBy(F.array_sort(F.array_distinct("terms")).alias("class")).agg(F.count("*").alias("size")).select("class", "size", F.explode("class").alias("term"))
    counts = products.select("category", F.explode(F.array_distinct("terms")).alias("term")).groupBy("term", "category").agg(F.count("*").alias("c"))
    known = idf_table(products, F.col("terms"))
    q = queries.select("query", F.array_distinct("terms").alias("terms")).distinct()
    t = q.select("query", F.posexplode("terms").alias("pos", "term")).join(known, "term", "left")
    order = Window.partitionBy("query").orderBy(F.col("idf").isNotNull(), F.col("term").isin(list(protected)), F.round("idf", 9), "pos")
    t = t.withColumn("gone", F.row_number().over(order)).withColumn("n", F.count("*").over(Window.partitionBy("query"))).withColumn("unknown", F.count_if(F.col("idf").isNull()).over(Window.partitionBy("query")))
    # Unknown terms go first and don't count as tries beyond the limit; one term stays.
    first = F.least(F.col("unknown"), F.col("n") - 1)
    last = F.greatest(first, F.least(F.col("n") - 1, F.lit(drops)))
    tries = t.withColumn("cut", F.explode(F.sequence(first.cast("int"), last.cast("int")))).where(F.col("gone") > F.col("cut"))
    hit = tries.join(classes, "term").groupBy("query", "cut", "n", "class", "size").agg(F.count("*").alias("k")).where(F.col("k") == F.col("n") - F.col("cut"))
    enough = hit.groupBy("query", "cut").agg(F.sum("size").alias("m")).where((F.col("m") >= matches) & (F.col("cut") > 0)).groupBy("query").agg(F.min("cut").alias("cut"))
    kept = t.join(enough, "query").where(F.col("gone") > F.col("cut")).groupBy("query").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "term"))), lambda x: x["term"]), " ").alias("relaxed"))
    vote = t.join(counts, "term").groupBy("query", "category").agg(F.sum("c").alias("v")).where(F.col("v") >= votes)
    top = best(vote, ["query"], [F.desc("v"), F.asc("category")]).select("query", "category")
    out = q.select("query").join(kept, "query", "left").join(top, "query", "left")
    strategy = F.when(F.col("relaxed").isNotNull(), "relaxed").when(F.col("category").isNotNull(), "category").otherwise("global")
    return out.select("query", strategy.alias("strategy"), "relaxed", F.when(F.col("relaxed").isNull(), F.col("category")).alias("category"))


def fallback_rows(queries: DataFrame, products: DataFrame, trending: DataFrame, k: int = 24, **options) -> DataFrame:
    """(query, strategy, payload): what a query without results shows, as a row of JSON (strategy, relaxed, category, products).

    Products that match the relaxed query come by their place among the k of highest trend, others after them by id; else the category's k of highest trend; else the k of all. A category
    without trend falls back on all. queries, products, options: as for ``zero_result_fallbacks``; trending: as for ``fallback_products``."""
    f = _checkpoint(zero_result_fallbacks(queries, products, **options))
    now = latest(trending, "snapshot_date")
    if now.isEmpty():
        raise ValueError("the trending snapshot is empty")
    order = [F.desc(F.round("score", 9)), F.asc("sku")]
    top = _checkpoint(now.orderBy(*order).limit(k).withColumn("place", F.row_number().over(Window.orderBy(*order))).select("sku", "place"))  # k rows
    # Different relaxed queries meet classes of products with the same terms; a class gives its first k.
    listed = products.select("sku", F.array_sort(F.array_distinct("terms")).alias("class")).join(F.broadcast(top), "sku", "left")
    few = top_k(listed, ["class"], [F.asc_nulls_last("place"), F.asc("sku")], k, "_r").drop("_r")
    relaxed = f.where("strategy = 'relaxed'").select(F.col("relaxed").alias("query_id"), F.split("relaxed", " ").alias("terms")).distinct()
    met = match_all(relaxed, listed.select(F.col("class").alias("doc_id")).distinct().select("doc_id", F.explode("doc_id").alias("term")))
    met = met.select(F.col("query_id").alias("relaxed"), F.col("doc_id").alias("class")).join(few, "class")
    own = top_k(met, ["relaxed"], [F.asc_nulls_last("place"), F.asc("sku")], k).select("relaxed", "sku", "rank")
    own = f.where("strategy = 'relaxed'").select("query", "relaxed").join(own, "relaxed").select("query", "sku", "rank")
    trend = top_k(now, ["category"], order, k).select("category", "sku", "rank")
    served = trend.select("category").distinct().withColumn("_known", F.lit(True))
    f = f.join(served, "category", "left").withColumn("strategy", F.when((F.col("strategy") == "category") & F.col("_known").isNull(), "global").otherwise(F.col("strategy"))).withColumn("category", F.when(F.col("strategy") == "category", F.col("category")))
    shown = own.unionByName(f.where("strategy = 'category'").select("query", "category").join(trend, "category").select("query", "sku", "rank"))
    lists = shown.groupBy("query").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "sku"))), lambda x: x["sku"]).alias("products"))  # k products
    everywhere = [r.sku for r in top.orderBy("place").collect()]  # k rows
    out = f.join(lists, "query", "left").withColumn("products", F.coalesce("products", F.array(*[F.lit(x) for x in everywhere])))
    return out.select("query", "strategy", F.to_json(F.struct("strategy", "relaxed", "category", "products"), {"ignoreNullFields": "false"}).alias("payload"))


def strategy_shares(fallbacks: DataFrame, searches: DataFrame) -> DataFrame:
    """(strategy, queries, searches, share): how much of the search volume each strategy serves. fallbacks: query, strategy; searches: query, n."""
    j = searches.join(fallbacks.select("query", "strategy"), "query", "left").withColumn("strategy", F.coalesce("strategy", F.lit("none")))
    g = j.groupBy("strategy").agg(F.count("*").alias("queries"), F.sum("n").alias("searches"))
    return g.join(F.broadcast(g.agg(F.sum("searches").alias("all")))).select("strategy", "queries", "searches", (F.col("searches") / F.col("all")).alias("share"))  # one row


def fallback_products(fallbacks: DataFrame, trending: DataFrame, k: int = 24) -> DataFrame:
    """(query, sku, rank): for queries that fall back on a category, its k products with the highest trend, else the k highest of all. trending:
    snapshot_date, category, sku, score, of which the latest snapshot counts; an empty one is refused."""
    now = latest(trending, "snapshot_date")
    if now.isEmpty():
        raise ValueError("the trending snapshot is empty")
    order = [F.desc(F.round("score", 9)), F.asc("sku")]
    by_category = top_k(now, ["category"], order, k).select("category", "sku", "rank")
    # k rows.
    overall = F.broadcast(now.orderBy(*order).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(*order))).select("sku", "rank"))
    own = fallbacks.where("strategy = 'category'").select("query", "category").join(by_category, "category").select("query", "sku", "rank")
    return own.unionByName(fallbacks.where("strategy = 'global'").select("query").join(overall).select("query", "sku", "rank"))
