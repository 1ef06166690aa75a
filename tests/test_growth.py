"""Steps whose work must not grow faster than their input."""

from __future__ import annotations

import datetime
import math
import random
import re

from pyspark.sql import functions as F

from brindle.operators import boosting, drift, experiments, graph, recs, search, vectors
from brindle.plans.catalogue import QUERIES
from brindle.sources import tables
from brindle.sources.tables import Tables


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_equal_vectors_meet_once(spark, monkeypatch):
    """Sixty items of three different vectors: the search sees three."""
    v = {0: {1: 0.6, 2: 0.8}, 1: {1: 0.8, 2: 0.6}, 2: {2: 1.0}}
    rows = [(i, s, x) for i in range(60) for s, x in v[i % 3].items()]
    seen, search = [], vectors.search_blocks
    monkeypatch.setattr(vectors, "search_blocks", lambda items, queries, *a, **o: (seen.append((items.count(), queries.count())), search(items, queries, *a, **o))[1])
    got = vectors.sparse_neighbours(spark.createDataFrame(rows, "id long, slot int, value double"), "id", 25).collect()
    assert seen == [(3, 3)]
    for i in range(60):
        score = {j: round(sum(x * v[j % 3].get(s, 0.0) for s, x in v[i % 3].items()), 9) for j in range(60) if j != i}
        want = sorted(score, key=lambda j: (-score[j], j))[:25]
        assert [r.other for r in sorted((r for r in got if r.id == i), key=lambda r: r.rank)] == want


def test_large_sides_of_a_join_are_not_broadcast(spark, tmp_path):
    """A million parts are a few MB as a file; as broadcast tables they went through the driver with hundreds."""
    k = F.col("id")
    p = spark.range(1_000_000).select(k.alias("p_partkey"), F.lit("old ring").alias("p_name"), F.lit("b").alias("p_brand"), F.lit("t").alias("p_type"), (k % 50).cast("int").alias("p_size"), (900 + k % 1000 / 10).cast("double").alias("p_retailprice"))
    p.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    df = QUERIES["reorder_policy"](spark, str(tmp_path))
    assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_small_values_in_a_message_have_no_zeros_left(spark):
    rows = [("alert", "m", f"f{i}", "psi", v) for i, v in enumerate([1.3e-7, 1e-10, 2.5e-5, 0.05, 10.0, -0.25, 0.0])]
    text = drift.message(spark.createDataFrame(rows, "severity string, model string, feature string, metric string, value double"), "d").first()[0]
    assert [line.split("psi=")[1] for line in text.split("\n")[1:]] == ["1.3e-07", "1e-10", "2.5e-05", "0.05", "10", "-0.25", "0"]
    assert drift.message(spark.createDataFrame([], "severity string, model string, feature string, metric string, value double"), "d").first()[0] is None


def test_adjusted_p_values_look_at_no_whole_family_a_row(spark):
    d = spark.range(4000).select(F.lit("e").alias("e"), F.col("id").alias("metric"), (F.col("id") * 7919 % 10007 / 10007).alias("p_value"))
    x = experiments.adjust_p(d, ["e"])
    assert "unboundedfollowing" not in plan(x)
    ps = sorted((r.p_value, r.metric) for r in d.collect())
    low, want = 1.0, {}
    for r in range(len(ps), 0, -1):
        low = min(low, ps[r - 1][0] * len(ps) / r)
        want[ps[r - 1][1]] = round(low, 12)
    assert {r.metric: round(r.p_adjusted, 12) for r in x.collect()} == want


def test_bursts_count_no_window_a_row(spark):
    rng = random.Random(5)
    rows = [(k, datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=rng.randrange(300))) for k in ("a", "b", None) for _ in range(60 if k != "b" else 6)]
    x = graph.bursts(spark.createDataFrame(rows, "k string, ts timestamp_ntz"), ["k"], "ts", 24, 4)
    assert "RangeFrame" not in plan(x)
    want, day = {}, datetime.timedelta(hours=24)
    for k in ("a", "b", None):
        own = sorted(t for q, t in rows if q == k)
        for t in own:
            inside = [u for u in own if t - day <= u <= t]
            if len(inside) >= 4:
                want[k] = (inside[0], t, len(inside))
                break
    assert {r.k: (r.start, r.end, r.n) for r in x.collect()} == want


def test_fallbacks_meet_no_single_products(spark):
    k = F.col("id")
    products = spark.range(20).select(k.alias("sku"), F.array(F.lit("red"), F.concat(F.lit("w"), (k % 2).cast("string"))).alias("terms"), F.lit("c").alias("category"))
    asked = spark.range(2).select(F.concat(F.lit("red zzz q"), k.cast("string")).alias("query")).select("query", F.split("query", " ").alias("terms"))
    x = search.zero_result_fallbacks(asked, products)
    assert "sku#" not in plan(x)
    assert sorted((r.query, r.strategy, r.relaxed) for r in x.collect()) == [("red zzz q0", "relaxed", "red"), ("red zzz q1", "relaxed", "red")]


def test_equal_products_and_listings_meet_once(spark, monkeypatch):
    """Thirty products and thirty listings of two titles and prices, one without a price: four pairs are scored, and each listing has what all pairs give."""
    price = [10.0, None]
    p = spark.createDataFrame([(i, f"oak chair {'xy'[i % 2]}", "b", "c", price[i % 2]) for i in range(30)], "sku long, title string, brand string, category string, price double")
    c = spark.createDataFrame([(100 + i, f"shop{i % 4}", f"oak chair {'xy'[i % 2]}", "b", "c", price[i % 2]) for i in range(30)], "listing_id long, competitor string, title string, brand string, category string, price double")
    seen, top = [], recs.top_k
    monkeypatch.setattr(recs, "top_k", lambda df, *a: (seen.append(df.count()), top(df, *a))[1])
    got = {(r.sku, r.competitor): (r.listing_id, round(r.score, 6)) for r in recs.match_listings(p, c, 0.6).collect()}
    assert seen[0] == 4
    assert got == {(0, "shop0"): (100, 1.0 - 0.075), (0, "shop2"): (102, 1.0 - 0.075), (1, "shop1"): (101, 0.775), (1, "shop3"): (103, 0.775)}


def test_copies_of_a_listing_give_a_row_each(spark):
    rows = [(i, "oak chair", "b", 10.0) for i in range(40)] + [(50 + i, "oak chair", "b", 10.1) for i in range(3)] + [(60, "oak chair", "b", None), (61, "oak chair", "b", None), (70, "oak chair", None, 10.0)]
    df = spark.createDataFrame(rows, "sku long, title string, brand string, price double")
    got = {(r.a, r.b): round(r.score, 6) for r in recs.duplicate_listings(df, 0.9, expand=False).collect()}
    assert got == {(0, i): 1.0 for i in range(1, 40)} | {(50, 51): 1.0, (50, 52): 1.0, (0, 50): round(0.8 + 0.2 * 10.0 / 10.1, 6)} | {(i, j): 1.0 for i in (0, 50) for j in (60, 61)}
    assert recs.duplicate_listings(df, 0.9).count() == 43 * 42 // 2 + 43 * 2


def test_bm25_exchanges_no_pairs(spark, monkeypatch):
    """Pairs of queries and documents stay where the document is; queries of the same words, in blocks, give what scoring each alone gives."""
    monkeypatch.setattr(search, "ASKED", 2, raising=False)
    rng = random.Random(5)
    docs = {i: [rng.choice("abcdefg") for _ in range(rng.randint(0, 9))] for i in range(60)}
    asked = {100: ["a", "b"], 101: ["b", "a", "a"], 102: ["c"], 103: ["a", "z"], 104: ["z"], 105: [], 106: ["g", "f", "e"]}
    q = spark.createDataFrame(list(asked.items()), "query_id long, terms array<string>")
    out = search.bm25(q, spark.createDataFrame(list(docs.items()), "doc_id long, terms array<string>"))
    exchanges = [line for line in out._jdf.queryExecution().executedPlan().toString().split("\n") if "hashpartitioning" in line]
    assert not [line for line in exchanges if "query_id" in line or "class" in line]
    n, mean = len(docs), sum(map(len, docs.values())) / len(docs)
    want = {}
    for name, terms in asked.items():
        for d, words in docs.items():
            for t in set(terms) & set(words):
                df, tf = sum(t in x for x in docs.values()), words.count(t)
                want[name, d] = want.get((name, d), 0.0) + math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / mean))
    assert {(r.query_id, r.doc_id): round(r.score, 9) for r in out.collect()} == {k: round(v, 9) for k, v in want.items()}


def test_items_are_sent_once_for_many_blocks_of_queries(spark):
    """Twenty blocks of queries share one copy of the items, and find what each query alone finds."""
    rng = random.Random(3)
    v = {i: {s: rng.randint(1, 9) / 7 for s in rng.sample(range(12), 4)} for i in range(80)}
    df = spark.createDataFrame([(i, s, x) for i, r in v.items() for s, x in r.items()], "id long, slot int, value double")
    lists = df.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("slot", "value"))).alias("x")).select("id", F.col("x.slot").cast("array<long>").alias("slots"), F.col("x.value").alias("values"))
    parts = vectors.search_blocks(lists, lists, 3, vectors.Postings, lambda q, y: q.products(y), 4)
    copies = re.findall(r"sequence\(cast\(0 as bigint\), cast\((\d+) as bigint\)", parts._jdf.queryExecution().analyzed().toString())
    assert copies == ["0", "0"]
    got = {}
    for r in parts.collect():
        got.setdefault(r.query, []).append((-round(r.score, 9), r.other))
    for i in v:
        score = {j: sum(x * v[j][s] for s, x in v[i].items() if s in v[j]) for j in v if j != i and set(v[i]) & set(v[j])}
        assert [j for _, j in sorted(got[i])] == sorted(score, key=lambda j: (-round(score[j], 9), j))[:3]


def test_documents_of_the_same_terms_meet_a_query_once(spark):
    """Two hundred documents of two kinds: rows that meet by term are those of kinds."""
    docs = {i: ["old", "ring"] if i % 2 else ["old", "bolt", "x"] for i in range(200)}
    post = spark.createDataFrame([(i, t) for i, ts in docs.items() for t in ts] + [(900, None)], "doc_id long, term string")
    asked = {"a": ["old", "ring"], "b": ["ring", "old", "ring"], "c": ["old"], "d": ["x", "nothing"], "e": []}
    out = search.match_all(spark.createDataFrame(list(asked.items()), "query_id string, terms array<string>"), post)
    assert re.search(r"Aggregate \[asked.*, n.*, of_doc.*\]", plan(out))
    assert sorted(tuple(r) for r in out.collect()) == sorted((q, i) for q, ts in asked.items() for i, own in docs.items() if ts and set(ts) <= set(own))


def test_rounds_on_lists_exchange_nothing(spark, monkeypatch):
    """the pairs of a list were made from windows over all rows in each round. Lists go on from batch to batch here, and blocks are small."""
    monkeypatch.setattr(boosting, "BLOCK_PAIRS", 150)
    rng = random.Random(5)
    rows = [(q, q * 100 + i, float(rng.randrange(3)), rng.randrange(8) / 4, 1.0 + rng.random()) for q in range(30) for i in range(q)]
    rows.append((30, 3000, None, 0.5, 1.0))
    rows.append((30, 3001, 1.0, 0.5, 1.0))
    df = graph._checkpoint(boosting.dealt(spark.createDataFrame(rows, "q long, id long, clicked double, f0 double, w double"), "q", "id"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = boosting.lists("q", "clicked", "id", "w", top=6, deal=False)(df)
        assert "Window" not in plan(out) and "Repartition" not in plan(out)
        got = {r.id: (r.g, r.h) for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(rows) and got[3000] == got[3001] == (0.0, 0.0)
    for q in range(30):
        one = [r for r in rows if r[0] == q]
        rank = {r[1]: i + 1 for i, r in enumerate(sorted(one, key=lambda r: (-r[3], r[1])))}
        cut = lambda r: 1 / math.log2(r + 1) if r <= 6 else 0.0
        best = sum((2 ** y - 1) * cut(i + 1) for i, y in enumerate(sorted((r[2] for r in one), reverse=True)))
        g, h = dict.fromkeys(rank, 0.0), dict.fromkeys(rank, 0.0)
        for a in one:
            for b in one:
                if a[2] > b[2] and min(rank[a[1]], rank[b[1]]) <= 6:
                    rho = 1 / (1 + math.exp(a[3] - b[3]))
                    size = (2 ** a[2] - 2 ** b[2]) * abs(cut(rank[a[1]]) - cut(rank[b[1]])) / best * a[4]
                    for k, sign in ((a[1], -1), (b[1], 1)):
                        g[k] += sign * rho * size
                        h[k] += rho * (1 - rho) * size
        assert all(math.isclose(got[k][0], g[k], abs_tol=1e-12) and math.isclose(got[k][1], h[k], abs_tol=1e-12) for k in rank)


def test_products_of_the_same_text_are_weighed_once(spark, monkeypatch):
    """sixty products of three texts give terms three times, and the neighbours are those of sixty vectors. Scans of a few MB are not broadcast."""
    titles = ["oak chair red", "oak table red", "ash table blue"]
    p = spark.createDataFrame([(i, titles[i % 3], f"<p>made of {'oak' if i % 3 < 2 else 'ash'}</p> {i % 5} tc", i % 7 != 0, True) for i in range(60)], "sku long, title string, description string, is_active boolean, in_stock boolean")
    lines = spark.createDataFrame([(100 + i, i, datetime.datetime(2001, 7, 20)) for i in range(0, 60, 11)], "customer_id long, sku long, order_ts timestamp_ntz")
    seen, weigh = [], vectors.tfidf
    monkeypatch.setattr(recs, "tfidf", lambda docs, *a, **o: (seen.append(docs.count()), weigh(docs, *a, **o))[1])
    got = sorted((r.customer_id, r.sku, r.rank, round(r.similarity, 9)) for r in recs.mail_recommendations(p, lines, "2001-08-01", ["of"], k=4).collect())
    assert seen == [3]
    w = weigh(p.select("sku", recs.word_pairs(recs.mail_text(F.col("title"), F.col("description")), ["of"]).alias("t")), "sku", F.col("t"))
    v = {}
    for r in w.collect():
        v.setdefault(r.sku, {})[r.term] = r.weight
    want = []
    for i in range(0, 60, 11):
        score = {j: round(sum(x * v[j].get(t, 0.0) for t, x in v[i].items()), 9) for j in v if j != i and j % 7 and set(v[i]) & set(v[j])}
        want += [(100 + i, j, n + 1, score[j]) for n, j in enumerate(sorted((j for j in score if score[j] >= 0.08), key=lambda j: (-score[j], j))[:4])]
    assert got == sorted(want) and len(got) == 24
    Tables(spark, "/nowhere")
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "1MB"


def test_shingles_are_dealt_once_and_lonely_ones_are_not_sent_on(spark, monkeypatch):
    """all shingles were exchanged three times. Each text has a word of its own in the middle; ranks are those among all its shingles."""
    seen, meet = [], graph._meet
    monkeypatch.setattr(graph, "_meet", lambda d, *a, **o: (seen.append(d), meet(d, *a, **o))[1])
    texts = {i: " ".join(f"w{j}" if j != 10 + i % 3 else f"own{i}" for j in range(24)) for i in range(9)} | {20: " ".join(f"w{j}" if j != 10 else "own0" for j in range(24))}
    df = spark.createDataFrame(list(texts.items()), "id int, t string")
    got = {(r.a, r.b): r.jaccard for r in graph.exact_jaccard(df, "id", "t", 0.6, expand=False).collect()}
    sets = {k: {tuple(t.split()[i : i + 3]) for i in range(22)} for k, t in texts.items() if k < 20}
    want = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b}
    assert got == {p: j for p, j in want.items() if j >= 0.6} | {(0, 20): 1.0}
    assert {r.r for r in seen[0].collect()} == set(range(4, 10))
    final = seen[0]._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len([line for line in final.split("\n") if "Exchange hashpartitioning(s#" in line and "ReusedExchange" not in line]) == 1
    asked = QUERIES["near_duplicate_docs"](spark, "/root/testdata/sf0.001")
    assert "labels.parquet" not in "".join(asked.inputFiles())


def test_partitions_grow_with_lines(spark, monkeypatch):
    """the first exchanges of lines had as many parts as the session says, however many the lines are. The rows are the same in more parts."""
    initial, sf = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "/root/testdata/sf0.01"
    want = sorted(map(tuple, QUERIES["basket_rules"](spark, sf).collect()))
    assert spark.conf.get(initial, None) is None
    monkeypatch.setattr(tables, "LINES_A_TASK", 5000)
    try:
        assert sorted(map(tuple, QUERIES["basket_rules"](spark, sf).collect())) == want and len(want) == 48
        assert spark.conf.get(initial) == str(-(-spark.read.parquet(f"{sf}/lineitem.parquet").count() // 5000))
    finally:
        spark.conf.unset(initial)
