"""Boosted trees with own gradients, demand bands, and the two-level text classifier: against plain numpy, planted orders and simulated demand."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.operators import boosting, classify, models
from brindle.sources.tables import reachable


@pytest.fixture(scope="module")
def noisy(spark):
    reachable(spark)
    rng = np.random.default_rng(3)
    n = 600
    x = np.round(rng.normal(size=(n, 2)), 2)
    y = np.where(x[:, 0] > 0.3, 3.0, 0.0) + x[:, 1] + rng.normal(size=n)
    x[::11, 1] = np.nan
    rows = [(i, float(a), None if math.isnan(b) else float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y, strict=True))]
    return x, y, spark.createDataFrame(rows, "id long, a double, b double, y double").repartition(3)


def plain_tree(bins, g, h, depth, reg, least, wide):
    """Splits and leaf values of one tree, by plain loops."""
    split, value = {}, {}

    def node(n, at, left):
        value[n] = -g[at].sum() / (h[at].sum() + reg)
        if not left:
            return
        best = (1e-9, None)
        whole = g[at].sum() ** 2 / (h[at].sum() + reg)
        for f in range(bins.shape[1]):
            for b in range(wide - 1):
                lo = at[bins[at, f] <= b]
                hi = at[bins[at, f] > b]
                if min(len(lo), len(hi)) >= least:
                    gain = sum(g[p].sum() ** 2 / (h[p].sum() + reg) for p in (lo, hi)) - whole
                    if round(gain, 9) > round(best[0], 9):
                        best = (gain, (f, b, lo, hi))
        if best[1] is not None:
            f, b, lo, hi = best[1]
            split[n] = (f, b)
            del value[n]
            node(2 * n, lo, left - 1)
            node(2 * n + 1, hi, left - 1)

    node(1, np.arange(len(g)), depth)
    return split, value


def test_trees_equal_plain_ones(noisy):
    x, y, df = noisy
    m = boosting.fit(df, ["a", "b"], "y", [boosting.squared(), boosting.pinball(0.8)], rounds=3, depth=3, rate=0.5, bins=8, min_rows=15)
    bins = m.bin(x)
    assert (bins[np.isnan(x[:, 1]), 1] == 0).all() and bins[~np.isnan(x)[:, 1], 1].min() == 1
    f, q = np.full(len(y), y.mean()), np.full(len(y), np.sort(y)[math.ceil(0.8 * len(y)) - 1])
    assert m.start == pytest.approx([f[0], q[0]])
    for tree, qtree in zip(*m.trees, strict=True):
        split, value = plain_tree(bins, f - y, np.ones(len(y)), 3, 1.0, 15, 9)
        assert tree.split == split and tree.value == pytest.approx(value)
        f = f + 0.5 * tree.scores(bins)
        qsplit, _ = plain_tree(bins, np.where(y < q, 1.0, 0.0) - 0.8, np.ones(len(y)), 3, 1.0, 15, 9)
        assert qtree.split == qsplit
        leaf = boosting.Tree(qsplit, {n: n for n in range(1, 16)}).scores(bins)
        for n in np.unique(leaf):
            rest = np.sort((y - q)[leaf == n])
            assert qtree.value[int(n)] == pytest.approx(rest[math.ceil(0.8 * len(rest)) - 1])
        q = q + 0.5 * qtree.scores(bins)
    got = {r.id: (r.p, r.q) for r in m.predict(df, ["p", "q"]).collect()}
    assert [got[i] for i in range(len(y))] == [pytest.approx(v) for v in zip(f, q, strict=True)]
    again = boosting.Boosted.from_json(m.to_json())
    assert np.allclose(again.raw(x), m.raw(x)) and again.columns == ["a", "b"] and sum(m.gains().values()) == sum(len(t.split) for ts in m.trees for t in ts)


def test_pair_gradients_by_hand(spark):
    rows = [(0, 0, 1.0, 0.2, 1.0), (0, 1, 0.0, 0.5, 1.0), (0, 2, 1.0, 0.1, 4.0), (0, 3, 0.0, 0.3, 1.0), (1, 4, 0.0, 1.0, 1.0), (1, 5, 0.0, 0.0, 1.0)]
    df = spark.createDataFrame(rows, "q long, id long, clicked double, f0 double, w double")
    got = {r.id: (r.g, r.h) for r in boosting.lists("q", "clicked", "id", "w", top=3)(df).collect()}
    one = [r for r in rows if r[0] == 0]
    rank = {r[1]: i + 1 for i, r in enumerate(sorted(one, key=lambda r: (-r[3], r[1])))}
    cut = lambda r: 1 / math.log2(r + 1) if r <= 3 else 0.0
    best = sum(cut(i + 1) for i in range(2))
    g, h = Counter(), Counter()
    for a in one:
        for b in one:
            if a[2] > b[2]:
                rho = 1 / (1 + math.exp(a[3] - b[3]))
                size = abs(cut(rank[a[1]]) - cut(rank[b[1]])) / best * a[4]
                g[a[1]] -= rho * size
                g[b[1]] += rho * size
                h[a[1]] += rho * (1 - rho) * size
                h[b[1]] += rho * (1 - rho) * size
    assert got == {i: (pytest.approx(g[i]), pytest.approx(h[i])) for i in range(6)}


@pytest.fixture(scope="module")
def clicks(spark):
    """Between lists, feature a goes with more clicks; inside a list, with fewer. What is relevant is u."""
    reachable(spark)
    rng = np.random.default_rng(0)
    rows = []
    for q in range(240):
        level = rng.random()
        for i in range(12):
            u = rng.random()
            seen = rng.random() < 1 / math.sqrt(1 + i)
            hit = rng.random() < 1 / (1 + math.exp(-(6 * (level - 0.5) + 3 * (u - 0.5))))
            rows.append((q * 12 + i, q, i + 1, level - 0.3 * u + 0.02 * rng.normal(), 0.3 * u + 0.7 * level + 0.1 * rng.normal(), int(hit and seen), u, q % 30))
    d = spark.createDataFrame([(int(a), int(b), int(c), float(x), float(y), int(k), float(u), int(z)) for a, b, c, x, y, k, u, z in rows], "sku long, query_id long, position int, a double, b double, clicked int, u double, day int")
    return d.withColumn("event_date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("day")))


def test_lists_are_ranked_better_than_by_single_rows(clicks):
    config = SimpleNamespace(max_position=48, min_impressions=5, holdout_days=7, leaves=8, rounds=15, learning_rate=0.15, min_leaf=20, patience=6, truncation=20)
    model, figures = boosting.train_ranker(clicks, ["a", "b"], config)
    assert 1 <= figures["best_iteration"] == len(model.trees[0]) <= 15 and 0 < figures["ndcg_at_10"] < 1 and figures["splits"]["a"] > 0
    held, train = clicks.where("day >= 23"), clicks.where("day < 23")
    lists = models.ndcg(model.predict(held, ["score"]), "query_id", "score", "u", "sku").first()[0]
    single = models.ranker(train.withColumn("w", F.lit(1.0)), held, ["a", "b"], "clicked", "w")
    assert lists > models.ndcg(single, "query_id", "rank_score", "u", "sku").first()[0] + 0.02


def test_lists_end_at_the_last_position(clicks):
    d = boosting.impressions(clicks, "query_id", "position", 4, 4)
    assert d.groupBy("query_id").count().agg(F.max("count"), F.min("count")).first() == (4, 4)
    w = boosting.click_weights(clicks, clicks.sparkSession.createDataFrame([(1, 1.0), (2, 0.5), (3, 0.01)], "position int, propensity double"))
    assert {(r.position, r.clicked): r.weight for r in w.collect()}.items() >= {(1, 1): 1.0, (2, 1): 2.0, (3, 1): 20.0, (9, 1): 20.0, (9, 0): 1.0}.items()


def test_demand_band_covers_what_it_says(spark):
    reachable(spark)
    rng = np.random.default_rng(8)

    def panel(n):
        level, season = rng.gamma(2, 10, n), rng.random(n)
        y = rng.poisson(rng.gamma(4, level * (0.5 + season) / 4))
        return spark.createDataFrame([(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(level, season, y, strict=True))], "id long, level double, season double, units double").repartition(4)

    m = models.demand_band(panel(6000), ["level", "season"], rounds=25, depth=4, rate=0.2)
    out = models.band(m, panel(5000)).cache()
    r = out.agg(F.avg(F.col("units").between(F.col("p10"), F.col("p90")).cast("double")).alias("cover"), F.min(F.col("p50") - F.col("p10")).alias("a"), F.min(F.col("p90") - F.col("p50")).alias("b"), F.avg("point").alias("point"), F.avg("units").alias("units")).first()
    # Counts have ties at the quantiles, which lie inside.
    assert abs(r.cover - 0.8) < 0.035 and r.a >= 0 and r.b >= 0 and r.point == pytest.approx(r.units, rel=0.05)


def test_quantiles_of_smooth_demand(spark):
    reachable(spark)
    rng = np.random.default_rng(9)
    make = lambda n: spark.createDataFrame([(float(a), float(a * np.exp(s * (0.2 + 0.4 * (a > 50))))) for a, s in zip(rng.random(n) * 100, rng.normal(size=n), strict=True)], "level double, units double")
    out = models.band(models.demand_band(make(8000), ["level"], rounds=20, depth=3, rate=0.3), make(6000))
    r = out.agg(F.avg(F.col("units").between(F.col("p10"), F.col("p90")).cast("double")).alias("c"), F.avg((F.col("units") < F.col("p50")).cast("double")).alias("m")).first()
    assert abs(r.c - 0.8) < 0.02 and abs(r.m - 0.5) < 0.02


# ---- texts


def plain_border_grams(text: str) -> list[str]:
    out = []
    for w in text.split():
        w = f" {w} "
        for n in (3, 4, 5):
            out += [w[i : i + n] for i in range(max(1, len(w) - n + 1))]
            if len(w) <= n:
                break
    return out


def test_grams(spark):
    texts = ["ab cde  fghij", "", "x", "über straße", "a\tb\nc d'e", "one"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    for r in df.select("t", classify.word_grams(F.col("t")).alias("w"), classify.border_grams(F.col("t")).alias("c")).collect():
        words = re.findall(r"\b\w\w+\b", r.t)
        assert [x for x in r.w if x] == words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
        assert Counter(r.c) == Counter(plain_border_grams(r.t))


def test_vectors_equal_plain_ones(spark):
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice(["red", "blue", "green", "cat", "dog", "sofa"]) for _ in range(rnd.randint(1, 9))) for _ in range(40)]
    tf = classify.counts(spark.createDataFrame(list(enumerate(texts)), "id int, t string"), "id", "t").cache()
    vocab = classify.vocabulary(tf, 40, words=9)
    names = {r["at"]: (r.kind, r.term, r.idf) for r in vocab.collect()}
    assert sum(k == 0 for k, _, _ in names.values()) == 9 and sorted(names) == list(range(len(names)))
    bags = [Counter((1, g) for g in plain_border_grams(t)) + Counter((0, g) for w in [t.split()] for g in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]) for t in texts]
    df = Counter(g for b in bags for g in b)
    assert all(idf == pytest.approx(math.log(41 / (1 + df[k, g])) + 1) for k, g, idf in names.values())
    for r in classify.vectorise(tf, vocab, len(names)).collect():
        want = {i: (1 + math.log(bags[r.key][k, g])) * idf for i, (k, g, idf) in names.items() if (k, g) in bags[r.key]}
        size = {kind: math.sqrt(sum(v * v for i, v in want.items() if names[i][0] == kind)) for kind in (0, 1)}
        assert dict(zip(r.features.indices.tolist(), r.features.values.tolist(), strict=True)) == {i: pytest.approx(v / size[names[i][0]]) for i, v in want.items()}


def test_grams_are_counted_where_texts_are(spark, monkeypatch):
    """a row of each text and gram was exchanged and written. Small bounds make tasks send sums on and forget words."""
    monkeypatch.setattr(classify, "HELD", 20)
    monkeypatch.setattr(classify, "REMEMBERED", 3)
    monkeypatch.setattr(classify, "TEXTS", 4)
    reachable(spark)
    rnd = random.Random(6)
    texts = [" ".join(rnd.choice(["red", "blu\u00e9", "a", "\U0001f600x", "sofa-bed", "the", "of\u00a0it"]) for _ in range(rnd.randint(1, 9))) for _ in range(40)] + ["", None, "?", "zq"]
    d = spark.createDataFrame([(i, t, f"l{i % 3}") for i, t in enumerate(texts)], "id int, t string, l string")
    tf = classify.counts(d, "id", "t").cache()
    stats = classify.gram_statistics(d, "id", "t")
    assert "Generate" not in stats._jdf.queryExecution().optimizedPlan().toString()
    rows = lambda df: sorted(map(tuple, df.select("kind", "term", "df", "n").collect()))
    assert rows(stats) == rows(tf.groupBy("kind", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("n")))
    vocab = classify.vocabulary(tf, len(texts), 9, 60)
    assert sorted(map(tuple, classify.most_frequent(stats, len(texts), 9, 60).collect())) == sorted(map(tuple, vocab.collect()))
    size = vocab.count()
    want = {r.key: r.features for r in classify.vectorise(tf, vocab, size).collect()}
    got = {r.id: r for r in classify.with_features(d, "id", "t", vocab, size).collect()}
    assert len(got) == len(texts) and all(got[i].l == f"l{i % 3}" for i in got)
    for i, r in got.items():
        v = want.get(i)
        assert r.features.size == size and (r.features.indices.tolist() == (v.indices.tolist() if v else []))
        assert v is None or r.features.values.tolist() == pytest.approx(v.values.tolist())
    assert {r.id for r in classify.with_features(d, "id", "t", vocab, size, empty=False).collect()} == set(want)


def test_paths_are_found(spark):
    rnd = random.Random(1)
    kinds = {("bed", "sheet"): "flat fitted percale", ("bed", "duvet"): "down quilt warm", ("bath", "towel"): "terry hand dry", ("bath", "mat"): "floor slip round", ("rug", "rug"): "wool woven floor"}
    filler = "soft new great home colour large".split()
    rows = [(i, a, b, " ".join(rnd.choice(words.split() if rnd.random() < 0.4 else filler) for _ in range(12)) + f" {a}") for i in range(400) for (a, b), words in [rnd.choice(list(kinds.items()))]]
    d = spark.createDataFrame(rows, "sku long, l1 string, l2 string, text string")
    m = classify.fit_paths(d.where("sku % 4 != 0"), "sku", "text", "l1", "l2", words=60, chars=200)
    assert m.size <= 260 and set(m.children) == {"bed", "bath", "rug"} and m.children["rug"].model is None
    out = m.predict(d.where("sku % 4 = 0"), "sku", "text").join(d.select("sku", F.col("l1").alias("r1"), F.col("l2").alias("r2")), "sku").cache()
    assert out.count() == 100
    assert models.macro_f1(out, "r1", "l1").first()[0] > 0.97 and models.macro_f1(out.where("l2 is not null"), "r2", "l2").first()[0] > 0.9


def test_draws_follow_their_distribution(spark):
    reachable(spark)
    from brindle.operators import marketing

    rows = spark.range(40_000).select(F.col("id").alias("customer_id"), (F.col("id") % 4).cast("int").alias("bucket"))
    shape = F.element_at(F.array(*[F.lit(v) for v in (0.3, 1.0, 2.5, 40.0)]), F.col("bucket") + 1)
    post = rows.withColumn("a", shape).withColumn("b", F.lit(3.0))
    out = marketing.thompson(post)
    for r in out.groupBy("a").agg(F.avg("draw").alias("m"), F.var_pop("draw").alias("v"), F.min("draw").alias("lo"), F.max("draw").alias("hi")).collect():
        mean = r.a / (r.a + 3)
        var = r.a * 3 / ((r.a + 3) ** 2 * (r.a + 4))
        assert r.m == pytest.approx(mean, abs=4 * math.sqrt(var / 10_000)) and r.v == pytest.approx(var, rel=0.08) and 0 <= r.lo < r.hi <= 1
    pick = lambda df: {r.customer_id: r.draw for r in df.where("customer_id < 50").collect()}
    assert pick(out) == pick(marketing.thompson(post.repartition(7))) != pick(marketing.thompson(post, 1))


def test_token_sets_align_as_plainly(spark):
    reachable(spark)
    from difflib import SequenceMatcher

    from brindle.functions.text import token_set_ratio

    rnd = random.Random(3)
    pairs = [tuple(" ".join(rnd.choice(["linen", "sheet", "king", "set", "oat", "duvet"]) for _ in range(rnd.randint(0, 6))) for _ in range(2)) for _ in range(200)] + [("", ""), (None, "a")]

    def plain(x, y):
        if x is None or y is None:
            return 0.0
        p, q = set(x.split()), set(y.split())
        texts = [" ".join(sorted(p & q)), *[" ".join([*sorted(p & q), *sorted(o)]) for o in (p - q, q - p)]]
        return max(SequenceMatcher(None, texts[i], texts[j]).ratio() for i, j in ((0, 1), (0, 2), (1, 2)))

    got = [r[0] for r in spark.createDataFrame(pairs, "a string, b string").select(token_set_ratio("a", "b")).collect()]
    assert got == [pytest.approx(plain(x, y)) for x, y in pairs]


def test_no_group_is_ranked_in_one_window(spark, sf_dir):
    """Bands and budgets come from ranges: no window orders a whole category or table."""
    from brindle.operators import ranking, supply
    from brindle.sources.tables import Tables

    p = ranking.price_bands(Tables(spark, sf_dir).products)
    b = supply.within_budget(spark.range(100).select(F.col("id").alias("sku"), F.lit(1).alias("warehouse_id"), (F.col("id") % 3 / 10).alias("margin"), F.lit(1.0).alias("cost")), 37.0)
    assert b.count() == 37 and {r.margin for r in b.collect()} == {0.2, 0.1}
    for df, order in ((p, "price"), (b, "margin")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "collect_set" not in plan
        windows = [line for line in plan.splitlines() if "Window [" in line and order in line.split("windowspecdefinition")[-1]]
        assert windows and all("_p#" in line for line in windows)


@pytest.mark.parametrize("part", [20_000, 50])
def test_vector_index_recall(spark, part, monkeypatch):
    """Nine of ten exact neighbours at least, all vectors indexed, cells in parts or whole."""
    reachable(spark)
    from brindle.operators import ann, vectors

    monkeypatch.setattr(ann, "PART_ROWS", part)
    monkeypatch.setattr(ann, "QUERY_ROWS", part)
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    coder = ann.fit(e, "vec_id", "embedding", cells=40, fit_rows=1200)
    index = ann.index(e, "vec_id", "embedding", coder)
    assert index.count() == e.count() and index.groupBy("cell", "part").count().agg(F.max("count")).first()[0] <= 2 * part and coder.probe < 40
    q = e.where("vec_id % 20 = 0")
    found, exact = (_ck(x) for x in (ann.search(index, coder, q, 10, "vec_id", "embedding"), vectors.neighbours(e, q, 10)))
    assert found.groupBy("query").count().agg(F.min("count"), F.count("*")).first() == (10, q.count())
    assert ann.recall(found, exact) >= 0.9
    # What is found has its exact score.
    assert found.join(exact.withColumnRenamed("score", "s"), ["query", "other"]).where(F.abs(F.col("score") - F.col("s")) > 1e-5).count() == 0


def _ck(df):
    from brindle.operators.graph import _checkpoint

    return _checkpoint(df)


@pytest.mark.parametrize("shard", [40, 10_000])
def test_skipping_finds_what_full_scores_find(spark, shard, monkeypatch):
    reachable(spark)
    from brindle.operators import retrieval, search

    monkeypatch.setattr(retrieval, "BLOCK", 4)
    monkeypatch.setattr(retrieval, "QUERY_ROWS", 7)
    rnd = random.Random(6)
    word = lambda: f"w{min(60, int(rnd.expovariate(0.1)))}"
    docs = spark.createDataFrame([(i, [word() for _ in range(rnd.randint(0, 40))]) for i in range(400)], "doc_id long, terms array<string>")
    queries = spark.createDataFrame([(i, [word() for _ in range(rnd.randint(1, 6))]) for i in range(30)] + [(98, ["none"]), (99, [])], "query_id long, terms array<string>")
    got = retrieval.search(retrieval.index(docs, shard_docs=shard), queries, 5).collect()
    want = {}
    for r in search.bm25(queries, docs).collect():
        want.setdefault(r.query_id, []).append((-round(r.score, 9), r.doc_id))
    assert {(r.query_id, r["rank"]): (-round(r.score, 9), r.doc_id) for r in got} == {(q, i): (pytest.approx(s), d) for q, v in want.items() for i, (s, d) in enumerate(sorted(v)[:5], 1)}
    assert all(0 < r.read <= r.postings for r in got)


def test_a_frequent_word_is_looked_up_only():
    """A rare word's few documents decide; of the frequent word's list only blocks that hold them are read."""
    from brindle.operators import retrieval

    rng = np.random.default_rng(2)
    rare = (np.sort(rng.choice(100_000, 200, replace=False)), 5 + rng.random(200), np.full(2, 255.0), 6.0)
    common = (np.arange(100_000), 0.5 * rng.random(100_000), np.full(-(-100_000 // retrieval.BLOCK), 255.0), 0.5)
    f = retrieval.run_query([common, rare], 10)
    full = np.zeros(100_000)
    full[rare[0]] += rare[1]
    full += common[1]
    want = np.lexsort((np.arange(100_000), -full))[:10]
    assert f.docs[np.lexsort((f.docs, -f.scores))[:10]].tolist() == want.tolist() and np.allclose(np.sort(f.scores)[::-1][:10], full[want]) and f.read < 30_000


def test_trade_offs_by_hand(spark):
    reachable(spark)
    from brindle.operators import ranking

    rows = spark.createDataFrame([("q", 1, 1.0, "a"), ("q", 2, 0.9, "a"), ("q", 3, 0.5, "b"), ("r", 4, 1.0, "c"), ("r", 5, 0.0, "c")], "query string, sku long, rel double, brand string")
    clicks = spark.createDataFrame([("q", 3)], "query string, sku long")
    got = {r.lam: r for r in ranking.trade_offs(rows, "query", "sku", "rel", {"brand": 1.0}, (1.0, 0.3), clicks, k=2).collect()}
    assert (got[1.0].relevance_loss, got[1.0].moved, got[1.0].precision_at_k) == (0.0, 0.0, 0.0)
    # With more weight on differences item 3 takes the place of item 2.
    r = got[0.3]
    assert r.relevance_loss == pytest.approx((0.2 + 0.0) / 2) and r.moved == pytest.approx(0.25) and r.precision_at_k == 0.5 and r.diversity == 0.5 and r.brand_distinct == 0.75


@pytest.mark.parametrize("block", [3, 1000])
def test_many_queries_meet_items_in_groups(spark, block, monkeypatch):
    reachable(spark)
    from brindle.operators import vectors

    monkeypatch.setattr(vectors, "SHARD_ITEMS", 17)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 6))
    d = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -9)
    got = {(r.query, r["rank"]): r.other for r in vectors.neighbours(d, d.where("vec_id % 2 = 0"), 3, block=block).collect()}
    assert got == {(q, k + 1): int(o) for q in range(0, 60, 2) for k, o in enumerate(np.argsort(-s[q])[:3])}


def test_words_and_columns_in_one_ridge(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(600):
        words = [rnd.choice(["sale", "news", "linen", "today", "blue", "red"]) for _ in range(4)]
        x = rnd.random()
        rows.append((i, " ".join(words) if i % 50 else "", x, 0.2 + 0.3 * x + (0.2 if "sale" in words and i % 50 else 0.0), 1.0 + rnd.random()))
    d = spark.createDataFrame(rows, "id long, s string, x double, y double, w double")
    p = {r.id: r.predicted for r in classify.text_ridge(d, "id", "s", ["x"], "y", "w", reg=0.1).collect()}
    y = np.array([r[3] for r in rows])
    rest = np.array([p[i] for i in range(600)]) - y
    assert len(p) == 600 and np.mean(rest**2) < 0.15 * np.var(y)


def test_vocabulary_cap_and_accuracy(spark):
    from brindle.operators import bayes

    d = spark.createDataFrame([("a", 1.0, ["x", "x", "y"]), ("b", 1.0, ["z", "z", "y"]), ("b", 2.0, ["w"])], "label string, weight double, terms array<string>")
    assert {r.term for r in bayes.fit(d, 1.0, most=3)["terms"].collect()} == {"x", "y", "w"} and {r.term for r in bayes.fit(d, 1.0)["terms"].collect()} == set("xyzw")
    p = spark.createDataFrame([("a", "a", 3.0), ("a", "b", 1.0), ("b", "b", 1.0)], "label string, guess string, w double")
    assert {r.label: (r.accuracy, r.n) for r in bayes.accuracy(p, weight="w").collect()} == {"a": (0.75, 2), "b": (1.0, 1)}


def test_bounds_can_be_lifted(spark):
    """Orders, pools, prefixes and look-alikes of any size."""
    reachable(spark)
    from brindle.operators import baskets, ranking, search, vectors

    lines = spark.range(45).select(F.lit(1).alias("order_id"), F.col("id").alias("sku"))
    assert baskets.baskets(lines, "sku").count() == 0 and baskets.baskets(lines, "sku", None).count() == 45
    rows = spark.range(70).select(F.lit("q").alias("q"), F.col("id").alias("sku"), (1 - F.col("id") / 100).alias("rel"), F.lit("b").alias("brand"))
    assert ranking.diversify(rows, "q", "sku", "rel", {"brand": 1.0}, k=70).count() == 48 and ranking.diversify(rows, "q", "sku", "rel", {"brand": 1.0}, k=70, pool=None).count() == 70
    log = spark.createDataFrame([("a query of thirty three characters", "2024-01-01", True)] * 9, "query_text string, event_date string, clicked boolean").withColumn("event_date", F.to_date("event_date"))
    assert {r.prefix for r in search.autocomplete(log, "2024-01-01").collect()} < {r.prefix for r in search.autocomplete(log, "2024-01-01", longest=None).collect()} and search.autocomplete(log, "2024-01-01", longest=None).count() == 34
    e = spark.range(90).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.col("id") / 100).alias("embedding"))
    seeds = e.where("vec_id < 30").select("vec_id")
    assert vectors.lookalikes(e, seeds, most=5).count() == 5 and vectors.lookalikes(e, seeds, most=None, least=-1.0).count() == 60
