"""Models on data with known answers, and the queries without SQL against independent code."""

from __future__ import annotations

import itertools
import math
import random
from collections import Counter
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.operators import features, graph, lifetime, marketing, models, recs, supply
from brindle.plans.catalogue import QUERIES
from brindle.sources.tables import Tables


def area(y, p):
    """Share of (positive, negative) pairs in the right order."""
    pos, neg = ([v for v, k in zip(p, y, strict=True) if k == w] for w in (1, 0))
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def signal(spark):
    """Rows whose label is drawn with probability sigmoid(2 x - 1); noise says nothing."""
    rng = np.random.default_rng(1)
    x, noise = rng.normal(size=3000), rng.normal(size=3000)
    p = 1 / (1 + np.exp(1 - 2 * x))
    y = (rng.random(3000) < p).astype(int)
    return spark.createDataFrame([(i, float(a), float(b), int(c), float(d)) for i, (a, b, c, d) in enumerate(zip(x, noise, y, p, strict=True))], "id long, x double, noise double, y int, p_true double")


def test_calibrated_trees_follow_the_true_probability(signal):
    part = F.col("id") % 3
    out = models.calibrated_gbt(signal.where(part == 0), signal.where(part == 1), signal.where(part == 2), ["x", "noise"], "y", "id").join(signal, "id").collect()
    assert area([r.y for r in out], [r.p for r in out]) > 0.8
    assert np.mean([abs(r.p - r.p_true) for r in out]) < 0.1 and all(0 <= r.p <= 1 for r in out)


def test_uplift_is_found_where_it_is(spark):
    rng = random.Random(2)
    rows = [(i, i % 2, float(x), int(rng.random() < (0.7 if i % 2 and x else 0.2))) for i in range(4000) for x in [rng.randint(0, 1)]]
    d = spark.createDataFrame(rows, "id long, treated int, x double, converted int")
    got = {r.x: r.u for r in models.t_learner(d, d, ["x"], "id").join(d, "id").groupBy("x").agg(F.avg("uplift").alias("u")).collect()}
    assert got[1.0] == pytest.approx(0.5, abs=0.06) and got[0.0] == pytest.approx(0.0, abs=0.06)


def test_logistic_with_missing_values(signal):
    d = models.with_missing_flags(signal.withColumn("x", F.when(F.col("id") % 10 != 0, F.col("x"))), ["x", "noise"])
    m = models.logistic(["x", "noise"], "y").fit(models.balanced(d, "y"))
    out = m.transform(d.withColumn("weight", F.lit(1.0))).select("y", models.p1().alias("p"), "x").collect()
    assert area([r.y for r in out if r.x is not None], [r.p for r in out if r.x is not None]) > 0.82
    w = m.stages[-1].coefficients
    assert w[0] > 1 and abs(w[1]) < 0.15
    assert models.auc(signal.select("y", F.round("x", 1).alias("s")), "y", "s").first().auc == pytest.approx(area(*zip(*[(r.y, round(r.x, 1)) for r in signal.collect()], strict=True)), abs=2e-3)


def test_balanced_weights(spark):
    d = models.balanced(spark.createDataFrame([(c,) for c in "aaab"], "c string"), "c")
    assert {r.c: r.weight for r in d.collect()} == {"a": 4 / (2 * 3), "b": 4 / (2 * 1)}


def test_text_classifier_separates_languages(spark, sf_dir):
    out = QUERIES["text_classifier"](spark, sf_dir).collect()
    names = sorted({r.label for r in out})
    assert len(out) > 20 and sum(r.label == r.guess for r in out) / len(out) >= 0.9 and {r.guess for r in out} <= set(names)


def test_segments_find_blobs(spark):
    rng = np.random.default_rng(3)
    centres = 20 * rng.normal(size=(5, 8))
    rows = [(i, [float(v) for v in centres[i % 5] + rng.normal(size=8)]) for i in range(400)]
    out = models.segments(spark.createDataFrame(rows, "id long, e array<double>"), "id", "e").collect()
    assert {r.k for r in out} == {5}
    assert len({(r.id % 5, r.segment) for r in out}) == 5 and all(r.distance >= 0 for r in out)


def steps(df):
    return supply.calendar_features(supply.lag_features(df, ["sku"]))


def test_recursive_forecast_of_a_level(spark):
    start = "2000-01-03"
    rows = spark.range(3 * 70).select((F.col("id") % 3).alias("sku"), F.date_add(F.lit(start).cast("date"), (7 * F.floor(F.col("id") / 3)).cast("int")).alias("week_start"))
    panel = rows.withColumn("units", (F.col("sku") + 1) * 10.0 + (F.dayofmonth("week_start") % 3 - 1))
    cols = ["lag_1", "lag_2", "lag_4", "roll_mean_4", "roll_mean_8", "roll_mean_13"]
    model, q = models.demand_model(steps(panel).where("lag_4 is not null"), cols)
    short, long = ({(r.sku, r.horizon): r for r in models.recursive_forecast(panel, ["sku"], cols, model, q, steps, lookback=n).collect()} for n in (53, 500))
    assert len(short) == 3 * 12 and {h for _, h in short} == set(range(1, 13))
    for k, r in short.items():
        # The model is log-linear in the lags, so a level is only met roughly; the order of the levels is.
        assert r.p10 <= r.p50 <= r.p90 and r.p50 == pytest.approx(long[k].p50) and (k[0] + 1) * 5 < r.p50 < (k[0] + 1) * 20
        assert k[0] == 0 or r.p50 > short[k[0] - 1, k[1]].p50


def test_ranker_orders_by_relevance(spark):
    rng = random.Random(5)
    rows = [(i, i % 40, x, rng.random(), int(rng.random() < x)) for i in range(2000) for x in [rng.random()]]
    d = spark.createDataFrame(rows, "id long, q long, x double, z double, clicked int").withColumn("weight", F.lit(1.0))
    out = models.ranker(d.where("q < 20"), d.where("q >= 20"), ["x", "z"], "clicked", "weight").withColumn("gain", F.col("x"))
    assert models.ndcg(out, "q", "rank_score", "gain", "id").first().ndcg > 0.9


def test_ridge_equals_its_closed_form(spark):
    rng = np.random.default_rng(7)
    x, w = rng.normal(size=(300, 2)), rng.random(300) + 0.5
    y = x @ np.array([2.0, -1.0]) + 3 + 0.1 * rng.normal(size=300)
    d = spark.createDataFrame([(float(a), float(b), float(c), float(k)) for (a, b), c, k in zip(x, y, w, strict=True)], "a double, b double, y double, w double")
    p = [r.prediction for r in models.ridge(d, ["a", "b"], "y", "w", 0.0).transform(d).collect()]
    one = np.column_stack([np.ones(300), x])
    want = one @ np.linalg.solve(one.T @ (w[:, None] * one), one.T @ (w * y))
    assert np.allclose(p, want, atol=1e-3)


def test_lifetime_values_of_simulated_customers(spark):
    """Buyers with gamma rates who drop out after a purchase with beta probability: the fit predicts the purchases of the next year."""
    rng = np.random.default_rng(11)
    rows, future = [], 0
    for i in range(3000):
        rate, leave, age = rng.gamma(0.8, 1 / 10), rng.beta(1.2, 4.0), 104.0
        t, times, alive = 0.0, [], True
        while alive:
            t += rng.exponential(1 / rate)
            if t > age + 52:
                break
            times.append(t)
            alive = rng.random() > leave
        x = [round(7 * v) / 7 for v in times if v <= age]
        future += sum(v > age for v in times)
        rows.append((i, len(x), x[-1] if x else 0.0, age, float(rng.gamma(6, 5)) if x else 0.0))
    s = spark.createDataFrame(rows, "customer_id long, frequency long, recency double, T double, monetary double")
    out = lifetime.lifetime_values(s, lifetime.fit_bgnbd(s), lifetime.fit_gamma_gamma(s)).collect()
    assert sum(r.purchases for r in out) == pytest.approx(future, rel=0.12)
    assert all(0 <= r.p_alive <= 1 and r.value >= 0 for r in out) and np.mean([r.order_value for r in out]) == pytest.approx(30, rel=0.1)


@pytest.mark.parametrize("kind", ["purchases", "spend"])
def test_likelihood_slopes(kind):
    """Against differences of the likelihood, and the likelihood against the gamma function."""
    rng = np.random.default_rng(1)
    x = rng.integers(0 if kind == "purchases" else 1, 30, 200).astype(float)
    if kind == "purchases":
        t = rng.uniform(10, 100, 200)
        rows, p, terms = [x, np.where(x > 0, t * rng.random(200), 0.0), t], np.array([0.7, 9.0, 1.1, 3.0]), lifetime.purchase_terms
    else:
        rows, p, terms = [x, rng.gamma(4, 10, 200)], np.array([4.0, 3.0, 20.0]), lifetime.spend_terms
    value, slopes = terms(p, rows)
    for j in range(len(p)):
        up, down = p.copy(), p.copy()
        up[j] *= 1 + 1e-6
        down[j] *= 1 - 1e-6
        assert np.allclose((terms(up, rows)[0] - terms(down, rows)[0]) / (2e-6 * p[j]), slopes[j], rtol=1e-4, atol=1e-6)
    g = np.vectorize(math.lgamma)
    if kind == "purchases":
        r, al, a, b = p
        tx = rows[1]
        gone = np.where(x > 0, a / np.where(x > 0, b + x - 1, 1) * (al + tx) ** -(r + x), 0)
        want = g(b + x) + g(a + b) - g(a + b + x) - g(b) + g(r + x) - g(r) + r * np.log(al) + np.log((al + t) ** -(r + x) + gone)
    else:
        k, q, c = p
        m = rows[1]
        want = g(k * x + q) - g(k * x) - g(q) + q * np.log(c) + (k * x - 1) * np.log(m) + k * x * np.log(x) - (k * x + q) * np.log(c + m * x)
    assert np.allclose(value, want, rtol=1e-9)


def test_expected_purchases_equal_the_closed_form():
    p, x, t = np.array([0.7, 9.0, 1.6, 3.0]), np.array([0.0, 1.0, 7.0, 40.0]), np.array([5.0, 20.0, 52.0, 104.0])
    r, al, a, b = p
    got = lifetime.to_come(p, x, t, np.array([4.0, 52.0]))
    for j, s in enumerate((4.0, 52.0)):
        z = s / (al + t + s)
        # By the posterior given that the customer is alive: dropout chances are Beta(a, b + x).
        want = (a + b + x - 1) / (a - 1) * (1 - ((al + t) / (al + t + s)) ** (r + x) * lifetime.hyp2f1(r + x, b + x, a + b + x - 1, z))
        assert np.allclose(got[:, j], want, rtol=1e-6)


def simulated(n, seed, r, alpha, a, b, weeks=104.0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        rate, leave, t, times = rng.gamma(r, 1 / alpha), rng.beta(a, b), 0.0, []
        while True:
            t += rng.exponential(1 / rate)
            if t > weeks:
                break
            times.append(t)
            if rng.random() < leave:
                break
        rows.append((i, len(times), times[-1] if times else 0.0, weeks))
    return rows


def test_parameters_are_recovered(spark):
    s = spark.createDataFrame(simulated(40_000, 5, 0.8, 10.0, 1.2, 4.0), "customer_id long, frequency long, recency double, T double").repartition(4)
    r, alpha, a, b = lifetime.fit_bgnbd(s, penalty=0.0)
    assert r == pytest.approx(0.8, rel=0.05) and r / alpha == pytest.approx(0.08, rel=0.05) and a / (a + b) == pytest.approx(1.2 / 5.2, rel=0.05)
    rng = np.random.default_rng(6)
    n = rng.integers(1, 9, 40_000)
    m = [float(rng.gamma(6.0 * k, 1 / v) / k) for k, v in zip(n, rng.gamma(4.0, 1 / 15.0, 40_000), strict=True)]
    p, q, g = lifetime.fit_gamma_gamma(spark.createDataFrame([(int(k), v) for k, v in zip(n, m, strict=True)], "frequency long, monetary double"))
    assert p == pytest.approx(6.0, rel=0.05) and q == pytest.approx(4.0, rel=0.05) and g == pytest.approx(15.0, rel=0.08)


@pytest.mark.parametrize("name", ["churn_gbt", "uplift_tlearner", "coupon_logistic", "segments_kmeans", "demand_recursive", "search_ranker", "listwise_ranker", "category_paths", "subject_scores", "clv_values"])
def test_model_queries_cover_their_tables(name, spark, sf_dir):
    t = Tables(spark, sf_dir)
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    assert rows and not any(v is None or (isinstance(v, float) and not math.isfinite(v)) for r in rows for v in r)
    lines = t.lines.select("customer_id").distinct()
    keys = {
        "churn_gbt": ("customer_id", lines), "segments_kmeans": ("vec_id", t.raw("embeddings").select("vec_id")), "subject_scores": ("review_id", t.reviews.select("review_id")),
        "clv_values": ("customer_id", lines), "search_ranker": ("sku", t.products.where("sku % 4 = 0").select("sku")),
    }
    if name in keys:
        key, of = keys[name]
        assert Counter(r[key] for r in rows) == Counter(r[0] for r in of.collect())


def test_minhash_recall(spark, sf_dir):
    """Against all pairs by plain sets: none wrong, nine of ten found."""
    t = Tables(spark, sf_dir)

    def shingle(x):
        w = __import__("re").findall(r"[a-z0-9']+", (x or "").lower())
        return frozenset(" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))) if w else frozenset()

    s = {r.review_id: shingle(r.body) for r in t.reviews.collect()}
    want = {(a, b): len(s[a] & s[b]) / len(s[a] | s[b]) for a, b in itertools.combinations(sorted(s), 2) if s[a] and s[b] and len(s[a] & s[b]) >= 0.6 * len(s[a] | s[b])}
    got = {(r.a, r.b): r.jaccard for r in graph.jaccard_pairs(t.reviews, "review_id", "body").collect()}
    assert set(got) <= set(want) and all(got[k] == pytest.approx(want[k]) for k in got) and len(got) >= 0.9 * len(want) and want


def test_duplicate_listings_by_brute_force(spark):
    rng = random.Random(3)
    words = "linen cotton duvet cover sheet set queen king throw pillow".split()
    rows = [(i, " ".join(rng.choices(words[:5], k=rng.randint(2, 3))) + rng.choice(["", "-x", " 2"]), f"b{i % 2}", float(rng.randint(8, 9))) for i in range(60)]
    ratio = lambda a, b: max(SequenceMatcher(None, x, y).ratio() for x, y in ((a, b), (b, a)))
    want = {}
    for (i, a, p, x), (j, b, q, y) in itertools.combinations(rows, 2):
        score = 0.8 * ratio(a.replace("-", " "), b.replace("-", " ")) + 0.2 * min(x, y) / max(x, y)
        if p == q and score >= 0.85:
            want[i, j] = score
    got = {(r.a, r.b): r.score for r in recs.duplicate_listings(spark.createDataFrame(rows, "sku long, title string, brand string, price double")).collect()}
    assert got == {k: pytest.approx(v) for k, v in want.items()} and want


def test_matches_by_brute_force(spark):
    rng = random.Random(4)
    words = "linen cotton duvet cover sheet set queen grey throw pillow".split()
    title = lambda: " ".join(rng.choices(words, k=rng.randint(1, 4)))
    ours = [(i, title(), f"b{i % 2}", "c", float(rng.randint(50, 90))) for i in range(40)]
    theirs = [(100 + i, f"s{i % 2}", title(), f"b{i % 2}", "c", float(rng.randint(50, 90))) for i in range(40)]

    def tokens(a, b):
        p, q = set(a.split()), set(b.split())
        both = " ".join(sorted(p & q))
        x, y = (f"{both} {' '.join(sorted(r))}".strip() for r in (p - q, q - p))
        return max(SequenceMatcher(None, u, v).ratio() for u, v in ((both, x), (both, y), (x, y)))

    colour = lambda t: next((w for w in t.split() if w in ("gray", "linen")), None)
    best = {}
    for lid, comp, lt, lb, _, lp in theirs:
        for sku, ot, ob, _, op in ours:
            a, b = ot.replace("grey", "gray"), lt.replace("grey", "gray")
            ts = tokens(a, b)
            if lb != ob or ts < 0.5:
                continue
            attr = 0.5 if None in (colour(a), colour(b)) else float(colour(a) == colour(b))
            price = math.erfc(abs(math.log(lp / op) / 0.45) / math.sqrt(2))
            score = 0.7 * ts + 0.15 * attr + 0.15 * price
            if score >= 0.78 and (lid not in best or (-round(score, 9), sku) < (-round(best[lid][1], 9), best[lid][0])):
                best[lid] = (sku, score, comp)
    per = {}
    for lid, (sku, score, comp) in best.items():
        if (sku, comp) not in per or (-round(score, 9), lid) < (-round(per[sku, comp][1], 9), per[sku, comp][0]):
            per[sku, comp] = (lid, score)
    p = spark.createDataFrame(ours, "sku long, title string, brand string, category string, price double")
    c = spark.createDataFrame(theirs, "listing_id long, competitor string, title string, brand string, category string, price double")
    got = {(r.sku, r.competitor): (r.listing_id, r.score) for r in recs.match_listings(p, c).collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in per.items()} and per
    assert all(got[k][1] == pytest.approx(per[k][1], abs=1e-6) for k in per)


def test_unsimilar_prefixes_do_not_hide_features(spark, sf_dir):
    """Subject lines are whole first lines."""
    f = marketing.subject_features(F.col("s"))
    r = spark.createDataFrame([("x" * 200 + " LAST hours?",)], "s string").select(*[v.alias(k) for k, v in f.items()]).first()
    assert r.n_urgency == 2 and r.has_question == 1
    assert features.order_values(Tables(spark, sf_dir).lines).count() > 0
