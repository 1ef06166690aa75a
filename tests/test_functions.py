"""Functions and operators on small literal inputs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.functions import exprs, tails
from brindle.functions import text as tx
from brindle.operators import baskets, catalog, drift, experiments, features, graph, images, lifetime, marketing, models, ranking, recs, reviews, search, supply, vectors
from brindle.sources import config, io


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_query_normaliser(spark):
    assert one(spark, tx.normalize_query(F.lit("  Égyptian Cotton  Sheets 1000 Thread Count, Cal-King "))) == "egyptian cotton sheets 1000tc cal king"
    assert one(spark, tx.normalize_query(F.lit('rug 5 Feet x 60 inches'))) == "rug 5ft x 60in"


@pytest.mark.parametrize(("word", "root"), [("towels", "towel"), ("throws", "throw"), ("berries", "berry"), ("dishes", "dish"), ("glass", "glass"), ("bus", "bus"), ("400", "400")])
def test_stem(spark, word, root):
    assert one(spark, tx.stem(F.lit(word))) == root


def test_ngrams_and_shingles(spark):
    assert one(spark, tx.char_ngrams(F.lit("rug"), 2, 3)) == [" r", "ru", "ug", "g ", " ru", "rug", "ug "]
    assert one(spark, tx.shingles(F.lit("A b c d"))) == ["a b c", "b c d"]
    assert one(spark, tx.shingles(F.lit("A b"))) == ["a b"] and one(spark, tx.shingles(F.lit(""))) == []
    assert one(spark, tx.bigrams(F.array(F.lit("a"), F.lit("b"), F.lit("c")))) == ["a_b", "b_c"]


def test_blocked_words(spark):
    assert one(spark, tx.blocked(F.lit("n4zi rug"))) and not one(spark, tx.blocked(F.lit("linen rug")))


def test_edit_distance():
    assert [tx.damerau(a, b) for a, b in (("linen", "lienn"), ("rug", "rugs"), ("", "ab"), ("duvet", "dvuett"))] == [1, 1, 2, 2]


def test_tails():
    assert tails.normal_two_sided(1.959963984540054) == pytest.approx(0.05)
    assert tails.t_two_sided(2.0, 10) == pytest.approx(0.0733880, abs=1e-6)
    assert tails.t_two_sided(1.5, 1e6) == pytest.approx(tails.normal_two_sided(1.5), abs=1e-5)
    assert tails.chi2_upper(3.841458820694124, 1) == pytest.approx(0.05)
    assert tails.chi2_upper(10, 4) == pytest.approx(math.exp(-5) * 6)
    assert tails.ks_upper(0.0, 10, 10) == 1.0 and tails.ks_upper(0.9, 50, 50) < 1e-10


def test_cut_is_right_closed(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.5, 4.0, 4.5, 12.0)], "x double")
    assert [r.b for r in df.select(exprs.cut(F.col("x"), [0, 4, 12], ["a", "b"]).alias("b")).collect()] == [None, "a", "a", "b", "b"]


def test_bands_match_interpolated_quantiles(spark):
    for n in (3, 4, 7, 50):
        df = spark.range(1, n + 1).select(exprs.rank_band(F.col("id"), F.lit(n), 4).alias("b"))
        edges = np.quantile(np.arange(1, n + 1), [0.25, 0.5, 0.75])
        assert [r.b for r in df.collect()] == [int((edges < i).sum()) for i in range(1, n + 1)]


def test_top_k_and_pinned_diversity(spark):
    df = spark.createDataFrame([("q", i, s, b) for i, s, b in ((1, 1.0, "x"), (2, 0.9, "x"), (3, 0.5, "y"), (4, 0.4, "x"))], "q string, i int, s double, b string")
    assert [r.i for r in ranking.top_k(df, ["q"], [F.desc("s")], 2).collect()] == [1, 2]
    out = ranking.diversify(df, "q", "i", "s", {"b": 1.0}, 0.5, 3, 1).orderBy("position").collect()
    assert [(r.i, r.original_position) for r in out] == [(1, 1), (3, 3), (2, 2)]


def test_basket_rules(spark):
    lines = spark.createDataFrame([(o, i, c) for o, items in enumerate((("a", "b"), ("a", "b"), ("a", "c"), ("b",))) for i, c in ((x, x.upper()) for x in items)], "order_id int, sku string, category string")
    r = {(x.antecedent, x.consequent): x for x in baskets.rules(baskets.baskets(lines, "sku"), 2, 0.0, 0.0).collect()}
    assert set(r) == {("a", "b"), ("b", "a")} and r["b", "a"].confidence == 1.0 and r["a", "b"].support == pytest.approx(2 / 3)


def test_components_and_bursts(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (10, 11), (11, 12), (12, 13), (13, 14), (14, 15)], "a int, b int")
    assert sorted(map(tuple, graph.components(e).collect())) == [(1, 1), (2, 1), (3, 1)] + [(i, 10) for i in range(10, 16)]
    t = spark.createDataFrame([("p", f"2024-01-0{d}") for d in (1, 2, 3, 3, 9)], "k string, d string").select("k", F.col("d").cast("timestamp_ntz").alias("ts"))
    b = graph.bursts(t, ["k"], "ts", 48, 4).first()
    assert b.n == 4 and str(b.start).startswith("2024-01-01")


def test_minhash_finds_copies(spark):
    words = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, words), (2, words + " tail"), (3, "something else entirely here")], "id int, t string")
    assert [(r.a, r.b) for r in graph.jaccard_pairs(df, "id", "t").collect()] == [(1, 2)] == [(r.a, r.b) for r in graph.exact_jaccard(df, "id", "t").collect()]


def test_false_discovery_rate(spark):
    df = spark.createDataFrame([("e", m, p) for m, p in (("a", 0.01), ("b", 0.02), ("c", 0.03), ("d", 0.5))], "e string, metric string, p_value double")
    assert [round(r.p_adjusted, 4) for r in experiments.adjust_p(df, ["e"]).orderBy("metric").collect()] == [0.04, 0.04, 0.04, 0.5]


def test_cuped_removes_the_explained_part(spark):
    df = spark.createDataFrame([("e", "m", i, float(2 * i + i % 2), float(i)) for i in range(20)], "experiment_id string, metric string, unit_id int, value double, pre_value double")
    r = experiments.cuped(df).agg(F.var_samp("adjusted"), F.var_samp("value"), F.avg("adjusted"), F.avg("value")).first()
    assert r[0] < 0.02 * r[1] and r[2] == pytest.approx(r[3])


def test_drift_of_equal_windows_is_nothing(spark):
    v = spark.range(1000).select(F.lit("f").alias("feature"), (F.col("id") % 500).cast("double").alias("value"), (F.col("id") < 500).alias("is_ref"))
    assert drift.psi(v).first().psi == pytest.approx(0, abs=1e-9) and drift.ks(v).first().d == 0


def test_reorder_rounds_up_to_packs(spark):
    f = spark.createDataFrame([("s", 1, h, 10.0, 10.0, 10.0) for h in range(1, 5)], "sku string, warehouse_id int, horizon int, p10 double, p50 double, p90 double")
    st = spark.createDataFrame([("s", 1, 5, 0, 0, 0.5)], "sku string, warehouse_id int, on_hand int, on_order int, allocated int, margin double")
    tm = spark.createDataFrame([("s", "v", 10, 6, 3, 2.0)], "sku string, vendor_id string, lead_days int, case_pack int, moq int, unit_cost double")
    r = supply.reorder(f, st, tm).first()
    assert r.reorder_point == pytest.approx(100 / 7) and r.order_up_to == pytest.approx(170 / 7) and r.order_qty == 24 and r.cost == 48.0


def test_markdown_ladder_never_falls_and_beats_any_fixed_one():
    rows, value = supply.markdown_ladder(100, 10.0, 5.0, -2.0, 6)
    d = [r[1] for r in rows]
    assert d == sorted(d) and rows[-1][3] >= 0 and sum(r[2] for r in rows) + rows[-1][3] == pytest.approx(100)
    for k in (0.0, 0.2, 0.4):
        assert supply.markdown_ladder(100, 10.0, 5.0, -2.0, 6, steps=(k,))[1] <= value + 1e-9


def test_elasticity_is_recovered(spark):
    rnd = np.random.default_rng(0)
    rows = [("c", f"s{i}", w, float(np.exp(3 + i * 0.1 + 0.05 * w - 1.7 * lp)), float(np.exp(lp))) for i in range(6) for w in range(1, 30) for lp in [rnd.normal()]]
    df = spark.createDataFrame(rows, "category string, sku string, week_of_year int, units double, avg_price double").withColumn("week_start", F.lit("2024-01-01").cast("date"))
    assert supply.fit_elasticity(df).first().beta == pytest.approx(-1.7, abs=1e-6)


def test_elasticity_equals_a_regression_on_dummies(spark):
    """Beta, clustered error and fit against least squares with a dummy for each item and week; items of one row, one week or one price, and a null category."""
    rnd = np.random.default_rng(5)
    rows = []
    for c, items in (("a", 9), (None, 5), ("flat", 4), ("few", 2)):
        for i in range(items):
            n = 1 if i == 0 else int(rnd.integers(10, 40))
            price = np.full(n, 2.0 + i) if c == "flat" or i == 1 else np.exp(rnd.normal(0.5, 0.3, n))
            weeks = np.full(n, 7) if i == 2 else rnd.integers(1, 54, n)
            rows += [(c, f"{c}{i}", int(w), float(np.exp(2 + 0.2 * i - 1.3 * np.log(p) + rnd.normal(0, 0.4))), float(p)) for w, p in zip(weeks, price, strict=True)]
    rows += [("a", "a3", 5, 0.0, 1.0), ("a", "a3", 5, 3.0, 0.0)]
    df = spark.createDataFrame(rows, "category string, sku string, week_of_year int, units double, avg_price double").repartition(5)
    got = {r.category: r for r in supply.fit_elasticity(df, min_skus=3, min_obs=20).collect()}
    assert set(got) == {"a", None}
    for c in got:
        own = [r for r in rows if r[0] == c and r[3] > 0 and r[4] > 0]
        y, lp = np.log([r[3] for r in own]), np.log([r[4] for r in own])
        sku, g = np.unique([r[1] for r in own], return_inverse=True)
        d = np.eye(len(sku))[g]
        off = np.eye(len(y)) - d @ np.linalg.pinv(d)
        week = np.array([r[2] for r in own])
        x = off @ np.column_stack([lp, *[week == w for w in np.unique(week)[1:]]])
        x = x[:, np.abs(x).sum(axis=0) > 1e-9]
        b = np.linalg.lstsq(x, off @ y, rcond=1e-12)[0]
        u = off @ y - x @ b
        inv = np.linalg.pinv(x.T @ x, rcond=1e-12)
        meat = sum(np.outer(s, s) for k in range(len(sku)) for s in [x[g == k].T @ u[g == k]])
        m, rows_, k = len(sku), len(y), x.shape[1]
        se = np.sqrt(m / (m - 1) * (rows_ - 1) / max(rows_ - k - m, 1) * (inv @ meat @ inv)[0, 0])
        r = got[c]
        assert (r.n_obs, r.n_skus) == (rows_, m)
        assert (r.beta, r.se, r.r2) == pytest.approx((b[0], se, 1 - (u @ u) / ((off @ y) @ (off @ y))), rel=1e-8)


def test_moderation_and_tags(spark):
    df = spark.createDataFrame([("Lovely duvet",), ("SCAM buy at http://cheap.example",), ("what a scam!",), ("THIS IS BAD",)], "b string")
    assert [r.x for r in df.select(reviews.moderation(F.col("b")).alias("x")).collect()] == [None, "spam_link", "profanity", "shouting"]
    t = spark.createDataFrame([("B", "Linen"), ("B", "Bed"), ("B", "sale!!"), ("T", "Towels")], "sku string, tag string")
    assert sorted(map(tuple, reviews.valid_tags(t).collect())) == [("B", "bedding"), ("B", "linen"), ("T", "towel")]


def mentions(spark, text):
    df = spark.createDataFrame([(text,)], "b string").select(reviews.aspect_mentions(F.col("b")).alias("m"))
    return [(m.aspect, m.score) for m in df.first().m]


def test_sentiment(spark):
    got = dict(mentions(spark, "not very soft. the color is beautiful"))
    assert got["softness"] < 0 < got["color"]
    assert mentions(spark, None) == [] and mentions(spark, "so soft")[0] == ("softness", pytest.approx(0.78))
    assert mentions(spark, "never really soft") == [("softness", pytest.approx(0.6 * 1.4 * -0.7))]
    assert mentions(spark, "not bad but soft") == [("softness", pytest.approx((0.6 * 1 - 0.6 * -0.7 * 1 / 3) / (1 + 1 / 3)))]
    far = (-0.9 / 6 - 0.7 / 4) / (1 / 6 + 1 / 4)
    assert mentions(spark, "it FELL\u3000APART after the soooo loooong delivery, it wore out") == [("durability", -0.9), ("shipping", pytest.approx(far)), ("durability", -0.7)]
    assert mentions(spark, "the box") == []


def test_summary(spark):
    df = spark.createDataFrame([("B", 5, "So soft, great color!"), ("B", 3, "Soft but did shrink after washing")], "sku string, rating int, body string")
    assert tuple(reviews.summaries(df).first()) == ("B", 4.0, "Customers mention: soft, color, shrink")


def test_attributes(spark):
    df = spark.createDataFrame([(1, "Queen duvet 400 TC, 55% linen 45% cotton", "<b>machine wash cold</b>"), (2, "Rug 90 x 92 in", "dry clean only, wash cold")], "sku int, title string, description string")
    a, b = catalog.attributes(df).orderBy("sku").collect()
    assert (a.material, a["size"], a.thread_count, a.care) == ("cotton:45,linen:55", "Queen", 400, "machine_wash_cold")
    assert (b.width_cm, b.length_cm, b.care, b.material) == (228.6, 233.7, None, None)


def test_titles(spark):
    cols = ("sku", "title", "category_l2", "brand", "material", "product_type", "size", "color", "thread_count", "dimensions")
    rows = [
        (1, "t", "Sheets", "Hearth", "linen", "sheet set", "queen", "a very long colour name indeed", "400 Thread Count", None), (2, "SALE!! Linen sheet, -", "Rugs", None, None, "rug", None, None, None, ""),
        (3, "t", None, "Oak and Co", "wool", "throw of wool", None, "rust", None, None), (4, None, "Towels", "B" * 90, None, "towel", None, None, None, None),
    ]
    got = {r.sku: r for r in catalog.seo_titles(spark.createDataFrame(rows, ", ".join(f"{c} {'int' if c == 'sku' else 'string'}" for c in cols))).collect()}
    assert (got[1].reason, got[1].kept_original) == ("ok", False) and len(got[1].seo_title) <= 70 and "Linen" in got[1].seo_title and "400" not in got[1].seo_title
    assert (got[2].reason, got[2].seo_title, got[2].kept_original) == ("missing:dimensions", "Linen sheet", True)
    assert got[3].seo_title == "Oak and Co Wool Throw of Rust"
    assert got[4].seo_title == "Towel"


def test_paths(spark):
    df = spark.createDataFrame([("Bedding > Sheets > Flat Sheets",), ("Bath > Sheets > Flat Sheets",), ("Bath",)], "category_path string")
    assert [r.l3 for r in catalog.valid_paths(df).collect()] == ["Flat Sheets"]


def test_images(spark):
    img = np.full((40, 40, 3), 255, dtype=np.uint8)
    img[10:30, 10:30] = (20, 30, 90)
    blur, mean, clipped, white, score, why = images.quality(img)
    assert white == 1.0 and "LOW_RES" in why and 0 <= score <= 100
    shares = images.colour_shares(img)
    assert shares == {"navy": pytest.approx(1)}
    img[10:30, 10:15] = (180, 60, 30)
    shares = images.colour_shares(img)
    assert sum(shares.values()) == pytest.approx(1) and shares["navy"] == pytest.approx(0.75) and len(shares) == 2
    assert images.colour_shares(np.full((40, 40, 3), 250, dtype=np.uint8)) == {}


def test_hash_embedding_has_unit_length(spark):
    df = spark.createDataFrame([(1, "queen linen duvet cover"), (2, "ab")], "sku int, t string")
    e = vectors.hash_embedding(df, "sku", tx.words(F.col("t")))
    assert e.agg(F.sum(F.col("value") ** 2)).first()[0] == pytest.approx(1)
    assert len(vectors.dense(e, "sku").first().vector) == 128


def test_neighbours_in_blocks_are_exact(spark):
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(90, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    got = {(r.query, r.rank): r.other for r in vectors.neighbours(df, df.where("vec_id % 9 = 0"), 5, block=16).collect()}
    assert got == {(i, k + 1): int(j) for i in range(0, 90, 9) for k, j in enumerate(np.argsort(-s[i])[:5])}


def test_bandit_equals_the_normal_equations(spark):
    rnd = np.random.default_rng(1)
    x, r = rnd.normal(size=(50, 2)), rnd.normal(size=50)
    log = spark.createDataFrame([("none", float(a), float(b), float(y)) for (a, b), y in zip(x, r, strict=True)], "arm string, u double, v double, reward double")
    a, b = marketing.bandit_statistics(log, ["u", "v"])
    s = marketing.bandit_scores(spark.createDataFrame([(1, 0.5, -1.0)], "id int, u double, v double"), a, b, ["u", "v"], "id", ["none"]).first()
    theta = np.linalg.solve(np.eye(2) + x.T @ x, x.T @ r)
    assert s["mean"] == pytest.approx(theta @ [0.5, -1.0])
    assert s.ucb - s["mean"] == pytest.approx(0.5 * math.sqrt(np.array([0.5, -1.0]) @ np.linalg.inv(np.eye(2) + x.T @ x) @ [0.5, -1.0]))


def test_offer_propensities(spark):
    s = spark.createDataFrame([(i, a, 0.0, float(k)) for i in range(400) for k, a in enumerate(marketing.ARMS)], "id int, arm string, mean double, ucb double")
    recent = spark.createDataFrame([(i, 5) for i in range(0, 400, 2)], "id int, discounts int")
    out = marketing.choose_offers(s, recent, "id").collect()
    assert len(out) == 400 and all(r.n_allowed == (2 if r.id % 2 == 0 else 4) for r in out)
    assert 0.9 < sum(r.arm == "none" for r in out) / 400 < 1


def test_lifetime_value_parts():
    x = np.array([0.3])
    assert lifetime.hyp2f1(np.array([1.0]), np.array([1.0]), np.array([2.0]), x)[0] == pytest.approx(-math.log(0.7) / 0.3)
    log, psi = lifetime.stirling(np.array([0.01, 1.0, 2.5, 40.0]))
    assert log == pytest.approx([math.lgamma(v) for v in (0.01, 1.0, 2.5, 40.0)], rel=1e-10, abs=1e-10) and psi[1] == pytest.approx(-0.5772156649015329)


def test_auc_and_ndcg(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1)], "y int, p double")
    assert models.auc(df, "y", "p").first().auc == pytest.approx(0.875)
    r = spark.createDataFrame([("g", 1, 0.1, 1.0), ("g", 2, 0.9, 0.0)], "g string, k int, s double, gain double")
    assert models.ndcg(r, "g", "s", "gain", "k").first().ndcg == pytest.approx(1 / math.log2(3))


def test_least_squares_takes_the_minimum_norm(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (2.0, 2.0, 4.0)], "a double, b double, y double")
    assert models.least_squares(df, ["a", "b"], "y") == pytest.approx([1, 1])


def test_feature_views_and_expectations(spark):
    text = "defaults: {windows: [7], ttl_days: 1}\nfeature_views:\n  - name: v\n    entity: c\n    sources:\n      - {table: t, timestamp_column: ts, aggregations: [{column: x, function: median, alias: m}]}\n"
    with pytest.raises(ValueError, match="unsupported"):
        config.feature_views(text)
    with pytest.raises(ValueError, match=r"unsupported function median; feature_views\[0\].entity is missing"):
        config.feature_views(text.replace("entity: c", "other: c"))
    v = config.feature_views(text.replace("median", "sum"))[0]
    t = spark.createDataFrame([("a", "2024-01-05", 2.0), ("a", "2024-01-10", 5.0), ("b", "2023-12-01", 1.0)], "c string, d string, x double").select("c", F.col("d").cast("timestamp_ntz").alias("ts"), "x")
    out = features.materialize(v, {"t": t}, "2024-01-10")
    assert [(r.c, r.m_7d) for r in out.collect()] == [("a", 2.0)]
    io.expect(out, "c", ["m_7d"])
    with pytest.raises(ValueError, match="duplicate"):
        io.expect(out.unionAll(out), "c", ["m_7d"])
    with pytest.raises(KeyError):
        io.expect(out, "c", ["other"])


def test_config_layers(tmp_path, monkeypatch):
    f = tmp_path / "c.yaml"
    f.write_text("lookback_days: 9\nold: 1\nlam: 0.5\n")
    monkeypatch.setenv("BRINDLE_DRY_RUN", "yes")
    c = config.load(config.DiversityConfig, str(f), {"k": 10})
    assert (c.lookback_days, c.lam, c.dry_run, c.k, c.extra) == (9, 0.5, True, 10, {"old": 1})
    with pytest.raises(KeyError):
        config.load(config.JobConfig, None, {"nope": 1})
    with pytest.raises(ValueError, match="pin_top"):
        config.load(config.DiversityConfig, None, {"k": 100})
    with pytest.raises(ValueError, match="lookback_days must be 1 at least; alpha must be 10 at most; n_max can't be read"):
        config.load(config.CategorizerConfig, None, {"lookback_days": 0, "alpha": 11, "n_max": "x"})
    assert config.load(config.ZeroResultConfig, None, {"protected": "king, xl"}).protected == ["king", "xl"] and config.load(config.SynonymConfig).min_npmi == 0.15


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "ids.csv").write_text("customer_id,x\n1,a\n,b\n3,c\n")
    (tmp_path / "l.txt").write_text(" one \n\ntwo\n")
    assert [r.customer_id for r in io.read_csv_ids(spark, str(tmp_path / "ids.csv"), "customer_id").collect()] == ["1", "3"]
    assert [r.line for r in io.read_lines(spark, str(tmp_path / "l.txt")).collect()] == ["one", "two"]
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, d string")
    p = str(tmp_path / "out")
    assert not io.write(df.limit(0), p) and not io.write(df, p, dry_run=True) and io.write(df, p, partition="d")
    assert io.write(spark.createDataFrame([(9, "b")], "x int, d string"), p, partition="d")
    assert sorted((r.x, r.d) for r in spark.read.parquet(p).collect()) == [(1, "a"), (9, "b")]
    df.createOrReplaceTempView("v")
    assert io.run_sql(spark, "SELECT x FROM v WHERE d = :d", {"d": "b"}).first().x == 2
    assert [r.x for r in io.scan(spark, "v", ["x"], "x > 0", 1, ["x"]).collect()] == [1]
    assert [r.x for r in io.latest(df, "d").collect()] == [2]


def test_synonyms_and_fallbacks(spark):
    log = spark.createDataFrame([(s, q, f"2024-01-01 00:0{m}:00", c) for s in range(3) for q, m, c in (("linen sofa", 0, False), ("linen couch", 1, True))], "session_id int, query_text string, ts string, clicked boolean").withColumn("event_ts", F.col("ts").cast("timestamp"))
    assert {(r.a, r.b) for r in search.term_swaps(search.reformulations(log)).collect()} == {("sofa", "couch")}
    p = spark.createDataFrame([(i, ["linen", "sheet", w], "bed") for i, w in enumerate("abcdef")], "sku int, terms array<string>, category string")
    q = spark.createDataFrame([("linen sheet zzz", ["linen", "sheet", "zzz"]), ("zzz", ["zzz"]), ("a", ["a"])], "query string, terms array<string>")
    got = {r["query"]: (r.strategy, r.relaxed) for r in search.zero_result_fallbacks(q, p).collect()}
    assert got == {"linen sheet zzz": ("relaxed", "linen sheet"), "zzz": ("global", None), "a": ("global", None)}


def test_spelling(spark):
    v = spark.createDataFrame([("linen", 50), ("linens", 3), ("cotton", 40)], "word string, n int")
    w = spark.createDataFrame([("lienn",), ("cottn",), ("coton",), ("xyzzy",), ("12",)], "word string")
    assert {r.word: r.best for r in search.corrections(w, v).collect()} == {"lienn": "linen", "cottn": "cotton", "coton": "cotton"}


def test_duplicates_and_matches(spark):
    p = spark.createDataFrame([("B1", "Queen Linen Duvet Cover - Oat", "Hearth", "bed", 189.0), ("B2", "Queen linen duvet cover oat", "Hearth", "bed", 179.0), ("T", "Turkish Cotton Bath Towel", "Loom", "bath", 34.0)], "sku string, title string, brand string, category string, price double")
    assert [(r.a, r.b, round(r.score, 3)) for r in recs.duplicate_listings(p).collect()] == [("B1", "B2", 0.989)]
    c = spark.createDataFrame([(1, "shop", "turkish cotton bath towel", "loom ", "Bath", 35.0)], "listing_id int, competitor string, title string, brand string, category string, price double")
    assert recs.match_listings(p, c).first().sku == "T"
