"""Home page, backtest and fallbacks against independent code."""

from __future__ import annotations

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from brindle.operators import recs, search, supply
from brindle.sources import config


def test_candidate_pool(spark):
    modules = spark.createDataFrame([("m", "a"), ("m", "b"), ("n", "b")], "module string, category string")
    feed = spark.createDataFrame([("n", 9, "c"), ("m", 1, "a")], "module string, sku int, category string")
    trend = spark.createDataFrame([(1, "a", 2.0), (2, "b", -1.0), (3, "d", 5.0)], "sku int, category string, z double")
    got = sorted(map(tuple, recs.candidate_pool(modules, feed, trend).collect()))
    assert got == [("m", 1, "a", 2.0), ("m", 2, "b", -1.0), ("n", 2, "b", -1.0), ("n", 9, "c", 0.0)]


def test_home_page_by_brute_force(spark):
    rng = random.Random(1)
    pool = [(m, 100 * i + j, f"c{rng.randint(0, 3)}", rng.uniform(-2, 2)) for i, m in enumerate("xyz") for j in range(8)]
    affinity = [(c, f"c{k}", rng.random()) for c in (1, 2) for k in range(3)]
    prior = [(f"c{k}", rng.random() / 2) for k in range(3)]
    own, base = {(c, k): a for c, k, a in affinity}, dict(prior)
    want = {}
    for c in (1, 2, 3):  # 3 is new
        lists = {}
        for m in "xyz":
            rel = {s: 0.65 * max(own.get((c, k), 0), base.get(k, 0)) + 0.35 / (1 + math.exp(-z / 2)) for n, s, k, z in pool if n == m}
            kind = {s: k for n, s, k, _ in pool if n == m}
            left, out = sorted(rel, key=lambda s: (-rel[s], s)), []
            while left and len(out) < 5:
                best = max(left, key=lambda s: (round(0.7 * rel[s] - 0.3 * any(kind[s] == kind[o] for o in out), 12), rel[s], -s))
                out.append(best)
                left.remove(best)
            lists[m] = [(s, rel[s]) for s in out]
        order = sorted(lists, key=lambda m: (-round(sum(r for _, r in lists[m]) / len(lists[m]), 9), m))
        for n, m in enumerate(order):
            for i, (s, r) in enumerate(lists[m]):
                want[c, m, n + 1, i + 1] = (s, r)
    frames = [spark.createDataFrame(*x) for x in (([(1,), (2,), (3,)], "customer_id long"), (affinity, "customer_id long, category string, affinity double"), (pool, "module string, sku long, category string, z double"), (prior, "category string, prior double"))]
    got = {(r.customer_id, r.module, r.module_rank, r.position): (r.sku, r.relevance) for r in recs.home_page(*frames, slots=5).collect()}
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1]) for k in want)


def test_backtest_sees_no_future(spark):
    day = lambda i: datetime.date(2001, 1, 1) + datetime.timedelta(days=7 * i)
    rows = [(s, day(i), 10.0 if i < 20 else 30.0) for s in (1, 2) for i in range(40)]
    panel = spark.createDataFrame(rows, "sku int, week_start date, units double")
    got = {r.origin: r for r in supply.rolling_backtest(panel, ["sku"], [str(day(10)), str(day(19)), str(day(30))], 4).collect()}
    assert (got[str(day(10))].wape, got[str(day(19))].wape, got[str(day(30))].wape) == (0.0, pytest.approx(20 / 30), 0.0)
    assert got[str(day(19))].bias == pytest.approx(-2 / 3) and {r.n for r in got.values()} == {8}


def test_an_empty_snapshot_is_refused(spark):
    f = spark.createDataFrame([("q", "global", None)], "query string, strategy string, category string")
    t = spark.createDataFrame([], "snapshot_date date, category string, sku long, score double")
    with pytest.raises(ValueError, match="empty"):
        search.fallback_products(f, t)
    old = spark.createDataFrame([("2024-01-01", "c", 1, 9.0), ("2024-01-02", "c", 2, 1.0)], "d string, category string, sku long, score double").withColumn("snapshot_date", F.col("d").cast("date"))
    assert [tuple(r) for r in search.fallback_products(f, old).collect()] == [("q", 2, 1)]


def test_ranker_settings(tmp_path):
    f = tmp_path / "r.yaml"
    f.write_text("k1: 1.5\nrounds: 10\n")
    c = config.load(config.RankerConfig, str(f))
    assert (c.k1, c.b, c.rounds, c.prior_impressions) == (1.5, 0.75, 10, 40.0)
