"""Saved models, exact hold-outs and expanding fits."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.operators import boosting, holdout, models, supply
from brindle.sources.artefacts import Store
from brindle.sources.tables import reachable


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_versions_are_saved_loaded_and_rolled_back(spark, tmp_path, scheme):
    reachable(spark)
    s = Store(spark, f"{scheme}{tmp_path}/models")
    d = spark.createDataFrame([(float(i), float(i % 7), float(i > 20), 1.0) for i in range(60)], "a double, b double, y double, weight double")
    x = models.with_missing_flags(d, ["a", "b"])
    p = models.logistic(["a", "b"], "y").fit(x)
    first = s.save("coupon", p, {"reg": 0.01}, {"auc": 0.9})
    assert s.current("coupon") == first and s.manifest("coupon")["settings"] == {"reg": 0.01} and s.manifest("coupon")["kind"] == "pipeline"
    score = lambda m: [r.p for r in m.transform(x).select(models.p1().alias("p")).collect()]
    assert score(s.load("coupon")) == pytest.approx(score(p))

    bandit = spark.createDataFrame([("none", [1.0, 0.5])], "arm string, stats array<double>")
    s.save("bandit", bandit)
    assert s.load("bandit").collect() == bandit.collect() and s.manifest("bandit")["schema"]["fields"][0]["name"] == "arm"

    m = boosting.fit(d, ["a", "b"], "y", [boosting.logistic()], rounds=2, depth=2, min_rows=5)
    one = s.save("ranker", m.to_json(), metrics={"ndcg": 0.5})
    two = s.save("ranker", "{}", activate=False)
    assert s.versions("ranker") == [one, two] and s.current("ranker") == one
    again = boosting.Boosted.from_json(s.load("ranker"))
    v = np.array([[3.0, 1.0], [50.0, np.nan]])
    assert np.allclose(again.raw(v), m.raw(v))
    s.activate("ranker", two)
    assert s.load("ranker") == "{}" and s.load("ranker", one) == m.to_json()
    s.activate("ranker", one)
    assert s.manifest("ranker")["metrics"] == {"ndcg": 0.5}
    # A version without a manifest is not complete.
    (tmp_path / "models/ranker/v000009-x").mkdir()
    assert s.versions("ranker") == [one, two]
    with pytest.raises(KeyError):
        s.activate("ranker", "v000009-x")
    with pytest.raises(KeyError):
        s.load("unknown")


@pytest.mark.parametrize("share", [0.0, 0.2, 1.0])
def test_hold_outs_are_exact(spark, share):
    rows = [(i, "big" if i % 3 else "small" if i % 2 else None, i % 17) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, s string, g int").withColumns({"rank": F.lit(1), "cut": F.lit(2), "stratum": F.lit("x"), "key": F.lit(0)})
    out = holdout.hold_out(df, "id", "s", share)
    assert out.columns == [*df.columns, "held"] and out.count() == 1000
    n, held = Counter(r[1] for r in rows), Counter(r.s for r in out.where("held").collect())
    assert held == Counter({k: int(v * share + 0.5) for k, v in n.items() if int(v * share + 0.5)})
    again = holdout.hold_out(df.repartition(7), "id", "s", share)
    assert {r.id for r in again.where("held").collect()} == {r.id for r in out.where("held").collect()}
    groups = holdout.hold_out(df, "id", None, share, "g").groupBy("g").agg(F.count_distinct("held").alias("k"), F.max("held").alias("held")).collect()
    assert all(r.k == 1 for r in groups) and sum(r.held for r in groups) == int(17 * share + 0.5)
    assert holdout.hold_out(df.limit(0), "id", "s", share).collect() == []


def test_equal_ranks_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(holdout, "rank", lambda key, seed=0: F.lit(5).cast("long"))
    assert holdout.hold_out(spark.range(50).select(F.col("id").alias("k")), "k", None, 0.3).where("held").count() == 15


def test_expanding_fits_equal_separate_ones(spark):
    rng = np.random.default_rng(4)
    rows = [(i, f"2024-{1 + w // 28:02d}-{1 + w % 28:02d}", float(a), float(b), float(2 + 3 * a - b + rng.normal())) for w in range(84) for i, (a, b) in enumerate(rng.normal(size=(5, 2)))]
    df = spark.createDataFrame(rows, "k int, day string, a double, b double, y double").withColumn("day", F.col("day").cast("date"))
    origins = ["2024-01-20", "2024-02-10", "2024-03-28"]
    for r in supply.expanding_fits(df, ["a", "b"], "y", "day", origins).collect():
        part = [x for x in rows if x[1] <= r.origin]
        want = np.linalg.lstsq(np.array([[1, x[2], x[3]] for x in part]), np.array([x[4] for x in part]), rcond=None)[0]
        assert r.coefficients == pytest.approx(want)
