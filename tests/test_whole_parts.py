"""Every part has a picture and a listing."""

from __future__ import annotations

import math
import random

from brindle.operators import recs
from brindle.plans.catalogue import QUERIES
from brindle.plans.content import pictures
from brindle.sources.tables import Tables


def test_every_part_has_a_picture_and_a_listing(spark, tmp_path):
    rows = [(k, f"name{k} thing{k}", f"b{k}", "t", 10 + k, 5.0) for k in range(1, 13)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    d = str(tmp_path)
    assert {r.image_id for r in QUERIES["image_quality"](spark, d).collect()} == {f"i{k}" for k in range(1, 13)} == {r.image_id for r in pictures(Tables(spark, d)).select("image_id").collect()}
    assert {r.sku for r in QUERIES["dominant_colours"](spark, d).collect()} == {f"b{k}" for k in range(1, 13)}
    assert {(r.sku, r.listing_id) for r in QUERIES["competitor_match"](spark, d).collect()} == {(k, k + 1_000_000) for k in range(1, 13)}


def test_listings_meet_the_nearest_prices_only(spark, monkeypatch):
    """each price of a title met each price of a like listing, and all these rows were sorted. The same best products as from all pairs, also for prices that scores don't tell apart
    (nearly equal, or far from any), and for none."""
    rng = random.Random(4)
    ours = [(i, 20.0 + rng.randrange(3000) / 7) for i in range(150)] + [(200 + i, v) for i, v in enumerate((31.0, 31.0 + 1e-9, 31.0 - 1e-9, None, 0.0, -3.0, 5000.0, 4999.0, 900000.0))]
    rng.shuffle(ours)
    theirs = [(1000 + i, 20.0 + rng.randrange(3000) / 7) for i in range(150)] + [(2000 + i, v) for i, v in enumerate((31.0, 31.0 + 1e-9, None, 0.0, -1.0, 0.001, 1e9, 21000.0, 90000.0, 1.8, 1.9, 2.0))]
    p = spark.createDataFrame([(k, "oak chair", "b", "c", v) for k, v in ours], "sku long, title string, brand string, category string, price double")
    c = spark.createDataFrame([(k, f"shop{k}", "oak chair", "b", "c", v) for k, v in theirs], "listing_id long, competitor string, title string, brand string, category string, price double")
    real = lambda v: v is not None and v > 0
    like = lambda a, b: math.erfc(abs(math.log(b / a) / 0.45) / math.sqrt(2)) if real(a) and real(b) else 0.0
    want = {k: min((-round(0.775 + 0.15 * like(v, x), 9), s) for s, v in ours)[1] for k, x in theirs}
    seen, top = [], recs.top_k
    monkeypatch.setattr(recs, "top_k", lambda df, *a: (seen.append(df.count()), top(df, *a))[1])
    assert {r.listing_id: r.sku for r in recs.match_listings(p, c, 0.6).collect()} == want
    assert seen[0] < 3000
