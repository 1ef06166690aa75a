"""Every registered query of the analytics operators runs; those with SQL give the same rows as DuckDB."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

import duckdb
import pytest

from brindle.plans.catalogue import ORACLES, QUERIES
from brindle.sources.tables import RAW

#: Model fits take long; test_models runs each of these queries once and holds the models against known answers.
SLOW = {"churn_gbt", "uplift_tlearner", "coupon_logistic", "text_classifier", "segments_kmeans", "demand_recursive", "search_ranker", "subject_scores", "clv_values", "listwise_ranker", "category_paths"}


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return tuple(plain(x) for x in v) if isinstance(v, list) else v


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in RAW:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if name in ORACLES:
        cur = duck.execute(ORACLES[name])
        have = [d[0] for d in cur.description]
        assert sorted(have) == cols
        assert got == Counter(tuple(plain(r[have.index(c)]) for c in cols) for r in cur.fetchall())


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
