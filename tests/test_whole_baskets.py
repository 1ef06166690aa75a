"""Orders of any number of items make rules."""

from __future__ import annotations

import datetime

import duckdb
import pytest

from brindle.operators import baskets
from brindle.plans.catalogue import ORACLES, QUERIES


def plain(rows):
    return sorted(tuple(r) for r in rows)


@pytest.fixture
def large_orders(spark, tmp_path):
    """20 orders of 40 items each, which a bound of 30 leaves out, and 20 of two items; an item is its own brand and every second one the same category."""
    at = datetime.datetime(2001, 6, 2)
    items = [(o, k) for o in range(20) for k in range(1, 41)] + [(20 + o, k) for o in range(20) for k in (1 + o % 4, 50 + o % 3)]
    spark.createDataFrame([(o, k, 1, i, 1.0, 2.0, 0.0, "N") for i, (o, k) in enumerate(items)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(o, o % 7, at, "F") for o in range(40)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, f"n{k}", f"b{k}", f"t{k % 33}", 1, 1.0) for k in range(1, 54)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def same_as_sql(name, spark, sf_dir):
    duck = duckdb.connect()
    for t in ("lineitem", "orders", "part"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet/*.parquet')")
    cur = duck.execute(ORACLES[name])
    got = plain(QUERIES[name](spark, sf_dir).select(*[d[0] for d in cur.description]).collect())
    assert got == plain(cur.fetchall())
    return got


def test_rules_of_large_orders(spark, large_orders):
    """orders of more than 30 brands made no rules."""
    assert len(same_as_sql("basket_rules", spark, large_orders)) >= 36 * 35


def test_rules_with_backoff_of_large_orders(spark, large_orders):
    """nor did orders of more than 30 items or categories. The bound of ``cart_addons`` is in its SQL and stays."""
    got = same_as_sql("basket_rules_backoff", spark, large_orders)
    assert len({r[0] for r in got}) == 43
    assert [len(r) for r in (same_as_sql("cart_addons", spark, large_orders),)] == [0]


def test_pairs_of_large_orders_in_any_cells(spark, monkeypatch):
    lines = spark.createDataFrame([(o, f"i{k}") for o in range(3) for k in range(35 + o)] + [(9, "i1"), (9, "i2")], "order_id int, sku string")
    want = {(f"i{x}", f"i{y}"): sum(max(x, y) < 35 + o for o in range(3)) + ({x, y} == {1, 2}) for x in range(37) for y in range(37) if x != y}
    for cell, wide in ((4, 30), (512, 30), (3, 36), (512, 100)):
        monkeypatch.setattr(baskets, "CELL_ITEMS", cell)
        monkeypatch.setattr(baskets, "WIDE", wide)
        got = baskets.rules(baskets.baskets(lines, "sku", None), 1, 0.0, 0.0).collect()
        assert len(got) == len(want) and {(r.antecedent, r.consequent): round(r.support * 4) for r in got} == want
