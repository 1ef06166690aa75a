"""Queries do the whole job: literal tables in which a part left out would show."""

from __future__ import annotations

import datetime

from brindle.plans.catalogue import QUERIES


def test_devices_of_many_customers_join_them(spark, tmp_path):
    """30 customers on one device, and two more on another, with small values."""
    at = datetime.datetime(2024, 1, 2, 3)
    rows = [(i, at + datetime.timedelta(seconds=i), i, "click", 1.0, '{"k": 5}') for i in range(30)]
    rows += [(30 + i, at + datetime.timedelta(hours=2), 100 + i, "view", 1.0, '{"k": 5}') for i in range(2)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    got = {r.node: r.component for r in QUERIES["reviewer_components"](spark, str(tmp_path)).collect()}
    assert got == {i: 0 for i in range(30)} | {100: 100, 101: 100}
    assert [(r.component, r.members) for r in QUERIES["suspicious_rings"](spark, str(tmp_path)).collect()] == [(0, 30)]
