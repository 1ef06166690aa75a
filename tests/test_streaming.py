"""Streams over a folder of files give the batch results for all closed windows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from brindle.operators.marketing import bandit_statistics
from brindle.sources.tables import Tables
from brindle.streaming import jobs


@pytest.fixture(scope="module")
def folder(spark, sf_dir, tmp_path_factory):
    p = str(tmp_path_factory.mktemp("events"))
    # In the order of time, as a stream would bring them.
    Tables(spark, sf_dir).events.withColumn("arm", F.when(F.col("event_id") % 2 == 0, "none").otherwise("free_shipping")).withColumn("reward", F.col("value")).repartitionByRange(3, "event_ts").write.mode("overwrite").parquet(p)
    return p


def test_activity_matches_batch(spark, folder, tmp_path):
    out = jobs.run_to_end(jobs.activity_windows(jobs.read_events(spark, folder, 10)), str(tmp_path / "o"), str(tmp_path / "c"))
    want = {(r.sku, r.start, r.end, round(r.weight, 6), r.n) for r in jobs.activity_windows(spark.read.parquet(folder)).collect()}
    got = {(r.sku, r.start, r.end, round(r.weight, 6), r.n) for r in out.collect()}
    last = max(w[2] for w in want)
    assert got <= want and {w for w in want if w[2] < last} <= got


def test_sessions_and_bursts_run(spark, folder, tmp_path):
    s = jobs.run_to_end(jobs.session_counts(jobs.read_events(spark, folder)), str(tmp_path / "o"), str(tmp_path / "c"))
    b = jobs.run_to_end(jobs.burst_windows(jobs.read_events(spark, folder), "customer_id", 48, 24, 3), str(tmp_path / "o2"), str(tmp_path / "c2"))
    assert s.count() > 0 and b.where("n < 3").count() == 0


def test_alerts_are_raised_once(spark, tmp_path):
    rows = [("m", "f", "psi", f"2024-01-01 0{h}:00:00") for h in range(4)] + [("m", "g", "psi", "2024-01-01 01:00:00")]
    spark.createDataFrame(rows, "model string, feature string, metric string, t string").withColumn("created_at", F.col("t").cast("timestamp")).drop("t").write.parquet(str(tmp_path / "in"))
    out = jobs.run_to_end(jobs.first_alerts(jobs.read_events(spark, str(tmp_path / "in"), 10)), str(tmp_path / "o"), str(tmp_path / "c"))
    assert sorted(r.feature for r in out.collect()) == ["f", "g"]


def test_bandit_state_adds_up(spark, folder, tmp_path):
    log = jobs.read_events(spark, folder)
    jobs.merge_statistics(log, ["value", "reward"], str(tmp_path / "s"), str(tmp_path / "c")).awaitTermination()
    a, b = jobs.read_statistics(spark, str(tmp_path / "s"))
    wa, wb = bandit_statistics(spark.read.parquet(folder), ["value", "reward"])
    near = lambda x, y: {tuple(r)[:-1]: round(r.value, 3) for r in x.select(*y.columns).collect()} == {tuple(r)[:-1]: round(r.value, 3) for r in y.collect()}
    assert near(a, wa) and near(b, wb)
