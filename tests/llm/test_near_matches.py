"""Proximity matches: which items, and in which document."""

from __future__ import annotations

import pytest

from brindle.llm.queries import QUERIES

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa"


@pytest.mark.parametrize("ahead", [0, 1])
def test_near_match_at_the_start_of_a_document(spark, tmp_path, ahead):
    """Seen from its rarest word (document 9 has the first one often), the passage of document 5 starts before the document does."""
    docs = [(i, "other words only") for i in range(ahead)] + [(5, "beta alpha gamma delta epsilon zeta eta theta iota kappa"), (6, "alpha gamma beta delta epsilon zeta eta theta kappa iota"), (8, ITEM), (9, "alpha alpha alpha")]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3, ITEM), (4, "no such passage in any of the documents at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: (r.n_near, r.near_items) for r in QUERIES["op4_decontamination"](spark, str(tmp_path)).collect()}
    assert got == {i: (0, "") for i in range(ahead)} | {5: (1, "3"), 6: (1, "3"), 8: (0, ""), 9: (0, "")}
    exact = {r.doc_id: r.n_hit for r in QUERIES["op4_decontamination"](spark, str(tmp_path)).collect()}
    assert exact == {i: 0 for i in range(ahead)} | {5: 0, 6: 0, 8: 10, 9: 0}
