"""Search queries take all the rows that are due."""

from __future__ import annotations

import tracemalloc

import numpy as np

from brindle.operators import ann
from brindle.plans.catalogue import QUERIES


def test_every_twentieth_query_is_scored(spark, tmp_path):
    rows = [(i, "alpha beta gamma", "en", "s", 1) for i in range(101)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {(r.query_id, r.doc_id) for r in QUERIES["bm25_scores"](spark, str(tmp_path)).collect()}
    assert got == {(q, d) for q in range(0, 101, 20) for d in range(101)}


def test_memory_of_a_part_and_of_cells_is_bounded():
    """a thousand queries met all vectors of a part in one matrix, and a batch was sorted by all cells at once. The same neighbours as in one matrix."""
    rng = np.random.default_rng(2)
    x = ann.unit(rng.normal(size=(4000, 16)).astype(np.float32))
    coder = ann.Coder(x[:1000].copy(), [w.astype(np.float32) for w in np.array_split(rng.normal(size=(64, 16)) / 9, 4, axis=1)], 10)
    codes, names = coder.codes(x, np.zeros(4000, dtype=int)), np.arange(0, 4000, 8)
    tracemalloc.start()
    cells = coder.cell(x)
    got = ann.best_in_part(coder, 0, names, x[names], np.arange(4000), x, codes, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 << 20
    d = (coder.cells**2).sum(axis=1)[None, :] - 2 * x @ coder.cells.T
    assert (np.abs(d[np.arange(4000), cells[:, 0]] - d.min(axis=1)) < 1e-5).all()
    assert (coder.cell(x[:600], 7).shape, coder.cell(x[:0], 7).shape) == ((600, 7), (0, 7))
    s = x[names] @ x.T
    s[np.arange(len(names)), names] = -np.inf
    best = -np.sort(-s, axis=1)[:, :5]
    rows = got.sort_values(["query", "score"], ascending=[True, False]).score.to_numpy().reshape(-1, 5)
    assert len(got) == 5 * len(names) and (got["query"] != got.other).all() and (rows <= best + 1e-5).all()
