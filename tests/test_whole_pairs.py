"""Large buckets lose no pair."""

from __future__ import annotations

import itertools

import numpy as np

from brindle.operators import graph, vectors


def test_pairs_of_large_buckets(spark):
    """Variants of one text of 40 words, each with another word in two places, some of them copied: many a pair is unlike the first."""
    words = [f"w{i}" for i in range(40)]
    texts = {0: " ".join(words)} | {i: " ".join(w if j not in (i, i + 20) else f"x{i}" for j, w in enumerate(words)) for i in range(1, 19)} | {100 + i: " ".join(words) for i in range(5)}
    df = spark.createDataFrame(list(texts.items()), "id int, t string")
    sets = {k: {tuple(t.split()[i : i + 3]) for i in range(38)} for k, t in texts.items()}
    band = {k: {(r.band, r.bucket) for r in g} for k, g in itertools.groupby(sorted(graph.minhash_bands(df, "id", "t").collect(), key=lambda r: r.id), key=lambda r: r.id)}
    jac = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    want = {(a, b): jac(a, b) for a, b in itertools.combinations(sorted(texts), 2) if band[a] & band[b] and jac(a, b) >= 0.5}
    got = graph.jaccard_pairs(df, "id", "t", 0.5, largest=3).collect()
    assert len(got) == len(want) and {(r.a, r.b): r.jaccard for r in got} == want and len(want) > 30


def test_exact_pairs_in_any_parts_and_without_their_copies(spark):
    """All pairs by brute force, whatever the parts; unexpanded, the pairs of the smallest copies and a row for each other copy. Null and empty texts link to nothing."""
    words = [f"w{i}" for i in range(12)]
    texts = {i: " ".join(w if j != i % 13 else f"x{i // 26}" for j, w in enumerate(words)) for i in range(60)} | {90: None, 91: "", 92: "", 93: "--", 94: "--"}
    df = spark.createDataFrame(list(texts.items()), "id int, t string")
    sets = {k: {tuple(t.split()[i : i + 3]) for i in range(10)} for k, t in texts.items() if k < 90}
    jac = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    want = {(a, b): jac(a, b) for a, b in itertools.combinations(sets, 2) if jac(a, b) >= 0.5}
    first = {k: min(j for j in sets if texts[j] == texts[k]) for k in sets}
    compact = {(a, b): j for (a, b), j in want.items() if first[a] == a and (first[b] == b or first[b] == a)}
    assert 30 < len(compact) < len(want)
    for largest, expand, rows in ((2000, True, want), (3, True, want), (3, False, compact)):
        got = [(r.a, r.b, r.jaccard) for r in graph.exact_jaccard(df, "id", "t", 0.5, largest=largest, expand=expand).collect()]
        assert len(got) == len(rows) and {(a, b): j for a, b, j in got} == rows


def test_products_of_sparse_blocks(monkeypatch):
    """most of the time went into entries of words that many texts have; these are multiplied as matrices. The same products by either way, and -inf only where no slot is shared, also
    where a sum cancels out, a slot stands twice in a row, or a row is empty."""
    rng = np.random.default_rng(3)
    rows = lambda n: [np.unique((40 * rng.random(9) ** 3).astype(int) ** 2) for _ in range(n)]
    for sign in (False, True):
        q, y = rows(30), rows(50)
        value = lambda x: [rng.choice([-1.0, 1.0], len(r)) if sign else rng.random(len(r)) + 0.1 for r in x]
        vq, vy = value(q), value(y)
        q[3], vq[3], y[4], vy[4] = [], [], np.append(y[4], y[4][0]), np.append(vy[4], 1.0)
        a, b = (np.zeros((len(s), 1600)) for s in (q, y))
        for m, s, v in ((a, q, vq), (b, y, vy)):
            for i, (x, z) in enumerate(zip(s, v, strict=True)):
                np.add.at(m[i], np.asarray(x, dtype=int), z)
        shared = np.array([[bool(set(map(int, s)) & set(map(int, t))) for t in y] for s in q])
        for most in (1024, 3, 0):
            monkeypatch.setattr(vectors, "DENSE_SLOTS", most)
            own = vectors.Postings([q, vq])
            assert (own.dense.shape[1] > 0) == (most > 0) and (own.column < 0).any()
            got = own.products(vectors.Laid([y, vy]))
            assert (np.isinf(got) == ~shared).all() and np.allclose(got[shared], (a @ b.T)[shared], atol=1e-12)
            assert (not sign) or (got[shared] == 0).any()
