"""Top-k search, the Merkle manifest and ranked search against brute force, with nulls, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.llm import merkle, ranked, topk

# ---- top-k


def vectors() -> list[tuple]:
    rnd = random.Random(3)
    base = [[rnd.gauss(0, 0.2) for _ in range(9)] for _ in range(60)]
    out = [(i, base[i % 60] if i % 7 else [x + rnd.gauss(0, 0.01) for x in base[i % 60]]) for i in range(700)]
    out += [(700, None), (701, [0.1] * 8 + [None]), (800, [0.1] * 8 + [float("nan")]), (801, [float("inf")] + [0.0] * 8), (900, [0.5, -0.5]), (902, [0.25, -0.25]), (1000, []), (1001, []), (None, base[1]), (100, base[2]), (100, base[2]), (1100, [0.0] * 9)]
    return out


def expected_top(rows: list[tuple], k: int) -> Counter:
    live = [(i, [math.floor(1024 * np.float64(np.float32(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out: Counter = Counter()
    for a, (q, u) in enumerate(live):
        if q is None or q % 100:
            continue
        near = sorted(((-sum(x * y for x, y in zip(u, v, strict=True)), i is None, i) for b, (i, v) in enumerate(live) if a != b and len(v) == len(u)), key=lambda x: (x[0], x[1], x[2] or 0))
        out.update((q, r, i, -s) for r, (s, _, i) in enumerate(near[:k], 1))
    return out


@pytest.mark.parametrize("items", [topk.BLOCK_ITEMS, 37])
def test_topk(spark, items, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ITEMS", items)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 3 if items == 37 else topk.BLOCK_QUERIES)
    monkeypatch.setattr(topk, "KEPT", 2)
    df = spark.createDataFrame(vectors(), "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("r", "id", "v", "q", "score", "rank", "block")}).repartition(3)
    got = topk.report(df)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "bigint"]
    assert Counter(map(tuple, got.collect())) == expected_top(vectors(), topk.K)
    assert topk.report(df.limit(0)).collect() == [] and topk.report(df.where("vec_id = 1")).collect() == []


def test_topk_copies_of_queries_are_not_broadcast(spark):
    """A copy of the queries a shard met the items by a broadcast: it went through the driver."""
    rows = topk.integers(spark.createDataFrame(vectors(), "vec_id long, embedding array<float>"), "vec_id", "embedding", 1024)
    asked = topk.query_blocks(rows.withColumn("floor", F.lit(topk.NONE).cast("long")), 700)
    plan = topk.scan(topk.stage(topk.item_blocks(rows), "blocks"), topk.stage(asked, "asked"), 10)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan


def test_reading_stops_before_the_end_of_the_lists():
    rng = np.random.default_rng(1)
    x = np.floor(1024 * rng.normal(size=(3000, 16)) * 0.2).astype(np.int64)
    o = np.argsort(x, axis=0, kind="stable").T
    block = topk.Block(np.arange(3000), o.ravel(), np.take_along_axis(x.T, o, axis=1).ravel(), 16)
    for j in range(40):
        q = x[j]
        want = np.lexsort((np.arange(3000), -(x @ q)))[:5]
        at, score, read = block.search(q, topk.NONE, 5)
        assert topk.best(at, score, 5)[0].tolist() == want.tolist()
        floor = int((x @ q)[want[-1]])
        at, score, early = block.search(q, floor, 5)
        assert topk.best(at, score, 5)[0].tolist() == want.tolist() and early <= read and early < x.size
    assert len(block.search(np.zeros(16, dtype=np.int64), topk.NONE, 5)[0]) == 3000
    with pytest.raises(OverflowError):
        block.search(np.full(16, 1 << 60), topk.NONE, 5)


# ---- Merkle


def sha(*x: str) -> str:
    return hashlib.sha256("".join(x).encode()).hexdigest()


def leaf(*v) -> str:
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in v))


def climb(hashes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and each leaf's siblings before and after it, level by level."""
    paths: list[list] = [[] for _ in hashes]
    now, under = hashes, [[i] for i in range(len(hashes))]
    while len(now) > 1:
        up, over = [], []
        for s in range(0, len(now), 16):
            run = now[s : s + 16]
            for j in range(len(run)):
                for i in under[s + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(sha(*run))
            over.append([i for u in under[s : s + 16] for i in u])
        now, under = up, over
    return now[0], paths


def expected_manifest(rows: list[tuple]) -> Counter:
    by = defaultdict(list)
    for d, s, la, n, t in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t) if t is not None else None
        changed = d is not None and zlib.crc32(str(d).encode()) % 5 == 0
        h = leaf(d, s, la, n, t)
        by[s].append((d is not None, d or 0, h, d, leaf(d, s, la, n, low) if changed else h))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in names}
    root, above = climb([trees[s][0] for s in names])
    out: Counter = Counter()
    for s, top in zip(names, above, strict=True):
        for (_, _, h, d, other), path in zip(sorted(by[s], key=lambda x: x[:3]), trees[s][1], strict=True):
            folded = other
            for a, b in path + top:
                folded = sha(a, folded, b)
            out[d, h, trees[s][0], root, sha(*[a + b for a, b in path + top]), folded, folded == root] += 1
    return out


def manifest_rows() -> list[tuple]:
    rnd = random.Random(9)
    out = [(i, f"s{rnd.choice('aaaaab')}", "en", i, rnd.choice(["Some Text", "low text", "", "É ß 東京"]) + str(i)) for i in range(700)]
    out += [(1000 + i, f"x{i}", None, None, None) for i in range(30)] + [(2000 + i, None, "de", 1, "Null source") for i in range(17)]
    out += [(None, "sa", "en", 1, "No id"), (5, "sa", "en", 5, "again"), (3000, "", "", 0, ""), (3001, "é", "fr", 1, "x" * 50_000), *[(9, "sa", "en", 9, "Same Row")] * 40]
    return out


def test_merkle_manifest(spark):
    rows = manifest_rows()
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df = df.withColumns({c: F.lit("z") for c in ("g", "h", "i", "n", "other", "leaf", "path", "_u")}).repartition(5)
    got = merkle.report(df)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, got.collect())) == expected_manifest(rows)
    assert merkle.report(df.limit(0)).collect() == []
    one = df.where("doc_id = 3000")
    assert Counter(map(tuple, merkle.report(one).collect())) == expected_manifest([(3000, "", "", 0, "")])


def test_leaves_are_placed_without_a_task_per_group(spark, monkeypatch):
    rows = spark.range(20_000).select(F.lit("one").alias("g"), F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
    kept = {}
    real = merkle.stage
    monkeypatch.setattr(merkle, "stage", lambda df, name, **o: kept.setdefault(name, real(df, name, **o)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = merkle.placed(rows, "k")
        assert out.where("i != k or n != 20000").count() == 0
        assert kept["places"].groupBy(F.shiftright("_m", 33)).count().agg(F.max("count")).first()[0] < 12_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# ---- ranked search

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(x: str | None) -> list[str]:
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))


def expected_ranks(docs: list[tuple], items: list[tuple], k: int) -> Counter:
    bags = [(d, Counter(terms(t))) for d, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n_docs, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * c + 1))) for t, c in df.items()}
    out: Counter = Counter()
    for i, text in items:
        ask = Counter(terms(text))
        found = []
        for (d, b), n in zip(bags, sizes, strict=True):
            s = sum(c * w[t] * (1000000000 * b[t] // (1000 * b[t] + 12 * (75 + 25 * n * n_docs // total))) for t, c in ask.items() if t in b)
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        out.update((i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(found)[:k], 1))
    return out


def lexical() -> tuple[list[tuple], list[tuple]]:
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(80)]
    text = lambda n: " ".join(vocab[min(79, int(rnd.expovariate(0.08)))] + rnd.choice(["", ",", "!"]) for _ in range(n))
    docs = [(i, text(rnd.randint(0, 60))) for i in range(300)]
    docs += [(i, docs[7][1]) for i in range(300, 340)] + [(400, None), (401, ""), (402, " -- "), (403, "É Straße 東京 w1"), (404, "w3 " * 4000), (None, "w1 w70 w71"), (5, "w1 w2"), (5, "w1 w2"), (405, "Q" * 30_000)]
    items = [(i, text(rnd.randint(1, 25))) for i in range(12)] + [(20, None), (21, ""), (22, "absent words"), (23, "É w1 W1 straße"), (3, "w1"), (None, "w70"), (24, docs[7][1]), (25, "q" * 30_000)]
    return docs, items


@pytest.mark.parametrize("head", [1, 100])
def test_ranked_search(spark, head, monkeypatch):
    monkeypatch.setattr(ranked.tput, "__defaults__", (ranked.K, head, head))
    docs, items = lexical()
    clash = {c: F.lit(1) for c in ("r", "n", "terms", "term", "s", "item", "score", "rank", "c", "low")}
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns(clash).repartition(4)
    q = spark.createDataFrame(items, "item_id long, text string").withColumns(clash)
    got = ranked.search(d, q)
    assert Counter(map(tuple, got.collect())) == expected_ranks(docs, items, ranked.K)
    assert ranked.search(d.limit(0), q).collect() == [] and ranked.search(d, q.limit(0)).collect() == []


def test_thresholds_keep_postings_back(spark):
    """The second phase doesn't read what can't matter: with one rare and one frequent term, the frequent list gives up little."""
    docs = [(i, "common " * (1 + i % 3) + ("rare " * 9 if i < 40 else "")) for i in range(2000)]
    d = spark.createDataFrame(docs, "r long, text string")
    counts = ranked.stage(ranked.counted(d, None), "counts")
    lists = ranked.stage(ranked.postings(counts), "lists")
    asked = spark.createDataFrame([(0, "rare", 1), (0, "common", 1)], "item long, term string, c long")
    left = ranked.tput(lists, asked, 2000)
    assert 20 <= left.count() <= 60 and {r.r for r in left.collect()} <= set(range(40))
