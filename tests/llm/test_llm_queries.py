"""The registered queries against their SQL, and the pipeline against plain code, stage by stage."""

from __future__ import annotations

import datetime
import re
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from brindle.llm import decontaminate, mixing, packing, simhash
from brindle.llm.oracles import ORACLES
from brindle.llm.queries import QUERIES

TABLES = ("documents", "pages", "benchmark", "embeddings")


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


def plain(v):
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    cur = duck.execute(ORACLES[name])
    have = [d[0] for d in cur.description]
    assert sorted(have) == cols
    assert Counter(tuple(plain(r[c]) for c in cols) for r in df.collect()) == Counter(tuple(plain(r[have.index(c)]) for c in cols) for r in cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_covers_its_table(name, spark, sf_dir):
    out = QUERIES[name](spark, sf_dir)
    if name == "op9_packing":
        out = packing.unpack(out)
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect())


def words(x: str) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", x or "")


def rejected(x: str) -> bool:
    """The quality rules, written out."""
    from brindle.llm import quality as q

    w = words(x)
    chars = sum(map(len, w))

    def inside(n: int) -> set[int]:
        g = Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
        return {j for i in range(len(w) - n + 1) if g[tuple(w[i : i + n])] > 1 for j in range(i, i + n)}

    def earlier(n: int) -> set[int]:
        seen, out = set(), set()
        for i in range(len(w) - n + 1):
            g = tuple(w[i : i + n])
            out |= set(range(i, i + n)) if g in seen else set()
            seen.add(g)
        return out

    seen, again = set(), 0
    for line in x.split("\n"):
        if words(line):
            again += sum(map(len, words(line))) if line in seen else 0
            seen.add(line)
    bad = again > q.MAX_LINE_SHARE * chars or len(re.findall(r"[#*$%&|<>]", x)) > q.MAX_SYMBOLS * len(w)
    return len(w) < 50 or 100 * len(inside(3)) > 50 * len(w) or bad or any(sum(len(w[j]) for j in earlier(n)) > s * chars for n, s in q.MAX_GRAM_SHARE.items())


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "decontamination", "mixing", "packing"]
    seen = [docs]
    for _, step in corpus_pipeline.STAGES[:4]:
        seen.append(step(spark, seen[-1], sf_dir).cache())
        assert seen[-1].columns == docs.columns
    ids = [Counter(r.doc_id for r in d.select("doc_id").collect()) for d in seen]
    text = {r.doc_id: r.text for r in docs.collect()}
    assert ids[1] == Counter(d for d in ids[0].elements() if not rejected(text[d]))
    fp = {d: int(r.fingerprint, 16) for r in simhash.near_duplicates(seen[1]).collect() for d in [r.doc_id]}
    comp = {d: d for d in fp}
    while True:
        new = {d: min(comp[e] for e in fp if (fp[d] ^ fp[e]).bit_count() <= 3) for d in fp}
        if new == comp:
            break
        comp = new
    assert ids[2] == Counter(set(comp.values()))
    report = decontaminate.decontaminate(seen[2], spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()
    assert ids[3] == Counter(r.doc_id for r in report if not r.contaminated) and any(r.contaminated for r in report)
    assert ids[4] == Counter({r.doc_id: r.copies for r in mixing.report(seen[3]).collect() if r.copies})
    encode, end = packing.tokenizer(packing.TOKENIZER)
    out = corpus_pipeline.run(spark, sf_dir)
    assert Counter((r.doc_id, *r.ids) for r in packing.unpack(out).collect()) == Counter((d, *[int(x) for x in encode([text[d]])[0]], end) for d in ids[4].elements())


def test_entry_registers_them():
    import __spark_entry__ as entry

    names = entry.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names and set(ORACLES) <= set(entry.oracle_sql())
    assert {f"op{n}_" for n in range(1, 14)} == {re.match(r"op\d+_", n)[0] for n in QUERIES}
