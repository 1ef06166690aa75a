"""Approximate nearest neighbours by cosine: an inverted file of cells with product-quantised residuals.

Fitted on a bounded sample (FIT_ROWS vectors, chosen by a hash of the id): cells and code words are k-means centroids, and the number of cells to probe is the
least one that finds TARGET of the sample's own neighbours. Every vector is indexed: its cell, a byte for each part of what it differs from the cell's centroid, and the vector.
The index is written, by cell.

A query meets its cells by an equi-join. A large cell is dealt into parts of PART_ROWS vectors and its queries into blocks, so a group has a bound; inside a group tables of
part products give approximate scores of all its vectors, and the REFINE best are scored exactly. k rows a query leave a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import _checkpoint
from .ranking import top_k

FIT_ROWS = 20_000
PART_ROWS = 20_000
QUERY_ROWS = 1_000
REFINE = 10
TARGET = 0.97
#: Rows that are compared with all cells, and queries with all vectors of a part, at a time: no batch or group makes a whole matrix of both.
ROWS, MEET_QUERIES = 512, 32


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def matrix(rows: pd.Series) -> np.ndarray:
    return np.array(rows.tolist(), dtype=np.float32) if len(rows) else np.zeros((0, 1), dtype=np.float32)


def centroids(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """k-means of a sample; a centroid without members starts again at the worst-placed point."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        d = (c * c).sum(axis=1)[None, :] - 2 * x @ c.T
        at = d.argmin(axis=1)
        n = np.bincount(at, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
        if (empty := np.flatnonzero(n == 0)).size:
            c[empty] = x[np.argsort(-d[np.arange(len(x)), at])[: empty.size]]
    return c.astype(np.float32)


@dataclass
class Coder:
    """cells x dims centroids; per part of the dims, its code words; how many cells a query probes."""

    cells: np.ndarray
    words: list[np.ndarray]
    probe: int

    def parts(self, x: np.ndarray) -> list[np.ndarray]:
        return np.array_split(x, len(self.words), axis=1)

    def cell(self, x: np.ndarray, n: int = 1) -> np.ndarray:
        """The n nearest cells of each row, the nearest first."""
        out, length = np.zeros((len(x), min(n, len(self.cells))), dtype=np.int64), (self.cells * self.cells).sum(axis=1)[None, :]
        for lo in range(0, len(x), ROWS):
            d = length - 2 * x[lo : lo + ROWS] @ self.cells.T
            out[lo : lo + ROWS] = d.argmin(axis=1)[:, None] if n == 1 else np.argsort(d, axis=1, kind="stable")[:, :n]
        return out

    def codes(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        rest = x - self.cells[cell]
        return np.stack([((w * w).sum(axis=1)[None, :] - 2 * p @ w.T).argmin(axis=1) for p, w in zip(self.parts(rest), self.words, strict=True)], axis=1).astype(np.uint8)

    def scores(self, q: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """queries x vectors of one cell: product with the centroid, and of each part with its code word."""
        out = np.repeat((q @ self.cells[cell])[:, None], len(codes), axis=1)
        for j, (p, w) in enumerate(zip(self.parts(q), self.words, strict=True)):
            out += (p @ w.T)[:, codes[:, j]]
        return out


def fit(vectors: DataFrame, key: str, vector: str, cells: int | None = None, parts: int = 8, words: int = 256, k: int = 10, fit_rows: int = FIT_ROWS, seed: int = 5) -> Coder:
    n = vectors.count()
    share = min(1.0, 1.2 * fit_rows / max(1, n))
    sample = vectors.where(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 20)) < int(share * (1 << 20))).select(F.col(vector).cast("array<float>").alias("v")).limit(fit_rows).toPandas()
    x = unit(matrix(sample.v))
    cells = cells or int(np.clip(np.sqrt(n), 1, 4096))
    c = centroids(x, cells, seed) if len(x) else np.zeros((1, 1), dtype=np.float32)
    coder = Coder(c, [np.zeros((1, 1))] * min(parts, c.shape[1]), len(c))
    own = coder.cell(x)[:, 0] if len(x) else np.zeros(0, dtype=np.int64)
    coder.words = [centroids(p, words, seed + 1) if len(p) else np.zeros((1, p.shape[1]), dtype=np.float32) for p in coder.parts(x - c[own])] if len(x) else coder.words
    # Of the sample's neighbours, how far down the order of cells do they lie?
    asked = x[:: max(1, len(x) // 500)]
    s = asked @ x.T
    near = np.argsort(-s, axis=1)[:, 1 : k + 1]
    place = np.argsort(coder.cell(asked, len(c)), axis=1)
    at = np.sort(place[np.arange(len(asked))[:, None], own[near]].ravel())
    coder.probe = int(at[min(len(at) - 1, int(TARGET * len(at)))]) + 1 if len(at) else 1
    return coder


INDEX = "cell int, part int, id long, codes binary, v array<float>"


def index(vectors: DataFrame, key: str, vector: str, coder: Coder) -> DataFrame:
    """INDEX of every vector, written; parts are ranges of a hash, as many as the cell needs."""
    shared = vectors.sparkSession.sparkContext.broadcast(coder)  # bounded by the numbers of cells and words

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = unit(matrix(pdf.v))
                cell = shared.value.cell(x)[:, 0]
                codes = shared.value.codes(x, cell)
                yield pd.DataFrame({"cell": cell.astype(np.int32), "id": pdf.id, "codes": [r.tobytes() for r in codes], "v": list(x)})

    rows = vectors.where(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("v"))
    coded = _checkpoint(rows.mapInPandas(run, "cell int, id long, codes binary, v array<float>"))
    size = coded.groupBy("cell").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    return _checkpoint(coded.join(F.broadcast(size), "cell").select("cell", part.alias("part"), "id", "codes", "v"))  # a row a cell


def best_in_part(coder: Coder, cell: int, names: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, codes: np.ndarray, k: int) -> pd.DataFrame:
    """(query, other, score): the k best of each query among the vectors of a part, by approximate scores and then by exact ones of the best REFINE * k."""
    out, m = [], min(REFINE * k, len(ids))
    for lo in range(0, len(names), MEET_QUERIES):
        name, own = names[lo : lo + MEET_QUERIES], q[lo : lo + MEET_QUERIES]
        rough = coder.scores(own, cell, codes)
        rough[name[:, None] == ids[None, :]] = -np.inf
        best = np.argpartition(-rough, m - 1, axis=1)[:, :m]
        exact = np.einsum("qd,qmd->qm", own, x[best])
        exact[np.isneginf(np.take_along_axis(rough, best, axis=1))] = -np.inf
        order = np.lexsort((ids[best], -np.round(exact, 9)), axis=1)[:, :k]
        at, score = np.take_along_axis(best, order, axis=1), np.take_along_axis(exact, order, axis=1)
        out.append(pd.DataFrame({"query": np.repeat(name, at.shape[1]), "other": ids[at.ravel()], "score": score.ravel().astype(float)}))
    found = pd.concat(out)
    return found[found.score > -np.inf]


def search(indexed: DataFrame, coder: Coder, queries: DataFrame, k: int, key: str, vector: str, probe: int | None = None) -> DataFrame:
    """(query, other, score, rank) by cosine, itself excluded."""
    shared = indexed.sparkSession.sparkContext.broadcast(coder)
    probe = min(len(coder.cells), probe or coder.probe)

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in (b.iloc[lo : lo + ROWS] for b in batches for lo in range(0, len(b), ROWS)):
            if len(pdf):
                x = unit(matrix(pdf.v))
                cell = shared.value.cell(x, probe)
                yield pd.DataFrame({"cell": cell.ravel().astype(np.int32), "query": np.repeat(pdf.id.to_numpy(), probe), "q": list(np.repeat(x, probe, axis=0))})

    rows = queries.where(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("v"))
    asked = _checkpoint(rows.mapInPandas(near, "cell int, query long, q array<float>"))
    blocks = asked.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("blocks"))
    parts = indexed.groupBy("cell").agg((F.max("part") + 1).alias("parts"))
    plan = F.broadcast(_checkpoint(blocks.join(parts, "cell")))  # a row a cell
    left = indexed.join(plan, "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = asked.join(plan, "cell").withColumn("block", F.pmod(F.xxhash64("query"), F.col("blocks")).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def meet(group: tuple, items: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        if items.empty or qs.empty:
            return pd.DataFrame({"query": [], "other": [], "score": []})
        return best_in_part(shared.value, int(group[0]), qs["query"].to_numpy(), matrix(qs.q), items.id.to_numpy(), matrix(items.v), np.frombuffer(b"".join(items.codes), dtype=np.uint8).reshape(len(items), -1), k)

    by = ["cell", "part", "block"]
    found = left.select(*by, "id", "codes", "v").groupBy(*by).cogroup(right.select(*by, "query", "q").groupBy(*by)).applyInPandas(meet, "query long, other long, score double")
    return top_k(found, ["query"], [F.desc(F.round("score", 9)), F.asc("other")], k)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of the exact (query, other) that were found."""
    met = exact.join(found.select("query", "other").withColumn("_hit", F.lit(1)), ["query", "other"], "left")
    return met.agg(F.count("_hit") / F.count("*")).first()[0] or 0.0
