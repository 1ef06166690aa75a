"""Exact top-k search by inner product: no-random-access aggregation (NRA) over sorted lists.

Index: items are dealt into blocks of bounded size. A block has one list per component, sorted by value; since a score is the sum of
q_d * x_d, a query reads list d from its large end where q_d > 0 and from its small end where q_d < 0, so contributions never rise along
a list. Lists with q_d = 0 add nothing and are not read.

Search: for each block and query, all lists are read in step, some further part of each a round. What an item has shown so far plus the last contribution read of
each list that has not shown it bounds its score from above; with the list's other end it is bounded from below. Once no more items than RESOLVE of
the block can still reach the k-th best lower bound, the others are outsiders that can't qualify; reading stops and the final scores of those left are resolved in exact integers. A first search over a
sample of items (one in SAMPLE, by a hash) gives every query a floor, so that blocks without good items are left early. The floor only saves reading:
every item of every block is judged.

Queries meet items block by block (an equi-join on shards of the items); no pair of a query and an item leaves a task unless it is among the best k of its block.

Cases: vectors that are null or hold a null or non-finite component take no part. Only items of the query's length are its candidates. A query is not
its own candidate, but a repeated row with the same id is. Ties go to the smaller id (a null id last). An empty table
gives an empty result. A score that may not fit in 64 bits raises OverflowError. Columns other than id and vector are ignored.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import configure, shuffle_partitions, stage

K = 10
#: Items and components in a block, at most (one item at least).
BLOCK_ITEMS = 8192
BLOCK_CELLS = 1 << 20
#: Queries in a block.
BLOCK_QUERIES = 512
#: One item in SAMPLE is searched first for floors.
SAMPLE = 16
#: How far every list is read after each round.
DEPTHS = (0.45, 0.6, 0.75, 1.0)
#: Reading stops when this part of a block is left.
RESOLVE = 0.125
#: Query blocks whose floors a task keeps from one item block to the next.
KEPT = 256

ROWS = "array<long>"
BLOCKS = f"block string, dims int, rows {ROWS}, places array<int>, vals array<long>"
QUERIES = f"qblock string, qdims int, qrows {ROWS}, q array<long>, floors array<long>"
FOUND = "q long, r long, score long"
NONE = -(1 << 62)


class Block:
    """Items of a block: ``rows`` their row numbers in order of their ids; ``places`` and ``vals`` the lists (dims x n), ascending."""

    def __init__(self, rows: np.ndarray, places: np.ndarray, vals: np.ndarray, dims: int):
        self.rows, self.dims, n = rows, dims, len(rows)
        self.places, self.exact = places.reshape(dims, n).astype(np.int64), vals.reshape(dims, n)
        self.vals = self.exact.astype(np.float64)
        self.seat = self.places + np.arange(dims)[:, None] * n
        self.items = np.empty((dims, n), dtype=np.int64)
        self.items.ravel()[self.seat.ravel()] = self.exact.ravel()
        self.most = np.abs(self.vals[:, [0, -1]]).max(axis=1) if dims else np.zeros(0)

    def search(self, q: np.ndarray, floor: int, k: int, depths: tuple[float, ...] = DEPTHS) -> tuple[np.ndarray, np.ndarray, int]:
        """(positions, scores, entries read): items with a score of floor or more that can be among the best k. All of the best k are, unless they are below the floor."""
        n, wide = len(self.rows), float(np.abs(q).astype(np.float64) @ self.most)
        if wide >= 2.0**63:
            raise OverflowError("an inner product may not fit in 64 bits")
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        lists = np.concatenate([up, down])
        alive, read = np.arange(n), 0
        if len(lists):
            w = q[lists].astype(np.float64)[:, None]
            end = lambda i: np.concatenate([self.vals[up, n - 1 - i], self.vals[down, i]]) * w[:, 0]  # noqa: E731  contribution of the i-th entry of each list
            slack = 1e-5 * wide + 1
            score, seen, least, a = np.zeros(n), np.zeros((len(lists), n), dtype=np.float32), end(n - 1), 0
            for depth in depths:
                b = min(n, max(a + 1, int(np.ceil(depth * n))))
                cut = lambda x: np.concatenate([x[up, n - b : n - a], x[down, a:b]])  # noqa: B023, E731
                at = cut(self.places)
                score += np.bincount(at.ravel(), weights=(cut(self.vals) * w).ravel(), minlength=n)
                seen[np.arange(len(lists))[:, None], at] = 1
                read, a, last = read + at.size, b, end(b - 1)
                # What the lists that have not shown an item can add, at most and at least.
                more, less = np.stack([last, least]).astype(np.float32) @ seen
                best = max(float(floor), self.kth(score + (least.sum() - less) - slack, k))
                alive = np.flatnonzero(score + (last.sum() - more) + slack >= best)
                if b == n or len(alive) <= max(k, RESOLVE * n):
                    break
        final = q @ self.items[:, alive] if self.dims else np.zeros(len(alive), dtype=np.int64)
        keep = final >= floor
        return alive[keep], final[keep], read

    @staticmethod
    def kth(x: np.ndarray, k: int) -> float:
        return float(np.partition(x, len(x) - k)[len(x) - k]) if len(x) >= k else -np.inf


def best(at: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k by falling score, then position (which follows the ids)."""
    o = np.lexsort((at, -score))[:k]
    return at[o], score[o]


def integers(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(r, id, v): the row's number, its id, and floor(scale * x) of each component as a double; rows that take no part are left out."""
    x = vectors.select(F.monotonically_increasing_id().alias("r"), vectors[vec_id].alias("id"), vectors[vector].alias("v"))
    fine = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    return x.where(F.col("v").isNotNull() & F.coalesce(fine, F.lit(False))).withColumn("v", F.transform("v", lambda e: F.floor(F.lit(float(scale)) * e.cast("double"))))


def runs(batches: Iterator[pa.RecordBatch], rows: int, cells: int) -> Iterator[tuple[list, np.ndarray]]:
    """Runs of rows with vectors of one length, of at most ``rows`` rows and ``cells`` components: the other columns, and the matrix."""
    held, mats, size = [], [], 0
    for batch in batches:
        v = batch.column("v")
        at, flat = v.offsets.to_numpy().astype(np.int64), v.values.to_numpy().astype(np.int64)
        n = np.diff(at)
        others = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != "v"]
        i = 0
        while i < len(n):
            d = int(n[i])
            most = max(1, min(rows, cells // max(1, d)))
            if mats and (mats[0].shape[1] != d or size >= most):
                yield [np.concatenate(c) for c in zip(*held, strict=True)], np.concatenate(mats)
                held, mats, size = [], [], 0
            j = i + 1
            while j < len(n) and n[j] == d and size + j - i < most:
                j += 1
            held.append([c[i:j].to_numpy(zero_copy_only=False) for c in others])
            mats.append(flat[at[i] : at[j]].reshape(j - i, d))
            size, i = size + j - i, j
    if mats:
        yield [np.concatenate(c) for c in zip(*held, strict=True)], np.concatenate(mats)


def digest(rows: np.ndarray) -> str:
    return hashlib.md5(rows.tobytes()).hexdigest()


def one(v: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array([v], pa.list_(kind))


def item_blocks(rows: DataFrame) -> DataFrame:
    """BLOCKS of (r, id, v): inside a block, positions follow the ids."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (r,), x in runs(batches, BLOCK_ITEMS, BLOCK_CELLS):
            o = np.argsort(x, axis=0, kind="stable").T
            vals = np.take_along_axis(x.T, o, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array([digest(r)]), pa.array([x.shape[1]], pa.int32()), one(r, pa.int64()), one(o.ravel().astype(np.int32), pa.int32()), one(vals.ravel(), pa.int64())], names=["block", "dims", "rows", "places", "vals"])

    return rows.sortWithinPartitions(F.size("v"), F.col("id").asc_nulls_last()).select("r", "v").mapInArrow(build, BLOCKS)


def query_blocks(rows: DataFrame, n: int) -> DataFrame:
    """QUERIES of (r, v, floor), n rows in all."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (r, floor), x in runs(batches, BLOCK_QUERIES, BLOCK_CELLS):
            yield pa.RecordBatch.from_arrays([pa.array([digest(r)]), pa.array([x.shape[1]], pa.int32()), one(r, pa.int64()), one(x.ravel(), pa.int64()), one(floor, pa.int64())], names=["qblock", "qdims", "qrows", "q", "floors"])

    return rows.select("r", "floor", "v").repartition(-(-n // BLOCK_QUERIES), "r").sortWithinPartitions(F.size("v"), "r").mapInArrow(build, QUERIES)


def scan(items: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """FOUND: the best k of each item block for each query that are not below its floor. items, queries: staged blocks."""
    shards = shuffle_partitions(items.sparkSession, items.count(), 64)
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("block"), F.lit(shards)))
    asked = queries.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    # The queries are one copy a shard here, which Spark's estimate leaves out: broadcast, all copies would go through the driver.
    met = dealt.join(asked.hint("merge"), (dealt.shard == asked.shard) & (F.col("dims") == F.col("qdims"))).select("block", "dims", "rows", "places", "vals", "qblock", "qrows", "q", "floors")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raised: OrderedDict[str, np.ndarray] = OrderedDict()
        last, block = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda c: batch.column(c)[i].values.to_numpy()  # noqa: B023, E731
                if last != (name := batch.column("block")[i].as_py()):
                    last, block = name, Block(get("rows"), get("places"), get("vals"), batch.column("dims")[i].as_py())
                qblock, qrows = batch.column("qblock")[i].as_py(), get("qrows")
                q = get("q").reshape(len(qrows), block.dims)
                floors = raised.pop(qblock) if qblock in raised else get("floors").copy()
                raised[qblock] = floors
                if len(raised) > KEPT:
                    raised.popitem(last=False)
                out = []
                for j in range(len(qrows)):
                    at, score, _ = block.search(q[j], int(floors[j]), k + 1)  # the query itself can be one of them
                    other = block.rows[at] != qrows[j]
                    at, score = best(at[other], score[other], k)
                    if len(at) == k:
                        floors[j] = max(floors[j], score[-1])
                    out.append((np.full(len(at), qrows[j]), block.rows[at], score))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out, strict=True)], names=["q", "r", "score"])

    return met.mapInArrow(search, FOUND)


def first(found: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k of each query, with rank."""
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = K, scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest integer inner product with each row of which ``is_query``, a condition on the column ``id``, holds."""
    configure(vectors.sparkSession)
    rows = stage(integers(vectors, vec_id, vector, scale), "vectors")
    asked = stage(rows.where(is_query), "queries")
    n = asked.count()
    kind = rows.schema["id"].dataType
    if not n:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("score")).limit(0)
    sample = stage(item_blocks(rows.where(F.pmod(F.xxhash64("r"), F.lit(SAMPLE)) == 0).repartition(shuffle_partitions(rows.sparkSession, n, BLOCK_ITEMS))), "sample")
    start = asked.withColumn("floor", F.lit(NONE).cast("long"))
    early = stage(scan(sample, stage(query_blocks(start, n), "asked"), k), "early")
    # Of k different items, the lowest score is a floor.
    floors = first(early, k, F.desc("score")).groupBy("q").agg(F.min("score").alias("floor"), F.count("*").alias("c")).where(F.col("c") == k)
    start = asked.join(floors.drop("c"), asked.r == F.col("q"), "left").select("r", "v", F.coalesce("floor", F.lit(NONE)).alias("floor"))
    found = stage(scan(stage(item_blocks(rows), "blocks"), stage(query_blocks(start, n), "asked"), k), "found")
    ids = rows.select("r", F.col("id").alias("vec_id"))
    ranked = first(found.join(ids, "r"), k, F.desc("score"), F.col("vec_id").asc_nulls_last())
    mine = asked.select(F.col("r").alias("q"), F.col("id").cast(kind).alias("query_id"))
    return ranked.join(mine, "q").select("query_id", "rank", "vec_id", "score")


def report(vectors: DataFrame) -> DataFrame:
    """Queries are the rows whose id is divisible by 100."""
    return search(vectors, F.col("id") % 100 == 0)
