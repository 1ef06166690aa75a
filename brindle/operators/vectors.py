"""Vectors: hashed embeddings, similarity searches in blocks, centroids."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.functions.exprs import cosine, dot, normalized
from brindle.functions.text import md5_slot

from .graph import _checkpoint
from .ranking import top_k


def hash_embedding(docs: DataFrame, key: str, terms: Column, dim: int = 128) -> DataFrame:
    """(key, slot, value): signed counts of hashed tokens, L2-normalised; zeros left out."""
    slot, sign = md5_slot(F.col("t"), dim)
    t = docs.select(key, F.explode(terms).alias("t")).select(key, slot.alias("slot"), sign.alias("s")).groupBy(key, "slot").agg(F.sum("s").alias("v")).where("v != 0")
    length = t.groupBy(key).agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("len"))
    return t.join(length, key).select(key, "slot", (F.col("v") / F.col("len")).alias("value"))


def dense(sparse: DataFrame, key: str, dim: int = 128) -> DataFrame:
    """(key, vector) from (key, slot, value)."""
    m = sparse.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("slot", "value"))).alias("m"))
    return m.select(key, F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.coalesce(F.element_at("m", i), F.lit(0.0))).alias("vector"))


class Best:
    """The k best others of each query so far: by score, rounded to nine digits, and of equal ones by id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, 0), -np.inf)
        self.id = np.zeros((queries, 0), dtype=np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        """score: queries x items, -inf where there is no pair; ids ascending."""
        m = score.shape[1]
        # The place breaks ties: rounded scores are whole numbers here, the places a fraction below one.
        rank = np.round(score * 1e9) - np.arange(m) / (m + 1)
        top = np.argpartition(-rank, min(self.k, m) - 1, axis=1)[:, : self.k] if m else np.zeros((len(score), 0), dtype=np.int64)
        s = np.concatenate([self.score, np.take_along_axis(score, top, axis=1)], axis=1)
        i = np.concatenate([self.id, ids[top]], axis=1)
        order = np.lexsort((i, -np.round(s * 1e9)), axis=1)[:, : self.k]
        self.score, self.id = np.take_along_axis(s, order, axis=1), np.take_along_axis(i, order, axis=1)

    def frame(self, queries: np.ndarray) -> pd.DataFrame:
        q, j = np.nonzero(self.score > -np.inf)
        return pd.DataFrame({"query": queries[q], "other": self.id[q, j], "score": self.score[q, j]})


#: Queries of a block, items that meet one in a group, and items that are scored at a time; queries that share a group, though scored a block at a time.
QUERY_BLOCK, SHARD_ITEMS, ITEM_BLOCK = 2048, 20_000, 1024
GROUP_QUERIES = 8192
#: Groups at least, so that few items are shared by several tasks.
GROUPS = 16


def search_blocks(items: DataFrame, queries: DataFrame, k: int, prepare: Callable[[list], object], score: Callable[[object, object], np.ndarray], block: int, apart: bool = True, lay: Callable[[list], object] = list) -> DataFrame:
    """(query, other, score): items and queries have an id (long) and the columns that ``prepare`` and ``score`` use. Up to ``block`` queries are broadcast, and the items
    stream past where they are read. More queries are dealt to groups of GROUP_QUERIES and the items to shards by hashes of their ids; each such group meets each shard, ``block``
    queries at a time, in a task of bounded size, and nothing passes through the driver: each item is sent once for GROUP_QUERIES queries. k rows a query leave a task or a group. ``apart``: an item is none of its own neighbours.
    ``lay`` brings the columns of a block of items into the form that ``score`` reads, once for all queries of a group."""
    columns = items.columns[1:]

    def laid(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, object]]:
        for pdf in frames:
            pdf = pdf.sort_values("id")
            for lo in range(0, len(pdf), ITEM_BLOCK):
                part = pdf.iloc[lo : lo + ITEM_BLOCK]
                yield part["id"].to_numpy(), lay([part[c].tolist() for c in columns])

    def best_of(ids: np.ndarray, ready: object, items: Iterable[tuple[np.ndarray, object]]) -> pd.DataFrame:
        best = Best(len(ids), k)
        for own, part in items:
            s = score(ready, part)
            if apart:
                s[ids[:, None] == own[None, :]] = -np.inf
            best.add(s, own)
        return best.frame(ids)

    rows = queries.limit(block + 1).collect()
    if len(rows) <= block:
        ids = np.array([r[0] for r in rows], dtype=np.int64)
        shared = items.sparkSession.sparkContext.broadcast((ids, prepare([list(c) for c in zip(*[r[1:] for r in rows], strict=True)] if rows else [[]] * len(columns))))  # block rows

        def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            yield best_of(*shared.value, laid(batches))

        return items.mapInPandas(stream, "query long, other long, score double")

    n_items = items.count()
    blocks = -(-queries.count() // max(block, GROUP_QUERIES))
    shards = max(-(-n_items // SHARD_ITEMS), min(GROUPS // blocks, -(-n_items // ITEM_BLOCK)))
    deal = lambda df, own, other, n_own, n_other: df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n_own))).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_other - 1).cast("long"))))

    def meet(qs: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if qs.empty or own.empty:
            return pd.DataFrame({"query": [], "other": [], "score": []})
        parts = [qs.iloc[lo : lo + block] for lo in range(0, len(qs), block)]
        ready = list(laid(iter([own])))  # a shard
        return pd.concat([best_of(x["id"].to_numpy(), prepare([x[c].tolist() for c in columns]), ready) for x in parts])

    fresh = lambda df: df.select(*[F.col(c).alias(c) for c in df.columns])  # so that both sides can be told apart
    left, right = deal(fresh(queries), "_block", "_shard", blocks, shards), deal(fresh(items), "_shard", "_block", shards, blocks)
    return left.groupBy("_block", "_shard").cogroup(right.groupBy("_block", "_shard")).applyInPandas(meet, "query long, other long, score double")


def _flat(rows: list, kind: type) -> np.ndarray:
    return np.concatenate([np.asarray(r, dtype=kind) for r in rows]) if len(rows) else np.zeros(0, dtype=kind)


class Laid:
    """Sparse items: of each entry its item, its value, and its slot as a place in the sorted slots that they have."""

    def __init__(self, columns: list):
        slots, values = columns
        self.items = len(slots)
        self.start = np.append(0, np.cumsum([len(x) for x in slots])).astype(np.int64)
        self.item = np.repeat(np.arange(self.items), np.diff(self.start))
        self.slot, self.place = np.unique(_flat(slots, np.int64), return_inverse=True)
        self.value = _flat(values, np.float64)


#: Slots that this share of a block's queries have are multiplied as a dense matrix, so many at most; the others entry by entry.
DENSE_SHARE, DENSE_SLOTS = 0.05, 1024


class Postings:
    """An inverted index of sparse queries: per slot the queries that have it, and their values."""

    def __init__(self, columns: list):
        slots, values = columns
        self.queries = len(slots)
        slot, value = _flat(slots, np.int64), _flat(values, np.float64)
        order = np.argsort(slot, kind="stable")
        self.who = np.repeat(np.arange(len(slots)), [len(x) for x in slots])[order]
        self.value = value[order]
        self.slot, self.at = np.unique(slot[order], return_index=True)
        self.end = np.append(self.at[1:], len(order)).astype(np.int64)
        n = self.end - self.at
        often = np.flatnonzero(n >= max(2, DENSE_SHARE * self.queries))
        often = often[np.argsort(-n[often], kind="stable")[:DENSE_SLOTS]]
        self.column = np.full(len(self.slot), -1)
        self.column[often] = np.arange(len(often))
        at, shape = np.repeat(self.column, n), (self.queries, len(often))
        self.dense = np.bincount(self.who[at >= 0] * len(often) + at[at >= 0], weights=self.value[at >= 0], minlength=self.queries * len(often)).reshape(shape).astype(float)  # counts, if there are none
        self.held = np.zeros(shape)
        self.held[self.who[at >= 0], at[at >= 0]] = 1.0
        self.positive = bool((self.value > 0).all())

    def products(self, items: Laid | list) -> np.ndarray:
        """queries x items; -inf where no slot is shared."""
        y = items if isinstance(items, Laid) else Laid(items)
        if not len(self.slot) or not len(y.slot):
            return np.full((self.queries, y.items), -np.inf)
        k = np.minimum(np.searchsorted(self.slot, y.slot), len(self.slot) - 1)
        k = np.where(self.slot[k] == y.slot, k, -1)[y.place]
        column = np.where(k >= 0, self.column[k], -1)
        big = column >= 0
        width = self.dense.shape[1]
        m = np.bincount(y.item[big] * width + column[big], weights=y.value[big], minlength=y.items * width).reshape(y.items, width).astype(float)
        out = self.dense @ m.T
        # Sums of positive values tell by themselves whether a slot is shared.
        positive = self.positive and bool((y.value > 0).all())
        if not positive:
            m[y.item[big], column[big]] = 1.0
            met = self.held @ m.T
        rest = np.flatnonzero((k >= 0) & ~big)
        step = max(1, 4_000_000 // max(1, self.queries * 32))
        for lo in range(0, y.items, step):
            n = min(step, y.items - lo)
            e = rest[np.searchsorted(rest, y.start[lo]) : np.searchsorted(rest, y.start[lo + n])]
            size = self.end[k[e]] - self.at[k[e]]
            place = np.repeat(self.at[k[e]] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
            cell = self.who[place] * n + np.repeat(y.item[e] - lo, size)
            out[:, lo : lo + n] += np.bincount(cell, weights=self.value[place] * np.repeat(y.value[e], size), minlength=self.queries * n).reshape(self.queries, n)
            if not positive:
                met[:, lo : lo + n] += np.bincount(cell, minlength=self.queries * n).reshape(self.queries, n)
        out[(out if positive else met) <= 0] = -np.inf
        return out


def sparse_neighbours(sparse: DataFrame, key: str, k: int, queries: Column | None = None, block: int = QUERY_BLOCK, asked: DataFrame | None = None, eligible: DataFrame | None = None, members: DataFrame | None = None) -> DataFrame:
    """(key, other, score, rank): exact top k by dot product, itself excluded, among items that share a slot. sparse: key (a number), slot, value.
    ``queries`` says which items are asked for (all), or ``asked`` lists them; only items in ``eligible`` (all) are given. ``members`` (key, like): the items, each with the vector of
    the item ``like``, which is the smallest of its kind; then sparse has these only.

    Items with the same slots and values (to twelve digits) are one class: classes meet once, as in ``search_blocks``, and each gives its k + 1 smallest items, since of equal
    scores the smaller ids count. So the work grows with the square of the different vectors, not of the items."""
    slot = F.col("slot").cast("long") if sparse.schema["slot"].dataType.simpleString() in ("int", "bigint") else F.xxhash64("slot")
    x = F.sort_array(F.collect_list(F.struct("slot", "value")))  # a row of an item's slots
    lists = sparse.select(F.col(key).cast("long").alias("id"), slot.alias("slot"), F.col("value").cast("double").alias("value")).groupBy("id").agg(x.alias("x")).select("id", F.col("x.slot").alias("slots"), F.col("x.value").alias("values"))
    text = F.concat_ws(" ", F.col("slots").cast("array<string>"), F.transform("values", lambda v: F.round(v, 12).cast("string")))
    lists = _checkpoint(lists.withColumn("class", F.sha2(text, 256)))
    rows = lists.select("id", "class") if members is None else members.select(F.col(key).cast("long").alias("id"), F.col("like").cast("long").alias("_like")).join(lists.select(F.col("id").alias("_like"), "class"), "_like").select("id", "class")
    of = lambda df: df.select(F.col(key).cast("long").alias("id")).distinct()
    wanted = of(asked) if asked is not None else None if queries is None else of(sparse.where(queries))
    among = rows if eligible is None else rows.join(of(eligible), "id", "left_semi")
    own = (rows if wanted is None else rows.join(wanted, "id", "left_semi")).select("id", "class")
    shape = lists.groupBy("class").agg(F.min_by(F.struct("slots", "values"), "id").alias("v"))
    first = _checkpoint(among.groupBy("class").agg(F.min("id").alias("id")))
    named = _checkpoint(own.groupBy("class").agg(F.min("id").alias("id")))
    of_class = lambda df: df.join(shape, "class").select("id", "v.slots", "v.values")
    parts = search_blocks(_checkpoint(of_class(first)), _checkpoint(of_class(named)), k + 1, Postings, lambda q, y: q.products(y), block, apart=False, lay=Laid)
    best = [F.desc(F.round("score", 9)), F.asc("other")]
    near = top_k(parts, ["query"], best, k + 1).drop("rank").join(first.select(F.col("id").alias("other"), F.col("class").alias("of")), "other")
    few = top_k(among.select(F.col("class").alias("of"), F.col("id")), ["of"], [F.asc("id")], k + 1, "_r").select("of", "id")
    near = top_k(near.drop("other").join(few.withColumnRenamed("id", "other"), "of"), ["query"], best, k + 1)
    near = near.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("rank", "other", "score"))).alias("near")).join(named.withColumnRenamed("id", "query"), "query")  # k + 1 items
    left = F.slice(F.filter("near", lambda n: n["other"] != F.col("id")), 1, k)
    kind = sparse.schema[key].dataType
    out = own.join(near.select("class", "near"), "class").select("id", F.posexplode(left).alias("at", "n"))
    return out.select(F.col("id").cast(kind).alias(key), F.col("n.other").cast(kind).alias("other"), F.col("n.score").alias("score"), (F.col("at") + 1).alias("rank"))


def units(columns: list) -> np.ndarray:
    v = np.array(columns[0], dtype=np.float64) if len(columns[0]) else np.zeros((0, 1))
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def neighbours(items: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", block: int = QUERY_BLOCK) -> DataFrame:
    """(query, other, score, rank): exact top k by cosine of a stated set of queries among all items; see ``search_blocks``."""
    pick = lambda df: df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("v"))
    parts = search_blocks(pick(items), pick(queries), k, units, lambda q, x: q @ units(x).T, block)
    return top_k(parts, ["query"], [F.desc(F.round("score", 9)), F.asc("other")], k)


def mean_vector(df: DataFrame, vector: Column, by: list[str] | None = None) -> DataFrame:
    """Element-wise mean per group, as one array."""
    e = df.select(*(by or []), F.posexplode(vector).alias("i", "x")).groupBy(*(by or []), "i").agg(F.avg("x").alias("m"))
    return e.groupBy(*(by or [])).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("centroid"))


def lookalikes(items: DataFrame, seeds: DataFrame, key: str = "vec_id", vector: str = "embedding", trim: float = 0.1, least: float = 0.55, most: int | None = 50_000, min_seeds: int = 25) -> DataFrame:
    """(key, similarity, rank): items nearest to the seeds' centroid, after the seeds least like it are trimmed; the ``most`` nearest (None: all). Seeds: key."""
    n = seeds.count()
    if n < min_seeds:
        raise ValueError(f"{n} seeds, need {min_seeds}")
    unit = items.select(key, normalized(F.col(vector)).alias("u"))
    own = unit.join(seeds.select(key).distinct(), key, "left_semi")
    at = lambda df: F.broadcast(mean_vector(df, F.col("u")).select(normalized(F.col("centroid")).alias("c")))  # one row
    if trim > 0 and n >= 2 * min_seeds:
        s = own.join(at(own)).select(key, "u", dot(F.col("u"), F.col("c")).alias("sim"))
        edge = F.broadcast(s.agg(F.percentile("sim", F.lit(trim)).alias("edge")))  # one row
        own = s.join(edge).where(F.col("sim") >= F.col("edge") - 1e-12).select(key, "u")
    rest = unit.join(seeds.select(key), key, "left_anti").join(at(own))
    s = rest.select(key, dot(F.col("u"), F.col("c")).alias("similarity")).where(F.col("similarity") >= least)
    return s if most is None else s.orderBy(F.desc(F.round("similarity", 9)), key).limit(most)


def tfidf(docs: DataFrame, key: str, terms: Column, least: int = 2, share: float = 0.5, copies: str | None = None) -> DataFrame:
    """(key, term, weight): sublinear tf times smoothed idf, L2-normalised; rare and very common terms dropped. ``copies``: a column that says how many documents a row stands for."""
    each = F.col(copies) if copies else F.lit(1).cast("long")
    n = F.broadcast(docs.agg(F.sum(each).alias("n")))  # one row
    # Terms are made once, for the three uses of tf below.
    tf = _checkpoint(docs.select(key, each.alias("_each"), F.explode(terms).alias("term")).groupBy(key, "_each", "term").agg(F.count("*").alias("tf")))
    df = tf.groupBy("term").agg(F.sum("_each").alias("df")).join(n).where((F.col("df") >= least) & (F.col("df") <= share * F.col("n")))
    w = tf.join(df, "term").select(key, "term", ((1 + F.log("tf")) * (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1)).alias("w"))
    length = w.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("len"))
    return w.join(length, key).select(key, "term", (F.col("w") / F.col("len")).alias("weight"))


def tfidf_neighbours(weights: DataFrame, key: str, k: int, least: float = 0.08, queries: Column | None = None) -> DataFrame:
    return sparse_neighbours(weights.select(key, F.col("term").alias("slot"), F.col("weight").alias("value")), key, k, queries, 256).where(F.col("score") >= least)


def pair_cosine(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.withColumn("cosine", cosine(F.col(a), F.col(b)))
