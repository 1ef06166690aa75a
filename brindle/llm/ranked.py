"""Ranked lexical search: the three-phase uniform threshold algorithm (TPUT) over term-partitioned postings.

Index: documents are cut into terms in Arrow batches; what leaves a task is one row per document with its searched terms and their counts (a Bloom
filter of bounded size keeps other terms back, an exact join drops those that pass by chance). Postings
get their impact, an integer that depends on term and document only, and are written by ranges of (term, falling impact): a term's list
is read from its head, and a frequent term's list is cut over many tasks.

Search, for all items at once:
1. The first HEAD postings of each list give partial scores; the LOOK documents with the largest ones are looked up. The k-th best score is a lower bound of an item's k-th best.
2. Uniform threshold: a document whose score reaches the bound has the bound's m-th part in one of the item's m lists at least. Every list gives up
   its postings from the SHARE-th part of that on. They are sent by document, once for all items, and meet the items' terms there. What a list
   has not given up for a document is less than the threshold, and no more than the list's head; documents that can't reach the bound with that, or
   not the k-th best partial score, go.
3. For those left, what the lists have kept back is looked up, which makes their scores exact.

Scores are integers: log weights are floored, products are divided with the remainder dropped, so the order of summing doesn't show.

Cases: a null text has no terms, and a document without terms is none of the N. An item without terms has no rows. Repeated documents are ranked each for itself; repeated
items, also with equal ids, get their rows each. Equal scores go by document id (null last). Terms of any length are searched as they are. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textnum as tn
from .keyfilter import KeyFilter, key_filter
from .runtime import configure, shuffle_partitions, small, stage

K = 20
#: Postings from the head of each list, and documents of each item that are looked up for its lower bound.
HEAD = 100
LOOK = 2 * K
#: The uniform threshold is the bound over SHARE times the number of lists: with more than 1 the lists give up a few more postings, and the upper bounds
#: leave far fewer documents to be looked up.
SHARE = 4
#: Documents in a partition of the second phase.
PART_DOCS = 20_000



def cut_terms(t: tn.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes; start, end, row and hash of each term."""
    low = tn.LOWER[t.buf]
    s, e, row = tn.spans(tn.Texts(low, t.start, t.end), tn.ALNUM)
    return low, s, e, row, tn.hashes(low, s, e)


def strings(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> pa.Array:
    size = e - s
    off = np.zeros(len(s) + 1, dtype=np.int64)
    np.cumsum(size, out=off[1:])
    at = np.arange(off[-1]) - np.repeat(off[:-1] - s, size)
    return pa.Array.from_buffers(pa.large_string(), len(s), [None, pa.py_buffer(off.tobytes()), pa.py_buffer(buf[at].tobytes())]).cast(pa.string())


def counted(docs: DataFrame, wanted: KeyFilter | None, most: int = 1 << 20) -> DataFrame:
    """(r, n, terms, tfs, ...) of (r, text, ...): n, the number of terms with repeats, and the distinct terms (only those that pass ``wanted``) with their counts."""
    shared = None if wanted is None else docs.sparkSession.sparkContext.broadcast(wanted)  # bounded by keyfilter.MAX_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, j, t in tn.pieces(tn.texts(batch.column(1)), most):
                low, s, e, row, h = cut_terms(t)
                n = np.bincount(row, minlength=len(t))
                if shared is not None:
                    on = np.flatnonzero(shared.value.passes(h.view(np.int64), tn.mix(h).view(np.int64)))
                    s, e, row, h = s[on], e[on], row[on], h[on]
                o = np.lexsort((h, row))
                new = np.ones(len(o), dtype=bool)
                new[1:] = (row[o][1:] != row[o][:-1]) | (h[o][1:] != h[o][:-1])
                at = np.flatnonzero(new)
                tf = np.diff(np.append(at, len(o)))
                f = o[at]
                off = np.searchsorted(row[f], np.arange(len(t) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([ids[i:j], pa.array(n), pa.ListArray.from_arrays(off, strings(low, s[f], e[f])), pa.ListArray.from_arrays(off, pa.array(tf)), *[c[i:j] for c in batch.columns[2:]]], names=["r", "n", "terms", "tfs", *rest])

    rest = [c for c in docs.columns if c not in ("r", "text")]
    schema = docs.select(F.lit(0).cast("long").alias("r"), F.lit(0).cast("long").alias("n"), F.array().cast("array<string>").alias("terms"), F.array().cast("array<long>").alias("tfs"), *rest).schema
    return docs.select("r", "text", *rest).mapInArrow(run, schema)


def term_keys(terms: DataFrame) -> DataFrame:
    """(k1, k2) of a column of terms, as ``counted`` makes them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = tn.texts(batch.column(0))
            h = tn.hashes(t.buf, t.start, t.end)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(tn.mix(h).view(np.int64))], names=["k1", "k2"])

    return terms.mapInArrow(run, "k1 long, k2 long")


def postings(counts: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """The index: (term, r, s) of staged counts, by term and falling impact s; with ``terms`` (one column term), of these only."""
    t = counts.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    n_docs, n_terms = t[0], max(1, t[1] or 0)
    rows = counts.select("r", "n", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).select(F.col("x.terms").alias("term"), "r", "n", F.col("x.tfs").alias("tf"))
    df = rows.groupBy("term").agg(F.count("*").alias("df"))
    if terms is not None:
        df = stage(df, "frequencies").join(terms, "term", "left_semi")
    weight = F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double")))
    df = small(stage(df.select("term", weight.alias("w")), "weights"))
    # 25 * n * N leaves 64 bits for the longest documents of the largest corpora; those alone are divided as decimals.
    wide = F.expr(f"(25 * CAST(n AS DECIMAL(19, 0)) * CAST({n_docs} AS DECIMAL(15, 0))) div CAST({n_terms} AS DECIMAL(19, 0))").cast("long")
    share = F.when(F.col("n") <= (1 << 62) // (25 * max(1, n_docs)), F.expr(f"(25 * n * {n_docs}L) div {n_terms}L")).otherwise(wide)
    impact = F.expr("w * ((1000000000 * tf) div (1000 * tf + 12 * m))")
    lists = rows.join(df, "term").withColumn("m", 75 + share).select("term", "r", impact.alias("s"))
    order = ["term", F.desc("s"), "r"]
    return lists.repartitionByRange(*order).sortWithinPartitions(*order)


def item_terms(items: DataFrame, item_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(item, item_id) and (item, term, c): the items, numbered, and how often each has a term."""
    own = stage(items.select(F.monotonically_increasing_id().alias("r"), items[item_id].alias("item_id"), items[text].alias("text")), "items")
    terms = counted(own.select("r", "text"), None).select(F.col("r").alias("item"), F.explode(F.arrays_zip("terms", "tfs")).alias("x"))
    return own.select(F.col("r").alias("item"), "item_id"), stage(terms.select("item", F.col("x.terms").alias("term"), F.col("x.tfs").alias("c")), "terms")


def top(scores: DataFrame, k: int, by: str, *ties: Column) -> DataFrame:
    w = Window.partitionBy("item").orderBy(F.desc(by), *ties)
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def entries(lists: DataFrame, pairs: DataFrame, asked: DataFrame, which: Column | bool = True) -> DataFrame:
    """(item, r, add) from all lists, for the written pairs (item, r): lists are cut to the pairs' documents first, and not exchanged while those are few."""
    docs = stage(pairs.select("r").distinct(), "documents")
    own = lists.join(small(docs), "r", "left_semi").join(small(asked), "term").withColumn("add", F.col("c") * F.col("s")).where(F.lit(which) if isinstance(which, bool) else which)
    return own.select("item", "r", "add").join(small(pairs.select("item", "r")), ["item", "r"])


def kth(scores: DataFrame, k: int, by: str, alias: str) -> DataFrame:
    """(item, alias): the k-th best of an item that has as many."""
    return top(scores, k, by).where(F.col("rank") == k).select("item", F.col(by).alias(alias))


def tput(lists: DataFrame, terms: DataFrame, n_docs: int, k: int = K, head: int = HEAD, look: int = LOOK) -> DataFrame:
    """(item, r, score): a set that holds the k best of each item, by any order of ties. lists: the written index; terms: (item, term, c)."""
    first = Window.partitionBy("term").orderBy(F.desc("s"), "r")
    heads = stage(lists.where("s > 0").withColumn("i", F.row_number().over(first)).where(F.col("i") <= max(k, head)), "heads")
    # Lists without a posting above 0 add nothing.
    asked = stage(terms.join(heads.groupBy("term").agg(F.max("s").alias("most")), "term"), "asked")
    partial = heads.join(small(asked), "term").groupBy("item", "r").agg(F.sum(F.col("c") * F.col("s")).alias("score"))
    looked = stage(top(partial, max(k, look), "score", F.col("r").asc()).select("item", "r"), "looked")
    low = stage(kth(entries(lists, looked, asked).groupBy("item", "r").agg(F.sum("add").alias("score")), k, "score", "low"), "bounds")
    # The least a posting must add, and the most that a list hides below that.
    m = terms.groupBy("item").agg(F.count("*").alias("m"))
    need = F.greatest(F.lit(1), F.expr(f"(coalesce(low, 0) + {SHARE} * m - 1) div ({SHARE} * m)"))
    asked = asked.join(m, "item").join(low, "item", "left").withColumn("need", need).withColumn("hidden", F.least(F.col("c") * F.col("most"), F.col("need") - 1))
    asked = stage(asked.select("item", "term", "c", "need", "hidden", F.coalesce("low", F.lit(0)).alias("low"), F.sum("hidden").over(Window.partitionBy("item")).alias("all")), "asked")
    least = stage(asked.groupBy("term").agg(F.min(F.expr("(need + c - 1) div c")).alias("least")), "least")
    given = lists.join(small(least), "term").where("s >= least").select("term", "r", "s").repartition(shuffle_partitions(lists.sparkSession, n_docs, PART_DOCS), "r")
    met = given.join(small(asked), "term").withColumn("add", F.col("c") * F.col("s")).where("add >= need")
    sums = met.groupBy("item", "r").agg(F.sum("add").alias("partial"), F.sum("hidden").alias("shown"), F.first("all").alias("all"), F.first("low").alias("low"))
    left = stage(sums.withColumn("upper", F.col("partial") + F.col("all") - F.col("shown")).where("upper >= low").select("item", "r", "partial", "upper"), "candidates")
    second = stage(kth(left, k, "partial", "second"), "bounds")
    left = stage(left.join(small(second), "item", "left").where("second is null or upper >= second").select("item", "r", "partial"), "left")
    # What is missing of an exact score are the postings that the lists have kept back.
    more = entries(lists, left, asked, F.col("add") < F.col("need")).groupBy("item", "r").agg(F.sum("add").alias("more"))
    return left.join(more, ["item", "r"], "left").select("item", "r", (F.col("partial") + F.coalesce("more", F.lit(0))).alias("score"))


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item with a score above 0."""
    configure(docs.sparkSession)
    named, terms = item_terms(items, item_id, item_text)
    words = stage(terms.select("term").distinct(), "searched")
    own = docs.select(F.monotonically_increasing_id().alias("r"), docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    counts = stage(counted(own, key_filter(term_keys(words))), "counts")
    ids = counts.select("r", "doc_id")
    lists = stage(postings(counts, words), "postings")
    scores = tput(lists, terms, ids.count(), k).where("score > 0").join(ids, "r")
    return top(scores, k, "score", F.col("doc_id").asc_nulls_last()).join(named, "item").select("item_id", "rank", "doc_id", "score")


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(docs, items)
