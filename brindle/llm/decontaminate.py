"""Benchmark decontamination by a distributed positional inverted index.

Build: every task cuts its documents into blocks of bounded size and writes, per block, the
postings of each term (a 64-bit hash of the word): all its positions in the block, in order.
Positions count words; between two documents lies a gap wider than any window, so that no
match crosses documents. Blocks are independent, so no key gathers and nothing is shuffled.

Search: the windows of the test items are taken in blocks of bounded size. In each index block a
window's terms are ordered from the rarest; a term without postings ends it. The rarest term's
list, less the term's offset, gives the possible starts, which are intersected with the other
offset-adjusted lists. The same intersection with a tolerance gives proximity matches: there is a start from
which each of the window's terms stands at most ``slop`` words from its place. Neither depends on how documents
are dealt to blocks.

Cases: a null or empty text has no words, and so no windows and no hits. A document of any length
is one block at least. Equal windows of several items are searched once. Items with the same id
count once; items without an id are left out of the id list, but their words are hit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum as tn
from .keyfilter import without
from .runtime import configure, stage

WINDOW = 10
SLOP = 2
#: Bytes of text in a block of the index, unless a single document is longer.
BLOCK_BYTES = 2 << 20
#: Bytes of benchmark text that are searched for at a time.
QUERY_BYTES = 4 << 20
GAP = 64
#: The writer holds a row group, and the vectorized reader decodes up to 4,096 rows of one at once: a block has a row group of its own,
#: so that neither holds more than one block, however many a task has.
ONE_BLOCK = {"parquet.block.row.count.limit": "1"}

INDEX = "block string, keys array<string>, first array<long>, n_words array<long>, terms array<long>, counts array<int>, positions array<int>"


def terms_of(t: tn.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each word."""
    low = tn.LOWER[t.buf]
    s, e, row = tn.spans(tn.Texts(low, t.start, t.end), tn.ALNUM)
    return tn.hashes(low, s, e), row


def postings(h: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms in order, how often each occurs, and their positions, term by term in order."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else np.zeros(0, dtype=np.int64)
    return s[new], np.diff(np.append(new, len(s))), pos[order]


def build_index(docs: DataFrame, key: str, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block: its documents (key, first position, words) and its terms with their postings."""
    configure(docs.sparkSession)

    def block(keys: list, t: tn.Texts) -> pa.RecordBatch:
        h, row = terms_of(t)
        n = np.bincount(row, minlength=len(t)).astype(np.int64)
        first = np.zeros(len(t), dtype=np.int64)
        np.cumsum(n[:-1] + GAP, out=first[1:])
        at = np.arange(len(h)) - (np.cumsum(n) - n)[row] + first[row]
        terms, counts, where = postings(h, at.astype(np.int32))
        one = lambda v, kind: pa.array([v], kind)
        return pa.RecordBatch.from_arrays(
            [one(hashlib.md5("\0".join(map(str, keys)).encode()).hexdigest(), pa.string()), one(keys, pa.list_(pa.string())), one(first, pa.list_(pa.int64())), one(n, pa.list_(pa.int64())), one(terms.view(np.int64), pa.list_(pa.int64())), one(counts.astype(np.int32), pa.list_(pa.int32())), one(where, pa.list_(pa.int32()))],
            names=["block", "keys", "first", "n_words", "terms", "counts", "positions"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, bufs, sizes, held = [], [], [], 0

        def out() -> pa.RecordBatch:
            end = np.cumsum(np.concatenate(sizes))
            return block(keys, tn.Texts(np.concatenate(bufs), end - np.concatenate(sizes), end))

        for batch in batches:
            names = batch.column(0).to_pylist()
            for i, j, t in tn.pieces(tn.texts(batch.column(1)), block_bytes):
                if held and held + len(t.buf) > block_bytes:
                    yield out()
                    keys, bufs, sizes, held = [], [], [], 0
                keys += names[i:j]
                bufs.append(t.buf)
                sizes.append(t.length)
                held += len(t.buf)
        if keys:
            yield out()

    return docs.select(docs[key].cast("string"), docs[text]).mapInArrow(run, INDEX)


class Windows:
    """Distinct windows of some items: the terms of each (0-padded), its length, and the items that have it."""

    def __init__(self, ids: list, t: tn.Texts, window: int = WINDOW):
        h, row = terms_of(t)
        n = np.bincount(row, minlength=len(t))
        at, _ = tn.grams(h, row, window)
        short = np.flatnonzero((n > 0) & (n < window))
        head = np.cumsum(n) - n
        start = np.concatenate([at, head[short]]).astype(np.int64)
        size = np.concatenate([np.full(len(at), window), n[short]]).astype(np.int64)
        item = np.concatenate([row[at], short]).astype(np.int64)
        grid = np.zeros((len(start), window), dtype=np.uint64)
        for j in range(window):
            on = j < size
            grid[on, j] = h[start[on] + j]
        key = np.concatenate([grid, size[:, None].astype(np.uint64)], axis=1)
        key, of = np.unique(key, axis=0, return_inverse=True) if len(key) else (key, np.zeros(0, dtype=np.int64))
        self.grid, self.size = key[:, :window], key[:, window].astype(np.int64)
        pair = np.unique(np.stack([of.ravel(), item], axis=1), axis=0) if len(item) else np.zeros((0, 2), dtype=np.int64)
        self.owner_at = np.searchsorted(pair[:, 0], np.arange(len(self.grid) + 1))
        self.owner = pair[:, 1]
        self.ids = ids
        self.terms = np.unique(np.concatenate([self.grid[self.size > j, j] for j in range(window)])) if len(self.grid) else np.zeros(0, dtype=np.uint64)

    def search(self, terms: np.ndarray, counts: np.ndarray, positions: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows, their start positions in a block, and where their rarest term stands; with slop, terms may stand that far from their places
        (the rarest one, too, so each of its places gives 2 * slop + 1 starts), and a start can lie before its document's first word."""
        none = np.zeros(0, dtype=np.int64)
        if not len(terms) or not len(self.grid):
            return none, none, none
        at = np.searchsorted(terms, self.terms)
        found = (at < len(terms)) & (terms[np.minimum(at, len(terms) - 1)] == self.terms)
        n = np.where(found, counts[np.minimum(at, len(terms) - 1)], 0)
        begin = np.cumsum(counts) - counts
        wide = int(positions.max()) + GAP + 1
        # The lists of the test terms as one ascending array: rank of the term * wide + position.
        mine = np.flatnonzero(n)
        own = np.repeat(mine, n[mine])
        place = np.arange(len(own)) - np.repeat(np.cumsum(n[mine]) - n[mine], n[mine])
        lists = own * wide + positions[begin[at[own]] + place]
        list_at = np.zeros(len(n) + 1, dtype=np.int64)
        np.cumsum(n, out=list_at[1:])

        on = np.arange(self.grid.shape[1]) < self.size[:, None]
        rank = np.where(on, np.searchsorted(self.terms, np.where(on, self.grid, self.terms[0])), 0)
        freq = np.where(on, n[rank], np.iinfo(np.int64).max)
        live = np.flatnonzero(freq.min(axis=1) > 0)
        hits_w, hits_p, hits_at = [], [], []
        # Bounded runs of windows by the length of their rarest lists.
        rarest = np.argsort(freq[live], axis=1, kind="stable")
        least = np.take_along_axis(freq[live], rarest[:, :1], axis=1)[:, 0]
        run = np.cumsum(least) // 500_000
        for r in np.unique(run):
            w = live[run == r]
            order = rarest[run == r]
            off = order[:, 0]
            k = n[rank[w, off]]
            who = np.repeat(np.arange(len(w)), k)
            place = np.arange(len(who)) - np.repeat(np.cumsum(k) - k, k)
            seat = lists[list_at[rank[w, off]][who] + place] % wide
            start = seat - off[who]
            if slop:
                shift = np.arange(-slop, slop + 1)
                who, seat, start = np.repeat(who, len(shift)), np.repeat(seat, len(shift)), (start[:, None] + shift).ravel()
            for j in range(1, self.grid.shape[1]):
                if not len(who):
                    break
                o = order[who, j]
                want = rank[w[who], o] * wide + start + o
                i = np.searchsorted(lists, want - slop)
                hit = (o >= self.size[w[who]]) | ((i < len(lists)) & (lists[np.minimum(i, len(lists) - 1)] <= want + slop))
                who, start, seat = who[hit], start[hit], seat[hit]
            hits_w.append(w[who])
            hits_p.append(start)
            hits_at.append(seat)
        return (np.concatenate(hits_w), np.concatenate(hits_p), np.concatenate(hits_at)) if hits_w else (none, none, none)


HITS = "key string, item string, near boolean, first array<int>, last array<int>"


def search_index(index: DataFrame, windows: Windows, slop: int = SLOP) -> DataFrame:
    """Matches of one block of test items: per document and item, the word ranges hit exactly (near false), or none (near true: proximity
    only). Without slop, exact ones only."""
    shared = index.sparkSession.sparkContext.broadcast(windows)  # bounded by QUERY_BYTES of text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        for batch in batches:
            for b in range(batch.num_rows):
                get = lambda c: batch.column(c)[b].values  # noqa: E731, B023
                terms = get("terms").to_numpy().view(np.uint64)
                if not len(terms):
                    continue
                counts, positions = get("counts").to_numpy().astype(np.int64), get("positions").to_numpy().astype(np.int64)
                first = get("first").to_numpy()
                keys = batch.column("keys")[b].as_py()
                seen: dict[tuple, list] = {}
                for near in (False, True) if slop else (False,):
                    w, p, seat = q.search(terms, counts, positions, slop if near else 0)
                    doc = np.searchsorted(first, seat, side="right") - 1
                    for x, d, s in zip(w.tolist(), doc.tolist(), (p - first[doc]).tolist(), strict=True):
                        for item in q.owner[q.owner_at[x] : q.owner_at[x + 1]].tolist():
                            if not near:
                                seen.setdefault((d, item), []).append((s, s + int(q.size[x])))
                            else:
                                seen.setdefault((d, item), [])
                if seen:
                    ranges = [sorted(set(v)) for v in seen.values()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([keys[d] for d, _ in seen], pa.string()), pa.array([q.ids[i] for _, i in seen], pa.string()), pa.array([not v for v in ranges]), pa.array([[a for a, _ in v] for v in ranges], pa.list_(pa.int32())), pa.array([[z for _, z in v] for v in ranges], pa.list_(pa.int32()))],
                        names=["key", "item", "near", "first", "last"],
                    )

    return index.mapInArrow(run, HITS)


def query_blocks(bench: DataFrame, item_id: str, text: str, window: int, query_bytes: int = QUERY_BYTES) -> Iterator[Windows]:
    """The test items in runs of at most query_bytes; the driver holds one run at a time."""
    ids, bodies, held = [], [], 0
    for x in bench.select(bench[item_id].cast("string").alias("i"), bench[text].alias("t")).toLocalIterator():
        ids.append(x.i)
        bodies.append(x.t)
        held += len((x.t or "").encode())
        if held >= query_bytes:
            yield Windows(ids, tn.texts(pa.array(bodies, pa.string())), window)
            ids, bodies, held = [], [], 0
    if ids:
        yield Windows(ids, tn.texts(pa.array(bodies, pa.string())), window)


def matches(docs: DataFrame, bench: DataFrame, key: str, item_id: str = "item_id", text: str = "text", bench_text: str = "text", window: int = WINDOW, slop: int = SLOP) -> tuple[DataFrame, DataFrame]:
    """The index of the documents, and the matches (HITS) of all items in it."""
    index = stage(build_index(docs, key, text), "postings", **ONE_BLOCK)
    hits = None
    for w in query_blocks(bench, item_id, bench_text, window):
        part = stage(search_index(index, w, slop), "hits")
        hits = part if hits is None else hits.unionByName(part)
    return index, docs.sparkSession.createDataFrame([], HITS) if hits is None else hits


def contamination(docs: DataFrame, bench: DataFrame, key: str, **options) -> DataFrame:
    """Per distinct key: n_words, n_hit, n_items, items_sha256, contaminated, n_near and near_items (items found by proximity only)."""
    index, hits = matches(docs, bench, key, **options)
    size = index.select(F.explode(F.arrays_zip("keys", "n_words")).alias("x")).select(F.col("x.keys").alias("key"), F.col("x.n_words").alias("n_words")).groupBy("key").agg(F.max("n_words").alias("n_words"))
    # Word ranges of a document, joined where they overlap: sorted by start, each adds what lies past the ends before it.
    ranges = F.array_sort(F.flatten(F.collect_set(F.arrays_zip("first", "last"))))
    step = lambda acc, x: F.struct((acc["n"] + F.greatest(F.lit(0), x["last"] - F.greatest(x["first"], acc["upto"])).cast("long")).alias("n"), F.greatest(acc["upto"], x["last"]).alias("upto"))
    exact = F.when(~F.col("near"), F.col("item"))
    # The item list of a document is as long as the benchmark has items with hits in it; its ranges are bounded by its words.
    per = hits.groupBy("key").agg(ranges.alias("r"), F.array_sort(F.collect_set(exact)).alias("items"), F.collect_set(F.when(F.col("near"), F.col("item"))).alias("near"))
    per = per.select("key", F.aggregate("r", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto")), step)["n"].alias("n_hit"), "items", F.array_sort(F.array_except("near", "items")).alias("near"))
    return size.join(per, "key", "left").select(
        "key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.when(F.col("near").isNull(), 0).otherwise(F.size("near")).cast("long").alias("n_near"),
        F.coalesce(F.array_join("near", ","), F.lit("")).alias("near_items"),
    )


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds _key: equal for rows with the same id and text only, so that repeated rows share their result."""
    return docs.withColumn("_key", F.concat_ws(":", F.coalesce(docs[doc_id].cast("string"), F.lit("-")), F.hex(F.xxhash64(docs[text]))))


def decontaminate(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", bench_text: str = "text") -> DataFrame:
    """The report of ``contamination`` for every row of docs, with doc_id."""
    own = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    rows = keyed(own)
    report = contamination(rows, bench, "_key", item_id=item_id, bench_text=bench_text)
    return rows.select("doc_id", "_key").join(report, F.col("_key") == F.col("key"), "left").drop("_key", "key")


def clean(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", bench_text: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents without an exact match, with their columns as they were. Texts are not exchanged, but for those of documents that are hit
    (and the few that pass the filter of keys by chance)."""
    spark = configure(docs.sparkSession)
    own = docs.columns
    plain = docs.select(*[docs[c].alias(f"_{i}") for i, c in enumerate(own)])
    rows = keyed(plain, f"_{own.index(doc_id)}", f"_{own.index(text)}")
    _, hits = matches(rows, bench, "_key", item_id, f"_{own.index(text)}", bench_text, window, 0)
    left = without(rows, stage(hits.select("key").distinct(), "hit"), "_key", "key")
    return left.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(own)])
