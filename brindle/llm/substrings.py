"""Removal of every byte string of WINDOW bytes that also starts anywhere else, by a hash-compared suffix sort.

Only suffixes at anchors are sorted. The anchor of a window is the leftmost of its KGRAM-byte strings with the
smallest hash, so that equal windows have their anchors at the same place, and one anchor stands for a
run of neighbouring windows. Everything that decides these windows lies in the anchor's context, the bytes from
WINDOW - KGRAM before it to WINDOW after it.

1. Anchors of all documents: hash of the KGRAM bytes, hash of the context (together 128 bits that identify the
   context), place, and run of window starts.
2. A context found twice or more settles all its windows. Counting is a partial aggregate, so thousands of copies are one row early. The
   bytes of all these contexts are compared (``agreed``); if two hashes are equal and the bytes are not, all is done again with other hashes.
3. What is left are different contexts around an equal KGRAM: the edges of repeated passages. One copy of each
   is cut from its document and they meet by KGRAM. In a group the suffixes at the anchors are merge-sorted;
   two suffixes are compared by a binary search over prefix polynomial hashes for their common extension. The
   sorted order with the common extensions of neighbours gives, for each distance d of a window's start from the
   anchor, the runs that agree in the WINDOW - d bytes from the anchor on; those that also agree in the d bytes
   before it (hash, then the bytes) are equal windows. Extensions found by hashes are checked on the bytes; on a collision another base is drawn.
   A group of more than HOT contexts is dealt again (``split``): each quarter of the distances d has a core, the bytes that all its
   windows share, and contexts with different cores can't have equal windows there. Quarters are quartered until their groups are small
   or their cores are the windows themselves; those are compared as bytes by an aggregate.
4. The runs go back to all anchors with that context, and each document drops the bytes that its windows cover.

Cases: null and empty texts, and texts shorter than WINDOW, keep all bytes. Rows that are equal in id and text are
copies of each other like any others. A very long text is processed in overlapping slices, which meet again at
their joints. Ids of any type stay as they are. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textnum as tn
from .keyfilter import key_filter
from .runtime import configure, shuffle_partitions, stage

U64 = np.uint64
WINDOW = 400
#: Long enough that common phrases are not shared, so that groups are copies of passages.
KGRAM = 96
LEFT = WINDOW - KGRAM
SLICE = 1 << 19
#: Distinct contexts of one KGRAM that are sorted in one task.
HOT = 8192
#: Contexts sorted together.
CHUNK = 4096
PER_TASK = 20_000
#: KGRAMs with more contexts than this are dealt by context, too.
SPREAD = 1000
SALTS = 64


class Collision(Exception):
    """Two different byte strings with equal hashes."""


#: Of bytes and a seed, 64 bits.
Hash = Callable[[bytes, int], int]


def content_hash(data: bytes, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(data, seed)


class Polynomial:
    """Prefix polynomial hashes modulo 2**64 with an odd base drawn from a seed."""

    def __init__(self, seed: int):
        self.byte = tn.stream(256, 1000 + seed)
        self.base = tn.stream(1, 2000 + seed)[0] | U64(5)
        self._pow = np.ones(1, dtype=U64)

    def powers(self, n: int) -> np.ndarray:
        if n > len(self._pow):
            self._pow = np.multiply.accumulate(np.concatenate([np.ones(1, dtype=U64), np.full(n, self.base, dtype=U64)]))
        return self._pow[:n]

    def inverse(self, n: int) -> np.ndarray:
        b = U64(pow(int(self.base), -1, 1 << 64))
        if n > len(getattr(self, "_inv", ())):
            self._inv = np.multiply.accumulate(np.concatenate([np.ones(1, dtype=U64), np.full(n, b, dtype=U64)]))
        return self._inv[:n]

    def prefixes(self, x: np.ndarray) -> np.ndarray:
        """Along the last axis; element i hashes the first i bytes."""
        out = np.zeros((*x.shape[:-1], x.shape[-1] + 1), dtype=U64)
        np.cumsum(self.byte[x] * self.powers(x.shape[-1]), axis=-1, out=out[..., 1:])
        return out


_roll = Polynomial(0)


def anchors_of(t: tn.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all windows inside the rows: place, first and last window start of each."""
    n = len(t.buf)
    long = t.length >= WINDOW
    none = np.zeros(0, dtype=np.int64)
    if not long.any():
        return none, none, none
    p = _roll.prefixes(t.buf)
    g = tn.mix((p[KGRAM:] - p[:-KGRAM]) * _roll.inverse(n - KGRAM + 1))
    # The place in the low bits makes the leftmost of equal ones the smallest.
    low = U64((1 << 21) - 1)
    g = (g & ~low) | np.arange(len(g), dtype=U64)
    w = LEFT + 1
    pad = np.concatenate([g, np.full(-len(g) % w, ~U64(0))]).reshape(-1, w)
    head = np.minimum.accumulate(pad, axis=1).ravel()
    tail = np.minimum.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
    at = (np.minimum(tail[: n - WINDOW + 1], head[w - 1 : len(g)]) & low).astype(np.int64)
    d = np.zeros(n + 1, dtype=np.int32)
    d[t.start[long]] += 1
    d[t.end[long] - WINDOW + 1] -= 1
    s = np.flatnonzero(np.cumsum(d[: n - WINDOW + 1]))
    at = at[s]
    new = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    return at[new], s[new], s[np.append(new[1:], len(s)) - 1]


def anchors_sliced(t: tn.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for a single row of any length."""
    parts = []
    for x in range(0, max(1, len(t.buf) - WINDOW + 1), SLICE):
        b = t.buf[x : x + SLICE + WINDOW - 1]
        parts.append([v + x for v in anchors_of(tn.Texts(b, np.zeros(1, dtype=np.int64), np.array([len(b)])))])
    a, s0, s1 = (np.concatenate(v) for v in zip(*parts, strict=True))
    new = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, dtype=np.int64)
    return a[new], s0[new], s1[np.append(new[1:], len(a)) - 1] if len(a) else s1


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text, k1, k2); rows with the same k1, k2 are equal in id and text."""
    x = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    return x.withColumn("k1", F.xxhash64("doc_id")).withColumn("k2", F.xxhash64("text"))


def anchors(rows: DataFrame, hash_: Hash, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
            for i, _, t in tn.pieces(tn.texts(batch.column("text")), SLICE):
                a, s0, s1 = anchors_of(t) if len(t.buf) <= SLICE else anchors_sliced(t)
                if not len(a):
                    continue
                row = t.row_of(a)
                data = t.buf.tobytes()
                left = np.maximum(a - LEFT, t.start[row])
                kg = np.fromiter((hash_(data[x : x + KGRAM], seed) for x in a.tolist()), dtype=U64, count=len(a))
                ctx = np.fromiter((hash_(data[x:y], seed + 1) for x, y in zip(left.tolist(), np.minimum(a + WINDOW, t.end[row]).tolist(), strict=True)), dtype=U64, count=len(a))
                ctx = tn.mix(ctx + (a - left).astype(U64) * U64(0x9E3779B97F4A7C15))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1[i + row]), pa.array(k2[i + row]), pa.array(kg.view(np.int64)), pa.array(ctx.view(np.int64)), pa.array((a - t.start[row]).astype(np.int32)), pa.array((a - s1).astype(np.int32)), pa.array((a - s0).astype(np.int32))],
                    names=["k1", "k2", "kg", "ctx", "at", "d0", "d1"],
                )

    return rows.select("k1", "k2", "text").mapInArrow(run, "k1 long, k2 long, kg long, ctx long, at int, d0 int, d1 int")


PACKED = T.StructType().add("k1", "long").add("k2", "long").add("packed", "binary").fields


def packed(rows: DataFrame, shared) -> DataFrame:
    """(doc_id, k1, k2, packed) of the rows whose keys pass the filter: the bytes of the texts, compressed before they are exchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            own = batch.filter(pa.array(shared.value.passes(batch.column("k1").to_numpy(), batch.column("k2").to_numpy())))
            body = pa.array([z.compress(x.as_buffer()) for x in own.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([*own.columns[:3], body], names=["doc_id", "k1", "k2", "packed"])

    chosen = rows.select("doc_id", "k1", "k2", "text")
    return chosen.mapInArrow(run, T.StructType([chosen.schema["doc_id"], *PACKED]))


CONTEXT = "kg long, ctx long, d0 int, d1 int, m long, before int, bytes binary"
CONTEXT_NAMES = ["kg", "ctx", "d0", "d1", "m", "before", "bytes"]
CONTEXT_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
#: Bytes of contexts that a task remembers to leave out equal ones.
REMEMBER = 64 << 20


def contexts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted: (kg, ctx, d0, d1, m, k1, k2, at). The bytes of these contexts, and how many of them stand before the anchor; a task gives equal ones
    once (again, when it has seen REMEMBER bytes of others)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        seen: set[tuple[int, int, int, bytes]] = set()
        held = 0
        for batch in batches:
            out: list[tuple] = []
            for body, own in zip(batch.column("packed"), batch.column("wanted"), strict=True):
                data = z.decompress(body.as_buffer())
                for kg, ctx, d0, d1, m, at in zip(*(own.values.field(c).to_pylist() for c in ("kg", "ctx", "d0", "d1", "m", "at")), strict=True):
                    left = max(0, at - LEFT)
                    key = kg, ctx, at - left, data[left : at + WINDOW]
                    if key not in seen:
                        if held > REMEMBER:
                            seen, held = set(), 0
                        seen.add(key)
                        held += len(key[3]) + 150
                        out.append((kg, ctx, d0, d1, m, *key[2:]))
            for i in range(0, len(out), 2000):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out[i : i + 2000], strict=True), CONTEXT_KINDS, strict=True)], names=CONTEXT_NAMES)

    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("kg", "ctx", "d0", "d1", "m", "at")).alias("wanted"))  # bounded by the text's length
    shared = rows.sparkSession.sparkContext.broadcast(key_filter(wanted.select("k1", "k2").distinct()))  # bounded by MAX_BITS
    joined = packed(rows, shared).drop("doc_id").join(lists, ["k1", "k2"])
    return joined.select("packed", "wanted").mapInArrow(run, CONTEXT)


def agreed(ctxs: DataFrame) -> DataFrame:
    """One row for each (kg, ctx) that others share the KGRAM with (m > 1). Raises Collision if any (kg, ctx) stands for different bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, clash = None, False
        for batch in batches:  # sorted by kg, ctx: equal contexts follow one another
            keep = []
            for i, (m, *now) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("m", "kg", "ctx", "before", "bytes")), strict=True)):
                if last is None or now[:2] != last[:2]:
                    if m > 1:
                        keep.append(i)
                elif now[2:] != last[2:]:
                    clash = True
                last = now
            if keep:
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(keep)).columns, pa.array([False] * len(keep))], names=[*CONTEXT_NAMES, "clash"])
        if clash:
            yield pa.RecordBatch.from_arrays([*(pa.array([b"" if k == pa.binary() else 0], k) for k in CONTEXT_KINDS), pa.array([True])], names=[*CONTEXT_NAMES, "clash"])

    # A (kg, ctx) has no more rows here than there were tasks before.
    one = stage(ctxs.repartition("kg", "ctx").sortWithinPartitions("kg", "ctx").mapInArrow(run, CONTEXT + ", clash boolean"), "contexts")
    if not one.where("clash").isEmpty():
        raise Collision
    return one.drop("clash")


class Contexts:
    """Contexts as rows of a matrix with the anchor in column LEFT."""

    def __init__(self, group: np.ndarray, before: np.ndarray, data: list[bytes]):
        m = len(data)
        size = np.array([len(x) for x in data], dtype=np.int64)
        self.group, self.before, self.after = group, before.astype(np.int64), size - before
        self.x = np.zeros((m, LEFT + WINDOW), dtype=np.uint8)
        flat = np.frombuffer(b"".join(data), dtype=np.uint8)
        k = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        self.x[np.repeat(np.arange(m), size), k + np.repeat(LEFT - self.before, size)] = flat
        self.draw(0)

    def draw(self, seed: int) -> None:
        self.p = Polynomial(seed).prefixes(self.x)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common extension of the suffixes at the anchors of i and j: binary search over prefix hashes."""
        lo = np.zeros(len(i), dtype=np.int64)
        hi = np.minimum(self.after[i], self.after[j])
        diff = self.p[i, LEFT] - self.p[j, LEFT]
        while (lo < hi).any():
            mid = (lo + hi + 1) >> 1
            same = self.p[i, LEFT + mid] - self.p[j, LEFT + mid] == diff
            lo = np.where(same, mid, lo)
            hi = np.where(same, hi, mid - 1)
        return lo

    def before_or_equal(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether suffix i stands before suffix j or equals it; groups come first."""
        gi, gj = self.group[i], self.group[j]
        out = gi < gj
        t = np.flatnonzero(gi == gj)
        a, b = i[t], j[t]
        n = self.common(a, b)
        ends = n >= self.after[a]
        out[t] = ends | (~ends & (n < self.after[b]) & (self.x[a, np.minimum(LEFT + n, LEFT + WINDOW - 1)] < self.x[b, np.minimum(LEFT + n, LEFT + WINDOW - 1)]))
        return out

    def sorted(self) -> np.ndarray:
        """Merge sort, all merges of a level at once: an element's place is its place in its own run plus the number of elements of the other run before it."""
        m = len(self.group)
        order = np.arange(m)
        width = 1
        while width < m:
            at = np.arange(m)
            base = at - at % (2 * width)
            left = at % (2 * width) < width
            lo = np.where(left, np.minimum(base + width, m), base)
            end = np.where(left, np.minimum(base + 2 * width, m), np.minimum(base + width, m))
            first, hi = lo.copy(), end.copy()
            while (act := np.flatnonzero(lo < hi)).size:
                mid = (lo[act] + hi[act]) >> 1
                mine, other = order[at[act]], order[mid]
                # Of equal ones the left run's come first.
                less = np.where(left[act], ~self.before_or_equal(mine, other), self.before_or_equal(other, mine))
                lo[act] = np.where(less, mid + 1, lo[act])
                hi[act] = np.where(less, hi[act], mid)
            place = base + (at - np.where(left, base, np.minimum(base + width, m))) + (lo - first)
            out = np.empty_like(order)
            out[place] = order
            order, width = out, 2 * width
        return order

    def equal_windows(self, d0: np.ndarray, d1: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, first d, last d): windows that start d bytes before the row's anchor, for d in d0..d1, and are found in another row of its group."""
        for seed in range(8):
            if seed:
                self.draw(seed)
            got = self._equal_windows(d0, d1)
            if got is not None:
                return got
        raise RuntimeError("hash collisions with eight bases")

    def _equal_windows(self, d0: np.ndarray, d1: np.ndarray) -> list[tuple[int, int, int]] | None:
        order = self.sorted()
        i, j = order[:-1], order[1:]
        n = np.where(self.group[i] == self.group[j], self.common(i, j), -1)
        # Collision verification: the bytes agree as far as the hashes say, and no further.
        differs = (self.x[i, LEFT:] != self.x[j, LEFT:]) | (np.arange(WINDOW) >= np.minimum(self.after[i], self.after[j])[:, None])
        true = np.where(differs.any(axis=1), differs.argmax(axis=1), WINDOW)
        if ((n >= 0) & (n != true)).any():
            return None
        d0, d1 = d0[order], d1[order]
        hit = np.zeros((len(order), LEFT + 1), dtype=bool)
        for d in range(int(d0.min()), int(d1.max()) + 1):
            own = np.flatnonzero((d0 <= d) & (d <= d1))
            if len(own) < 2:
                continue
            run = np.cumsum(np.append(True, n < WINDOW - d))
            rows = order[own]
            left = self.p[rows, LEFT] - self.p[rows, LEFT - d]
            key = tn.mix(left + run[own].astype(U64) * U64(0xA0761D6478BD642F))
            dup = own[tn.repeated(key)]
            if not len(dup):
                continue
            rows = order[dup]
            k = tn.mix(self.p[rows, LEFT] - self.p[rows, LEFT - d] + run[dup].astype(U64) * U64(0xA0761D6478BD642F))
            by = np.argsort(k, kind="stable")
            a, b = by[:-1], by[1:]
            same = k[a] == k[b]
            a, b = a[same], b[same]
            if (run[dup[a]] != run[dup[b]]).any() or (d and (self.x[rows[a], LEFT - d : LEFT] != self.x[rows[b], LEFT - d : LEFT]).any()):
                return None
            hit[dup, d] = True
        edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        r, first = np.nonzero(edge == 1)
        last = np.nonzero(edge == -1)[1] - 1
        return list(zip(order[r].tolist(), first.tolist(), last.tolist(), strict=True))


RUNS = "kg long, ctx long, d0 int, d1 int"


def _runs(kg: list, ctx: list, found: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([kg[r] for r, _, _ in found], pa.int64()), pa.array([ctx[r] for r, _, _ in found], pa.int64()), pa.array([a for _, a, _ in found], pa.int32()), pa.array([z for _, _, z in found], pa.int32())], names=["kg", "ctx", "d0", "d1"])


def sort_groups(ctxs: DataFrame, tasks: int) -> DataFrame:
    """ctxs: CONTEXT and g. Groups of contexts with an equal g; returns the runs of windows (RUNS) that are found in another context of the group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            g, kg, ctx, d0, d1, before, data = zip(*rows, strict=True)
            c = Contexts(np.array(g, dtype=np.int64), np.array(before), list(data))
            if found := c.equal_windows(np.array(d0), np.array(d1)):
                yield _runs(kg, ctx, found)

        held: list[tuple] = []
        for batch in batches:  # sorted by g
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[0] != held[-1][0] and len(held) >= CHUNK:
                    yield from out(held)
                    held = []
                held.append(row)
        if held:
            yield from out(held)

    chosen = ctxs.select("g", "kg", "ctx", "d0", "d1", "before", "bytes")
    return chosen.repartition(tasks, "g").sortWithinPartitions("g").mapInArrow(run, RUNS)


PARTS = 4


def split(hot: DataFrame, hash_: Hash, seed: int, with_bytes: bool) -> DataFrame:
    """hot: CONTEXT, g, and lo and hi, the range of distances d that g stands for. Each row once for every quarter of its range with windows of its
    own; g becomes a hash of the old one, the quarter, and the bytes that all windows of the quarter share."""
    keys = "g long"
    schema = keys + (", lo int, hi int, " + CONTEXT) * with_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at: list[int] = []
            out: list[tuple[int, int, int, int, int]] = []
            for i, (g, lo, hi, d0, d1, before, data) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("g", "lo", "hi", "d0", "d1", "before", "bytes")), strict=True)):
                for k in range(PARTS):
                    a, z = lo + (hi - lo + 1) * k // PARTS, lo + (hi - lo + 1) * (k + 1) // PARTS - 1
                    first, last = max(d0, a), min(d1, z)
                    if first <= last:
                        core = data[before - a : before - z + WINDOW]
                        h = hash_(b"%d %d %d " % (g, a, z) + core, seed + 2)
                        at.append(i)
                        out.append((h - (1 << 64) if h >> 63 else h, a, z, first, last))
            g2, a2, z2, first2, last2 = zip(*out, strict=True) if out else ((),) * 5
            cols = [pa.array(g2, pa.int64())]
            if with_bytes:
                own = batch.take(pa.array(at, pa.int32()))
                new = {"d0": pa.array(first2, pa.int32()), "d1": pa.array(last2, pa.int32())}
                cols += [pa.array(a2, pa.int32()), pa.array(z2, pa.int32()), *(new.get(c, own.column(c)) for c in CONTEXT_NAMES)]
            yield pa.RecordBatch.from_arrays(cols, names=["g", "lo", "hi", *CONTEXT_NAMES][: len(cols)])

    return hot.mapInArrow(run, schema)


def settle_hot(hot: DataFrame, hash_: Hash, seed: int) -> DataFrame:
    """The runs (RUNS) of groups that are too large to be sorted in one task."""
    spark = hot.sparkSession
    found = None
    rows = hot.withColumn("g", F.col("kg")).withColumn("lo", F.lit(0)).withColumn("hi", F.lit(LEFT))
    while True:
        # Groups are counted without bytes first; most contexts of a common phrase share no core with others and end here.
        counts = stage(split(rows, hash_, seed, False).groupBy("g").agg(F.count("*").alias("n")).where("n > 1"), "counts")
        met = stage(split(rows, hash_, seed, True).join(counts, "g"), "hot")
        whole = met.where("lo = hi")
        window = F.substring("bytes", F.col("before") - F.col("lo") + 1, F.lit(WINDOW))
        if not whole.groupBy("g").agg(F.min(window).alias("a"), F.max(window).alias("z")).where("a != z").isEmpty():
            raise Collision
        few = met.where((F.col("lo") < F.col("hi")) & (F.col("n") <= HOT))
        runs = sort_groups(few, shuffle_partitions(spark, few.count(), PER_TASK)).unionByName(whole.select("kg", "ctx", "d0", "d1"))
        found = runs if found is None else found.unionByName(runs)
        rows = met.where((F.col("lo") < F.col("hi")) & (F.col("n") > HOT)).drop("n")
        if rows.isEmpty():
            return found


#: (kg, ctx) pairs that a task counts before it hands them on.
COMBINE = 2_000_000


def counted(a: DataFrame) -> DataFrame:
    """(kg, ctx, n, m) of the contexts found more than once (n), or sharing their KGRAM with others (m contexts).

    Each task counts its own pairs first, so that copies are one row a task. Contexts are counted by KGRAM with partial aggregates, and
    learn m in a join in which a KGRAM with more than SPREAD of them is dealt by context, too."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            pair, n = np.unique(np.concatenate(held), axis=0, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(n)], names=["kg", "ctx", "n"])

        for batch in batches:
            held.append(np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1))
            if sum(len(x) for x in held) >= COMBINE:
                yield out()
                held = []
        if held:
            yield out()

    pairs = a.select("kg", "ctx").mapInArrow(combine, "kg long, ctx long, n long")
    by_ctx = stage(pairs.groupBy("kg", "ctx").agg(F.sum("n").alias("n")), "pairs")
    shared = stage(by_ctx.groupBy("kg").agg(F.count("*").alias("m")).where("m > 1"), "shared")
    hot = a.sparkSession.sparkContext.broadcast(key_filter(shared.where(F.col("m") > SPREAD).select(F.col("kg").alias("k1"), F.col("kg").alias("k2"))))  # bounded by MAX_BITS

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.column("kg").to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hot.value.passes(k, k))], names=[*batch.schema.names, "hot"])

    # Both sides ask the same filter, so that it need not be right about a KGRAM, only the same.
    left = by_ctx.mapInArrow(mark, "kg long, ctx long, n long, hot boolean").withColumn("salt", F.when(F.col("hot"), F.pmod("ctx", F.lit(SALTS))).otherwise(0))
    right = shared.mapInArrow(mark, "kg long, m long, hot boolean").withColumn("salt", F.explode(F.when(F.col("hot"), F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))))
    met = left.drop("hot").join(right.drop("hot"), ["kg", "salt"], "left").drop("salt")
    return met.select("kg", "ctx", "n", F.coalesce("m", F.lit(1)).alias("m")).where("n > 1 or m > 1")


def windows_found(rows: DataFrame, hash_: Hash, seed: int) -> DataFrame:
    """As repeated_windows, with one choice of hashes; may raise Collision."""
    spark = rows.sparkSession
    a = stage(anchors(rows, hash_, seed), "anchors")
    met = stage(a.join(stage(counted(a), "counted"), ["kg", "ctx"]), "met")
    ctxs = agreed(contexts(rows, met))
    todo = ctxs.agg(F.count("*"), F.count_if(F.col("m") > HOT)).first()
    at = lambda d0, d1: F.struct((F.col("at") - F.col(d1)).alias("first"), (F.col("at") - F.col(d0) + WINDOW).alias("last")).alias("r")
    # A context found twice is settled, and still serves as the other side of those found once.
    cover = met.where("n > 1").select("k1", "k2", at("d0", "d1"))
    single = met.where("n = 1").select("k1", "k2", "kg", "ctx", "at")
    if todo[0] - todo[1]:
        few = ctxs.where(F.col("m") <= HOT).withColumn("g", F.col("kg"))
        cover = cover.unionByName(single.join(stage(sort_groups(few, shuffle_partitions(spark, todo[0], PER_TASK)), "runs"), ["kg", "ctx"]).select("k1", "k2", at("d0", "d1")))
    if todo[1]:
        cover = cover.unionByName(single.join(stage(settle_hot(ctxs.where(F.col("m") > HOT), hash_, seed), "runs"), ["kg", "ctx"]).select("k1", "k2", at("d0", "d1")))
    return cover.groupBy("k1", "k2").agg(F.collect_set("r").alias("ranges"))  # bounded by the text's length


def repeated_windows(rows: DataFrame, hash_: Hash = content_hash) -> DataFrame:
    """rows: as from keyed(). (k1, k2, ranges): per distinct id and text, the byte ranges to drop."""
    for seed in range(0, 30, 10):
        try:
            return windows_found(rows, hash_, seed)
        except Collision:
            pass
    raise RuntimeError("hash collisions with three choices of hashes")


def cut(data: bytes, ranges: list[tuple[int, int]]) -> tuple[bytes, list[list[int]]]:
    """What the ranges leave of the bytes, and the maximal runs they remove."""
    spans: list[list[int]] = []
    for first, last in sorted(ranges):
        if spans and first <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], last)
        else:
            spans.append([first, last])
    kept, at = [], 0
    for first, last in spans:
        kept.append(data[at:first])
        at = last
    return (b"".join([*kept, data[at:]]) if spans else data), spans


NAMES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"]
KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.list_(pa.int32()))]


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_text: bool = False, hash_: Hash = content_hash) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256; with_text adds kept (bytes) and spans.

    Rows that lose nothing are reported where they are read; only the others meet their ranges in an exchange."""
    spark = configure(docs.sparkSession)
    rows = keyed(docs, doc_id, text)
    ranges = stage(repeated_windows(rows, hash_), "ranges")
    shared = spark.sparkContext.broadcast(key_filter(ranges))  # bounded by MAX_BITS
    results = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary, spans array<array<int>>" * with_text
    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL(results).fields])
    width = len(schema) - 1

    def result(ids: pa.Array, bodies: Iterator[bytes], ranges: Iterator[list]) -> pa.RecordBatch:
        out = []
        for data, own in zip(bodies, ranges, strict=True):
            kept, spans = cut(data, own)
            out.append((len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept, spans)[:width])
        return pa.RecordBatch.from_arrays([ids, *(pa.array([r[i] for r in out], KINDS[i]) for i in range(width))], names=NAMES[: width + 1])

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.filter(pa.array(~shared.value.passes(batch.column("k1").to_numpy(), batch.column("k2").to_numpy())))
            yield result(own.column("doc_id"), (x.as_buffer().to_pybytes() for x in own.column("text")), ([] for _ in range(own.num_rows)))

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for batch in batches:
            yield result(batch.column("doc_id"), (z.decompress(x.as_buffer()) for x in batch.column("packed")), ([(r["first"], r["last"]) for r in x.as_py() or ()] for x in batch.column("ranges")))

    calm = rows.select("doc_id", "k1", "k2", "text").mapInArrow(untouched, schema)
    met = packed(rows, shared).join(ranges, ["k1", "k2"], "left").select("doc_id", "packed", "ranges").mapInArrow(touched, schema)
    return calm.unionByName(met)
