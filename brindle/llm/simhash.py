"""SimHash near-duplicates by a Gray-order hierarchical index.

1. Fingerprints: word 3-shingles hashed with XXH64, one bit per hash bit by majority.
2. Equal fingerprints fall together first (a partial aggregate; the largest group of copies costs one row).
3. Two fingerprints at distance 3 or less agree in one of four 16-bit bands. Each task takes all
   fingerprints of some band values, turned so that the band leads, sorts them by Gray rank and
   builds a hierarchy: a node keeps the bits that all fingerprints below it share. Walking down, the
   differences on shared bits add up; a node above 3 drops with its whole group, and a node whose
   shared differences plus free bits stay within 3 is taken as a whole group.
4. Within the task, links become a spanning forest; only its edges leave the task.
5. The forests of all tasks are joined by star contraction.

A band value that more than REFINE distinct fingerprints share is dealt again by four sub-bands of
the other 48 bits (any pair within 3 differences agrees in one), so a hot value spreads over tasks.

Cases: null and empty texts have fingerprint zero and link like others. Null doc_ids stand aside when
the smallest is chosen; a component of null ids only has a null id. Ids of any type that can be compared stay as they are.
Repeated rows stay repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from . import textnum as tn
from .components import components
from .runtime import configure, shuffle_partitions, stage
from .xxh import xxh64

U64 = np.uint64
SHINGLE = 3
DISTANCE = 3
BANDS = 4
REFINE = 20_000
FAN = 8
PER_TASK = 250_000


def fingerprints_of(t: tn.Texts, shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text."""
    low = tn.LOWER[t.buf]
    s, e, row = tn.spans(t, tn.NOT_SPACE)
    rows = len(t)
    if not len(s):
        return np.zeros(rows, dtype=U64)
    # The words, each followed by one space.
    n = e - s
    at = np.zeros(len(s), dtype=np.int64)
    np.cumsum(n[:-1] + 1, out=at[1:])
    joined = np.full(int(at[-1] + n[-1] + 1), 32, dtype=np.uint8)
    k = np.arange(int(n.sum()), dtype=np.int64)
    first = np.zeros(len(s), dtype=np.int64)
    np.cumsum(n[:-1], out=first[1:])
    joined[k + np.repeat(at - first, n)] = low[k + np.repeat(s - first, n)]
    words = np.bincount(row, minlength=rows)
    full = np.flatnonzero(row[: max(0, len(row) - shingle + 1)] == row[shingle - 1 :]) if len(row) >= shingle else np.zeros(0, dtype=np.int64)
    few = np.flatnonzero((words > 0) & (words < shingle))
    head = np.zeros(rows, dtype=np.int64)
    np.cumsum(words[:-1], out=head[1:])
    a = np.concatenate([full, head[few]])
    z = np.concatenate([full + shingle - 1, head[few] + words[few] - 1])
    order = np.argsort(a, kind="stable")
    a, z = a[order], z[order]
    own = row[a]
    count = np.bincount(own, minlength=rows)
    ones = np.zeros((rows, 64), dtype=np.int64)
    for lo in range(0, len(a), HASHES):
        part = slice(lo, lo + HASHES)
        who, n_ones = bit_counts(xxh64(joined, at[a[part]], at[z[part]] + n[z[part]] - at[a[part]]), own[part])
        ones[who] += n_ones
    some = count > 0
    out = np.zeros(rows, dtype=U64)
    out[some] = np.packbits(2 * ones[some] > count[some][:, None], axis=1, bitorder="little").view(U64)[:, 0]
    return out


#: Hashes whose bits are spread out at a time, so that a very long text needs no more memory than others.
HASHES = 1 << 18


def bit_counts(h: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """own: the row of each hash, ascending. (rows that occur, how many of their hashes have each of the 64 bits)."""
    # One byte lane per bit; up to 255 hashes fit in a lane before it is widened.
    lanes = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(U64)
    cut = np.append(True, own[1:] != own[:-1])
    place = np.arange(len(h)) - np.maximum.accumulate(np.where(cut, np.arange(len(h)), 0))
    cut |= place % 255 == 0
    seg = np.flatnonzero(cut)
    part = np.add.reduceat(lanes, seg, axis=0).view(np.uint8).astype(np.int64)
    new = np.flatnonzero(np.append(True, own[seg][1:] != own[seg][:-1]))
    return own[seg][new], np.add.reduceat(part, new, axis=0)


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` and fp long."""
    configure(docs.sparkSession)
    keep = [c for c in docs.columns if c != "fp"] if keep is None else keep
    chosen = docs.select(*[docs[c] for c in dict.fromkeys([*keep, text])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, t in tn.pieces(tn.texts(batch.column(text)), 1 << 19):
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in keep), pa.array(fingerprints_of(t).view(np.int64))], names=[*keep, "fp"])

    return chosen.mapInArrow(run, docs.select(*[docs[c] for c in keep]).schema.add("fp", "long"))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each code word in the reflected Gray sequence."""
    for k in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> U64(k))
    return x


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = np.arange(n, dtype=np.int64)

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        up = self.up
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            far = ra != rb
            a, b, ra, rb = a[far], b[far], ra[far], rb[far]
            np.minimum.at(up, np.maximum(ra, rb), np.minimum(ra, rb))

    def roots(self, x: np.ndarray) -> np.ndarray:
        up = self.up
        r = up[x]
        while True:
            n = up[r]
            if np.array_equal(n, r):
                return r
            r = n


def forest(code: np.ndarray, group: np.ndarray, band: np.ndarray, distance: int = DISTANCE) -> np.ndarray:
    """Links fingerprints of the same group within the distance. code: fingerprints turned so that the bits
    ``band`` (a mask per element) which a group shares lead. Returns each element's root in its own forest."""
    n = len(code)
    order = np.lexsort((gray_rank(code), group))
    code, group = code[order], group[order]
    # Levels of nodes, leaves first: shared ones, ones anywhere, first and last group, number of elements.
    levels = [(code, code, group, group)]
    while len(levels[-1][0]) > FAN:
        a, o, g0, g1 = levels[-1]
        pad = -len(a) % FAN
        ext = lambda x: np.concatenate([x, np.repeat(x[-1:], pad)]).reshape(-1, FAN)  # noqa: E731, B023
        levels.append((np.bitwise_and.reduce(ext(a), axis=1), np.bitwise_or.reduce(ext(o), axis=1), ext(g0)[:, 0], ext(g1)[:, -1]))
    trees = Forest(n)
    whole = [np.zeros(len(x[0]), dtype=bool) for x in levels]
    for lo in range(0, n, 2048):
        hi = min(n, lo + 2048)
        top = len(levels) - 1
        q = np.repeat(np.arange(lo, hi), len(levels[top][0]))
        node = np.tile(np.arange(len(levels[top][0])), hi - lo)
        for k in range(top, -1, -1):
            ones, any_, g0, g1 = levels[k]
            # An element only looks for others at or after it: links are symmetric.
            ok = (g0[node] <= group[q]) & (group[q] <= g1[node]) & ((node + 1) * FAN**k > q)
            q, node = q[ok], node[ok]
            free = ones[node] ^ any_[node]
            far = np.bitwise_count((code[q] ^ ones[node]) & ~free)
            ok = far <= distance
            q, node, free, far = q[ok], node[ok], free[ok], far[ok]
            if k == 0:
                trees.union(q, node)
                break
            all_in = (far + np.bitwise_count(free) <= distance) & (g0[node] == group[q]) & (g1[node] == group[q])
            if all_in.any():
                first = node[all_in] * FAN**k
                trees.union(q[all_in], first)
                new = np.unique(node[all_in])
                new = new[~whole[k][new]]
                whole[k][new] = True
                if len(new):
                    size = np.minimum(n, (new + 1) * FAN**k) - new * FAN**k
                    head = np.repeat(new * FAN**k, size)
                    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                    trees.union(head, head + place)
                q, node = q[~all_in], node[~all_in]
            q = np.repeat(q, FAN)
            node = (node[:, None] * FAN + np.arange(FAN)).ravel()
            ok = node < len(levels[k - 1][0])
            q, node = q[ok], node[ok]
    root = np.empty(n, dtype=np.int64)
    root[order] = order[trees.roots(np.arange(n))]
    return root


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cols = [(b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy()) for b in batches if b.num_rows]
    if cols:
        band, key, fp = (np.concatenate(x) for x in zip(*cols, strict=True))
        x = fp.view(U64)
        r = (band * 16).astype(U64)
        code = np.where(r > 0, (x << r) | (x >> ((U64(64) - r) & U64(63))), x)
        _, group = np.unique(np.stack([band.astype(np.int64), key]), axis=1, return_inverse=True)
        root = forest(code, group.ravel(), band)
        at = np.flatnonzero(root != np.arange(len(root)))
        yield pa.RecordBatch.from_arrays([pa.array(fp[at]), pa.array(fp[root[at]])], names=["u", "v"])


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """fps: distinct fp long. Edges (u, v) between fingerprints that connect all pairs within the distance."""
    if distance != DISTANCE:
        raise ValueError("bands and sub-bands are laid out for a distance of 3")
    spark = fps.sparkSession
    n = shuffle_partitions(spark, BANDS * fps.count(), PER_TASK)
    key = lambda b: F.shiftrightunsigned("fp", 48 - 16 * b).bitwiseAND(F.lit(0xFFFF))
    banded = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(b).alias("band"), key(b).alias("key")) for b in range(BANDS)])).alias("x")).select("x.band", "x.key", "fp")
    hot = banded.groupBy("band", "key").agg(F.count("*").alias("n")).where(F.col("n") > REFINE).select("band", "key", F.lit(True).alias("hot"))
    if not hot.isEmpty():
        # The other 48 bits, turned to the low end, in four parts of 12.
        turned = F.expr("(shiftleft(fp, 16 * (band + 1)) | shiftrightunsigned(fp, 64 - 16 * (band + 1)))")
        rest = F.when(F.col("band") == BANDS - 1, F.col("fp")).otherwise(turned)
        sub = F.array(*[F.lit((j + 1) << 28) + F.shiftleft(F.col("key"), 12) + F.shiftrightunsigned(rest, 16 + 12 * j).bitwiseAND(F.lit(0xFFF)) for j in range(4)])
        banded = banded.join(hot, ["band", "key"], "left").withColumn("key", F.explode(F.when(F.col("hot"), sub).otherwise(F.array("key")))).select("band", "key", "fp")
    return banded.repartition(n, "band", "key").mapInArrow(_edges, "u long, v long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per document."""
    fp = stage(fingerprints(docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")), "text", ["doc_id"]), "fingerprints")
    least = fp.groupBy("fp").agg(F.min("doc_id").alias("own"))
    roots = components(links(least.select("fp")))
    named = least.join(roots, least.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "own")
    named = stage(named, "roots")
    comp = named.groupBy("root").agg(F.min("own").alias("component_id"))
    of_fp = named.join(comp, "root").select(F.col("fp").alias("fp2"), "component_id")
    return fp.join(of_fp, fp.fp == of_fp.fp2, "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def has_map(kind: DataType) -> bool:
    return isinstance(kind, MapType) or (isinstance(kind, ArrayType) and has_map(kind.elementType)) or (isinstance(kind, StructType) and any(has_map(f.dataType) for f in kind))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, that with the smallest id (of several with it, the one with the smallest hash; of equal rows, one). Columns of any type
    pass through: maps, arrays and structs, too."""
    own = docs.columns
    n = len(own)
    plain = docs.select(*[docs[c].alias(f"_{i}") for i, c in enumerate(own)])
    row_id, body = F.col(f"_{own.index(doc_id)}"), f"_{own.index(text)}"
    # (h, g) tells rows apart; neither is null, so that one exchange serves the join and the aggregate below.
    # Maps have no hash of their own; their JSON text has, so that equal maps in another order count as different rows.
    value = [F.to_json(F.struct(f"_{i}")) if has_map(plain.schema[f"_{i}"].dataType) else F.col(f"_{i}") for i in range(n)]
    hashed, second = F.xxhash64(*value), F.xxhash64(F.lit(1), *reversed(value))
    plain = plain.withColumn("h", hashed).withColumn("g", second)
    fp = stage(fingerprints(plain.withColumn("id", row_id), body, ["id", "h", "g"]), "fingerprints")
    # The smallest of each fingerprint, then of each component: aggregates, so that a group of any size is one row early.
    rank = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("h"), F.col("g"))
    least = stage(fp.groupBy("fp").agg(F.min(rank).alias("best")), "classes")
    roots = components(links(least.select("fp")))
    chosen = least.join(roots, least.fp == roots.node, "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("best").alias("best")).select("best.h", "best.g")
    picked = plain.join(chosen, ["h", "g"], "left_semi")
    # Equal rows pass together; one stays.
    one = picked.groupBy("h", "g").agg(F.first(F.struct(*[F.col(f"_{i}") for i in range(n)])).alias("row"))
    return one.select(*[F.col("row")[f"_{i}"].alias(c) for i, c in enumerate(own)])
