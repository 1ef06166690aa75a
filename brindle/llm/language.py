"""Language identification by bit-sliced Bloom filters of byte n-grams.

Fit: on at most FIT_DOCS labelled documents of each language (of different texts, those with the smallest hashes; the bound is a
parameter), n-grams are counted per language. A language keeps the MAX_GRAMS most frequent ones among those whose rate in it is
at least SHARE of the highest rate in any language. All languages share one Bloom filter whose slots hold a bit per
language, so that one look-up of K slots, ANDed, returns all languages that contain the n-gram.

Predict: over every n-gram of the whole text, per-language popcounts of the returned masks; each is corrected for the filter's
false positives, (count - n * p) / (1 - p) with p = fill ** K of the language's slice. The language with the largest corrected
count wins (ties: the first by code point); the score is its share of all corrected counts.

Cases: a null text, or one without letters, is ``und`` with score 0. A text with letters but no known n-gram gets the language
with the most training documents, score 0. Without any labelled document every text is ``und``. Null languages are not learned.
Repeated rows are predicted alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textnum as tn
from .runtime import configure

U64 = np.uint64
SIZES = (3, 4)
FIT_DOCS = 4000
MAX_GRAMS = 20_000
SHARE = 0.4
K = 3
UNKNOWN = "und"
#: Bytes of letters: A-Z, a-z and all of multi-byte characters. Others separate words.
LETTER = tn.byte_class([(0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])


def lowered(col: pa.Array) -> tn.Texts:
    return tn.texts(pc.utf8_lower(pc.fill_null(col, "")))


def grams(t: tn.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Codes and rows of the n-grams of all texts: SIZES bytes in a row, all but one of them of letters; others count as blanks."""
    b = np.where(LETTER[t.buf], t.buf, np.uint8(32)).astype(U64)
    blank = np.cumsum(np.append(0, b == 32))
    codes, rows = [], []
    for n in SIZES:
        if len(b) < n:
            continue
        m = len(b) - n + 1
        code = b[:m].copy()
        for j in range(1, n):
            code |= b[j : j + m] << U64(8 * j)
        at = np.flatnonzero(blank[n:] - blank[:-n] <= 1)
        row = t.row_of(at)
        at, row = at[at + n <= t.end[row]], row[at + n <= t.end[row]]
        codes.append(code[at] | U64(n << 56))
        rows.append(row)
    if not codes:
        return np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)
    return np.concatenate(codes), np.concatenate(rows)


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


class Filters:
    """The bit-sliced filter: ``table[slot]`` holds a bit per language, 8 to a byte."""

    def __init__(self, langs: list[str], prior: str, entries: list[tuple[np.ndarray, int]]):
        self.langs, self.prior = langs, prior
        n = max(1, sum(len(g) for g, _ in entries))
        self.bits = max(12, int(8 * n - 1).bit_length())
        self.table = np.zeros((1 << self.bits, -(-max(1, len(langs)) // 8)), dtype=np.uint8)
        for codes, lang in entries:
            for slot in self.slots(codes):
                self.table[slot, lang // 8] |= np.uint8(1 << lang % 8)
        fill = np.array([((self.table[:, i // 8] >> (i % 8)) & 1).mean() for i in range(len(langs))])
        self.false = fill**K

    def slots(self, codes: np.ndarray) -> list[np.ndarray]:
        h = tn.mix(codes)
        low = U64((1 << self.bits) - 1)
        step = (h >> U64(32)) | U64(1)
        return [((h + U64(k) * step) & low).astype(np.int64) for k in range(K)]

    def masks(self, codes: np.ndarray) -> np.ndarray:
        """For each n-gram the languages that contain it, as bits."""
        a, *more = self.slots(codes)
        out = self.table[a]
        for s in more:
            out &= self.table[s]
        return out

    def counts(self, t: tn.Texts) -> np.ndarray:
        """Corrected popcounts, texts x languages."""
        codes, row = grams(t)
        rows = len(t)
        found = np.zeros((rows, len(self.langs)))
        m = self.masks(codes)
        unit = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float64)
        for j in range(m.shape[1]):
            # How often a text has each of the 256 values of this byte of the mask.
            h = np.bincount(row * 256 + m[:, j], minlength=rows * 256).reshape(rows, 256)
            part = found[:, 8 * j : 8 * j + 8]
            part += (h @ unit)[:, : part.shape[1]]
        n = np.bincount(row, minlength=rows)[:, None]
        return np.maximum(0.0, (found - n * self.false) / (1 - self.false))


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", key: Column | None = None, fit_docs: int = FIT_DOCS, max_grams: int = MAX_GRAMS) -> Filters:
    """docs: labelled documents. What comes to the driver is bounded by languages x max_grams."""
    configure(docs.sparkSession)
    x = docs.where(docs[lang].isNotNull())
    count = {r.lang: r.n for r in x.groupBy(x[lang].alias("lang")).agg(F.count("*").alias("n")).collect()}
    langs = sorted(count, key=lambda v: v.encode())
    if not langs:
        return Filters([], UNKNOWN, [])
    prior = max(langs, key=lambda v: count[v])
    # Below its language's threshold lie about fit_docs documents of each; of these, different texts only, and no more than fit_docs.
    part = F.element_at(F.create_map(*[F.lit(v) for k in langs for v in (k, min(1.0, fit_docs / count[k]))]), x[lang])
    key = F.xxhash64(x[text]) if key is None else key
    place = F.pmod(key, F.lit(1 << 30))
    below = x.where(place < part * float(1 << 30)).select(x[lang].alias("lang"), x[text].alias("text"), place.alias("place"), F.xxhash64(x[text]).alias("of"))
    distinct = below.groupBy("lang", "place", "of").agg(F.first("text").alias("text"))
    sample = distinct.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("place", "of"))).where(F.col("k") <= fit_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), dtype=object)
            for i, j, t in tn.pieces(lowered(batch.column(1))):
                codes, row = grams(t)
                for name in set(names[i:j]):
                    u, n = np.unique(codes[(names[i:j] == name)[row]], return_counts=True)
                    if name in held:
                        u, of = np.unique(np.concatenate([held[name][0], u]), return_inverse=True)
                        n = np.bincount(of, weights=np.concatenate([held[name][1], n])).astype(np.int64)
                    held[name] = u, n
        for name, (u, n) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(u)), pa.array(u.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    counted = sample.repartition("of").select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    of_lang = Window.partitionBy("lang")
    rates = counted.withColumn("rate", F.col("n") / F.sum("n").over(of_lang))
    rates = rates.withColumn("top", F.max("rate").over(Window.partitionBy("gram"))).where(F.col("rate") >= SHARE * F.col("top"))
    best = rates.withColumn("k", F.row_number().over(of_lang.orderBy(F.desc("n"), "gram"))).where(F.col("k") <= max_grams)
    rows = best.select("lang", "gram").toArrow()
    name, gram = np.array(rows["lang"].to_pylist(), dtype=object), rows["gram"].to_numpy().view(U64)
    return Filters(langs, prior, [(gram[name == v], i) for i, v in enumerate(langs)])


def predict(docs: DataFrame, model: Filters, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep``, lang_pred and score."""
    spark = configure(docs.sparkSession)
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")] if keep is None else keep
    shared = spark.sparkContext.broadcast(model)  # bounded by languages x MAX_GRAMS
    has = F.coalesce(docs[text].rlike(r"\p{L}"), F.lit(False))
    chosen = docs.select(*[docs[x] for x in keep], docs[text].alias("_text"), has.alias("_has"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.langs, m.prior, UNKNOWN], dtype=object)
        for batch in batches:
            has = np.asarray(batch.column("_has"))
            for i, j, t in tn.pieces(lowered(batch.column("_text")), 1 << 19):
                ok = has[i:j] & bool(m.langs)
                pred, score = np.full(j - i, len(m.langs) + 1), np.zeros(j - i)
                if m.langs:
                    c = m.counts(t)
                    total = c.sum(axis=1)
                    pred = np.where(ok, np.where(total > 0, c.argmax(axis=1), len(m.langs)), len(m.langs) + 1)
                    score = np.where(ok & (total > 0), c.max(axis=1) / np.maximum(total, 1e-300), 0.0)
                yield pa.RecordBatch.from_arrays([*(batch.column(x).slice(i, j - i) for x in keep), pa.array(names[pred].tolist(), pa.string()), pa.array(score)], names=[*keep, "lang_pred", "score"])

    return chosen.mapInArrow(run, docs.select(*[docs[x] for x in keep]).schema.add("lang_pred", "string").add("score", "double"))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): the filters are fitted on the text and lang of documents that are not held out."""
    x = docs.select("doc_id", "text", "lang")
    model = fit(x.where(~held_out(F.col("doc_id"))))
    return predict(x, model, keep=["doc_id"]).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
