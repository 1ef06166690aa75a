"""Quality rules by repetition coverage.

For every document, rolling hashes of its word n-grams of several lengths (numpy, a whole
Arrow batch at once) find the n-grams that stand in it more than once; the operator measures
the share of word characters inside duplicated n-grams and inside duplicated lines. Of equal n-grams, as of equal lines,
the first is not counted, so that a sentence said twice weighs once.

Cases: a null or empty text has no words, fails the base rule and is rejected. Very long texts
are processed whole, as a piece of their own. Documents are judged alone, so ties, repeated
rows and empty tables need no special result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textnum as tn

#: Largest allowed share of word characters inside n-grams that stand earlier in the text, by n: the published limits of Rae et al.,
#: "Scaling Language Models" (2021), table A1. They fall with n, so that each length can reject a text that the shorter ones let pass.
MAX_GRAM_SHARE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Longest allowed share of word characters in lines that repeat an earlier line.
MAX_LINE_SHARE = 0.30
#: Largest allowed number of symbols per word.
MAX_SYMBOLS = 0.3
MIN_WORDS = 50
SYMBOL = ~tn.byte_class([(ord(c), ord(c)) for c in "#*$%&|<>"])

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars", *(f"dup_chars_{n}" for n in MAX_GRAM_SHARE)]


RESULTS = [*MEASURES, "base_failed", "kept"]


def measure(t: tn.Texts) -> dict[str, np.ndarray]:
    """The measures of each text; all are counts, word_chars and the dup_ ones of code points in words (dup_chars_n: of words in n-grams that
    stand earlier in the text)."""
    rows = len(t)
    s, e, row = tn.spans(t, tn.NOT_SPACE)
    lead = (t.buf & 0xC0) != 0x80
    chars_at = np.zeros(len(t.buf) + 1, dtype=np.int64)
    np.cumsum(lead & tn.NOT_SPACE[t.buf], out=chars_at[1:])
    chars = chars_at[e] - chars_at[s]
    h = tn.hashes(t.buf, s, e)
    per_row = lambda flag, w=None: np.bincount(row[flag], weights=None if w is None else w[flag], minlength=rows).astype(np.int64)
    out = {"n_words": np.bincount(row, minlength=rows).astype(np.int64), "word_chars": chars_at[t.end] - chars_at[t.start], "n_symbols": t.sums(SYMBOL[t.buf])}

    line = np.unique(np.concatenate([t.start, np.flatnonzero(t.buf == 10) + 1, np.flatnonzero(t.buf == 10)]))
    ends = np.append(line[1:], len(t.buf))
    own = (ends > line) & (t.buf[np.minimum(line, max(len(t.buf) - 1, 0))] != 10) if len(t.buf) else np.zeros(len(line), dtype=bool)
    ls, le = line[own], ends[own]
    lchars = chars_at[le] - chars_at[ls]
    ls, le, lchars = ls[lchars > 0], le[lchars > 0], lchars[lchars > 0]
    lrow = t.row_of(ls)
    again = tn.later(tn.mix(tn.hashes(t.buf, ls, le) + (lrow.astype(np.uint64) + np.uint64(1)) * np.uint64(0xA0761D6478BD642F)))
    out["n_dup_lines"] = np.bincount(lrow[again], minlength=rows).astype(np.int64)
    out["dup_line_chars"] = np.bincount(lrow[again], weights=lchars[again], minlength=rows).astype(np.int64)

    at, g = tn.grams(h, row, 3)
    at = at[tn.repeated(g)]
    out["n_repeat_words"] = per_row(tn.covered(at, 3, len(h)))
    seen = np.zeros(len(h) + 1, dtype=bool)
    seen[at] = True
    for n in MAX_GRAM_SHARE:
        # A window can only be found twice if all windows of 3 words in it are.
        at = np.flatnonzero(seen[: len(h)])
        at = at[at + n <= len(h)]
        at = at[(row[at] == row[at + n - 1]) & np.logical_and.reduce([seen[at + j] for j in range(1, n - 2)])]
        g = (row[at].astype(np.uint64) + np.uint64(1)) * np.uint64(0xA0761D6478BD642F)
        for j in range(n):
            g = g + h[at + j] * tn.GRAM[j]
        at = at[tn.later(tn.mix(g))]
        out[f"dup_chars_{n}"] = per_row(tn.covered(at, n, len(h)), chars)
    return out


def measured(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of the documents (all; of names that results have, the results), and their measures."""
    keep = [c for c in docs.columns if c not in RESULTS] if keep is None else keep
    chosen = docs.select(*[docs[c] for c in dict.fromkeys([*keep, text])])
    schema = docs.select(*[docs[c] for c in keep]).schema
    for name in MEASURES:
        schema = schema.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = tn.texts(batch.column(text))
            for i, j, t in tn.pieces(whole):
                m = measure(t)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in keep), *(pa.array(m[c]) for c in MEASURES)], names=[*keep, *MEASURES])

    return chosen.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def repetitive() -> Column:
    """The method's verdict: too large a share of characters is repeated, or of words is symbols."""
    bad = F.col("dup_line_chars") > MAX_LINE_SHARE * F.col("word_chars")
    for n, share in MAX_GRAM_SHARE.items():
        bad = bad | (F.col(f"dup_chars_{n}") > share * F.col("word_chars"))
    return bad | (F.col("n_symbols") > MAX_SYMBOLS * F.col("n_words"))


def quality_rules(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds the measures, base_failed and kept."""
    return measured(docs, text, keep).withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~repetitive())


def filter_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that the rules keep, with their columns as they were."""
    own = docs.columns
    # Own names, so that columns of the input may be called as the measures are.
    plain = docs.select(*[docs[c].alias(f"_{i}") for i, c in enumerate(own)])
    kept = quality_rules(plain, f"_{own.index(text)}").where("kept")
    return kept.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(own)])
