"""A Bloom filter of key pairs with a bounded size, so that rows that can't join are kept out of an exchange.

It only saves work: a row that passes by chance finds no partner in the join. Its size follows the number of keys up to MAX_BITS,
beyond which it lets more rows pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum as tn

U64 = np.uint64
MAX_BITS = 1 << 27
PROBES = 3


def probes(k1: np.ndarray, k2: np.ndarray, bits: int) -> list[np.ndarray]:
    h = tn.mix(k1.view(U64) + tn.mix(k2.view(U64)))
    step = tn.mix(h) | U64(1)
    return [(h + U64(i) * step) & U64(bits - 1) for i in range(PROBES)]


class KeyFilter:
    def __init__(self, words: np.ndarray):
        self.words = words

    def passes(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        out = np.ones(len(k1), dtype=bool)
        for p in probes(k1, k2, 64 * len(self.words)):
            out &= (self.words[(p >> U64(6)).astype(np.int64)] >> (p & U64(63)) & U64(1)).astype(bool)
        return out


def key_filter(keys: DataFrame) -> KeyFilter:
    """keys: (k1 long, k2 long). Tasks set bits in their own copies; the words are joined by a bitwise or."""
    bits = min(MAX_BITS, 1 << max(13, (16 * keys.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(bits // 64, dtype=U64)
        for batch in batches:
            for p in probes(batch.column(0).to_numpy(), batch.column(1).to_numpy(), bits):
                np.bitwise_or.at(words, (p >> U64(6)).astype(np.int64), U64(1) << (p & U64(63)))
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at].view(np.int64))], names=["at", "word"])

    set_ = keys.select("k1", "k2").mapInArrow(run, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    words = np.zeros(bits // 64, dtype=U64)
    words[set_["at"].to_numpy()] = set_["word"].to_numpy().view(U64)
    return KeyFilter(words)


def without(rows: DataFrame, keys: DataFrame, own: str, key: str) -> DataFrame:
    """The rows whose column ``own`` (not null) is no ``key``. Rows that can't be one stay where they are; only the others meet the keys in an exchange."""
    two = lambda c: [F.xxhash64(c).alias("k1"), F.xxhash64(F.lit(1), c).alias("k2")]
    shared = rows.sparkSession.sparkContext.broadcast(key_filter(keys.select(*two(key))))  # bounded by MAX_BITS
    schema = rows.schema.add("_may", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            may = shared.value.passes(batch.column("k1").to_numpy(), batch.column("k2").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(may)], names=[f.name for f in schema])

    asked = rows.select("*", *two(own)).mapInArrow(run, schema)
    met = asked.where("_may").join(keys.select(F.col(key).alias("_out")), F.col(own) == F.col("_out"), "left_anti")
    return asked.where("not _may").unionByName(met).drop("_may")
