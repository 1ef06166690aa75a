"""Token ids packed into fixed-size rows by best-fit decreasing.

Texts become token ids of a public tokenizer (its file is a parameter), each document closed by
one end token. A document longer than a row is cut into full rows and a rest, losing nothing. Rests
and short documents are placed from the longest, each in the row with the least free space that
still holds it; a segment tree over free space finds that row in logarithmic time.

Packing is local to a block of bounded size, so nothing is shuffled and a lost task is just run again.
One result row is a matrix of up to MATRIX_ROWS rows of ``seq_len`` little-endian int32 ids, with the
cumulative lengths of its segments (padding closes a row as a segment of its own) and the places
where positions start from 0 again.

Cases: a null or empty text is a document of the end token alone. Ids of any type, null and repeated ones too, stay as they
are: ``doc_nos`` tells documents of a block apart. An empty table gives no matrices. Extra columns
are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import configure

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SEQ_LEN = 2048
MATRIX_ROWS = 64
#: Tokens of a block, unless a single document is longer.
BLOCK_TOKENS = 2_000_000
PAD = 0

#: Of the matrices; doc_ids has the type of the ids.
SCHEMA = "block string, matrix int, n_rows int, seq_len int, n_tokens long, ids binary, cu_seqlens array<int>, position_resets array<int>, doc_ids array<{id}>, doc_nos array<int>, doc_offsets array<int>"

_loaded: dict[str, tuple[Callable[[list[str]], list], int]] = {}


#: White space that the split pattern's engine can't take back step by step, in one run.
RUN = 5000
SPACE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def by_runs(enc, text: str, run: int = RUN) -> np.ndarray:
    """The ids of a text. A very long run of white space is cut out: as in the split pattern, all of it but the last character (all, at
    the end of the text) is a piece of its own, and the rest goes on from there."""
    if len(text) < run:
        return enc.encode_to_numpy(text, disallowed_special=())
    parts, at = [], 0
    for m in re.finditer(f"{SPACE}{{{run},}}", text):
        end = m.end() if m.end() == len(text) else m.end() - 1
        parts += [enc.encode_to_numpy(text[at : m.start()], disallowed_special=()), np.array(enc._encode_single_piece(text[m.start() : end]), dtype=np.uint32)]
        at = end
    return np.concatenate([*parts, enc.encode_to_numpy(text[at:], disallowed_special=())]) if parts else enc.encode_to_numpy(text, disallowed_special=())


def tokenizer(path: str) -> tuple[Callable[[list[str]], list], int]:
    """(texts -> lists of ids, id of the end token) for a .tiktoken, .json or .model file; kept per worker."""
    if path not in _loaded:
        if path.endswith(".tiktoken"):
            import tiktoken

            #: Fixed value: the split pattern of byte-level BPE vocabularies.
            pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            enc = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            _loaded[path] = (lambda xs: [by_runs(enc, x) for x in xs]), max(ranks.values()) + 1
        elif path.endswith(".json"):
            from tokenizers import Tokenizer

            own = Tokenizer.from_file(path)
            own.encode_special_tokens = True
            _loaded[path] = (lambda xs: [x.ids for x in own.encode_batch(xs, add_special_tokens=False)]), own.token_to_id("<|endoftext|>")
        else:
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            _loaded[path] = (lambda xs: sp.encode(xs, num_threads=1)), sp.eos_id()
    return _loaded[path]


class FreeSpace:
    """A segment tree over amounts of free space 0..capacity: which amount, at least x, is the smallest that some row has."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, space: int, row: int) -> None:
        self.rows[space].append(row)
        if len(self.rows[space]) == 1:
            self._step(space, 1)

    def _step(self, space: int, d: int) -> None:
        i = self.leaves + space
        while i:
            self.count[i] += d
            i >>= 1

    def take(self, x: int) -> tuple[int, int] | None:
        """The best row for x: (its free space, the row), taken out; or None."""
        count, i = self.count, self.leaves + x
        if not count[i]:
            # Up to the first subtree to the right that has a row, then down to its leftmost.
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if count[2 * i] else 2 * i + 1
        space = i - self.leaves
        row = self.rows[space].pop()
        if not self.rows[space]:
            self._step(space, -1)
        return space, row


def best_fit(sizes: np.ndarray, seq_len: int) -> list[list[int]]:
    """Rows of pieces (places in sizes, each 1..seq_len long), longest first; pieces of equal size keep their order."""
    rows: list[list[int]] = []
    free = FreeSpace(seq_len)
    for p in np.argsort(-sizes, kind="stable").tolist():
        n = int(sizes[p])
        if n == seq_len:
            rows.append([p])
            continue
        got = free.take(n)
        if got is None:
            got = seq_len, len(rows)
            rows.append([])
        rows[got[1]].append(p)
        if got[0] > n:
            free.add(got[0] - n, got[1])
    return rows


def pack_block(name: str, doc_ids: list, tokens: list[np.ndarray], seq_len: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    size = np.array([len(x) for x in tokens], dtype=np.int64)
    parts = -(-size // seq_len)
    doc = np.repeat(np.arange(len(size)), parts)
    offset = (np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)) * seq_len
    n = np.minimum(seq_len, size[doc] - offset)
    rows = best_fit(n, seq_len)
    for m in range(0, len(rows), MATRIX_ROWS):
        own = rows[m : m + MATRIX_ROWS]
        ids = np.full((len(own), seq_len), PAD, dtype="<i4")
        cuts, ends, nos, offsets = [0], [], [], []
        for r, row in enumerate(own):
            at = 0
            for p in row:
                d, o, k = int(doc[p]), int(offset[p]), int(n[p])
                ids[r, at : at + k] = tokens[d][o : o + k]
                at += k
                cuts.append(r * seq_len + at)
                ends.append(doc_ids[d])
                nos.append(d)
                offsets.append(o)
            if at < seq_len:
                cuts.append((r + 1) * seq_len)
                ends.append(None)
                nos.append(-1)
                offsets.append(0)
        used = int(sum(n[p] for row in own for p in row))
        one = lambda v, kind: pa.array([v], kind)
        ints = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays(
            [one(name, pa.string()), one(m // MATRIX_ROWS, pa.int32()), one(len(own), pa.int32()), one(seq_len, pa.int32()), one(used, pa.int64()), one(ids.tobytes(), pa.binary()), one(cuts, ints), one(cuts[:-1], ints), one(ends, pa.list_(kind)), one(nos, ints), one(offsets, ints)],
            names=["block", "matrix", "n_rows", "seq_len", "n_tokens", "ids", "cu_seqlens", "position_resets", "doc_ids", "doc_nos", "doc_offsets"],
        )


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = TOKENIZER, seq_len: int = SEQ_LEN, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Matrices (SCHEMA) with every token of every document."""
    configure(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = tokenizer(path)
        task, k = TaskContext.get().partitionId(), 0
        ids, tokens, held = [], [], 0
        for batch in batches:
            names, bodies, kind = batch.column(0).to_pylist(), batch.column(1), batch.column(0).type
            for i in range(0, len(names), 64):
                for d, x in zip(names[i : i + 64], encode([x or "" for x in bodies.slice(i, 64).to_pylist()]), strict=True):
                    own = np.append(x, end).astype(np.int32)
                    if held and held + len(own) > block_tokens:
                        yield from pack_block(f"{task}-{k}", ids, tokens, seq_len, kind)
                        ids, tokens, held, k = [], [], 0, k + 1
                    ids.append(d)
                    tokens.append(own)
                    held += len(own)
        if ids:
            yield from pack_block(f"{task}-{k}", ids, tokens, seq_len, kind)

    chosen = docs.select(docs[doc_id], docs[text])
    return chosen.mapInArrow(run, SCHEMA.format(id=chosen.schema[0].dataType.simpleString()))


def unpack(matrices: DataFrame) -> DataFrame:
    """The documents again: (block, doc_no, doc_id, ids array<int>), end token included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.column("doc_ids").type.value_type
            for x in batch.to_pylist():
                flat = np.frombuffer(x["ids"], dtype="<i4")
                cu = x["cu_seqlens"]
                own = [i for i, d in enumerate(x["doc_nos"]) if d >= 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x["block"]] * len(own), pa.string()), pa.array([x["doc_nos"][i] for i in own], pa.int32()), pa.array([x["doc_ids"][i] for i in own], kind), pa.array([x["doc_offsets"][i] for i in own], pa.int32()), pa.array([flat[cu[i] : cu[i + 1]] for i in own], pa.list_(pa.int32()))],
                    names=["block", "doc_no", "doc_id", "at", "part"],
                )

    ids = matrices.schema["doc_ids"].dataType.elementType
    parts = matrices.mapInArrow(run, T.StructType.fromDDL(f"block string, doc_no int, doc_id {ids.simpleString()}, at int, part array<int>"))
    # All parts of a document lie in one block, whose size is bounded.
    return parts.groupBy("block", "doc_no").agg(F.first("doc_id").alias("doc_id"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "part"))), lambda x: x["part"])).alias("ids"))
