"""Vector best-fit packing of tokenised documents into sequences.

A sequence has three capacities: tokens, documents and attention cost (the sum of the squared
piece lengths). Pieces are placed in decreasing length. Among the open sequences that can take a
piece under every capacity, the one with the smallest weighted norm of what is left (or the
largest weighted dot product of the piece and what is left) gets it; otherwise a new one opens.

Documents are tokenised in the scan; only lengths and checksums of their pieces go on. Pieces are
dealt evenly to blocks of ``BLOCK_PIECES``, each packed by one task, so the work of a task does not
grow with the table and the loss against one global packing is a few sequences per block.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.llm.shared import need, prepare
from barlab.session import materialize

BLOCK_PIECES = 16_384
SEPARATOR_ID = 0

# Scripts for which both libraries are known to cut words alike; other texts take the slower one.
_COMMON = re.compile("[\x00-ɏ‐-‧€]*")


class Encoder:
    """Token ids of a byte-level BPE vocabulary, as the tokenizers library gives them.

    ``ranks`` names the same vocabulary as a rank file, which is several times faster to apply.
    """

    def __init__(self, tokenizer: str, ranks: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer

        self.plain, self.fast = Tokenizer.from_file(tokenizer), None
        if ranks and pattern:
            import base64

            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            special = {t.content: i for i, t in self.plain.get_added_tokens_decoder().items() if t.special}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None and _COMMON.fullmatch(text):
            return self.fast.encode_to_numpy(text, allowed_special="all")
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=2)
def encoder(tokenizer: str, ranks: str | None, pattern: str | None) -> Encoder:
    return Encoder(tokenizer, ranks, pattern)


def piece_bounds(length: int, size: int) -> list[int]:
    """Starts of a document's pieces and its end: whole pieces at the end, the rest first."""
    if length <= size:
        return [0, length]
    rest = length % size
    return [0, *range(rest, length + 1, size)] if rest else list(range(0, length + 1, size))


_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(tokenizer: str, ranks: str | None, pattern: str | None, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, ranks, pattern).ids
        for b in batches:
            made = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.append(encode(text), SEPARATOR_ID).astype("<u4") if text else np.zeros(1, "<u4")
                bounds = piece_bounds(len(ids), size)
                for k, (start, end) in enumerate(zip(bounds, bounds[1:])):
                    made.append((doc_id, k, start, end - start, zlib.crc32(ids[start:end].tobytes())))
            columns = zip(*made) if made else [[] for _ in _PIECES]
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _PIECES)], schema=_PIECES)

    return run


def best_fit(
    lengths: np.ndarray,
    tokens: int,
    documents: int,
    attention: float,
    weights: tuple[float, float, float] = (1.0, 0.001, 0.001),
    score: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of every piece; ``lengths`` must be sorted downwards.

    A piece that exceeds a capacity alone (only the attention cost can) has a sequence of its own.
    """
    n = len(lengths)
    capacity = np.array([tokens, documents, attention], float)
    scale = np.asarray(weights, float)
    left = np.empty((3, max(n, 1)))  # what is left of the open sequences, as a share of capacity
    names = np.empty(max(n, 1), np.int64)
    sequence, offset = np.empty(n, np.int64), np.zeros(n, np.int64)
    used = np.zeros(n, np.int64)
    opened, count = 0, 0
    least = (np.array([lengths[-1], 1, float(lengths[-1]) ** 2]) / capacity if n else np.zeros(3)) - 1e-12
    for i in range(n):
        size = float(lengths[i])
        demand = np.array([size, 1.0, size * size]) / capacity
        there = left[:, :opened]
        fits = (there[0] >= demand[0] - 1e-12) & (there[1] >= demand[1] - 1e-12) & (there[2] >= demand[2] - 1e-12)
        able = np.flatnonzero(fits)
        if len(able):
            if score == "norm":
                rest = there[:, able] - demand[:, None]
                at = able[np.argmin(scale @ (rest * rest))]
            else:
                at = able[np.argmax((scale * demand) @ there[:, able])]
        else:
            at, opened = opened, opened + 1
            left[:, at], names[at], count = 1.0, count, count + 1
        left[:, at] -= demand
        name = names[at]
        sequence[i], offset[i] = name, used[name]
        used[name] += lengths[i]
        if (left[:, at] < least).any():  # takes nothing any more: the last open one moves here
            opened -= 1
            left[:, at], names[at] = left[:, opened], names[opened]
    return sequence, offset


def _packed(tokens: int, documents: int, attention: float, weights, score: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), schema=_PIECES)
        if not table.num_rows:
            return
        table = table.combine_chunks().sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]
        )
        lengths = table.column("length").to_numpy()
        sequence, offset = best_fit(lengths, tokens, documents, attention, weights, score)
        first = TaskContext.get().partitionId() << 32
        out = table.append_column("sequence_id", pa.array(sequence + first)).append_column("offset", pa.array(offset))
        yield from out.to_batches()

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    pattern: str | None = None,
    tokens: int = 2048,
    documents: int | None = None,
    attention: float | None = None,
    weights: tuple[float, float, float] = (1.0, 0.001, 0.001),
    score: str = "norm",
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and a separator; NULL and empty texts are the separator alone. Documents
    longer than ``tokens`` are cut, the rest piece first. Without ``documents`` and ``attention``
    only the tokens bind. Rows are packed one by one, so repeated and NULL ids are packed like
    others; other columns are ignored and an empty table gives no rows.
    """
    need(docs, id_column, text_column)
    prepare(docs.sparkSession)
    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )
    pieces = materialize(texts.mapInArrow(_pieces(tokenizer, ranks, pattern, tokens), PIECES), "pieces")
    blocks = max(1, -(-pieces.count() // BLOCK_PIECES))
    run = _packed(tokens, documents or tokens, attention or float(tokens) ** 2, weights, score)
    return pieces.repartition(blocks).mapInArrow(run, PIECES + ", sequence_id long, offset long")
