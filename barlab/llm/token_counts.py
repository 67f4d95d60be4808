"""Token counts of whole texts without materialising ids.

A pre-token is a run of word marks (spaces, written ``▁``) with the characters up to the next
mark. No piece of the vocabulary holds a mark behind another character (checked before a run),
so no merge crosses a pre-token's start and a text's count is the sum over its pre-tokens.

1. Blocks of documents keep, per distinct pre-token, the documents it occurs in and how often.
   Frequent pre-tokens combine here. A block leaves as one packed row per hash bucket.
2. The rows of a bucket meet in one task, which counts every distinct pre-token once and joins
   the counts to the frequencies: a partial sum per document of each block.
3. Partial sums are added per block.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.llm.shared import need, prepare, shuffle_parts

MARK = "▁"
_PRETOKEN = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

# A block ends once its texts hold so many bytes; one longer text is a block of its own.
BLOCK_BYTES = 16 << 20
# Buckets a task works through one after the other; only one bucket's counts are in memory.
BUCKETS_PER_TASK = 4


@lru_cache(maxsize=2)
def load_model(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


@lru_cache(maxsize=2)
def check_model(model: str) -> None:
    """Raise unless pre-tokens of this model can be counted apart from each other."""
    processor = load_model(model)
    pieces = map(processor.id_to_piece, range(processor.get_piece_size()))
    crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
    rewritten = "".join(processor.encode("  a ½ ﬁ  b ", out_type=str))
    if crossing or rewritten != f"{MARK * 3}a{MARK}½ ﬁ{MARK * 2}b{MARK}":
        raise ValueError("the model merges across word starts or rewrites texts")


def pretokens(text: str) -> list[str]:
    """The pre-tokens of a text as the model sees it, with a mark put before it."""
    return _PRETOKEN.findall(MARK + text.replace(" ", MARK)) if text else []


def count_pieces(processor, tokens: list[str]) -> list[int]:
    """Pieces of each pre-token; the mark that the model puts in front stands for its first one."""
    ids = processor.encode([t[1:] for t in tokens], num_threads=1)
    return [len(x) if t != MARK else 1 for t, x in zip(tokens, ids)]


def _pack(*arrays: np.ndarray) -> bytes:
    """Unsigned arrays, bytes of equal weight side by side, compressed."""
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes() for a in arrays]
    raw = b"".join(planes)
    head = np.array([len(raw), *(len(a) for a in arrays)], np.uint32).tobytes()
    return head + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes, *types: type) -> list[np.ndarray]:
    head = np.frombuffer(data, np.uint32, len(types) + 1)
    raw = pa.decompress(data[head.nbytes :], int(head[0]), codec="zstd", asbytes=True)
    out, at = [], 0
    for n, kind in zip(head[1:].tolist(), types):
        width = np.dtype(kind).itemsize
        plane = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(plane.T).reshape(-1).view(kind))
        at += n * width
    return out


_ROW = pa.schema(
    [("bucket", pa.int32()), ("block", pa.int64()), ("docs", pa.int32()), ("payload", pa.binary())]
)
_SUMS = pa.schema(
    [("block", pa.int64()), ("docs", pa.int32()), ("head", pa.binary()), ("sums", pa.binary())]
)


def _frequencies(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: dict[str, int] = {}
        rows, which, times, size = [], [], [], 0
        block = TaskContext.get().partitionId() << 32

        def flush():
            owner = np.repeat(np.arange(len(rows), dtype=np.uint32), [len(w) for w in which])
            token = np.fromiter((i for w in which for i in w), np.int64, len(owner))
            often = np.fromiter((n for t in times for n in t), np.uint32, len(owner))
            names = [t.encode() for t in index]
            home = np.fromiter((zlib.crc32(t) % buckets for t in names), np.int64, len(names))
            order = np.lexsort((owner, token, home[token]))
            owner, token, often = owner[order], token[order], often[order]
            listed = np.argsort(home, kind="stable")
            per_token = np.bincount(token, minlength=len(names)).astype(np.uint32)
            ends = np.searchsorted(home[listed], np.arange(buckets + 1))
            cut = np.searchsorted(home[token], np.arange(buckets + 1))
            ids, lengths = (np.array(c, object) for c in zip(*rows))
            known = np.array([i is not None for i in ids], np.uint8)
            head = _pack(np.where(known, ids, 0).astype(np.int64), known, lengths.astype(np.int64))
            made: list[tuple] = [(-1 - block % buckets, block, len(rows), head)]
            for k in range(buckets):
                own = listed[ends[k] : ends[k + 1]]
                if len(own):
                    blob = [names[i] for i in own]
                    lengths = np.fromiter(map(len, blob), np.uint32, len(blob))
                    at = slice(cut[k], cut[k + 1])
                    text = np.frombuffer(b"".join(blob), np.uint8)
                    made.append((k, block, len(rows), _pack(lengths, per_token[own], owner[at], often[at], text)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*made), _ROW)], schema=_ROW)

        for b in batches:
            for number, n_bytes, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                counts = Counter(pretokens(text))
                which.append([index.setdefault(t, len(index)) for t in counts])
                times.append(list(counts.values()))
                rows.append((number, n_bytes))
                size += n_bytes
                if size >= BLOCK_BYTES:
                    yield from flush()
                    index, rows, which, times, size, block = {}, [], [], [], 0, block + 1
        if rows:
            yield from flush()

    return run


def _join_counts(model: str):
    """Rows sorted by bucket: partial sums of pieces for the documents of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = load_model(model)
        current, pieces = None, {}
        for b in batches:
            for bucket, block, docs, payload in zip(*(b.column(i).to_pylist() for i in range(4))):
                if bucket != current:
                    current, pieces = bucket, {}
                if bucket < 0:
                    head, sums = payload, None
                else:
                    lengths, per_token, owner, often, text = _unpack(
                        payload, np.uint32, np.uint32, np.uint32, np.uint32, np.uint8
                    )
                    text, at, tokens = text.tobytes(), 0, []
                    for n in lengths.tolist():
                        tokens.append(text[at : at + n])
                        at += n
                    new = [t for t in tokens if t not in pieces]
                    for first in range(0, len(new), 4096):
                        part = new[first : first + 4096]
                        pieces.update(zip(part, count_pieces(processor, [t.decode() for t in part])))
                    each = np.fromiter(map(pieces.__getitem__, tokens), np.int64, len(tokens))
                    weights = np.repeat(each, per_token) * often
                    head, sums = None, _pack(np.bincount(owner, weights, minlength=docs).astype(np.uint32))
                made = zip(_SUMS, ([block], [docs], [head], [sums]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for t, c in made], schema=_SUMS)

    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block: id, bytes and tokens of every document of the block."""
    current, heads, total = None, None, np.zeros(0, np.int64)

    def whole():
        if current is not None:
            ids, known, lengths = _unpack(heads, np.int64, np.uint8, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=known == 0), pa.array(lengths), pa.array(total)],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    for b in batches:
        for block, docs, head, sums in zip(*(b.column(i).to_pylist() for i in range(4))):
            if block != current:
                yield from whole()
                current, total = block, np.zeros(docs, np.int64)
            if head is None:
                total = total + _unpack(sums, np.uint32)[0]
            else:
                heads = head
    yield from whole()


def count_tokens(
    docs: DataFrame, model: str, limit: int = 4096, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row.

    NULL and empty texts have no bytes and no tokens. Rows are counted one by one, so repeated and
    NULL ids keep a row each; other columns are ignored and an empty table gives no rows.
    """
    need(docs, id_column, text_column)
    check_model(model)
    spark = docs.sparkSession
    prepare(spark)
    parts = shuffle_parts(spark)
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.octet_length(text).cast("long"), text.alias("text")
    )
    made = rows.mapInArrow(
        _frequencies(BUCKETS_PER_TASK * parts), "bucket int, block long, docs int, payload binary"
    )
    joined = made.repartition(parts, "bucket").sortWithinPartitions("bucket")
    partial = joined.mapInArrow(_join_counts(model), "block long, docs int, head binary, sums binary")
    totals = partial.repartition(parts, "block").sortWithinPartitions("block")
    counts = totals.mapInArrow(_add_up, "doc_id long, n_bytes long, n_tokens long")
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
