"""Packing and token counts: exact round trips against the libraries."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from barlab.llm import packing, token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def paths():
    p = public_tokenizers.path
    return p("byte_bpe_50k.json"), p("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def test_pieces_hold_every_id_and_sequences_have_no_gaps(docs_of, odd_rows, tokenizer):
    rows = [r for r in odd_rows if r[0] is not None]
    got = packing.pack(docs_of(rows), *paths(), tokens=512).collect()
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    texts = {r[0]: r[1] for r in rows}
    for i, pieces in by_doc.items():
        ids = np.array([*tokenizer.encode(texts[i] or "", add_special_tokens=False).ids, 0], "<u4")
        copies = sum(r[0] == i for r in rows)
        pieces = sorted(pieces, key=lambda r: r.piece)
        assert len(pieces) == copies * -(-len(ids) // 512)
        for r in pieces:
            part = ids[r.start : r.start + r.length]
            assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
        assert {r.length for r in pieces if r.piece > 0} <= {512}
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= 512
    assert len(sequences) <= -(-sum(r.length for r in got) // 512) + 1
    assert packing.pack(docs_of([]), *paths()).count() == 0


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_best_fit_respects_every_capacity(score):
    rng = np.random.default_rng(1)
    lengths = np.sort(rng.integers(1, 100, 500))[::-1]
    sequence, offset = packing.best_fit(lengths, 100, 4, 3000.0, score=score)
    for s in range(sequence.max() + 1):
        own = lengths[sequence == s]
        assert own.sum() <= 100 and len(own) <= 4
        assert (own.astype(float) ** 2).sum() <= 3000 or len(own) == 1
        assert (np.sort(offset[sequence == s]) == np.concatenate(([0], np.cumsum(own)[:-1]))).all()
    free, _ = packing.best_fit(lengths, 100, 100, 1e9)
    assert free.max() + 1 <= 1.02 * -(-lengths.sum() // 100) + 1


def test_both_encoders_agree(tokenizer):
    encode = packing.Encoder(*paths())
    for text in ["a<|endoftext|> b", "  x\t\n", "naïve café ßüñ — “q”", "中文 and ascii", "\u0085\xa0 z", "don't I'LL 12345"]:
        assert encode.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_token_counts_equal_the_library(docs_of, odd_rows):
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = odd_rows + [(20, "  a  ▁▁ b ", "en", "s"), (21, " ", "en", "s"), (22, "<0x41> \x00 é", "en", "s")]
    got = token_counts.count_tokens(docs_of(rows), model, limit=3).collect()
    library = token_counts.load_model(model)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    expected = [
        (i, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 3)
        for i, t, *_ in rows
    ]
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)
    assert token_counts.count_tokens(docs_of([]), model).count() == 0
