"""Language identification with error-correcting output codes.

Every language has a codeword of bits. For each bit a logistic classifier over hashed byte 2- and
3-grams of the lower-cased letters tells whether the text's language has it set. Decoding takes the
codeword with the least logistic loss summed over the bits, each weighted by how reliable its
classifier was in training, so that one wrong bit is corrected by the others. A text whose two best
codewords are close is flagged as ambiguous.

The classifiers are fitted on at most ``SAMPLE`` labelled texts, chosen by a hash of their ids over
the whole table. Prediction reads every byte of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.llm import texts
from barlab.llm.shared import id_hash, in_fold, need, prepare

SAMPLE = 3_000
BUCKETS = 1 << 12
STEPS = 300
SLICE_BYTES = 1 << 18
AMBIGUOUS = 0.2
UNKNOWN = "und"

# Letters (in lower case) and the bytes of other scripts as they are; all else is a space.
_LETTER = np.full(256, 32, np.uint8)
_LETTER[0x80:] = np.arange(0x80, 256)
for _c in range(ord("a"), ord("z") + 1):
    _LETTER[_c] = _LETTER[_c - 32] = _c


def codewords(n: int) -> np.ndarray:
    """Rows of +-1: every split of up to 7 languages, else the best of some random codes."""
    if n <= 7:
        bits = max(2 ** (n - 1) - 1, 1)
        return np.array([[1 if (b + 1) >> k & 1 else -1 for b in range(bits)] for k in range(n)])
    bits, best, distance = int(np.ceil(10 * np.log2(n))), None, -1
    for seed in range(50):
        code = np.random.default_rng(seed).choice([-1, 1], (n, bits))
        least = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        if least > distance:
            best, distance = code, least
    return best


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed 2- and 3-grams in document order, and where each document's begin."""
    b = _LETTER[data].astype(np.uint32)
    two = np.zeros(len(b), np.uint32)
    three = np.zeros(len(b), np.uint32)
    two[:-1] = (b[:-1] | b[1:] << 8) * np.uint32(0x9E3779B1) >> np.uint32(20)
    three[:-2] = (b[:-2] | b[1:-1] << 8 | b[2:] << 16) * np.uint32(0x85EBCA6B) >> np.uint32(20)
    use2, use3 = np.ones(len(b), bool), np.ones(len(b), bool)
    ends = offsets[1:]
    use2[ends[ends > 0] - 1] = False
    use3[ends[ends > 0] - 1] = False
    use3[ends[ends > 1] - 2] = False
    blank = b == 32
    use2[:-1] &= ~(blank[:-1] & blank[1:])
    use3[:-2] &= ~(blank[:-2] & blank[1:-1])
    both = np.stack([two, three], axis=1).reshape(-1)
    use = np.stack([use2, use3], axis=1).reshape(-1)
    starts = np.concatenate(([0], np.cumsum(use)))[2 * offsets]
    return both[use], starts


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for _, data, offsets in texts.slices(b.column(2), SLICE_BYTES):
            grams, starts = _grams(data, offsets)
            for i in range(len(offsets) - 1):
                counts = np.bincount(grams[starts[i] : starts[i + 1]], minlength=BUCKETS)
                share = counts / max(1, starts[i + 1] - starts[i])
                rows.append(share.astype(np.float16).tobytes())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(rows, pa.binary())], names=["doc_id", "lang", "share"]
        )


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # buckets x bits
    bias: np.ndarray
    trust: np.ndarray  # weight of each bit, sum 1


def fit(x: np.ndarray, labels: list[str]) -> Model:
    """Logistic regression per bit by gradient steps with momentum, on shares of n-grams."""
    languages = sorted(set(labels))
    code = codewords(len(languages))
    y = code[[languages.index(v) for v in labels]].astype(np.float32)
    scale = 1.0 / np.maximum(np.sqrt((x * x).mean(axis=0)), 1e-4)
    x = (x * scale).astype(np.float32)
    norm = float(np.mean((x * x).sum(axis=1)))
    weights, bias = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    speed_w, speed_b = np.zeros_like(weights), np.zeros_like(bias)
    for _ in range(STEPS):
        margin = x @ weights + bias
        push = y / (1 + np.exp(np.clip(y * margin, -30, 30))) / len(x)
        speed_w = 0.9 * speed_w + x.T @ push - 1e-4 * weights / norm
        speed_b = 0.9 * speed_b + push.sum(axis=0)
        weights += speed_w * (4.0 / norm * 10)
        bias += speed_b
    right = ((x @ weights + bias) * y > 0).mean(axis=0)
    trust = np.maximum(right - 0.5, 1e-3)
    return Model(languages, code, (weights * scale[:, None]).astype(np.float64), bias.astype(np.float64), trust / trust.sum())


def decode(model: Model, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language, score in 0 to 1 and ambiguity of each row of bit margins."""
    margins = np.clip(margins, -20, 20)
    loss = np.stack([np.log1p(np.exp(-c * margins)) @ model.trust for c in model.code], axis=1)
    best = loss.argmin(axis=1)
    share = np.exp(-4.0 * (loss - loss.min(axis=1, keepdims=True)))
    ordered = np.sort(loss, axis=1)
    gap = ordered[:, 1] - ordered[:, 0] if loss.shape[1] > 1 else np.full(len(loss), np.inf)
    return best, 1.0 / share.sum(axis=1), gap < AMBIGUOUS


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(1)
            names, scores, unsure = [], [], []
            for first, data, offsets in texts.slices(column, SLICE_BYTES):
                grams, starts = _grams(data, offsets)
                summed = np.concatenate((model.weights[grams], np.zeros((1, len(model.bias)))))
                sums = np.add.reduceat(summed, np.minimum(starts[:-1], len(grams)), axis=0)
                n = np.diff(starts)
                sums[n == 0] = 0
                best, score, close = decode(model, sums / np.maximum(n, 1)[:, None] + model.bias)
                ascii_letters = np.concatenate(([0], np.cumsum((_LETTER[data] != 32) & (data < 0x80))))[offsets]
                for i in range(len(n)):
                    known = ascii_letters[i + 1] > ascii_letters[i] or any(
                        map(str.isalpha, column[first + i].as_py() or "")
                    )
                    names.append(model.languages[best[i]] if known else UNKNOWN)
                    scores.append(float(score[i]) if known else 0.0)
                    unsure.append(bool(close[i]) if known else True)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(unsure, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "ambiguous"],
            )

    return run


def train(docs: DataFrame, usable: Column, sample: int = SAMPLE) -> Model | None:
    """Fit on up to ``sample`` rows of (doc_id, lang, text); None without any labelled text."""
    order = id_hash("doc_id", "lang:")
    rows = docs.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    last = rows.select(order.alias("h")).orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if last is None:
        return None
    got = rows.filter(order <= last).mapInArrow(_features, "doc_id long, lang string, share binary").collect()
    got = sorted(got, key=lambda r: (r.doc_id, r.lang, bytes(r.share)))[: 2 * sample]
    x = np.stack([np.frombuffer(r.share, np.float16).astype(np.float32) for r in got])
    return fit(x, [r.lang for r in got])


def identify(
    docs: DataFrame,
    folds: int = 4,
    held_out: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous of every row.

    Rows of the held-out fold and with a NULL language, text or id are not learned from. NULL texts and texts
    without a letter are ``und`` with score 0, as are all texts if nothing can be learned. Other
    columns are ignored; an empty table gives no rows.
    """
    need(docs, id_column, text_column, lang_column)
    prepare(docs.sparkSession)
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(lang_column).cast("string").alias("lang"),
        F.col(text_column).cast("string").alias("text"),
    )
    held = in_fold("doc_id", folds, held_out)
    model = train(rows, ~held)
    if model is None:
        found = rows.select(
            "doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous")
        )
    else:
        found = rows.select("doc_id", "text").mapInArrow(
            _predict(model), "doc_id long, lang_pred string, score double, ambiguous boolean"
        )
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")
