"""Quality by importance resampling.

Two bag-of-hashed-n-grams models, one of the target texts (labelled good) and one of all raw
texts, give every text the logarithm of its importance: the mean over its word 1- and 2-grams of
log p_target / p_raw, times ``LENGTH`` grams, so that long texts do not get larger weights. With
Gumbel noise added, the k largest keys are a sample without replacement in proportion to the
importance. The noise is a hash of the id, so reruns agree.

Both models count every n-gram of every text; a task sends one table of ``BUCKETS`` counts. The
k-th key is found from counts per range of keys, and only the range that holds it is ordered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlab.llm import texts
from barlab.llm.shared import id_hash, keep_ids, need, prepare
from barlab.session import materialize

BUCKETS = 1 << 14
LENGTH = 100.0
SHARE = 0.9
RANGES = 256  # of keys, per unit


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the 1-grams and 2-grams of each document in turn, and the documents' bounds."""
    starts, ends, firsts = texts.word_spans(data, offsets)
    words = texts.word_hashes(texts.lowered(data), starts, ends)
    pairs = texts.mix(words[:-1] * np.uint64(3) + words[1:]) if len(words) else words
    both = np.zeros((len(words), 2), np.int64)
    both[:, 0] = words >> np.uint64(50)
    both[: len(pairs), 1] = pairs >> np.uint64(50)
    use = np.ones((len(words), 2), bool)
    last = firsts[1:][np.diff(firsts) > 0] - 1
    use[last, 1] = False
    bounds = np.concatenate(([0], np.cumsum(use.sum(axis=1))))[firsts]
    return both.reshape(-1)[use.reshape(-1)], bounds


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for b in batches:
        for _, data, offsets in texts.slices(b.column(0)):
            total += np.bincount(_grams(data, offsets)[0], minlength=BUCKETS)
    there = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["bucket", "n"])


def _weigh(ratio: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for _, data, offsets in texts.slices(b.column(1)):
                grams, bounds = _grams(data, offsets)
                sums = np.add.reduceat(np.append(ratio[grams], 0.0), np.minimum(bounds[:-1], len(grams)))
                n = np.diff(bounds)
                out.append(np.where(n > 0, sums / np.maximum(n, 1), ratio.min()) * LENGTH)
            out = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out)], names=["doc_id", "log_weight"])

    return run


def model(rows: DataFrame) -> np.ndarray:
    """Bucket probabilities of a table of texts, each bucket seen once more than it is."""
    counts = rows.mapInArrow(_count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.ones(BUCKETS)
    for bucket, n in counts.collect():  # at most BUCKETS rows
        total[bucket] += n
    return total / total.sum()


def sample(
    docs: DataFrame,
    labels: DataFrame,
    share: float = SHARE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, log_weight, key and kept of every row; ceil(share * rows) rows are kept.

    NULL and empty texts have the weight of the worst n-gram. Rows without id share one noise. Equal
    rows at the cut are all kept. Labels that are NULL or of no row are ignored; without good labels
    all weights are equal. Other columns are ignored; an empty table gives no rows.
    """
    need(docs, id_column, text_column)
    need(labels, "doc_id", "quality")
    prepare(docs.sparkSession)
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1").select("doc_id")
    good = materialize(good, "good")
    raw = model(rows.select("text"))
    target = raw if good.isEmpty() else model(keep_ids(rows, "doc_id", good).select("text"))
    ratio = np.log(target) - np.log(raw)
    weighed = rows.mapInArrow(_weigh(ratio), "doc_id long, log_weight double")
    uniform = (id_hash("doc_id", "gumbel:") + F.lit(0.5)) / F.lit(float(1 << 60))
    keyed = weighed.withColumn("key", F.col("log_weight") - F.log(-F.log(uniform)))
    return _top(materialize(keyed, "keys"), share)


def _top(rows: DataFrame, share: float) -> DataFrame:
    """Adds kept: whether the row is among the largest share of keys."""
    order = F.struct("key", F.coalesce("doc_id", F.lit(-1)).alias("i"))
    slot = F.floor(F.col("key") * RANGES)
    slots = rows.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    slots = slots.withColumn("total", F.sum("n").over(Window.orderBy(F.desc("slot"))))
    wanted = -(-int(rows.count() * round(share * 1000)) // 1000)
    found = slots.filter(F.col("total") >= wanted).agg(F.max(F.struct("slot", F.col("total") - F.col("n")))).first()[0]
    if found is None:
        return rows.withColumn("kept", F.lit(True))
    place = F.row_number().over(Window.orderBy(order.desc()))
    inside = rows.filter(slot == found[0]).select(order.alias("o"), place.alias("place"))
    last = inside.filter(F.col("place") == wanted - found[1]).select("o.*").first()
    if last is None:
        return rows.withColumn("kept", slot > found[0])
    end = F.struct(F.lit(last[0]).alias("key"), F.lit(last[1]).cast("long").alias("i"))
    return rows.withColumn("kept", order >= end)
