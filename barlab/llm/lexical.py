"""The documents that rank highest for each item of a query set, by dual-tree search.

Terms are runs of ASCII letters and digits and characters beyond ASCII, with A-Z lowered. A document of
n terms has m = 75 + (25 n N) div L; a term that it holds tf times has impact
(1000000000 tf) div (1000 tf + 12 m) there; its weight is floor(1000 ln((2N + 2) / (2 df + 1))). The
score is the sum of weight times impact over the item's terms, repeats included. N, L and df cover all
documents that have a term.

Items are taken in blocks. For each block, one scan of the texts writes per document its length and how
often it holds the block's terms; all later steps read that table. In a task, documents come in batches.
Of a batch, documents that cannot reach any item's k-th score by the maxima of all items are dropped;
the others are ordered by their heaviest term and cut into a tree of leaves and groups; items are
ordered by the score that they have to beat and cut likewise. Every node of either tree holds coordinate
maxima: of impacts, or of weights. The product of two nodes' maxima bounds every score between them. A
pair of nodes whose bound is below the weakest k-th score among the node's items is dropped with all its
documents; the others are split until single documents are scored, those of the highest bound first. So
nothing is lost. A first search over one document in ``SEED`` gives k-th scores from which the search
over all documents starts, so that tasks return few rows.

Terms are known by 64-bit hashes. Defined results: NULL texts have no terms; documents without a term do
not count; repeated rows and rows of equal or NULL ids are documents of their own, NULL ids last among
equal scores; each row of the items is an item of its own; an item without terms, or none of whose terms
any document holds, has no rows; empty tables give no rows; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlab.llm import terms, texts
from barlab.llm.shared import need, prepare
from barlab.session import materialize

BLOCK_ITEMS = 512
BLOCK_TERMS = 16_384
SEED = 32
LEAF = 8
FAN = 8
CELLS = 4 << 20

_VECTORS = "doc_id long, n long, term array<int>, tf array<long>"
_FOUND = "item long, doc_id long, score long"


class Items:
    """A block of items: rows, and their term counts over a sorted vocabulary of hashes."""

    def __init__(self, rows: list[tuple[int, np.ndarray]]):
        self.rows = [i for i, _ in rows]
        self.vocabulary = np.unique(np.concatenate([h for _, h in rows]))
        self.counts = [np.unique(terms.lookup(self.vocabulary, h), return_counts=True) for _, h in rows]


def blocks_of(items: DataFrame, most_items: int, most_terms: int) -> Iterator[Items]:
    """Blocks of at most ``most_items`` items and ``most_terms`` different terms (a single item may have more)."""
    rows: list[tuple[int, np.ndarray]] = []
    seen: set[int] = set()
    for r in items.select("item", "text").toLocalIterator():
        hashes = terms.of_text(r.text)
        if not len(hashes):
            continue
        own = set(hashes.tolist())
        if rows and (len(rows) == most_items or len(seen | own) > most_terms):
            yield Items(rows)
            rows, seen = [], set()
        rows.append((r.item, hashes))
        seen |= own
    if rows:
        yield Items(rows)


def _vectors(vocabulary: np.ndarray):
    size = len(vocabulary)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in texts.slices(batch.column(1)):
                hashes, firsts = terms.hashed(data, offsets)
                made = len(offsets) - 1
                at = terms.lookup(vocabulary, hashes)
                doc = np.repeat(np.arange(made), np.diff(firsts))
                key, tf = np.unique(doc[at >= 0] * size + at[at >= 0], return_counts=True)
                bounds = pa.array(np.searchsorted(key // size, np.arange(made + 1)), pa.int32())
                out = pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, made),
                        pa.array(np.diff(firsts)),
                        pa.ListArray.from_arrays(bounds, pa.array(key % size, pa.int32())),
                        pa.ListArray.from_arrays(bounds, pa.array(tf, pa.int64())),
                    ],
                    names=["doc_id", "n", "term", "tf"],
                )
                yield out.filter(pa.array(np.diff(firsts) > 0))

    return read


def impacts(n: np.ndarray, tf: np.ndarray, documents: int, length: int) -> np.ndarray:
    """Impact of a term that a document of n terms holds tf times."""
    if 25 * documents * int(n.max(initial=0)) < 1 << 63:
        m = 75 + 25 * n * documents // length
    else:
        m = np.array([75 + 25 * int(x) * documents // length for x in n], np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class DualTree:
    """The k best documents per item among those offered so far."""

    def __init__(self, weights: list[tuple[np.ndarray, np.ndarray]], size: int, k: int, floors: np.ndarray):
        """``weights``: per item its terms and their weights (positive); ``floors``: scores to reach at least."""
        self.size, self.k = size, k
        self.weights = weights
        self.kth = np.maximum(floors, 1).astype(np.int64)
        order = np.argsort(self.kth, kind="stable")
        self.groups = [order[i : i + FAN] for i in range(0, len(order), FAN)]
        self.group_max = [self._maxima(g) for g in self.groups]
        self.root_top = np.zeros(size)
        at, top = self._maxima(order)
        self.root_top[at] = top
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in weights]
        self.scored = 0

    def _maxima(self, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        top = np.zeros(self.size)
        for i in items:
            term, weight = self.weights[i]
            top[term] = np.maximum(top[term], weight)
        term = np.flatnonzero(top)
        return term, top[term]

    def offer(self, ids: np.ndarray, missing: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
        """A batch of documents: ids, and (document, term, impact) of what they hold."""
        if not len(ids) or not len(term):
            return
        reach = np.bincount(doc, impact * self.root_top[term], minlength=len(ids))
        # Slack for sums beyond 2^53, where doubles round.
        slack = 1 + 1e-9
        # Documents that could rank, those with the same heaviest term together.
        value = impact * self.root_top[term]
        heaviest = np.full(len(ids), -1)
        by_value = np.argsort(value, kind="stable")
        heaviest[doc[by_value]] = term[by_value]
        order = np.lexsort((-reach, heaviest))
        order = order[reach[order] * slack >= self.kth.min()]
        used = len(order)
        if not used:
            return
        place = np.full(len(ids), -1)
        place[order] = np.arange(used)
        kept = place[doc] >= 0
        dense = np.zeros((used, self.size))
        dense[place[doc[kept]], term[kept]] = impact[kept]
        ids, missing = ids[order], missing[order]
        leaves = np.maximum.reduceat(dense[:used], np.arange(0, used, LEAF))
        groups = np.maximum.reduceat(leaves, np.arange(0, len(leaves), FAN))
        for own, (at, top) in zip(self.groups, self.group_max, strict=True):
            wide = np.flatnonzero((groups[:, at] @ top) * slack >= self.kth[own].min())
            if not len(wide):
                continue
            below = (wide[:, None] * FAN + np.arange(FAN)).ravel()
            below = below[below < len(leaves)]
            for i in own:
                term_i, weight = self.weights[i]
                bound = (leaves[np.ix_(below, term_i)] @ weight) * slack
                best_first = np.argsort(-bound, kind="stable")
                below_i, bound = below[best_first], bound[best_first]
                done, step = 0, 2
                # The best leaves first: they raise the score that the others have to reach.
                while done < len(bound) and bound[done] >= self.kth[i]:
                    now = below_i[done : done + step][bound[done : done + step] >= self.kth[i]]
                    rows = (now[:, None] * LEAF + np.arange(LEAF)).ravel()
                    self._score(i, dense, rows[rows < used], ids, missing)
                    done, step = done + step, 2 * step

    def _score(self, i: int, dense: np.ndarray, rows: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        term, weight = self.weights[i]
        self.scored += len(rows)
        score = dense[np.ix_(rows, term)].astype(np.int64) @ weight
        high = score >= self.kth[i]
        if not high.any():
            return
        merged = [np.concatenate(x) for x in zip(self.best[i], (score[high], ids[rows[high]], missing[rows[high]]), strict=True)]
        order = np.lexsort((merged[1], merged[2], -merged[0]))[: self.k]
        self.best[i] = tuple(x[order] for x in merged)
        if len(order) == self.k:
            self.kth[i] = max(self.kth[i], merged[0][order[-1]])


def _search(weights, size: int, k: int, floors: np.ndarray, rows: np.ndarray, documents: int, length: int):
    batch_rows = max(LEAF, min(2048, CELLS // max(size, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = DualTree(weights, size, k, floors)
        for batch in batches:
            for first in range(0, batch.num_rows, batch_rows):
                part = batch.slice(first, batch_rows)
                held, tf = (part.column(c).combine_chunks() if hasattr(part.column(c), "combine_chunks") else part.column(c) for c in (2, 3))
                sizes = np.diff(held.offsets.to_numpy())
                n = part.column(1).to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(part.num_rows), sizes)
                missing = part.column(0).is_null().to_numpy(zero_copy_only=False)
                ids = part.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                impact = impacts(n[doc], tf.flatten().to_numpy(zero_copy_only=False), documents, length)
                tree.offer(ids, missing, doc, held.flatten().to_numpy(zero_copy_only=False), impact)
        for i, (score, ids, missing) in enumerate(tree.best):
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(score), rows[i])), pa.array(ids, mask=missing), pa.array(score)],
                    names=["item", "doc_id", "score"],
                )

    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search_block(docs: DataFrame, items: Items, k: int, seed: int = SEED) -> DataFrame | None:
    """(item, rank, doc_id, score) of one block's items, or None where no document has a term."""
    vectors = materialize(docs.mapInArrow(_vectors(items.vocabulary), _VECTORS), "lexical-vectors")
    documents, length = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not documents:
        return None
    held = vectors.select(F.explode("term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    df = dict(map(tuple, held.collect()))
    weight = np.zeros(len(items.vocabulary), np.int64)
    for t, n in df.items():
        weight[t] = math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1)))
    weights = []
    for term, count in items.counts:
        own = weight[term] > 0
        weights.append((term[own], weight[term[own]] * count[own]))
    size, rows = len(items.vocabulary), np.array(items.rows, np.int64)
    floors = np.zeros(len(rows), np.int64)
    if seed > 1:
        some = vectors.filter(F.pmod(F.xxhash64("doc_id", "n"), F.lit(seed)) == 0)
        first = some.mapInArrow(_search(weights, size, k, floors, rows, documents, length), _FOUND)
        place = {item: i for i, item in enumerate(items.rows)}
        for item, score in _top(first, k).filter(F.col("rank") == k).select("item", "score").collect():
            floors[place[item]] = score
    found = vectors.mapInArrow(_search(weights, size, k, floors, rows, documents, length), _FOUND)
    return _top(found, k).select("item", "rank", "doc_id", "score")


def rank(
    docs: DataFrame, items: DataFrame, k: int = 20, most_items: int = BLOCK_ITEMS, most_terms: int = BLOCK_TERMS, seed: int = SEED
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring documents of every item, scores above 0."""
    need(docs, "doc_id", "text")
    need(items, "item_id", "text")
    spark = docs.sparkSession
    prepare(spark)
    texts_ = docs.select(F.col("doc_id").cast("long"), "text")
    numbered = materialize(
        items.select("item_id", "text", F.monotonically_increasing_id().alias("item")), "lexical-items"
    )
    found = None
    for block in blocks_of(numbered, most_items, most_terms):
        part = search_block(texts_, block, k, seed)
        if part is not None:
            part = materialize(part, "lexical-found")
            found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], "item long, rank int, doc_id long, score long")
    return found.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
