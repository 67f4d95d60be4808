"""Approximate nearest neighbours by inner product with learned partitions.

1. On at most ``SAMPLE`` vectors, chosen by a hash of their ids, the exact neighbour graph is built
   and cut into balanced parts: halves by principal direction first, then moves of vectors to the
   part that holds most of their neighbours, within a capacity.
2. A softmax classifier learns the part of a vector. Every row is indexed under its most probable
   part, and a query goes to its most probable parts, as many as the sample's own neighbours need to
   be found with share ``RECALL``.
3. Parts are dealt to blocks of about ``BLOCK_ROWS`` rows by a hash of the id, so a part that many
   equal vectors share is many tasks. Each block ranks its rows for the queries routed to its part,
   and the best of all blocks are merged.
4. A query that found fewer vectors than exist and are wanted goes to all other parts as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlab.llm.shared import id_hash, need, prepare, shuffle_parts
from barlab.session import materialize

SAMPLE = 6_000
PART_ROWS = 2_048  # wanted rows of a part
SAMPLE_PER_PART = 96  # at least; more parts could not be learned
BLOCK_ROWS = 4_096
QUERY_BATCH = 256
GRAPH_NEIGHBOURS = 10
RECALL = 0.97


def _vectors(column: pa.Array) -> tuple[np.ndarray, list]:
    """Whether each row is a usable vector (finite, not zero), and the rows as doubles."""
    rows = column.to_pylist()
    made, use = [], np.zeros(len(rows), bool)
    for i, v in enumerate(rows):
        x = None
        if v is not None and len(v) and None not in v:
            x = np.array(v, np.float64)
            use[i] = np.isfinite(x).all() and bool(x.any())
        made.append(x)
    return use, made


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        use, rows = _vectors(b.column(1))
        use &= np.array([i is not None for i in b.column(0).to_pylist()], bool)
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0).filter(pa.array(use)),
                pa.array([r.tobytes() for r, u in zip(rows, use) if u], pa.binary()),
            ],
            names=["vec_id", "vector"],
        )


def _nearest(x: np.ndarray, k: int) -> np.ndarray:
    """The k best other rows of each row, in blocks."""
    out = np.empty((len(x), k), np.int64)
    for s in range(0, len(x), 512):
        scores = x[s : s + 512] @ x.T
        scores[np.arange(len(scores)), np.arange(s, s + len(scores))] = -np.inf
        out[s : s + 512] = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 8, slack: float = 1.1) -> np.ndarray:
    """Parts of equal size (up to ``slack``) that keep neighbours together; ``parts`` is a power of 2."""
    label = np.zeros(len(x), np.int64)
    count = 1
    while count < parts:  # halve every part at the median of its main direction
        for p in range(count):
            own = np.flatnonzero(label == p)
            centred = x[own] - x[own].mean(axis=0)
            direction = np.ones(x.shape[1]) / np.sqrt(x.shape[1])
            for _ in range(20):
                direction = centred.T @ (centred @ direction)
                direction /= max(np.linalg.norm(direction), 1e-30)
            order = np.argsort(centred @ direction, kind="stable")
            label[own[order[len(own) // 2 :]]] = p + count
        count *= 2
    capacity = int(np.ceil(len(x) / parts * slack))
    sizes = np.bincount(label, minlength=parts)
    for _ in range(rounds):
        moved = 0
        votes = np.zeros((len(x), parts))
        np.add.at(votes, (np.repeat(np.arange(len(x)), graph.shape[1]), label[graph].reshape(-1)), 1)
        np.add.at(votes, (graph.reshape(-1), np.repeat(label, graph.shape[1])), 1)
        gain = votes.max(axis=1) - votes[np.arange(len(x)), label]
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            to = int(votes[i].argmax())
            if sizes[to] < capacity:
                sizes[label[i]] -= 1
                sizes[to] += 1
                label[i] = to
                moved += 1
        if not moved:
            break
    return label


class Router:
    """A softmax classifier of unit vectors."""

    def __init__(self, x: np.ndarray, label: np.ndarray, parts: int, steps: int = 200):
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        self.weights = np.stack([unit[label == p].mean(axis=0) if (label == p).any() else unit[0] * 0 for p in range(parts)], axis=1) * 8
        self.bias = np.zeros(parts)
        target = np.zeros((len(x), parts))
        target[np.arange(len(x)), label] = 1
        m, v = np.zeros((x.shape[1] + 1, parts)), np.zeros((x.shape[1] + 1, parts))
        full = np.hstack([unit, np.ones((len(x), 1))])
        w = np.vstack([self.weights, self.bias])
        for t in range(1, steps + 1):  # Adam on the whole sample
            gradient = full.T @ (self._softmax(full @ w) - target) / len(x) + 1e-5 * w
            m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
            w -= 0.2 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        self.weights, self.bias = w[:-1], w[-1]

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def ranked(self, x: np.ndarray, m: int) -> np.ndarray:
        """The m most probable parts of each vector, most probable first."""
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        return np.argsort(-(unit @ self.weights + self.bias), axis=1, kind="stable")[:, :m]


def learn(x: np.ndarray, rows: int, k: int) -> tuple[Router, int, int]:
    """Router, number of parts, and how many of them a query searches."""
    wanted = min(rows / PART_ROWS, len(x) / SAMPLE_PER_PART)
    parts = 2 ** max(0, int(np.log2(max(wanted, 1))))
    if parts == 1 or len(x) <= 2 * k:
        return Router(x, np.zeros(len(x), np.int64), 1, steps=0), 1, 1
    near = _nearest(x, min(GRAPH_NEIGHBOURS, len(x) - 1))
    label = balanced_parts(x, near, parts)
    router = Router(x, label, parts)
    ranked = router.ranked(x, parts)
    home = ranked[:, 0]
    # Where the true neighbours lie in the query's order of parts, over the sample.
    sought = _nearest(x, k)
    place = np.argsort(ranked, axis=1)
    depth = place[np.repeat(np.arange(len(x)), k), home[sought].reshape(-1)]
    share = np.cumsum(np.bincount(depth, minlength=parts)) / len(depth)
    return router, parts, int(np.searchsorted(share, RECALL) + 1)


def _route(router: Router, width: int, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = np.frombuffer(b"".join(b.column(1).to_pylist()), np.float64).reshape(-1, width)
            ranked = router.ranked(x, probes)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    pa.array(ranked[:, 0].astype(np.int32)),
                    pa.array(ranked.astype(np.int32).tolist(), pa.list_(pa.int32())),
                ],
                names=["vec_id", "vector", "part", "parts"],
            )

    return run


def _best(ids, vectors, query_ids, queries, k: int):
    """Best k rows of a block for each query: (query, row, score), equal scores to the smaller id."""
    made = []
    rough = queries @ vectors.T
    keep = min(k + 1, len(ids))
    for i, q in enumerate(query_ids):
        least = np.partition(rough[i], len(ids) - keep)[len(ids) - keep]
        # Products of one pair are the same wherever it is; the bound leaves room for rounding.
        near = np.flatnonzero(rough[i] >= least - 1e-9 * max(1.0, abs(least)))
        exact = (vectors[near] * queries[i]).sum(axis=1)
        order = np.lexsort((ids[near], -exact))
        order = order[ids[near][order] != q][:k]
        made.append((np.full(len(order), q), ids[near][order], exact[order]))
    return [np.concatenate(c) for c in zip(*made)] if made else [np.zeros(0)] * 3


def _search(width: int, k: int):
    """Rows sorted by (part, block, queries last): the block's rows, then its queries in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, rows, queries, matrix = None, [], [], [], None

        def answer():
            nonlocal matrix, queries
            if ids and queries:
                if matrix is None:
                    matrix = np.frombuffer(b"".join(rows), np.float64).reshape(-1, width)
                wanted = np.frombuffer(b"".join(v for _, v in queries), np.float64).reshape(-1, width)
                q, r, s = _best(np.array(ids), matrix, [i for i, _ in queries], wanted, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q.astype(np.int64)), pa.array(r.astype(np.int64)), pa.array(s.astype(float))],
                    names=["query_id", "vec_id", "score"],
                )
            queries = []

        for b in batches:
            for part, block, query, vec_id, vector in zip(*(b.column(i).to_pylist() for i in range(5))):
                if (part, block) != key:
                    yield from answer()
                    key, ids, rows, matrix = (part, block), [], [], None
                if query:
                    queries.append((vec_id, vector))
                    if len(queries) >= QUERY_BATCH:
                        yield from answer()
                else:
                    ids.append(vec_id)
                    rows.append(vector)
        yield from answer()

    return run


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: each query's k nearest other rows that were found.

    Rows without id, and vectors that are NULL, empty, zero, hold NULL or non-finite components or
    are not as long as most, take no part. Equal scores go to the smaller id. Of rows that share an
    id all are candidates but for a query of that id. Other columns are ignored; an empty table
    gives no rows.
    """
    need(vectors, id_column, vector_column)
    spark = vectors.sparkSession
    prepare(spark)
    total = shuffle_parts(spark)
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector"))
    clean = materialize(rows.mapInArrow(_clean, "vec_id long, vector binary"), "vectors")
    widths = clean.groupBy(F.length("vector").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    usual = widths.orderBy(F.desc("n"), "w").first()
    if usual is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, count = usual["w"] // 8, usual["n"]
    clean = clean.filter(F.length("vector") == usual["w"])
    sample = clean.orderBy(id_hash("vec_id", "ann:"), "vec_id").limit(SAMPLE).collect()
    x = np.frombuffer(b"".join(r.vector for r in sample), np.float64).reshape(-1, width)
    router, parts, probes = learn(x, count, k)
    routed = materialize(
        clean.mapInArrow(_route(router, width, parts), "vec_id long, vector binary, part int, parts array<int>"),
        "routed",
    )
    sizes = routed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per part
    blocks = {r.part: -(-r.n // BLOCK_ROWS) for r in sizes}
    block_of = F.create_map(*(F.lit(v) for kv in blocks.items() for v in kv))
    own = routed.select(
        "part",
        F.pmod(F.xxhash64("vec_id"), F.element_at(block_of, F.col("part"))).cast("int").alias("block"),
        F.lit(False).alias("query"),
        "vec_id",
        "vector",
    )
    queries = routed.select("vec_id", "vector", "parts").filter(is_query)

    def found(asked: DataFrame) -> DataFrame:
        """Best k of the parts in ``parts`` of each query."""
        sent = asked.select("vec_id", "vector", F.explode("parts").alias("part"))
        sent = sent.withColumn("blocks", F.element_at(block_of, F.col("part"))).filter("blocks IS NOT NULL")
        sent = sent.select(
            "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("query"), "vec_id", "vector"
        )
        together = own.union(sent).repartition(total, "part", "block")
        together = together.sortWithinPartitions("part", "block", "query", "vec_id")
        return together.mapInArrow(_search(width, k), "query_id long, vec_id long, score double")

    def top(hits: DataFrame) -> DataFrame:
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    hits = materialize(top(found(queries.withColumn("parts", F.slice("parts", 1, probes)))), "hits")
    if probes < parts:
        got = hits.groupBy(F.col("query_id").alias("vec_id")).agg(F.count(F.lit(1)).alias("got"))
        short = queries.join(got, "vec_id", "left").filter(F.coalesce("got", F.lit(0)) < min(k, count - 1))
        short = materialize(short.select("vec_id", "vector", F.slice("parts", probes + 1, parts).alias("parts")), "short")
        if not short.isEmpty():
            hits = top(hits.drop("rank").union(found(short)))
    return hits.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
