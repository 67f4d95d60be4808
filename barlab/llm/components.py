"""Connected components of an edge table by alternating large and small stars.

Every round rewrites the edges around the smallest neighbour of each node; the rounds needed
grow with the logarithm of the longest path. Each round is written to the shared folder, so
neither the lineage nor the driver grows with the graph.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.session import materialize

MAX_ROUNDS = 60


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per Arrow batch, the edges from each node to the smallest node it reaches there."""
    for b in batches:
        ends = np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()])
        nodes, flat = np.unique(ends, return_inverse=True)
        u, v = flat.reshape(2, -1)
        root = np.arange(len(nodes))
        while True:
            low = np.minimum(root[u], root[v])
            changed = (root[u] != low) | (root[v] != low)
            if not changed.any():
                break
            np.minimum.at(root, root[u], low)
            np.minimum.at(root, root[v], low)
            root = root[root]
        inner = root != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[inner]), pa.array(nodes[root[inner]])], names=["u", "v"]
        )


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u, v), u > v. The smallest neighbour replaces the others."""
    both = edges.select("u", "v")
    if large:
        both = both.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    linked = both.join(low, "u")
    if large:
        out = linked.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        # A node that is smallest itself keeps its larger neighbours; the others hand them on.
        return out.filter(F.col("u") != F.col("v")).distinct()
    out = linked.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.union(low.select("u", F.col("m").alias("v"))).filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of an edge table (a, b); the component is its smallest node.

    Nodes are longs. Self links and repeated or NULL ends are ignored; an empty table gives none.
    """
    a, b = (F.col(c).cast("long") for c in edges.columns[:2])
    tidy = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), (a + b).alias("_both"))
    tidy = tidy.filter((F.col("u") != F.col("v")) & F.col("_both").isNotNull()).drop("_both")
    current = materialize(tidy.mapInArrow(_forest, "u long, v long"), "edges")
    state = None
    for _ in range(MAX_ROUNDS):
        following = materialize(_stars(_stars(current, large=True), large=False), "edges")
        total = following.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
            F.countDistinct("u").alias("k"),
        ).first()
        current = following
        if tuple(total) == state:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        state = tuple(total)
    raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
