"""A fitted forest as a relation: its saved nodes, scored level by level, and importance from its gains."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.errors import DataValidationError

# A node table up to this size is broadcast (about 100 bytes a row); beyond, it is joined by its key.
BROADCAST_NODES = 1_000_000


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of a saved MLlib forest: tree, node, feature, threshold, left, right, stats, gain.

    A leaf has left = right = -1 and no feature. ``stats`` are the class weights that reached a node.
    Only splits of continuous features are read.
    """
    saved = spark.read.parquet(f"{path.rstrip('/')}/data")
    n = "nodeData"
    inner = F.col(f"{n}.leftChild") >= 0
    split = F.col(f"{n}.split")
    nodes = saved.select(
        F.col("treeID").cast("int").alias("tree"),
        F.col(f"{n}.id").cast("int").alias("node"),
        F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner, F.get(split["leftCategoriesOrThreshold"], 0)).alias("threshold"),
        F.col(f"{n}.leftChild").alias("left"),
        F.col(f"{n}.rightChild").alias("right"),
        F.col(f"{n}.impurityStats").alias("stats"),
        F.col(f"{n}.gain").alias("gain"),
        F.when(inner, split["numCategories"]).alias("_categories"),
    )
    if not nodes.filter(F.col("_categories") >= 0).isEmpty():
        raise DataValidationError("the forest has splits of categorical features")
    return nodes.drop("_categories")


def _total(stats: str) -> F.Column:
    return F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)


def forest_votes(rows: DataFrame, nodes: DataFrame, keys: list[str], features: str = "features") -> DataFrame:
    """Per row (named by ``keys``, unique) the mean over all trees of a leaf's share of class 1.

    Every row starts at the root of every tree; one join per level moves it down. The node table has
    at most 2^(depth + 1) rows a tree and is broadcast behind a count.
    """
    shape = nodes.agg(F.max("tree").alias("trees"), F.count(F.lit(1)).alias("n")).first()
    if shape.n == 0:
        raise DataValidationError("the forest has no nodes")
    small = F.broadcast(nodes) if shape.n <= BROADCAST_NODES else nodes
    # Children have larger numbers than their parents, so the longest path is known from the nodes alone.
    depth = _depth(nodes)
    at = rows.select(
        *keys,
        vector_to_array(F.col(features)).alias("_x"),
        F.explode(F.sequence(F.lit(0), F.lit(shape.trees))).alias("tree"),
        F.lit(0).alias("node"),
    )
    step = small.select("tree", "node", "feature", "threshold", "left", "right")
    for _ in range(depth):
        goes = F.when(F.get("_x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = at.join(step, ["tree", "node"]).select(
            *keys, "_x", "tree", F.when(F.col("left") >= 0, goes).otherwise(F.col("node")).alias("node")
        )
    leaves = small.select("tree", "node", (F.col("stats")[1] / _total("stats")).alias("share"))
    return at.drop("_x").join(leaves, ["tree", "node"]).groupBy(*keys).agg(F.avg("share").alias("y_prob"))


def _depth(nodes: DataFrame) -> int:
    """Levels below the roots: the roots' children, their children, until none is left."""
    level, depth = nodes.filter("node = 0"), 0
    while True:
        inner = level.filter("left >= 0")
        below = inner.select("tree", F.explode(F.array("left", "right")).alias("node"))
        found = below.join(nodes, ["tree", "node"])
        if found.isEmpty():
            return depth
        level, depth = found, depth + 1


def importance(nodes: DataFrame) -> DataFrame:
    """(feature, importance): gains weighted by what reached the node, as shares of a tree, then of the forest."""
    gains = nodes.filter("left >= 0").select("tree", "feature", (F.col("gain") * _total("stats")).alias("g"))
    per_tree = gains.groupBy("tree").agg(F.sum("g").alias("all"))
    shares = gains.join(per_tree, "tree").groupBy("feature").agg(F.sum(F.col("g") / F.col("all")).alias("s"))
    total = shares.agg(F.sum("s")).scalar()
    return shares.select("feature", (F.col("s") / total).alias("importance"))
