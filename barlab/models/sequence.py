"""A classifier over windows of feature vectors, and the sweep over its settings.

A multilayer perceptron on the flattened window stands where a recurrent network would: the
data contract (windows per symbol, label of the last row, cutoff tuned on validation) is the
same, the network is not.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.errors import DataValidationError
from barlab.operators import metrics
from barlab.operators.sequences import require_sequences, sequence_windows
from barlab.schema import FEATURE_COLUMNS

# Window length and hidden width of the five candidates (fixed values).
SWEEP = [
    {"name": "A", "seq_len": 60, "hidden": 64},
    {"name": "B", "seq_len": 30, "hidden": 64},
    {"name": "C", "seq_len": 120, "hidden": 64},
    {"name": "D", "seq_len": 60, "hidden": 128},
    {"name": "E", "seq_len": 60, "hidden": 32},
]
TOO_FEW = "too few rows"


@dataclass
class SequenceModel:
    model: PipelineModel
    columns: list[str]
    rows: int
    hidden: int
    cutoff: float
    balanced_accuracy: float


def flattened(windows: DataFrame, target: str = "target") -> DataFrame:
    flat = F.transform(F.flatten("sequence"), lambda x: x.cast("double"))
    return windows.select("symbol", "open_time", target, array_to_vector(flat).alias("features"))


def score_sequences(fitted, windows: DataFrame, target: str = "target") -> DataFrame:
    prob = vector_to_array("probability")[1]
    return fitted.transform(flattened(windows, target)).select(
        "symbol",
        "open_time",
        F.col(target).cast("int").alias("y_true"),
        prob.alias("y_prob"),
        (prob >= 0.5).cast("int").alias("y_pred"),
    )


def fit_sequence_classifier(
    train: DataFrame,
    val: DataFrame,
    columns: list[str] | None = None,
    target: str = "target",
    rows: int = 60,
    hidden: int = 64,
    max_iter: int = 20,
    seed: int = 42,
) -> SequenceModel:
    columns = columns or FEATURE_COLUMNS
    require_sequences(train, rows)
    require_sequences(val, rows)
    train_windows = sequence_windows(train, columns, target, rows)
    val_windows = sequence_windows(val, columns, target, rows, train=train)
    fitting = flattened(train_windows, target).persist(StorageLevel.MEMORY_AND_DISK)
    network = MultilayerPerceptronClassifier(
        featuresCol="features",
        labelCol=target,
        layers=[rows * len(columns), hidden, 2],
        maxIter=max_iter,
        seed=seed,
    )
    try:
        fitted = network.fit(fitting)
    finally:
        fitting.unpersist()
    scored = score_sequences(fitted, val_windows, target)
    best = metrics.threshold_search(scored).first()
    if best is None or best[0] is None:
        raise DataValidationError(f"no symbol of the validation table has {rows} rows")
    return SequenceModel(
        PipelineModel(stages=[fitted]), columns, rows, hidden, best[0], best[1]
    )


def config_sweep(
    train: DataFrame,
    val: DataFrame,
    configs: list[dict] | None = None,
    columns: list[str] | None = None,
    **fitting,
) -> tuple[DataFrame, SequenceModel | None]:
    """Fit every configuration; the first with the highest tuned balanced accuracy wins.

    A configuration whose window is longer than the rows of every symbol in a split has a row that
    says so. The two splits are kept while the configurations read them.
    """
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    val = val.persist(StorageLevel.MEMORY_AND_DISK)
    results, winner = [], None
    try:
        longest = min(
            split.groupBy("symbol").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
            for split in (train, val)
        )
        for config in configs or SWEEP:
            if config["seq_len"] > longest:
                results.append((config["name"], config["seq_len"], config["hidden"], None, None, TOO_FEW))
                continue
            fitted = fit_sequence_classifier(
                train, val, columns, rows=config["seq_len"], hidden=config["hidden"], **fitting
            )
            if winner is None or fitted.balanced_accuracy > winner.balanced_accuracy:
                winner = fitted
            results.append(
                (config["name"], fitted.rows, fitted.hidden, fitted.balanced_accuracy, fitted.cutoff, None)
            )
    finally:
        train.unpersist()
        val.unpersist()
    table = train.sparkSession.createDataFrame(
        results,
        "config string, seq_len int, hidden int, balanced_accuracy double, cutoff double, note string",
    )
    return table, winner
