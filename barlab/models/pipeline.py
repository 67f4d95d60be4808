"""Scaling, logistic regression and random forest, trained and validated on Spark."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import SparkContext, StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.functions.checks import require_columns, require_rows
from barlab.operators import metrics
from barlab.schema import FEATURE_COLUMNS

LOGISTIC, FOREST = "logistic_regression", "random_forest"


def regularization_from_c(c: float, rows: int) -> float:
    """MLlib's penalty for an inverse strength C summed over rows: 1 / (C n)."""
    return 1.0 / (c * rows)


def scaling_stages(columns: list[str], out: str = "features") -> list[Estimator]:
    """Assemble the columns (rows with NULL or NaN skipped) and standardize (sample deviation)."""
    return [
        VectorAssembler(inputCols=columns, outputCol="raw_features", handleInvalid="skip"),
        StandardScaler(inputCol="raw_features", outputCol=out, withMean=True, withStd=True),
    ]


def scaled_features(train: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """Replace the columns of ``rows`` by values standardized with training statistics."""
    model = Pipeline(stages=scaling_stages(columns)).fit(train)
    scaled = model.transform(rows).withColumn("_z", vector_to_array("features"))
    return scaled.withColumns({c: F.col("_z")[i] for i, c in enumerate(columns)}).drop(
        "_z", "features", "raw_features"
    )


def logistic(target: str = "target", reg_param: float = 0.1, max_iter: int = 100) -> Estimator:
    return LogisticRegression(
        featuresCol="features", labelCol=target, maxIter=max_iter, regParam=reg_param
    )


def forest(
    target: str = "target",
    trees: int = 100,
    depth: int = 10,
    subsampling: float = 1.0,
    seed: int = 42,
) -> Estimator:
    return RandomForestClassifier(
        featuresCol="features",
        labelCol=target,
        numTrees=trees,
        maxDepth=depth,
        subsamplingRate=subsampling,
        seed=seed,
    )


def without_summary(fitted: Model) -> Model:
    """The fitted stage without its training summary, which is not used here.

    A binary classifier's summary holds the session, and scoring sends the model to the tasks: that
    fails in a session in which an ``Observation`` was ever taken (``sinks.write_checked``), as such a
    session cannot be serialized.
    """
    if getattr(fitted, "hasSummary", False):
        none = SparkContext._active_spark_context._jvm.scala.Option.empty()
        fitted._java_obj.setSummary(none)
    return fitted


def fit(stages: list[Estimator], train: DataFrame) -> PipelineModel:
    """A fitted pipeline that can score in any session."""
    fitted = Pipeline(stages=stages).fit(train)
    return PipelineModel(stages=[without_summary(s) for s in fitted.stages])


def score(model: PipelineModel, rows: DataFrame, target: str = "target") -> DataFrame:
    """Prediction table of a fitted classifier: keys, ``y_true``, ``y_prob``, ``y_pred``.

    ``y_pred`` is the model's own decision; apply ``metrics.with_direction`` for a cutoff.
    """
    carried = [c for c in ("symbol", "open_time", "volatility_30", "split") if c in rows.columns]
    return model.transform(rows).select(
        *carried,
        F.col(target).cast("int").alias("y_true"),
        vector_to_array("probability")[1].alias("y_prob"),
        F.col("prediction").cast("int").alias("y_pred"),
    )


@dataclass
class TrainedModels:
    models: dict[str, PipelineModel]
    columns: list[str]
    metrics: DataFrame
    cutoffs: dict[str, float] = field(default_factory=dict)


def train_pipeline(
    train: DataFrame,
    val: DataFrame,
    columns: list[str] | None = None,
    target: str = "target",
    estimators: dict[str, Estimator] | None = None,
) -> TrainedModels:
    """Fit every classifier on train, measure it on validation, and tune its cutoff there.

    Train and validation are kept (spilling to disk) while the models read them repeatedly.
    ``metrics`` holds the binary metrics at the default decision, one row per model.
    """
    columns = columns or FEATURE_COLUMNS
    for name, part in (("training table", train), ("validation table", val)):
        require_columns(part, [*columns, target], name)
    train, val = (part.dropna(subset=[*columns, target]) for part in (train, val))
    require_rows(train, "training table")
    require_rows(val, "validation table")
    estimators = estimators or {LOGISTIC: logistic(target), FOREST: forest(target)}
    train = train.select(*columns, target).persist(StorageLevel.MEMORY_AND_DISK)
    val = val.persist(StorageLevel.MEMORY_AND_DISK)
    scored = None
    try:
        scaling = Pipeline(stages=scaling_stages(columns)).fit(train)
        scaled = scaling.transform(train).select("features", target)
        scaled = scaled.persist(StorageLevel.MEMORY_AND_DISK)
        models = {}
        for name, estimator in estimators.items():
            fitted = without_summary(estimator.fit(scaled))
            models[name] = PipelineModel(stages=[*scaling.stages, fitted])
        scaled.unpersist()
        for name, model in models.items():
            part = score(model, val, target).withColumn("model", F.lit(name))
            scored = part if scored is None else scored.unionByName(part)
        scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
        # One row per model: small enough to hold as values that outlive the cached tables.
        table = metrics.model_ladder(scored)
        table = train.sparkSession.createDataFrame(table.collect(), table.schema)
        best = {r["model"]: r["best_cutoff"] for r in metrics.threshold_search(scored, ["model"]).collect()}
    finally:
        train.unpersist()
        val.unpersist()
        if scored is not None:
            scored.unpersist()
    return TrainedModels(models, columns, table, best)


def mllib_metrics(model: PipelineModel, rows: DataFrame, target: str = "target") -> dict[str, float]:
    """MLlib's own evaluators: weighted precision / recall / F1 and the two curve areas.

    ``numBins=0`` keeps the curves exact instead of cut to a thousand points.
    """
    predicted = model.transform(rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        out = {}
        for name, metric in (
            ("accuracy", "accuracy"),
            ("weighted_precision", "weightedPrecision"),
            ("weighted_recall", "weightedRecall"),
            ("weighted_f1", "f1"),
        ):
            out[name] = MulticlassClassificationEvaluator(
                labelCol=target, predictionCol="prediction", metricName=metric
            ).evaluate(predicted)
        for name, metric in (("area_under_roc", "areaUnderROC"), ("area_under_pr", "areaUnderPR")):
            out[name] = BinaryClassificationEvaluator(
                labelCol=target, rawPredictionCol="rawPrediction", metricName=metric, numBins=0
            ).evaluate(predicted)
    finally:
        predicted.unpersist()
    return out


def feature_importance(trained: TrainedModels, spark) -> DataFrame:
    """Forest importance and logistic coefficient per feature, most important first."""
    trees = trained.models[FOREST].stages[-1].featureImportances.toArray()
    weights = trained.models[LOGISTIC].stages[-1].coefficients.toArray()
    rows = [
        (c, float(trees[i]), float(weights[i])) for i, c in enumerate(trained.columns)
    ]
    return spark.createDataFrame(
        rows, "feature string, rf_importance double, lr_coefficient double"
    ).orderBy(F.desc("rf_importance"), "feature")


def top_coefficients(trained: TrainedModels, spark, k: int = 5) -> DataFrame:
    """The k logistic coefficients largest in size."""
    return (
        feature_importance(trained, spark)
        .select("feature", "lr_coefficient")
        .orderBy(F.desc(F.abs("lr_coefficient")), "feature")
        .limit(k)
    )


def overfit_check(
    trained: TrainedModels, split_table: DataFrame, target: str = "target"
) -> DataFrame:
    """Accuracy of every model on each split of a table with a ``split`` column."""
    out = None
    for name, model in trained.models.items():
        part = score(model, split_table, target).withColumn("model", F.lit(name))
        out = part if out is None else out.unionByName(part)
    correct = (F.col("y_true") == F.col("y_pred")).cast("int")
    return out.groupBy("model", "split").agg(
        F.count(F.lit(1)).alias("rows"), F.avg(correct).alias("accuracy")
    )
