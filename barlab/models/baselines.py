"""Majority class and least squares on the future return."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.schema import RETURN_THRESHOLD


def majority_label(train: DataFrame, target: str = "target") -> DataFrame:
    """The commoner label, the lower one on a tie: one row, ``majority_label`` and both counts."""
    ones = F.count_if(F.col(target) == 1)
    zeros = F.count_if(F.col(target) == 0)
    return train.agg(
        F.when(ones > zeros, 1).otherwise(0).alias("majority_label"),
        zeros.alias("zeros"),
        ones.alias("ones"),
    )


def predict_majority(train: DataFrame, rows: DataFrame, target: str = "target") -> DataFrame:
    """Score every row with the training majority."""
    label = majority_label(train, target).select("majority_label").scalar()
    scored = rows.withColumn("y_pred", label)
    return scored.withColumn("y_prob", F.col("y_pred").cast("double"))


@dataclass
class ReturnModel:
    """A fitted least-squares model of the future return."""

    model: PipelineModel
    columns: list[str]
    threshold: float
    r2: float

    def predict_return(self, rows: DataFrame) -> DataFrame:
        return self.model.transform(rows).drop("_x")

    def predict_direction(self, rows: DataFrame) -> DataFrame:
        scored = self.predict_return(rows)
        return scored.withColumn(
            "y_pred", (F.col("predicted_return") > self.threshold).cast("int")
        )

    def coefficients(self) -> list[tuple[str, float]]:
        fitted = self.model.stages[-1]
        return [*zip(self.columns, map(float, fitted.coefficients)), ("intercept", fitted.intercept)]


def fit_return_model(
    train: DataFrame,
    columns: list[str],
    target: str = "future_return",
    threshold: float = RETURN_THRESHOLD,
) -> ReturnModel:
    """Ordinary least squares on unscaled features, by the normal equations in one pass."""
    assembler = VectorAssembler(inputCols=columns, outputCol="_x", handleInvalid="skip")
    ols = LinearRegression(
        featuresCol="_x",
        labelCol=target,
        predictionCol="predicted_return",
        solver="normal",
        regParam=0.0,
        standardization=False,
    )
    model = Pipeline(stages=[assembler, ols]).fit(train)
    return ReturnModel(model, columns, threshold, float(model.stages[-1].summary.r2))


def simple_regression(train: DataFrame, x: str, y: str = "future_return") -> DataFrame:
    """Slope, intercept and R² of one feature, as aggregates."""
    pair = train.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return pair.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
    )
