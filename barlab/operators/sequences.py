"""Fixed-length windows of standardized features, and the rows eligible for one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.errors import DataValidationError
from barlab.functions.checks import require_columns
from barlab.operators.series import over_series
from barlab.schema import FEATURE_COLUMNS

SEQUENCE_ROWS = 60


def scaling_stats(train: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and sample deviation of each feature: one row of one struct per feature."""
    return train.agg(
        F.struct(
            *[
                F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")).alias(c)
                for c in columns
            ]
        ).alias("stats")
    )


def standardized(table: DataFrame, columns: list[str], train: DataFrame | None = None) -> DataFrame:
    """Features less the training mean over the training deviation (0 for a constant)."""
    stats = scaling_stats(table if train is None else train, columns)
    scaled = table.withColumn("_stats", stats.scalar())
    return scaled.withColumns(
        {
            c: F.when(F.col("_stats")[c]["std"] > 0, (F.col(c) - F.col("_stats")[c]["mean"])
                      / F.col("_stats")[c]["std"]).otherwise(0.0)
            for c in columns
        }
    ).drop("_stats")


def sequence_windows(
    table: DataFrame,
    columns: list[str] | None = None,
    target: str = "target",
    rows: int = SEQUENCE_ROWS,
    train: DataFrame | None = None,
    scale: bool = True,
    **layout,
) -> DataFrame:
    """The last ``rows`` feature vectors of each row that has so many in its symbol.

    Windows count rows, not minutes, and never cross symbols. The label is the last row's.
    """
    columns = columns or FEATURE_COLUMNS
    require_columns(table, ["symbol", "open_time", target, *columns])
    if scale:
        table = standardized(table, columns, train)
    slim = table.select(
        "symbol", "open_time", target, F.array(*[F.col(c).cast("float") for c in columns]).alias("x")
    )
    windows = over_series(
        slim,
        lambda s: s.with_columns({"sequence": F.collect_list("x").over(s.last(rows))}),
        lookback=rows - 1,
        **layout,
    )
    return windows.filter(F.size("sequence") == rows).drop("x")


def require_sequences(table: DataFrame, rows: int = SEQUENCE_ROWS) -> None:
    """Raise on a table shorter than one window."""
    found = table.limit(rows).count()
    if found < rows:
        raise DataValidationError(f"{found} rows are fewer than the sequence length {rows}")


def sequence_eligible(table: DataFrame, rows: int = SEQUENCE_ROWS, **layout) -> DataFrame:
    """Keys of the rows that end a full window, without building the windows."""
    counted = over_series(
        table.select("symbol", "open_time"),
        lambda s: s.with_columns({"_seen": F.count(F.lit(1)).over(s.last(rows))}),
        lookback=rows - 1,
        **layout,
    )
    return counted.filter(F.col("_seen") == rows).drop("_seen")


def aligned_predictions(
    predictions: DataFrame, table: DataFrame, rows: int = SEQUENCE_ROWS, **layout
) -> DataFrame:
    """Predictions on rows for which a sequence model could predict too."""
    return predictions.join(
        sequence_eligible(table, rows, **layout), ["symbol", "open_time"], "left_semi"
    )
