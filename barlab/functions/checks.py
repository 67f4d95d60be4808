"""Checks on a table before an operator is planned."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barlab.errors import DataValidationError
from barlab.schema import OHLCV_COLUMNS


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise DataValidationError(f"{what} lacks columns {missing}")


def require_rows(df: DataFrame, what: str = "input") -> None:
    if df.isEmpty():
        raise DataValidationError(f"{what} has no rows")


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def bar_checks() -> list[Column]:
    """Counts over a bar table that one pass can take; conditions on NULL or NaN do not hold.

    Rows; rows without symbol or time; rows with a NULL among open to volume; highs below the low, the open or the
    close; prices that are not positive; negative volumes; first and last time in milliseconds.
    """
    incomplete = F.lit(False)
    for c in OHLCV_COLUMNS:
        incomplete = incomplete | F.col(c).isNull()
    opened = F.unix_millis(F.col("open_time").cast("timestamp"))
    high, low = F.nanvl("high", F.lit(None)), F.nanvl("low", F.lit(None))
    prices = [F.nanvl(c, F.lit(None)) for c in ("open", "high", "low", "close")]
    return [
        F.count(F.lit(1)).alias("row_count"),
        _count(F.col("symbol").isNull()).alias("no_symbol"),
        _count(F.col("open_time").isNull()).alias("no_time"),
        _count(incomplete).alias("null_rows"),
        _count(
            F.coalesce(high < low, F.lit(False)) | F.coalesce(high < prices[0], F.lit(False))
            | F.coalesce(high < prices[3], F.lit(False))
        ).alias("low_high"),
        _count(F.least(*prices) <= 0).alias("bad_price"),
        _count(F.nanvl("volume", F.lit(None)) < 0).alias("bad_volume"),
        F.min(opened).alias("first_ms"),
        F.max(opened).alias("last_ms"),
    ]


def observed_row(spark: SparkSession, observed: Observation, what: str) -> DataFrame:
    """Metrics that a finished action has counted, as a table of one row; refuses a count of no rows."""
    counts = observed.get
    if not counts["row_count"]:
        raise DataValidationError(f"{what} has no rows")
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts))
