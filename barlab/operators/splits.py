"""Chronological train / validation / test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlab.errors import DataValidationError
from barlab.functions.checks import require_columns
from barlab.functions.timestamps import int_div, to_us
from barlab.schema import HORIZON, TRAIN_FRACTION, VALIDATION_FRACTION

SPLITS = ["train", "val", "test"]


_SECOND, _DAY = 1_000_000, 86_400_000_000


def split_boundaries(
    table: DataFrame,
    train_fraction: float = TRAIN_FRACTION,
    val_fraction: float = VALIDATION_FRACTION,
) -> DataFrame:
    """The times at which train and validation end: one row, ``train_end`` and ``val_end``.

    Each is the order statistic min(int(n p), n - 1) of all rows' times, cut to seconds. Rows are counted
    per day; the running count finds the day that holds the wanted row. Only the rows of those two days
    are then counted per second. The windows run over a row per day, and over a day's seconds.
    """
    require_columns(table, ["open_time"])
    us = to_us("open_time")
    times = table.filter(F.col("open_time").isNotNull()).select(
        int_div(us, _DAY).alias("day"), int_div(us, _SECOND).alias("second")
    )
    so_far = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    days = times.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    days = days.withColumns({"cum": F.sum("n").over(so_far), "total": F.sum("n").over(Window.partitionBy())})

    def holding(p: float) -> Column:
        """The day of the wanted row, and its place within the day."""
        index = F.least(F.floor(F.col("total") * F.lit(p)), F.col("total") - 1)
        place = F.struct(F.col("day"), (index - F.col("cum") + F.col("n")).alias("place"))
        return F.min(F.when(F.col("cum") > index, place))

    fractions = {"train_end": float(train_fraction), "val_end": float(train_fraction) + float(val_fraction)}
    wanted = days.agg(*[holding(p).alias(name) for name, p in fractions.items()])
    marked = times.withColumn("_w", wanted.select(F.struct(*fractions)).scalar())
    seconds = (
        marked.filter(F.col("day").isin(*[F.col("_w")[name]["day"] for name in fractions]))
        .groupBy("day", "second", "_w")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    in_day = Window.partitionBy("day").orderBy("second").rowsBetween(Window.unboundedPreceding, 0)
    seconds = seconds.withColumn("cum", F.sum("n").over(in_day))

    def boundary(name: str) -> Column:
        w = F.col("_w")[name]
        here = (F.col("day") == w["day"]) & (F.col("cum") > w["place"])
        return F.timestamp_seconds(F.min(F.when(here, F.col("second")))).alias(name)

    return seconds.agg(*[boundary(name) for name in fractions])


def boundary_values(table: DataFrame, **fractions) -> tuple[str, str]:
    """The two boundaries as text; raises on an empty table."""
    row = (
        split_boundaries(table, **fractions)
        .select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("train_end", "val_end")])
        .first()
    )
    if row[0] is None:
        raise DataValidationError("no rows to split")
    return row[0], row[1]


def split_column(
    train_end: str | Column, val_end: str | Column, purge_minutes: int = 0
) -> Column:
    """train / val / test, or NULL in the purged minutes after each boundary."""
    t = F.col("open_time").cast("timestamp")
    first, second = (
        F.lit(b).cast("timestamp") if isinstance(b, str) else b for b in (train_end, val_end)
    )
    purge = F.make_dt_interval(mins=F.lit(purge_minutes))
    return (
        F.when(t < first, "train")
        .when((t >= first + purge) & (t < second), "val")
        .when(t >= second + purge, "test")
    )


def chrono_split(
    table: DataFrame, train_end: str | Column, val_end: str | Column, purge_minutes: int = HORIZON
) -> DataFrame:
    """Label every row with its split and drop the purged ones."""
    labelled = table.withColumn("split", split_column(train_end, val_end, purge_minutes))
    return labelled.filter(F.col("split").isNotNull())


def chrono_split_by_fraction(
    table: DataFrame, purge_minutes: int = HORIZON, **fractions
) -> DataFrame:
    """As ``chrono_split`` with boundaries taken from the table's own times; pass a stored table."""
    bounds = split_boundaries(table, **fractions).select(F.struct("train_end", "val_end"))
    joined = table.withColumn("_ends", bounds.scalar())
    split = chrono_split(joined, F.col("_ends")["train_end"], F.col("_ends")["val_end"], purge_minutes)
    return split.drop("_ends")


def three_way(
    table: DataFrame, train_end: str, val_end: str, purge_minutes: int = 0
) -> tuple[DataFrame, DataFrame, DataFrame]:
    labelled = chrono_split(table, train_end, val_end, purge_minutes)
    return tuple(labelled.filter(F.col("split") == name).drop("split") for name in SPLITS)


def split_balance(split_table: DataFrame, target: str = "target") -> DataFrame:
    """Rows and positive rate of each split."""
    return split_table.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.avg(target).alias("positive_rate")
    )
