"""Inputs of the registered queries, all derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.functions.timestamps import to_ms, to_us
from barlab.operators import features, metrics
from barlab.schema import DAY_MS
from barlab.session import materialize, scratch_dir
from barlab.sources.adapters import bars_from_events, bars_from_lineitem, read_table
from barlab.sources.sinks import write_bars
from barlab.sources.tables import load_bars

HOUR_MS = 3_600_000
EVENT_TYPES = ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW"]
TOP_SUPPLIERS = [f"S{i}USDT" for i in range(20)]
TOP_GROUPS = [f"{t}{i}USDT" for t in EVENT_TYPES for i in range(4)]
GROUPS = 20


def hourly(spark: SparkSession, d: str) -> DataFrame:
    return bars_from_events(spark, d, "hour")


def daily(spark: SparkSession, d: str) -> DataFrame:
    return bars_from_lineitem(spark, d)


def stored_daily(spark: SparkSession, d: str) -> DataFrame:
    """Daily bars as a stored table: windows read bars for their segments and then again for the values,
    which would group all order lines each time."""
    return materialize(daily(spark, d), "bars")


def grouped_daily(spark: SparkSession, d: str) -> DataFrame:
    return bars_from_events(spark, d, "day", GROUPS)


def raw_lines(spark: SparkSession, d: str) -> DataFrame:
    """Order lines as raw bar rows: mixed epochs, repeated times, NULL lows and volumes.

    Twenty years on, because microseconds are told from milliseconds only after 2001.
    """
    lines = read_table(spark, d, "lineitem")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    micro = F.col("l_linenumber") % 2 == 0
    shipped = F.col("l_shipdate").cast("timestamp") + F.expr("INTERVAL 7305 DAYS")
    opened = F.when(micro, to_us(shipped)).otherwise(to_ms(shipped))
    return lines.select(
        opened.alias("_c0"),
        price.alias("_c1"),
        (price * 1.01).alias("_c2"),
        F.when(F.col("l_discount") > 0, price * 0.99).alias("_c3"),
        (price * (1 - F.col("l_discount"))).alias("_c4"),
        F.when(F.col("l_tax") > 0, F.col("l_quantity")).alias("_c5"),
        (opened + F.when(micro, DAY_MS * 1000 - 1).otherwise(DAY_MS - 1)).alias("_c6"),
        F.col("l_extendedprice").alias("_c7"),
        F.col("l_linenumber").alias("_c8"),
        (F.col("l_quantity") * F.col("l_discount")).alias("_c9"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("_c10"),
        F.lit(0.0).alias("_c11"),
        F.concat(F.lit("S"), F.col("l_suppkey"), F.lit("USDT")).alias("symbol"),
    )


def labelled(spark: SparkSession, d: str) -> DataFrame:
    """Features and labels as a stored table: what reads it takes several passes."""
    return materialize(features.labelled_features(hourly(spark, d), bar_ms=HOUR_MS), "labelled")


def every_model(spark: SparkSession, d: str) -> DataFrame:
    """Predictions of three fixed scores, so that metrics have an exact expected value."""
    table = labelled(spark, d)
    clamp = lambda c: F.least(F.greatest(F.col(c), F.lit(0.0)), F.lit(1.0))
    scores = {
        "rsi": F.col("rsi_14") / 100,
        "band": clamp("bb_position"),
        "flow": clamp("taker_buy_ratio"),
    }
    rows = F.array(
        *[
            F.struct(F.lit(m).alias("model"), F.round(s, 4).alias("y_prob"))
            for m, s in scores.items()
        ]
    )
    long = table.select(
        "symbol", "open_time", "volatility_30", F.col("target").alias("y_true"), F.inline(rows)
    )
    return metrics.with_direction(long)


def predictions(spark: SparkSession, d: str) -> DataFrame:
    table = labelled(spark, d)
    scored = table.select(
        "symbol",
        "open_time",
        "volatility_30",
        F.col("target").alias("y_true"),
        F.round(F.col("rsi_14") / 100, 4).alias("y_prob"),
    )
    return metrics.with_direction(scored)


def read_bars_table(spark: SparkSession, d: str) -> DataFrame:
    """Daily bars as a stored table, the form in which features normally meet them."""
    path = scratch_dir(spark, "bars")
    write_bars(daily(spark, d), path)
    return load_bars(spark, path)
