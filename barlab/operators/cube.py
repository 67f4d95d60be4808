"""Sufficient statistics per (symbol, month, hour) and the market tables made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlab.functions.checks import require_columns
from barlab.operators.ordered import wide_quantiles
from barlab.schema import DAY_MS, MINUTE_MS

CUBE_INPUTS = [
    "symbol", "open_time", "open", "close", "volume", "quote_asset_volume",
    "number_of_trades", "taker_buy_base_asset_volume",
]


def eda_cube(bars: DataFrame) -> DataFrame:
    """Counts and sums per (symbol, month, UTC hour), in one scan and one shuffle.

    The return is close / open - 1 of a single bar, so no window is needed. A bar that opens at zero
    has none; ``n_r`` counts those that have one.
    """
    require_columns(bars, CUBE_INPUTS, "bar table")
    r = F.try_divide("close", "open") - 1.0
    return (
        bars.withColumns(
            {
                "month": F.date_format("open_time", "yyyy-MM"),
                "hour": F.hour("open_time"),
                "_r": r,
            }
        )
        .groupBy("symbol", "month", "hour")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("_r").alias("n_r"),
            F.sum("_r").alias("sum_r"),
            F.sum(F.col("_r") * F.col("_r")).alias("sum_r2"),
            F.sum(F.when(F.col("close") > F.col("open"), 1).otherwise(0)).alias("up_n"),
            F.sum("volume").alias("sum_volume"),
            F.sum("quote_asset_volume").alias("sum_quote_volume"),
            F.sum("number_of_trades").alias("sum_trades"),
            F.sum("taker_buy_base_asset_volume").alias("sum_taker_buy_base"),
        )
    )


def symbol_rollup(cube: DataFrame, bar_ms: int = MINUTE_MS) -> DataFrame:
    """Per-symbol totals with mean and deviation of the returns there are, up-share and daily volume."""
    bars_per_day = DAY_MS / bar_ms
    totals = cube.groupBy("symbol").agg(
        F.sum("n").alias("n"),
        F.sum("n_r").alias("n_r"),
        F.sum("sum_r").alias("sum_r"),
        F.sum("sum_r2").alias("sum_r2"),
        F.sum("up_n").alias("up_n"),
        F.sum("sum_volume").alias("volume"),
        F.sum("sum_quote_volume").alias("quote_volume"),
        F.sum("sum_trades").alias("trades"),
        F.sum("sum_taker_buy_base").alias("taker_base"),
    )
    n, n_r = F.col("n"), F.col("n_r")
    return totals.withColumn("mean_r", F.try_divide("sum_r", n_r)).withColumns(
        {
            "std_r": F.when(
                n_r > 0, F.sqrt(F.greatest(F.col("sum_r2") / n_r - F.col("mean_r") * F.col("mean_r"), F.lit(0.0)))
            ),
            "up_share": F.col("up_n") / n,
            "taker_ratio": F.try_divide("taker_base", "volume"),
            "quote_vol_per_day": F.col("quote_volume") / (n / F.lit(bars_per_day)),
        }
    )


def with_membership(
    rollup: DataFrame, cohort: DataFrame, top_symbols: list[str]
) -> DataFrame:
    """Flags ``in_cohort`` (a table of symbols) and ``in_top`` (a short list)."""
    flags = cohort.select("symbol").distinct().withColumn("in_cohort", F.lit(True))
    return rollup.join(flags, "symbol", "left").withColumns(
        {
            "in_cohort": F.coalesce("in_cohort", F.lit(False)),
            "in_top": F.col("symbol").isin(top_symbols),
        }
    )


def monthly_activity(cube: DataFrame) -> DataFrame:
    """Quote volume, active symbols and up-share by month.

    Summing to (symbol, month) first turns the distinct count into a plain one.
    """
    per_symbol = cube.groupBy("month", "symbol").agg(
        F.sum("sum_quote_volume").alias("q"), F.sum("n").alias("n"), F.sum("up_n").alias("up_n")
    )
    return (
        per_symbol.groupBy("month")
        .agg(
            F.sum("q").alias("quote_volume"),
            F.sum("n").alias("n"),
            F.sum("up_n").alias("up_n"),
            F.count(F.lit(1)).alias("active_symbols"),
        )
        .withColumn("up_share", F.col("up_n") / F.col("n"))
    )


def hourly_seasonality(cube: DataFrame) -> DataFrame:
    """Share of all quote volume and taker ratio by UTC hour (24 rows at most)."""
    hours = cube.groupBy("hour").agg(
        F.sum("sum_volume").alias("volume"),
        F.sum("sum_quote_volume").alias("quote_volume"),
        F.sum("sum_taker_buy_base").alias("taker_base"),
        F.sum("n").alias("n"),
        F.sum("up_n").alias("up_n"),
    )
    return hours.withColumns(
        {
            "volume_share": F.col("quote_volume")
            / F.sum("quote_volume").over(Window.partitionBy()),
            "taker_ratio": F.try_divide("taker_base", "volume"),
        }
    )


COHORT_STATS = ["quote_vol_per_day", "std_r", "up_share", "taker_ratio"]


def _group_rows(rollup: DataFrame, by: str, stats: list[str], also: dict[str, Column]) -> DataFrame:
    """One row per group: further aggregates, then the exact median of each statistic."""
    found = wide_quantiles(rollup, {c: [0.5] for c in stats}, [by], [v.alias(k) for k, v in also.items()])
    rows = [
        (*g, *(found.also[g][k] for k in also), *(found.quantiles[g][c][0] for c in stats)) for g in found.quantiles
    ]
    key = dict(rollup.dtypes)[by]
    fields = [f"`{by}` {key}", *(f"{k} long" for k in also), *(f"median_{c} double" for c in stats)]
    return rollup.sparkSession.createDataFrame(rows, ", ".join(fields))


def group_medians(rollup: DataFrame, by: str, stats: list[str] | None = None) -> DataFrame:
    """Exact median of each statistic per group, as columns ``median_<stat>``; pass a stored table.

    Groups are tiers or flags: a handful.
    """
    return _group_rows(rollup, by, stats or COHORT_STATS, {})


def cohort_medians(rollup: DataFrame) -> DataFrame:
    return group_medians(rollup, "in_cohort")


def tier_summary(tiered: DataFrame) -> DataFrame:
    """Symbols, total rows and medians per tier; pass a stored table, which is scanned twice."""
    sizes = {"symbols": F.count(F.lit(1)), "total_rows": F.sum("n")}
    return _group_rows(tiered, "tier", COHORT_STATS, sizes)


def liquidity_topk(rollup: DataFrame, k: int = 30) -> DataFrame:
    return rollup.orderBy(F.desc("quote_vol_per_day"), "symbol").limit(k)


def topk_set_diff(rollup: DataFrame, configured: list[str], k: int = 20) -> DataFrame:
    """Symbols of the data's top k and of the configured list that the other lacks."""
    ranked = liquidity_topk(rollup, k).select("symbol")
    spark = rollup.sparkSession
    listed = spark.createDataFrame([(s,) for s in configured], "symbol string")
    only_ranked = ranked.join(listed, "symbol", "left_anti")
    only_listed = listed.join(ranked, "symbol", "left_anti")
    return only_ranked.withColumn("side", F.lit("ranked_only")).unionByName(
        only_listed.withColumn("side", F.lit("configured_only"))
    )
