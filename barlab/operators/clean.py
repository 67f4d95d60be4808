"""Projections, filters and cleaning of bar tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.functions.checks import require_columns
from barlab.functions.timestamps import epoch_timestamp
from barlab.schema import (
    BAR_COLUMNS,
    FULL_WINDOW_END,
    FULL_WINDOW_START,
    LEVERAGED_SUFFIXES,
    OHLCV_COLUMNS,
    QUOTE_ASSET,
    RAW_POSITIONS,
    STABLECOIN_BASES,
)


def canonical_bars(raw: DataFrame) -> DataFrame:
    """Raw positional columns plus ``symbol`` to the twelve named, typed bar columns."""
    require_columns(raw, [*RAW_POSITIONS, "symbol"], "raw bar table")
    types = {"open_time": None, "close_time": None, "number_of_trades": "int"}
    columns = []
    for position, name in RAW_POSITIONS.items():
        kind = types.get(name, "double")
        value = epoch_timestamp(position) if kind is None else F.col(position).cast(kind)
        columns.append(value.alias(name))
    return raw.select(*columns, F.col("symbol").cast("string").alias("symbol"))


def drop_nan_prices(bars: DataFrame) -> DataFrame:
    """NaN sorts above every number in Spark, so it must not reach a comparison."""
    keep = F.lit(True)
    for c in OHLCV_COLUMNS:
        keep = keep & ~F.coalesce(F.isnan(c), F.lit(False))
    return bars.filter(keep)


def filter_symbol(bars: DataFrame, symbol: str) -> DataFrame:
    return bars.filter(F.col("symbol") == symbol)


def filter_symbols(bars: DataFrame, symbols: list[str]) -> DataFrame:
    return bars.filter(F.col("symbol").isin(symbols))


def base_asset(symbol: Column) -> Column:
    return F.substring(symbol, F.lit(1), F.length(symbol) - len(QUOTE_ASSET))


def is_tradable(
    symbol: Column | str = "symbol",
    suffixes: list[str] | None = None,
    stablecoins: list[str] | None = None,
) -> Column:
    """Quoted in USDT, not a leveraged token, base not a stablecoin.

    The suffix rule looks only at the base name, so it also drops genuine coins such as JUP.
    """
    symbol = F.col(symbol) if isinstance(symbol, str) else symbol
    base = base_asset(symbol)
    keep = symbol.endswith(QUOTE_ASSET)
    for suffix in LEVERAGED_SUFFIXES if suffixes is None else suffixes:
        keep = keep & ~base.endswith(suffix)
    return keep & ~base.isin(STABLECOIN_BASES if stablecoins is None else stablecoins)


def tradable_universe(bars: DataFrame, **rules) -> DataFrame:
    return bars.filter(is_tradable(**rules))


def filter_window(
    bars: DataFrame, start: str = FULL_WINDOW_START, end: str = FULL_WINDOW_END
) -> DataFrame:
    """Bars opening in [start, end)."""
    opened = F.col("open_time")
    return bars.filter(
        (opened >= F.lit(start).cast("timestamp")) & (opened < F.lit(end).cast("timestamp"))
    )


def null_row_flag(columns: list[str] | None = None) -> Column:
    """1 where any of the columns is NULL."""
    any_null = F.lit(False)
    for c in columns or OHLCV_COLUMNS:
        any_null = any_null | F.col(c).isNull()
    return F.when(any_null, 1).otherwise(0)


def null_rows(bars: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return bars.withColumn("is_null_row", null_row_flag(columns))


def drop_incomplete(table: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows complete in the named columns, or in all columns."""
    return table.dropna(subset=columns or table.columns)


def dedup_bars(bars: DataFrame) -> DataFrame:
    """One bar per (symbol, open_time): the smallest by all other columns in order.

    A minimum combines on the map side, so a bar copied any number of times shuffles once
    per input partition. Bars without symbol or time have no key; each is a group of its own.
    """
    require_columns(bars, BAR_COLUMNS)
    keys = ["symbol", "open_time"]
    rest = [c for c in bars.columns if c not in keys]
    keyless = F.col("symbol").isNull() | F.col("open_time").isNull()
    alone = bars.withColumn("_alone", F.when(keyless, F.monotonically_increasing_id()))
    first = alone.groupBy(*keys, "_alone").agg(F.min(F.struct(*rest)).alias("_bar"))
    return first.select(*keys, "_bar.*").select(*bars.columns)


def with_tier(
    table: DataFrame,
    top_symbols: list[str],
    in_cohort: str = "in_cohort",
    labels: tuple[str, str, str] = ("listed", "full history", "other"),
) -> DataFrame:
    """Tier of a symbol: the listed set first, then the cohort flag, then the rest."""
    require_columns(table, ["symbol", in_cohort])
    tier = (
        F.when(F.col("symbol").isin(top_symbols), labels[0])
        .when(F.col(in_cohort), labels[1])
        .otherwise(labels[2])
    )
    return table.withColumn("tier", tier)
