"""Feature bundles: indicators, their stationary forms, order flow and time of day."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.errors import DataValidationError
from barlab.functions.checks import require_columns
from barlab.operators import ema, rolling
from barlab.operators.series import Series, over_series
from barlab.schema import EPSILON, FEATURE_COLUMNS, HORIZON, OHLCV_COLUMNS, RETURN_THRESHOLD

PRICE_INPUTS = ["symbol", "open_time", *OHLCV_COLUMNS]
FLOW_INPUTS = [
    "symbol", "open_time", "volume", "number_of_trades", "taker_buy_base_asset_volume",
]
_EMA_SPANS = [9, 12, 15, 26, 50]

# Rows before a bar on which its indicators depend: the slowest average, then the signal.
INDICATOR_LOOKBACK = ema.memory_rows(50) + ema.memory_rows(9)


def _first_columns(s: Series) -> dict[str, Column]:
    """Everything that needs only input columns, so that one window pass yields it."""
    return {
        "sma_15": rolling.rolling_mean(s, "close", 15),
        "sma_50": rolling.rolling_mean(s, "close", 50),
        "log_return": rolling.log_return(s),
        **rolling.change_columns(s),
        **rolling.band_columns(s),
    }


def _after_first(s: Series) -> Series:
    """The rest of the indicators: statistics of returns and changes, then the averages."""
    s = s.with_columns(rolling.gain_columns())
    s = s.with_columns(
        {"rsi_14": rolling.rsi_column(s, 14), "volatility_30": rolling.rolling_std(s, "log_return", 30)}
    )
    s = s.with_columns(rolling.bollinger_columns()).drop(*rolling.WORK_COLUMNS)
    s = ema.with_emas(
        s,
        {
            "ema_15": ("close", 15),
            "ema_50": ("close", 50),
            "_ema_12": ("close", 12),
            "_ema_26": ("close", 26),
        },
    )
    return ema.with_macd(s).drop("_ema_12", "_ema_26")


def with_indicators(s: Series) -> Series:
    """The thirteen indicators, all windows on one sort."""
    s = ema.blocked_for(s, _EMA_SPANS)
    return _after_first(s.with_columns(_first_columns(s)))


def stationary_columns() -> dict[str, Column]:
    """Price-scale indicators relative to the close, so that symbols compare."""
    close = F.col("close")
    relative = {
        f"close_to_{name}": F.try_divide(close - F.col(name), close)
        for name in ("sma_15", "sma_50", "ema_15", "ema_50")
    }
    scaled = {
        f"{name}_norm": F.try_divide(F.col(name), close)
        for name in ("macd_line", "macd_signal", "macd_hist")
    }
    band = F.col("bb_upper") - F.col("bb_lower") + EPSILON
    return {**relative, "bb_position": (close - F.col("bb_lower")) / band, **scaled}


def hour_columns() -> dict[str, Column]:
    angle = F.lit(2 * math.pi) * F.hour("open_time") / 24.0
    return {"hour_sin": F.sin(angle), "hour_cos": F.cos(angle)}


def _flow_columns(s: Series) -> dict[str, Column]:
    ratio = F.col("taker_buy_base_asset_volume") / (F.col("volume") + EPSILON)
    return {
        "taker_buy_ratio": ratio,
        "volume_z30": rolling.rolling_zscore(s, "volume", 30),
        "trades_z30": rolling.rolling_zscore(s, "number_of_trades", 30),
        **hour_columns(),
    }


def with_flow(s: Series) -> Series:
    return s.with_columns(_flow_columns(s))


def _future_close(s: Series, horizon: int) -> dict[str, Column]:
    return {"future_close": F.lead("close", horizon).over(s.ordered())}


def _label_columns(s: Series, threshold: float) -> Series:
    s = s.with_columns(
        {"future_return": F.try_divide(F.col("future_close"), F.col("close")) - 1.0}
    )
    up = F.when(
        F.col("future_return").isNotNull(), (F.col("future_return") > threshold).cast("int")
    )
    return s.with_columns({"target": up})


def with_labels(
    s: Series, horizon: int = HORIZON, threshold: float = RETURN_THRESHOLD
) -> Series:
    """Close ``horizon`` rows ahead, its return, and whether the return beats the threshold.

    Rows with no such close keep a NULL label.
    """
    return _label_columns(s.with_columns(_future_close(s, horizon)), threshold)


# --- operators on bar tables -------------------------------------------------------------


def indicators(bars: DataFrame, **layout) -> DataFrame:
    require_columns(bars, PRICE_INPUTS)
    return over_series(bars, with_indicators, lookback=INDICATOR_LOOKBACK, **layout)


def stationary_features(indicator_table: DataFrame) -> DataFrame:
    """Relative forms of an indicator table; needs no windows."""
    require_columns(
        indicator_table,
        ["close", "sma_15", "sma_50", "ema_15", "ema_50", "bb_lower", "bb_upper",
         "macd_line", "macd_signal", "macd_hist"],
        "indicator table",
    )
    return indicator_table.withColumns(stationary_columns())


def flow_features(bars: DataFrame, **layout) -> DataFrame:
    require_columns(bars, FLOW_INPUTS)
    return over_series(bars, with_flow, lookback=29, **layout)


def hour_cycle(bars: DataFrame) -> DataFrame:
    require_columns(bars, ["open_time"])
    return bars.withColumns(hour_columns())


def _with_features(s: Series, ahead: int | None = None) -> Series:
    s = ema.blocked_for(s, _EMA_SPANS)
    first = {**_first_columns(s), **_flow_columns(s)}
    if ahead is not None:
        first |= _future_close(s, ahead)
    s = _after_first(s.with_columns(first))
    return s.with_columns(stationary_columns())


def feature_matrix(bars: DataFrame, **layout) -> DataFrame:
    """Bars with all indicator, stationary and flow columns, from one pass of windows."""
    require_columns(bars, [*PRICE_INPUTS, *FLOW_INPUTS])
    return over_series(bars, _with_features, lookback=INDICATOR_LOOKBACK, **layout)


def direction_labels(
    bars: DataFrame, horizon: int = HORIZON, threshold: float = RETURN_THRESHOLD, **layout
) -> DataFrame:
    require_columns(bars, ["symbol", "open_time", "close"])
    return over_series(
        bars,
        lambda s: with_labels(s, horizon, threshold),
        lookback=0,
        lookahead=horizon,
        **layout,
    )


def labelled_features(
    bars: DataFrame,
    horizon: int = HORIZON,
    threshold: float = RETURN_THRESHOLD,
    columns: list[str] | None = None,
    **layout,
) -> DataFrame:
    """Features and labels together, complete rows only (warm-up and label tail dropped).

    Only the columns asked for are computed; all windows share one shuffle.
    """
    require_columns(bars, [*PRICE_INPUTS, *FLOW_INPUTS])
    columns = columns or FEATURE_COLUMNS
    table = over_series(
        bars,
        lambda s: _label_columns(_with_features(s, horizon), threshold),
        lookback=INDICATOR_LOOKBACK,
        lookahead=horizon,
        **layout,
    )
    return table.dropna(subset=[*columns, "target"])


def slim_features(table: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Keys, close and features, the features narrowed to 32-bit floats."""
    columns = columns or FEATURE_COLUMNS
    require_columns(table, ["symbol", "open_time", "close", *columns])
    return table.select("symbol", "open_time", "close", *[F.col(c).cast("float") for c in columns])


def feature_parity(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Compare two feature tables row by row on (symbol, open_time).

    One row per column: rows compared, rows found on one side only, NULLs on one side only,
    and the largest absolute difference.
    """
    keys = ["symbol", "open_time"]
    require_columns(left, [*keys, *columns])
    require_columns(right, [*keys, *columns])
    a = left.select(*keys, *[F.col(c).alias(f"a_{c}") for c in columns], F.lit(True).alias("_a"))
    b = right.select(*keys, *[F.col(c).alias(f"b_{c}") for c in columns], F.lit(True).alias("_b"))
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    parts = []
    for c in columns:
        x, y = F.col(f"a_{c}"), F.col(f"b_{c}")
        parts += [
            F.sum(F.when(both & (x.isNull() != y.isNull()), 1).otherwise(0)).alias(f"n_{c}"),
            F.max(F.abs(x - y)).alias(f"d_{c}"),
        ]
    totals = a.join(b, keys, "full_outer").agg(
        F.sum(both.cast("long")).alias("matched"),
        F.sum((~both).cast("long")).alias("unmatched"),
        *parts,
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col("matched"),
                F.col("unmatched"),
                F.col(f"n_{c}").alias("null_mismatches"),
                F.coalesce(F.col(f"d_{c}"), F.lit(0.0)).alias("max_abs_diff"),
            )
            for c in columns
        ]
    )
    return totals.select(F.inline(rows))


def assert_parity(left: DataFrame, right: DataFrame, columns: list[str], tol: float = 1e-5) -> None:
    """Raise where any column differs by more than ``tol`` or the rows do not pair up."""
    bad = feature_parity(left, right, columns).filter(
        (F.col("max_abs_diff") > tol) | (F.col("unmatched") > 0) | (F.col("null_mismatches") > 0)
    )
    worst = bad.first()
    if worst is not None:
        raise DataValidationError(f"feature tables differ: {worst.asDict()}")
