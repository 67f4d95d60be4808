"""Rolling statistics over the last n rows; NULL until n values are in the window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.functions.checks import require_columns
from barlab.operators.series import Series, over_series
from barlab.schema import EPSILON


def _full(s: Series, x: Column, n: int, value: Column) -> Column:
    return F.when(F.count(x).over(s.last(n)) == n, value)


def rolling_mean(s: Series, x: Column | str, n: int) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return _full(s, x, n, F.avg(x).over(s.last(n)))


def rolling_std(s: Series, x: Column | str, n: int) -> Column:
    """Sample standard deviation (divisor n - 1)."""
    x = F.col(x) if isinstance(x, str) else x
    return _full(s, x, n, F.stddev_samp(x).over(s.last(n)))


def rolling_zscore(s: Series, x: Column | str, n: int) -> Column:
    """Distance of the current value from the mean of a window that includes it."""
    x = (F.col(x) if isinstance(x, str) else x).cast("double")
    spread = F.stddev_samp(x).over(s.last(n)) + EPSILON
    return _full(s, x, n, (x - F.avg(x).over(s.last(n))) / spread)


def log_return(s: Series, x: Column | str = "close") -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return F.ln(F.try_divide(x, F.lag(x).over(s.ordered())))


def difference(s: Series, x: Column | str = "close") -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return x - F.lag(x).over(s.ordered())


WORK_COLUMNS = ["_change", "_gain", "_loss", "_bb_std"]


def change_columns(s: Series) -> dict[str, Column]:
    return {"_change": difference(s)}


def gain_columns() -> dict[str, Column]:
    """Rises and falls; the first bar of a symbol has no change and counts as 0 in both."""
    change = F.col("_change")
    return {
        "_gain": F.when(change > 0, change).otherwise(0.0),
        "_loss": F.when(change < 0, -change).otherwise(0.0),
    }


def rsi_column(s: Series, n: int) -> Column:
    """Relative strength index from simple means of gains and losses."""
    strength = rolling_mean(s, "_gain", n) / (rolling_mean(s, "_loss", n) + EPSILON)
    return 100.0 - 100.0 / (1.0 + strength)


def with_rsi(s: Series, n: int = 14, out: str = "rsi_14") -> Series:
    s = s.with_columns(change_columns(s)).with_columns(gain_columns())
    return s.with_columns({out: rsi_column(s, n)}).drop("_change", "_gain", "_loss")


def with_volatility(s: Series, n: int = 30, out: str = "volatility_30") -> Series:
    """Rolling deviation of the log return; the log return column must be present."""
    return s.with_columns({out: rolling_std(s, "log_return", n)})


def band_columns(s: Series, n: int = 20) -> dict[str, Column]:
    return {"bb_middle": rolling_mean(s, "close", n), "_bb_std": rolling_std(s, "close", n)}


def bollinger_columns(width: float = 2.0) -> dict[str, Column]:
    return {
        "bb_upper": F.col("bb_middle") + width * F.col("_bb_std"),
        "bb_lower": F.col("bb_middle") - width * F.col("_bb_std"),
    }


def with_bollinger(s: Series, n: int = 20, width: float = 2.0) -> Series:
    s = s.with_columns(band_columns(s, n))
    return s.with_columns(bollinger_columns(width)).drop("_bb_std")


# --- operators on bar tables -------------------------------------------------------------


def sma(bars: DataFrame, spans: tuple[int, ...] = (15, 20, 50), **layout) -> DataFrame:
    require_columns(bars, ["close"])
    return over_series(
        bars,
        lambda s: s.with_columns({f"sma_{n}": rolling_mean(s, "close", n) for n in spans}),
        lookback=max(spans) - 1,
        **layout,
    )


def rolling_stds(
    bars: DataFrame, columns: dict[str, int], suffix: str = "std", **layout
) -> DataFrame:
    """Add ``<column>_<suffix><n>`` for each ``{column: n}``."""
    require_columns(bars, columns)
    return over_series(
        bars,
        lambda s: s.with_columns(
            {f"{c}_{suffix}{n}": rolling_std(s, c, n) for c, n in columns.items()}
        ),
        lookback=max(columns.values()) - 1,
        **layout,
    )


def zscores(bars: DataFrame, columns: dict[str, str], n: int = 30, **layout) -> DataFrame:
    """Add rolling z-scores, ``{output: input}``."""
    require_columns(bars, columns.values())
    return over_series(
        bars,
        lambda s: s.with_columns({out: rolling_zscore(s, x, n) for out, x in columns.items()}),
        lookback=n - 1,
        **layout,
    )


def log_returns(bars: DataFrame, **layout) -> DataFrame:
    require_columns(bars, ["close"])
    return over_series(
        bars, lambda s: s.with_columns({"log_return": log_return(s)}), lookback=1, **layout
    )


def rsi(bars: DataFrame, n: int = 14, **layout) -> DataFrame:
    require_columns(bars, ["close"])
    return over_series(bars, lambda s: with_rsi(s, n, f"rsi_{n}"), lookback=n, **layout)


def bollinger(bars: DataFrame, n: int = 20, width: float = 2.0, **layout) -> DataFrame:
    require_columns(bars, ["close"])
    return over_series(bars, lambda s: with_bollinger(s, n, width), lookback=n - 1, **layout)


def volatility(bars: DataFrame, n: int = 30, **layout) -> DataFrame:
    require_columns(bars, ["close"])
    return over_series(
        bars,
        lambda s: with_volatility(
            s.with_columns({"log_return": log_return(s)}), n, f"volatility_{n}"
        ),
        lookback=n,
        **layout,
    )
