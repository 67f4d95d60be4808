"""Schemas, column lists and fixed parameters of the bar pipeline."""

from __future__ import annotations

from pyspark.sql import types as T

MINUTE_MS = 60_000
DAY_MS = 86_400_000

# An epoch at or above this value is in microseconds, below it in milliseconds.
MICROSECOND_CUTOFF = 10**15

# Positional columns of a raw bar file, which has no header and no symbol column.
# The columns of a raw bar file, by position.
RAW_BAR_SCHEMA = T.StructType(
    [
        T.StructField("_c0", T.LongType()),
        T.StructField("_c1", T.DoubleType()),
        T.StructField("_c2", T.DoubleType()),
        T.StructField("_c3", T.DoubleType()),
        T.StructField("_c4", T.DoubleType()),
        T.StructField("_c5", T.DoubleType()),
        T.StructField("_c6", T.LongType()),
        T.StructField("_c7", T.DoubleType()),
        T.StructField("_c8", T.IntegerType()),
        T.StructField("_c9", T.DoubleType()),
        T.StructField("_c10", T.DoubleType()),
        T.StructField("_c11", T.DoubleType()),
    ]
)

# Name of each raw position in the canonical bar table.
# Places of the raw columns.
RAW_POSITIONS = {
    "_c0": "open_time",
    "_c1": "open",
    "_c2": "high",
    "_c3": "low",
    "_c4": "close",
    "_c5": "volume",
    "_c6": "close_time",
    "_c7": "quote_asset_volume",
    "_c8": "number_of_trades",
    "_c9": "taker_buy_base_asset_volume",
    "_c10": "taker_buy_quote_asset_volume",
}

BAR_COLUMNS = [*RAW_POSITIONS.values(), "symbol"]
OHLCV_COLUMNS = ["open", "high", "low", "close", "volume"]

# Names and order of the indicators.
INDICATOR_COLUMNS = [
    "sma_15", "sma_50", "ema_15", "ema_50", "log_return",
    "macd_line", "macd_signal", "macd_hist",
    "bb_middle", "bb_upper", "bb_lower", "volatility_30", "rsi_14",
]

# Names and order of the relative indicators.
STATIONARY_COLUMNS = [
    "close_to_sma_15", "close_to_sma_50", "close_to_ema_15", "close_to_ema_50",
    "bb_position", "macd_line_norm", "macd_signal_norm", "macd_hist_norm",
]

# Names and order of the flow features.
FLOW_COLUMNS = ["taker_buy_ratio", "volume_z30", "trades_z30", "hour_sin", "hour_cos"]

# The sixteen model inputs, in model order (fixed values).
FEATURE_COLUMNS = [
    *STATIONARY_COLUMNS, "volatility_30", "rsi_14", "log_return", *FLOW_COLUMNS,
]

# Default liquid set, stablecoin bases, leveraged-token suffixes.
TOP_20_SYMBOLS = [
    "BTCUSDT", "ETHUSDT", "BNBUSDT", "SOLUSDT", "ADAUSDT", "XRPUSDT", "DOGEUSDT", "DOTUSDT",
    "MATICUSDT", "LINKUSDT", "TRXUSDT", "LTCUSDT", "BCHUSDT", "AVAXUSDT", "SHIBUSDT", "ATOMUSDT",
    "XLMUSDT", "UNIUSDT", "ETCUSDT", "FILUSDT",
]
STABLECOIN_BASES = ["USDC", "BUSD", "TUSD", "FDUSD", "DAI", "USDP", "PAX", "UST", "USTC"]
LEVERAGED_SUFFIXES = ["UP", "DOWN"]
QUOTE_ASSET = "USDT"

# Label, split and guard parameters.
HORIZON = 15
RETURN_THRESHOLD = 0.0
TRAIN_FRACTION = 0.70
VALIDATION_FRACTION = 0.15
EPSILON = 1e-10
LOG_LOSS_CLIP = 1e-15
FULL_WINDOW_START = "2023-06-01 00:00:00"
FULL_WINDOW_END = "2026-06-01 00:00:00"
FULL_WINDOW_ROWS = 1_578_240


def threshold_grid(low: float = 0.40, high: float = 0.605, step: float = 0.005) -> list[float]:
    """Cutoffs tried by the threshold search, as the exact doubles of ``numpy.arange``."""
    import numpy as np

    return [float(x) for x in np.arange(low, high, step)]
