import datetime as dt

import numpy as np
import pandas as pd
import pytest

from barlab.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(4, 4)


def minute_bars(symbol, closes, start="2024-01-01", trades=None, volume=None):
    """A pandas bar table with one bar per minute."""
    n = len(closes)
    rng = np.random.default_rng(sum(map(ord, symbol)))
    closes = np.asarray(closes, dtype=float)
    return pd.DataFrame(
        {
            "open_time": pd.date_range(start, periods=n, freq="min"),
            "open": closes - 0.5,
            "high": closes + 1.0,
            "low": closes - 1.0,
            "close": closes,
            "volume": rng.uniform(1, 10, n) if volume is None else np.full(n, float(volume)),
            "close_time": pd.date_range(start, periods=n, freq="min")
            + dt.timedelta(milliseconds=59_999),
            "quote_asset_volume": closes * 2,
            "number_of_trades": (rng.integers(1, 50, n) if trades is None else np.full(n, trades)).astype("int32"),
            "taker_buy_base_asset_volume": rng.uniform(0, 1, n),
            "taker_buy_quote_asset_volume": closes,
            "symbol": symbol,
        }
    )


@pytest.fixture(scope="session")
def walk(spark):
    """Two adjacent random walks of different lengths, as pandas and as Spark."""
    rng = np.random.default_rng(7)
    a = minute_bars("AAAUSDT", 100 + np.cumsum(rng.normal(0, 0.5, 3000)).clip(-90))
    b = minute_bars("BBBUSDT", 50 + np.cumsum(rng.normal(0, 0.2, 700)).clip(-40))
    # Gaps: windows count rows, so a missing minute must not matter.
    a = a.drop(index=range(500, 560)).reset_index(drop=True)
    frame = pd.concat([a, b], ignore_index=True)
    table = spark.createDataFrame(frame)
    return frame, table
