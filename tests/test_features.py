import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barlab.errors import DataValidationError
from barlab.operators import ema, features, rolling, sequences
from barlab.operators.series import over_series, segment_table
from barlab.schema import FEATURE_COLUMNS, INDICATOR_COLUMNS
from tests.conftest import minute_bars


def expected_features(frame):
    """The definitions written with pandas, symbol by symbol."""
    out = []
    for _, g in frame.groupby("symbol", sort=True):
        g = g.sort_values("open_time").copy()
        c = g["close"]
        ewm = lambda x, n: x.ewm(span=n, adjust=False).mean()
        for n in (15, 50):
            g[f"sma_{n}"] = c.rolling(n).mean()
            g[f"ema_{n}"] = ewm(c, n)
        g["log_return"] = np.log(c / c.shift(1))
        g["macd_line"] = ewm(c, 12) - ewm(c, 26)
        g["macd_signal"] = ewm(g["macd_line"], 9)
        g["macd_hist"] = g["macd_line"] - g["macd_signal"]
        g["bb_middle"] = c.rolling(20).mean()
        spread = c.rolling(20).std()
        g["bb_upper"], g["bb_lower"] = g["bb_middle"] + 2 * spread, g["bb_middle"] - 2 * spread
        g["volatility_30"] = g["log_return"].rolling(30).std()
        change = c.diff()
        gain, loss = change.where(change > 0, 0.0), (-change).where(change < 0, 0.0)
        strength = gain.rolling(14).mean() / (loss.rolling(14).mean() + 1e-10)
        g["rsi_14"] = 100 - 100 / (1 + strength)
        for n in ("sma_15", "sma_50", "ema_15", "ema_50"):
            g[f"close_to_{n}"] = (c - g[n]) / c
        g["bb_position"] = (c - g["bb_lower"]) / (g["bb_upper"] - g["bb_lower"] + 1e-10)
        for n in ("line", "signal", "hist"):
            g[f"macd_{n}_norm"] = g[f"macd_{n}"] / c
        g["taker_buy_ratio"] = g["taker_buy_base_asset_volume"] / (g["volume"] + 1e-10)
        for out_name, x in (("volume_z30", g["volume"]), ("trades_z30", g["number_of_trades"])):
            g[out_name] = (x - x.rolling(30).mean()) / (x.rolling(30).std() + 1e-10)
        hour = g["open_time"].dt.hour
        g["hour_sin"], g["hour_cos"] = np.sin(2 * np.pi * hour / 24), np.cos(2 * np.pi * hour / 24)
        future = c.shift(-15) / c - 1
        g["future_return"] = future
        g["target"] = (future > 0).astype(float).where(future.notna())
        out.append(g)
    return pd.concat(out, ignore_index=True)


ALL = [*INDICATOR_COLUMNS, *[c for c in FEATURE_COLUMNS if c not in INDICATOR_COLUMNS]]


@pytest.mark.parametrize("segment_rows", [None, 2000])
def test_features_match_their_definitions(walk, segment_rows):
    frame, table = walk
    got = features.feature_matrix(table, segment_rows=segment_rows)
    got = got.toPandas().sort_values(["symbol", "open_time"]).reset_index(drop=True)
    want = expected_features(frame)
    assert len(got) == len(want)
    for c in ALL:
        a, b = got[c].to_numpy(float), want[c].to_numpy(float)
        assert (np.isnan(a) == np.isnan(b)).all(), c
        assert np.nanmax(np.abs(a - b)) < 1e-7, c


@pytest.mark.parametrize("segment_rows", [60, 113, 1000])
def test_segments_give_the_same_rolling_values_and_labels(walk, segment_rows):
    frame, table = walk

    def build(s):
        s = s.with_columns({"m": rolling.rolling_mean(s, "close", 50), "r": rolling.log_return(s)})
        return features.with_labels(s)

    whole = over_series(table, build, 49, 15, segment_rows=None)
    cut = over_series(table, build, 49, 15, segment_rows=segment_rows)
    checked = features.feature_parity(whole, cut, ["m", "r", "future_return", "target"]).collect()
    for row in checked:
        assert row["matched"] == len(frame) and row["unmatched"] == 0
        assert row["null_mismatches"] == 0 and row["max_abs_diff"] < 1e-9


def test_segments_hold_the_rows_their_windows_need(spark):
    """Buckets of two rows, two of them empty: margins count rows, whatever the gaps."""
    minutes = [*range(128), *range(300, 340), *range(1000, 1200)]
    frame = minute_bars("S", np.arange(1200.0)).iloc[minutes]
    bars = spark.createDataFrame(pd.concat([frame, minute_bars("SHORT", np.arange(50.0))]))
    got = segment_table(bars, 5, 3, 128, 60_000).orderBy("symbol", "first").collect()
    # Buckets of 128 // 64 = 2 minutes; segments start at the buckets of rows 0, 128 and 256.
    day = int(pd.Timestamp("2024-01-01").timestamp()) // 120
    assert [(*r[:2], *(b - day for b in r[2:])) for r in got] == [
        ("S", 0, 0, 63, 0, 151),
        ("S", 1, 150, 543, 61, 545),
        ("S", 2, 544, 599, 541, 599),
        ("SHORT", 0, 0, 24, 0, 24),
    ]


def test_a_bucket_of_many_copies_is_one_segment(spark):
    """More rows of one instant than a segment has: margins still hold every row that is needed."""
    frame = pd.concat([minute_bars("S", np.arange(40.0)), *[minute_bars("S", [7.0 + i]) for i in range(300)]])
    table = spark.createDataFrame(frame)
    whole = rolling.sma(table, (20,), segment_rows=None).select("open_time", "close", "sma_20")
    cut = rolling.sma(table, (20,), segment_rows=64).select("open_time", "close", "sma_20")
    assert sorted(map(str, whole.collect())) == sorted(map(str, cut.collect()))


def test_sparse_segments_reach_back_over_gaps(spark):
    # One bar a day for a long time: every time bucket is nearly empty.
    frame = minute_bars("GAPUSDT", 100 + np.sin(np.arange(400)))
    frame["open_time"] = pd.date_range("2020-01-01", periods=400, freq="D")
    table = spark.createDataFrame(frame)
    whole = rolling.sma(table, (50,), segment_rows=None)
    cut = rolling.sma(table, (50,), segment_rows=64, bar_ms=60_000)
    row = features.feature_parity(whole, cut, ["sma_50"]).first()
    assert row["matched"] == 400 and row["null_mismatches"] == 0 and row["max_abs_diff"] < 1e-9


def test_long_exponential_average(spark):
    rng = np.random.default_rng(3)
    closes = 30_000 + np.cumsum(rng.normal(0, 10, 70_000))
    frame = minute_bars("LONGUSDT", closes)[["symbol", "open_time", "close"]]
    table = spark.createDataFrame(frame)
    for segment_rows in (None, 20_000):
        got = ema.ema(table, (9, 15, 50, 400), segment_rows=segment_rows).toPandas()
        got = got.sort_values("open_time")
        for span in (9, 15, 50, 400):
            want = pd.Series(closes).ewm(span=span, adjust=False).mean().to_numpy()
            assert np.max(np.abs(got[f"ema_{span}"].to_numpy() - want) / want) < 1e-12


def test_spans_that_cannot_share_a_block_are_split():
    assert ema.share_blocks([9, 12, 15, 26, 50]) == [[9, 12, 15, 26, 50]]
    assert len(ema.share_blocks([9, 400])) == 2
    with pytest.raises(ValueError):
        ema.block_rows([9, 400])


def test_short_symbol_has_averages_but_no_windows(spark):
    table = spark.createDataFrame(minute_bars("TENUSDT", np.arange(10) + 100.0))
    out = features.feature_matrix(table).toPandas()
    for c in ("sma_15", "sma_50", "bb_middle", "rsi_14", "volatility_30", "volume_z30"):
        assert out[c].isna().all()
    assert out["ema_15"].notna().all() and out["macd_signal"].notna().all()


def test_flat_prices(spark):
    table = spark.createDataFrame(minute_bars("FLATUSDT", np.full(60, 100.0), trades=5, volume=10))
    out = features.feature_matrix(table).toPandas().sort_values("open_time")
    last = out.iloc[-1]
    assert last["rsi_14"] == 0.0 and last["volatility_30"] == 0.0
    assert abs(last["volume_z30"]) < 1e-5 and abs(last["trades_z30"]) < 1e-5
    assert math.isfinite(last["bb_position"])


def test_rsi_starts_on_the_fourteenth_row_and_stays_in_range(walk):
    _, table = walk
    out = rolling.rsi(table).toPandas().sort_values(["symbol", "open_time"])
    for _, g in out.groupby("symbol"):
        assert g["rsi_14"].iloc[:13].isna().all() and g["rsi_14"].iloc[13:].notna().all()
        assert g["rsi_14"].dropna().between(0, 100).all()


def test_zero_price_gives_null_not_an_error(spark):
    closes = np.full(40, 10.0)
    closes[20] = 0.0
    table = spark.createDataFrame(minute_bars("ZEROUSDT", closes))
    out = features.feature_matrix(table).toPandas().sort_values("open_time").reset_index(drop=True)
    assert math.isnan(out["log_return"][20]) and math.isnan(out["log_return"][21])
    assert math.isnan(out["close_to_ema_15"][20])
    labels = features.direction_labels(table).toPandas().sort_values("open_time")
    assert math.isnan(labels["target"].iloc[20])


def test_labels_have_a_null_tail(spark):
    table = spark.createDataFrame(
        pd.concat([minute_bars("UPUSDT", np.arange(40) + 1.0), minute_bars("DNUSDT", 99.0 - np.arange(40))])
    )
    out = features.direction_labels(table).toPandas().sort_values(["symbol", "open_time"])
    for symbol, value in (("UPUSDT", 1), ("DNUSDT", 0)):
        target = out.loc[out.symbol == symbol, "target"]
        assert (target.iloc[:25] == value).all() and target.iloc[25:].isna().all()
    out = features.direction_labels(table, threshold=10.0).toPandas()
    assert (out.loc[out.symbol == "UPUSDT"].sort_values("open_time")["target"].iloc[2:25] == 0).all()


def test_complete_rows_of_a_hundred_minutes(spark):
    frame = pd.concat(
        [minute_bars("BTCUSDT", 42000 + 10.0 * np.arange(100), trades=100, volume=10),
         minute_bars("ETHUSDT", 2200 + 2.0 * np.arange(100), trades=80, volume=50)]
    )
    out = features.labelled_features(spark.createDataFrame(frame))
    assert {r["symbol"]: r["count"] for r in out.groupBy("symbol").count().collect()} == {
        "BTCUSDT": 36, "ETHUSDT": 36,
    }


def test_parity_check(spark):
    a = spark.createDataFrame(
        [("A", i, 0.1 * i, 50.0) for i in range(5)], "symbol string, open_time long, x double, y double"
    )
    near = a.withColumn("x", F.col("x") + 1e-7)
    far = a.withColumn("y", F.col("y") + 10.0)
    features.assert_parity(a, near, ["x", "y"], 1e-4)
    with pytest.raises(DataValidationError):
        features.assert_parity(a, far, ["x", "y"], 1e-4)
    with pytest.raises(DataValidationError):
        features.assert_parity(a, a.limit(4), ["x"], 1e-4)


def test_missing_columns_raise(spark):
    with pytest.raises(DataValidationError, match="close"):
        features.indicators(spark.createDataFrame([("A", 1)], "symbol string, open_time int"))
    with pytest.raises(DataValidationError):
        features.stationary_features(spark.createDataFrame([(1.0,)], "close double"))


def test_sequences(spark):
    rows = [(s, i, float(i), i % 2) for s in "AB" for i in range(100)]
    table = spark.createDataFrame(rows, "symbol string, open_time long, f double, target int")
    for segment_rows in (None,):
        out = sequences.sequence_windows(table, ["f"], rows=10, scale=False, segment_rows=segment_rows)
        assert out.count() == 182
        first = out.filter("symbol = 'B' AND open_time = 9").first()
        assert [v[0] for v in first["sequence"]] == [float(i) for i in range(10)]
        assert first["target"] == 1
    assert sequences.sequence_eligible(table, 10).count() == 182
    with pytest.raises(DataValidationError):
        sequences.require_sequences(table.limit(10), 60)


def test_sequences_in_segments(walk):
    _, table = walk
    table = table.withColumn("target", F.lit(1))
    whole = sequences.sequence_windows(table, ["close", "volume"], rows=60, segment_rows=None)
    cut = sequences.sequence_windows(table, ["close", "volume"], rows=60, segment_rows=500)
    assert whole.exceptAll(cut).count() == 0 and cut.exceptAll(whole).count() == 0


def test_bars_without_a_symbol_are_one_series_in_any_layout(spark):
    frame = minute_bars("X", 100 + np.sin(np.arange(400)))
    frame["symbol"] = None
    table = spark.createDataFrame(frame, "open_time timestamp, open double, high double, low double, close double, "
        "volume double, close_time timestamp, quote_asset_volume double, number_of_trades int, "
        "taker_buy_base_asset_volume double, taker_buy_quote_asset_volume double, symbol string")  # fmt: skip
    whole = rolling.sma(table, (5,), segment_rows=None).select("open_time", "sma_5")
    for rows in (50, 250_000):
        cut = rolling.sma(table, (5,), segment_rows=rows).select("open_time", "sma_5")
        assert cut.count() == 400 and cut.exceptAll(whole).count() == 0


def test_copies_of_one_instant_give_the_same_values_under_any_partitioning(spark):
    frame = minute_bars("X", 100 + np.cumsum(np.random.default_rng(2).normal(size=400)))
    frame["open_time"] = frame["open_time"].iloc[np.arange(400) // 4].to_numpy()
    table = spark.createDataFrame(frame)
    for rows in (None, 40, 250_000):
        sums = {
            rolling.log_returns(table.repartition(n), segment_rows=rows)
            .agg(F.round(F.sum(F.abs("log_return")), 9))
            .first()[0]
            for n in (1, 3, 7)
        }
        assert len(sums) == 1


def test_averages_pass_over_missing_values(spark):
    closes = np.full(3000, 100.0)
    frame = minute_bars("X", closes)
    frame.loc[::5, "close"] = np.nan
    out = ema.ema(spark.createDataFrame(frame), (15, 50)).toPandas().sort_values("open_time")
    there = np.arange(3000) % 5 > 0
    for c in ("ema_15", "ema_50"):
        assert np.allclose(out[c].to_numpy()[there], 100.0) and np.isnan(out[c].to_numpy()[~there]).all()
    rng = np.random.default_rng(4)
    frame["close"] = np.where(rng.uniform(size=3000) < 0.3, np.nan, rng.uniform(50, 60, 3000))
    out = ema.ema(spark.createDataFrame(frame), (9,)).toPandas().sort_values("open_time")
    a, weight, total, want = 0.2, 0.0, 0.0, []
    for x in frame["close"]:
        weight, total = weight * (1 - a), total * (1 - a)
        if not np.isnan(x):
            share = a if weight else 1.0
            weight, total = weight + share, total + share * x
        want.append(total / weight if weight and not np.isnan(x) else np.nan)
    assert np.allclose(out["ema_9"], want, equal_nan=True)
