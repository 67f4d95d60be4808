"""Rolling and exponential indicators, labels, sequences and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlab.functions.timestamps import to_ms
from barlab.operators import clean, ema, features, rolling, sequences, splits
from barlab.plans import fixtures as fx
from barlab.plans import sql as q
from barlab.plans.registry import emit, query, rounded
from barlab.schema import DAY_MS, FEATURE_COLUMNS, INDICATOR_COLUMNS
from barlab.session import materialize

EV = f"WITH {q.event_bars()}"
KEY = f"symbol, {q.OPEN_MS}"
HOURS = {"bar_ms": fx.HOUR_MS}
# Bars made by a grouping are unique, so nothing else has to order bars of one instant.
DAYS = {"bar_ms": DAY_MS, "tie_break": []}


@query(
    "sma",
    f"WITH {q.LINE_BARS}, t AS (SELECT *, {q.mean('close', 15)} AS sma_15, "
    f"{q.mean('close', 20)} AS sma_20, {q.mean('close', 50)} AS sma_50 FROM bars) "
    f"SELECT {KEY}, {q.rs(['sma_15', 'sma_20', 'sma_50'], 6)} FROM t",
)
def sma(spark, d):
    out = rolling.sma(fx.stored_daily(spark, d), **DAYS)
    return emit(out, "symbol", "open_time", sma_15=6, sma_20=6, sma_50=6)


@query(
    "rolling_std",
    f"WITH {q.LINE_BARS}, t AS (SELECT *, {q.std('close', 20)} AS close_std20, "
    f"{q.std('volume', 30)} AS volume_std30 FROM bars) "
    f"SELECT {KEY}, {q.rs(['close_std20', 'volume_std30'], 5)} FROM t",
)
def rolling_std(spark, d):
    out = rolling.rolling_stds(fx.stored_daily(spark, d), {"close": 20, "volume": 30}, **DAYS)
    return emit(out, "symbol", "open_time", close_std20=5, volume_std30=5)


_SPANS = [9, 12, 15, 26, 50]


@query(
    "ema",
    f"WITH {q.LINE_BARS}, t AS (SELECT *, "
    + ", ".join(f"{q.ema('close', n)} AS ema_{n}" for n in _SPANS)
    + f" FROM bars) SELECT {KEY}, {q.rs([f'ema_{n}' for n in _SPANS], 4)} FROM t",
)
def ema_query(spark, d):
    out = ema.ema(fx.stored_daily(spark, d), tuple(_SPANS), **DAYS)
    return emit(out, "symbol", "open_time", **rounded([f"ema_{n}" for n in _SPANS], 4))


@query(
    "log_return",
    f"WITH {q.LINE_BARS}, t AS (SELECT *, {q.LOG_RETURN} AS log_return FROM bars) "
    f"SELECT {KEY}, {q.r('log_return', 8)} FROM t",
)
def log_return(spark, d):
    return emit(
        rolling.log_returns(fx.stored_daily(spark, d), **DAYS), "symbol", "open_time", log_return=8
    )


@query(
    "rsi",
    f"WITH {q.LINE_BARS}, {q.RSI_STEPS.format(source='bars')} "
    f"SELECT {KEY}, {q.r('rsi_14', 6)} FROM rsi",
)
def rsi(spark, d):
    return emit(rolling.rsi(fx.stored_daily(spark, d), **DAYS), "symbol", "open_time", rsi_14=6)


_BB = ["bb_middle", "bb_upper", "bb_lower"]


@query(
    "bollinger",
    f"WITH {q.LINE_BARS}, t AS (SELECT *, {q.mean('close', 20)} AS bb_middle, "
    f"{q.std('close', 20)} AS s FROM bars), "
    "u AS (SELECT *, bb_middle + 2 * s AS bb_upper, bb_middle - 2 * s AS bb_lower FROM t) "
    f"SELECT {KEY}, {q.rs(_BB, 5)} FROM u",
)
def bollinger(spark, d):
    out = rolling.bollinger(fx.stored_daily(spark, d), **DAYS)
    return emit(out, "symbol", "open_time", **rounded(_BB, 5))


_MACD = ["macd_line", "macd_signal", "macd_hist"]


@query(
    "macd",
    f"{EV}, a AS (SELECT *, {q.ema('close', 12)} - {q.ema('close', 26)} AS macd_line FROM bars), "
    f"b AS (SELECT *, {q.ema('macd_line', 9)} AS macd_signal FROM a), "
    "c AS (SELECT *, macd_line - macd_signal AS macd_hist FROM b) "
    f"SELECT {KEY}, {q.rs(_MACD, 7)} FROM c",
)
def macd(spark, d):
    out = ema.macd(fx.hourly(spark, d), **HOURS)
    return emit(out, "symbol", "open_time", **rounded(_MACD, 7))


@query(
    "volatility",
    f"WITH {q.LINE_BARS}, a AS (SELECT *, {q.LOG_RETURN} AS log_return FROM bars), "
    f"b AS (SELECT *, {q.std('log_return', 30)} AS volatility_30 FROM a) "
    f"SELECT {KEY}, {q.r('volatility_30', 8)} FROM b",
)
def volatility(spark, d):
    out = rolling.volatility(fx.stored_daily(spark, d), **DAYS)
    return emit(out, "symbol", "open_time", volatility_30=8)


@query(
    "indicators",
    f"{EV}, {q.indicators()} SELECT {KEY}, {q.rs(INDICATOR_COLUMNS, 6)} FROM ind",
)
def indicators(spark, d):
    out = features.indicators(fx.hourly(spark, d), **HOURS)
    return emit(out, "symbol", "open_time", **rounded(INDICATOR_COLUMNS, 6))


_STATIONARY = FEATURE_COLUMNS[:8]


@query(
    "stationary_features",
    f"{EV}, {q.indicators()}, s AS (SELECT *, {q.STATIONARY} FROM ind) "
    f"SELECT {KEY}, {q.rs(_STATIONARY, 5)} FROM s",
)
def stationary_features(spark, d):
    out = features.stationary_features(features.indicators(fx.hourly(spark, d), **HOURS))
    return emit(out, "symbol", "open_time", **rounded(_STATIONARY, 5))


@query(
    "zscore",
    f"WITH {q.LINE_BARS}, t AS (SELECT *, {q.zscore('volume', 30)} AS volume_z30, "
    f"{q.zscore('number_of_trades', 30)} AS trades_z30 FROM bars) "
    f"SELECT {KEY}, {q.rs(['volume_z30', 'trades_z30'], 4)} FROM t",
)
def zscore(spark, d):
    columns = {"volume_z30": "volume", "trades_z30": "number_of_trades"}
    out = rolling.zscores(fx.stored_daily(spark, d), columns, **DAYS)
    return emit(out, "symbol", "open_time", volume_z30=4, trades_z30=4)


@query(
    "hour_cycle",
    f"{EV}, t AS (SELECT *, sin(2 * pi() * hour(open_time) / 24) AS hour_sin, "
    "cos(2 * pi() * hour(open_time) / 24) AS hour_cos FROM bars) "
    f"SELECT {KEY}, {q.rs(['hour_sin', 'hour_cos'], 8)} FROM t",
)
def hour_cycle(spark, d):
    return emit(
        features.hour_cycle(fx.hourly(spark, d)), "symbol", "open_time", hour_sin=8, hour_cos=8
    )


_FLOW = FEATURE_COLUMNS[11:]


@query("flow_features", f"{EV}, f AS (SELECT *, {q.FLOW} FROM bars) "
       f"SELECT {KEY}, {q.rs(_FLOW, 5)} FROM f")  # fmt: skip
def flow_features(spark, d):
    out = features.flow_features(fx.hourly(spark, d), **HOURS)
    return emit(out, "symbol", "open_time", **rounded(_FLOW, 5))


_MATRIX = list(dict.fromkeys([*INDICATOR_COLUMNS, *FEATURE_COLUMNS]))


@query(
    "feature_matrix",
    f"WITH {q.LINE_BARS}, {q.features()} SELECT {KEY}, {q.rs(_MATRIX, 4)} FROM feat",
)
def feature_matrix(spark, d):
    out = features.feature_matrix(fx.stored_daily(spark, d), **DAYS)
    return emit(out, "symbol", "open_time", **rounded(_MATRIX, 4))


@query(
    "drop_warmup",
    f"{EV}, {q.features()} SELECT {KEY}, {q.rs(FEATURE_COLUMNS, 5)} FROM feat WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_COLUMNS),
)
def drop_warmup(spark, d):
    table = features.feature_matrix(fx.hourly(spark, d), **HOURS)
    kept = clean.drop_incomplete(table, FEATURE_COLUMNS)
    return emit(kept, "symbol", "open_time", **rounded(FEATURE_COLUMNS, 5))


_SLIM = FEATURE_COLUMNS


@query(
    "slim_features",
    f"{EV}, {q.features()}, s AS (SELECT symbol, open_time, close, "
    + ", ".join(f"{c}::FLOAT::DOUBLE AS {c}" for c in _SLIM)
    + f" FROM feat) SELECT {KEY}, {q.r('close', 2)}, {q.rs(_SLIM, 3)} FROM s",
)
def slim_features(spark, d):
    table = features.slim_features(features.feature_matrix(fx.hourly(spark, d), **HOURS))
    return emit(table, "symbol", "open_time", close=2, **rounded(_SLIM, 3))


@query(
    "direction_labels",
    f"WITH {q.LINE_BARS}, {q.LABELS.format(source='bars')} SELECT {KEY}, "
    f"{q.big('target')}, {q.rs(['future_close', 'future_return'], 6)} FROM lab",
)
def direction_labels(spark, d):
    out = features.direction_labels(fx.stored_daily(spark, d), **DAYS)
    return emit(out, "symbol", "open_time", "target", future_close=6, future_return=6)


@query(
    "labelled_features",
    f"{EV}, {q.labelled()} SELECT {KEY}, {q.big('target')}, {q.r('future_return', 6)}, "
    f"{q.rs(FEATURE_COLUMNS, 5)} FROM labelled",
)
def labelled_features(spark, d):
    out = fx.labelled(spark, d)
    digits = rounded(FEATURE_COLUMNS, 5)
    return emit(out, "symbol", "open_time", "target", future_return=6, **digits)


_SEQ = FEATURE_COLUMNS


@query(
    "sequence_windows",
    f"{EV}, {q.labelled()}, st AS (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in _SEQ)
    + " FROM labelled), z AS (SELECT symbol, open_time, target, "
    + ", ".join(f"(({c} - m_{c}) / s_{c})::FLOAT AS {c}" for c in _SEQ)
    + f" FROM labelled, st), w AS (SELECT *, list([{', '.join(_SEQ)}]) OVER {q.frame(60)} AS s, "
    f"count(*) OVER {q.frame(60)} AS n FROM z) "
    f"SELECT {KEY}, {q.big('target')}, len(s) AS seq_len, "
    f"{q.r('s[1][1]::DOUBLE', 3, 'first_value')}, {q.r('s[60][16]::DOUBLE', 3, 'last_value')}, "
    f"{q.r('list_sum(list_transform(flatten(s), lambda x: x::DOUBLE))', 1, 'total')} "
    "FROM w WHERE n = 60",
)
def sequence_windows(spark, d):
    windows = sequences.sequence_windows(fx.labelled(spark, d), _SEQ, rows=60, **HOURS)
    total = F.aggregate(
        F.flatten("sequence"), F.lit(0.0), lambda a, x: a + x.cast("double")
    )
    out = windows.select(
        "symbol",
        "open_time",
        "target",
        F.size("sequence").alias("seq_len"),
        F.col("sequence")[0][0].alias("first_value"),
        F.col("sequence")[59][15].alias("last_value"),
        total.alias("total"),
    )
    return emit(
        out, "symbol", "open_time", "target", "seq_len", first_value=3, last_value=3, total=1
    )


@query(
    "feature_parity",
    f"""WITH {q.event_bars('minute')}, n AS (SELECT count(*) AS matched FROM bars)
    SELECT unnest(['rsi_14', 'ema_50', 'volume_z30', 'macd_signal']) AS feature, matched,
    0::BIGINT AS unmatched, 0::BIGINT AS null_mismatches, TRUE AS within_tolerance FROM n""",
)
def feature_parity(spark, d):
    """Minute bars cut into segments of 1300 rows against a task per symbol."""
    bars = fx.bars_from_events(spark, d, "minute")
    columns = ["rsi_14", "ema_50", "volume_z30", "macd_signal"]
    whole = features.feature_matrix(bars, segment_rows=None)
    cut = features.feature_matrix(bars, segment_rows=1300)
    table = features.feature_parity(whole, cut, columns)
    return table.select(
        "feature",
        "matched",
        "unmatched",
        F.col("null_mismatches").cast("long"),
        (F.col("max_abs_diff") <= 1e-5).alias("within_tolerance"),
    )


_HOLES = f"""holes AS (SELECT * REPLACE (CASE WHEN hour(open_time) % 5 > 0 THEN close END AS close) FROM bars),
l AS (SELECT symbol, open_time, close, list(close) OVER ({q.W}) AS x FROM holes),
p AS (SELECT *, list_position(list_transform(x, lambda v: v IS NOT NULL), TRUE) AS f FROM l)"""


def _ema_of_present(span: int) -> str:
    """Decayed values over decayed weights; the first value has the whole weight."""
    a = f"(2::DOUBLE / {span + 1})"
    weight = f"pow(1 - {a}, len(x) - i) * CASE WHEN i = f THEN 1::DOUBLE ELSE {a} END"
    over = lambda v: f"list_sum(list_transform(x, lambda v, i: CASE WHEN v IS NOT NULL THEN {v} END))"
    return f"CASE WHEN close IS NOT NULL THEN {over('v * ' + weight)} / {over(weight)} END"


@query(
    "ema_nulls",
    f"{EV}, {_HOLES} SELECT {KEY}, {q.r(_ema_of_present(15), 4, 'ema_15')}, "
    f"{q.r(_ema_of_present(50), 4, 'ema_50')} FROM p",
)
def ema_nulls(spark, d):
    """Averages of a price that is missing every fifth hour, in half of these cases as NaN."""
    bars = fx.hourly(spark, d)
    hour = F.hour("open_time")
    missing = F.when(hour % 10 == 0, F.lit(float("nan")))
    holes = bars.withColumn("close", F.when(hour % 5 > 0, F.col("close")).otherwise(missing))
    return emit(ema.ema(holes, (15, 50), **HOURS), "symbol", "open_time", ema_15=4, ema_50=4)


_LABELLED_BARS = f"{EV}, {q.LABELS.format(source='bars')}, l AS (SELECT * FROM lab WHERE target IS NOT NULL)"
_SPLIT = f"{_LABELLED_BARS}, {q.BOUNDS.format(source='l')}, {q.SPLIT.format(source='l')}"


def _labelled_bars(spark, d):
    """Labelled bars as a stored table: boundaries are read from it first."""
    labelled = features.direction_labels(fx.hourly(spark, d), tie_break=[], **HOURS).dropna(subset=["target"])
    return materialize(labelled.select("symbol", "open_time", "target"), "labelled-bars")


@query(
    "split_boundaries",
    f"{_LABELLED_BARS}, {q.BOUNDS.format(source='l')} SELECT epoch_ms(train_end) AS train_end_ms, "
    "epoch_ms(val_end) AS val_end_ms FROM bounds",
)
def split_boundaries(spark, d):
    bounds = splits.split_boundaries(_labelled_bars(spark, d))
    return bounds.select(
        to_ms("train_end").alias("train_end_ms"), to_ms("val_end").alias("val_end_ms")
    )


@query("chrono_split", f"{_SPLIT} SELECT {KEY}, split, {q.big('target')} FROM parts")
def chrono_split(spark, d):
    out = splits.chrono_split_by_fraction(_labelled_bars(spark, d))
    return emit(out, "symbol", "open_time", "split", "target")


@query(
    "split_balance",
    f"{_SPLIT} SELECT split, count(*) AS rows, {q.r('avg(target)', 8, 'positive_rate')} "
    "FROM parts GROUP BY split",
)
def split_balance(spark, d):
    out = splits.split_balance(splits.chrono_split_by_fraction(_labelled_bars(spark, d)))
    return emit(out, "split", "rows", positive_rate=8)
