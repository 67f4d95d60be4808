"""SQL fragments shared by the oracles: fixtures, features and metrics."""

from __future__ import annotations

from barlab.schema import FEATURE_COLUMNS


def nudge(digits: int) -> float:
    """A thousandth of the last digit: moves exact ties, which engines break differently."""
    return 10.0 ** -(digits + 3)


def r(expr: str, digits: int, name: str | None = None) -> str:
    """Round off ties, with negative zero folded into zero."""
    rounded = f"round(({expr}) + {nudge(digits)!r}::DOUBLE, {digits})"
    return f"(CASE WHEN {rounded} = 0 THEN 0::DOUBLE ELSE {rounded} END) AS {name or expr}"


def rs(columns: list[str], digits: int) -> str:
    return ", ".join(r(c, digits) for c in columns)


def big(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS BIGINT) AS {name or expr}"


def bigs(columns: list[str]) -> str:
    return ", ".join(big(c) for c in columns)


OPEN_MS = "epoch_ms(open_time) AS open_ms"


def event_bars(unit: str = "hour", groups: int | None = None, name: str = "bars") -> str:
    key = "upper(event_type)" + (f" || (user_id % {groups})::VARCHAR" if groups else "")
    return f"""{name} AS (
  SELECT {key} || 'USDT' AS symbol,
    date_trunc('{unit}', ts)::TIMESTAMP AS open_time,
    arg_min(value, row(ts, event_id)) AS open, max(value) AS high, min(value) AS low,
    arg_max(value, row(ts, event_id)) AS close, sum(value) AS volume,
    date_trunc('{unit}', ts)::TIMESTAMP + INTERVAL 1 {unit} - INTERVAL 1 MILLISECOND AS close_time,
    sum(value * value) AS quote_asset_volume,
    CAST(count(*) AS INTEGER) AS number_of_trades,
    coalesce(sum(value) FILTER (WHERE event_id % 2 = 0), 0) AS taker_buy_base_asset_volume,
    coalesce(sum(value * value) FILTER (WHERE event_id % 2 = 0), 0) AS taker_buy_quote_asset_volume
  FROM events GROUP BY ALL)"""


LINE_ORDER = "row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)"
LINE_BARS = f"""bars AS (
  SELECT 'S' || l_suppkey || 'USDT' AS symbol, l_shipdate AS open_time,
    arg_min(l_extendedprice / l_quantity, {LINE_ORDER}) AS open,
    max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
    arg_max(l_extendedprice / l_quantity, {LINE_ORDER}) AS close,
    sum(l_quantity) AS volume,
    l_shipdate + INTERVAL 1 DAY - INTERVAL 1 MILLISECOND AS close_time,
    sum(l_extendedprice) AS quote_asset_volume,
    CAST(count(*) AS INTEGER) AS number_of_trades,
    coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'A'), 0) AS taker_buy_base_asset_volume,
    coalesce(sum(l_extendedprice) FILTER (WHERE l_returnflag = 'A'), 0)
      AS taker_buy_quote_asset_volume
  FROM lineitem GROUP BY ALL)"""

# Order lines read as uncleaned bars: mixed epochs, several rows per time, NULLs. Twenty years
# on, because an epoch in microseconds is told from milliseconds only after 2001.
LINE_RAW = """raw AS (
  SELECT 'S' || l_suppkey || 'USDT' AS symbol,
    CASE WHEN l_linenumber % 2 = 0 THEN epoch_us(l_shipdate + INTERVAL 7305 DAY)
      ELSE epoch_ms(l_shipdate + INTERVAL 7305 DAY) END AS c0,
    l_extendedprice / l_quantity AS c1,
    l_extendedprice / l_quantity * 1.01::DOUBLE AS c2,
    CASE WHEN l_discount > 0 THEN l_extendedprice / l_quantity * 0.99::DOUBLE END AS c3,
    l_extendedprice / l_quantity * (1 - l_discount) AS c4,
    CASE WHEN l_tax > 0 THEN l_quantity END AS c5,
    CASE WHEN l_linenumber % 2 = 0 THEN epoch_us(l_shipdate + INTERVAL 7305 DAY) + 86399999999
      ELSE epoch_ms(l_shipdate + INTERVAL 7305 DAY) + 86399999 END AS c6,
    l_extendedprice AS c7, l_linenumber AS c8,
    l_quantity * l_discount AS c9, l_extendedprice * l_discount AS c10
  FROM lineitem),
raw_bars AS (
  SELECT symbol, CASE WHEN c0 >= 1000000000000000 THEN c0 // 1000 ELSE c0 END AS open_ms,
    make_timestamp(CASE WHEN c0 >= 1000000000000000 THEN c0 ELSE c0 * 1000 END) AS open_time,
    c1 AS open, c2 AS high, c3 AS low, c4 AS close, c5 AS volume,
    CASE WHEN c6 >= 1000000000000000 THEN c6 ELSE c6 * 1000 END AS close_us,
    c7 AS quote_asset_volume, c8 AS number_of_trades,
    c9 AS taker_buy_base_asset_volume, c10 AS taker_buy_quote_asset_volume
  FROM raw)"""

PROFILE = """profile AS (
  SELECT symbol, count(*) AS row_count, min(open_ms) AS min_time_ms, max(open_ms) AS max_time_ms,
    count(open_ms) - count(DISTINCT open_ms) AS duplicate_timestamps,
    count(*) FILTER (WHERE open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL
      OR volume IS NULL) AS null_values_count
  FROM {source} GROUP BY symbol)"""


def gaps(bar_ms: int) -> str:
    return f"""gaps AS (
  SELECT *, strftime(epoch_ms(min_time_ms), '%Y-%m-%d %H:%M:%S') AS start_date,
    strftime(epoch_ms(max_time_ms), '%Y-%m-%d %H:%M:%S') AS end_date,
    (max_time_ms - min_time_ms) // {bar_ms} + 1 AS expected_rows,
    (max_time_ms - min_time_ms) // {bar_ms} + 1 - row_count AS missing_rows,
    round(((max_time_ms - min_time_ms) // {bar_ms} + 1 - row_count)
      / ((max_time_ms - min_time_ms) // {bar_ms} + 1)::DOUBLE * 100, 4) AS gap_percentage
  FROM profile)"""


# --- windows ------------------------------------------------------------------------------

W = "PARTITION BY symbol ORDER BY open_time"


def frame(n: int) -> str:
    return f"({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def full(x: str, n: int, value: str) -> str:
    return f"CASE WHEN count({x}) OVER {frame(n)} = {n} THEN {value} END"


def mean(x: str, n: int) -> str:
    return full(x, n, f"avg({x}) OVER {frame(n)}")


def std(x: str, n: int) -> str:
    return full(x, n, f"stddev_samp({x}) OVER {frame(n)}")


def zscore(x: str, n: int) -> str:
    return full(
        x, n, f"({x} - avg({x}) OVER {frame(n)}) / (stddev_samp({x}) OVER {frame(n)} + 1e-10)"
    )


def ema(x: str, span: int) -> str:
    """The recurrence itself, folded over the rows so far."""
    a = f"(2::DOUBLE / {span + 1})"
    return (
        f"list_reduce(list({x}) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        f"lambda acc, v: acc * (1 - {a}) + v * {a})"
    )


LOG_RETURN = f"ln(close / nullif(lag(close) OVER ({W}), 0))"

RSI_STEPS = f"""chg AS (SELECT *, close - lag(close) OVER ({W}) AS change FROM {{source}}),
gl AS (SELECT *, CASE WHEN change > 0 THEN change ELSE 0 END AS gain,
  CASE WHEN change < 0 THEN -change ELSE 0 END AS loss FROM chg),
rsi AS (SELECT * EXCLUDE (change, gain, loss),
  100 - 100 / (1 + ({mean('gain', 14)}) / (({mean('loss', 14)}) + 1e-10)) AS rsi_14 FROM gl)"""


def indicators(source: str = "bars") -> str:
    return f"""ind1 AS (SELECT *,
    {mean('close', 15)} AS sma_15, {mean('close', 50)} AS sma_50,
    {ema('close', 15)} AS ema_15, {ema('close', 50)} AS ema_50,
    {LOG_RETURN} AS log_return,
    {ema('close', 12)} - {ema('close', 26)} AS macd_line,
    {mean('close', 20)} AS bb_middle, {std('close', 20)} AS bb_std
  FROM {source}),
ind2 AS (SELECT *, {ema('macd_line', 9)} AS macd_signal,
    bb_middle + 2 * bb_std AS bb_upper, bb_middle - 2 * bb_std AS bb_lower,
    {std('log_return', 30)} AS volatility_30 FROM ind1),
ind3 AS (SELECT *, macd_line - macd_signal AS macd_hist FROM ind2),
{RSI_STEPS.format(source='ind3')},
ind AS (SELECT * EXCLUDE (bb_std) FROM rsi)"""


STATIONARY = """(close - sma_15) / nullif(close, 0) AS close_to_sma_15,
    (close - sma_50) / nullif(close, 0) AS close_to_sma_50,
    (close - ema_15) / nullif(close, 0) AS close_to_ema_15,
    (close - ema_50) / nullif(close, 0) AS close_to_ema_50,
    (close - bb_lower) / (bb_upper - bb_lower + 1e-10) AS bb_position,
    macd_line / nullif(close, 0) AS macd_line_norm,
    macd_signal / nullif(close, 0) AS macd_signal_norm,
    macd_hist / nullif(close, 0) AS macd_hist_norm"""

FLOW = f"""taker_buy_base_asset_volume / (volume + 1e-10) AS taker_buy_ratio,
    {zscore('volume', 30)} AS volume_z30, {zscore('number_of_trades', 30)} AS trades_z30,
    sin(2 * pi() * hour(open_time) / 24) AS hour_sin,
    cos(2 * pi() * hour(open_time) / 24) AS hour_cos"""


def features(source: str = "bars") -> str:
    return f"{indicators(source)},\nfeat AS (SELECT *, {STATIONARY}, {FLOW} FROM ind)"


LABELS = f"""lab0 AS (SELECT *, lead(close, 15) OVER ({W}) AS future_close FROM {{source}}),
lab1 AS (SELECT *, future_close / nullif(close, 0) - 1 AS future_return FROM lab0),
lab AS (SELECT *, CASE WHEN future_return IS NOT NULL
  THEN CAST(future_return > 0 AS INTEGER) END AS target FROM lab1)"""

COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in [*FEATURE_COLUMNS, "target"])


def labelled(source: str = "bars") -> str:
    return (
        f"{features(source)},\n{LABELS.format(source='feat')},\n"
        f"labelled AS (SELECT * FROM lab WHERE {COMPLETE})"
    )


# --- splits -------------------------------------------------------------------------------

BOUNDS = """times AS (SELECT open_time, row_number() OVER (ORDER BY open_time) - 1 AS i,
    count(*) OVER () AS n FROM {source}),
bounds AS (SELECT
  date_trunc('second', min(open_time) FILTER (WHERE
    i >= least(floor(n * 0.7::DOUBLE)::BIGINT, n - 1))) AS train_end,
  date_trunc('second', min(open_time) FILTER (WHERE
    i >= least(floor(n * (0.7::DOUBLE + 0.15::DOUBLE))::BIGINT, n - 1))) AS val_end
  FROM times)"""

SPLIT = """split AS (SELECT l.*, CASE WHEN open_time < train_end THEN 'train'
    WHEN open_time >= train_end + INTERVAL 15 MINUTE AND open_time < val_end THEN 'val'
    WHEN open_time >= val_end + INTERVAL 15 MINUTE THEN 'test' END AS split
  FROM {source} l, bounds),
parts AS (SELECT * FROM split WHERE split IS NOT NULL)"""


# --- predictions and metrics --------------------------------------------------------------

PREDICTIONS = """scored AS (
  SELECT symbol, open_time, volatility_30, target AS y_true, 'rsi' AS model,
    round(rsi_14 / 100, 4) AS y_prob FROM {source}
  UNION ALL SELECT symbol, open_time, volatility_30, target, 'band',
    round(least(greatest(bb_position, 0), 1), 4) FROM {source}
  UNION ALL SELECT symbol, open_time, volatility_30, target, 'flow',
    round(least(greatest(taker_buy_ratio, 0), 1), 4) FROM {source}),
every_model AS (SELECT *, CAST(y_prob >= 0.5 AS INTEGER) AS y_pred FROM scored),
preds AS (SELECT * FROM every_model WHERE model = 'rsi')"""


def rates() -> str:
    return """coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0)::DOUBLE, 0) AS accuracy,
    coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS precision,
    coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS recall,
    coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) AS f1,
    coalesce((coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0)
      + coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0))
      / nullif((tp + fn > 0)::INTEGER + (tn + fp > 0)::INTEGER, 0), 0) AS balanced_accuracy,
    coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0) AS specificity,
    coalesce(tn / nullif(tn + fn, 0)::DOUBLE, 0) AS npv"""


def confusion(source: str, by: list[str], name: str = "conf") -> str:
    keys = ", ".join(by) + (", " if by else "")
    group = f" GROUP BY {', '.join(by)}" if by else ""
    return f"""{name} AS (SELECT {keys}count(*) AS "count",
    count(*) FILTER (WHERE y_true = 0 AND y_pred = 0) AS tn,
    count(*) FILTER (WHERE y_true = 0 AND y_pred = 1) AS fp,
    count(*) FILTER (WHERE y_true = 1 AND y_pred = 0) AS fn,
    count(*) FILTER (WHERE y_true = 1 AND y_pred = 1) AS tp
  FROM {source}{group})"""


def evaluation(source: str, by: list[str]) -> str:
    """All metrics; the curve areas straight from their definitions over rows."""
    keys = ", ".join(by) + (", " if by else "")
    part = f"PARTITION BY {', '.join(by)}" if by else ""
    group = f" GROUP BY {', '.join(by)}" if by else ""
    same = " AND ".join(f"p.{c} = n.{c}" for c in by) or "TRUE"
    back = lambda t: " AND ".join(f"c.{c} = {t}.{c}" for c in by) or "TRUE"
    own = ", ".join(f"p.{c}" for c in by) + (", " if by else "")
    return f"""{confusion(source, by)},
pairs AS (SELECT {own}avg(CASE WHEN p.y_prob > n.y_prob THEN 1.0::DOUBLE
    WHEN p.y_prob = n.y_prob THEN 0.5::DOUBLE ELSE 0::DOUBLE END) AS auc
  FROM {source} p JOIN {source} n ON {same} AND p.y_true = 1 AND n.y_true = 0{
      " GROUP BY " + ", ".join(f"p.{c}" for c in by) if by else ""}),
ranks AS (SELECT {keys}y_true,
    sum(y_true) OVER ({part} ORDER BY y_prob DESC RANGE UNBOUNDED PRECEDING)::DOUBLE
    / count(*) OVER ({part} ORDER BY y_prob DESC RANGE UNBOUNDED PRECEDING) AS prec
  FROM {source}),
ap AS (SELECT {keys}avg(prec) AS ap FROM ranks WHERE y_true = 1{group}),
ll AS (SELECT {keys}avg(-ln(CASE WHEN y_true = 1
    THEN least(greatest(y_prob, 1e-15), 1 - 1e-15)
    ELSE 1 - least(greatest(y_prob, 1e-15), 1 - 1e-15) END)) AS ll FROM {source}{group}),
evaluated AS (SELECT {", ".join("c." + k for k in by) + (", " if by else "")}c."count",
    c.tn, c.fp, c.fn, c.tp, {rates()},
    CASE WHEN tp + fn > 0 AND tn + fp > 0 THEN pairs.auc ELSE 0.5 END AS roc_auc,
    CASE WHEN tp + fn > 0 AND tn + fp > 0 THEN ap.ap ELSE 0.5 END AS pr_auc,
    CASE WHEN tp + fn > 0 AND tn + fp > 0 THEN ll.ll ELSE 0 END AS log_loss
  FROM conf c LEFT JOIN pairs ON {back('pairs')} LEFT JOIN ap ON {back('ap')}
  LEFT JOIN ll ON {back('ll')})"""


COUNTS = '"count", tn, fp, fn, tp'
COUNT_OUT = ", ".join(
    f'CAST({c} AS BIGINT) AS {c}' for c in ['"count"', "tn", "fp", "fn", "tp"]
)
RATE_NAMES = [
    "accuracy", "precision", "recall", "f1", "balanced_accuracy", "specificity", "npv",
]
METRIC_OUT = f"{COUNT_OUT}, {rs([*RATE_NAMES, 'roc_auc', 'pr_auc', 'log_loss'], 8)}"

REGIMES = """edges AS (SELECT quantile_cont(volatility_30, 0::DOUBLE) AS e0,
    quantile_cont(volatility_30, 1 / 3::DOUBLE) AS e1,
    quantile_cont(volatility_30, 2 / 3::DOUBLE) AS e2,
    quantile_cont(volatility_30, 1::DOUBLE) AS e3 FROM preds),
binned AS (SELECT p.*,
    CASE WHEN volatility_30 < e1 THEN 'Low' WHEN volatility_30 < e2 THEN 'Medium'
      ELSE 'High' END AS regime,
    CASE WHEN volatility_30 < e1 THEN e0 WHEN volatility_30 < e2 THEN e1 ELSE e2 END AS min_val,
    CASE WHEN volatility_30 < e1 THEN e1 WHEN volatility_30 < e2 THEN e2 ELSE e3 END AS max_val
  FROM preds p, edges)"""
