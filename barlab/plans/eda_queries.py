"""Descriptive statistics of bars and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlab.operators import eda, features
from barlab.operators.clean import drop_incomplete
from barlab.plans import fixtures as fx
from barlab.plans import sql as q
from barlab.plans.registry import emit, query, rounded
from barlab.schema import DAY_MS, FEATURE_COLUMNS
from barlab.session import materialize

_FEAT = f"WITH {q.event_bars()}, {q.features()}, f AS (SELECT * FROM feat WHERE " + " AND ".join(
    f"{c} IS NOT NULL" for c in FEATURE_COLUMNS
) + ")"
_LAB = f"WITH {q.event_bars()}, {q.labelled()}"
_BOX_FEATURES = [
    "close_to_sma_15", "bb_position", "macd_hist_norm", "volatility_30", "rsi_14", "log_return",
]


def _features(spark, d):
    """Complete features as a stored table: what reads it takes several passes."""
    table = features.feature_matrix(fx.hourly(spark, d), bar_ms=fx.HOUR_MS)
    return materialize(drop_incomplete(table, FEATURE_COLUMNS).select(*FEATURE_COLUMNS), "features")


def _each(columns: list[str], select: str, source: str, tail: str = "") -> str:
    """One SELECT per feature, ``{c}`` replaced by its name."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {select.replace('{c}', c)} FROM {source} {tail}"
        for c in columns
    )


@query(
    "symbol_summary",
    f"WITH {q.LINE_BARS}, s AS (SELECT symbol, count(*) AS total_observations, "
    "epoch_ms(min(open_time)) AS start_ms, epoch_ms(max(open_time)) AS end_ms, "
    "avg(close) AS mean_price, stddev_samp(close) AS std_price, avg(volume) AS mean_volume "
    "FROM bars GROUP BY symbol ORDER BY 2 DESC, 1 LIMIT 5) "
    "SELECT symbol, total_observations, start_ms, end_ms, "
    f"{q.rs(['mean_price', 'std_price', 'mean_volume'], 5)} FROM s",
)
def symbol_summary(spark, d):
    out = eda.symbol_summary(fx.daily(spark, d))
    out = out.withColumns(
        {"start_ms": F.unix_millis("start_date"), "end_ms": F.unix_millis("end_date")}
    )
    return emit(
        out, "symbol", "total_observations", "start_ms", "end_ms",
        mean_price=5, std_price=5, mean_volume=5,
    )


_MOMENTS = (
    "count({c}) AS n, avg({c}) AS mean, median({c}) AS median, stddev_pop({c}) AS std, "
    "skewness({c}) AS skewness, kurtosis({c}) AS kurtosis"
)


@query(
    "feature_stats",
    f"{_FEAT}, s AS ({_each(FEATURE_COLUMNS, _MOMENTS, 'f')}) "
    f"SELECT feature, n, {q.rs(['mean', 'median', 'std', 'skewness', 'kurtosis'], 4)} FROM s",
)
def feature_stats(spark, d):
    out = eda.feature_stats(_features(spark, d), FEATURE_COLUMNS)
    return emit(out, "feature", "n", mean=4, median=4, std=4, skewness=4, kurtosis=4)


_FENCES = _each(
    FEATURE_COLUMNS, "quantile_cont({c}, 0.25::DOUBLE) AS q25, quantile_cont({c}, 0.75::DOUBLE) AS q75, "
    "count({c}) AS n", "f"
)
_OUT = " UNION ALL ".join(
    f"SELECT q.*, (SELECT count(*) FROM f WHERE f.{c} < q25 - 1.5 * (q75 - q25) "
    f"OR f.{c} > q75 + 1.5 * (q75 - q25)) AS outliers FROM q WHERE feature = '{c}'"
    for c in FEATURE_COLUMNS
)


@query(
    "iqr_outliers",
    f"{_FEAT}, q AS ({_FENCES}), o AS ({_OUT}) SELECT feature, outliers, {q.rs(['q25', 'q75'], 5)}, "
    f"{q.r('q75 - q25', 5, 'iqr')}, {q.r('outliers * 100.0::DOUBLE / n', 6, 'outlier_pct')} FROM o",
)
def iqr_outliers(spark, d):
    out = eda.iqr_outliers(_features(spark, d), FEATURE_COLUMNS)
    return emit(out, "feature", "outliers", q25=5, q75=5, iqr=5, outlier_pct=6)


_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
    + ("1::DOUBLE" if a == b else f"corr({a}, {b})")
    + " AS correlation FROM f"
    + (" HAVING count(*) > 0" if a == b else "")
    for a in FEATURE_COLUMNS
    for b in FEATURE_COLUMNS
)


@query(
    "feature_correlation",
    f"{_FEAT}, p AS ({_PAIRS}) SELECT feature_a, feature_b, {q.r('correlation', 6)} FROM p",
)
def feature_correlation(spark, d):
    out = eda.feature_correlation(_features(spark, d), FEATURE_COLUMNS)
    return emit(out, "feature_a", "feature_b", correlation=6)


@query(
    "target_correlation",
    f"{_LAB}, p AS ({_each(FEATURE_COLUMNS, 'corr({c}, future_return) AS correlation', 'labelled')})"
    f" SELECT feature, {q.r('correlation', 6)} FROM p",
)
def target_correlation(spark, d):
    return emit(
        eda.target_correlation(fx.labelled(spark, d), FEATURE_COLUMNS), "feature", correlation=6
    )


_HIST = _each(
    FEATURE_COLUMNS,
    "coalesce(least(floor(({c} - lo_{c}) * 50 / nullif(hi_{c} - lo_{c}, 0))::BIGINT, 49), 0) AS bin,"
    " count(*) AS n",
    "x",
    "GROUP BY 2",
)


@query(
    "feature_histogram",
    f"{_FEAT}, x AS (SELECT *, "
    + ", ".join(
        f"min({c}) OVER () AS lo_{c}, max({c}) OVER () AS hi_{c}"
        for c in FEATURE_COLUMNS
    )
    + f" FROM f) {_HIST}",
)
def feature_histogram(spark, d):
    table = eda.feature_histogram(_features(spark, d), FEATURE_COLUMNS)
    return emit(table, "feature", "bin", "n")


_FIVE = (
    "min({c}) AS minimum, quantile_cont({c}, 0.25::DOUBLE) AS q25, median({c}) AS median, "
    "quantile_cont({c}, 0.75::DOUBLE) AS q75, max({c}) AS maximum"
)
_FIVE_OUT = q.rs(list(eda.FIVE_NUMBERS), 5)
_FIVE_DIGITS = rounded(list(eda.FIVE_NUMBERS), 5)


@query(
    "box_stats",
    f"{_FEAT}, b AS ({_each(FEATURE_COLUMNS, _FIVE, 'f')}) SELECT feature, {_FIVE_OUT} FROM b",
)
def box_stats(spark, d):
    out = eda.box_stats(_features(spark, d), FEATURE_COLUMNS)
    return emit(out, "feature", **_FIVE_DIGITS)


@query(
    "box_stats_by_target",
    f"{_LAB}, b AS ({_each(_BOX_FEATURES, 'target, ' + _FIVE, 'labelled', 'GROUP BY target')}) "
    f"SELECT feature, {q.big('target')}, {_FIVE_OUT} FROM b",
)
def box_stats_by_target(spark, d):
    out = eda.box_stats(fx.labelled(spark, d), _BOX_FEATURES, ["target"])
    return emit(out, "feature", "target", **_FIVE_DIGITS)


@query(
    "series_slice",
    f"WITH {q.LINE_BARS}, t AS (SELECT *, {q.mean('close', 15)} AS sma_15, "
    f"row_number() OVER ({q.W}) AS row_no FROM bars) "
    f"SELECT symbol, {q.OPEN_MS}, row_no, {q.r('close', 5)}, "
    f"{q.r('(close - sma_15) / nullif(close, 0)', 6, 'close_to_sma_15')} FROM t WHERE row_no <= 100",
)
def series_slice(spark, d):
    from barlab.operators.rolling import sma

    table = sma(fx.daily(spark, d), (15,), bar_ms=DAY_MS)
    table = table.withColumn(
        "close_to_sma_15", F.try_divide(F.col("close") - F.col("sma_15"), F.col("close"))
    )
    out = eda.series_slice(table, ["close", "close_to_sma_15"], 100)
    return emit(out, "symbol", "open_time", "row_no", close=5, close_to_sma_15=6)
