"""The sufficient-statistics cube and the market tables made from it."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlab.operators import clean, cube, profile
from barlab.plans import fixtures as fx
from barlab.plans import sql as q
from barlab.plans.registry import emit, query, rounded
from barlab.schema import DAY_MS
from barlab.session import materialize, scratch_dir
from barlab.sources import cube_store, sinks
from barlab.sources.adapters import read_table

_CUBE_BODY = """cube AS (SELECT symbol, strftime(open_time, '%Y-%m') AS month,
    hour(open_time) AS hour, count(*) AS n, sum(close / open - 1) AS sum_r,
    sum((close / open - 1) * (close / open - 1)) AS sum_r2,
    count(*) FILTER (WHERE close > open) AS up_n, sum(volume) AS sum_volume,
    sum(quote_asset_volume) AS sum_quote_volume, sum(number_of_trades) AS sum_trades,
    sum(taker_buy_base_asset_volume) AS sum_taker_buy_base FROM bars GROUP BY ALL)"""
_EVENT_CUBE = f"WITH {q.event_bars()}, {_CUBE_BODY}"
_LINE_CUBE = f"WITH {q.LINE_BARS}, {_CUBE_BODY}"
_GROUP_CUBE = f"WITH {q.event_bars('day', fx.GROUPS)}, {_CUBE_BODY}"

_ROLLUP = """sym AS (SELECT *, sum_r / n AS mean_r,
    sqrt(greatest(sum_r2 / n - (sum_r / n) * (sum_r / n), 0)) AS std_r, up_n / n AS up_share,
    taker_base / volume AS taker_ratio, quote_volume / (n / 1::DOUBLE) AS quote_vol_per_day
  FROM (SELECT symbol, sum(n)::BIGINT AS n, sum(sum_r) AS sum_r, sum(sum_r2) AS sum_r2,
    sum(up_n)::BIGINT AS up_n, sum(sum_volume) AS volume, sum(sum_quote_volume) AS quote_volume,
    sum(sum_trades)::BIGINT AS trades, sum(sum_taker_buy_base) AS taker_base
    FROM cube GROUP BY symbol))"""


def _listed(symbols: list[str]) -> str:
    return ", ".join(f"'{s}'" for s in symbols)


_MEMBERS = f"""flagged AS (SELECT s.*, coalesce(c.full_history, FALSE) AS in_cohort,
    s.symbol IN ({_listed(fx.TOP_GROUPS)}) AS in_top FROM sym s
  LEFT JOIN (SELECT symbol, TRUE AS full_history FROM bars GROUP BY symbol
    HAVING count(*) = 30 AND count(DISTINCT open_time) = 30
      AND date_diff('day', min(open_time), max(open_time)) = 29) c USING (symbol))"""
_FLAGGED = f"{_GROUP_CUBE}, {_ROLLUP}, {_MEMBERS}"


def _flagged(spark, d):
    bars = fx.grouped_daily(spark, d)
    gaps = profile.profile_gaps(profile.profile_symbols(bars), DAY_MS)
    rollup = cube.symbol_rollup(cube.eda_cube(bars), DAY_MS)
    return cube.with_membership(rollup, profile.full_history_cohort(gaps, 30), fx.TOP_GROUPS)


_SUMS = ["sum_r", "sum_r2", "sum_volume", "sum_quote_volume", "sum_taker_buy_base"]


@query(
    "eda_cube",
    f"{_EVENT_CUBE} SELECT symbol, month, {q.bigs(['hour', 'n', 'up_n', 'sum_trades'])}, "
    f"{q.rs(_SUMS, 4)} FROM cube",
)
def eda_cube(spark, d):
    out = cube.eda_cube(fx.hourly(spark, d))
    return emit(out, "symbol", "month", "hour", "n", "up_n", "sum_trades", **rounded(_SUMS, 4))


@query(
    "incremental_cube",
    f"{_LINE_CUBE} SELECT symbol, month, {q.bigs(['hour', 'n', 'up_n', 'sum_trades'])}, {q.rs(_SUMS, 4)} FROM cube",
)
def incremental_cube(spark, d):
    """The cube kept beside monthly bars: built without the last month and without what one symbol
    had in the first, then refreshed when both arrive."""
    store = scratch_dir(spark, "store")
    days = read_table(spark, d, "lineitem").agg(F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))
    ends = days.select(F.trunc("first", "month").alias("first"), F.trunc("last", "month").alias("last")).first()
    month = F.trunc("open_time", "month")
    late = (month == F.lit(ends["last"])) | ((month == F.lit(ends["first"])) & (F.col("symbol") == "S1USDT"))
    # Apart, so that the few late bars are not looked for among all others again.
    bars = fx.daily(spark, d).withColumn("late", F.coalesce(late, F.lit(False)))
    bars = materialize(bars, "bars", ["late"])
    for arrived in (bars.filter("NOT late").drop("late"), bars.filter("late").drop("late")):
        sinks.write_monthly(arrived, f"{store}/bars")
        refreshed = cube_store.refresh_cube(spark, f"{store}/bars", f"{store}/cube")
    return emit(refreshed.cube, "symbol", "month", "hour", "n", "up_n", "sum_trades", **rounded(_SUMS, 4))


_DERIVED = ["mean_r", "std_r", "up_share", "taker_ratio", "quote_vol_per_day", "quote_volume"]


@query(
    "symbol_rollup",
    f"{_LINE_CUBE}, {_ROLLUP} SELECT symbol, {q.bigs(['n', 'up_n', 'trades'])}, "
    f"{q.rs(_DERIVED, 4)} FROM sym",
)
def symbol_rollup(spark, d):
    out = cube.symbol_rollup(cube.eda_cube(fx.daily(spark, d)), DAY_MS)
    return emit(out, "symbol", "n", "up_n", "trades", **rounded(_DERIVED, 4))


@query(
    "monthly_activity",
    f"{_LINE_CUBE} SELECT month, sum(n)::BIGINT AS n, sum(up_n)::BIGINT AS up_n, "
    "count(DISTINCT symbol) AS active_symbols, "
    f"{q.r('sum(sum_quote_volume)', 2, 'quote_volume')}, "
    f"{q.r('sum(up_n) / sum(n)', 8, 'up_share')} FROM cube GROUP BY month",
)
def monthly_activity(spark, d):
    out = cube.monthly_activity(cube.eda_cube(fx.daily(spark, d)))
    return emit(out, "month", "n", "up_n", "active_symbols", quote_volume=2, up_share=8)


@query(
    "hourly_seasonality",
    f"{_EVENT_CUBE}, h AS (SELECT hour, sum(n)::BIGINT AS n, sum(sum_quote_volume) AS quote_volume, "
    "sum(sum_taker_buy_base) / sum(sum_volume) AS taker_ratio FROM cube GROUP BY hour) "
    f"SELECT {q.bigs(['hour', 'n'])}, {q.r('quote_volume', 3)}, "
    f"{q.r('quote_volume / sum(quote_volume) OVER ()', 8, 'volume_share')}, "
    f"{q.r('taker_ratio', 8)} FROM h",
)
def hourly_seasonality(spark, d):
    out = cube.hourly_seasonality(cube.eda_cube(fx.hourly(spark, d)))
    return emit(out, "hour", "n", quote_volume=3, volume_share=8, taker_ratio=8)


_MEDIANS = [f"median_{c}" for c in cube.COHORT_STATS]
_MEDIAN_SQL = ", ".join(f"median({c}) AS median_{c}" for c in cube.COHORT_STATS)


@query(
    "cohort_medians",
    f"{_FLAGGED}, m AS (SELECT in_cohort, {_MEDIAN_SQL} FROM flagged GROUP BY 1) "
    f"SELECT in_cohort, {q.rs(_MEDIANS, 6)} FROM m",
)
def cohort_medians(spark, d):
    flagged = materialize(_flagged(spark, d), "flagged")
    return emit(cube.cohort_medians(flagged), "in_cohort", **rounded(_MEDIANS, 6))


_TIER = """CASE WHEN in_top THEN 'listed' WHEN in_cohort THEN 'full history'
  ELSE 'other' END AS tier"""


@query("tier_of_symbol", f"{_FLAGGED} SELECT symbol, in_top, in_cohort, {_TIER} FROM flagged")
def tier_of_symbol(spark, d):
    tiered = clean.with_tier(_flagged(spark, d), fx.TOP_GROUPS)
    return tiered.select("symbol", "in_top", "in_cohort", "tier")


@query(
    "tier_summary",
    f"{_FLAGGED}, t AS (SELECT *, {_TIER} FROM flagged), m AS (SELECT tier, count(*) AS symbols, "
    f"sum(n)::BIGINT AS total_rows, {_MEDIAN_SQL} FROM t GROUP BY tier) "
    f"SELECT tier, symbols, total_rows, {q.rs(_MEDIANS, 6)} FROM m",
)
def tier_summary(spark, d):
    tiered = materialize(clean.with_tier(_flagged(spark, d), fx.TOP_GROUPS), "tiered")
    return emit(
        cube.tier_summary(tiered), "tier", "symbols", "total_rows", **rounded(_MEDIANS, 6)
    )


_TOPK = "ORDER BY quote_vol_per_day DESC, symbol LIMIT"


@query(
    "liquidity_topk",
    f"{_LINE_CUBE}, {_ROLLUP} SELECT symbol, {q.r('quote_vol_per_day', 4)} FROM sym "
    "ORDER BY sym.quote_vol_per_day DESC, symbol LIMIT 30",
)
def liquidity_topk(spark, d):
    rollup = cube.symbol_rollup(cube.eda_cube(fx.daily(spark, d)), DAY_MS)
    return emit(cube.liquidity_topk(rollup, 30), "symbol", quote_vol_per_day=4)


@query(
    "topk_set_diff",
    f"{_LINE_CUBE}, {_ROLLUP}, k AS (SELECT symbol FROM sym {_TOPK} 20), "
    f"c AS (SELECT unnest([{_listed(fx.TOP_SUPPLIERS)}]) AS symbol) "
    "SELECT symbol, 'ranked_only' AS side FROM (SELECT * FROM k EXCEPT SELECT * FROM c) "
    "UNION ALL "
    "SELECT symbol, 'configured_only' FROM (SELECT * FROM c EXCEPT SELECT * FROM k)",
)
def topk_set_diff(spark, d):
    rollup = cube.symbol_rollup(cube.eda_cube(fx.daily(spark, d)), DAY_MS)
    return cube.topk_set_diff(rollup, fx.TOP_SUPPLIERS, 20)


@query(
    "log_histogram",
    # The range spans all symbols, those without any deviation included.
    f"{_FLAGGED}, x AS (SELECT in_cohort, CASE WHEN std_r > 0 THEN log10(std_r) END AS v, "
    "log10(greatest(min(std_r) OVER (), 1e-6)) AS lo, log10(max(std_r) OVER ()) AS hi "
    "FROM flagged) "
    "SELECT in_cohort, least(floor((v - lo) * 39 / (hi - lo))::BIGINT, 38) AS bin, count(*) AS n "
    "FROM x WHERE v >= lo GROUP BY 1, 2",
)
def log_histogram(spark, d):
    from barlab.operators.eda import log_histogram as histogram

    return emit(histogram(_flagged(spark, d), "std_r", "in_cohort", 40), "in_cohort", "bin", "n")
