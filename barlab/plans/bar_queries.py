"""Sources, sinks, cleaning and profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.functions.timestamps import epoch_ms, epoch_timestamp, to_us
from barlab.operators import clean, cube, profile, rolling
from barlab.plans import fixtures as fx
from barlab.plans import sql as q
from barlab.plans.registry import emit, query, rounded
from barlab.schema import DAY_MS
from barlab.session import materialize, scratch_dir
from barlab.sources import raw, sinks, tables

# Prices leave as computed; sums, whose order differs between engines, leave rounded.
PRICES = ["open", "high", "low", "close"]
SUMS = rounded(
    ["volume", "quote_asset_volume", "taker_buy_base_asset_volume",
     "taker_buy_quote_asset_volume"], 5)
BAR_SQL = (
    f"symbol, {q.OPEN_MS}, epoch_ms(close_time) AS close_ms, "
    f"{q.big('number_of_trades')}, {', '.join(PRICES)}, {q.rs(list(SUMS), 5)}"
)


def _emit_bars(bars: DataFrame) -> DataFrame:
    bars = bars.withColumn("close_ms", F.unix_millis(F.col("close_time").cast("timestamp")))
    return emit(bars, "symbol", "open_time", "close_ms", "number_of_trades", *PRICES, **SUMS)


# --- sources and sinks --------------------------------------------------------------------


@query("bars_from_events", f"WITH {q.event_bars()} SELECT {BAR_SQL} FROM bars")
def bars_from_events(spark, d):
    return _emit_bars(fx.hourly(spark, d))


@query("bars_from_lineitem", f"WITH {q.LINE_BARS} SELECT {BAR_SQL} FROM bars")
def bars_from_lineitem(spark, d):
    return _emit_bars(fx.daily(spark, d))


@query(
    "scan_bars",
    "SELECT l_suppkey, l_linenumber::BIGINT AS l_linenumber, epoch_ms(l_shipdate) AS open_ms, "
    f"{q.r('l_extendedprice', 2)} FROM lineitem",
)
def scan_bars(spark, d):
    columns = ["l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice"]
    table = tables.load_bars(spark, f"{d}/lineitem.parquet", columns)
    return emit(
        table.withColumnRenamed("l_shipdate", "open_time"),
        "l_suppkey", "l_linenumber", "open_time", l_extendedprice=2,
    )


_PATH = "'spot/monthly/klines/S' || l_suppkey || 'USDT/1m/S' || l_suppkey || 'USDT-1m-' ||"


@query(
    "symbol_from_path",
    f"""SELECT regexp_extract({_PATH} strftime(l_shipdate, '%Y-%m') || '.csv',
        '([^/\\\\#?]+)-1m-', 1) AS symbol, count(*) AS n FROM lineitem GROUP BY 1""",
)
def symbol_from_path(spark, d):
    lines = fx.read_table(spark, d, "lineitem")
    name = F.concat(F.lit("S"), F.col("l_suppkey"), F.lit("USDT"))
    path = F.concat(
        F.lit("spot/monthly/klines/"), name, F.lit("/1m/"), name, F.lit("-1m-"),
        F.date_format("l_shipdate", "yyyy-MM"), F.lit(".csv"),
    )
    return lines.groupBy(raw.symbol_from_path(path).alias("symbol")).agg(F.count("*").alias("n"))


@query("write_bars", f"WITH {q.event_bars()} SELECT {BAR_SQL} FROM bars")
def write_bars(spark, d):
    path = scratch_dir(spark, "bars")
    sinks.write_bars(fx.hourly(spark, d), path)
    return _emit_bars(tables.load_bars(spark, path))


@query(
    "verify_bars",
    f"WITH {q.LINE_BARS} SELECT count(*) AS row_count, count(DISTINCT symbol) AS symbols FROM bars",
)
def verify_bars(spark, d):
    return sinks.verify_bars(fx.daily(spark, d))


@query(
    "cached_aggregates",
    f"WITH {q.LINE_BARS} SELECT symbol, strftime(open_time, '%Y-%m') AS month, "
    f"count(*) AS n, count(*) FILTER (WHERE close > open) AS up_n, "
    f"{q.r('sum(volume)', 4, 'sum_volume')} FROM bars GROUP BY 1, 2",
)
def cached_aggregates(spark, d):
    path = f"{scratch_dir(spark, 'cube')}/cube"
    for _ in range(2):  # the second call reads what the first one wrote
        table = tables.read_or_compute(spark, path, lambda: cube.eda_cube(fx.daily(spark, d)))
    monthly = table.groupBy("symbol", "month").agg(
        F.sum("n").alias("n"), F.sum("up_n").alias("up_n"), F.sum("sum_volume").alias("sum_volume")
    )
    return emit(monthly, "symbol", "month", "n", "up_n", sum_volume=4)


@query(
    "catalog_table",
    f"WITH {q.event_bars('day')} SELECT symbol, count(*) AS n, {q.r('sum(volume)', 4, 'volume')} "
    "FROM bars GROUP BY 1",
)
def catalog_table(spark, d):
    path = scratch_dir(spark, "catalog")
    sinks.write_bars(fx.bars_from_events(spark, d, "day"), path)
    name = "bars_" + path.rsplit("-", 1)[-1]
    table = tables.register_table(spark, name, path)
    out = table.groupBy("symbol").agg(F.count("*").alias("n"), F.sum("volume").alias("volume"))
    out = materialize(emit(out, "symbol", "n", volume=4), "totals")
    spark.sql(f"DROP TABLE {name}")
    return out


@query(
    "bucketed_sma",
    f"WITH {q.LINE_BARS}, t AS (SELECT *, {q.mean('close', 15)} AS sma_15, {q.mean('close', 50)} AS sma_50 "
    f"FROM bars) SELECT symbol, {q.OPEN_MS}, {q.rs(['sma_15', 'sma_50'], 6)} FROM t",
)
def bucketed_sma(spark, d):
    path = scratch_dir(spark, "bucketed")
    name = "bucketed_" + path.rsplit("-", 1)[-1]
    table = tables.save_bucketed(fx.stored_daily(spark, d), name, path, buckets=8)
    out = rolling.sma(table, (15, 50), segment_rows=None, tie_break=[])
    out = materialize(emit(out, "symbol", "open_time", sma_15=6, sma_50=6), "averages")
    spark.sql(f"DROP TABLE {name}")
    return out


_INCOMPLETE = "open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL"


@query(
    "validation_report",
    f"""WITH {q.LINE_RAW} SELECT count(*) AS row_count, count(*) FILTER (WHERE symbol IS NULL) AS no_symbol,
    count(*) FILTER (WHERE open_ms IS NULL) AS no_time, count(*) FILTER (WHERE {_INCOMPLETE}) AS null_rows,
    count(*) FILTER (WHERE high < low OR high < open OR high < close) AS low_high,
    count(*) FILTER (WHERE least(open, high, low, close) <= 0) AS bad_price,
    count(*) FILTER (WHERE volume < 0) AS bad_volume, min(open_ms)::BIGINT AS first_ms, max(open_ms)::BIGINT AS last_ms
    FROM raw_bars""",
)
def validation_report(spark, d):
    return sinks.write_checked(clean.canonical_bars(fx.raw_lines(spark, d)), scratch_dir(spark, "checked"))


_RAW_OUT = f"""symbol, {q.big('epoch_ms(open_time)', 'open_ms')}, {q.r('close', 6)}, {q.r('volume', 6)},
    {q.big('number_of_trades')}"""


def _raw_folder(spark, d) -> str:
    """Daily bars as raw files below the documented layout: a file per symbol and month."""
    root = scratch_dir(spark, "raw")
    rows = sinks.raw_rows(fx.daily(spark, d))
    sinks.write_raw(rows, root)
    return root


def _emit_scanned(bars):
    return emit(bars, "symbol", "open_time", "number_of_trades", close=6, volume=6)


@query("scan_raw_csv", f"WITH {q.LINE_BARS} SELECT {_RAW_OUT} FROM bars")
def scan_raw_csv(spark, d):
    return _emit_scanned(raw.read_raw_bars(spark, _raw_folder(spark, d)))


@query(
    "scan_raw_symbols",
    f"WITH {q.LINE_BARS} SELECT {_RAW_OUT} FROM bars WHERE symbol IN ('S1USDT', 'S3USDT', 'S8USDT')",
)
def scan_raw_symbols(spark, d):
    symbols = ["S1USDT", "S3USDT", "S8USDT", "NONEUSDT"]
    return _emit_scanned(raw.read_raw_bars(spark, _raw_folder(spark, d), symbols))


@query("scan_raw_tree", f"WITH {q.LINE_BARS} SELECT symbol, count(*) AS n FROM bars GROUP BY 1")
def scan_raw_tree(spark, d):
    rows = raw.scan_raw_tree(spark, f"{_raw_folder(spark, d)}/spot")
    return rows.groupBy("symbol").agg(F.count("*").alias("n"))


# --- cleaning -----------------------------------------------------------------------------


@query(
    "normalize_ts_ms",
    f"""WITH {q.LINE_RAW} SELECT symbol,
    CASE WHEN c0 >= 1000000000000000 THEN c0 // 1000 ELSE c0 END AS open_ms,
    CASE WHEN c6 >= 1000000000000000 THEN c6 // 1000 ELSE c6 END AS close_ms FROM raw""",
)
def normalize_ts_ms(spark, d):
    rows = fx.raw_lines(spark, d)
    return rows.select("symbol", epoch_ms("_c0").alias("open_ms"), epoch_ms("_c6").alias("close_ms"))


@query(
    "normalize_ts",
    f"""WITH {q.LINE_RAW} SELECT symbol, epoch_us(open_time) AS open_us,
    epoch_us(make_timestamp(close_us)) AS close_us FROM raw_bars""",
)
def normalize_ts(spark, d):
    rows = fx.raw_lines(spark, d)
    return rows.select(
        "symbol",
        to_us(epoch_timestamp("_c0")).alias("open_us"),
        to_us(epoch_timestamp("_c6")).alias("close_us"),
    )


RAW_VALUES = [*PRICES, *SUMS]
RAW_SQL = (
    f"symbol, open_ms, close_us // 1000 AS close_ms, {q.big('number_of_trades')}, "
    f"{', '.join(RAW_VALUES)}"
)


def _emit_raw(bars: DataFrame) -> DataFrame:
    bars = bars.withColumn("close_ms", F.unix_millis("close_time"))
    return emit(bars, "symbol", "open_time", "close_ms", "number_of_trades", *RAW_VALUES)


@query("canonical_bars", f"WITH {q.LINE_RAW} SELECT {RAW_SQL} FROM raw_bars")
def canonical_bars(spark, d):
    return _emit_raw(clean.canonical_bars(fx.raw_lines(spark, d)))


@query(
    "filter_symbol", f"WITH {q.event_bars()} SELECT {BAR_SQL} FROM bars WHERE symbol = 'CLICKUSDT'"
)
def filter_symbol(spark, d):
    return _emit_bars(clean.filter_symbol(fx.hourly(spark, d), "CLICKUSDT"))


_TOP = ", ".join(f"'{s}'" for s in fx.TOP_SUPPLIERS)


@query("filter_symbols", f"WITH {q.LINE_BARS} SELECT {BAR_SQL} FROM bars WHERE symbol IN ({_TOP})")
def filter_symbols(spark, d):
    return _emit_bars(clean.filter_symbols(fx.daily(spark, d), fx.TOP_SUPPLIERS))


@query(
    "tradable_universe",
    """WITH pairs AS (SELECT CASE l_suppkey % 6 WHEN 1 THEN 'S' || l_suppkey || 'UPUSDT'
      WHEN 2 THEN 'S' || l_suppkey || 'DOWNUSDT' WHEN 3 THEN 'S' || l_suppkey || 'BUSD'
      WHEN 4 THEN 'USDCUSDT' ELSE 'S' || l_suppkey || 'USDT' END AS symbol FROM lineitem)
    SELECT symbol, count(*) AS n FROM pairs
    WHERE symbol LIKE '%USDT' AND symbol NOT LIKE '%UPUSDT' AND symbol NOT LIKE '%DOWNUSDT'
      AND left(symbol, length(symbol) - 4) NOT IN
        ('USDC', 'BUSD', 'TUSD', 'FDUSD', 'DAI', 'USDP', 'PAX', 'UST', 'USTC')
    GROUP BY symbol""",
)
def tradable_universe(spark, d):
    key = F.concat(F.lit("S"), F.col("l_suppkey"))
    kind = F.col("l_suppkey") % 6
    symbol = (
        F.when(kind == 1, F.concat(key, F.lit("UPUSDT")))
        .when(kind == 2, F.concat(key, F.lit("DOWNUSDT")))
        .when(kind == 3, F.concat(key, F.lit("BUSD")))
        .when(kind == 4, "USDCUSDT")
        .otherwise(F.concat(key, F.lit("USDT")))
    )
    pairs = fx.read_table(spark, d, "lineitem").select(symbol.alias("symbol"))
    return clean.tradable_universe(pairs).groupBy("symbol").agg(F.count("*").alias("n"))


@query(
    "filter_window",
    f"""WITH {q.event_bars()} SELECT {BAR_SQL} FROM bars
    WHERE open_time >= TIMESTAMP '2024-01-05' AND open_time < TIMESTAMP '2024-01-20 12:00:00'""",
)
def filter_window(spark, d):
    bars = fx.hourly(spark, d)
    return _emit_bars(clean.filter_window(bars, "2024-01-05 00:00:00", "2024-01-20 12:00:00"))


@query(
    "null_rows",
    f"""WITH {q.LINE_RAW} SELECT symbol, CAST(open IS NULL OR high IS NULL OR low IS NULL
      OR close IS NULL OR volume IS NULL AS BIGINT) AS is_null_row, count(*) AS n
    FROM raw_bars GROUP BY 1, 2""",
)
def null_rows(spark, d):
    flagged = clean.null_rows(clean.canonical_bars(fx.raw_lines(spark, d)))
    return emit(
        flagged.groupBy("symbol", "is_null_row").agg(F.count("*").alias("n")),
        "symbol", "is_null_row", "n",
    )


@query(
    "drop_incomplete",
    f"WITH {q.LINE_RAW} SELECT {RAW_SQL} FROM raw_bars WHERE low IS NOT NULL AND volume IS NOT NULL",
)
def drop_incomplete(spark, d):
    return _emit_raw(
        clean.drop_incomplete(clean.canonical_bars(fx.raw_lines(spark, d)), ["low", "volume"])
    )


@query(
    "dedup_bars",
    f"""WITH {q.LINE_RAW} SELECT {RAW_SQL} FROM raw_bars QUALIFY row_number() OVER (
      PARTITION BY symbol, open_ms ORDER BY open NULLS FIRST, high NULLS FIRST, low NULLS FIRST,
      close NULLS FIRST, volume NULLS FIRST, close_us NULLS FIRST, quote_asset_volume NULLS FIRST,
      number_of_trades NULLS FIRST, taker_buy_base_asset_volume NULLS FIRST,
      taker_buy_quote_asset_volume NULLS FIRST) = 1""",
)
def dedup_bars(spark, d):
    return _emit_raw(clean.dedup_bars(clean.canonical_bars(fx.raw_lines(spark, d))))


# --- profile ------------------------------------------------------------------------------

_RAW_PROFILE = f"WITH {q.LINE_RAW}, {q.PROFILE.format(source='raw_bars')}"


def _raw_bars(spark, d):
    return clean.canonical_bars(fx.raw_lines(spark, d))


@query(
    "profile_base",
    f"{_RAW_PROFILE} SELECT symbol, row_count, min_time_ms, max_time_ms, null_values_count "
    "FROM profile",
)
def profile_base(spark, d):
    return profile.profile_base(_raw_bars(spark, d))


@query(
    "duplicate_timestamps",
    f"{_RAW_PROFILE} SELECT symbol, duplicate_timestamps FROM profile "
    "WHERE duplicate_timestamps > 0",
)
def duplicate_timestamps(spark, d):
    return profile.duplicate_timestamps(_raw_bars(spark, d))


@query(
    "profile_symbols",
    f"{_RAW_PROFILE} SELECT symbol, row_count, min_time_ms, max_time_ms, duplicate_timestamps, "
    "null_values_count FROM profile",
)
def profile_symbols(spark, d):
    return profile.profile_symbols(_raw_bars(spark, d))


@query(
    "profile_gaps",
    f"{_RAW_PROFILE}, {q.gaps(DAY_MS)} SELECT symbol, row_count, start_date, end_date, "
    f"expected_rows, missing_rows, {q.r('gap_percentage', 4)} FROM gaps",
)
def profile_gaps(spark, d):
    table = profile.profile_gaps(profile.profile_symbols(_raw_bars(spark, d)), DAY_MS)
    return emit(
        table, "symbol", "row_count", "start_date", "end_date", "expected_rows", "missing_rows",
        gap_percentage=4,
    )


@query(
    "profile_totals",
    f"{_RAW_PROFILE} SELECT count(*) AS total_symbols, sum(row_count)::BIGINT AS total_rows, "
    "sum(duplicate_timestamps)::BIGINT AS total_duplicates, "
    "sum(null_values_count)::BIGINT AS total_null_rows FROM profile",
)
def profile_totals(spark, d):
    return profile.profile_totals(profile.profile_symbols(_raw_bars(spark, d)))


_GROUP_PROFILE = (
    f"WITH {q.event_bars('day', fx.GROUPS)}, timed AS (SELECT *, epoch_ms(open_time) AS open_ms "
    f"FROM bars), {q.PROFILE.format(source='timed')}, {q.gaps(DAY_MS)}"
)


@query(
    "full_history_cohort",
    f"{_GROUP_PROFILE} SELECT symbol, row_count FROM gaps "
    "WHERE row_count = 30 AND missing_rows = 0 AND duplicate_timestamps = 0",
)
def full_history_cohort(spark, d):
    gaps = profile.profile_gaps(profile.profile_symbols(fx.grouped_daily(spark, d)), DAY_MS)
    return profile.full_history_cohort(gaps, 30).select("symbol", "row_count")


@query(
    "profile_report",
    f"""{_GROUP_PROFILE},
    lines AS (SELECT '| ' || symbol || ' | ' || format('{{:,}}', row_count) || ' | '
      || format('{{:,}}', expected_rows) || ' | ' || format('{{:,}}', missing_rows) || ' | '
      || gap_percentage::VARCHAR || '% | ' || start_date || ' | ' || end_date || ' | '
      || duplicate_timestamps || ' | ' || null_values_count || ' |' AS line FROM gaps)
    SELECT line FROM lines
    UNION ALL SELECT unnest(['# Dataset Profile Report', '', 'Daily event bars', '',
      '## Summary Metrics', '',
      '- **Total Unique Symbols**: ' || count(*),
      '- **Total Rows (Observations)**: ' || format('{{:,}}', sum(row_count)::BIGINT),
      '- **Total Duplicate Timestamps**: ' || sum(duplicate_timestamps)::BIGINT,
      '- **Total Rows with Null Values**: ' || sum(null_values_count)::BIGINT, '',
      '## Detailed Symbol Analysis', '',
      '| Symbol | Total Rows | Expected Rows | Gaps (Rows) | Gap % | Start Date (UTC) '
        || '| End Date (UTC) | Duplicates | Nulls |',
      '| :--- | :---: | :---: | :---: | :---: | :--- | :--- | :---: | :---: |']) FROM gaps""",
)
def profile_report(spark, d):
    gaps = profile.profile_gaps(profile.profile_symbols(fx.grouped_daily(spark, d)), DAY_MS)
    return profile.profile_report(gaps, "Dataset Profile Report", "Daily event bars")
