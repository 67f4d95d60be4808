"""Bar tables built from event and order tables, with the canonical columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.schema import BAR_COLUMNS, DAY_MS

UNIT_MS = {"minute": 60_000, "hour": 3_600_000, "day": DAY_MS}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def packed(*parts: tuple[Column, int]) -> Column:
    """Whole numbers in lexicographic order as one decimal of fixed width.

    Each part is not negative and has at most so many digits, 38 in all.
    """
    # Decimal arithmetic is by far the slower one: as many parts as fit are first packed into longs.
    longs: list[tuple[Column, int]] = []
    for value, digits in parts:
        if longs and longs[-1][1] + digits <= 18:
            before, width = longs.pop()
            longs.append((before * F.lit(10**digits) + value.cast("long"), width + digits))
        else:
            longs.append((value.cast("long"), digits))
    order = longs[0][0].cast("decimal(38,0)")
    for value, digits in longs[1:]:
        order = order * F.lit("1" + "0" * digits).cast(f"decimal({digits + 1},0)") + value.cast("decimal(38,0)")
    return order


def bars_from_ticks(
    ticks: DataFrame,
    price: Column,
    volume: Column,
    quote: Column,
    taker: Column,
    order: Column,
    opened: Column,
    bar_ms: int,
) -> DataFrame:
    """OHLCV bars per (symbol, opening time) from a table with a ``symbol`` column.

    ``order`` ranks the ticks of a bar; the first and last give open and close. It is one number
    of fixed width, not a struct, so that bars are hash-aggregated without a sort of the ticks.
    Ticks whose price or volume is NaN are left out.
    """
    number = lambda c: ~F.coalesce(F.isnan(c), F.lit(False))
    ticks = ticks.filter(number(price) & number(volume))
    on_taker = lambda c: F.sum(F.when(taker, c).otherwise(0.0))
    close_time = F.col("open_time") + F.expr(f"INTERVAL '{bar_ms // 1000}' SECOND")
    return (
        ticks.groupBy("symbol", opened.alias("open_time"))
        .agg(
            F.min_by(price, order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, order).alias("close"),
            F.sum(volume).alias("volume"),
            F.sum(quote).alias("quote_asset_volume"),
            F.count(F.lit(1)).cast("int").alias("number_of_trades"),
            on_taker(volume).alias("taker_buy_base_asset_volume"),
            on_taker(quote).alias("taker_buy_quote_asset_volume"),
        )
        .withColumn("close_time", close_time - F.expr("INTERVAL '0.001' SECOND"))
        .select(*BAR_COLUMNS)
    )


def bars_from_events(
    spark: SparkSession, sf_dir: str, unit: str = "hour", groups: int | None = None
) -> DataFrame:
    """Bars of the event values, one symbol per event type (and per user group, if given)."""
    events = read_table(spark, sf_dir, "events")
    value = F.col("value")
    group = [] if groups is None else [(F.col("user_id") % groups).cast("string")]
    symbol = F.concat(F.upper("event_type"), *group, F.lit("USDT"))
    return bars_from_ticks(
        events.select("event_id", "ts", "value", symbol.alias("symbol")),
        price=value,
        volume=value,
        quote=value * value,
        taker=F.col("event_id") % 2 == 0,
        order=packed((F.unix_micros(F.col("ts").cast("timestamp")), 18), (F.col("event_id"), 19)),
        opened=F.date_trunc(unit, F.col("ts").cast("timestamp")),
        bar_ms=UNIT_MS[unit],
    )


def bars_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of the unit price, one symbol per supplier."""
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_shipdate",
    )
    # All lines of a bar have one supplier; prices are in cents.
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    key = [(F.col("l_orderkey"), 13), (F.col("l_linenumber"), 1), (F.col("l_partkey"), 12), (cents, 11)]
    return bars_from_ticks(
        lines.withColumn("symbol", F.concat(F.lit("S"), F.col("l_suppkey"), F.lit("USDT"))),
        price=F.try_divide("l_extendedprice", "l_quantity"),
        volume=F.col("l_quantity"),
        quote=F.col("l_extendedprice"),
        taker=F.col("l_returnflag") == "A",
        order=packed(*key),
        opened=F.col("l_shipdate").cast("timestamp"),
        bar_ms=DAY_MS,
    )
