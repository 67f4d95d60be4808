"""Data quality per symbol: coverage, gaps, duplicates and incomplete rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.functions.checks import require_columns
from barlab.functions.timestamps import format_ms, to_ms
from barlab.operators.clean import null_row_flag
from barlab.schema import FULL_WINDOW_ROWS, MINUTE_MS, OHLCV_COLUMNS


def _keyed(bars: DataFrame) -> DataFrame:
    require_columns(bars, ["symbol", "open_time", *OHLCV_COLUMNS], "bar table")
    return bars.select(
        "symbol", to_ms("open_time").alias("time_ms"), null_row_flag().alias("is_null_row")
    )


def profile_base(bars: DataFrame) -> DataFrame:
    """Rows, first and last time, and incomplete rows of each symbol."""
    return (
        _keyed(bars)
        .groupBy("symbol")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min("time_ms").alias("min_time_ms"),
            F.max("time_ms").alias("max_time_ms"),
            F.sum("is_null_row").alias("null_values_count"),
        )
    )


def duplicate_timestamps(bars: DataFrame) -> DataFrame:
    """Surplus rows per symbol that has any; rows without a time are not duplicates."""
    return (
        _keyed(bars)
        .filter(F.col("time_ms").isNotNull())
        .groupBy("symbol", "time_ms")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .groupBy("symbol")
        .agg(F.sum(F.col("n") - 1).alias("duplicate_timestamps"))
    )


def profile_symbols(bars: DataFrame) -> DataFrame:
    """Base profile and duplicates from a single scan, most rows first.

    Counting per (symbol, time) first lets duplicates fall out of the same two-level
    aggregation: no second scan, no join and no count-distinct.
    """
    per_time = (
        _keyed(bars)
        .groupBy("symbol", "time_ms")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("is_null_row").alias("nulls"))
    )
    surplus = F.when(F.col("time_ms").isNotNull(), F.col("n") - 1).otherwise(0)
    return (
        per_time.groupBy("symbol")
        .agg(
            F.sum("n").alias("row_count"),
            F.min("time_ms").alias("min_time_ms"),
            F.max("time_ms").alias("max_time_ms"),
            F.sum(surplus).alias("duplicate_timestamps"),
            F.sum("nulls").alias("null_values_count"),
        )
        .orderBy(F.desc("row_count"), "symbol")
    )


def profile_gaps(profile: DataFrame, bar_ms: int = MINUTE_MS) -> DataFrame:
    """Expected and missing rows for a bar length; missing is negative where copies outnumber gaps."""
    span = (F.col("max_time_ms") - F.col("min_time_ms")) / F.lit(bar_ms) + 1
    return (
        profile.withColumns(
            {
                "start_date": format_ms("min_time_ms"),
                "end_date": format_ms("max_time_ms"),
                "expected_rows": F.floor(span),
            }
        )
        .withColumn("missing_rows", F.col("expected_rows") - F.col("row_count"))
        .withColumn(
            "gap_percentage", F.round(F.col("missing_rows") / F.col("expected_rows") * 100, 4)
        )
    )


def profile_totals(profile: DataFrame) -> DataFrame:
    return profile.agg(
        F.count(F.lit(1)).alias("total_symbols"),
        F.sum("row_count").alias("total_rows"),
        F.sum("duplicate_timestamps").alias("total_duplicates"),
        F.sum("null_values_count").alias("total_null_rows"),
    )


def full_history_cohort(gaps: DataFrame, window_rows: int = FULL_WINDOW_ROWS) -> DataFrame:
    """Symbols covering the whole window with no gap and no duplicate."""
    return gaps.filter(
        (F.col("row_count") == window_rows)
        & (F.col("missing_rows") == 0)
        & (F.col("duplicate_timestamps") == 0)
    )


def profile_report(gaps: DataFrame, title: str, description: str) -> DataFrame:
    """The profile as markdown, one row per line: ``line_no``, ``line``.

    Lines are built in Spark; write them with ``sinks.write_text``.
    """
    totals = profile_totals(gaps)
    # The report's wording and table layout.
    head = [
        F.lit(f"# {title}"),
        F.lit(""),
        F.lit(description),
        F.lit(""),
        F.lit("## Summary Metrics"),
        F.lit(""),
        F.format_string("- **Total Unique Symbols**: %d", "total_symbols"),
        F.format_string("- **Total Rows (Observations)**: %,d", "total_rows"),
        F.format_string("- **Total Duplicate Timestamps**: %d", "total_duplicates"),
        F.format_string("- **Total Rows with Null Values**: %d", "total_null_rows"),
        F.lit(""),
        F.lit("## Detailed Symbol Analysis"),
        F.lit(""),
        F.lit("| Symbol | Total Rows | Expected Rows | Gaps (Rows) | Gap % | Start Date (UTC) "
              "| End Date (UTC) | Duplicates | Nulls |"),
        F.lit("| :--- | :---: | :---: | :---: | :---: | :--- | :--- | :---: | :---: |"),
    ]
    header = totals.select(F.posexplode(F.array(*head)).alias("place", "line")).select(
        F.lit(0).alias("part"), F.col("place").cast("long").alias("place"),
        F.lit("").alias("symbol"), "line",
    )
    row = F.format_string(
        "| %s | %,d | %,d | %,d | %s%% | %s | %s | %d | %d |",
        "symbol", "row_count", "expected_rows", "missing_rows",
        F.col("gap_percentage").cast("string"), "start_date", "end_date",
        "duplicate_timestamps", "null_values_count",
    )
    body = gaps.select(
        F.lit(1).alias("part"), (-F.col("row_count")).alias("place"), "symbol", row.alias("line")
    )
    return header.unionByName(body).orderBy("part", "place", "symbol").select("line")
