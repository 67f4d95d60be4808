import pytest

import __spark_entry__ as entry_points
from barlab.operators import cube, features, metrics, profile, rolling
from barlab.operators.ordered import running_totals
from barlab.plans import fixtures as fx
from barlab.schema import DAY_MS

D = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_take_one_shuffle_and_no_python(spark):
    text = plan(features.feature_matrix(fx.read_bars_table(spark, D), segment_rows=None))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Sort [") == 2
    assert "Python" not in text


def test_segments_shuffle_the_bars_once(spark):
    bars = fx.read_bars_table(spark, D)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with large tables
    try:
        text = plan(features.feature_matrix(bars, segment_rows=5000, bar_ms=DAY_MS))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # One shuffle carries bars; the others carry a row per bucket, and the segments are broadcast.
    exchanges = [x for x in text.splitlines() if "Exchange hashpartitioning" in x]
    assert sum("_segment" in x for x in exchanges) == 1 and "Exchange rangepartitioning" not in text
    assert text.count("BroadcastExchange") == 2
    assert "Python" not in text


def test_rolling_values_read_only_their_columns(spark):
    bars = fx.read_bars_table(spark, D)
    text = plan(rolling.sma(bars, tie_break=[]).select("symbol", "open_time", "sma_15"))
    assert "ReadSchema: struct<open_time:timestamp,close:double,symbol:string>" in text


def test_symbol_filter_reaches_the_scan_through_windows(spark):
    out = features.feature_matrix(fx.read_bars_table(spark, D), bar_ms=DAY_MS)
    assert "EqualTo(symbol,S1USDT)" in plan(out.filter("symbol = 'S1USDT'"))


def test_bars_are_hash_aggregated(spark):
    for name in ("bars_from_lineitem", "bars_from_events"):
        text = plan(entry_points.queries()[name](spark, D))
        assert "SortAggregate" not in text and "HashAggregate" in text, name


def test_planning_a_window_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    bars = fx.read_bars_table(spark, D)
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        features.feature_matrix(bars, bar_ms=DAY_MS)
        metrics.evaluate(metrics.with_direction(bars.selectExpr("1 AS y_true", "close AS y_prob")))
        assert not tracker.getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_profile_and_cube_scan_once(spark):
    bars = fx.read_bars_table(spark, D)
    text = plan(profile.profile_symbols(bars))
    assert text.count("FileScan") == 1 and "Join" not in text
    text = plan(cube.eda_cube(bars))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_split_totals_share_the_grouping_shuffle(spark):
    bars = fx.read_bars_table(spark, D)
    counts = bars.groupBy("close").count()
    out = running_totals(counts, "close", ["count"], split=True)
    out.collect()
    assert "ReusedExchange" in plan(out)


def test_metrics_group_before_they_rank(spark):
    table = spark.createDataFrame(
        [("A", 1, 1, 0.5)], "symbol string, y_true int, y_pred int, y_prob double"
    )
    text = plan(metrics.evaluate(table, ["symbol"]))
    assert "partial_sum" in text and "Python" not in text


def test_no_query_uses_python_workers(spark):
    for name in ("feature_matrix", "eda_cube", "metrics_by_symbol", "sequence_windows", "ema"):
        assert "Python" not in plan(entry_points.queries()[name](spark, D)), name


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.slow
@pytest.mark.parametrize(
    "name",
    ["bars_from_lineitem", "dedup_bars", "profile_report", "eda_cube", "tier_summary", "macd",
     "labelled_features", "chrono_split", "metrics_by_regime", "threshold_search", "feature_stats"],
)
def test_oracles_on_the_smallest_tables(spark, name):
    import duckdb

    import check

    db = duckdb.connect()
    for t in check.TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    df = entry_points.queries()[name](spark, D)
    result = db.execute(entry_points.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    rows = [tuple(r) for r in df.collect()]
    assert rows and not check.compare(rows, df.columns, result.fetchall(), columns)
