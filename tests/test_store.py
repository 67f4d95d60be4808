"""Stored layouts: the cube kept up by months, bucketed tables, checks taken by the write."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barlab.errors import DataValidationError
from barlab.operators import features, rolling
from barlab.operators.cube import eda_cube
from barlab.sources import cube_store, sinks, tables
from tests.conftest import minute_bars


@pytest.fixture(scope="module")
def three_months(spark):
    """Bars of two symbols in three months, one of them without a time."""
    frames = [
        minute_bars(s, [10.0 + i % 7 for i in range(90)], start)
        for s in ("AAAUSDT", "BBBUSDT")
        for start in ("2024-01-31 23:00", "2024-03-05")
    ]
    bars = spark.createDataFrame(frames[0])
    for f in frames[1:]:
        bars = bars.unionByName(spark.createDataFrame(f))
    untimed = bars.limit(1).withColumn("open_time", F.lit(None).cast("timestamp"))
    return bars.withColumn("open_time", F.col("open_time").cast("timestamp")).unionByName(untimed)


def cells(cube):
    columns = sorted(cube.columns)
    return sorted(tuple(round(v, 9) if isinstance(v, float) else str(v) for v in r) for r in cube.select(columns).collect())


def in_month(month):
    return F.date_format("open_time", "yyyy-MM") == month


def test_a_refresh_reads_changed_months_only(spark, three_months, tmp_path):
    path, store = str(tmp_path / "bars"), str(tmp_path / "cube")
    march = F.coalesce(in_month("2024-03"), F.lit(False))
    sinks.write_monthly(three_months.filter(~march), path)
    first = cube_store.refresh_cube(spark, path, store)
    assert first.months == ["2024-01", "2024-02", "none"]
    assert cells(first.cube) == cells(eda_cube(three_months.filter(~march)))
    assert cube_store.refresh_cube(spark, path, store).files == []

    sinks.write_monthly(three_months.filter(march), path)
    second = cube_store.refresh_cube(spark, path, store)
    assert second.months == ["2024-03"] and second.files
    assert all("month=2024-03" in f for f in second.files)
    assert cells(second.cube) == cells(eda_cube(three_months))
    assert dict(second.cube.dtypes) == dict(eda_cube(three_months).dtypes)


def test_late_bars_add_to_their_month(spark, three_months, tmp_path):
    path, store = str(tmp_path / "bars"), str(tmp_path / "cube")
    late = F.coalesce(in_month("2024-02") & (F.col("symbol") == "BBBUSDT"), F.lit(False))
    sinks.write_monthly(three_months.filter(~late), path)
    cube_store.refresh_cube(spark, path, store)
    sinks.write_monthly(three_months.filter(late), path)
    after = cube_store.refresh_cube(spark, path, store)
    assert after.months == ["2024-02"] and {f.split("month=")[1][:7] for f in after.files} == {"2024-02"}
    assert cells(after.cube) == cells(eda_cube(three_months))


def test_files_of_several_months_rewritten_and_removed(spark, three_months, tmp_path):
    path, store = str(tmp_path / "bars"), str(tmp_path / "cube")
    three_months.repartition(3).write.parquet(path)
    cube_store.refresh_cube(spark, path, store)
    file = sorted(Path(path).glob("*.parquet"))[0]
    read = spark.read.parquet(str(file))
    lost = spark.createDataFrame(read.collect(), read.schema)
    file.unlink()
    after = cube_store.refresh_cube(spark, path, store)
    assert cells(after.cube) == cells(eda_cube(three_months.exceptAll(lost)))

    three_months.filter(in_month("2024-03")).write.mode("overwrite").parquet(path)
    after = cube_store.refresh_cube(spark, path, store)
    assert after.months == ["2024-01", "2024-02", "2024-03", "none"]
    assert {r.month for r in after.cube.select("month").distinct().collect()} == {"2024-03"}
    assert cells(after.cube) == cells(eda_cube(three_months.filter(in_month("2024-03"))))


def test_a_refresh_cut_short_is_done_again(spark, three_months, tmp_path):
    path, store = str(tmp_path / "bars"), str(tmp_path / "cube")
    sinks.write_monthly(three_months, path)
    cube_store.refresh_cube(spark, path, store)
    (tmp_path / "cube" / "manifest" / "00000000" / "_SUCCESS").unlink()
    again = cube_store.refresh_cube(spark, path, store)
    assert again.months == ["2024-01", "2024-02", "2024-03", "none"]
    assert cells(again.cube) == cells(eda_cube(three_months))


def test_a_cube_of_no_bars(spark, three_months, tmp_path):
    path, store = str(tmp_path / "bars"), str(tmp_path / "cube")
    with pytest.raises(DataValidationError):
        cube_store.refresh_cube(spark, path, store)
    three_months.limit(0).write.parquet(path)
    empty = cube_store.refresh_cube(spark, path, store)
    assert empty.months == [] and empty.cube.count() == 0
    assert cube_store.refresh_cube(spark, path, store).files == []


def test_windows_on_a_bucketed_table_need_no_exchange(spark, walk, tmp_path):
    frame, bars = walk
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    table = tables.save_bucketed(bars, "bucketed_walk", str(tmp_path / "b"), 4)
    try:
        out = features.feature_matrix(table, segment_rows=None)
        text = out._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in text and "Exchange" not in text
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = rolling.sma(table, segment_rows=None).join(table.groupBy("symbol").count(), "symbol")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        expected = features.feature_matrix(bars, segment_rows=None)
        assert sorted(map(str, out.collect())) == sorted(map(str, expected.select(*out.columns).collect()))
        shown = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED bucketed_walk").collect()}
        assert shown["Num Buckets"] == "4" and f"{len(frame)} rows" in shown["Statistics"]
        assert len(list((tmp_path / "b").glob("*.parquet"))) <= 4
        with pytest.raises(DataValidationError):
            tables.save_bucketed(bars, "bucketed_long", str(tmp_path / "c"), 4, max_symbol_rows=1000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE IF EXISTS bucketed_walk")


def test_the_write_counts_its_checks(spark, tmp_path):
    good = minute_bars("AAAUSDT", [10.0] * 50)
    bars = spark.createDataFrame(good)
    odd = bars.limit(6).withColumn("k", F.row_number().over(sinks_order()))
    nothing = F.lit(None)
    odd = odd.withColumns({
        "symbol": F.when(F.col("k") == 1, nothing).otherwise(F.col("symbol")),
        "open_time": F.when(F.col("k") == 2, nothing).otherwise(F.col("open_time")),
        "high": F.when(F.col("k") == 3, 1.0).when(F.col("k") == 4, nothing).otherwise(F.col("high")),
        "low": F.when(F.col("k") == 5, -1.0).when(F.col("k") == 4, float("nan")).otherwise(F.col("low")),
        "volume": F.when(F.col("k") == 6, -2.0).otherwise(F.col("volume")),
    }).drop("k")
    row = sinks.write_checked(bars.unionByName(odd), str(tmp_path / "a")).first().asDict()
    first = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert row == {
        "row_count": 56, "no_symbol": 1, "no_time": 1, "null_rows": 1, "low_high": 1, "bad_price": 1, "bad_volume": 1,
        "first_ms": first, "last_ms": first + 49 * 60_000,
    }
    assert spark.read.parquet(str(tmp_path / "a")).count() == 56
    with pytest.raises(DataValidationError):
        sinks.write_checked(bars.limit(0), str(tmp_path / "b"))


def sinks_order():
    from pyspark.sql import Window

    return Window.orderBy("open_time")


def test_checks_cost_no_further_job(spark, walk, tmp_path):
    tracker, jobs = spark.sparkContext.statusTracker(), {}
    for name, write in (("plain", sinks.write_bars), ("checked", sinks.write_checked)):
        spark.sparkContext.setJobGroup(name, name)
        write(walk[1], str(tmp_path / name))
        jobs[name] = len(tracker.getJobIdsForGroup(name))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs["plain"] == jobs["checked"]
