import datetime as dt

import pytest
from pyspark.sql import functions as F

from barlab.errors import DataValidationError
from barlab.functions.timestamps import epoch_ms, epoch_timestamp, to_us
from barlab.operators import clean, cube, profile
from barlab.schema import BAR_COLUMNS, RAW_BAR_SCHEMA
from barlab.sources import raw, sinks, tables
from barlab.sources.adapters import packed

T0 = 1704067200000


def write_raw(root, symbol, rows, month="2024-01"):
    folder = root / "spot" / "monthly" / "klines" / symbol / "1m"
    folder.mkdir(parents=True, exist_ok=True)
    lines = [",".join("" if v is None else str(v) for v in r) for r in rows]
    (folder / f"{symbol}-1m-{month}.csv").write_text("\n".join(lines) + "\n")


def bar(t, price, high=None, volume=10.0, trades=100, unit=1):
    return [t * unit, price, price + 5 if high is None else high, price - 5, price, volume,
            (t + 59_999) * unit + (999 if unit == 1000 else 0), 420000.0, trades, 5.0, 210000.0, 0]


@pytest.fixture(scope="module")
def raw_root(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    write_raw(root, "BTCUSDT", [bar(T0, 42000.0), bar(T0 + 60_000, 42010.0)])
    write_raw(root, "ETHUSDT", [bar(T0, 2200.0), bar(T0 + 60_000, 2215.0)])
    return root


def test_scan_and_canonical_bars(spark, raw_root):
    bars = raw.read_raw_bars(spark, str(raw_root))
    assert bars.columns == BAR_COLUMNS and bars.count() == 4
    types = dict(bars.dtypes)
    assert types["open_time"] == types["close_time"] == "timestamp"
    assert types["number_of_trades"] == "int" and types["volume"] == "double"
    first = bars.filter("symbol = 'BTCUSDT'").orderBy("open_time").first()
    assert first["open"] == 42000.0 and first["open_time"] == dt.datetime(2024, 1, 1)
    last = bars.filter("symbol = 'ETHUSDT'").orderBy(F.desc("open_time")).first()
    assert last["close"] == 2215.0


def test_scan_of_listed_symbols_and_of_a_tree(spark, raw_root):
    one = raw.scan_raw_csv(spark, str(raw_root), ["ETHUSDT", "NOSUCHUSDT"])
    assert {r["symbol"] for r in one.collect()} == {"ETHUSDT"}
    assert raw.scan_raw_tree(spark, str(raw_root)).count() == 4
    with pytest.raises(DataValidationError):
        raw.scan_raw_csv(spark, str(raw_root), ["NOSUCHUSDT"])
    assert one.schema.fields[:12] == RAW_BAR_SCHEMA.fields


def test_raw_round_trip(spark, raw_root):
    bars = raw.read_raw_bars(spark, str(raw_root))
    again = clean.canonical_bars(sinks.raw_rows(bars))
    assert again.exceptAll(bars).count() == 0


def test_mixed_epochs_never_spill_into_the_next_minute(spark):
    df = spark.createDataFrame([(1735689659999999,), (1735689659999,), (None,)], "c long")
    out = df.select(epoch_ms("c").alias("ms"), to_us(epoch_timestamp("c")).alias("us")).collect()
    assert [r["ms"] for r in out] == [1735689659999, 1735689659999, None]
    assert [r["us"] for r in out] == [1735689659999999, 1735689659999000, None]


def profiled(spark, rows, bar_ms=60_000):
    table = spark.createDataFrame(
        rows, "symbol string, t long, open double, high double, low double, close double, volume double"
    ).withColumn("open_time", F.timestamp_millis("t"))
    return table, profile.profile_gaps(profile.profile_symbols(table), bar_ms)


def ohlcv(s, t, *values):
    return (s, t, *(values or (1.0, 2.0, 0.5, 1.5, 10.0)))


def test_profile_counts(spark):
    minutes = [0, 1, 2, 3, 3, 5, 6, 9, 10, 10]
    rows = [ohlcv("DUPUSDT", T0 + m * 60_000) for m in minutes]
    rows += [ohlcv("NULUSDT", T0 + i * 60_000, *[None if j == i else 1.0 for j in range(5)]) for i in range(6)]
    rows += [ohlcv("NULUSDT", None), ohlcv("NULUSDT", None)]
    table, gaps = profiled(spark, rows)
    got = {r["symbol"]: r for r in gaps.collect()}
    dup = got["DUPUSDT"]
    assert (dup["row_count"], dup["duplicate_timestamps"], dup["expected_rows"], dup["missing_rows"]) == (10, 2, 11, 1)
    assert dup["gap_percentage"] == 9.0909
    assert (dup["start_date"], dup["end_date"]) == ("2024-01-01 00:00:00", "2024-01-01 00:10:00")
    nul = got["NULUSDT"]
    assert (nul["row_count"], nul["null_values_count"], nul["duplicate_timestamps"]) == (8, 5, 0)
    base = {r["symbol"]: r for r in profile.profile_base(table).collect()}
    assert base["NULUSDT"]["null_values_count"] == 5
    assert profile.duplicate_timestamps(table).collect() == [("DUPUSDT", 2)]
    totals = profile.profile_totals(gaps).first()
    assert tuple(totals) == (2, 18, 2, 5)


def test_missing_rows_are_negative_where_copies_outnumber_gaps(spark):
    _, gaps = profiled(spark, [ohlcv("AUSDT", T0)] * 3 + [ohlcv("AUSDT", T0 + 60_000)])
    assert gaps.first()["missing_rows"] == -2


def test_same_instant_in_both_units_is_a_duplicate(spark, tmp_path):
    write_raw(tmp_path, "MIXUSDT", [bar(T0, 5.0), bar(T0, 5.0, unit=1000)])
    bars = raw.read_raw_bars(spark, str(tmp_path))
    assert profile.profile_symbols(bars).first()["duplicate_timestamps"] == 1


def test_report(spark, raw_root, tmp_path):
    gaps = profile.profile_gaps(profile.profile_symbols(raw.read_raw_bars(spark, str(raw_root))))
    lines = [r["line"] for r in profile.profile_report(gaps, "Title", "About").collect()]
    assert lines[0] == "# Title" and "- **Total Unique Symbols**: 2" in lines
    assert "- **Total Rows (Observations)**: 4" in lines
    assert any(line.startswith("| BTCUSDT | 2 | 2 | 0 | 0.0% | 2024-01-01 00:00:00 |") for line in lines)
    sinks.write_text(profile.profile_report(gaps, "Title", "About"), str(tmp_path / "report"))
    assert spark.read.text(str(tmp_path / "report")).first()[0] == "# Title"


def test_universe_rule(spark):
    names = ["BTCUSDT", "USDCUSDT", "BTCUPUSDT", "ETHDOWNUSDT", "BTCBUSD", "JUPUSDT", "USD1USDT"]
    table = spark.createDataFrame([(n,) for n in names], "symbol string")
    kept = {r["symbol"] for r in clean.tradable_universe(table).collect()}
    assert kept == {"BTCUSDT", "USD1USDT"}
    kept = {r["symbol"] for r in clean.tradable_universe(table, suffixes=[], stablecoins=["USD1"]).collect()}
    assert kept == {"BTCUSDT", "USDCUSDT", "BTCUPUSDT", "ETHDOWNUSDT", "JUPUSDT"}


def test_dedup_keeps_one_bar_per_time_and_rows_without_key(spark, raw_root):
    bars = raw.read_raw_bars(spark, str(raw_root))
    copies = bars
    for _ in range(6):
        copies = copies.unionByName(copies)
    changed = bars.withColumn("open", F.col("open") - 1)
    keyless = bars.limit(2).withColumn("open_time", F.lit(None).cast("timestamp"))
    out = clean.dedup_bars(copies.unionByName(changed).unionByName(keyless))
    assert out.count() == 6
    assert out.filter("open_time IS NOT NULL").exceptAll(changed).count() == 0


def test_nan_prices_are_dropped(spark, raw_root):
    bars = raw.read_raw_bars(spark, str(raw_root))
    broken = bars.withColumn("close", F.when(F.col("symbol") == "BTCUSDT", float("nan")).otherwise(F.col("close")))
    assert clean.drop_nan_prices(broken).count() == 2


def test_tier_order(spark):
    table = spark.createDataFrame(
        [("A", True), ("B", True), ("C", False)], "symbol string, in_cohort boolean"
    )
    tiers = {r["symbol"]: r["tier"] for r in clean.with_tier(table, ["A"]).collect()}
    assert tiers == {"A": "listed", "B": "full history", "C": "other"}


def test_written_bars_are_ordered_and_prune(spark, raw_root, tmp_path):
    path = str(tmp_path / "bars")
    bars = raw.read_raw_bars(spark, str(raw_root))
    sinks.write_bars(bars, path, files=2)
    back = tables.load_bars(spark, path)
    assert sinks.verify_bars(back).first() == (4, 2)
    assert back.exceptAll(bars).count() == 0
    slim = clean.filter_symbol(tables.load_bars(spark, path, ["symbol", "close"]), "BTCUSDT")
    plan = slim._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(symbol,BTCUSDT)" in plan and "ReadSchema: struct<close:double,symbol:string>" in plan
    with pytest.raises(DataValidationError):
        tables.load_bars(spark, str(tmp_path / "nothing"))


def test_cache_computes_once(spark, tmp_path):
    calls = []

    def compute():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "cache")
    for _ in range(2):
        assert tables.read_or_compute(spark, path, compute).count() == 3
    assert len(calls) == 1
    # A half-written folder has no marker and is computed again.
    half = tmp_path / "half"
    half.mkdir()
    assert tables.read_or_compute(spark, str(half), compute).count() == 3 and len(calls) == 2


def test_object_store_scheme():
    assert tables.spark_path("s3://b/k") == "s3a://b/k" and tables.spark_path("/x") == "/x"


def test_cube_and_rollup(spark, raw_root):
    bars = raw.read_raw_bars(spark, str(raw_root)).withColumn("open", F.col("close") - 10)
    table = cube.eda_cube(bars)
    row = table.filter("symbol = 'BTCUSDT'").first()
    assert (row["month"], row["hour"], row["n"], row["up_n"]) == ("2024-01", 0, 2, 2)
    r = [42000.0 / 41990 - 1, 42010.0 / 42000 - 1]
    assert row["sum_r"] == pytest.approx(sum(r)) and row["sum_r2"] == pytest.approx(sum(x * x for x in r))
    rolled = cube.symbol_rollup(table).filter("symbol = 'BTCUSDT'").first()
    assert rolled["quote_vol_per_day"] == pytest.approx(840000 / (2 / 1440))
    assert rolled["std_r"] == pytest.approx(abs(r[0] - r[1]) / 2, rel=1e-3)
    diff = {(r["symbol"], r["side"]) for r in cube.topk_set_diff(cube.symbol_rollup(table), ["ETHUSDT", "X"], 2).collect()}
    assert diff == {("BTCUSDT", "ranked_only"), ("X", "configured_only")}


def test_a_bar_that_opens_at_zero_has_no_return(spark, raw_root):
    bars = raw.read_raw_bars(spark, str(raw_root)).filter("symbol = 'BTCUSDT'").withColumn("open", F.col("close") / 2)
    odd = bars.limit(1).withColumn("open", F.lit(0.0))
    rolled = cube.symbol_rollup(cube.eda_cube(bars.unionByName(odd))).first()
    assert (rolled["n"], rolled["n_r"], rolled["mean_r"], rolled["std_r"]) == (3, 2, 1.0, 0.0)
    rolled = cube.symbol_rollup(cube.eda_cube(odd)).first()
    assert (rolled["n"], rolled["n_r"], rolled["mean_r"], rolled["std_r"]) == (1, 0, None, None)


def test_packed_keys_are_exact_and_take_few_decimal_steps(spark):
    row = spark.createDataFrame([(9_999_999_999_999, 9, 999_999_999_999, 99_999_999_999), (0, 0, 0, 7)], "a long, b int, c long, d long")
    key = packed((F.col("a"), 13), (F.col("b"), 1), (F.col("c"), 12), (F.col("d"), 11))
    assert [int(r[0]) for r in row.select(key).collect()] == [10**37 - 1, 7]
    assert str(key).lower().count("decimal(38") == 3, str(key)  # longs of 14, 12 and 11 digits
    assert int(row.limit(1).select(packed((F.col("a") * 10**5, 18), (F.col("c"), 19))).first()[0]) == 9_999_999_999_999 * 10**24 + 999_999_999_999


def test_raw_write_makes_no_folder_per_symbol_on_the_driver(spark, tmp_path, monkeypatch):
    names = [f"S{i}USDT" for i in range(40)]
    frame = [(s, T0 + 60_000 * k, *[1.0] * 5, T0 + 60_000 * k + 59_999, 1.0, 1, 1.0, 1.0, 0.0) for s in names for k in range(3)]
    columns = "symbol string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_BAR_SCHEMA)
    made, plain = [], sinks._rename
    monkeypatch.setattr(sinks, "_rename", lambda files, a, b: (made.append(b.toString()), plain(files, a, b)))
    sinks.write_raw(spark.createDataFrame(frame, columns), str(tmp_path))
    assert sorted(p for p in made if p.endswith("/1m")) == sorted(f"{tmp_path}/spot/monthly/klines/{s}/1m" for s in names)
    assert {r["symbol"]: r["count"] for r in raw.read_raw_bars(spark, str(tmp_path)).groupBy("symbol").count().collect()} == {
        s: 3 for s in names
    }
    assert [p.split(":")[-1] for p in raw._folders(spark, str(tmp_path), None)] == [f"{tmp_path}/spot/monthly/klines/*/1m"]
    assert raw.read_raw_bars(spark, str(tmp_path), ["S7USDT", "NOUSDT"]).count() == 3
