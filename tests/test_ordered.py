import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barlab.operators import cube, eda, ordered, splits
from barlab.operators.ordered import exact_quantiles, running_totals


def skewed(n=4000):
    """A third of all rows share one value; the rest spread over many scales."""
    rng = np.random.default_rng(5)
    spread = np.concatenate([rng.normal(0, 1, n // 3), rng.lognormal(0, 3, n - 2 * (n // 3))])
    return np.concatenate([np.full(n // 3, 0.25), spread])


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_running_totals_split_and_whole(spark, by, descending):
    x = skewed()
    frame = pd.DataFrame({"g": np.where(np.arange(len(x)) % 3 == 0, "a", None), "x": x})
    counts = spark.createDataFrame(frame).groupBy(*by, "x").agg(F.count("*").alias("n"))
    out = {}
    for split in (True, False):
        table = running_totals(counts, "x", ["n"], by, descending, split=split)
        out[split] = sorted(map(str, table.select(*by, "x", "n", "cum_n", "total_n").collect()))
    assert out[True] == out[False]
    got = running_totals(counts, "x", ["n"], by, descending, split=True).toPandas()
    keys = [k for k in by] or [lambda _: 0]
    for _, g in got.groupby(keys, dropna=False) if by else [(0, got)]:
        g = g.sort_values("x", ascending=not descending)
        assert (g["cum_n"].to_numpy() == g["n"].cumsum().to_numpy()).all()
        assert (g["total_n"] == g["n"].sum()).all()


@pytest.mark.parametrize("split", [True, False])
@pytest.mark.parametrize("few_groups", [True, False])
def test_quantiles_equal_numpy(spark, split, few_groups):
    x = skewed()
    p = [0.0, 0.01, 0.25, 1 / 3, 0.5, 0.85, 0.999, 1.0]
    frame = pd.DataFrame({"g": np.where(np.arange(len(x)) % 5 == 0, "few", "many"), "x": x})
    frame = pd.concat([frame, pd.DataFrame({"g": ["one", "none"], "x": [7.0, None]})])
    table = spark.createDataFrame(frame)
    got = exact_quantiles(table, "x", p, ["g"], few_groups, split)
    got = {r["g"]: r["quantiles"] for r in got.collect()}
    assert set(got) == {"few", "many", "one"}
    for g in got:
        values = frame.loc[frame.g == g, "x"].dropna()
        assert np.allclose(got[g], np.quantile(values, p), rtol=1e-12, atol=1e-12)
    whole = exact_quantiles(table, "x", p, split=split).first()[0]
    assert np.allclose(whole, np.quantile(frame["x"].dropna(), p), rtol=1e-12, atol=1e-12)


def test_brackets_of_large_groups(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([np.full(20_000, 3.0), rng.normal(0, 1, 30_011), rng.lognormal(0, 4, 9_000)])
    rng.shuffle(x)
    frame = pd.DataFrame({"g": np.where(np.arange(len(x)) % 2 == 0, "a", "b"), "x": x})
    table = spark.createDataFrame(frame).repartition(7)
    p = [i / 40 for i in range(41)] + [1 / 3, 2 / 3, 0.9999]
    for r in exact_quantiles(table, "x", p, ["g"], True, True).collect():
        want = np.quantile(frame.x[frame.g == r["g"]], p)
        assert np.allclose(r["quantiles"], want, rtol=1e-12, atol=1e-12)


def test_quantiles_of_a_constant_and_of_nothing(spark):
    table = spark.createDataFrame([(1.5,)] * 9, "x double")
    assert exact_quantiles(table, "x", [0.1, 0.5], split=True).first()[0] == [1.5, 1.5]
    assert exact_quantiles(table.filter("x > 2"), "x", [0.5], ["x"], split=True).count() == 0


def test_moments_match_pandas(spark):
    frame = pd.DataFrame({"x": skewed(900), "c": 2.0})
    out = eda.feature_stats(spark.createDataFrame(frame), ["x", "c"])
    got = {r["feature"]: r for r in out.collect()}
    x = frame["x"]
    assert got["x"]["mean"] == pytest.approx(x.mean())
    assert got["x"]["median"] == pytest.approx(x.median())
    assert got["x"]["std"] == pytest.approx(np.std(x))
    assert got["x"]["skewness"] == pytest.approx(x.skew(), rel=1e-9)
    assert got["x"]["kurtosis"] == pytest.approx(x.kurt(), rel=1e-9)
    assert got["c"]["std"] == 0 and got["c"]["skewness"] == 0


def test_outliers_and_boxes(spark):
    frame = pd.DataFrame({"x": skewed(900), "target": np.arange(900) % 2})
    table = spark.createDataFrame(frame)
    q25, q75 = np.quantile(frame.x, [0.25, 0.75])
    low, high = q25 - 1.5 * (q75 - q25), q75 + 1.5 * (q75 - q25)
    row = eda.iqr_outliers(table, ["x"]).first()
    assert row["outliers"] == ((frame.x < low) | (frame.x > high)).sum()
    assert row["outlier_pct"] == pytest.approx(row["outliers"] / 9)
    for r in eda.box_stats(table, ["x"], ["target"]).collect():
        want = np.quantile(frame.x[frame.target == r["target"]], [0, 0.25, 0.5, 0.75, 1])
        assert np.allclose(list(r[2:]), want)


@pytest.mark.parametrize("collect", [20_000, 100])
def test_wide_quantiles_equal_numpy(spark, monkeypatch, collect):
    """Ties, NULLs, an empty column and a NaN; with small brackets every quantile takes several scans."""
    monkeypatch.setattr(ordered, "COLLECT", collect)
    rng = np.random.default_rng(11)
    n = 30_000
    frame = pd.DataFrame(
        {
            "x": np.concatenate([np.full(n // 3, 3.0), rng.normal(0, 1, n // 3), rng.lognormal(0, 4, n // 3)]),
            "few": np.where(np.arange(n) % 1000 == 0, np.arange(n) * 1.0, np.nan),
            "whole": rng.integers(0, 5, n),
            "g": np.where(np.arange(n) % 10 == 0, "a", None),
        }
    ).sample(frac=1, random_state=3)
    table = spark.createDataFrame(frame).withColumn("few", F.nanvl("few", F.lit(None).cast("double")))
    table = table.withColumn("none", F.lit(None).cast("double")).repartition(6)
    p = [0.0, 0.001, 0.25, 1 / 3, 0.5, 2 / 3, 0.9, 0.9999, 1.0]
    wanted = {c: p for c in ("x", "few", "whole", "none")}
    for by in ([], ["g"]):
        found = ordered.wide_quantiles(table, wanted, by, [F.count(F.lit(1)).alias("rows")])
        assert found.scans <= (2 if collect == 20_000 else 6)
        for group, got in found.quantiles.items():
            own = frame if not by else frame[frame.g.isna() if group[0] is None else frame.g == group[0]]
            assert found.also[group]["rows"] == len(own)
            for c in ("x", "few", "whole"):
                if own[c].isna().all():
                    assert got[c] == [None] * len(p)
                    continue
                assert np.allclose(got[c], np.quantile(own[c].dropna(), p), rtol=1e-12, atol=1e-12), (c, group)
            assert got["none"] == [None] * len(p)


def test_a_missed_bracket_is_opened_again():
    b = ordered._Bracket("x", 0.5, 101, low=10.0, high=12.0, most=3)
    b.settle(90, 91, [11.0], 93)  # 90 of 101 values are below: the middle is not inside
    assert b.value is None and b.low is None and b.most == float("inf")
    b.narrow(0, [float(i) / 10 for i in range(1001)], 101)
    assert b.low < 50 < b.high


def test_quantiles_of_many_groups(spark, monkeypatch):
    monkeypatch.setattr(ordered, "MAX_GROUPS", 3)
    rows = [(i % 7, float(i * i % 97), float(i)) for i in range(200)]
    table = spark.createDataFrame(rows, "g long, x double, y double")
    got = ordered.grouped_quantiles(table, {"x": [0.5], "y": [0.25, 0.9]}, ["g"]).collect()
    frame = pd.DataFrame(rows, columns=["g", "x", "y"])
    for r in got:
        want = np.quantile(frame[r["feature"]][frame.g == r["g"]], [0.5] if r["feature"] == "x" else [0.25, 0.9])
        assert np.allclose(r["quantiles"], want)
    assert len(got) == 14


def test_correlation_with_a_constant_column(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame({"a": rng.normal(size=300), "c": 1.0})
    frame["b"] = frame.a * 2 + rng.normal(size=300)
    table = spark.createDataFrame(frame)
    got = {(r[0], r[1]): r[2] for r in eda.feature_correlation(table, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == pytest.approx(frame.a.corr(frame.b)) and got["a", "a"] == pytest.approx(1.0)
    assert got["a", "c"] is None
    by_target = {r[0]: r[1] for r in eda.target_correlation(table, ["a", "c"], "b").collect()}
    assert by_target["a"] == pytest.approx(frame.a.corr(frame.b)) and by_target["c"] is None


def test_histograms_hold_every_row(spark):
    frame = pd.DataFrame({"x": skewed(900), "g": True})
    table = spark.createDataFrame(frame)
    got = {r["bin"]: r["n"] for r in eda.feature_histogram(table, ["x"], 50).collect()}
    want, _ = np.histogram(frame.x, bins=50)
    assert [got.get(i, 0) for i in range(50)] == list(want)
    positive = table.filter("x > 0")
    got = eda.log_histogram(positive, "x", "g", 40).agg(F.sum("n")).first()[0]
    assert got == ((frame.x >= 1e-6) & (frame.x > 0)).sum()


def test_series_slice_cuts_before_the_shuffle(spark, walk):
    _, table = walk
    out = eda.series_slice(table, ["close"], 10)
    assert out.count() == 20
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [10, 20])
def test_boundaries_are_exact_order_statistics(spark, n):
    times = pd.date_range("2024-01-01", periods=n, freq="7h")
    table = spark.createDataFrame(pd.DataFrame({"open_time": times}))
    for cut in (table, table.repartition(3)):
        first, second = splits.boundary_values(cut)
        assert first == str(times[int(n * 0.7)]) and second == str(times[int(n * (0.7 + 0.15))])


def test_boundaries_weigh_rows_not_times(spark):
    times = pd.to_datetime(["2024-01-01"] * 7 + ["2024-01-02", "2024-01-03", "2024-01-04"])
    table = spark.createDataFrame(pd.DataFrame({"open_time": times}))
    assert splits.boundary_values(table)[0] == "2024-01-02 00:00:00"
    with pytest.raises(ValueError):
        splits.boundary_values(table.filter("open_time IS NULL"))


def test_purge_drops_minutes_after_each_boundary(spark):
    times = pd.date_range("2024-01-01", periods=200, freq="min")
    table = spark.createDataFrame(pd.DataFrame({"open_time": times, "target": np.arange(200) % 2}))
    ends = ("2024-01-01 01:00:00", "2024-01-01 02:00:00")
    got = splits.split_balance(splits.chrono_split(table, *ends, purge_minutes=15)).collect()
    assert {r["split"]: r["rows"] for r in got} == {"train": 60, "val": 45, "test": 65}
    train, val, test = splits.three_way(table, *ends)
    assert (train.count(), val.count(), test.count()) == (60, 60, 80)
    assert splits.three_way(table, "2024-01-01 00:30:00", "2025-01-01")[2].count() == 0


def test_group_medians(spark):
    rows = [(i % 3 == 0, float(i), float(-i), 0.5, i / 7) for i in range(50)]
    schema = "in_cohort boolean, quote_vol_per_day double, std_r double, up_share double, taker_ratio double"
    table = spark.createDataFrame(rows, schema)
    got = {r["in_cohort"]: r["median_quote_vol_per_day"] for r in cube.cohort_medians(table).collect()}
    assert got == {True: 24.0, False: 25.0}
