import json
import pathlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barlab.operators import metrics
from barlab.schema import threshold_grid
from barlab.sources import sinks


def predictions(spark, y, pred, prob, **more):
    frame = pd.DataFrame({"y_true": y, "y_pred": pred, "y_prob": prob, **more})
    if "symbol" not in frame:
        frame["symbol"] = "A"
    return spark.createDataFrame(frame)


def brute(y, pred, prob):
    """Metrics from their definitions, pair by pair."""
    y, pred, prob = map(np.asarray, (y, pred, prob))
    pos, neg = prob[y == 1], prob[y == 0]
    out = {"accuracy": float(np.mean(y == pred))}
    if len(pos) and len(neg):
        gap = pos[:, None] - neg[None, :]
        out["roc_auc"] = float(np.mean((gap > 0) + 0.5 * (gap == 0)))
        out["pr_auc"] = float(np.mean([y[prob >= t].mean() for t in pos]))
        p = np.clip(prob, 1e-15, 1 - 1e-15)
        out["log_loss"] = float(np.mean(-(y * np.log(p) + (1 - y) * np.log(1 - p))))
    else:
        out |= {"roc_auc": 0.5, "pr_auc": 0.5, "log_loss": 0.0}
    return out


def test_confusion_and_rates(spark):
    y, pred = [1, 1, 1, 0, 0, 1, 0, 0, 0, 1], [1, 0, 1, 0, 1, 1, 0, 1, 0, 0]
    prob = [0.7, 0.3, 0.95, 0.15, 0.55, 0.65, 0.05, 0.75, 0.35, 0.45]
    row = metrics.evaluate(predictions(spark, y, pred, prob)).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (3, 2, 2, 3)
    assert row["precision"] == row["recall"] == row["f1"] == row["specificity"] == row["npv"] == 0.6
    table = predictions(spark, y, pred, prob)
    assert metrics.classification_metrics(table).first()["balanced_accuracy"] == 0.6


def test_rows_without_a_score_are_left_out_and_counted(spark):
    table = predictions(spark, [1, 0, 1, 0], [1, 0, 1, 1], [0.9, 0.2, None, float("nan")])
    whole = metrics.evaluate(table.limit(2)).first()
    assert metrics.evaluate(table.filter("y_prob IS NULL OR y_prob >= 0")).count() == 1
    row = metrics.evaluate(table).first()
    assert (row["count"], row["roc_auc"]) == (whole["count"], whole["roc_auc"]) == (2, 1.0)
    assert metrics.unscored(table).first()["unscored"] == 2


def test_undefined_rates_are_zero_and_one_class_is_neutral(spark):
    row = metrics.evaluate(predictions(spark, [0, 0], [0, 0], [0.2, 0.4])).first()
    assert row["precision"] == row["recall"] == row["f1"] == 0.0
    assert row["balanced_accuracy"] == 1.0
    assert (row["roc_auc"], row["pr_auc"], row["log_loss"]) == (0.5, 0.5, 0.0)


@pytest.mark.parametrize("split", [True, False])
def test_ranking_metrics_equal_brute_force(spark, split):
    rng = np.random.default_rng(11)
    n = 900
    # A third of the rows in one group, and scores rounded so that many tie.
    symbol = np.where(np.arange(n) % 3 == 0, "HOT", np.char.add("S", (np.arange(n) % 7).astype(str)))
    prob = np.round(rng.uniform(0, 1, n), 2)
    y = (rng.uniform(0, 1, n) < prob).astype(int)
    y[symbol == "S1"] = 1
    table = predictions(spark, y, (prob >= 0.5).astype(int), prob, symbol=symbol)
    for row in metrics.evaluate(table, ["symbol"], split).collect():
        mine = symbol == row["symbol"]
        for name, value in brute(y[mine], prob[mine] >= 0.5, prob[mine]).items():
            assert row[name] == pytest.approx(value, abs=1e-12), (row["symbol"], name)
        assert row["count"] == mine.sum()
    whole = metrics.evaluate(table, split=split).first()
    for name, value in brute(y, prob >= 0.5, prob).items():
        assert whole[name] == pytest.approx(value, abs=1e-12)


def test_scores_outside_the_unit_interval_rank(spark):
    y, score = [0, 1, 0, 1, 1], [-0.003, 0.002, 0.001, -0.001, 0.004]
    row = metrics.evaluate(predictions(spark, y, [0, 1, 1, 0, 1], score)).first()
    assert row["roc_auc"] == pytest.approx(brute(y, [0] * 5, score)["roc_auc"])


def test_regimes(spark):
    vol = [0.01, 0.02, 0.05, 0.06, 0.10, 0.12]
    table = predictions(
        spark, [0, 1, 1, 0, 1, 0], [0, 1, 1, 0, 0, 0], [0.1, 0.9, 0.8, 0.2, 0.4, 0.3], volatility_30=vol
    )
    for split in (True, False):
        rows = {r["regime"]: r for r in metrics.metrics_by_regime(table, split=split).collect()}
        assert {k: r["count"] for k, r in rows.items()} == {"Low": 2, "Medium": 2, "High": 2}
        edges = np.quantile(vol, [0, 1 / 3, 2 / 3, 1])
        assert rows["Low"]["min_val"] == edges[0] and rows["High"]["max_val"] == edges[3]
        assert rows["Medium"]["min_val"] == pytest.approx(edges[1])
    flat = table.withColumn("volatility_30", F.lit(1.0))
    assert [r["regime"] for r in metrics.metrics_by_regime(flat).collect()] == ["High"]
    assert {r["regime"] for r in metrics.metrics_by_regime(table, bins=2).collect()} == {"Bin_1", "Bin_2"}
    assert metrics.metrics_by_regime(table, bins=1).first()["count"] == 6


def test_per_symbol_and_best(spark):
    table = predictions(
        spark, [0, 1, 1, 0], [0, 1, 1, 1], [0.1, 0.9, 0.8, 0.7], symbol=["BTC", "BTC", "ETH", "ETH"]
    )
    per_symbol = metrics.metrics_by_symbol(table)
    rows = {r["symbol"]: r for r in per_symbol.collect()}
    assert rows["BTC"]["count"] == rows["ETH"]["count"] == 2 and rows["BTC"]["accuracy"] == 1.0
    best = metrics.best_and_worst(per_symbol).first()
    assert (best["best_symbol"], best["worst_symbol"]) == ("BTC", "ETH")


def test_median_split_and_symbol_table(spark):
    base = predictions(spark, [0, 1, 1, 0], [0, 1, 0, 1], [0.1, 0.9, 0.2, 0.7], volatility_30=[1.0, 2.0, 3.0, 4.0])
    table = base.withColumn("model", F.lit("m")).unionByName(
        base.withColumns({"model": F.lit("n"), "y_pred": F.col("y_true")})
    )
    got = {(r["model"], r["side"]): r["accuracy"] for r in metrics.accuracy_by_median(table, by=["model"]).collect()}
    assert got == {("m", "low"): 1.0, ("m", "high"): 0.0, ("n", "low"): 1.0, ("n", "high"): 1.0}
    assert tuple(metrics.accuracy_by_symbol(table, ["m", "n"]).first()) == ("A", 4, 0.5, 1.0)


def test_threshold_search_takes_the_first_best(spark):
    rng = np.random.default_rng(2)
    prob = np.round(rng.uniform(0.35, 0.65, 500), 3)
    y = (rng.uniform(0, 1, 500) < prob).astype(int)
    table = predictions(spark, y, (prob >= 0.5).astype(int), prob, model="m")
    best, score = 0.5, -1.0
    for cut in np.arange(0.40, 0.605, 0.005):
        up = prob >= cut
        balanced = (up[y == 1].mean() + (~up[y == 0]).mean()) / 2
        if balanced > score + 1e-15:
            best, score = float(cut), balanced
    got = metrics.threshold_search(table, ["model"])
    row = got.first()
    assert row["best_cutoff"] == best and row["best_balanced_accuracy"] == pytest.approx(score)
    assert len(threshold_grid()) == 41
    compared = {r["setting"]: r for r in metrics.threshold_compare(table, got).collect()}
    assert compared["tuned"]["balanced_accuracy"] == pytest.approx(score)
    assert compared["default"]["accuracy"] == pytest.approx(np.mean((prob >= 0.5) == y))
    assert compared["tuned"]["roc_auc"] == compared["default"]["roc_auc"]


def test_roc_points_end_at_one(spark):
    table = predictions(spark, [0, 1, 1, 0], [0, 1, 1, 1], [0.1, 0.9, 0.8, 0.8])
    points = metrics.roc_points(table).orderBy(F.desc("cutoff")).collect()
    assert [(p["fpr"], p["tpr"]) for p in points] == [(0.0, 0.5), (0.5, 1.0), (1.0, 1.0)]


def test_report_and_json(spark, tmp_path):
    n = 100
    table = predictions(
        spark, [0, 1] * 50, [0, 1] * 50, [0.2, 0.8] * 50,
        symbol=["A"] * 50 + ["B"] * 50, volatility_30=list(np.linspace(0.01, 0.2, n)),
    )
    report = metrics.evaluation_report(table, "rf")
    scopes = {r["scope"] for r in report.select("scope").distinct().collect()}
    assert scopes == {"overall", "per_symbol", "volatility_regimes"}
    accuracy = report.filter("scope = 'overall' AND metric = 'accuracy'").first()
    assert accuracy["value"] == 1.0 and accuracy["model"] == "rf"
    sinks.write_json(metrics.report_document(report), str(tmp_path / "report"))
    lines = [
        json.loads(line)
        for part in pathlib.Path(tmp_path / "report").glob("part-*")
        for line in part.read_text().splitlines()
    ]
    overall = next(d for d in lines if d["scope"] == "overall")
    assert overall["confusion_matrix"] == {"tn": 50, "fp": 0, "fn": 0, "tp": 50}
    assert isinstance(overall["metrics"]["accuracy"], float)


def test_report_equals_its_parts(spark):
    """One grouping of three scopes gives what three evaluations give; rows without a regime count elsewhere."""
    rng = np.random.default_rng(4)
    n = 300
    vol = np.where(rng.random(n) < 0.1, np.nan, rng.lognormal(0, 1, n))
    table = predictions(
        spark, rng.integers(0, 2, n), rng.integers(0, 2, n), np.round(rng.random(n), 2),
        symbol=[["A", "B", "C"][i % 3] for i in range(n)], volatility_30=list(vol),
    )
    table = table.withColumn("volatility_30", F.nanvl("volatility_30", F.lit(None).cast("double")))
    table = table.withColumn("symbol", F.when(F.col("symbol") != "C", F.col("symbol")))
    report = metrics.evaluation_report(table)
    got = {(r["scope"], r["group_name"], r["metric"]): r["value"] for r in report.collect()}
    names = ["count", *metrics.CONFUSION, *metrics.RATES, *metrics.RANKING]
    parts = {
        "overall": {"all": metrics.evaluate(table).first()},
        "per_symbol": {r["symbol"]: r for r in metrics.metrics_by_symbol(table).collect()},
        "volatility_regimes": {r["regime"]: r for r in metrics.metrics_by_regime(table).collect()},
    }
    want = {}
    for scope, groups in parts.items():
        more = ["min_val", "max_val"] if scope == "volatility_regimes" else []
        want |= {(scope, g, m): float(r[m]) for g, r in groups.items() for m in [*names, *more]}
    assert set(got) == set(want) and None in parts["per_symbol"]
    assert all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)
    final = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Expand" in final


def test_cutoffs_do_not_count_missing_scores(spark):
    """What ``evaluate`` leaves out is left out of every cutoff's counts too."""
    rows = [(1, 0.9), (0, 0.1), (1, None), (0, float("nan")), (None, 0.7)]
    table = spark.createDataFrame(rows, "y_true int, y_prob double")
    got = metrics.threshold_metrics(table, grid=[0.5]).first()
    assert (got["tn"], got["fp"], got["fn"], got["tp"]) == (1, 0, 0, 1)
    whole = metrics.evaluate(metrics.with_direction(table)).first()
    assert [whole[c] for c in metrics.CONFUSION] == [got[c] for c in metrics.CONFUSION]
