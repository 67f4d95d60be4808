import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from barlab.errors import DataValidationError
from barlab.models import baselines, pipeline, sequence, trees
from barlab.operators import metrics, splits
from barlab.sources import sinks

FEATURES = ["f1", "f2", "f3"]


@pytest.fixture(scope="module")
def parts(spark):
    rng = np.random.default_rng(4)
    frames = []
    for s in ("A", "B"):
        x = rng.normal(size=(300, 3))
        r = 0.5 * x[:, 0] - 0.2 * x[:, 1] + rng.normal(scale=0.3, size=300)
        frames.append(
            pd.DataFrame(x, columns=FEATURES).assign(
                symbol=s,
                open_time=pd.date_range("2024-01-01", periods=300, freq="min"),
                future_return=r,
                target=(r > 0).astype("int32"),
                volatility_30=np.abs(x[:, 2]),
            )
        )
    frame = pd.concat(frames, ignore_index=True)
    table = spark.createDataFrame(frame)
    return frame, splits.chrono_split(table, "2024-01-01 03:30:00", "2024-01-01 04:15:00", 0)


def named(table, name):
    return table.filter(F.col("split") == name)


def test_majority(spark, parts):
    _, table = parts
    train = named(table, "train")
    row = baselines.majority_label(train).first()
    assert row["majority_label"] == int(row["ones"] > row["zeros"])
    tied = spark.createDataFrame([(0,), (1,)], "target int")
    assert baselines.majority_label(tied).first()[0] == 0
    scored = baselines.predict_majority(tied, named(table, "val"))
    assert scored.select("y_pred", "y_prob").distinct().collect() == [(0, 0.0)]


def test_least_squares_equals_numpy(parts):
    frame, table = parts
    fitted = baselines.fit_return_model(named(table, "train"), FEATURES)
    mine = frame[frame.open_time < "2024-01-01 03:30:00"]
    design = np.column_stack([mine[FEATURES].to_numpy(), np.ones(len(mine))])
    want, *_ = np.linalg.lstsq(design, mine["future_return"].to_numpy(), rcond=None)
    got = [v for _, v in fitted.coefficients()]
    assert np.allclose(got, want, atol=1e-9)
    rest = mine["future_return"] - design @ want
    assert fitted.r2 == pytest.approx(1 - rest.var() / mine["future_return"].var())
    scored = fitted.predict_direction(named(table, "val")).select("predicted_return", "y_pred").collect()
    assert all(r["y_pred"] == int(r["predicted_return"] > 0) for r in scored)
    simple = baselines.simple_regression(named(table, "train"), "f1").first()
    slope, intercept = np.polyfit(mine["f1"], mine["future_return"], 1)
    assert simple["slope"] == pytest.approx(slope) and simple["intercept"] == pytest.approx(intercept)


def test_scaling_uses_training_statistics(parts):
    frame, table = parts
    out = pipeline.scaled_features(named(table, "train"), named(table, "val"), FEATURES).toPandas()
    train = frame[frame.open_time < "2024-01-01 03:30:00"]
    joined = out.merge(frame, on=["symbol", "open_time"], suffixes=("", "_raw"))
    want = (joined["f1_raw"] - train["f1"].mean()) / train["f1"].std(ddof=1)
    assert np.allclose(joined["f1"], want)


@pytest.mark.slow
def test_training_scoring_saving(spark, parts, tmp_path):
    _, table = parts
    train, val = named(table, "train"), named(table, "val")
    estimators = {
        pipeline.LOGISTIC: pipeline.logistic(reg_param=pipeline.regularization_from_c(0.1, 420)),
        pipeline.FOREST: pipeline.forest(trees=10, depth=4),
    }
    trained = pipeline.train_pipeline(train, val, FEATURES, estimators=estimators)
    rows = {r["model"]: r for r in trained.metrics.collect()}
    assert rows[pipeline.LOGISTIC]["roc_auc"] > 0.8 and rows[pipeline.FOREST]["accuracy"] > 0.6
    assert all(0.4 <= c <= 0.61 for c in trained.cutoffs.values())

    model = trained.models[pipeline.LOGISTIC]
    exact = pipeline.mllib_metrics(model, val)
    assert exact["area_under_roc"] == pytest.approx(rows[pipeline.LOGISTIC]["roc_auc"])
    assert exact["accuracy"] == pytest.approx(rows[pipeline.LOGISTIC]["accuracy"])

    path = str(tmp_path / "model")
    sinks.save_model(model, path)
    again = pipeline.score(sinks.load_model(path), val)
    assert again.exceptAll(pipeline.score(model, val)).count() == 0
    calls = []

    def fit():
        calls.append(1)
        return model

    for _ in range(2):
        sinks.load_or_train(spark, str(tmp_path / "cached"), fit)
    assert len(calls) == 1
    tuned = metrics.with_direction(again, trained.cutoffs[pipeline.LOGISTIC])
    assert tuned.count() == val.count()

    ranked = pipeline.feature_importance(trained, spark).collect()
    assert ranked[0]["feature"] == "f1"
    assert pipeline.top_coefficients(trained, spark, 2).first()["feature"] == "f1"
    gap = pipeline.overfit_check(trained, table.filter("split != 'test'")).collect()
    assert {(r["model"], r["split"]) for r in gap} == {
        (m, s) for m in estimators for s in ("train", "val")
    }


def test_empty_training_table_raises(parts):
    _, table = parts
    with pytest.raises(DataValidationError):
        pipeline.train_pipeline(table.filter("1 = 0"), table, FEATURES)
    with pytest.raises(DataValidationError):
        pipeline.train_pipeline(table.drop("f1"), table, FEATURES)


@pytest.mark.slow
def test_sequence_sweep(parts):
    _, table = parts
    configs = [{"name": "x", "seq_len": 5, "hidden": 4}, {"name": "y", "seq_len": 3, "hidden": 4}]
    results, winner = sequence.config_sweep(named(table, "train"), named(table, "val"), configs, FEATURES, max_iter=8)
    rows = results.collect()
    assert [r["config"] for r in rows] == ["x", "y"]
    assert winner.balanced_accuracy == max(r["balanced_accuracy"] for r in rows)
    assert winner.rows == max(rows, key=lambda r: (r["balanced_accuracy"], -rows.index(r)))["seq_len"]
    with pytest.raises(DataValidationError):
        sequence.fit_sequence_classifier(named(table, "train").limit(3), table, FEATURES, rows=5)


def test_sweep_says_which_windows_do_not_fit(parts):
    _, table = parts
    configs = [{"name": "long", "seq_len": 100_000, "hidden": 4}]
    results, winner = sequence.config_sweep(named(table, "train"), named(table, "val"), configs, FEATURES)
    assert winner is None
    assert [tuple(r) for r in results.collect()] == [("long", 100_000, 4, None, None, sequence.TOO_FEW)]


def test_weighted_metrics_equal_mllib(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator

    rng = np.random.default_rng(8)
    score = np.round(rng.random(400), 1)  # ties
    y = (rng.random(400) < score).astype(int)
    frame = pd.DataFrame({"y_true": y, "y_prob": score, "y_pred": (score >= 0.5).astype(int)})
    table = spark.createDataFrame(frame).withColumns(
        {"y": F.col("y_true").cast("double"), "p": F.col("y_pred").cast("double")}
    )
    got = metrics.weighted_metrics(table).first()
    names = {"accuracy": "accuracy", "weightedPrecision": "weighted_precision", "weightedRecall": "weighted_recall",
             "f1": "weighted_f1"}
    for name, own in names.items():
        e = MulticlassClassificationEvaluator(labelCol="y", predictionCol="p", metricName=name)
        assert got[own] == pytest.approx(e.evaluate(table), abs=1e-12)
    for name, own in {"areaUnderROC": "area_under_roc", "areaUnderPR": "area_under_pr"}.items():
        e = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="y_prob", metricName=name, numBins=0)
        assert got[own] == pytest.approx(e.evaluate(table), abs=1e-9)
    one = metrics.weighted_metrics(table.filter("y_true = 1")).first()
    assert one["area_under_roc"] == 0.5 and one["area_under_pr"] == 0.5 and one["weighted_recall"] == one["accuracy"]


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_a_saved_forest_is_a_table_of_nodes(spark, tmp_path, monkeypatch, limit):
    from pyspark.ml.feature import VectorAssembler

    monkeypatch.setattr(trees, "BROADCAST_NODES", limit)
    rng = np.random.default_rng(6)
    frame = pd.DataFrame(rng.normal(size=(300, 3)), columns=list("abc"))
    frame["target"] = (frame.a + frame.b**2 > 0.5).astype(float)
    frame["id"] = range(300)
    rows = VectorAssembler(inputCols=list("abc"), outputCol="features").transform(spark.createDataFrame(frame))
    model = pipeline.forest(trees=4, depth=3).fit(rows)
    model.write().overwrite().save(str(tmp_path / "forest"))
    nodes = trees.read_nodes(spark, str(tmp_path / "forest"))
    got = {r.id: r.y_prob for r in trees.forest_votes(rows, nodes, ["id"]).collect()}
    want = model.transform(rows).select("id", vector_to_array("probability")[1]).collect()
    assert len(got) == 300 and all(got[i] == pytest.approx(p, abs=1e-12) for i, p in want)
    gains = {r.feature: r.importance for r in trees.importance(nodes).collect()}
    given = model.featureImportances.toArray()
    assert all(gains.get(i, 0) == pytest.approx(v, abs=1e-9) for i, v in enumerate(given))
    with pytest.raises(DataValidationError):
        trees.forest_votes(rows, nodes.filter("tree < 0"), ["id"])


def test_models_score_in_a_session_that_has_counted_a_write(spark, parts, walk, tmp_path):
    sinks.write_checked(walk[1], str(tmp_path / "checked"))
    _, table = parts
    train, val = named(table, "train"), named(table, "val")
    chosen = {pipeline.LOGISTIC: pipeline.logistic(), pipeline.FOREST: pipeline.forest(trees=3, depth=3)}
    trained = pipeline.train_pipeline(train, val, FEATURES, estimators=chosen)
    for model in trained.models.values():
        assert pipeline.score(model, val).count() == val.count()
    fitted = pipeline.fit([*pipeline.scaling_stages(FEATURES), pipeline.logistic()], train)
    assert pipeline.mllib_metrics(fitted, val)["accuracy"] > 0.5
