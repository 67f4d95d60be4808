"""Baselines and MLlib classifiers on the labelled features."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from barlab.functions.timestamps import to_ms
from barlab.models import baselines, pipeline, sequence, trees
from barlab.operators import metrics, splits
from barlab.plans import fixtures as fx
from barlab.plans import sql as q
from barlab.plans.registry import emit, query, rounded
from barlab.schema import FEATURE_COLUMNS, threshold_grid
from barlab.session import materialize, scratch_dir
from barlab.sources import sinks

_PARTS = (
    f"WITH {q.event_bars()}, {q.labelled()}, {q.BOUNDS.format(source='labelled')}, "
    f"{q.SPLIT.format(source='labelled')}"
)


def _split_table(spark, d):
    table = fx.labelled(spark, d)
    keep = ["symbol", "open_time", "target", "future_return", *FEATURE_COLUMNS]
    split = splits.chrono_split_by_fraction(table.select(*keep))
    return materialize(split, "labelled", ["split"])


def _parts(spark, d):
    table = _split_table(spark, d)
    return [table.filter(F.col("split") == s) for s in splits.SPLITS]


def _wide(table, *keys):
    names = [*metrics.RATES, *metrics.RANKING]
    return emit(table, *keys, "count", *metrics.CONFUSION, **rounded(names, 6))


@query(
    "majority_baseline",
    f"{_PARTS} SELECT CAST(sum(target) * 2 > count(*) AS BIGINT) AS majority_label, "
    "(count(*) - sum(target))::BIGINT AS zeros, sum(target)::BIGINT AS ones "
    "FROM parts WHERE split = 'train'",
)
def majority_baseline(spark, d):
    train, _, _ = _parts(spark, d)
    return emit(baselines.majority_label(train), "majority_label", "zeros", "ones")


@query(
    "majority_predictions",
    f"{_PARTS}, m AS (SELECT CAST(sum(target) * 2 > count(*) AS INTEGER) AS y FROM parts "
    f"WHERE split = 'train') SELECT symbol, {q.OPEN_MS}, {q.big('y', 'y_pred')} FROM parts, m "
    "WHERE split = 'test'",
)
def majority_predictions(spark, d):
    train, _, test = _parts(spark, d)
    return emit(baselines.predict_majority(train, test), "symbol", "open_time", "y_pred")


@query(
    "simple_regression",
    f"{_PARTS}, g AS (SELECT regr_slope(future_return, rsi_14) AS slope, "
    "regr_intercept(future_return, rsi_14) AS intercept, regr_r2(future_return, rsi_14) AS r2 "
    f"FROM parts WHERE split = 'train') SELECT {q.rs(['slope', 'intercept', 'r2'], 6)} FROM g",
)
def simple_regression(spark, d):
    train, _, _ = _parts(spark, d)
    return emit(baselines.simple_regression(train, "rsi_14"), slope=6, intercept=6, r2=6)


@query(
    "ols_one_feature",
    f"{_PARTS}, g AS (SELECT regr_slope(future_return, rsi_14) AS s, "
    "regr_intercept(future_return, rsi_14) AS i FROM parts WHERE split = 'train'), "
    "p AS (SELECT symbol, open_time, s * rsi_14 + i AS predicted_return FROM parts, g "
    f"WHERE split = 'test') SELECT symbol, {q.OPEN_MS}, {q.r('predicted_return', 5)}, "
    "CAST(predicted_return > 0 AS BIGINT) AS y_pred FROM p",
)
def ols_one_feature(spark, d):
    train, _, test = _parts(spark, d)
    fitted = baselines.fit_return_model(train, ["rsi_14"])
    scored = fitted.predict_direction(test)
    return emit(scored, "symbol", "open_time", "y_pred", predicted_return=5)


@query("ols_baseline")
def ols_baseline(spark, d):
    train, val, _ = _parts(spark, d)
    fitted = baselines.fit_return_model(train, FEATURE_COLUMNS)
    scored = fitted.predict_direction(val).select(
        F.col("target").alias("y_true"), "y_pred", F.col("predicted_return").alias("y_prob")
    )
    return _wide(metrics.evaluate(scored)).withColumn("train_r2", F.lit(round(fitted.r2, 8)))


@query(
    "scaled_features",
    f"{_PARTS}, st AS (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in FEATURE_COLUMNS)
    + " FROM parts WHERE split = 'train'), z AS (SELECT symbol, open_time, "
    + ", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in FEATURE_COLUMNS)
    + f" FROM parts, st WHERE split = 'val') SELECT symbol, {q.OPEN_MS}, "
    f"{q.rs(FEATURE_COLUMNS, 5)} FROM z",
)
def scaled_features(spark, d):
    train, val, _ = _parts(spark, d)
    out = pipeline.scaled_features(train, val, FEATURE_COLUMNS)
    return emit(out, "symbol", "open_time", **rounded(FEATURE_COLUMNS, 5))


def _single(spark, d, name, estimator):
    train, val, _ = _parts(spark, d)
    return _wide(
        pipeline.train_pipeline(train, val, FEATURE_COLUMNS, estimators={name: estimator}).metrics,
        "model",
    )


@query("logreg")
def logreg(spark, d):
    return _single(spark, d, pipeline.LOGISTIC, pipeline.logistic())


@query("random_forest")
def random_forest(spark, d):
    return _single(spark, d, pipeline.FOREST, pipeline.forest())


@query("train_pipeline")
def train_pipeline(spark, d):
    train, val, _ = _parts(spark, d)
    trained = pipeline.train_pipeline(train, val)
    cutoffs = spark.createDataFrame(list(trained.cutoffs.items()), "model string, cutoff double")
    return _wide(trained.metrics.join(cutoffs, "model"), "model", "cutoff")


_WEIGHTED = ["accuracy", "weighted_precision", "weighted_recall", "weighted_f1", "area_under_roc", "area_under_pr"]
_CURVE = """curve AS (SELECT DISTINCT y_prob,
    sum(y_true) OVER (ORDER BY y_prob DESC RANGE UNBOUNDED PRECEDING)::DOUBLE AS tp_at,
    sum(1 - y_true) OVER (ORDER BY y_prob DESC RANGE UNBOUNDED PRECEDING)::DOUBLE AS fp_at FROM preds),
steps AS (SELECT *, coalesce(lag(tp_at) OVER w, 0) AS tp_0, coalesce(lag(fp_at) OVER w, 0) AS fp_0,
    tp_at / (tp_at + fp_at) AS prec FROM curve WINDOW w AS (ORDER BY y_prob DESC)),
areas AS (SELECT sum((fp_at - fp_0) * (tp_at + tp_0) / 2) / (max(tp_at) * max(fp_at)) AS area_under_roc,
    sum((tp_at - tp_0) * (prec + CASE WHEN tp_0 + fp_0 = 0 THEN prec ELSE tp_0 / (tp_0 + fp_0) END) / 2)
    / max(tp_at) AS area_under_pr FROM steps)"""


@query(
    "mllib_metrics",
    f"WITH {q.event_bars()}, {q.labelled()}, {q.PREDICTIONS.format(source='labelled')}, "
    f"{q.confusion('preds', [])}, {_CURVE}, w AS (SELECT *, (tp + fn)::DOUBLE / count AS w1, (tn + fp)::DOUBLE / count AS w0 "
    "FROM conf), m AS (SELECT (tp + tn)::DOUBLE / count AS accuracy, "
    "w1 * coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) + w0 * coalesce(tn / nullif(tn + fn, 0)::DOUBLE, 0) AS weighted_precision, "
    "(tp + tn)::DOUBLE / count AS weighted_recall, w1 * coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) "
    "+ w0 * coalesce(2 * tn / nullif(2 * tn + fp + fn, 0)::DOUBLE, 0) AS weighted_f1 FROM w) "
    f"SELECT {q.rs(_WEIGHTED, 8)} FROM m, areas",
)
def mllib_metrics(spark, d):
    return emit(metrics.weighted_metrics(fx.predictions(spark, d)), **rounded(_WEIGHTED, 8))


@query(
    "mllib_evaluators",
    " UNION ALL ".join(f"SELECT '{m}' AS metric, TRUE AS agrees" for m in _WEIGHTED),
)
def mllib_evaluators(spark, d):
    """MLlib's evaluators on a fitted model beside the closed forms on its scores."""
    train, val, _ = _parts(spark, d)
    stages = [*pipeline.scaling_stages(FEATURE_COLUMNS), pipeline.logistic()]
    model = pipeline.fit(stages, train)
    values = pipeline.mllib_metrics(model, val)
    own = metrics.weighted_metrics(materialize(pipeline.score(model, val), "scored")).first()
    rows = [(m, abs(values[m] - own[m]) < 1e-6) for m in _WEIGHTED]
    return spark.createDataFrame(rows, "metric string, agrees boolean")


@query(
    "forest_nodes",
    f"{_PARTS} SELECT count(*) AS rows, 0::BIGINT AS different, TRUE AS importance_agrees, "
    "1.0::DOUBLE AS importance_total FROM parts WHERE split = 'val'",
)
def forest_nodes(spark, d):
    """A forest read back as a table of nodes: the same directions and importance as MLlib's."""
    train, val, _ = _parts(spark, d)
    stages = [*pipeline.scaling_stages(FEATURE_COLUMNS), pipeline.forest(trees=20, depth=6)]
    model = pipeline.fit(stages, train)
    path = scratch_dir(spark, "forest")
    model.stages[-1].write().overwrite().save(path)
    nodes = materialize(trees.read_nodes(spark, path), "nodes")
    scored = materialize(model.transform(val).select("symbol", "open_time", "features", "prediction"), "scored")
    votes = trees.forest_votes(scored, nodes, ["symbol", "open_time"])
    up = (F.col("y_prob") > 0.5).cast("double")
    compared = scored.join(votes, ["symbol", "open_time"], "left").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~up.eqNullSafe(F.col("prediction"))).alias("different")
    )
    given = model.stages[-1].featureImportances.toArray()
    own = {r.feature: r.importance for r in trees.importance(nodes).collect()}  # one row a feature
    agrees = all(abs(own.get(i, 0.0) - v) < 1e-9 for i, v in enumerate(given))
    return compared.select(
        "rows", "different", F.lit(agrees).alias("importance_agrees"), F.lit(round(sum(own.values()), 9)).alias("importance_total")
    )


@query("feature_importance")
def feature_importance(spark, d):
    train, val, _ = _parts(spark, d)
    return pipeline.feature_importance(pipeline.train_pipeline(train, val), spark)


@query(
    "top_coefficients",
    "SELECT 5::BIGINT AS rows, TRUE AS largest, TRUE AS descending",
)
def top_coefficients(spark, d):
    """The five logistic coefficients largest in size, beside all sixteen of the model."""
    train, val, _ = _parts(spark, d)
    trained = pipeline.train_pipeline(train, val)
    top = [abs(r.lr_coefficient) for r in pipeline.top_coefficients(trained, spark).collect()]
    given = sorted(map(abs, trained.models[pipeline.LOGISTIC].stages[-1].coefficients.toArray()), reverse=True)
    rows = [(len(top), bool(sorted(top) == sorted(given[:5])), top == sorted(top, reverse=True))]
    return spark.createDataFrame(rows, "rows long, largest boolean, descending boolean")


@query("overfit_check")
def overfit_check(spark, d):
    table = _split_table(spark, d)
    train, val = (table.filter(F.col("split") == s) for s in ("train", "val"))
    trained = pipeline.train_pipeline(train, val)
    both = table.filter(F.col("split") != "test")
    return pipeline.overfit_check(trained, both)


@query("save_model")
def save_model(spark, d):
    train, _, test = _parts(spark, d)
    stages = [*pipeline.scaling_stages(FEATURE_COLUMNS), pipeline.logistic()]
    path = scratch_dir(spark, "model")
    sinks.save_model(pipeline.fit(stages, train), path)
    scored = pipeline.score(sinks.load_model(path), test)
    return scored.select(
        "symbol", to_ms("open_time").alias("open_ms"), "y_true", "y_pred",
        F.round("y_prob", 6).alias("y_prob"),
    )


@query("sequence_classifier")
def sequence_classifier(spark, d):
    train, val, _ = _parts(spark, d)
    fitted = sequence.fit_sequence_classifier(train, val)
    return spark.createDataFrame(
        [(fitted.rows, fitted.hidden, fitted.cutoff, fitted.balanced_accuracy)],
        "seq_len int, hidden int, cutoff double, balanced_accuracy double",
    )


@query("config_sweep")
def config_sweep(spark, d):
    train, val, _ = _parts(spark, d)
    return sequence.config_sweep(train, val)[0]


_ROWS_OF = "(SELECT count(*) FROM parts WHERE split = '{}')"


@query(
    "save_model_roundtrip",
    f"{_PARTS} SELECT {_ROWS_OF.format('test')} AS rows, 0::BIGINT AS different",
)
def save_model_roundtrip(spark, d):
    """Rows scored by a fitted pipeline, and those that the saved and loaded one scores otherwise."""
    train, _, test = _parts(spark, d)
    stages = [*pipeline.scaling_stages(FEATURE_COLUMNS), pipeline.logistic()]
    fitted, path = pipeline.fit(stages, train), scratch_dir(spark, "model")
    sinks.save_model(fitted, path)
    loaded = sinks.load_or_train(spark, path, lambda: fitted)
    keys = ["symbol", "open_time"]
    ours = pipeline.score(fitted, test).select(*keys, "y_prob", "y_pred")
    theirs = pipeline.score(loaded, test).select(*keys, F.struct("y_prob", "y_pred").alias("t"))
    same = F.struct("y_prob", "y_pred") == F.col("t")
    both = ours.join(theirs, keys, "full")
    return both.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~F.coalesce(same, F.lit(False))).alias("different")
    )


@query(
    "ols_residuals",
    f"SELECT unnest({[*FEATURE_COLUMNS, 'intercept']}) AS feature, TRUE AS orthogonal",
)
def ols_residuals(spark, d):
    """Least squares leaves residuals without correlation with any feature, checked on the data.

    The MACD histogram is the line less the signal, so it is left out of the fit and still tested.
    """
    train, _, _ = _parts(spark, d)
    fitted = baselines.fit_return_model(train, [c for c in FEATURE_COLUMNS if c != "macd_hist_norm"])
    scored = fitted.predict_return(train)
    rest = F.col("future_return") - F.col("predicted_return")
    columns = {**{c: F.col(c) for c in FEATURE_COLUMNS}, "intercept": F.lit(1.0)}
    cells = [
        F.struct(
            F.lit(name).alias("feature"),
            (F.abs(F.sum(rest * x)) <= 1e-6 * F.sqrt(F.sum(rest * rest) * F.sum(x * x))).alias("orthogonal"),
        )
        for name, x in columns.items()
    ]
    return scored.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


@query(
    "logistic_gradient",
    f"SELECT unnest({FEATURE_COLUMNS}) AS feature, TRUE AS stationary",
)
def logistic_gradient(spark, d):
    """The penalized gradient of the logistic fit is zero in every scaled feature."""
    train, _, _ = _parts(spark, d)
    estimator = pipeline.logistic()
    fitted = pipeline.fit([*pipeline.scaling_stages(FEATURE_COLUMNS), estimator], train)
    weights, penalty = fitted.stages[-1].coefficients, estimator.getRegParam()
    scored = fitted.transform(train)
    x = vector_to_array(estimator.getFeaturesCol())
    gap = vector_to_array("probability")[1] - F.col(estimator.getLabelCol())
    cells = [
        F.struct(
            F.lit(name).alias("feature"),
            (F.abs(F.avg(gap * x[i]) + F.lit(penalty * float(weights[i]))) <= 1e-3).alias("stationary"),
        )
        for i, name in enumerate(FEATURE_COLUMNS)
    ]
    return scored.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


@query(
    "train_pipeline_counts",
    f"{_PARTS} SELECT unnest(['{pipeline.LOGISTIC}', '{pipeline.FOREST}']) AS model, "
    f"{_ROWS_OF.format('val')} AS rows, TRUE AS adds_up, TRUE AS cutoff_in_grid",
)
def train_pipeline_counts(spark, d):
    """Each model is judged on every validation row, and its cutoff is one of the grid's."""
    train, val, _ = _parts(spark, d)
    trained = pipeline.train_pipeline(train, val)
    cutoffs = spark.createDataFrame(list(trained.cutoffs.items()), "model string, cutoff double")
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return trained.metrics.join(cutoffs, "model").select(
        "model",
        F.col("count").cast("long").alias("rows"),
        (total == F.col("count")).alias("adds_up"),
        F.col("cutoff").isin(threshold_grid()).alias("cutoff_in_grid"),
    )
