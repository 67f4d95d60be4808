"""Classification metrics of three fixed scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlab.functions.timestamps import to_ms
from barlab.operators import metrics, sequences
from barlab.plans import fixtures as fx
from barlab.plans import sql as q
from barlab.plans.registry import emit, query, rounded
from barlab.schema import threshold_grid
from barlab.session import scratch_dir
from barlab.sources import sinks

BASE = f"WITH {q.event_bars()}, {q.labelled()}, {q.PREDICTIONS.format(source='labelled')}"
ALL = [*metrics.RATES, *metrics.RANKING]
COUNTS = ["count", *metrics.CONFUSION]


def _emit(table, *keys, **more):
    return emit(table, *keys, *COUNTS, **rounded(ALL, 8), **more)


@query(
    "confusion",
    f"{BASE}, {q.confusion('preds', [])} SELECT {q.bigs(['tn', 'fp', 'fn', 'tp'])} FROM conf",
)
def confusion(spark, d):
    return emit(metrics.confusion(fx.predictions(spark, d)), *metrics.CONFUSION)


@query(
    "classification_metrics",
    f"{BASE}, {q.confusion('preds', [])}, m AS (SELECT *, {q.rates()} FROM conf) "
    f"SELECT {q.COUNT_OUT}, {q.rs(q.RATE_NAMES, 8)} FROM m",
)
def classification_metrics(spark, d):
    table = metrics.classification_metrics(fx.predictions(spark, d))
    return emit(table, *COUNTS, **rounded(metrics.RATES, 8))


for _name in metrics.RANKING:

    def _one(spark, d, name=_name):
        return emit(metrics.evaluate(fx.predictions(spark, d)), **{name: 8})

    query(_name, f"{BASE}, {q.evaluation('preds', [])} SELECT {q.r(_name, 8)} FROM evaluated")(_one)


@query(
    "metrics_by_symbol",
    f"{BASE}, {q.evaluation('preds', ['symbol'])} SELECT symbol, {q.METRIC_OUT} FROM evaluated",
)
def metrics_by_symbol(spark, d):
    return _emit(metrics.metrics_by_symbol(fx.predictions(spark, d)), "symbol")


@query(
    "best_and_worst_symbol",
    f"{BASE}, {q.evaluation('preds', ['symbol'])} SELECT "
    "first(symbol ORDER BY f1 DESC, symbol) AS best_symbol, "
    "first(symbol ORDER BY f1, symbol) AS worst_symbol, "
    f"{q.r('max(f1)', 8, 'best_f1')}, {q.r('min(f1)', 8, 'worst_f1')} FROM evaluated",
)
def best_and_worst_symbol(spark, d):
    table = metrics.best_and_worst(metrics.metrics_by_symbol(fx.predictions(spark, d)))
    return emit(table, "best_symbol", "worst_symbol", best_f1=8, worst_f1=8)


_GAPPED = "gapped AS (SELECT * FROM preds WHERE hour(open_time) % 6 > 1)"


@query(
    "evaluate_missing_scores",
    f"{BASE}, {_GAPPED}, {q.evaluation('gapped', [])} SELECT {q.METRIC_OUT}, "
    "(SELECT count(*) FROM preds WHERE hour(open_time) % 6 <= 1) AS unscored FROM evaluated",
)
def evaluate_missing_scores(spark, d):
    """A third of the rows has no score, a NaN or no truth; they are counted, not scored."""
    table = fx.predictions(spark, d)
    hour = F.hour("open_time") % 6
    up = F.col("y_true") == 1
    score = F.when((hour == 1) & up, F.lit(float("nan"))).when(hour > 0, F.col("y_prob"))
    truth = F.when((hour != 1) | up, F.col("y_true"))
    table = table.withColumns({"y_prob": score, "y_true": truth})
    both = metrics.evaluate(table).join(metrics.unscored(table))
    return emit(both, *COUNTS, "unscored", **rounded(ALL, 8))


_BINS = ["regime", "min_val", "max_val"]


@query(
    "metrics_by_regime",
    f"{BASE}, {q.REGIMES}, {q.evaluation('binned', _BINS)} SELECT regime, {q.METRIC_OUT}, "
    f"{q.rs(['min_val', 'max_val'], 7)} FROM evaluated",
)
def metrics_by_regime(spark, d):
    table = metrics.metrics_by_regime(fx.predictions(spark, d))
    return _emit(table, "regime", min_val=7, max_val=7)


@query(
    "accuracy_by_median_vol",
    f"{BASE}, m AS (SELECT median(volatility_30) AS m FROM every_model), s AS (SELECT model, "
    "CASE WHEN volatility_30 <= m THEN 'low' ELSE 'high' END AS side, "
    "(y_true = y_pred)::INTEGER AS ok FROM every_model, m) SELECT model, side, "
    f"{q.big('count(*)', 'count')}, {q.r('avg(ok)', 8, 'accuracy')} FROM s GROUP BY model, side",
)
def accuracy_by_median_vol(spark, d):
    table = metrics.accuracy_by_median(fx.every_model(spark, d), by=["model"])
    return emit(table, "model", "side", "count", accuracy=8)


_MODELS = ["rsi", "band", "flow"]


@query(
    "accuracy_by_symbol",
    f"{BASE} SELECT symbol, count(*) FILTER (WHERE model = 'rsi') AS rows, "
    + ", ".join(
        q.r(f"avg((y_true = y_pred)::INTEGER) FILTER (WHERE model = '{m}')", 8, f"{m}_acc")
        for m in _MODELS
    )
    + " FROM every_model GROUP BY symbol",
)
def accuracy_by_symbol(spark, d):
    table = metrics.accuracy_by_symbol(fx.every_model(spark, d), _MODELS)
    return emit(table, "symbol", "rows", **rounded([f"{m}_acc" for m in _MODELS], 8))


def _long_sql(keys: str, group: str, scope: str, extra: tuple[str, ...] = ()) -> str:
    return " UNION ALL ".join(
        f"SELECT '{scope}' AS scope, {group} AS group_name, '{m}' AS metric, "
        f'{q.r(chr(34) + m + chr(34) + "::DOUBLE", 7, "value")} FROM {keys}'
        for m in [*COUNTS, *ALL, *extra]
    )


def _nested(source: str, by: list[str], with_ctes: str = "") -> str:
    """An evaluation as a subquery, so that several can stand side by side."""
    return f"(WITH {with_ctes}{q.evaluation(source, by)} SELECT * FROM evaluated)"


@query(
    "evaluation_report",
    f"{BASE}, o AS {_nested('preds', [])}, s AS {_nested('preds', ['symbol'])}, "
    f"v AS {_nested('binned', _BINS, q.REGIMES + ', ')} "
    + _long_sql("o", "'all'", "overall")
    + " UNION ALL "
    + _long_sql("s", "symbol", "per_symbol")
    + " UNION ALL "
    + _long_sql("v", "regime", "volatility_regimes", ("min_val", "max_val")),
)
def evaluation_report(spark, d):
    table = metrics.evaluation_report(fx.predictions(spark, d))
    return emit(table, "scope", "group_name", "metric", value=7)


@query(
    "metrics_json",
    f"{BASE}, {q.evaluation('preds', ['symbol'])} SELECT symbol AS group_name, "
    f"{q.bigs(['tn', 'fp', 'fn', 'tp'])}, {q.r('accuracy', 7)} FROM evaluated",
)
def metrics_json(spark, d):
    report = metrics.evaluation_report(fx.predictions(spark, d))
    path = scratch_dir(spark, "metrics")
    sinks.write_json(metrics.report_document(report), path)
    schema = (
        "model string, scope string, group_name string, metrics map<string, double>, "
        "confusion_matrix struct<tn: bigint, fp: bigint, fn: bigint, tp: bigint>"
    )
    back = spark.read.schema(schema).json(path).filter("scope = 'per_symbol'")
    flat = back.select("group_name", "confusion_matrix.*", F.col("metrics")["accuracy"].alias("accuracy"))
    return emit(flat, "group_name", "tn", "fp", "fn", "tp", accuracy=7)


_GRID = ", ".join(f"{g!r}::DOUBLE" for g in threshold_grid())
_THRESHOLDS = f"""grid AS (SELECT unnest([{_GRID}]) AS cutoff),
cut AS (SELECT model, cutoff, y_true, CAST(y_prob >= cutoff AS INTEGER) AS y_pred
  FROM every_model, grid),
{q.confusion('cut', ['model', 'cutoff'])},
tm AS (SELECT *, {q.rates()} FROM conf)"""


@query(
    "threshold_metrics",
    f"{BASE}, {_THRESHOLDS} SELECT model, {q.r('cutoff', 6)}, {q.bigs(['tn', 'fp', 'fn', 'tp'])}, "
    f"{q.rs(q.RATE_NAMES, 8)} FROM tm",
)
def threshold_metrics(spark, d):
    table = metrics.threshold_metrics(fx.every_model(spark, d), ["model"])
    return emit(table, "model", *metrics.CONFUSION, cutoff=6, **rounded(metrics.RATES, 8))


_BEST = "best AS (SELECT model, first(cutoff ORDER BY balanced_accuracy DESC, cutoff) AS best_cutoff, max(balanced_accuracy) AS best_balanced_accuracy FROM tm GROUP BY model)"  # noqa: E501


@query(
    "threshold_search",
    f"{BASE}, {_THRESHOLDS}, {_BEST} SELECT model, {q.r('best_cutoff', 6)}, "
    f"{q.r('best_balanced_accuracy', 8)} FROM best",
)
def threshold_search(spark, d):
    table = metrics.threshold_search(fx.every_model(spark, d), ["model"])
    return emit(table, "model", best_cutoff=6, best_balanced_accuracy=8)


@query(
    "threshold_missing_scores",
    f"{BASE}, gaps AS (SELECT * FROM every_model WHERE hour(open_time) % 6 > 1), "
    f"{_THRESHOLDS.replace('FROM every_model, grid', 'FROM gaps, grid')}, {_BEST} "
    f"SELECT model, {q.r('best_cutoff', 6)}, {q.r('best_balanced_accuracy', 8)} FROM best",
)
def threshold_missing_scores(spark, d):
    """A third of the rows has no score, a NaN or no truth: no cutoff counts them."""
    hour = F.hour("open_time") % 6
    up = F.col("y_true") == 1
    score = F.when((hour == 1) & up, F.lit(float("nan"))).when(hour > 0, F.col("y_prob"))
    truth = F.when((hour != 1) | up, F.col("y_true"))
    table = fx.every_model(spark, d).withColumns({"y_prob": score, "y_true": truth})
    return emit(metrics.threshold_search(table, ["model"]), "model", best_cutoff=6, best_balanced_accuracy=8)


_SETTINGS = """settings AS (SELECT model, 'default' AS setting, 0.5::DOUBLE AS cutoff FROM best
  UNION ALL SELECT model, 'tuned', best_cutoff FROM best),
compared AS (SELECT m.model, setting, cutoff, y_true, y_prob,
    CAST(y_prob >= cutoff AS INTEGER) AS y_pred FROM every_model m JOIN settings USING (model))"""
_SETTING_KEYS = ["model", "setting", "cutoff"]


@query(
    "threshold_compare",
    f"{BASE}, tuned_grid AS (WITH {_THRESHOLDS} SELECT * FROM tm), "
    f"{_BEST.replace('FROM tm', 'FROM tuned_grid')}, {_SETTINGS}, "
    f"{q.evaluation('compared', _SETTING_KEYS)} "
    f"SELECT model, setting, {q.r('cutoff', 6)}, {q.METRIC_OUT} FROM evaluated",
)
def threshold_compare(spark, d):
    preds = fx.every_model(spark, d)
    table = metrics.threshold_compare(preds, metrics.threshold_search(preds, ["model"]))
    return _emit(table, "model", "setting", cutoff=6)


@query(
    "model_ladder",
    f"{BASE}, {q.evaluation('every_model', ['model'])} SELECT model, {q.METRIC_OUT} FROM evaluated",
)
def model_ladder(spark, d):
    return _emit(metrics.model_ladder(fx.every_model(spark, d)), "model")


@query(
    "roc_points",
    f"{BASE}, w AS (SELECT DISTINCT model, y_prob, "
    "sum(y_true) OVER (PARTITION BY model ORDER BY y_prob DESC RANGE UNBOUNDED PRECEDING)::DOUBLE "
    "/ sum(y_true) OVER (PARTITION BY model) AS tpr, "
    "sum(1 - y_true) OVER (PARTITION BY model ORDER BY y_prob DESC RANGE UNBOUNDED PRECEDING)"
    "::DOUBLE / sum(1 - y_true) OVER (PARTITION BY model) AS fpr FROM every_model) "
    f"SELECT model, {q.r('y_prob', 4, 'cutoff')}, {q.rs(['fpr', 'tpr'], 8)} FROM w",
)
def roc_points(spark, d):
    return emit(
        metrics.roc_points(fx.every_model(spark, d), ["model"]), "model", cutoff=4, fpr=8, tpr=8
    )


@query(
    "aligned_predictions",
    f"{BASE}, e AS (SELECT symbol, open_time, row_number() OVER ({q.W}) AS i FROM labelled) "
    f"SELECT p.symbol, epoch_ms(p.open_time) AS open_ms, {q.big('y_true')}, {q.big('y_pred')}, "
    f"{q.r('y_prob', 4)} FROM preds p SEMI JOIN (SELECT * FROM e WHERE i >= 60) e "
    "ON p.symbol = e.symbol AND p.open_time = e.open_time",
)
def aligned_predictions(spark, d):
    table = fx.predictions(spark, d)
    out = sequences.aligned_predictions(table, table, 60, bar_ms=fx.HOUR_MS)
    return emit(out, "symbol", "open_time", "y_true", "y_pred", y_prob=4)


@query(
    "score_direction",
    f"{BASE} SELECT symbol, {q.OPEN_MS}, {q.r('y_prob', 4)}, "
    "CAST(y_prob >= 0.475 AS BIGINT) AS y_pred FROM preds",
)
def score_direction(spark, d):
    table = metrics.with_direction(fx.predictions(spark, d).drop("y_pred"), 0.475)
    return table.select(
        "symbol", to_ms("open_time").alias("open_ms"), "y_prob", F.col("y_pred").cast("long")
    )
