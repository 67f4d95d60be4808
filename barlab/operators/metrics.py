"""Classification metrics from prediction tables.

A prediction table has ``symbol``, ``open_time``, ``y_true`` (0/1), ``y_pred`` (0/1) and
``y_prob``. Everything is derived from counts per (group, score): one shuffle with map-side
combining, after which ranking metrics are exact running totals over distinct scores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.functions.checks import require_columns
from barlab.operators.ordered import running_totals, wide_quantiles
from barlab.schema import LOG_LOSS_CLIP, threshold_grid

CONFUSION = ["tn", "fp", "fn", "tp"]
RATES = [
    "accuracy", "precision", "recall", "f1", "balanced_accuracy", "specificity", "npv",
]
RANKING = ["roc_auc", "pr_auc", "log_loss"]


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def rate_columns() -> dict[str, Column]:
    """The seven rates from tn, fp, fn, tp; an undefined rate is 0.

    Balanced accuracy averages the recalls of the classes that occur.
    """
    tn, fp, fn, tp = (F.col(c) for c in CONFUSION)
    recall, specificity = _ratio(tp, tp + fn), _ratio(tn, tn + fp)
    classes = (tp + fn > 0).cast("int") + (tn + fp > 0).cast("int")
    return {
        "accuracy": _ratio(tp + tn, tn + fp + fn + tp),
        "precision": _ratio(tp, tp + fp),
        "recall": recall,
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        "balanced_accuracy": _ratio(recall + specificity, classes),
        "specificity": specificity,
        "npv": _ratio(tn, tn + fn),
    }


def _count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0)).cast("long")


def is_scored() -> Column:
    """A row that can be scored: truth and direction are 0 or 1, the score is a number."""
    score = F.col("y_prob").cast("double")
    right = F.col("y_true").isin(0, 1) & F.col("y_pred").isin(0, 1)
    return F.coalesce(right & score.isNotNull() & ~F.isnan(score), F.lit(False))


def unscored(predictions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per group, the rows that the metrics leave out because something of them is missing."""
    require_columns(predictions, ["y_true", "y_pred", "y_prob", *(by or [])], "prediction table")
    return predictions.groupBy(*(by or [])).agg(_count_if(~is_scored()).alias("unscored"))


def confusion(predictions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts of truth by direction; rows where either is missing are left out."""
    require_columns(predictions, ["y_true", "y_pred", *(by or [])], "prediction table")
    y, p = F.col("y_true"), F.col("y_pred")
    return predictions.groupBy(*(by or [])).agg(
        _count_if((y == 0) & (p == 0)).alias("tn"),
        _count_if((y == 0) & (p == 1)).alias("fp"),
        _count_if((y == 1) & (p == 0)).alias("fn"),
        _count_if((y == 1) & (p == 1)).alias("tp"),
    )


def classification_metrics(predictions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Confusion counts, row count and the seven rates (no ranking metrics)."""
    table = confusion(predictions, by)
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return table.withColumns({"count": total} | rate_columns())


def score_counts(predictions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Scored rows per (group, score) split by truth and by prediction; see ``unscored``."""
    by = list(by or [])
    require_columns(predictions, ["y_true", "y_pred", "y_prob", *by], "prediction table")
    y, p = F.col("y_true"), F.col("y_pred")
    scored = predictions.filter(is_scored())
    return scored.groupBy(*by, F.col("y_prob").cast("double").alias("y_prob")).agg(
        _count_if(y == 1).alias("n_pos"),
        _count_if(y == 0).alias("n_neg"),
        _count_if((y == 1) & (p == 1)).alias("n_tp"),
        _count_if((y == 0) & (p == 1)).alias("n_fp"),
    )


def metrics_from_scores(
    scores: DataFrame, by: list[str] | None = None, split: bool = True
) -> DataFrame:
    by = list(by or [])
    ranked = running_totals(scores, "y_prob", ["n_pos", "n_neg"], by, descending=True, split=split)
    pos, neg = F.col("n_pos").cast("double"), F.col("n_neg").cast("double")
    cum_pos, cum_neg = F.col("cum_n_pos").cast("double"), F.col("cum_n_neg").cast("double")
    p = F.least(F.greatest(F.col("y_prob"), F.lit(LOG_LOSS_CLIP)), F.lit(1 - LOG_LOSS_CLIP))
    # Zero counts must not meet the logarithm of a clipped zero.
    loss = -(
        F.when(pos > 0, pos * F.ln(p)).otherwise(0.0)
        + F.when(neg > 0, neg * F.ln(1.0 - p)).otherwise(0.0)
    )
    sums = ranked.groupBy(*by).agg(
        F.sum("n_pos").alias("_p"),
        F.sum("n_neg").alias("_n"),
        F.sum("n_tp").alias("tp"),
        F.sum("n_fp").alias("fp"),
        F.sum(neg * (cum_pos - pos / 2)).alias("_above"),
        F.sum(pos * cum_pos / (cum_pos + cum_neg)).alias("_ap"),
        F.sum(loss).alias("_loss"),
    )
    sums = sums.withColumns({"fn": F.col("_p") - F.col("tp"), "tn": F.col("_n") - F.col("fp")})
    both = (F.col("_p") > 0) & (F.col("_n") > 0)
    area = F.col("_above") / (F.col("_p").cast("double") * F.col("_n").cast("double"))
    return sums.select(
        *by,
        (F.col("_p") + F.col("_n")).alias("count"),
        *CONFUSION,
        *[c.alias(name) for name, c in rate_columns().items()],
        F.when(both, area).otherwise(0.5).alias("roc_auc"),
        F.when(both, F.col("_ap") / F.col("_p")).otherwise(0.5).alias("pr_auc"),
        F.when(both, F.col("_loss") / (F.col("_p") + F.col("_n"))).otherwise(0.0).alias("log_loss"),
    )


def evaluate(
    predictions: DataFrame, by: list[str] | None = None, split: bool = True
) -> DataFrame:
    """All metrics per group in one pass over the predictions."""
    return metrics_from_scores(score_counts(predictions, by), by, split)


def metrics_by_symbol(predictions: DataFrame, **split) -> DataFrame:
    return evaluate(predictions, ["symbol"], **split)


def best_and_worst(per_symbol: DataFrame) -> DataFrame:
    """Symbols with the highest and lowest F1; the first by name among equals."""
    return per_symbol.agg(
        F.min_by("symbol", F.struct(-F.col("f1"), F.col("symbol"))).alias("best_symbol"),
        F.max("f1").alias("best_f1"),
        F.min_by("symbol", F.struct(F.col("f1"), F.col("symbol"))).alias("worst_symbol"),
        F.min("f1").alias("worst_f1"),
    )


def regime_names(bins: int) -> list[str]:
    return ["Low", "Medium", "High"] if bins == 3 else [f"Bin_{i + 1}" for i in range(bins)]


def _regime_edges(predictions: DataFrame, column: str, bins: int) -> list[float | None]:
    """Edges of the quantile bins, from scans of the predictions; all None if no value is there."""
    return wide_quantiles(predictions, {column: [i / bins for i in range(bins + 1)]}).quantiles[()][column]


def _bin_of(column: str, edges: list[float | None]) -> Column:
    """Index of the bin [low, high), the last one closed; where edges coincide bins stay empty."""
    if edges[0] is None:
        return F.lit(None).cast("int")
    x, inner = F.col(column), edges[1:-1]
    place = sum((F.when(x >= F.lit(e), 1).otherwise(0) for e in inner), F.lit(0))
    return F.when((x >= F.lit(edges[0])) & (x <= F.lit(edges[-1])), place)


def _described(table: DataFrame, index: str, edges: list[float | None]) -> DataFrame:
    """Names and limits of the bins by their index."""
    names = regime_names(len(edges) - 1)
    of = lambda values, kind: F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col(index))
    return table.withColumns(
        {"regime": of(names, "string"), "min_val": of(edges[:-1], "double"), "max_val": of(edges[1:], "double")}
    )


def with_regime(predictions: DataFrame, column: str = "volatility_30", bins: int = 3) -> DataFrame:
    """Add the quantile bin of a column: [low, high), the last bin closed; pass a stored table."""
    edges = _regime_edges(predictions, column, bins)
    table = predictions.withColumn("_i", _bin_of(column, edges)).filter(F.col("_i").isNotNull())
    return _described(table, "_i", edges).drop("_i")


def metrics_by_regime(predictions: DataFrame, column: str = "volatility_30", bins: int = 3, **split) -> DataFrame:
    """Metrics per volatility bin, with its limits; empty bins do not appear. Pass a stored table."""
    edges = _regime_edges(predictions, column, bins)
    table = predictions.withColumn("_i", _bin_of(column, edges)).filter(F.col("_i").isNotNull())
    return _described(evaluate(table, ["_i"], **split), "_i", edges).drop("_i")


def accuracy_by_median(
    predictions: DataFrame, column: str = "volatility_30", by: list[str] | None = None
) -> DataFrame:
    """Accuracy at or below and above the median of a column; pass a stored table."""
    by = list(by or [])
    middle = wide_quantiles(predictions, {column: [0.5]}).quantiles[()][column][0]
    side = F.when(F.col(column) <= F.lit(middle).cast("double"), "low").otherwise("high")
    correct = (F.col("y_true") == F.col("y_pred")).cast("int")
    return (
        predictions.filter(F.col(column).isNotNull())
        .groupBy(*by, side.alias("side"))
        .agg(F.count(F.lit(1)).alias("count"), F.avg(correct).alias("accuracy"))
    )


def accuracy_by_symbol(predictions: DataFrame, models: list[str]) -> DataFrame:
    """One row per symbol, one accuracy column per model, best last model first."""
    correct = (F.col("y_true") == F.col("y_pred")).cast("int")
    one = F.col("model") == models[0]
    return (
        predictions.groupBy("symbol")
        .agg(
            _count_if(one).alias("rows"),
            *[F.avg(F.when(F.col("model") == m, correct)).alias(f"{m}_acc") for m in models],
        )
        .orderBy(F.desc(f"{models[-1]}_acc"), "symbol")
    )


def evaluation_report(
    predictions: DataFrame, model: str = "Model", column: str = "volatility_30", bins: int = 3, **split
) -> DataFrame:
    """Overall, per-symbol and per-regime metrics in long form; pass a stored table.

    After the regimes' edges, one scan counts the rows of all three scopes (grouping sets over score,
    symbol and score, regime and score), and one ranking serves all their groups.
    """
    require_columns(predictions, ["symbol", "y_true", "y_pred", "y_prob", column], "prediction table")
    edges = _regime_edges(predictions, column, bins)
    scored = predictions.filter(is_scored()).select(
        "symbol", "y_true", "y_pred", F.col("y_prob").cast("double").alias("y_prob"), _bin_of(column, edges).alias("_i")
    )
    sets = [["y_prob"], ["symbol", "y_prob"], ["_i", "y_prob"]]
    y, p = F.col("y_true"), F.col("y_pred")
    counts = scored.groupingSets(sets, "symbol", "_i", "y_prob").agg(
        F.grouping("symbol").alias("_all_symbols"),
        F.grouping("_i").alias("_all_bins"),
        _count_if(y == 1).alias("n_pos"),
        _count_if(y == 0).alias("n_neg"),
        _count_if((y == 1) & (p == 1)).alias("n_tp"),
        _count_if((y == 0) & (p == 1)).alias("n_fp"),
    )
    scope = (
        F.when(F.col("_all_symbols") == 0, "per_symbol")
        .when(F.col("_all_bins") == 0, "volatility_regimes")
        .otherwise("overall")
    )
    counts = counts.withColumn("scope", scope).drop("_all_symbols", "_all_bins")
    counts = counts.filter((F.col("scope") != "volatility_regimes") | F.col("_i").isNotNull())
    table = _described(metrics_from_scores(counts, ["scope", "symbol", "_i"], **split), "_i", edges)
    group = F.when(F.col("scope") == "overall", "all").when(F.col("scope") == "per_symbol", F.col("symbol"))
    cells = [
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"))
        for n in ["count", *CONFUSION, *RATES, *RANKING]
    ]
    limits = [F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in ("min_val", "max_val")]
    own = F.when(F.col("scope") == "volatility_regimes", F.array(*cells, *limits)).otherwise(F.array(*cells))
    return table.select(
        F.lit(model).alias("model"), "scope", F.coalesce(group, "regime").alias("group_name"), F.inline(own)
    )


def weighted_metrics(predictions: DataFrame, by: list[str] | None = None, split: bool = True) -> DataFrame:
    """The figures of MLlib's evaluators, per group, in closed form from counts per score.

    Precision, recall and F1 weighted by class; both curve areas by trapezoids, the precision-recall
    curve starting at the first point's precision.
    """
    by = list(by or [])
    scores = score_counts(predictions, by)
    ranked = running_totals(scores, "y_prob", ["n_pos", "n_neg"], by, descending=True, split=split)
    pos, neg, cum_pos, cum_neg = (F.col(c).cast("double") for c in ("n_pos", "n_neg", "cum_n_pos", "cum_n_neg"))
    here = cum_pos / (cum_pos + cum_neg)
    before = F.coalesce(F.try_divide(cum_pos - pos, cum_pos - pos + cum_neg - neg), here)
    sums = ranked.groupBy(*by).agg(
        F.sum("n_pos").alias("_p"),
        F.sum("n_neg").alias("_n"),
        F.sum("n_tp").alias("tp"),
        F.sum("n_fp").alias("fp"),
        F.sum(neg * (cum_pos - pos / 2)).alias("_roc"),
        F.sum(pos * (here + before) / 2).alias("_pr"),
    )
    p, n, tp, fp = (F.col(c).cast("double") for c in ("_p", "_n", "tp", "fp"))
    fn, tn, rows = p - tp, n - fp, p + n
    one = {"precision": _ratio(tp, tp + fp), "f1": _ratio(2 * tp, 2 * tp + fp + fn)}
    zero = {"precision": _ratio(tn, tn + fn), "f1": _ratio(2 * tn, 2 * tn + fp + fn)}
    accuracy = _ratio(tp + tn, rows)
    both = (F.col("_p") > 0) & (F.col("_n") > 0)
    return sums.select(
        *by,
        accuracy.alias("accuracy"),
        *[((p * one[m] + n * zero[m]) / rows).alias(f"weighted_{m}") for m in one],
        accuracy.alias("weighted_recall"),
        F.when(both, F.col("_roc") / (p * n)).otherwise(0.5).alias("area_under_roc"),
        F.when(both, F.col("_pr") / p).otherwise(0.5).alias("area_under_pr"),
    )


def report_document(report: DataFrame) -> DataFrame:
    """A long report as nested documents, one row per (model, scope), for a JSON sink."""
    per_group = report.groupBy("model", "scope", "group_name").agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("metrics")
    )
    return per_group.withColumn(
        "confusion_matrix",
        F.struct(*[F.col("metrics")[c].cast("long").alias(c) for c in CONFUSION]),
    )


def threshold_metrics(
    predictions: DataFrame, by: list[str] | None = None, grid: list[float] | None = None
) -> DataFrame:
    """Rates at every cutoff of a grid (predict 1 where the score is at or above it).

    Scores are reduced to how many cutoffs they reach, so a group carries at most
    len(grid) + 1 counts however many rows it has. Rows without a truth or a score are left out, as in
    all metrics; a group of such rows alone has counts of 0.
    """
    by = list(by or [])
    grid = threshold_grid() if grid is None else sorted(grid)
    cutoffs = F.array(*[F.lit(float(g)) for g in grid])
    reached = F.size(F.filter(cutoffs, lambda g: g <= F.col("y_prob")))
    y = F.col("y_true")
    score = F.col("y_prob").cast("double")
    known = F.coalesce(y.isin(0, 1) & score.isNotNull() & ~F.isnan(score), F.lit(False))
    # No filter: it could be pushed below what makes the rows, and so run a model on rows that it drops.
    counts = predictions.groupBy(*by, reached.alias("reached")).agg(
        _count_if(known & (y == 1)).alias("pos"), _count_if(known & (y == 0)).alias("neg")
    )
    packed = counts.groupBy(*by).agg(F.collect_list(F.struct("reached", "pos", "neg")).alias("c"))

    def total(part: str, least: Column) -> Column:
        kept = F.filter("c", lambda r: r["reached"] >= least)
        return F.aggregate(kept, F.lit(0).cast("long"), lambda a, r: a + r[part])

    rows = packed.select(*by, "c", F.posexplode(cutoffs).alias("i", "cutoff"))
    rows = rows.select(
        *by,
        "cutoff",
        total("pos", F.col("i") + 1).alias("tp"),
        total("neg", F.col("i") + 1).alias("fp"),
        total("pos", F.lit(0)).alias("_p"),
        total("neg", F.lit(0)).alias("_n"),
    )
    rows = rows.withColumns({"fn": F.col("_p") - F.col("tp"), "tn": F.col("_n") - F.col("fp")})
    return rows.select(
        *by, "cutoff", *CONFUSION, *[c.alias(n) for n, c in rate_columns().items()]
    )


def threshold_search(
    predictions: DataFrame, by: list[str] | None = None, grid: list[float] | None = None
) -> DataFrame:
    """The lowest cutoff with the highest balanced accuracy."""
    by = list(by or [])
    table = threshold_metrics(predictions, by, grid)
    rank = F.struct(F.col("balanced_accuracy"), -F.col("cutoff"))
    return table.groupBy(*by).agg(
        F.max_by("cutoff", rank).alias("best_cutoff"),
        F.max("balanced_accuracy").alias("best_balanced_accuracy"),
    )


def threshold_compare(
    predictions: DataFrame, tuned: DataFrame, by: str = "model", default: float = 0.5, **split
) -> DataFrame:
    """Metrics of each model at the default and at its tuned cutoff (``by``, ``best_cutoff``).

    The cutoffs are applied to counts per score, not to prediction rows.
    """
    scores = score_counts(predictions, [by]).join(tuned.select(by, "best_cutoff"), by)
    settings = F.array(
        F.struct(F.lit("default").alias("setting"), F.lit(float(default)).alias("cutoff")),
        F.struct(F.lit("tuned").alias("setting"), F.col("best_cutoff").alias("cutoff")),
    )
    both = scores.select(by, "y_prob", "n_pos", "n_neg", F.inline(settings))
    up = F.col("y_prob") >= F.col("cutoff")
    both = both.withColumns(
        {
            "n_tp": F.when(up, F.col("n_pos")).otherwise(0),
            "n_fp": F.when(up, F.col("n_neg")).otherwise(0),
        }
    )
    return metrics_from_scores(both, [by, "setting", "cutoff"], **split)


def model_ladder(predictions: DataFrame, **split) -> DataFrame:
    """One row of metrics per model."""
    return evaluate(predictions, ["model"], **split)


def roc_points(
    predictions: DataFrame, by: list[str] | None = None, split: bool = True
) -> DataFrame:
    """False and true positive rate at every distinct score."""
    by = list(by or [])
    scores = score_counts(predictions, by).select(*by, "y_prob", "n_pos", "n_neg")
    ranked = running_totals(scores, "y_prob", ["n_pos", "n_neg"], by, descending=True, split=split)
    return ranked.select(
        *by,
        F.col("y_prob").alias("cutoff"),
        F.try_divide(F.col("cum_n_neg"), F.col("total_n_neg")).alias("fpr"),
        F.try_divide(F.col("cum_n_pos"), F.col("total_n_pos")).alias("tpr"),
    )


def with_direction(
    scored: DataFrame, threshold: float | Column = 0.5, prob: str = "y_prob"
) -> DataFrame:
    """Predict 1 where the score is at or above the threshold."""
    limit = F.lit(float(threshold)) if isinstance(threshold, (int, float)) else threshold
    return scored.withColumn("y_pred", (F.col(prob) >= limit).cast("int"))

