"""Quality rules with risk-controlled thresholds.

Each rule is a number that is high for bad texts. Its cutoff is chosen on labelled texts, apart for
every stratum, so that the share of good texts it rejects is at most ``risk`` divided by the number
of rules: for a cutoff that rejects x of n good texts, the exact binomial probability of so few
rejections at that share must not exceed the error level. Cutoffs are tested from the loosest to
the strictest and stop at the first failure, so the tests of one rule need no correction; the level
is divided by the number of rules and strata. With probability 1 - ``error``, no stratum loses
more good texts than allowed. A stratum with too few labels has no cutoffs and rejects nothing.

Everything is expressions, aggregates and joins of the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlab.llm.shared import need, prepare
from barlab.session import materialize

RISK = 0.02
ERROR = 0.05
MIN_WORDS = 50
# More strata than this are joined without a broadcast (a stratum is some 100 bytes).
BROADCAST_STRATA = 10_000

_SPACE = "[\\x20\\x09-\\x0D]+"
METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate an expression once and use it several times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the text."""
    n = F.size(words)
    windows = F.transform(
        F.sequence(F.lit(1), n - 2),
        lambda i: F.xxhash64(
            F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)
        ),
    )

    def covered(starts: Column) -> Column:
        steps = F.transform(
            starts, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - p, F.lit(3)))
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def repeated(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(rows: Column) -> Column:
            own = F.transform(
                rows,
                lambda x, i: F.when(
                    F.coalesce(x.h == F.get(rows, i - 1).h, F.lit(False))
                    | F.coalesce(x.h == F.get(rows, i + 1).h, F.lit(False)),
                    x.i,
                ),
            )
            return F.sort_array(F.filter(own, lambda p: p.isNotNull()))

        found = let(let(placed, starts), covered)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(found)

    return F.when(n < 4, 0).otherwise(let(windows, repeated))


def text_metrics(text: Column) -> Column:
    """A struct of the counts named in METRICS; NULL and empty texts have none of anything.

    Equal windows are found by their 64-bit hashes.
    """
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, _SPACE), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
        )

    def of_lines(x: Column) -> Column:
        return F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        )

    w, x = let(words, of_words), let(lines, of_lines)
    symbols = (F.size(F.split(text, "[#*$%&|<>]")) - 1).cast("long")
    return let(
        F.struct(w.alias("w"), x.alias("x"), symbols.alias("s")),
        lambda m: F.struct(
            m.w.n_words.alias("n_words"),
            m.w.word_chars.alias("word_chars"),
            m.s.alias("n_symbols"),
            m.x.n_dup_lines.alias("n_dup_lines"),
            m.w.n_repeat_words.alias("n_repeat_words"),
            m.x.n_lines.alias("n_lines"),
        ),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.col(part) / F.nullif(F.col(whole), F.lit(0)), F.lit(0.0))


# Rule -> (its number, the grid of cutoffs: first, step and count).
RULES: dict[str, tuple[Callable[[], Column], tuple[float, float, int]]] = {
    "repeated_words": (lambda: _share("n_repeat_words", "n_words"), (0.02, 0.02, 25)),
    "repeated_lines": (lambda: _share("n_dup_lines", "n_lines"), (0.02, 0.02, 49)),
    "symbols": (lambda: _share("n_symbols", "word_chars"), (0.005, 0.005, 60)),
    "long_words": (lambda: _share("word_chars", "n_words"), (5.0, 0.25, 60)),
    "short_words": (lambda: -_share("word_chars", "n_words"), (-6.0, 0.25, 20)),
}


def binomial_tail(n: Column, x: Column, p: float) -> Column:
    """P(Bin(n, p) <= x), summed term by term in logarithms; 1 where x exceeds the mean."""
    odds = math.log(p) - math.log1p(-p)
    first = n * F.lit(math.log1p(-p))
    steps = F.when(x >= 1, F.sequence(F.lit(1).cast("long"), x)).otherwise(F.array().cast("array<bigint>"))
    total = F.aggregate(
        steps,
        F.struct(first.alias("term"), F.exp(first).alias("sum")),
        lambda acc, i: let(
            acc.term + F.log((n - i + 1) / i) + F.lit(odds),
            lambda term: F.struct(term.alias("term"), (acc.sum + F.exp(term)).alias("sum")),
        ),
        lambda acc: acc.sum,
    )
    return F.when(x > n * p, 1.0).otherwise(F.least(F.lit(1.0), total))


def thresholds(labelled: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """One row per stratum with a cutoff per rule (NULL: the rule rejects nothing there).

    ``labelled`` has a stratum, the metrics and ``good`` per labelled text.
    """
    allowed = risk / len(RULES)
    good = labelled.filter(F.col("good") & ~base_failed())
    levels = []
    for k, (value, (start, step, count)) in enumerate(RULES.values()):
        # Cutoff j is start + j * step; a text's level is how many cutoffs it exceeds.
        over = F.ceil((value() - F.lit(start)) / F.lit(step))
        levels.append(F.struct(F.lit(k).alias("rule"), F.least(F.greatest(over, F.lit(0)), F.lit(count)).alias("level")))
    rows = good.select("stratum", F.explode(F.array(*levels)).alias("r")).select("stratum", "r.rule", "r.level")
    counts = rows.groupBy("stratum", "rule", "level").agg(F.count(F.lit(1)).alias("k"))
    grids = F.array(*(F.lit(count) for _, (_, _, count) in RULES.values()))
    totals = counts.groupBy("stratum", "rule").agg(
        F.sum("k").alias("n"), F.collect_list(F.struct("level", "k")).alias("levels")
    )
    totals = totals.withColumn("tests", F.count(F.lit(1)).over(Window.partitionBy()))
    rejected = F.aggregate(
        "levels", F.lit(0).cast("long"), lambda s, v: s + F.when(v.level > F.col("j"), v.k).otherwise(0)
    )
    # At most as many levels as a grid has cutoffs, per stratum and rule.
    tested = (
        totals.withColumn("j", F.explode(F.sequence(F.lit(0), F.element_at(grids, F.col("rule") + 1) - 1)))
        .withColumn("x", rejected)
        .drop("levels")
        .withColumn("passed", binomial_tail(F.col("n"), F.col("x"), allowed) <= F.lit(error) / F.col("tests"))
    )
    looser = Window.partitionBy("stratum", "rule").orderBy(F.desc("j"))
    valid = tested.withColumn("passed", F.min("passed").over(looser)).filter("passed")
    chosen = valid.groupBy("stratum", "rule").agg(F.min("j").alias("j"))
    cutoffs = []
    for k, (name, (_, (start, step, _))) in enumerate(RULES.items()):
        cutoffs.append(
            F.max(F.when(F.col("rule") == k, F.col("j"))).alias(f"_j_{name}"),
        )
    return chosen.groupBy("stratum").agg(*cutoffs)


def rejected() -> Column:
    """Whether any rule's cutoff of the stratum is exceeded."""
    out = F.lit(False)
    for name, (value, (start, step, _)) in RULES.items():
        over = F.ceil((value() - F.lit(start)) / F.lit(step)) > F.col(f"_j_{name}")
        out = out | F.coalesce(over, F.lit(False))
    return out


def judged(rows: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Adds base_failed and kept to rows with metrics and a stratum."""
    few = cutoffs.count() <= BROADCAST_STRATA
    joined = rows.join(F.broadcast(cutoffs) if few else cutoffs, "stratum", "left")
    joined = joined.withColumn("base_failed", base_failed())
    return joined.withColumn("kept", ~F.col("base_failed") & ~rejected())


def _stratum(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def quality(
    docs: DataFrame,
    labels: DataFrame,
    risk: float = RISK,
    error: float = ERROR,
    id_column: str = "doc_id",
    text_column: str = "text",
    stratum_column: str = "lang",
) -> DataFrame:
    """doc_id, the counts of METRICS, base_failed and kept of every row.

    NULL and empty texts fail the base rules. Rows with a NULL stratum are one stratum. Labels that
    are NULL, or of no row, are ignored; a text with several labels is good only if all are. Other
    columns are ignored; without labels only the base rules reject.
    """
    need(docs, id_column, text_column, stratum_column)
    need(labels, "doc_id", "quality")
    prepare(docs.sparkSession)
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        _stratum(stratum_column).alias("stratum"),
        text_metrics(F.col(text_column)).alias("m"),
    )
    rows = materialize(rows.select("doc_id", "stratum", "m.*"), "metrics")
    return judged(rows, cutoffs_of(rows, labels, risk, error)).select("doc_id", *METRICS, "base_failed", "kept")


def cutoffs_of(rows: DataFrame, labels: DataFrame, risk: float, error: float) -> DataFrame:
    good = labels.groupBy("doc_id").agg((F.min("quality") == 1).alias("good")).filter("good IS NOT NULL")
    return materialize(thresholds(rows.join(good, "doc_id"), risk, error), "thresholds")


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    risk: float = RISK,
    error: float = ERROR,
    id_column: str = "doc_id",
    text_column: str = "text",
    stratum_column: str = "lang",
) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    need(docs, id_column, text_column, stratum_column)
    prepare(docs.sparkSession)
    metrics = docs.select(
        F.struct(*docs.columns).alias("_row"),
        F.col(id_column).cast("long").alias("doc_id"),
        _stratum(stratum_column).alias("stratum"),
        text_metrics(F.col(text_column)).alias("m"),
    ).select("_row", "doc_id", "stratum", "m.*")
    # The texts are measured in this pass and once more for the verdict, never shuffled.
    cutoffs = cutoffs_of(metrics.drop("_row"), labels, risk, error)
    return judged(metrics, cutoffs).filter("kept").select("_row.*")
