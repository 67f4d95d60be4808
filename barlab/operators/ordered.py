"""Running totals and exact quantiles over columns of any size."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlab.errors import DataValidationError

# A range is found in three steps of this many at least.
_FAN = 8
# The sketch behind the ranges and the brackets is off by at most 1 / accuracy of the ranks.
SKETCH_ACCURACY = 10_000
# Half-width of a quantile's bracket, several times what the sketch may be off.
_MARGIN = 5.0 / SKETCH_ACCURACY
# In a group this small a bracket of that width may hold less than a row on either side of its
# quantile, so all of the group's rows count as inside.
_WHOLE_GROUP = 20_000


def fan(df: DataFrame) -> int:
    """Steps in which a range is found: their cube, the ranges, is four for each shuffle task."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(_FAN, math.ceil((4 * tasks) ** (1 / 3)))


def _edges(order: str, fan: int) -> tuple[Column, Column]:
    """The sketch of the cut points, and the same as all of them, every n-th and every n²-th."""
    ranges = fan**3
    cuts = F.percentile_approx(order, [i / ranges for i in range(1, ranges)], max(SKETCH_ACCURACY, 4 * ranges))

    def every(step: int) -> Column:
        places = F.sequence(F.lit(step), F.lit(ranges - step), F.lit(step))
        return F.transform(places, lambda i: F.element_at(F.col("_cuts"), i))

    return cuts.alias("_cuts"), F.struct(
        F.col("_cuts").alias("fine"), every(fan).alias("mid"), every(fan**2).alias("coarse")
    ).alias("_e")


def _range_of(edges: Column, value: Column, fan: int) -> Column:
    """How many cut points are at or below the value."""

    def below(points: Column) -> Column:
        return F.size(F.filter(points, lambda e: e <= value))

    a = below(edges["coarse"]) * fan
    b = (a + below(F.slice(edges["mid"], a + 1, fan - 1))) * fan
    # Never NULL: else the join on it would push a not-NULL test, and with it this whole
    # expression, below the grouping, and the grouped rows could not be shared.
    return F.coalesce(b + below(F.slice(edges["fine"], b + 1, fan - 1)), F.lit(0))


def running_totals(
    df: DataFrame,
    order: str,
    values: list[str],
    by: list[str] | None = None,
    descending: bool = False,
    split: bool = True,
) -> DataFrame:
    """Add ``cum_<v>`` (running, current row included) and ``total_<v>`` for each value.

    ``df`` must hold one row per (by, order), with ``order`` numeric and not NULL: group first.

    A running total is a window with nothing to divide a group by, which would be one task. The
    table is cut at approximate quantiles into ranges of about equal size; totals run
    inside each range and the few range totals run across ranges. The cut only balances work:
    the result is exact wherever the cut points fall. ``split=False`` is the caller's word that
    one task can hold a group, which then is one plain window.
    """
    by = list(by or [])
    direction = F.col(order).desc() if descending else F.col(order).asc()
    if not split:
        inside = Window.partitionBy(*by).orderBy(direction)
        everything = Window.partitionBy(*by)
        return df.withColumns(
            {f"cum_{v}": F.sum(v).over(inside) for v in values}
            | {f"total_{v}": F.sum(v).over(everything) for v in values}
        )

    # The sums beside the sketch keep this plan's columns the same as the main branch's, so
    # that Spark reuses the shuffle that produced df.
    steps = fan(df)
    cuts, edges = _edges(order, steps)
    sketch = df.agg(cuts, *[F.sum(v).alias(v) for v in values]).select(edges)
    ranged = df.withColumn("_edges", sketch.scalar())
    ranged = ranged.withColumn("_range", _range_of(F.col("_edges"), F.col(order), steps)).drop("_edges")
    if descending:
        ranged = ranged.withColumn("_range", -F.col("_range"))
    # A struct of the group columns is never NULL itself, so groups with NULLs join plainly.
    ranged = ranged.withColumn("_g", F.struct(*(by or [F.lit(0).alias("all")])))
    before = Window.partitionBy("_g").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy("_g")
    sums = ranged.groupBy("_g", "_range").agg(*[F.sum(v).alias(f"_s_{v}") for v in values])
    columns = []
    for v in values:
        prior = F.coalesce(F.sum(f"_s_{v}").over(before), F.lit(0))
        columns += [
            prior.alias(f"_prior_{v}"),
            F.sum(f"_s_{v}").over(everything).alias(f"total_{v}"),
        ]
    # Laid out like the large side; else that side would follow this one's layout by group.
    starts = sums.select("_g", "_range", *columns).repartition("_g", "_range")
    inside = Window.partitionBy("_g", "_range").orderBy(direction)
    local = ranged.withColumns({f"_local_{v}": F.sum(v).over(inside) for v in values})
    return local.join(starts, ["_g", "_range"]).select(
        *df.columns,
        *[(F.col(f"_prior_{v}") + F.col(f"_local_{v}")).alias(f"cum_{v}") for v in values],
        *[f"total_{v}" for v in values],
    )


def exact_quantiles(
    df: DataFrame,
    column: str,
    probabilities: list[float],
    by: list[str] | None = None,
    few_groups: bool = False,
    split: bool = True,
) -> DataFrame:
    """Linearly interpolated quantiles: one row per group, ``quantiles`` an array of doubles.

    The table is read twice and hardly shuffled: a sketch brackets each quantile between two
    values; then the rows below each bracket are counted and only the rows inside
    it (about a thousandth) are put in order. A bracket that missed its quantile raises; it
    cannot give a wrong value. ``split=False`` is the caller's word that a task can hold every
    distinct value of a group, and uses ``percentile``.

    ``few_groups`` says the groups are fixed and few (features, classes), so that their
    brackets may be broadcast.
    """
    by = list(by or [])
    present = df.filter(F.col(column).isNotNull()).select(
        *by, F.col(column).cast("double").alias("_v")
    )
    if not split:
        exact = F.percentile("_v", F.array(*[F.lit(float(p)) for p in probabilities]))
        return present.groupBy(*by).agg(exact.alias("quantiles"))

    lows = [max(p - _MARGIN, 0.0) for p in probabilities]
    highs = [min(p + _MARGIN, 1.0) for p in probabilities]
    k = len(probabilities)
    ends = present.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_v", [*lows, *highs], SKETCH_ACCURACY).alias("_s"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
    )
    small = F.col("_n") <= _WHOLE_GROUP

    def end(i: int, whole: bool, extreme: str) -> Column:
        return F.col(extreme) if whole else F.when(small, F.col(extreme)).otherwise(F.col("_s")[i])

    limits = F.array(
        *[
            F.struct(
                end(i, lows[i] == 0.0, "_min").alias("lo"),
                end(k + i, highs[i] == 1.0, "_max").alias("hi"),
            )
            for i in range(k)
        ]
    )
    bracket = F.struct(F.col("_n").alias("n"), limits.alias("limits")).alias("_b")
    if by:
        brackets = ends.select(*[F.col(c).alias(f"_by_{c}") for c in by], bracket)
        match = F.lit(True)
        for c in by:
            match = match & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
        placed = present.join(F.broadcast(brackets) if few_groups else brackets, match)
    else:
        placed = present.withColumn("_b", ends.select(bracket).scalar())

    # Per quantile: a row below the bracket counts under a NULL value, one inside under its own.
    x, limit = F.col("_v"), lambda i: F.col("_b")["limits"][i]
    marks = [
        F.when(x < limit(i)["lo"], F.struct(F.lit(i).alias("i"), F.lit(None).cast("double").alias("v")))
        .when(x <= limit(i)["hi"], F.struct(F.lit(i).alias("i"), x.alias("v")))
        for i in range(k)
    ]
    marked = placed.select(
        *by, F.col("_b")["n"].alias("_n"), F.explode(F.array_compact(F.array(*marks))).alias("_m")
    )
    counts = marked.groupBy(*by, "_n", F.col("_m")["i"].alias("_i"), F.col("_m")["v"].alias("_x"))
    counts = counts.agg(F.count(F.lit(1)).alias("_c"))
    ranked = running_totals(counts, "_x", ["_c"], [*by, "_n", "_i"])

    # Ranks of the two order statistics around each quantile, and the weight of the upper one.
    p = F.element_at(F.array(*[F.lit(float(p)) for p in probabilities]), F.col("_i") + 1)
    place = p * (F.col("_n") - 1)
    low, high = F.floor(place), F.ceil(place)
    last = F.col("cum__c")
    first = last - F.col("_c")
    found = (
        ranked.select(
            *by,
            "_i",
            (place - low).alias("_w"),
            F.when((low >= first) & (low < last), F.col("_x")).alias("_lo"),
            F.when((high >= first) & (high < last), F.col("_x")).alias("_hi"),
        )
        .groupBy(*by, "_i")
        .agg(F.max("_w").alias("_w"), F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    )
    value = (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_w")).alias("q")
    packed = found.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("_i", value))).alias("_q"))
    whole = (F.size("_q") == k) & ~F.exists("_q", lambda q: q["q"].isNull())
    missed = F.raise_error(F.lit("a quantile fell outside its bracket"))
    values = F.transform("_q", lambda q: q["q"])
    return packed.select(*by, F.when(whole, values).otherwise(missed).alias("quantiles"))


def median(df: DataFrame, column: str, by: list[str] | None = None, **how) -> DataFrame:
    q = exact_quantiles(df, column, [0.5], by, **how)
    return q.withColumn("median", F.col("quantiles")[0]).drop("quantiles")


# --- quantiles of many columns at once ------------------------------------------------------

# A scan cuts a bracket into so many parts of about equal rank.
_PARTS = 1_000
# Values that one bracket may bring to the driver (8 bytes each).
COLLECT = 20_000
# And all brackets of a scan together.
COLLECT_ALL = 4_000_000
# Groups whose brackets travel with the scan; more groups go through ``exact_quantiles``.
MAX_GROUPS = 100
_ROUNDS = 12


@dataclass
class _Bracket:
    """What is known of one quantile: its place among n values, and the values around it."""

    column: str
    p: float
    n: int = 0
    low: float | None = None  # None: open, as at the start
    high: float | None = None
    most: float = math.inf  # rows strictly inside, at most
    value: float | None = None

    def ranks(self) -> tuple[int, int]:
        place = self.p * (self.n - 1)
        return math.floor(place), math.ceil(place)

    def narrow(self, below: int, cut: list[float], inside: int) -> None:
        """Keep the parts around the wanted ranks. ``cut``: values inside at equal steps of rank."""
        first, last = ((r - below) / max(inside, 1) * _PARTS for r in self.ranks())
        # The sketch may be off by 1 / SKETCH_ACCURACY of the ranks, and by one row.
        off = 2 + _PARTS / max(inside, 1) + 2 * _PARTS / SKETCH_ACCURACY
        low, high = max(math.floor(first - off), 0), min(math.ceil(last + off), _PARTS)
        if first - off > 0 or self.low is None:
            self.low = cut[low]
        if last + off < _PARTS or self.high is None:
            self.high = cut[high]
        self.most = inside * ((high - low) / _PARTS + 2 / SKETCH_ACCURACY) + 2

    def settle(self, below: int, at_low: int, inside: list[float], up_to_high: int) -> None:
        """Read the wanted order statistics; a bracket that missed them is opened again."""
        values = np.sort(np.array(inside, dtype=float))
        found = []
        for r in self.ranks():
            if r < below or r >= up_to_high:
                self.low = self.high = None
                self.most = math.inf
                return
            k = r - at_low
            found.append(self.low if k < 0 else values[k] if k < len(values) else self.high)
        weight = self.p * (self.n - 1) - self.ranks()[0]
        self.value = float(found[0] + (found[1] - found[0]) * weight) if weight else float(found[0])


@dataclass
class WideQuantiles:
    """Per group (a tuple of the ``by`` values): quantiles per column, None for an empty column, and
    the values of the further aggregates of the first scan."""

    quantiles: dict[tuple, dict[str, list[float | None]]] = field(default_factory=dict)
    also: dict[tuple, dict] = field(default_factory=dict)
    scans: int = 0


def wide_quantiles(
    table: DataFrame,
    wanted: dict[str, list[float]],
    by: list[str] | None = None,
    also: list[Column] | None = None,
) -> WideQuantiles:
    """Linearly interpolated quantiles of many columns, exact, from a few scans of one aggregate row.

    The first scan counts every column's values and cuts them at a thousand approximate quantiles, one
    mergeable sketch per column. Each later scan counts, for all brackets at once, the values below and
    up to a bracket's ends, and takes those strictly inside: as they are, if the sketch's bound says they
    are at most ``COLLECT``, else cut again, a bracket then being a few hundredths of a percent of it.
    So two scans do up to five million rows, three up to a thousand times as many, and nothing is
    unpivoted, ordered or shuffled but partial aggregates. A bracket that missed is opened again.

    It runs jobs: pass a stored table. NULLs are left out; NaN is the largest value, as Spark orders.
    ``also``: aggregates computed in the first scan. Groups are the result's keys; raises beyond
    ``MAX_GROUPS`` groups, see ``grouped_quantiles``.
    """
    by = list(by or [])
    x = {c: F.col(c).cast("double") for c in wanted}
    steps = F.lit([i / _PARTS for i in range(_PARTS + 1)])

    def sketch(value: Column) -> Column:
        return F.percentile_approx(value, steps, SKETCH_ACCURACY)

    first = []
    for i, c in enumerate(wanted):
        first += [F.count(x[c]).alias(f"n{i}"), sketch(x[c]).alias(f"s{i}")]
    out = WideQuantiles()
    rows = table.groupBy(*by).agg(*first, *(also or [])).limit(MAX_GROUPS + 1).collect()
    if len(rows) > MAX_GROUPS:
        raise DataValidationError(f"quantiles of more than {MAX_GROUPS} groups at once")
    out.scans = 1
    brackets: dict[tuple, list[_Bracket]] = {}
    for r in rows:
        group = tuple(r[c] for c in by)
        out.also[group] = r.asDict()
        brackets[group] = []
        for i, (c, probabilities) in enumerate(wanted.items()):
            for p in probabilities:
                b = _Bracket(c, float(p), r[f"n{i}"])
                if b.n:
                    b.narrow(0, r[f"s{i}"], b.n)
                brackets[group].append(b)
    many = sum(map(len, wanted.values()))
    for _ in range(_ROUNDS):
        # The same places are open in every group, so that one expression serves all.
        places = [j for j in range(many) if any(_is_open(g[j]) for g in brackets.values())]
        if not places:
            break
        counted = _count_brackets(table, by, brackets, places, sketch)
        out.scans += 1
        for r in counted:
            own = brackets[tuple(r[c] for c in by)]
            for j in places:
                b = own[j]
                if not _is_open(b):
                    continue
                if r[f"t{j}"] is None:
                    b.settle(r[f"a{j}"], r[f"b{j}"], r[f"v{j}"] or [], r[f"d{j}"])
                elif r[f"a{j}"] <= b.ranks()[0] and b.ranks()[1] < r[f"d{j}"] and r[f"c{j}"]:
                    b.narrow(r[f"b{j}"], r[f"t{j}"], r[f"c{j}"])
                else:
                    b.settle(r[f"a{j}"], r[f"b{j}"], [], r[f"d{j}"])
    else:
        raise DataValidationError(f"quantiles not settled after {_ROUNDS} scans")
    for group, own in brackets.items():
        out.quantiles[group] = {c: [b.value for b in own if b.column == c] for c in wanted}
    return out


def _is_open(b: _Bracket) -> bool:
    return b.n > 0 and b.value is None


def _count_brackets(table, by, brackets, places, sketch):
    """One scan: per group and place j, counts below (a), up to the low end (b), strictly inside (c) and
    up to the high end (d), and either the values inside (v) or their cut (t)."""
    spark = table.sparkSession
    empty = [None] * len(places)
    ends = {
        g: ([own[j].low for j in places], [own[j].high for j in places]) if own else (empty, empty)
        for g, own in brackets.items()
    }
    if by:
        fields = ", ".join(f"`_by_{c}` {t}" for c, t in table.select(*by).dtypes)
        limits = spark.createDataFrame(
            [(*g, *e) for g, e in ends.items()], f"{fields}, _low array<double>, _high array<double>"
        )
        same = F.lit(True)
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
        placed = table.join(F.broadcast(limits), same)  # at most MAX_GROUPS rows
    else:
        low, high = ends[()]
        as_text = lambda v: ", ".join("NULL" if e is None else f"CAST('{e!r}' AS DOUBLE)" for e in v)
        arrays = {n: F.expr(f"CAST(array({as_text(v)}) AS ARRAY<DOUBLE>)") for n, v in (("_low", low), ("_high", high))}
        placed = table.withColumns(arrays)
    parts = []
    most = max(100, min(COLLECT, COLLECT_ALL // (len(places) * len(brackets))))
    for k, j in enumerate(places):
        # SQL text: one call into the JVM for each aggregate, of which there may be hundreds.
        column = next(own[j].column for own in brackets.values())
        v, low, high = f"CAST(`{column}` AS DOUBLE)", f"_low[{k}]", f"_high[{k}]"
        known = f"{v} IS NOT NULL"
        few = all(own[j].most <= most for own in brackets.values() if _is_open(own[j]))
        parts += [
            F.expr(f"count_if(coalesce({v} < {low}, false)) AS a{j}"),
            F.expr(f"count_if(coalesce({v} <= {low}, false)) AS b{j}"),
            F.expr(f"count_if(coalesce({v} <= {high}, {known})) AS d{j}"),
        ]
        taken = f"CASE WHEN coalesce({v} > {low}, {known}) AND coalesce({v} < {high}, {known}) THEN {v} END"
        if few:
            parts += [F.expr(f"collect_list({taken}) AS v{j}"), F.expr(f"NULL AS t{j}"), F.expr(f"0 AS c{j}")]
        else:
            parts += [F.expr(f"NULL AS v{j}"), sketch(F.expr(taken)).alias(f"t{j}"), F.expr(f"count({taken}) AS c{j}")]
    return placed.groupBy(*by).agg(*parts).collect()


def grouped_quantiles(table: DataFrame, wanted: dict[str, list[float]], by: list[str]) -> DataFrame:
    """One row per (group, feature): ``feature``, ``quantiles``; any number of groups.

    Up to ``MAX_GROUPS`` groups are read by ``wide_quantiles``; beyond, values go through
    ``exact_quantiles`` as (group, feature, value) rows.
    """
    spark = table.sparkSession
    keys = ", ".join(f"`{c}` {t}" for c, t in table.select(*by).dtypes)
    schema = f"{keys + ', ' if by else ''}feature string, quantiles array<double>"
    if not by or len(table.select(*by).distinct().limit(MAX_GROUPS + 1).collect()) <= MAX_GROUPS:
        found = wide_quantiles(table, wanted, by).quantiles
        rows = [(*g, c, q) for g, of in found.items() for c, q in of.items() if q and q[0] is not None]
        return spark.createDataFrame(rows, schema)
    probabilities = sorted({p for ps in wanted.values() for p in ps})
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in wanted]
    long = table.select(*by, F.inline(F.array(*pairs)))
    found = exact_quantiles(long, "value", probabilities, [*by, "feature"])
    places = F.create_map(
        *[e for c, ps in wanted.items() for e in (F.lit(c), F.array(*[F.lit(probabilities.index(p)) for p in ps]))]
    )
    taken = F.transform(F.element_at(places, F.col("feature")), lambda i: F.col("quantiles")[i])
    return found.select(*by, "feature", taken.alias("quantiles"))
