"""Row windows over one symbol's bars, without tying a symbol to a task.

Every rolling, lagging, leading and exponential operator is written once, against a
``Series``: a table, the columns that partition its windows and the columns that order them.

Time is cut into buckets, and bars are counted per symbol and bucket. The running counts cut every
symbol into segments: runs of whole buckets of about ``segment_rows`` rows. They also tell which
further buckets a segment needs so that ``lookback`` rows precede and ``lookahead`` rows follow its own;
gaps in time and empty buckets only make that stretch of time longer. So a bar knows all its segments
from its time alone: it is copied to them before the only shuffle that carries bars, and the copies
are dropped once the windows are computed. A symbol spreads over as many tasks as its length asks
for, at any size of the table and without a job while the plan is built. ``segment_rows=None`` is the
caller's word that no symbol exceeds a task; windows are then partitioned by symbol alone.

The segments are broadcast: only symbols of more than one are in that table, so it has at most two
entries of 40 bytes per ``segment_rows`` bars (10 MB for 30 billion bars at the default).

Rows are ordered by time and then by all other columns, so that copies of one instant get the same
values in every run and every retry. Bars without a symbol are one series. Bars should be unique
per (symbol, open_time); ``clean.dedup_bars`` makes them so.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barlab.functions.checks import require_columns
from barlab.functions.timestamps import int_div, to_us
from barlab.schema import MINUTE_MS

# A segment's margins are about a percent of it.
SEGMENT_ROWS = 250_000
# Buckets of unique bars in a segment: margins are whole buckets.
BUCKETS = 64
# Segments are searched in two steps: among groups of so many, then inside a group.
_CHUNK = 64

_POS, _SEGMENT, _OWN = "_pos", "_segment", "_own"


@dataclass
class Series:
    """A table whose windows run along ``order`` inside each group of ``keys``."""

    df: DataFrame
    keys: list[str]
    order: list[str] = field(default_factory=lambda: ["open_time"])
    block: int | None = None
    _windows: dict[int, WindowSpec] = field(default_factory=dict)

    def ordered(self) -> WindowSpec:
        # A window is many calls into the JVM, so each is built once.
        if 0 not in self._windows:
            self._windows[0] = Window.partitionBy(*self.keys).orderBy(*self.order)
        return self._windows[0]

    def last(self, n: int) -> WindowSpec:
        """The current row and the ``n - 1`` rows before it."""
        if n not in self._windows:
            self._windows[n] = self.ordered().rowsBetween(-(n - 1), 0)
        return self._windows[n]

    def with_columns(self, columns: dict[str, Column]) -> Series:
        return replace(self, df=self.df.withColumns(columns)) if columns else self

    def drop(self, *columns: str) -> Series:
        return replace(self, df=self.df.drop(*columns))

    def blocked(self, rows: int) -> Series:
        """Number the rows and cut them into blocks; later windows share the block's sort."""
        if self.block is not None:
            return self
        df = self.df.withColumn(_POS, F.row_number().over(self.ordered()) - 1)
        df = df.withColumn("_block", int_div(_POS, rows)).withColumn(
            "_k", F.col(_POS) - F.col("_block") * rows
        )
        return Series(df, self.keys, ["_block", "_k"], rows)


def full_order(df: DataFrame) -> list[str]:
    """Time, then every other column that has an order, by name."""
    orderable = [c for c, t in df.dtypes if not t.startswith(("map", "variant")) and c not in ("symbol", "open_time")]
    return ["open_time", *sorted(orderable)]


def _bucket(bar_ms: int, segment_rows: int) -> Column:
    """Time buckets that hold at most a ``BUCKETS``-th of a segment's rows, if bars are unique."""
    width_us = bar_ms * 1000 * max(1, segment_rows // BUCKETS)
    return F.coalesce(int_div(to_us("open_time"), width_us), F.lit(-(2**40)))


def segment_table(df: DataFrame, lookback: int, lookahead: int, segment_rows: int, bar_ms: int) -> DataFrame:
    """The segments of every symbol: ``first`` and ``last`` bucket of its own rows, ``low`` and ``high``
    bucket of the rows that its windows need."""
    counts = df.groupBy("symbol", _bucket(bar_ms, segment_rows).alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    of_symbol = Window.partitionBy("symbol")
    so_far = of_symbol.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("_end", F.sum("_n").over(so_far))
    counts = counts.withColumn("_start", F.col("_end") - F.col("_n")).withColumn(_SEGMENT, int_div("_start", segment_rows))
    reach = {"_low": F.col("_bucket"), "_high": F.col("_bucket")}
    if lookback:
        # The first bucket with one of the last ``lookback`` rows up to the end of the bucket before.
        by_end = of_symbol.orderBy("_end")
        counts = counts.withColumn("_back", F.min("_bucket").over(by_end.rangeBetween(-(lookback - 1), 0)))
        reach["_low"] = F.coalesce(F.lag("_back").over(by_end), "_bucket")
    if lookahead:
        by_start = of_symbol.orderBy("_start")
        counts = counts.withColumn("_ahead", F.max("_bucket").over(by_start.rangeBetween(0, lookahead - 1)))
        reach["_high"] = F.coalesce(F.lead("_ahead").over(by_start), "_bucket")
    return (
        counts.withColumns(reach)
        .groupBy("symbol", _SEGMENT)
        .agg(
            F.min("_bucket").alias("first"), F.max("_bucket").alias("last"),
            F.min("_low").alias("low"), F.max("_high").alias("high"),
        )
    )


def _segments(
    df: DataFrame, lookback: int, lookahead: int, segment_rows: int, bar_ms: int, order: list[str]
) -> Series:
    if max(lookback, lookahead) > segment_rows:
        raise ValueError("a segment must be at least as long as its margins")
    found = segment_table(df, lookback, lookahead, segment_rows, bar_ms)
    found = found.withColumn("_parts", F.count(F.lit(1)).over(Window.partitionBy("symbol"))).filter("_parts > 1")
    chunk = int_div(_SEGMENT, _CHUNK).alias("_chunk")
    parts = found.select(
        F.col("symbol").alias("_of"), chunk, F.col(_SEGMENT).alias("_found"),
        *(F.col(c).alias(f"_{c}") for c in ("low", "high", "first", "last")),
    )
    chunks = parts.groupBy("_of", "_chunk").agg(F.min("_low").alias("_from"), F.max("_high").alias("_to"))
    # Both have rows of symbols of several segments only; see the module's text for their bound.
    placed = df.withColumn("_bucket", _bucket(bar_ms, segment_rows))
    same = F.col("symbol").eqNullSafe(F.col("_of"))
    within = F.col("_bucket").between(F.col("_from"), F.col("_to"))
    placed = placed.join(F.broadcast(chunks), same & within, "left").drop("_of")
    needed = (F.col("_chunk") == F.col("_in")) & F.col("_bucket").between(F.col("_low"), F.col("_high"))
    placed = placed.join(F.broadcast(parts.withColumnRenamed("_chunk", "_in")), same & needed, "left")
    own = F.col("_chunk").isNull() | F.col("_bucket").between(F.col("_first"), F.col("_last"))
    placed = placed.select(
        *df.columns, F.coalesce("_found", F.lit(0).cast("long")).alias(_SEGMENT), own.alias(_OWN)
    )
    return Series(placed, ["symbol", _SEGMENT], order)


def over_series(
    bars: DataFrame,
    build: Callable[[Series], Series],
    lookback: int,
    lookahead: int = 0,
    segment_rows: int | None = SEGMENT_ROWS,
    bar_ms: int = MINUTE_MS,
    tie_break: list[str] | None = None,
) -> DataFrame:
    """Apply ``build`` to the bars of every symbol and drop the helper columns.

    ``lookback`` and ``lookahead`` are the rows a result may depend on besides its own.
    ``tie_break`` orders bars of one instant, by default all columns, which therefore are all read;
    for bars that are unique, ``[]`` keeps the scan to the columns that are used.
    """
    require_columns(bars, ["symbol", "open_time"], "bar table")
    order = full_order(bars) if tie_break is None else ["open_time", *tie_break]
    if segment_rows is None:
        built = build(Series(bars, ["symbol"], order)).df
    else:
        built = build(_segments(bars, lookback, lookahead, segment_rows, bar_ms, order)).df
        built = built.filter(_OWN)
    return built.drop(_POS, _SEGMENT, _OWN, "_block", "_k")
