"""Mixing sources to target weights by weighted fair queueing.

Documents of a source are shuffled by a hash of their id and may be taken twice (two rounds in the
same order). A copy's virtual finish time is the source's words up to and including it, divided by
the source's target. All copies are ordered by that time and cut at the total budget, so at every
moment each source has had its share, and at the cut each has its target but for one document.

Running totals never order a whole source or table in one task: hash ranges of a source are summed
first, and the place of the cut is found from sums per range of virtual time; only the one range
that holds the cut is ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlab.llm.shared import BROADCAST_KEYS, id_hash, need, prepare, shuffle_parts
from barlab.session import materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # of all words
REPEATS = 2  # no document, and so no source, is taken more often
SEED = "mix:"
HASH_BITS = 60
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """source, source_size and target of every source.

    ``share`` of all words is dealt by weight; what exceeds ``repeats`` times a source's size goes to
    the others by weight. With sources ordered by capacity per weight, the level is where it just
    suffices. The windows run over one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights) + 1
    totals = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place).cast("double"))
    totals = totals.withColumn("cap", F.col("source_size") * F.lit(float(repeats)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    since = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = totals.select(
        "source",
        "source_size",
        "weight",
        "cap",
        (F.sum("source_size").over(everything) * F.lit(share)).alias("budget"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("full"),
        F.sum("weight").over(since).alias("open"),
    )
    level = F.when(
        F.col("full") + F.col("cap") / F.col("weight") * F.col("open") >= F.col("budget"),
        (F.col("budget") - F.col("full")) / F.col("open"),
    )
    # The first source, by capacity, whose level suffices: later ones give no lower level.
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = levels.withColumn("level", F.first(level, ignorenulls=True).over(whole))
    target = F.least("cap", F.col("level") * F.col("weight"))
    return levels.select("source", "source_size", "budget", target.alias("target"))


def _source_key() -> Column:
    """A source as text that is never NULL; NULL sorts last."""
    return F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("~"))


def finish_times(sizes: DataFrame, targets: DataFrame, parts: int) -> DataFrame:
    """Adds source_size, target and ``done``: the source's words up to and including the document."""
    ranges = parts * 8
    width = -(-(1 << HASH_BITS) // ranges)
    rows = sizes.withColumns({"key": _source_key(), "h": id_hash("doc_id", SEED)})
    rows = rows.withColumn("range", F.expr(f"h div {width}L"))
    sums = rows.groupBy("key", "range").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("key", "range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("start"))
    starts = starts.join(targets.withColumn("key", _source_key()).drop("source"), "key")
    # Else the documents would follow this small side's layout, which is by source alone.
    starts = starts.repartition(parts, "key", "range")
    own = Window.partitionBy("key", "range").orderBy("h", "doc_id", "size")
    return rows.join(starts, ["key", "range"]).withColumn("done", F.col("start") + F.sum("size").over(own))


def _order(time: Column) -> Column:
    doc_id = F.coalesce("doc_id", F.lit(-1)).alias("i")
    return F.struct(time.alias("t"), F.col("key").alias("k"), F.col("h").alias("h"), doc_id, F.col("size").alias("n"))


def _times(repeats: int) -> list[Column]:
    """Virtual finish time of each copy; NULL where the source gets nothing."""
    return [(F.col("source_size") * r + F.col("done")) / F.nullif(F.col("target"), F.lit(0.0)) for r in range(repeats)]


def _slot(time: Column, ranges: int) -> Column:
    """Range of virtual time. At time 2 every source has had twice its target or all of its
    copies, so the cut lies before, and all later times share the last range."""
    return F.least(F.floor(time * ranges), F.lit(2 * ranges))


def cut(rows: DataFrame, ranges: int, repeats: int = REPEATS) -> tuple[int | None, tuple | None]:
    """The range of virtual time in which the budget ends, and the last copy taken of that range."""
    copies = rows.select(
        "budget", "size", F.explode(F.array(*[_order(t) for t in _times(repeats)])).alias("copy")
    ).filter(F.col("copy.t").isNotNull() & (F.col("size") > 0))
    copies = copies.withColumn("slot", _slot(F.col("copy.t"), ranges))
    slots = copies.groupBy("slot").agg(F.sum("size").alias("n"), F.first("budget").alias("budget"))
    slots = slots.withColumn("total", F.sum("n").over(Window.orderBy("slot")))
    found = slots.filter(F.col("total") > F.col("budget")).agg(
        F.min(F.struct("slot", F.col("total") - F.col("n"))).alias("s")
    )
    found = found.first()["s"]
    if found is None:
        return None, None
    inside = copies.filter(F.col("slot") == found[0])
    inside = inside.withColumn("total", F.lit(found[1]) + F.sum("size").over(Window.orderBy("copy")))
    last = inside.filter(F.col("total") <= F.col("budget")).agg(F.max("copy").alias("last")).first()["last"]
    return found[0], None if last is None else tuple(last)


def queue(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> tuple[DataFrame, list[Column]]:
    """All rows in their sources' orders (a stored table), and per round whether the mix takes the copy."""
    need(docs, id_column, text_column, source_column)
    spark = docs.sparkSession
    prepare(spark)
    parts = shuffle_parts(spark)
    sizes = materialize(
        docs.select(
            F.col(id_column).cast("long").alias("doc_id"),
            F.col(source_column).cast("string").alias("source"),
            word_count(F.col(text_column)).alias("size"),
        ),
        "sizes",
    )
    targets = materialize(source_targets(sizes, weights, share, repeats), "targets")
    rows = materialize(finish_times(sizes, targets, parts), "queue")
    ranges = 64 * parts
    slot, last = cut(rows, ranges, repeats)
    rounds = []
    for t in _times(repeats):
        taken = F.lit(True) if slot is None else _slot(t, ranges) < slot
        if last is not None:
            kinds = ("double", "string", "long", "long", "long")
            taken = taken | (_order(t) <= F.struct(*(F.lit(v).cast(k) for v, k in zip(last, kinds))))
        rounds.append(t.isNotNull() & taken)
    return rows, rounds


def mix(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted) of every row.

    ``settings`` are those of ``queue``. NULL texts have no words; NULL sources are one source, ordered
    last; rows without id are shuffled to one place. Equal rows are taken together or not at all. Other
    columns are ignored; an empty table gives no rows.
    """
    rows, rounds = queue(docs, **settings)
    copies = F.lit(0)
    for taken in rounds:
        copies = copies + F.when(taken, 1).otherwise(0)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"))


def _place() -> Column:
    """A document's place in its source's order, which virtual time follows."""
    return F.struct("h", F.coalesce("doc_id", F.lit(-1)).alias("i"), "size")


def mixed(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    **settings,
) -> DataFrame:
    """The rows and columns of ``docs`` as often as the mix takes them; columns may have any names.

    Documents without words are not taken; rows equal in id, source and size are taken alike; an empty
    table stays empty. In a source, what a round takes is all up to one place, so a row of places per
    source decides each text where it is read, and no text is shuffled. That table is broadcast
    behind a count of the sources.
    """
    names = {"id_column": id_column, "text_column": text_column, "source_column": source_column}
    rows, rounds = queue(docs, **names, **settings)
    lasts = [F.max(F.when(taken & (F.col("size") > 0), _place())).alias(f"last{r}") for r, taken in enumerate(rounds)]
    places = materialize(rows.groupBy("key").agg(*lasts), "places")
    if places.count() <= BROADCAST_KEYS:
        places = F.broadcast(places)
    placed = docs.select(
        F.struct("*").alias("row"),
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(source_column).cast("string").alias("source"),
        word_count(F.col(text_column)).alias("size"),
    ).filter("size > 0")
    placed = placed.withColumns({"key": _source_key(), "h": id_hash("doc_id", SEED)})
    copies = F.lit(0)
    for r in range(len(rounds)):
        copies = copies + F.when(_place() <= F.col(f"last{r}"), 1).otherwise(0)
    taken = placed.join(places, "key").withColumn("copies", copies).filter("copies > 0")
    return taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")


MIX_SQL = """
WITH sizes AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source
), weighed AS (
  SELECT *, CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight,
    source_size * 2.0::DOUBLE AS cap FROM totals
), levels AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) * 1.5::DOUBLE AS budget,
    coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
    sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS others
  FROM weighed
), targets AS (
  SELECT source, source_size, budget, least(cap, weight * (
    SELECT min_by((budget - filled) / others, cap / weight) FROM levels WHERE filled + cap / weight * others >= budget)) AS target
  FROM levels
), queue AS (
  SELECT s.*, t.source_size, t.target, t.budget, substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS h,
    CAST(sum(size) OVER (PARTITION BY s.source ORDER BY substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15), doc_id, size) AS BIGINT) AS done
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), copies AS (
  SELECT *, r, (source_size * r + done) / nullif(target, 0) AS t FROM queue, (VALUES (0), (1)) v(r)
), taken AS (
  SELECT *, sum(size) OVER (ORDER BY t, coalesce('s' || source, '~'), h, coalesce(doc_id, -1), size) <= budget AS yes
  FROM copies WHERE t IS NOT NULL
), times AS (
  SELECT doc_id, source, size, any_value(source_size) AS source_size, any_value(target) AS target, count_if(yes) AS n
  FROM taken GROUP BY doc_id, source, size
)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(q.size * coalesce(t.n, 0) AS BIGINT) AS taken
FROM queue q LEFT JOIN times t
  ON q.doc_id IS NOT DISTINCT FROM t.doc_id AND q.source IS NOT DISTINCT FROM t.source AND q.size = t.size
"""
