"""The table of registered queries.

Each query is a function of (spark, data folder); its oracle, where SQL can state it, is the
same result for DuckDB. Doubles are rounded alike on both sides and times leave as epoch
milliseconds, so that results compare by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.functions.timestamps import to_ms
from barlab.plans.sql import nudge
from barlab.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(use_utc(spark), sf_dir)

        QUERIES[name] = in_utc
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


def emit(df: DataFrame, *columns: str, **digits: int) -> DataFrame:
    """Select plain columns and rounded ones; integers leave as 64-bit, times as ``open_ms``."""
    types = dict(df.dtypes)
    out = []
    for c in columns:
        if c == "open_time":
            out.append(to_ms(c).alias("open_ms"))
        elif types[c] in ("int", "bigint", "smallint", "tinyint"):
            out.append(F.col(c).cast("long").alias(c))
        else:
            out.append(F.col(c))
    for c, n in digits.items():
        out.append(F.round(F.col(c).cast("double") + nudge(n), n).alias(c))
    return df.select(*out)


def rounded(columns: list[str], digits: int) -> dict[str, int]:
    return dict.fromkeys(columns, digits)


def load_all() -> None:
    """Import the modules that register queries."""
    from barlab.plans import (  # noqa: F401
        bar_queries,
        cube_queries,
        eda_queries,
        feature_queries,
        metric_queries,
        model_queries,
    )
