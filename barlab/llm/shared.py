"""Helpers that several operators of this package share."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.errors import DataValidationError

# A side with at most this many keys may be broadcast (8 bytes each, 8 MB); beyond it, joins shuffle.
BROADCAST_KEYS = 1_000_000

ARROW_BATCH_BYTES = 8 << 20


# The folder that holds the package, for Python workers on the driver's machine or with the same layout;
# elsewhere the package is shipped as usual, with --py-files.
_HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Session settings of these operators: UTC, and Arrow batches bounded in bytes."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _HOME not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, _HOME])
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def need(df: DataFrame, *columns: str) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise DataValidationError(f"the table lacks columns {missing}")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_hash(column: Column | str, seed: str) -> Column:
    """A deterministic pseudo-random 60-bit number of an id, the same in any SQL engine with MD5."""
    column = F.col(column) if isinstance(column, str) else column
    text = F.concat(F.lit(seed), F.coalesce(column.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def in_fold(doc_id: Column | str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; a NULL id is in no fold."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def free_name(table: DataFrame, name: str) -> str:
    """``name``, longer by underscores where the table has a column of that name in any case."""
    taken = {c.lower() for c in table.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _match_ids(table: DataFrame, column: str, ids: DataFrame, how: str) -> DataFrame:
    few = ids.count() <= BROADCAST_KEYS
    name = free_name(table, "_id")
    ids = ids.select(F.col(ids.columns[0]).alias(name))
    matched = F.col(column).cast("long") == F.col(name)
    return table.join(F.broadcast(ids) if few else ids, matched, how)


def keep_ids(table: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose ``column`` is among the (stored) ids; the ids are broadcast behind a count."""
    return _match_ids(table, column, ids, "left_semi")


def without_ids(table: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose ``column`` is NULL or not among the (stored) ids."""
    return _match_ids(table, column, ids, "left_anti")
