"""Parquet bar tables, cached results and catalog tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.errors import DataValidationError
from barlab.functions.checks import require_columns
from barlab.schema import BAR_COLUMNS

# A bucket is read by one task, and a symbol lies in one bucket.
MAX_SYMBOL_ROWS = 50_000_000


def spark_path(path: str) -> str:
    """``s3://`` as the scheme Spark's connector answers to."""
    return "s3a://" + path[len("s3://"):] if path.startswith("s3://") else path


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(spark_path(path))
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def load_bars(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A parquet table by path, optionally only some columns."""
    if not path_exists(spark, path):
        raise DataValidationError(f"no parquet table at {path}")
    table = spark.read.parquet(spark_path(path))
    return table.select(*columns) if columns else table


def read_or_compute(
    spark: SparkSession, path: str, compute: Callable[[], DataFrame]
) -> DataFrame:
    """The table at ``path``; computed and written there first when it is not complete.

    Spark leaves a success marker only after the whole write is committed, so a job lost half
    way is done again rather than read short.
    """
    if not path_exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        compute().write.mode("overwrite").parquet(spark_path(path))
    return spark.read.parquet(spark_path(path))


def register_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Make an existing parquet folder a table of the session catalog.

    A table of that name at another place gives way; its files stay, as it was external.
    """
    quoted = spark_path(path).replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{quoted}'")
    return spark.table(name)


def save_bucketed(
    bars: DataFrame, name: str, path: str, buckets: int, max_symbol_rows: int = MAX_SYMBOL_ROWS
) -> DataFrame:
    """Bars as a catalog table bucketed by symbol, sorted by time inside the files, with statistics.

    Windows, joins and groups by symbol on it need no exchange: the layout is paid for once, in the write.
    So a symbol must fit a task: more than ``max_symbol_rows`` rows of one symbol (or without one) are refused, from
    counts that combine before they shuffle; such tables are for ``sinks.write_bars`` and segmented
    windows. The bars are hashed to their buckets by the same function as the table's, so that each
    bucket is one file.
    """
    require_columns(bars, BAR_COLUMNS, "bar table")
    most = bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if most > max_symbol_rows:
        raise DataValidationError(f"a symbol has {most} rows, a bucket takes {max_symbol_rows}")
    spark = bars.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = bars.repartition(buckets, "symbol").write.format("parquet").mode("overwrite")
    writer = writer.option("path", spark_path(path)).option("compression", "zstd")
    writer.bucketBy(buckets, "symbol").sortBy("symbol", "open_time").saveAsTable(name)
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS symbol, open_time")
    return spark.table(name)
