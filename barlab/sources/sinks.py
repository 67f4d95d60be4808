"""Writers: bar tables, text reports, metrics and fitted pipelines."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barlab.functions.checks import bar_checks, observed_row, require_columns
from barlab.schema import BAR_COLUMNS, RAW_POSITIONS
from barlab.sources.tables import path_exists, spark_path

_RENAMES = 16


def write_bars(bars: DataFrame, path: str, files: int | None = None) -> None:
    """Bars as zstd parquet in global (symbol, open_time) order.

    Range partitioning splits a long symbol over files, and the sorted files let later scans
    skip row groups by symbol and time.
    """
    require_columns(bars, BAR_COLUMNS, "bar table")
    keys = ["symbol", "open_time"]
    ranged = bars.repartitionByRange(files, *keys) if files else bars.repartitionByRange(*keys)
    writer = ranged.sortWithinPartitions(*keys).write.mode("overwrite")
    writer.option("compression", "zstd").parquet(spark_path(path))


def write_monthly(bars: DataFrame, path: str, mode: str = "append", files: int | None = None) -> None:
    """Bars in one folder per month, each in (symbol, open_time) order; bars without a time apart.

    Range partitioning splits a month, or one symbol's part of it, over files.
    """
    require_columns(bars, BAR_COLUMNS, "bar table")
    keys = ["month", "symbol", "open_time"]
    dated = bars.withColumn("month", F.date_format("open_time", "yyyy-MM"))
    ranged = dated.repartitionByRange(files, *keys) if files else dated.repartitionByRange(*keys)
    writer = ranged.sortWithinPartitions(*keys).write.mode(mode).partitionBy("month")
    writer.option("compression", "zstd").parquet(spark_path(path))


def write_checked(bars: DataFrame, path: str) -> DataFrame:
    """``write_bars``, and one row of ``checks.bar_checks`` counted by the write itself.

    The counts are taken behind the exchange, in the job's last stage: the sampling of ranges does not pass
    them, and a task that runs twice counts once. An empty table is refused after the write, as only
    the write knows.
    """
    require_columns(bars, BAR_COLUMNS, "bar table")
    keys = ["symbol", "open_time"]
    observed = Observation("bars")
    ordered = bars.repartitionByRange(*keys).sortWithinPartitions(*keys)
    counted = ordered.observe(observed, *bar_checks())
    counted.write.mode("overwrite").option("compression", "zstd").parquet(spark_path(path))
    return observed_row(bars.sparkSession, observed, "bar table")


def verify_bars(bars: DataFrame) -> DataFrame:
    """Rows and distinct symbols of a written table (distinct by grouping, so it combines)."""
    per_symbol = bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    return per_symbol.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count("symbol").alias("symbols"),
    )


def raw_rows(bars: DataFrame) -> DataFrame:
    """Canonical bars back to the twelve raw positions (epochs in milliseconds)."""
    out = []
    for position, name in RAW_POSITIONS.items():
        c = F.col(name)
        if name in ("open_time", "close_time"):
            c = F.unix_millis(c.cast("timestamp"))
        out.append(c.alias(position))
    return bars.select("symbol", *out, F.lit(0.0).alias("_c11"))


def write_raw(rows: DataFrame, root: str) -> None:
    """Rows of ``raw_rows`` as headerless files below ``<root>/spot/monthly/klines``.

    Spark names the files of a partitioned write itself, so they are written to ``<root>/staging``
    and then renamed to the raw layout, no second copy of the rows. The tasks make all folders, and
    the driver, which only renames, does so for ``_RENAMES`` symbols at a time.
    """
    spark, top = rows.sparkSession, spark_path(root).rstrip("/")
    named = rows.withColumns({"_of": F.col("symbol"), "_in": F.lit("1m")}).drop("symbol")
    staged = named.repartition("_of").sortWithinPartitions("_of", "_c0").write.partitionBy("_of", "_in")
    staged.csv(f"{top}/staging")
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    files = path_of(top).getFileSystem(spark._jsc.hadoopConfiguration())
    base = f"{top}/spot/monthly/klines"
    files.mkdirs(path_of(base))

    def move(folder) -> None:
        name = str(folder.getPath().getName())
        if not name.startswith("_of="):
            return
        symbol = name[len("_of=") :]
        to = f"{base}/{symbol}"
        _rename(files, folder.getPath(), path_of(to))
        _rename(files, path_of(f"{to}/_in=1m"), path_of(f"{to}/1m"))
        for k, part in enumerate(files.listStatus(path_of(f"{to}/1m"))):
            _rename(files, part.getPath(), path_of(f"{to}/1m/{symbol}-1m-{k:05d}.csv"))

    with ThreadPoolExecutor(_RENAMES) as pool:
        list(pool.map(move, files.listStatus(path_of(f"{top}/staging"))))


def _rename(files, source, to) -> None:
    if not files.rename(source, to):
        raise OSError(f"could not rename {source.toString()} to {to.toString()}")


def write_text(lines: DataFrame, path: str) -> None:
    """A one-column table of report lines, in its own order, as one text file.

    For reports with one line per symbol, not for bar-sized tables.
    """
    lines.coalesce(1).write.mode("overwrite").text(spark_path(path))


def write_json(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").option("ignoreNullFields", False).json(spark_path(path))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(spark_path(path))


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(spark_path(path))


def load_or_train(
    spark: SparkSession, path: str, train: Callable[[], PipelineModel]
) -> PipelineModel:
    """The model saved at ``path``, or a newly trained one, saved there.

    A model's stages are written after its metadata, so a save cut short is recognized by the
    missing marker of the last stage and trained again.
    """
    if path_exists(spark, f"{path}/metadata/_SUCCESS"):
        try:
            return load_model(path)
        except (AnalysisException, Py4JJavaError) as error:
            # A stage that is not there means a save cut short; all else is the caller's to see.
            if not any(w in str(error) for w in ("does not exist", "FileNotFound", "PATH_NOT_FOUND")):
                raise
    save_model(train(), path)
    return load_model(path)
