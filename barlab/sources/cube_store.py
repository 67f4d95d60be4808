"""A cube stored beside its bars, of which only months whose files changed are computed again.

The store holds cells, one folder per month, and a manifest: every file of the bar table with its
size, its time of change and the months it has bars of. A refresh lists the files, compares them with
the manifest, reads files that are new or rewritten once for their months, and computes the months of new,
rewritten and removed files again from all files that hold them. Those months alone are overwritten. The
manifest is written last under the next version, so a refresh that is cut short is done again by the next
one; readers of a version leave months out that it does not name. One refresh runs at a time.

Cells cannot be added up from old and new files instead: a rewritten or removed file has no known part in them.

Lists of files come to the driver, as in Spark's own file index; lists of months are as long as the calendar.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.errors import DataValidationError
from barlab.operators.cube import CUBE_INPUTS, eda_cube
from barlab.session import materialize
from barlab.sources.tables import path_exists, spark_path

CELL_SCHEMA = (
    "symbol string, hour int, n long, n_r long, sum_r double, sum_r2 double, up_n long, sum_volume double, "
    "sum_quote_volume double, sum_trades long, sum_taker_buy_base double, month string"
)
MANIFEST_SCHEMA = "file string, size long, changed timestamp, month string"
NO_MONTH = "none"  # of bars without a time
_FILE = ["file", "size", "changed"]


@dataclass(frozen=True)
class Refreshed:
    """The whole cube, and what the refresh read for it."""

    cube: DataFrame
    months: list[str]
    files: list[str]


def _file_columns() -> list[Column]:
    meta = {"file": "file_path", "size": "file_size", "changed": "file_modification_time"}
    return [F.col(f"_metadata.{c}").alias(name) for name, c in meta.items()]


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """file, size and changed of every parquet file below a folder; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return files.load(spark_path(path)).select(*_file_columns())


def _month(time: str = "open_time") -> Column:
    return F.coalesce(F.date_format(time, "yyyy-MM"), F.lit(NO_MONTH))


def _read(spark: SparkSession, files: list[str]) -> DataFrame:
    # Columns that folder names spell are not asked for.
    return spark.read.parquet(*map(unquote, files))


def _versions(spark: SparkSession, cube_path: str) -> list[str]:
    """Complete manifests, oldest first."""
    if not path_exists(spark, f"{cube_path}/manifest"):
        return []
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    top = path_of(spark_path(f"{cube_path}/manifest"))
    found = [str(s.getPath().getName()) for s in top.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(top)]
    return sorted(v for v in found if path_exists(spark, f"{cube_path}/manifest/{v}/_SUCCESS"))


def manifest(spark: SparkSession, cube_path: str) -> DataFrame:
    """The files that the stored cube was computed from: one row per file and month; month is NULL
    for files without bars. Empty before the first refresh."""
    versions = _versions(spark, cube_path)
    if not versions:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(spark_path(f"{cube_path}/manifest/{versions[-1]}"))


def read_cube(spark: SparkSession, cube_path: str) -> DataFrame:
    """The stored cube, with the columns of ``eda_cube``."""
    months = [r.month for r in manifest(spark, cube_path).select("month").distinct().collect() if r.month]
    if not months:
        cells = spark.createDataFrame([], CELL_SCHEMA)
    else:
        # The type of the folder's column is given, as a month could be taken for a date.
        cells = spark.read.schema(CELL_SCHEMA).parquet(spark_path(f"{cube_path}/cells"))
        cells = cells.filter(F.coalesce("month", F.lit(NO_MONTH)).isin(months))
        # Cells stored before returns were counted apart: every bar for one that has a return.
        cells = cells.withColumn("n_r", F.coalesce("n_r", "n"))
    return cells.select("symbol", "month", *[c for c in cells.columns if c not in ("symbol", "month")])


def _in_months(bars: DataFrame, months: list[str]) -> DataFrame:
    """Bars of these months; the first and last month also bound the scan by time."""
    if NO_MONTH not in months:
        after = F.add_months(F.to_date(F.lit(f"{max(months)}-01")), 1).cast("timestamp")
        opened = F.col("open_time")
        bars = bars.filter((opened >= F.lit(f"{min(months)}-01").cast("timestamp")) & (opened < after))
    return bars.filter(_month().isin(months))


def refresh_cube(spark: SparkSession, bars_path: str, cube_path: str) -> Refreshed:
    """Bring the cube at ``cube_path`` up to the parquet bars at ``bars_path``; both sessions in UTC.

    Without a change in the files nothing is read or written.
    """
    if not path_exists(spark, bars_path):
        raise DataValidationError(f"no parquet table at {bars_path}")
    known = manifest(spark, cube_path)
    listed = materialize(list_files(spark, bars_path), "files")
    fresh = [r.file for r in listed.join(known, _FILE, "left_anti").select("file").collect()]
    gone = known.join(listed, _FILE, "left_anti")
    lost = {r.month for r in gone.select("month").distinct().collect()}
    if not fresh and not lost:
        return Refreshed(read_cube(spark, cube_path), [], [])

    entries = known.join(listed, _FILE, "left_semi")
    if fresh:
        found = _read(spark, fresh).select("open_time", F.col("_metadata.file_path").alias("file"))
        found = found.groupBy("file", _month().alias("month")).agg(F.count(F.lit(1)).alias("n"))
        new = listed.join(known, _FILE, "left_anti").join(found, "file", "left").select(*_FILE, "month")
        entries = entries.unionByName(new)
    entries = materialize(entries, "manifest")
    if fresh:
        lost |= {r.month for r in entries.join(listed.join(known, _FILE, "left_anti"), _FILE, "left_semi")
                 .select("month").distinct().collect()}
    months = sorted(m for m in lost if m is not None)
    held = entries.filter(F.col("month").isin(months)).select("file").distinct().orderBy("file")
    files = [r.file for r in held.collect()]
    if files:
        bars = _in_months(_read(spark, files).select(*CUBE_INPUTS), months)
        # A month has at most 24 cells per symbol.
        cells = eda_cube(bars).repartition("month").write.mode("overwrite").partitionBy("month")
        cells.option("partitionOverwriteMode", "dynamic").parquet(spark_path(f"{cube_path}/cells"))
    version = len(_versions(spark, cube_path))
    entries.write.mode("overwrite").parquet(spark_path(f"{cube_path}/manifest/{version:08d}"))
    return Refreshed(read_cube(spark, cube_path), months, [unquote(f) for f in files])
