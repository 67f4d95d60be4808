"""Raw headerless bar files: ``<root>/spot/monthly/klines/<SYMBOL>/1m/<SYMBOL>-1m-YYYY-MM.csv``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.errors import DataValidationError
from barlab.operators.clean import canonical_bars, drop_nan_prices
from barlab.schema import RAW_BAR_SCHEMA

# The symbol is what stands between the last separator and the interval (fixed pattern).
SYMBOL_PATTERN = r"([^/\\#?]+)-1m-"


def symbol_from_path(path: Column | str) -> Column:
    path = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(path, SYMBOL_PATTERN, 1)


def symbol_globs(root: str, symbols: list[str] | None = None) -> list[str]:
    """Path patterns for all symbols, or one pattern per listed symbol."""
    base = f"{root.rstrip('/')}/spot/monthly/klines"
    if symbols is None:
        return [f"{base}/*/1m/*.csv"]
    return [f"{base}/{s}/1m/*.csv" for s in symbols]


def _folders(spark: SparkSession, root: str, symbols: list[str] | None) -> list[str]:
    """Paths of the symbol folders below the root, on whatever file system it names; none if it has none.

    Listed symbols are looked up one by one, and all symbols are one pattern: the driver does not walk
    the folders of other symbols. The files in them are listed by Spark alone, in parallel where there are many.
    """
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    base = path_of(f"{root.rstrip('/')}/spot/monthly/klines")
    files = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(base):
        return []
    if symbols is None:
        return [f"{base.toString()}/*/1m"] if any(f.isDirectory() for f in files.listStatus(base)) else []
    folders = [f"{base.toString()}/{symbol}" for symbol in sorted(set(symbols))]
    return [f"{folder}/1m" for folder in folders if files.exists(path_of(folder))]


def _with_symbol(reader_result: DataFrame) -> DataFrame:
    return reader_result.withColumn("symbol", symbol_from_path(F.col("_metadata.file_name")))


def scan_raw_csv(spark: SparkSession, root: str, symbols: list[str] | None = None) -> DataFrame:
    """Raw rows with the symbol taken from the file name; raises when no file matches.

    The schema is explicit, so no pass over the files infers it, and a symbol list prunes
    directories before any file is listed.
    """
    folders = _folders(spark, root, symbols)
    if not folders:
        raise DataValidationError(f"no raw bar files under {root}")
    reader = spark.read.schema(RAW_BAR_SCHEMA).option("pathGlobFilter", "*.csv")
    return _with_symbol(reader.csv(folders, header=False))


def scan_raw_tree(spark: SparkSession, prefix: str | list[str]) -> DataFrame:
    """Every CSV file below a prefix (local or object store), or an explicit file list."""
    reader = spark.read.schema(RAW_BAR_SCHEMA).option("recursiveFileLookup", True)
    return _with_symbol(reader.option("pathGlobFilter", "*.csv").csv(prefix, header=False))


def read_raw_bars(spark: SparkSession, root: str, symbols: list[str] | None = None) -> DataFrame:
    """Raw files straight to canonical bars, without rows that have a NaN price or volume."""
    return drop_nan_prices(canonical_bars(scan_raw_csv(spark, root, symbols)))
