"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ENGINE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # HotSpot never compiles longer methods: wide window chains run several times faster split up.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own.

    Its shared folder is one of this process, removed when the process ends.
    """
    builder = SparkSession.builder.master(f"local[{cores}]").appName("barlab")
    builder = builder.config("spark.checkpoint.dir", _own_folder())
    for key, value in ENGINE_SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("BARLAB_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Hours, months and formatted times are UTC throughout."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@functools.cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="barlab-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to the machine's own temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = _own_folder()
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(
    df: DataFrame, label: str, partition_by: list[str] | None = None, options: dict[str, str] | None = None
) -> DataFrame:
    """Write a table that several jobs will read, and read it back; ``options`` are those of the Parquet writer.

    Ends the lineage at files every executor can reach, so losing one recomputes nothing.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    writer = df.write.mode("overwrite").options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
