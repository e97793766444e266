"""Tables between steps, in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import contextlib
import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []
_folders: set[str] = set()


def scratch_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir. Where it is unset, a folder of this machine, but only if the executors are threads of this process (tests)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if master.partition("[")[0] != "local":
            raise ValueError(f"spark.checkpoint.dir must name a folder that the driver and all executors share (master: {master})")
        if not _own:
            holder = tempfile.TemporaryDirectory(prefix="kindred-")
            atexit.register(holder.cleanup)
            _own.append(f"file://{holder.name}")
        shared = _own[0]
    return shared.rstrip("/")


def cut(df: DataFrame, by: str | None = None) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: lineage ends here, and a lost executor loses nothing. by: a column to write one folder of files for each value of.

    All tables of a process lie in one folder, which clean() removes; at the latest it goes when the process ends.
    """
    spark = df.sparkSession
    folder = f"{scratch_dir(spark)}/kindred/{spark.sparkContext.applicationId}-{os.getpid()}"
    if folder not in _folders:
        _folders.add(folder)
        atexit.register(_remove, folder)
    path = f"{folder}/{uuid.uuid4().hex}"
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Asks for shuffle files that no plan needs any more to go now. They go when the driver collects its garbage, and a driver with little to do may not for long."""
    gc.collect()  # plans that Python still holds in cycles
    spark.sparkContext._jvm.System.gc()


def _remove(folder: str) -> None:
    from pyspark import SparkContext

    with contextlib.suppress(Exception):  # the JVM may have ended before
        sc, jvm = SparkContext._active_spark_context, SparkContext._gateway.jvm
        conf = sc._jsc.hadoopConfiguration() if sc and sc._jsc else jvm.org.apache.hadoop.conf.Configuration()
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    _folders.discard(folder)


def clean() -> None:
    """Removes the tables that this process has cut. DataFrames that read them can't be used after that."""
    for folder in list(_folders):
        _remove(folder)
