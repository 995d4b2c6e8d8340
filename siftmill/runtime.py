"""Session-level helpers: tables, the shared working folder, lineage cuts, partition counts."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: list[str] = []


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from `spark.checkpoint.dir`.

    Where the setting is absent a temporary folder of this process is used and removed at its end, but only
    with a local master: on a cluster each executor would write to its own disk, so that is an error.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    if not _LOCAL_DIRS:
        path = tempfile.mkdtemp(prefix="siftmill-")
        _LOCAL_DIRS.append(path)
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    return f"file://{os.path.abspath(_LOCAL_DIRS[0])}"


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in this application's part of it, which is deleted when the driver ends."""
    context = spark.sparkContext
    own = f"{shared_folder(spark)}/siftmill/{context.applicationId}"
    if not getattr(context, "_siftmill_owned", False):
        target = context._jvm.org.apache.hadoop.fs.Path(own)
        fs = target.getFileSystem(context._jsc.hadoopConfiguration())
        fs.mkdirs(target)
        fs.deleteOnExit(target)
        context._siftmill_owned = True
    return f"{own}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Writes df to the shared folder and reads it back.

    This cuts the lineage in a way that survives the loss of executors, keeps column pruning and filter
    push-down for later readers, and makes every later use read the rows instead of computing them again.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean_up(spark: SparkSession) -> None:
    """Deletes all tables that this application wrote to the shared folder; frames that read them are of no use afterwards."""
    remove_path(spark, f"{shared_folder(spark)}/siftmill/{spark.sparkContext.applicationId}")


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a path of any Hadoop file system; a missing path is no error."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship_package(spark: SparkSession) -> None:
    """Gives the Python workers of all executors this package, once per Spark context.

    Workers import the functions they run; where the package isn't installed on the executors, a zip of its
    sources is sent by Spark's file server.
    """
    context = spark.sparkContext
    if getattr(context, "_siftmill_shipped", False):
        return
    package = Path(__file__).parent
    folder = tempfile.mkdtemp(prefix="siftmill-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "siftmill.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(path)
    context._siftmill_shipped = True
