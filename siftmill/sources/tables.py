"""Parquet sources: path resolution, projections, counts, listings."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def resolve(spark: SparkSession, pattern: str, recursive: bool = False, missing: str = "error") -> list[str]:
    """Parquet files of a path, a folder or a glob, in sorted order, each once.

    None at all is an error, or with missing="warn" a warning and an empty list, as for a merge with nothing to do.
    """
    if missing not in ("error", "warn"):
        raise ValueError(f"missing must be error or warn, not {missing}")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found: list[str] = []
    for status in fs.globStatus(path) or []:
        if status.isDirectory():
            files = fs.listFiles(status.getPath(), recursive)
            while files.hasNext():
                name = files.next().getPath().toString()
                if name.endswith(".parquet"):
                    found.append(name)
        else:
            found.append(status.getPath().toString())
    if not found and missing == "error":
        raise FileNotFoundError(f"no files at {pattern}")
    if not found:
        log.warning("no files at %s", pattern)
    return sorted(dict.fromkeys(found))


def scan(spark: SparkSession, files: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Several files as one table, with the given columns alone; a missing column is an error."""
    frame = spark.read.parquet(*files)
    return frame.select(*columns) if columns is not None else frame


def listing(spark: SparkSession, pattern: str, hashed: bool = False) -> DataFrame:
    """One row for each file: `path, size, modified`, and with `hashed` its SHA-256; contents are read for that only."""
    files = spark.read.format("binaryFile").load(pattern)
    columns = [F.col("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")]
    return files.select(*columns, *([F.sha2("content", 256).alias("sha256")] if hashed else []))
