"""Hash shards: assignment, counts, layout checks, and the partitioned sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import shard_of


def assigned(rows: DataFrame, key: str = "id", shards: int = 512, column: str = "shard_id") -> DataFrame:
    """The rows with their shard; rows with a null key have none. An existing column of that name is an error."""
    if column.lower() in (c.lower() for c in rows.columns):
        raise ValueError(f"the rows already have a column {column}")
    return rows.withColumn(column, shard_of(key, shards))


def shard_counts(rows: DataFrame, column: str = "shard_id") -> DataFrame:
    """Rows of every shard that has any."""
    return rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def _expected(spark: SparkSession, shards: int, column: str) -> DataFrame:
    return spark.range(shards).select(F.col("id").cast("int").alias(column))


def missing_shards(rows: DataFrame, shards: int, column: str = "shard_id") -> DataFrame:
    """Shards that have no rows."""
    return _expected(rows.sparkSession, shards, column).join(rows.select(column).distinct(), column, "left_anti")


def unexpected_shards(rows: DataFrame, shards: int, column: str = "shard_id") -> DataFrame:
    """Shards of rows that are outside 0..shards-1."""
    return rows.select(column).where((F.col(column) < 0) | (F.col(column) >= shards)).distinct()


#: Shards that a failed layout check names.
NAMED = 5


def require_layout(rows: DataFrame, shards: int, column: str = "shard_id") -> None:
    """Fails if shards are missing or unexpected, naming the first few."""
    for what, found in (("missing", missing_shards(rows, shards, column)), ("unexpected", unexpected_shards(rows, shards, column))):
        first = [r[0] for r in found.orderBy(column).limit(NAMED).collect()]
        if first:
            raise ValueError(f"{what} shards: {found.count()} (such as {', '.join(map(str, first))})")


def write_shards(
    rows: DataFrame, path: str, shards: int = 512, key: str = "id", column: str = "shard_id", rows_per_file: int = 0, files_per_shard: int = 1
) -> None:
    """Writes one folder for each shard, in one shuffle by the number of the shard, so no task gets two shards while another has none.

    A shard is `files_per_shard` files, each by a task of its own, or more if files of `rows_per_file` rows don't
    suffice. Rows without shard go to a folder of their own; shards outside of 0..shards-1 are written as well.
    """
    if files_per_shard < 1:
        raise ValueError(f"a shard has at least one file, not {files_per_shard}")
    out = rows if column in rows.columns else assigned(rows, key, shards, column)
    place = F.pmod(F.coalesce(F.col(column), F.lit(0)).cast("int"), F.lit(shards)) * files_per_shard
    if files_per_shard > 1:
        place += F.pmod(F.xxhash64(*[c for c in out.columns if c != column]), F.lit(files_per_shard)).cast("int")
    writer = out.repartitionById(shards * files_per_shard, place.cast("int")).write.mode("overwrite").partitionBy(column).option("compression", "zstd")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def merged(spark: SparkSession, *paths: str, same_columns: bool = True) -> DataFrame:
    """UNION ALL of several Parquet paths, no row dropped; no path is an error. With same_columns=False columns are merged by name."""
    if not paths:
        raise ValueError("nothing to merge")
    return spark.read.option("mergeSchema", str(not same_columns).lower()).parquet(*paths)


def write_merged(rows: DataFrame, path: str, files: int = 1) -> int:
    """Writes rows as few files and checks the written number of rows against that which went in."""
    from pyspark.sql import Observation

    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).coalesce(files).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return require_written(rows.sparkSession, path, seen.get["rows"])


def require_written(spark: SparkSession, path: str, rows: int) -> int:
    """The rows of a path by its footers; another number than expected is an error."""
    there = spark.read.parquet(path).count()
    if there != rows:
        raise ValueError(f"{path} has {there} rows instead of {rows}")
    return there
