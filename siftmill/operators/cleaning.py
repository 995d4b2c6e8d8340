"""Filters, keep-first deduplication and the joins of training tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.features import all_valid


def keep_first(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order, which should end in a unique column; null keys are one key."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__place", F.row_number().over(window)).where("__place = 1").drop("__place")


def negative(rows: DataFrame, column: str = "affinity_kcal_mol") -> DataFrame:
    """Rows with a value below zero; null and NaN are not."""
    return rows.where(F.col(column) < 0)


def not_empty(rows: DataFrame, column: str) -> DataFrame:
    """Rows whose text is neither null nor empty."""
    return rows.where(F.col(column).isNotNull() & (F.col(column) != ""))


def empty_count(rows: DataFrame, column: str) -> DataFrame:
    """How many rows not_empty() keeps and skips: `kept, skipped`."""
    full = F.col(column).isNotNull() & (F.col(column) != "")
    return rows.agg(F.count_if(full).alias("kept"), F.count_if(~full).alias("skipped"))


def at_least(rows: DataFrame, column: str, least: float) -> DataFrame:
    """Rows with a value of `least` or more; null and NaN are dropped."""
    return rows.where((F.col(column) >= least) & ~F.isnan(column))


def training_rows(features: DataFrame, labels: DataFrame, first_feature: Sequence[Column], first_label: Sequence[Column], key: str = "id") -> DataFrame:
    """Valid features joined with negative labels one to one, each side reduced to the first row of a key."""
    left = keep_first(features.where(all_valid(features)), [key], first_feature)
    right = keep_first(negative(labels), [key], first_label)
    return left.join(right, key)


def present_and_absent(rows: DataFrame, outputs: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that have an output and rows that have none."""
    there = outputs.select(*keys).distinct()
    return rows.join(there, list(keys), "left_semi"), rows.join(there, list(keys), "left_anti")


def duplicated(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def aligned(left: DataFrame, right: DataFrame, position: str, key: str = "id") -> DataFrame:
    """Joins two tables row by row on a position and checks all keys: the left columns, `right_<key>` and `same`.

    Positions that one side alone has come out with nulls of the other and `same` false.
    """
    other = right.select(position, F.col(key).alias(f"right_{key}"))
    out = left.join(other, position, "full_outer")
    return out.withColumn("same", F.coalesce(F.col(key) == F.col(f"right_{key}"), F.lit(False)))


def require_aligned(joined: DataFrame) -> DataFrame:
    """The joined rows; fails if any differ."""
    wrong = joined.where("not same").count()
    if wrong:
        raise ValueError(f"{wrong} rows are not aligned")
    return joined


def difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that one side alone has: `key, side`; nulls are left out."""
    a, b = (f.select(F.col(key).alias("key")).where(F.col(key).isNotNull()).distinct() for f in (left, right))
    return a.join(b, "key", "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, "key", "left_anti").withColumn("side", F.lit("right")))
