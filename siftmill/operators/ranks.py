"""Ranks over compact frequencies: the first value of a group at which a cumulative count is enough."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def coarse(value: Column) -> Column:
    """A bin of a number that rises with it: 64 bins for each power of two, so at most some 2^18 whatever the data.

    Null for null and NaN.
    """
    size = F.least(F.abs(value), F.lit(1e300))
    exponent = F.floor(F.log2(F.greatest(size, F.lit(2.0**-64))))
    part = F.floor((size / F.pow(F.lit(2.0), exponent) - 1) * 64)
    place = F.greatest(F.lit(0), (exponent + 65) * 64 + F.least(F.lit(63), part))
    return F.when(value.isNull() | F.isnan(value), None).otherwise(F.when(value < 0, -place).otherwise(place)).cast("int")


def first_reaching(rows: DataFrame, groups: Sequence[str], value: str, need: Column, goals: DataFrame | None = None) -> DataFrame:
    """For every group the smallest value at which `need` holds: the groups, columns of `goals`, `value, upto, total`.

    `need` is a condition on `upto` (rows of the group at or below the value), `total` (all its rows) and the
    columns of `goals`, one row for each group; once it holds it must hold for all larger values. Groups
    without goal or for which it never holds are left out. Values must be neither null nor NaN; null is a group.

    Frequencies of distinct values are summed before any shuffle of rows. Sums run over coarse bins first,
    whose number in a group is bounded, then over the distinct values of the one bin where need begins to
    hold, so no task orders all values of a large group.
    """
    keys, more = list(groups), [c for c in goals.columns if c not in groups] if goals is not None else []
    counts = rows.select(*keys, F.col(value).cast("double").alias("value")).groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("bin", coarse(F.col("value")))
    bins = counts.groupBy(*keys, "bin").agg(F.sum("n").alias("n"))
    rising = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    placed = bins.withColumn("upto", F.sum("n").over(rising)).withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))
    if goals is not None:
        wanted = goals.select(*(F.col(k).alias(f"__{k}") for k in keys), *more)
        same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
        placed = placed.join(wanted, same).drop(*(f"__{k}" for k in keys))
    hit = (
        placed.where(need).groupBy(*keys, *more, "total")
        .agg(F.min_by(F.struct("bin", (F.col("upto") - F.col("n")).alias("before")), "bin").alias("h"))
        .select(*keys, *more, "total", "h.bin", "h.before")
    )
    same = F.col("c.bin") == F.col("h.bin")
    for k in keys:
        same &= F.col(f"c.{k}").eqNullSafe(F.col(f"h.{k}"))
    inside = counts.alias("c").join(hit.alias("h"), same).select(*(f"h.{k}" for k in keys), *more, "total", "before", "value", "n", "h.bin")
    finer = Window.partitionBy(*keys, "bin").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    return (
        inside.withColumn("upto", F.col("before") + F.sum("n").over(finer)).where(need)
        .groupBy(*keys, *more, "total").agg(F.min("value").alias("value"), F.min("upto").alias("upto"))
    )
