"""Cutoffs that keep a target fraction of every source (problem 5)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranks import first_reaching


def cutoffs(
    rows: DataFrame, targets: DataFrame, source: Sequence[str], score: str, permille: str = "keep_permille"
) -> DataFrame:
    """For every source with a target: the lowest score that keeps at least permille/1000 of its rows.

    Rows are kept from the best (lowest) score on, so the sums run over the frequencies of the negated score
    in descending order. Returns source columns, `cutoff`, `kept`, `total` and `permille`.

    Frequencies are summed before any shuffle of rows. The cumulative sums are taken over coarse bins first,
    whose number per source is bounded, and then over the distinct scores of the one bin that holds the
    cutoff, so no task sorts all the scores of a large source. Scores that are null or NaN must have been
    dropped. Null or missing targets and sources without rows give no row; a permille above 1000 can't be
    reached and gives none; 0 is met by the lowest score. If a source has several targets, the largest holds.
    """
    keys = list(source)
    goal = targets.where(F.col(permille).isNotNull()).groupBy(*keys).agg(F.max(permille).alias("permille"))
    found = first_reaching(rows, keys, score, F.col("upto") * 1000 >= F.col("permille") * F.col("total"), goal)
    return found.select(*keys, "permille", F.col("value").alias("cutoff"), F.col("upto").alias("kept"), "total")


def kept_rows(rows: DataFrame, cuts: DataFrame, source: Sequence[str], score: str) -> DataFrame:
    """The rows of every source that are at or below its cutoff; sources without cutoff keep none, and null is a source."""
    limits = cuts.select(*(F.col(k).alias(f"__{k}") for k in source), F.col("cutoff").alias("__cutoff"))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in source))
    return rows.join(limits, same & (F.col(score) <= F.col("__cutoff"))).drop("__cutoff", *(f"__{k}" for k in source))
