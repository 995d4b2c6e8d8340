"""Activity labels from a rank-based threshold, and how well a model finds the active."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize
from .ranks import coarse, first_reaching


def nearest_quantile(rows: DataFrame, column: str, percent: float, groups: Sequence[str] = ()) -> DataFrame:
    """The value nearest to the quantile in rank, an actual value: that of place floor((n - 1) p + 0.5) + 1.

    Over values that are neither null nor NaN, of every group that has any: the groups, `threshold, n`. Values
    are counted before they are ordered, and ordered inside of one coarse bin only.
    """
    if not 0 < percent <= 100:
        raise ValueError(f"the percentage must be above 0 and at most 100, not {percent}")
    fit = rows.where(F.col(column).isNotNull() & ~F.isnan(column))
    place = F.floor((F.col("total") - 1) * F.lit(percent / 100) + 0.5) + 1
    found = first_reaching(fit, groups, column, F.col("upto") >= place)
    return found.select(*groups, F.col("value").alias("threshold"), F.col("total").alias("n"))


def require_threshold(found: DataFrame) -> float:
    """The one threshold; none, as of an empty table, is an error."""
    row = found.select("threshold").first()
    if row is None:
        raise ValueError("there is no value to take a threshold from")
    return row[0]


def labelled(rows: DataFrame, thresholds: DataFrame, column: str, groups: Sequence[str] = ()) -> DataFrame:
    """Adds `active`: 1 at or below the threshold, else 0, also for null and NaN. Groups without threshold are dropped; null is a group."""
    limits = thresholds.select(*groups, "threshold")
    if groups:
        limits = thresholds.select(*(F.col(g).alias(f"__{g}") for g in groups), "threshold")
        same = reduce(lambda a, b: a & b, (F.col(g).eqNullSafe(F.col(f"__{g}")) for g in groups))
        joined = rows.join(limits, same).drop(*(f"__{g}" for g in groups))
    else:
        one = limits.first()
        joined = rows.withColumn("threshold", F.lit(one[0] if one else None).cast("double")).where(F.lit(one is not None))
    return joined.withColumn("active", F.coalesce((F.col(column) <= F.col("threshold")).cast("int"), F.lit(0))).drop("threshold")


def histogram(rows: DataFrame, column: str = "active") -> DataFrame:
    """The number of rows of every value from 0 to the largest, zeros included: `value, rows`."""
    counts = rows.where(F.col(column) >= 0).groupBy(F.col(column).cast("int").alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    every = counts.agg(F.max("value").alias("most")).where("most is not null").select(F.explode(F.sequence(F.lit(0), "most")).alias("value"))
    return every.join(counts, "value", "left").select("value", F.coalesce("rows", F.lit(0)).alias("rows"))


#: Shares of the ranking that are reported, in percent.
PERCENTS = (1.0, 5.0, 10.0, 15.0)


def enrichment(rows: DataFrame, score: str, active: str, key: str, percents: Sequence[float] = PERCENTS) -> DataFrame:
    """Of the best-scored share of rows: `percent, precision, recall, caught, actives`.

    A share of n rows is the integer part of it, but one row at least; equal scores go by key; null and NaN
    scores come last. Recall is null without actives; an empty table gives no rows.

    Rows and actives are summed over coarse bins of the score, whose number is bounded; only inside of the
    bins where a share ends rows are ranked one by one.
    """
    value = F.col(score).cast("double")
    fit = rows.select(F.col(key).alias("k"), F.when(~F.isnan(value), value).alias("s"), F.col(active).cast("long").alias("y")).withColumn("bin", coarse(F.col("s")))
    fit = materialize(fit, "ranked-rows")  # read twice, as the rows may come from a join
    sums = fit.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("hits")).collect()  # one row for each bin
    spark, schema = rows.sparkSession, "percent double, precision double, recall double, caught long, actives long"
    n, actives = sum(r["n"] for r in sums), sum(r["hits"] for r in sums)
    if not n:
        return spark.createDataFrame([], schema)
    out, open_ = {}, []
    for p in percents:
        end, before, hits = max(1, int(n * p / 100)), 0, 0
        for r in sorted(sums, key=lambda r: (r["bin"] is None, -(r["bin"] or 0))):
            if before + r["n"] >= end:
                open_.append((p, r["bin"], end - before))
                break
            before, hits = before + r["n"], hits + r["hits"]
        out[p] = (end, hits)
    ranked = Window.partitionBy("bin").orderBy(F.col("s").desc_nulls_last(), F.col("k"))
    ends = {b: max(e for _, x, e in open_ if x == b) for _, b, _ in open_}
    inside = F.lit(False)
    for b in ends:
        inside |= F.col("bin").eqNullSafe(F.lit(b).cast("int"))
    best = fit.where(inside).withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= max(ends.values()))
    more = best.agg(*(F.coalesce(F.sum(F.when(F.col("bin").eqNullSafe(F.lit(b).cast("int")) & (F.col("place") <= e), F.col("y"))), F.lit(0)).alias(f"c{i}") for i, (_, b, e) in enumerate(open_))).first()
    found = []
    for i, (p, _, _) in enumerate(open_):
        end, hits = out[p]
        caught = int(hits + more[i])
        found.append((float(p), caught / end, caught / actives if actives else None, caught, int(actives)))
    return spark.createDataFrame(found, schema)
