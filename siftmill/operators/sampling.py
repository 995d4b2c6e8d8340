"""Samples and selections that don't depend on how rows are laid out.

A sample of n takes the n smallest hashes of seed and key, so it is uniform, without replacement, exact in size,
the same after any repartitioning, and found with a group limit before and after one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: the seed that is used where none is given.
DEFAULT_SEED = 1000


def draw(key: Column | str, seed: int = DEFAULT_SEED) -> Column:
    """The lot of a key: the smallest win."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def _first(rows: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int | Column) -> DataFrame:
    limit = n if isinstance(n, Column) else F.lit(n)
    window = Window.partitionBy(*groups).orderBy(*order)
    return rows.withColumn("__place", F.row_number().over(window)).where(F.col("__place") <= limit).drop("__place")


def sampled(rows: DataFrame, n: int, key: str = "id", groups: Sequence[str] = ("shard_id",), seed: int = DEFAULT_SEED) -> DataFrame:
    """n rows of every group, or all of a smaller one. Rows with a null key or equal keys are ordered arbitrarily among each other."""
    if n < 0:
        raise ValueError(f"n must not be negative: {n}")
    return _first(rows, groups, [draw(key, seed), F.col(key)], n)


def top_scored(rows: DataFrame, n: int, score: str, key: str = "id", groups: Sequence[str] = ("shard_id",)) -> DataFrame:
    """The n best-scored rows of every group; null and NaN scores don't take part, equal scores go by key."""
    fit = rows.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    return _first(fit, groups, [F.col(score).desc(), F.col(key)], n)


def not_selected(rows: DataFrame, *earlier: DataFrame, key: str = "id") -> DataFrame:
    """The rows whose key no earlier selection has; null keys are in none."""
    for e in earlier:
        rows = rows.join(e.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")
    return rows


def taken_at(rows: DataFrame, places: DataFrame, place: str = "place") -> DataFrame:
    """The rows whose place is listed, each once however often that is; places beyond the rows give nothing."""
    return rows.join(places.select(place).distinct(), place, "left_semi")


def earlier_outputs(paths: Sequence[str], own: str) -> list[str]:
    """Paths of earlier selections, each once and in their order, without a step's own output, which it may find from its last run."""
    return [p for p in dict.fromkeys(paths) if p.rstrip("/") != own.rstrip("/")]


def select_top_and_random(
    rows: DataFrame, top: int, random: int, score: str, key: str = "id", groups: Sequence[str] = ("shard_id",), seed: int = DEFAULT_SEED
) -> DataFrame:
    """The best-scored rows of every group and a random draw of the others, with `selection_group` top or random.

    Rows without score take part in neither. Rows with equal keys are one candidate: if one is among the best,
    none of them is drawn.

    Both picks are group limits before and after a shuffle, so of a group no more than the rows that may be
    picked are sent or sorted: the best `top`, and the first top + random lots, of which at most `top` belong to
    the best.
    """
    fit = rows.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    best = _first(fit, groups, [F.col(score).desc(), F.col(key)], top)
    lots = Window.partitionBy(*groups).orderBy(draw(key, seed), F.col(key))
    drawn = fit.withColumn("__place", F.dense_rank().over(lots)).where(F.col("__place") <= top + random).drop("__place")
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*groups, key)]
    others = drawn.alias("d").join(best.select(*dict.fromkeys((*groups, key))).alias("b"), reduce(lambda x, y: x & y, same), "left_anti")
    others = _first(others, groups, [draw(key, seed), F.col(key)], random)
    return best.withColumn("selection_group", F.lit("top")).unionByName(others.withColumn("selection_group", F.lit("random")))


def split(rows: DataFrame, share: float = 0.8, key: str = "id", seed: int = DEFAULT_SEED) -> DataFrame:
    """Adds `part`, train for about `share` of the keys and else test; equal keys come to one part, with no shuffle."""
    lot = F.conv(F.substring(draw(key, seed), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    return rows.withColumn("part", F.when(lot < share, "train").otherwise("test"))


def quotas(total: int, groups: int, floor: bool = False) -> list[int]:
    """How many of `total` each of some groups gives: equal but for the rest, which goes to the first ones.

    With floor=True the rest is left out, as a plain division does; a total below the number of groups then
    gives nothing.
    """
    if groups < 1 or total < 0:
        raise ValueError("there must be a group, and the total not negative")
    each, rest = divmod(total, groups)
    return [each + (0 if floor else int(i < rest)) for i in range(groups)]


def round_seeds(seed: int, rounds: int) -> dict[str, int]:
    """The seed of the validation sample and of each round, all different."""
    return {"validation": seed} | {f"round_{i}": seed + 1 + i for i in range(rounds)}
