"""Top N items within every group (problem 6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(rows: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """The first n rows of every group in the given order; with `rank` their position in a column of that name.

    `order` must end in a unique column, else ties are broken arbitrarily. The rank filter on row_number
    becomes a group limit on both sides of the shuffle: each map task keeps at most n rows of a group, so a
    group of any size sends at most n rows per task. Null group values form one group of their own; nulls
    in order columns follow the order's null rule (first when rising). An empty table gives an empty table,
    repeated rows each take a place. Other columns are kept; if one has the name asked for, the position gets
    that name with underscores in front. n < 1 is an error.
    """
    if n < 1:
        raise ValueError(f"n must be at least 1, not {n}")
    taken = {c.lower() for c in rows.columns}
    name = rank or "place"
    while name.lower() in taken:
        name = f"_{name}"
    ranked = rows.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(name) <= n)
    return ranked if rank else ranked.drop(name)
