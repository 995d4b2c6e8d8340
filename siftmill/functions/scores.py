"""Desirability of molecular properties and the multi-parameter score made of it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Property, then the points (value, desirability) between which desirability runs linearly.
#: Beyond the first and last point it stays as it is there; a jump has two points at one value.
CURVES: dict[str, tuple[tuple[float, float], ...]] = {
    "clogd": ((0.0, 0.0), (2.0, 1.0), (4.0, 1.0), (5.0, 0.0)),
    "mw": ((360.0, 1.0), (500.0, 0.0)),
    "tpsa": ((20.0, 0.0), (40.0, 1.0), (90.0, 1.0), (120.0, 0.0)),
    "hbd": ((0.0, 1.0), (3.0, 0.0)),
}


def clamped_line(value: Column, start: float, end: float, low: float, high: float) -> Column:
    """Runs linearly from `low` at `start` to `high` at `end`, and stays there on either side."""
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (value - F.lit(start)) / F.lit(end - start)))
    return F.lit(low) + F.lit(high - low) * share


def desirability(value: Column | str, curve: str) -> Column:
    """The desirability 0..1 of a property by its curve; null for null, and null for NaN."""
    value = F.col(value) if isinstance(value, str) else value
    points = CURVES[curve]
    steps = F.lit(points[-1][1])
    for (a, low), (b, high) in reversed(list(zip(points, points[1:], strict=False))):
        steps = F.when(value < b, clamped_line(value, a, b, low, high)).otherwise(steps)
    return F.when(value.isNotNull() & ~F.isnan(value), steps)


def mpo_score(mw: Column, clogd: Column, tpsa: Column, hbd: Column, charged_nitrogen: Column) -> Column:
    """The score 0..6: lipophilicity counts twice, and a charged basic nitrogen takes one point.

    Null if a property is null or NaN; an unknown charge counts as none.
    """
    basic = F.when(F.coalesce(charged_nitrogen, F.lit(False)), 0.0).otherwise(1.0)
    return (
        F.lit(2.0) * desirability(clogd, "clogd") + desirability(mw, "mw") + desirability(tpsa, "tpsa") + desirability(hbd, "hbd") + basic
    )
