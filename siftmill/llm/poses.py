"""Docking rows that count: repeats and failed docks left out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns in which two docking rows must agree to be repeats of one another.
IDENTITY = ("id", "member_id", "site_id", "mode", "affinity_kcal_mol", "rmsd_lb", "rmsd_ub", "pose_pdbqt", "docked_at")


def counting_rows(docking: DataFrame) -> DataFrame:
    """The rows that count, one per set of repeats, with the smallest `pose_no` of the set.

    A row counts if `affinity_kcal_mol` is below zero (null and NaN are not) and no row with a smaller
    `pose_no` agrees in all IDENTITY columns (null equals null, NaN equals NaN). The affinity filter comes
    first, as repeats have equal affinities, and reaches the scan. Repeats collapse in the map-side half of
    the aggregation, so rows that were loaded very often cost nothing in the shuffle; grouping by all
    columns spreads a hot ligand or site over all partitions. Columns other than IDENTITY and `pose_no` are
    ignored. An empty table gives an empty table.
    """
    kept = docking.select("pose_no", *IDENTITY).where(
        (F.col("affinity_kcal_mol") < 0) & ~F.isnan("affinity_kcal_mol")
    )
    return kept.groupBy(*IDENTITY).agg(F.min("pose_no").alias("pose_no"))
