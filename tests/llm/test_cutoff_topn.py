"""Cutoffs and top N against plain loops."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from siftmill.llm.cutoff import cutoffs, kept_rows
from siftmill.llm.poses import IDENTITY, counting_rows
from siftmill.llm.topn import top_n

POSES = "pose_no long, id string, member_id string, site_id string, mode int, affinity_kcal_mol double, rmsd_lb double, rmsd_ub double, pose_pdbqt string, docked_at timestamp_ntz, loaded_at timestamp_ntz, cutoff string, n string, bin string, place int"


def poses(spark, rows):
    return spark.createDataFrame([(n, i, m, s, mode, a, lb, None, "", None, None, "c", "n", "b", 0) for n, i, m, s, mode, a, lb in rows], POSES)


def test_counting_rows(spark):
    rows = [
        (4, "a", "M", "S", 1, -5.0, 0.0), (2, "a", "M", "S", 1, -5.0, 0.0),  # repeats
        (5, "a", "M", "S", 1, -5.0, None), (6, "a", "M", "S", 1, -5.0, None),  # null equals null
        (7, "a", "M", "S", 1, -5.0, float("nan")), (8, "a", "M", "S", 1, -5.0, float("nan")),
        (9, "a", "M", "S", 1, float("nan"), 0.0), (10, "a", "M", "S", 1, 0.0, 0.0), (11, "a", "M", "S", 1, None, 0.0),
        (12, None, None, None, None, -1.0, None),
    ]
    frame = counting_rows(poses(spark, rows))
    assert sorted(r.pose_no for r in frame.collect()) == [2, 5, 7, 12] and set(frame.columns) == {*IDENTITY, "pose_no"}
    assert counting_rows(poses(spark, [])).count() == 0


def test_cutoffs_against_loops(spark):
    random.seed(1)
    rows, n = [], 0
    for site in range(12):
        for _ in range(random.choice([1, 2, 3, 50, 400])):
            rows.append((n := n + 1, f"i{n}", "M", f"S{site}", 1, -random.choice([0.1, 5.0, 5.25, 7.0, 63.9, 64.0, 64.1, 1e-12, 1e8, random.random() * 12]), 0.0))
    keep = {f"S{s}": random.choice([0, 1, 5, 333, 500, 999, 1000]) for s in range(10)} | {"S10": None, "S11": 1001, "none": 500}
    targets = spark.createDataFrame([("M", s, k) for s, k in keep.items()] + [(None, "S0", 5), ("M", None, 5)], "member_id string, site_id string, keep_permille int")
    frame, groups = counting_rows(poses(spark, rows)), defaultdict(list)
    for r in rows:
        groups[r[3]].append((r[5], r[0]))
    expected, kept = {}, set()
    for s, k in keep.items():
        for cut in sorted({a for a, _ in groups[s]}) if k is not None else []:
            below = [x for a, x in groups[s] if a <= cut]
            if 1000 * len(below) >= k * len(groups[s]):
                expected[s] = (cut, len(below), len(groups[s]))
                kept |= set(below)
                break
    cuts = cutoffs(frame, targets, ["member_id", "site_id"], "affinity_kcal_mol")
    assert {r.site_id: (r.cutoff, r.kept, r.total) for r in cuts.collect()} == expected
    assert {r.pose_no for r in kept_rows(frame, cuts, ["member_id", "site_id"], "affinity_kcal_mol").collect()} == kept


def test_cutoffs_of_extremes(spark):
    rows = spark.createDataFrame([("s", float("-inf")), ("s", -1.0), ("s", -0.0), ("s", 0.0), ("t", 3.0)], "source string, score double")
    for permille, cutoff in ((1, float("-inf")), (500, -1.0), (501, 0.0)):
        goal = spark.createDataFrame([("s", permille), ("s", 0)], "source string, keep_permille int")
        assert cutoffs(rows, goal, ["source"], "score").first().cutoff == cutoff
    assert cutoffs(rows.limit(0), goal, ["source"], "score").count() == 0 == cutoffs(rows, goal.limit(0), ["source"], "score").count()


def test_top_n(spark):
    rows = spark.createDataFrame([("a", -5.0, "S", 1), ("a", -5.0, None, 2), ("a", -6.0, "T", 3), ("a", -5.0, "S", 4), (None, -1.0, "S", 5), ("b", None, "S", 6)], "id string, a double, site_id string, no long")
    order = [F.col(c).asc() for c in ("a", "site_id", "no")]
    assert sorted(r.no for r in top_n(rows, ["id"], order, 3).collect()) == [1, 2, 3, 5, 6]
    assert {r.no: r.place for r in top_n(rows, ["id"], order, 2, rank="place").collect()} == {3: 1, 2: 2, 5: 1, 6: 1}
    clash = rows.withColumn("place", F.lit("x"))
    assert top_n(clash, ["id"], order, 1).columns == clash.columns and "_place" in top_n(clash, ["id"], order, 1, rank="place").columns
    assert top_n(rows.limit(0), ["id"], order, 3).count() == 0
    hot = spark.range(20_000).select(F.lit("h").alias("id"), (-(F.col("id") % 7)).cast("double").alias("a"), F.lit("S").alias("site_id"), F.col("id").alias("no"))
    assert sorted(r.no for r in top_n(hot, ["id"], order, 3).collect()) == [6, 13, 20]
    plan = top_n(hot.withColumn("id", F.col("no") % 5), ["id"], order, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    with pytest.raises(ValueError):
        top_n(rows, ["id"], order, 0)
