"""Binding sites: from predicted pockets and atoms, flattening, search boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import box_edge, site_id


def pocket_sites(pockets: DataFrame, atoms: DataFrame, tool: str) -> DataFrame:
    """Sites of trimmed pockets (with `member_id`) and atoms (`member_id, serial, x, y, z`).

    The radius is the root mean square distance of the pocket's atoms from its reported centre. Atoms that the
    structure lacks are left out and counted in `missing`; a pocket without any atom gives no site. One row:
    `site_id, member_id, center, radius, pocket_score, probability, missing`.
    """
    spots = pockets.select(
        "member_id",
        "rank",
        *(F.col(f"center_{a}").cast("double").alias(f"c{a}") for a in "xyz"),
        F.col("score").cast("double").alias("pocket_score"),
        F.col("probability").cast("double").alias("probability"),
        F.filter(F.split("surf_atom_ids", r"\s+"), lambda s: s != "").alias("serials"),
    )
    wanted = spots.select("*", F.explode("serials").alias("s")).withColumn("serial", F.col("s").cast("int"))
    away = sum((F.pow(F.col(a) - F.col(f"c{a}"), F.lit(2.0)) for a in "xyz"), F.lit(0.0))
    found = wanted.join(atoms.select("member_id", "serial", "x", "y", "z"), ["member_id", "serial"])
    return (
        found.groupBy("member_id", "rank", "cx", "cy", "cz", "pocket_score", "probability")
        .agg(F.sqrt(F.avg(away)).alias("radius"), (F.max(F.size("serials")) - F.count(F.lit(1))).alias("missing"))
        .select(site_id("member_id", tool, "rank").alias("site_id"), "member_id", F.array("cx", "cy", "cz").alias("center"), "radius", "pocket_score", "probability", "missing")
    )


def cloud_radius(sites: DataFrame) -> DataFrame:
    """Sites with `extent_radius`: that of a sphere, or the root mean square distance of a point cloud from the centre.

    Null if the extent has neither, or the centre isn't three numbers.
    """
    away = F.transform("extent.points", lambda p: F.pow(p[0] - F.col("center")[0], 2.0) + F.pow(p[1] - F.col("center")[1], 2.0) + F.pow(p[2] - F.col("center")[2], 2.0))
    total = F.aggregate(away, F.lit(0.0), lambda a, x: a + x)
    cloud = F.when((F.size("extent.points") > 0) & (F.size("center") == 3), F.sqrt(total / F.size("extent.points")))
    return sites.withColumn("extent_radius", F.when(F.col("extent.kind") == "sphere", F.col("extent.radius")).otherwise(cloud))


def search_boxes(sites: DataFrame) -> DataFrame:
    """The search box of every site: `site_id, center, edge`, an edge as wide as the extent but never below the least."""
    return cloud_radius(sites).select("site_id", "center", box_edge(F.col("extent_radius") * 2).alias("edge"))


def nested(sites: DataFrame) -> DataFrame:
    """One document for each ensemble: `ensemble_id, binding_sites`, sites in the order of member and site."""
    fields = F.struct("member_id", "site_id", *(c for c in sites.columns if c not in ("ensemble_id", "member_id", "site_id")))
    return sites.groupBy("ensemble_id").agg(F.sort_array(F.collect_list(F.struct(F.struct("member_id", "site_id").alias("k"), fields.alias("s")))).alias("b")).select("ensemble_id", F.col("b.s").alias("binding_sites"))


def flattened(documents: DataFrame) -> DataFrame:
    """One row for each site of the documents: `ensemble_id, site_id, member_id, center`, the centre as JSON text."""
    return documents.select("ensemble_id", F.explode("binding_sites").alias("s")).select("ensemble_id", "s.site_id", "s.member_id", F.to_json("s.center").alias("center"))
