"""Queries of the core: the reference's operators and problem 2, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import names, scores
from .functions.commands import scored_by
from .functions.features import all_valid, flattened
from .functions.hashing import blake3_shard_of
from .functions.providers import HashedDocking, HashedFeature, docked, featurized, stand_in_conformer, with_conformers
from .operators import cleaning, labels, packing, sampling, sharding, sites
from .operators.compact import pack_pose_files, pose_store
from .operators.surrogate import Settings, prepared, scored, trained
from .plans.active import run_rounds
from .plans.config import Round
from .runtime import table, work_path
from .plans.files import HadoopFiles
from .plans.layout import Layout, labels_up_to
from .plans.tasks import write_sites
from .plans.thresholds import kept_threshold
from .plans.workflows import layout_problems, sample_candidates
from .sources.pockets import POCKET_COLUMNS, read_pockets, read_sites, structure_atoms
from .sources.pose_text import pose_records
from .sources.poses import read_ligands, read_results, write_results
from .sources.smi import parse_lines
from .sources.tables import listing, resolve, scan

SITE = ["member_id", "site_id"]


def _packed(spark: SparkSession, folder: str) -> DataFrame:
    """A store that took the pose files in by two transactions, which were merged into one run of the next tier."""
    store = pose_store(spark, work_path(spark, "poses"), fanout=2, top=4)
    pack_pose_files(store, table(spark, folder, "pose_files"), parts=2)
    return store.read()


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """The pose records that any file holds, read from the compacted store."""
    return _packed(spark, folder).select("id", "member_id", "site_id", "mode").distinct()


def p2_records(spark: SparkSession, folder: str) -> DataFrame:
    """The numbers of the compacted store by site: records, ligands, and the best affinity."""
    return (
        _packed(spark, folder).groupBy(*SITE)
        .agg(F.count(F.lit(1)).alias("records"), F.countDistinct("id").alias("ligands"), F.min("affinity_kcal_mol").alias("best"))
    )


def shard_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates in each of 512 shards."""
    return sharding.shard_counts(sharding.assigned(table(spark, folder, "candidates").select("id")))


def blake3_shard_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates in each of 512 shards of the BLAKE3 layout."""
    rows = table(spark, folder, "candidates").select(blake3_shard_of("id", 512).alias("shard_id"))
    return sharding.shard_counts(rows)


def missing_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Shards of 4096 that no candidate is in."""
    return sharding.missing_shards(sharding.assigned(table(spark, folder, "candidates").select("id"), shards=4096), 4096)


def unexpected_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Shards of a layout of 512 that one of 500 doesn't have."""
    return sharding.unexpected_shards(sharding.assigned(table(spark, folder, "candidates").select("id")), 500)


def smi_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Candidate lines cut at their first white space."""
    lines = table(spark, folder, "candidates").select("row_no", F.concat_ws("\t", "smiles", "id").alias("value"))
    return parse_lines(lines, missing="drop")


def merge_tranches(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every tranche, from the merge of two written parts of the library."""
    rows, parts = table(spark, folder, "candidates").select("smiles", "id", "source_file"), [work_path(spark, f"tranche-{i}") for i in range(2)]
    for i, path in enumerate(parts):
        rows.where(F.pmod(F.xxhash64("source_file"), F.lit(2)) == i).write.option("compression", "zstd").parquet(path)
    merged = work_path(spark, "merged")
    sharding.write_merged(sharding.merged(spark, *parts), merged, files=8)
    found = scan(spark, resolve(spark, merged), ["source_file"])
    return found.groupBy(names.source_stem("source_file").alias("source")).agg(F.count(F.lit(1)).alias("rows"))


def written_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates in each of 64 shards, counted in the files of the sharded sink, whose layout is checked."""
    path = work_path(spark, "shards")
    sharding.write_shards(table(spark, folder, "candidates").select("smiles", "id").where("id is not null"), path, 64)
    rows = spark.read.parquet(path)
    if problems := layout_problems(spark, "final-in-range", [], path, 64):
        raise ValueError(problems)
    return sharding.shard_counts(rows)


def written_results(spark: SparkSession, folder: str) -> DataFrame:
    """Docking rows of every site as they come back from the sink of results."""
    path = work_path(spark, "results")
    write_results(table(spark, folder, "docking_results"), path)
    return read_results(spark, path).groupBy(*SITE).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("pose_pdbqt") != "").alias("texts"))


def pocket_table(spark: SparkSession, folder: str) -> DataFrame:
    """Pocket predictions of every site, through a table with padded names and cells."""
    rows = table(spark, folder, "binding_sites").where("size(center) = 3")
    values = {"name": F.col("site_id"), "rank": F.lit("1"), "score": F.coalesce("pocket_score", F.lit(0.0)).cast("string")} | {f"center_{a}": F.col("center")[i].cast("string") for i, a in enumerate("xyz")}
    padded = rows.select(*(F.concat(F.lit("  "), values.get(c, F.lit("0")), F.lit(" ")).alias(f" {c} ") for c in POCKET_COLUMNS))
    path = work_path(spark, "pockets")
    padded.write.csv(path, header=True)
    return read_pockets(spark, path).select("name", F.col("score").cast("double").alias("score"), F.col("center_x").cast("double").alias("x"))


def site_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Sites of every ensemble, read from the documents they were written to."""
    rows, files = table(spark, folder, "binding_sites"), HadoopFiles(spark)
    out = []
    for r in rows.select("ensemble_id").distinct().orderBy("ensemble_id").collect():  # one document for each ensemble
        path = f"{work_path(spark, 'sites')}.json"
        write_sites(rows, r.ensemble_id, path, files)
        out.append(read_sites(spark, path, r.ensemble_id).select("ensemble_id", "member_id", "site_id", "pocket_score"))
    return reduce(DataFrame.unionByName, out)


def written_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Three candidates of each of 64 shards, by the workflow that samples a sharded pool and keeps the sample."""
    pool = work_path(spark, "pool")
    once = cleaning.keep_first(table(spark, folder, "candidates").where("id is not null"), ["id"], [F.col("row_no")])
    sharding.write_shards(once.select("smiles", "id"), pool, 64)
    layout = Layout(work_path(spark, "data"), "screen")
    sample_candidates(spark, layout, pool, "few", 3 * 64 + 5, number=64)
    return spark.read.parquet(layout.shards("few", "raw")).select("id", "shard_id")


def atoms_of_structures(spark: SparkSession, folder: str) -> DataFrame:
    """Points of every site, through structure texts of both formats; texts of one have a second model, which doesn't count."""
    cloud = table(spark, folder, "binding_sites").where("extent.kind = 'point_cloud' and size(extent.points) > 0").select("site_id", F.col("extent.points").alias("p"))
    number = F.sequence(F.lit(0), F.size("p") - 1)
    line = lambda form: F.transform(number, lambda i: F.format_string(form, i + 1, F.col("p")[i][0], F.col("p")[i][1], F.col("p")[i][2]))
    older = F.concat_ws("\n", F.lit("MODEL        1"), F.concat_ws("\n", line("ATOM  %5d  C   ALA A   1    %8.3f%8.3f%8.3f")), F.lit("ENDMDL"), F.lit("ATOM      1  C   ALA A   1       0.000   0.000   0.000"))
    head = "\n".join(["data_X", "loop_", *(f"_atom_site.{c}" for c in ("group_PDB", "id", "label_atom_id", "Cartn_x", "Cartn_y", "Cartn_z"))])
    newer = F.concat_ws("\n", F.lit(head), F.concat_ws("\n", line("ATOM %d 'C 1' %.3f %.3f %.3f")), F.lit("#"))
    rows = cloud.select("site_id", F.lit("older").alias("format"), older.alias("content")).unionByName(cloud.select("site_id", F.lit("newer").alias("format"), newer.alias("content")))
    return structure_atoms(rows)


def taken_places(spark: SparkSession, folder: str) -> DataFrame:
    """Feature rows at the places that the rows of selections have, each once."""
    rows = table(spark, folder, "features").select(F.col("vec_no").alias("place"), "shard_id")
    return sampling.taken_at(rows, table(spark, folder, "selections").select(F.col("row_no").alias("place")))


def screen_threshold(spark: SparkSession, folder: str) -> DataFrame:
    """The activity threshold over all sites, kept in a file and taken from there the second time."""
    rows, path = table(spark, folder, "docking_results").select("affinity_kcal_mol"), f"{work_path(spark, 'threshold')}.json"
    files = HadoopFiles(spark)
    found = [kept_threshold(part, path, 2.5, {"rows": "all"}, files=files) for part in (rows, rows.limit(0))]
    return spark.createDataFrame([(i, v) for i, v in enumerate(found)], "time int, threshold double")


def rounds_so_far(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that were selected up to each round: the union that the model after it is trained on."""
    specs, rows = table(spark, folder, "sample_specs").select("batch_no", "round_label").distinct(), table(spark, folder, "selections").select("batch_no")
    by_label = {label: rows.join(specs.where(F.col("round_label") == label), "batch_no") for label in labels_up_to(2)}
    parts = [reduce(DataFrame.unionByName, (by_label[x] for x in labels_up_to(i))).agg(F.lit(i).alias("round"), F.count(F.lit(1)).alias("rows")) for i in range(3)]
    return reduce(DataFrame.unionByName, parts)


class Logistic:
    """A model with fixed weights."""

    def predict_proba(self, x):
        p = 1 / (1 + np.exp(-(x[:, 4] - 0.5 * x[:, 1])))
        return np.stack([1 - p, p], 1)


def model_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of an external model over one feature; null where a value is missing."""
    rows = scored_by(table(spark, folder, "features").where("size(cns_mpo) = 5 and cns_mpo_valid"), Logistic(), ["cns_mpo"])
    return rows.select("vec_no", F.round(F.col("score").cast("double"), 3).alias("score"))


def docking_statuses(spark: SparkSession, folder: str) -> DataFrame:
    """Ligands by the status of their docking, where structures with boron or bromine break the call they are in."""
    rows = with_conformers(table(spark, folder, "candidates").select("id", "smiles"), stand_in_conformer)
    return docked(rows, HashedDocking(modes=2, bad="B "), "M", "M:1").groupBy("status").agg(F.count(F.lit(1)).alias("rows"))


PACK_LIMIT = 200_000


def pack_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Pose files packed into batches in the order of their paths."""
    return packing.packed(table(spark, folder, "pose_files"), PACK_LIMIT, size="size_bytes")


def shard_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Five feature rows of every shard."""
    return sampling.sampled(table(spark, folder, "features").select("vec_no", "shard_id"), 5, key="vec_no")


def sample_clip(spark: SparkSession, folder: str) -> DataFrame:
    """A sample larger than its shards, which gives all rows."""
    rows = sampling.sampled(table(spark, folder, "features").select("vec_no", "shard_id"), 1_000_000, key="vec_no")
    return rows.groupBy("shard_id").agg(F.count(F.lit(1)).alias("rows"))


def train_test_split(spark: SparkSession, folder: str) -> DataFrame:
    """Feature rows by the part they train or test."""
    return sampling.split(table(spark, folder, "features").select("vec_no"), key="vec_no")


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "features").where(F.coalesce("cns_mpo_valid", F.lit(False)))
    return rows.select("vec_no", "id", "shard_id", F.get("cns_mpo", F.lit(4)).cast("double").alias("score"))


def topk_per_shard(spark: SparkSession, folder: str) -> DataFrame:
    """The five best-scored feature rows of every shard."""
    return sampling.top_scored(_scored(spark, folder), 5, "score", key="vec_no").select("vec_no", "shard_id", "score")


def select_top_random(spark: SparkSession, folder: str) -> DataFrame:
    """Of candidates that no batch selected: the five best of every shard and three random others."""
    rest = sampling.not_selected(_scored(spark, folder), table(spark, folder, "selections"))
    return sampling.select_top_and_random(rest, 5, 3, "score", key="vec_no").select("vec_no", "shard_id", "selection_group")


def exclude_selected(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates of every source file that no batch selected."""
    rest = sampling.not_selected(table(spark, folder, "candidates").select("id", "source_file"), table(spark, folder, "selections"))
    return rest.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))


def valid_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Feature rows all of whose flags are true."""
    rows = table(spark, folder, "features")
    return rows.where(all_valid(rows)).select("vec_no")


def keep_first_pose(spark: SparkSession, folder: str) -> DataFrame:
    """The first written pose of every ligand at every site."""
    rows = table(spark, folder, "docking_results").select("id", "site_id", "mode", "pose_no")
    return cleaning.keep_first(rows, ["id", "site_id"], [F.col("mode"), F.col("pose_no")]).select("pose_no")


def _training(spark: SparkSession, folder: str) -> DataFrame:
    labels_ = table(spark, folder, "docking_results").select("id", "mode", "pose_no", "affinity_kcal_mol")
    return cleaning.training_rows(table(spark, folder, "features"), labels_, [F.col("vec_no")], [F.col("mode"), F.col("pose_no")])


def training_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Valid features joined with the first negative label of each ligand."""
    return _training(spark, folder).select("id", "vec_no", "pose_no", "affinity_kcal_mol")


def aligned_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Feature rows against candidate rows of the same place: how many have the same id."""
    left = table(spark, folder, "features").select(F.col("vec_no").alias("place"), "id")
    right = table(spark, folder, "candidates").select(F.col("row_no").alias("place"), "id")
    return cleaning.aligned(left, right, "place").groupBy("same").agg(F.count(F.lit(1)).alias("rows"))


def alignment_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Ids that features or candidates alone have."""
    return cleaning.difference(table(spark, folder, "features"), table(spark, folder, "candidates"), "id")


def negative_affinities(spark: SparkSession, folder: str) -> DataFrame:
    """Docking rows with a negative affinity at every site."""
    return cleaning.negative(table(spark, folder, "docking_results")).groupBy(*SITE).agg(F.count(F.lit(1)).alias("rows"))


def active_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest-rank first percentile of negative affinities of every site."""
    rows = cleaning.negative(table(spark, folder, "docking_results").select(*SITE, "affinity_kcal_mol"))
    return labels.nearest_quantile(rows, "affinity_kcal_mol", 1.0, SITE)


def label_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """How many docking rows are active by the fifth percentile of their site."""
    rows = table(spark, folder, "docking_results").select(*SITE, "affinity_kcal_mol")
    limits = labels.nearest_quantile(cleaning.negative(rows), "affinity_kcal_mol", 5.0, SITE)
    return labels.histogram(labels.labelled(rows, limits, "affinity_kcal_mol", SITE))


def enrichment_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """How well the property score finds ligands of an affinity of -8 or below."""
    rows = _training(spark, folder).select("id", F.get("cns_mpo", F.lit(4)).alias("score"), (F.col("affinity_kcal_mol") <= -8).cast("int").alias("active"))
    return labels.enrichment(rows, "score", "active", "id")


def flatten_features(spark: SparkSession, folder: str) -> DataFrame:
    """All features of a valid row as one vector: its length, its first and last value, and that where the features meet."""
    rows = table(spark, folder, "features")
    flat = rows.where(all_valid(rows)).withColumn("x", flattened(rows, ["cns_mpo", "usrcat", "shard_id"])).where("x is not null")
    at = lambda i: F.get("x", i)
    return flat.select("vec_no", F.size("x").alias("width"), at(F.lit(0)).alias("first"), at(F.size("cns_mpo")).alias("middle"), at(F.size("x") - 1).alias("last"))


def _properties(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "features").where(F.coalesce("cns_mpo_valid", F.lit(False)) & (F.size("cns_mpo") == 5))
    return rows.select("vec_no", *(F.col("cns_mpo")[i].cast("double").alias(c) for i, c in enumerate(("mw", "clogd", "tpsa", "hbd"))))


def desirability_terms(spark: SparkSession, folder: str) -> DataFrame:
    """The desirability of every property."""
    return _properties(spark, folder).select("vec_no", *(F.round(scores.desirability(c, c), 9).alias(c) for c in scores.CURVES))


def mpo_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The property score of molecules without charged nitrogen."""
    score = scores.mpo_score(F.col("mw"), F.col("clogd"), F.col("tpsa"), F.col("hbd"), F.lit(False))
    return _properties(spark, folder).select("vec_no", F.round(score, 9).alias("score"))


def search_boxes(spark: SparkSession, folder: str) -> DataFrame:
    """The edge of every site's search box."""
    return sites.search_boxes(table(spark, folder, "binding_sites")).select("site_id", F.round("edge", 6).alias("edge"))


def pocket_radius(spark: SparkSession, folder: str) -> DataFrame:
    """Radii of pockets whose atoms are the points of a site, with one atom that the structure lacks."""
    cloud = table(spark, folder, "binding_sites").where("extent.kind = 'point_cloud' and size(center) = 3")
    atoms = cloud.select(F.col("site_id").alias("member_id"), F.posexplode("extent.points").alias("serial", "p")).select("member_id", "serial", *(F.col("p")[i].alias(a) for i, a in enumerate("xyz")))
    serials = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.size("extent.points") - 1), lambda i: i.cast("string")), F.lit("99999"))
    pockets = cloud.select(
        F.col("site_id").alias("member_id"), F.lit("1").alias("rank"), *(F.col("center")[i].cast("string").alias(f"center_{a}") for i, a in enumerate("xyz")),
        F.coalesce("pocket_score", F.lit(0.0)).cast("string").alias("score"), F.lit("0.5").alias("probability"), serials.alias("surf_atom_ids"),
    )
    return sites.pocket_sites(pockets, atoms, "cloud").select("site_id", F.round("radius", 6).alias("radius"), "missing")


def pocket_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Sites with a pocket score of ten or more."""
    return cleaning.at_least(table(spark, folder, "binding_sites"), "pocket_score", 10.0).select("site_id")


def sites_flatten(spark: SparkSession, folder: str) -> DataFrame:
    """Sites nested by ensemble and flattened again."""
    return sites.flattened(sites.nested(table(spark, folder, "binding_sites").select("ensemble_id", "member_id", "site_id", "center", "pocket_score")))


def ensemble_slugs(spark: SparkSession, folder: str) -> DataFrame:
    """Ensembles by the name they have in paths."""
    return table(spark, folder, "binding_sites").select("ensemble_id", names.slug("ensemble_id").alias("slug")).distinct()


def member_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Structure ids of lists that are written untidily."""
    listed = table(spark, folder, "binding_sites").select(F.concat(F.lower("member_id"), F.lit(" , ,"), "member_id", F.lit(",")).alias("l"))
    return listed.select(F.explode(names.structure_ids("l")).alias("structure")).groupBy("structure").agg(F.count(F.lit(1)).alias("times"))


def vina_records(spark: SparkSession, folder: str) -> DataFrame:
    """Result lines of all pose files."""
    return pose_records(table(spark, folder, "pose_files").select("file_no", "content")).drop("text")


def best_pose(spark: SparkSession, folder: str) -> DataFrame:
    """The first pose of every ligand at every site in its files."""
    rows = pose_records(table(spark, folder, "pose_files").select("file_no", "id", "site_id", "content")).drop("text")
    first = cleaning.keep_first(rows, ["id", "site_id"], [F.col(c) for c in ("mode", "affinity_kcal_mol", "file_no")])
    return first.select("id", "site_id", "mode", "affinity_kcal_mol")


def empty_files(spark: SparkSession, folder: str) -> DataFrame:
    """Pose files with and without content."""
    return cleaning.empty_count(table(spark, folder, "pose_files"), "content")


def missing_pose_files(spark: SparkSession, folder: str) -> DataFrame:
    """Docking rows by whether the pose file they name is there."""
    rows = table(spark, folder, "docking_results").select(F.col("pose_pdbqt").alias("path")).where("path <> ''")
    present, absent = cleaning.present_and_absent(rows, table(spark, folder, "pose_files"), ["path"])
    both = present.withColumn("present", F.lit(True)).unionByName(absent.withColumn("present", F.lit(False)))
    return both.groupBy("present").agg(F.count(F.lit(1)).alias("rows"))


def duplicated_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Pose files that are listed more than once."""
    return cleaning.duplicated(table(spark, folder, "pose_files"), ["path"])


def site_rounds(spark: SparkSession, folder: str) -> DataFrame:
    """Every site in every round: the tasks of a screen, from two control tables of fixed size."""
    rounds = [r[0] for r in table(spark, folder, "sample_specs").select("round_label").distinct().collect()]
    return table(spark, folder, "binding_sites").select("site_id", F.explode(F.array(*map(F.lit, rounds))).alias("round_label"))


def file_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Files of the tables with their sizes."""
    return listing(spark, f"{folder}/*.parquet").select("path", "size")


def conformer_features(spark: SparkSession, folder: str) -> DataFrame:
    """Valid features by source file, made by the stand-in providers."""
    rows = with_conformers(table(spark, folder, "candidates").select("row_no", "source_file", "smiles"), stand_in_conformer)
    made = featurized(rows, [HashedFeature("functional_groups"), HashedFeature("whim")])
    return made.groupBy("source_file").agg(F.count_if(all_valid(made)).alias("valid"), F.count(F.lit(1)).alias("rows"))


def stand_in_docking(spark: SparkSession, folder: str) -> DataFrame:
    """Ligands docked by the stand-in provider, by status and mode."""
    rows = with_conformers(table(spark, folder, "candidates").select("id", "smiles"), stand_in_conformer)
    return docked(read_ligands(rows), HashedDocking(), "M", "M:1").groupBy("status", "mode").agg(F.count(F.lit(1)).alias("rows"))


def surrogate_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Feature rows scored by a surrogate that was trained on docked ones."""
    rows = _training(spark, folder)
    limit = labels.nearest_quantile(rows, "affinity_kcal_mol", 10.0)
    model = trained(prepared(labels.labelled(rows, limit, "affinity_kcal_mol"), ["usrcat"], width=60), Settings())
    return scored(table(spark, folder, "features"), model, ["usrcat"]).select("vec_no", "eligible", "score")


def active_rounds(spark: SparkSession, folder: str) -> DataFrame:
    """Two rounds of active learning with stand-in docking: rows selected and labelled in each."""
    candidates = cleaning.keep_first(table(spark, folder, "features").where("id is not null"), ["id"], [F.col("vec_no")])

    def dock(rows: DataFrame) -> DataFrame:
        found = docked(rows.select("id", F.col("id").alias("conformer")), HashedDocking(), "M", "M:1")
        return found.where("status = 'docked'").select("id", "mode", "affinity_kcal_mol")

    out = run_rounds(candidates, dock, [Round(0, 8), Round(4, 4)], 8, 20.0, ["usrcat"], settings=Settings(), width=60)
    parts = [rows.agg(F.lit(label).alias("label"), F.count(F.lit(1)).alias("rows")) for label, rows in out.selections.items()]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        p2_found, p2_records, shard_counts, blake3_shard_counts, missing_shards, unexpected_shards, smi_parse, merge_tranches, written_shards, written_results, pocket_table, site_documents, pack_batches,
        written_sample, atoms_of_structures, taken_places, screen_threshold, rounds_so_far, model_scores, docking_statuses,
        shard_sample, sample_clip, train_test_split, topk_per_shard, select_top_random, exclude_selected, valid_rows, keep_first_pose,
        training_rows, aligned_rows, alignment_diff, negative_affinities, active_thresholds, label_histogram, enrichment_metrics,
        flatten_features, desirability_terms, mpo_scores, search_boxes, pocket_radius, pocket_filter, sites_flatten, ensemble_slugs,
        member_lists, vina_records, best_pose, empty_files, missing_pose_files, duplicated_paths, site_rounds, file_listing,
        conformer_features, stand_in_docking, surrogate_scores, active_rounds,
    )
}
