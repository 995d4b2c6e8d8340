"""The pN_ queries: each takes a session and a data folder and runs over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.runs import MB
from ..runtime import materialize, table
from .abuse import score_documents, source_rates
from .cutoff import cutoffs, kept_rows
from .folded import folded_copies, folded_records
from .incremental import repeated_rows
from .mixing import mix
from .neighbours import nearest_pairs
from .poses import counting_rows
from .tokens import token_ids
from .topn import top_n


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of feature rows of which one is among the five nearest of the other."""
    return nearest_pairs(table(spark, folder, "features"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Candidate rows that repeat an earlier row under another spelling."""
    return folded_copies(table(spark, folder, "candidates")).where("row_no <> first_row_no")


def p3_records(spark: SparkSession, folder: str) -> DataFrame:
    """Candidate records that occur more than once, with their number of rows."""
    return folded_records(folded_copies(table(spark, folder, "candidates")))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of new sampling batches that repeat an accepted row; the history comes in two runs, which are merged."""
    return repeated_rows(table(spark, folder, "selections"), table(spark, folder, "sample_specs"), parts=2, sizes=(8 * MB, 2, 4))


SITE = ("member_id", "site_id")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Counting docking rows at or below their source's cutoff."""
    rows = counting_rows(table(spark, folder, "docking_results")).select("pose_no", *SITE, "affinity_kcal_mol")
    rows = materialize(rows, "counting-rows")  # both the sums and the kept rows are read from it
    cuts = cutoffs(rows, table(spark, folder, "cutoff_targets"), SITE, "affinity_kcal_mol")
    return kept_rows(rows, cuts, SITE, "affinity_kcal_mol").select("pose_no")


def p5_cutoffs(spark: SparkSession, folder: str) -> DataFrame:
    """The cutoff of every source with a target, with the numbers of rows kept and in all."""
    rows = counting_rows(table(spark, folder, "docking_results"))
    cuts = cutoffs(rows, table(spark, folder, "cutoff_targets"), SITE, "affinity_kcal_mol")
    return cuts.select(*SITE, F.col("permille").cast("long").alias("permille"), "cutoff", "kept", "total")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """The three best counting poses of every ligand over all sites."""
    rows = counting_rows(table(spark, folder, "docking_results"))
    order = [F.col(c).asc() for c in ("affinity_kcal_mol", "site_id", "mode", "pose_no")]
    return top_n(rows.select("id", "affinity_kcal_mol", "site_id", "mode", "pose_no"), ["id"], order, 3).select("pose_no")


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as token ids of byte_bpe_50k."""
    return table(spark, folder, "documents").select("doc_id", token_ids("text").alias("ids"))


def p8_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """The texts of the mixture of mix_targets and how often each is used."""
    return mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets")).chosen


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Target and actual shares of the sources of that mixture."""
    return mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets")).report


def p8_goals(spark: SparkSession, folder: str) -> DataFrame:
    """The shares the mixture goes for: those of the targets, spread over the sources that have texts."""
    report = mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets")).report
    return report.select("source", "target_share", "max_repeats", F.round("share", 9).alias("share"))


def p8_repeated(spark: SparkSession, folder: str) -> DataFrame:
    """Shares of a mixture of four times the largest size at which all quotas are met: small sources are repeated as often as they may be."""
    return mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets"), stretch=4.0).report


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with abusive, hateful or sexual content."""
    return score_documents(table(spark, folder, "documents")).where("flagged").select("doc_id")


def p9_rates(spark: SparkSession, folder: str) -> DataFrame:
    """The rate of such documents in every source."""
    return source_rates(score_documents(table(spark, folder, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p3_found, p3_records, p4_found, p5_found, p5_cutoffs, p6_found, p7_ids, p8_mixture, p8_shares, p8_goals, p8_repeated, p9_found, p9_rates)
}
