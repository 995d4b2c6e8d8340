"""Docking output text: blocks opened by MODEL lines, result lines with three numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What opens a block, and what a result line says.
BLOCK_START = "MODEL"
RESULT_LINE = r"(?m)^REMARK VINA RESULT:\s*(-?\d+\.?\d*)[^\S\n]+(-?\d+\.?\d*)[^\S\n]+(-?\d+\.?\d*)"


def pose_blocks(content: Column) -> Column:
    """The blocks of a content with unified line ends, each from its MODEL line to the next."""
    return F.split(F.regexp_replace(content, r"\r\n?", "\n"), rf"(?m)^(?={BLOCK_START})", -1)


def pose_records(files: DataFrame, content: str = "content") -> DataFrame:
    """One row for each result line of each file: the file's other columns, then
    `mode, affinity_kcal_mol, rmsd_lb, rmsd_ub, text`.

    `mode` is the number of MODEL lines so far, but at least 1, and `text` the whole block. Null, empty and
    broken contents give the records they still hold, maybe none. Line ends may be of any kind and differ
    in one content; they don't make texts differ. Runs inside the JVM, without a shuffle. Columns of the
    files that are called as one of the five would clash and are an error.
    """
    others = [c for c in files.columns if c != content]
    clash = {"mode", "affinity_kcal_mol", "rmsd_lb", "rmsd_ub", "text"} & {c.lower() for c in others}
    if clash:
        raise ValueError(f"columns that clash with those of records: {sorted(clash)}")
    blocks = files.where(F.col(content).isNotNull()).select(*others, pose_blocks(F.col(content)).alias("__blocks"))
    first = F.when(F.col("__blocks")[0].startswith(BLOCK_START), 1).otherwise(0).alias("__first")
    opened = blocks.select(*others, first, F.posexplode("__blocks").alias("__place", "text"))
    found = opened.select(
        *others,
        F.greatest(F.lit(1), F.col("__place") + F.col("__first")).cast("int").alias("mode"),
        "text",
        F.explode(F.arrays_zip(*(F.regexp_extract_all("text", F.lit(RESULT_LINE), F.lit(k)).alias(n) for k, n in ((1, "a"), (2, "l"), (3, "u"))))).alias("__r"),
    )
    return found.select(
        *others,
        "mode",
        F.col("__r.a").cast("double").alias("affinity_kcal_mol"),
        F.col("__r.l").cast("double").alias("rmsd_lb"),
        F.col("__r.u").cast("double").alias("rmsd_ub"),
        "text",
    )
