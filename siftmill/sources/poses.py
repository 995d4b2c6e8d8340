"""The sink and the reader of docking results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULTS = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("member_id", T.StringType(), False),
        T.StructField("site_id", T.StringType(), False),
        T.StructField("mode", T.IntegerType(), False),
        T.StructField("affinity_kcal_mol", T.DoubleType(), False),
        T.StructField("rmsd_lb", T.DoubleType()),
        T.StructField("rmsd_ub", T.DoubleType()),
        T.StructField("pose_pdbqt", T.StringType(), False),
    ]
)
#: Fixed value: the name results have inside of a folder.
FILE_NAME = "docking.results.parquet"


def results_path(path: str) -> str:
    """The path of results: as given if it names a Parquet file, else inside of the folder."""
    return path if path.endswith(".parquet") else f"{path.rstrip('/')}/{FILE_NAME}"


def write_results(results: DataFrame, path: str, poses: bool = False) -> int:
    """Writes docked rows under the schema of results, without pose texts unless asked for; the number of rows.

    Rows with a null in a column that mustn't have one are left out. An empty table is written too, so that
    the file exists with its schema.
    """
    required = [f.name for f in RESULTS if not f.nullable and f.name != "pose_pdbqt"]
    fit = results.where(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in required)))  # NaN is no null
    text = F.coalesce("pose_pdbqt", F.lit("")) if poses and "pose_pdbqt" in results.columns else F.lit("")
    out = fit.select(*(F.col(f.name).cast(f.dataType) if f.name != "pose_pdbqt" else text.alias("pose_pdbqt") for f in RESULTS))
    seen = Observation()
    out.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", "zstd").parquet(results_path(path))
    return seen.get["rows"]


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESULTS).parquet(results_path(path))


def read_ligands(frame: DataFrame, key: str = "id", structure: str = "conformer") -> DataFrame:
    """`id, conformer` of rows with a structure; a missing column is an error, null and empty structures are skipped."""
    lacking = sorted({key, structure} - set(frame.columns))
    if lacking:
        raise ValueError(f"ligands lack columns {lacking}; they have {frame.columns}")
    return frame.select(F.col(key).alias("id"), F.col(structure).alias("conformer")).where(F.col("conformer").isNotNull() & (F.col("conformer") != ""))
