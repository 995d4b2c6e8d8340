"""Line sources of candidates: `structure<white space>id` in gzipped text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import source_stem


def parsed_line(line: Column | str) -> tuple[Column, Column]:
    """Structure and id of a stripped line, cut at the first run of white space; the id is null if there is none."""
    parts = F.split(F.regexp_replace(line, r"^\s+|\s+$", ""), r"\s+", 2)
    return parts[0], F.get(parts, F.lit(1))


def parse_lines(lines: DataFrame, column: str = "value", missing: str = "error") -> DataFrame:
    """Adds `smiles` and `id` in place of the line; blank and null lines are dropped.

    A line without id fails the query; with missing="drop" it is left out, with missing="null" its id is null.
    """
    if missing not in ("error", "drop", "null"):
        raise ValueError(f"missing must be error, drop or null, not {missing}")
    structure, name = parsed_line(column)
    out = lines.where(F.col(column).rlike(r"\S")).withColumns({"smiles": structure, "id": name})
    if missing == "error":
        fail = F.raise_error(F.concat(F.lit("line without id: "), F.col(column))).cast("string")
        out = out.withColumn("id", F.coalesce("id", fail))
    elif missing == "drop":
        out = out.where(F.col("id").isNotNull())
    return out.drop(column)


def read_smi(spark: SparkSession, path: str, missing: str = "error") -> DataFrame:
    """`smiles, id, source` of text files, gzipped or not. A gzipped file is one task, so many files make many tasks."""
    lines = spark.read.text(path).withColumn("source", source_stem(F.col("_metadata.file_name")))
    return parse_lines(lines, missing=missing).select("smiles", "id", "source")
