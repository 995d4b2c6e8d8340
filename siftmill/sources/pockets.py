"""Pocket predictions, atoms of structures, and site documents."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns that a table of pocket predictions must have.
POCKET_COLUMNS = ("name", "rank", "score", "probability", "sas_points", "surf_atoms", "center_x", "center_y", "center_z", "residue_ids", "surf_atom_ids")


def site_schema() -> str:
    """The schema of a document of binding sites, as DDL."""
    return (  # fixed values of the format
        "ensemble_id string, binding_sites array<struct<schema_version: string, site_id: string, member_id: string, center: array<double>, "
        "extent: struct<kind: string, center: array<double>, radius: double, points: array<array<double>>>, "
        "lining_residues: array<struct<chain: string, resid: int, resname: string>>, pocket_score: double, weight: double, "
        "correspondence_cluster: string, provenance: map<string, string>>>"
    )


def trimmed_pockets(raw: DataFrame) -> DataFrame:
    """Header names and cells without white space around; a missing column of POCKET_COLUMNS is an error, extra ones stay."""
    names = {c: c.strip() for c in raw.columns}
    missing = sorted(set(POCKET_COLUMNS) - set(names.values()))
    if missing:
        raise ValueError(f"pocket predictions lack columns {missing}; they have {sorted(names.values())}")
    return raw.select(*(F.regexp_replace(F.col(f"`{c}`"), r"^\s+|\s+$", "").alias(n) for c, n in names.items()))


def read_pockets(spark: SparkSession, path: str) -> DataFrame:
    """A table of pocket predictions, all columns as trimmed text."""
    return trimmed_pockets(spark.read.csv(path, header=True, inferSchema=False))


def atoms_of(structures: DataFrame, text: str = "content") -> DataFrame:
    """Atoms of structure texts in fixed columns: the other columns, then `serial, x, y, z`.

    Only the first model counts; of a serial that occurs again the last place holds. Texts without models are
    one model. Lines that aren't atoms, and atoms whose numbers can't be read, are left out.
    """
    others = [c for c in structures.columns if c != text]
    first = F.regexp_replace(F.regexp_replace(F.col(text), r"\r\n?", "\n"), r"(?s)(?<=\n)ENDMDL.*$", "")
    lines = structures.where(F.col(text).isNotNull()).select(*others, F.posexplode(F.split(first, "\n")).alias("__at", "__line"))
    cut = lambda a, n: F.trim(F.substring("__line", a, n))
    atoms = lines.where(F.col("__line").rlike("^(ATOM|HETATM)")).select(
        *others, "__at", F.try_to_number(cut(7, 5), F.lit("99999")).cast("int").alias("serial"), *(cut(a, 8).try_cast("double").alias(n) for a, n in ((31, "x"), (39, "y"), (47, "z")))
    )
    read = atoms.where(F.col("serial").isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull())
    return read.groupBy(*others, "serial").agg(F.max_by(F.struct("x", "y", "z"), "__at").alias("__p")).select(*others, "serial", "__p.x", "__p.y", "__p.z")


#: Of a structure in the newer format: values in quotes, or up to the next white space.
_VALUES = re.compile(r"""'(?:[^']|'(?=\S))*'|"(?:[^"]|"(?=\S))*"|\S+""")


def cif_atoms(text: str) -> list[tuple[int, float, float, float]]:
    """Atoms of a structure in mmCIF: serial and place, of the first model, the last place of a serial that occurs again."""
    lines = iter(text.splitlines())
    columns: list[str] = []
    found: dict[int, tuple[float, float, float]] = {}
    model = None
    for line in lines:
        if line.startswith("_atom_site."):
            columns.append(line.split()[0][len("_atom_site.") :])
        elif columns:
            values = _VALUES.findall(line)
            if not values or line.startswith(("#", "loop_", "_", "data_")):
                break
            row = dict(zip(columns, values, strict=False))
            model = row.get("pdbx_PDB_model_num") if model is None else model
            try:
                if row.get("pdbx_PDB_model_num") == model:
                    found[int(row["id"])] = (float(row["Cartn_x"]), float(row["Cartn_y"]), float(row["Cartn_z"]))
            except (KeyError, ValueError):
                continue
    return [(serial, *place) for serial, place in found.items()]


def cif_atoms_of(structures: DataFrame, text: str = "content") -> DataFrame:
    """Atoms of structures in mmCIF: the other columns, then `serial, x, y, z`; texts without atoms give none."""

    @F.pandas_udf("array<struct<serial: int, x: double, y: double, z: double>>")
    def parse(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [dict(zip(("serial", "x", "y", "z"), a, strict=True)) for a in cif_atoms(t)] if t else [])

    others = [c for c in structures.columns if c != text]
    return structures.select(*others, F.explode(parse(text)).alias("__a")).select(*others, "__a.*")


def structure_atoms(structures: DataFrame, text: str = "content") -> DataFrame:
    """Atoms of structure texts in either format, as they are downloaded: those with an `_atom_site` table are mmCIF."""
    newer = F.coalesce(F.col(text).contains("_atom_site."), F.lit(False))
    return atoms_of(structures.where(~newer), text).unionByName(cif_atoms_of(structures.where(newer), text))


def read_sites(spark: SparkSession, path: str, ensemble: str) -> DataFrame:
    """The sites of one ensemble's document, one row each; another ensemble's document or one without sites is an error."""
    document = spark.read.schema(site_schema()).json(path, multiLine=True)
    head = document.select("ensemble_id", F.size("binding_sites").alias("n")).first()
    if head is None or head["ensemble_id"] != ensemble:
        raise ValueError(f"{path} is not of ensemble {ensemble} but of {head and head['ensemble_id']}")
    if not head["n"] or head["n"] < 0:
        raise ValueError(f"{path} has no sites")
    return document.select("ensemble_id", F.explode("binding_sites").alias("s")).select("ensemble_id", "s.*")
