"""Feature columns: widths, placeholders, validity and flattening."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Feature:
    """A fixed-width feature: its element type, its width (None: given by the library), its placeholder value."""

    name: str
    element: str
    width: int | None
    placeholder: float = 0.0


#: The features of a feature table.
FEATURES: dict[str, Feature] = {
    f.name: f
    for f in (
        Feature("atom_pair", "int", 2048),
        Feature("autocorr", "float", 80),
        Feature("cns_mpo", "float", 5, float("nan")),
        Feature("descriptors", "float", None),
        Feature("e3fp", "smallint", 1024),
        Feature("ecfp", "smallint", 1024),
        Feature("electroshape", "float", 15),
        Feature("functional_groups", "smallint", 85),
        Feature("morse", "float", 224),
        Feature("pharmacophore_3d", "smallint", 1024),
        Feature("rdf", "float", 210),
        Feature("topological_torsion", "int", 2048),
        Feature("usrcat", "float", 60),
        Feature("whim", "float", 114),
    )
}
#: The features a surrogate may be trained on.
TRAINABLE = ("atom_pair", "autocorr", "descriptors", "ecfp", "functional_groups", "morse", "rdf", "topological_torsion", "usrcat", "whim")


def valid_columns(frame: DataFrame) -> list[str]:
    return [c for c in frame.columns if c.endswith("_valid")]


def all_valid(frame: DataFrame, none: bool = True) -> Column:
    """Whether every `_valid` column of the frame is true; a null is not. `none` holds if there are no such columns."""
    flags = [F.coalesce(F.col(c), F.lit(False)) for c in valid_columns(frame)]
    if not flags:
        return F.lit(none)
    out = flags[0]
    for f in flags[1:]:
        out &= f
    return out


def flattened(frame: DataFrame, columns: Sequence[str]) -> Column:
    """The columns, numbers or arrays of numbers, as one array<double> in the given order; null if one is null."""
    if not columns:
        raise ValueError("no feature columns")
    kinds = dict(frame.dtypes)
    parts = [F.col(c).cast("array<double>") if kinds[c].startswith("array") else F.array(F.col(c).cast("double")) for c in columns]
    there = F.lit(True)
    for c in columns:
        there &= F.col(c).isNotNull()
    return F.when(there, F.concat(*parts))
