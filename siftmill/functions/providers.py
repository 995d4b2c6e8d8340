"""Batch providers: features, conformers, docking. Each is a Python class that runs inside Arrow batches.

Chemistry libraries are optional. A provider says whether its environment can run it, and is refused with
ProviderNotAvailable before a job starts if not. Stand-ins with the same contract need no library.
"""

from __future__ import annotations

import hashlib
import importlib
import logging
import struct
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .features import FEATURES

log = logging.getLogger(__name__)


class ProviderNotAvailable(RuntimeError):
    """The environment lacks what a provider needs."""


class FeatureProvider(ABC):
    """Turns structures into vectors of one feature. `name` is a key of FEATURES, `needs` the modules to import."""

    name: str
    needs: tuple[str, ...] = ()

    def require(self) -> None:
        for module in self.needs:
            try:
                importlib.import_module(module)
            except ImportError as e:
                raise ProviderNotAvailable(f"{self.name} needs the module {module}") from e

    @abstractmethod
    def vectors(self, structures: list[str]) -> list[list[float] | None]:
        """A vector for each structure, None where there is none."""

    def placeholder(self) -> list[float]:
        feature = FEATURES[self.name]
        return [feature.placeholder] * (feature.width or 1)


class HashedFeature(FeatureProvider):
    """A stand-in of any feature: values drawn from a hash of the structure."""

    def __init__(self, name: str) -> None:
        self.name = name

    def vectors(self, structures: list[str]) -> list[list[float] | None]:
        feature, out = FEATURES[self.name], []
        for s in structures:
            raw = hashlib.shake_256(f"{self.name}:{s}".encode()).digest(feature.width or 1)
            out.append([float(b % 2) for b in raw] if feature.element != "float" else [b / 16 for b in raw])
        return out


class FingerprintFeature(FeatureProvider):
    """A feature of the scikit-fingerprints library by the name of its transformer."""

    needs = ("rdkit", "skfp")

    def __init__(self, name: str, transformer: str, **options: object) -> None:
        self.name, self.transformer, self.options = name, transformer, options

    def vectors(self, structures: list[str]) -> list[list[float] | None]:
        from rdkit import Chem

        made = getattr(importlib.import_module("skfp.fingerprints"), self.transformer)(**self.options)
        out: list[list[float] | None] = []
        for s in structures:
            molecule = Chem.MolFromMolBlock(s) if "\n" in s else Chem.MolFromSmiles(s)
            out.append(None if molecule is None else [float(v) for v in made.transform([molecule])[0]])
        return out


def _checked(provider: FeatureProvider, structures: list[str]) -> list[list[float] | None]:
    """Vectors of the right width, row by row if the batch fails, so that one bad structure spoils its own row only."""
    try:
        vectors = provider.vectors(structures)
    except Exception:
        if len(structures) == 1:
            log.warning("no %s", provider.name, exc_info=True)
            return [None]
        return [v for s in structures for v in _checked(provider, [s])]
    width = FEATURES[provider.name].width
    return [v if v is not None and (width is None or len(v) == width) and not any(x != x for x in v) else None for v in vectors]


def _lists(provider: FeatureProvider, vectors: list[list[float] | None]) -> pa.Array:
    """Vectors as a list column, placeholders in the gaps; NaN stays NaN."""
    filled = [v if v is not None else provider.placeholder() for v in vectors]
    kind = {"float": np.float32, "int": np.int32, "smallint": np.int16}[FEATURES[provider.name].element]
    values = pa.array(np.concatenate([np.asarray(v) for v in filled]).astype(kind), from_pandas=False)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, filled)]).astype(np.int32)), values)


#: Rows that a provider gets at once.
FEATURE_ROWS = 256


def featurized(rows: DataFrame, providers: Sequence[FeatureProvider], structure: str = "conformer") -> DataFrame:
    """Adds for every provider its feature and `<feature>_valid`, and drops the structure columns.

    All providers run over one Arrow pass. A null or empty structure, one that a provider can't handle, and a
    vector of another width or with NaN give the placeholder and false.
    """
    if not providers:
        raise ValueError("no features")
    for p in providers:
        p.require()
    kept = [c for c in rows.columns if c not in (structure, "smiles", "conformer")]
    source = rows.select(*kept, F.col(structure).alias("__structure"))
    schema = T.StructType([source.schema[c] for c in kept])
    for p in providers:
        element = {"float": T.FloatType(), "int": T.IntegerType(), "smallint": T.ShortType()}[FEATURES[p.name].element]
        schema = schema.add(p.name, T.ArrayType(element)).add(f"{p.name}_valid", T.BooleanType())

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for i in range(0, len(whole), FEATURE_ROWS):
                part = whole.slice(i, FEATURE_ROWS)
                structures = part.column(len(kept)).to_pylist()
                there = [k for k, s in enumerate(structures) if s]
                columns = part.columns[: len(kept)]
                for p in providers:
                    vectors: list[list[float] | None] = [None] * len(part)
                    for k, v in zip(there, _checked(p, [structures[k] for k in there]) if there else [], strict=True):
                        vectors[k] = v
                    columns += [_lists(p, vectors), pa.array([v is not None for v in vectors])]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(run, schema)


def with_conformers(rows: DataFrame, build: Callable[[str], str | None], structure: str = "smiles") -> DataFrame:
    """Adds `conformer` built from the structure; an empty text where there is none or building fails."""

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            out = []
            for s in part:
                try:
                    out.append((build(s) or "") if isinstance(s, str) and s else "")
                except Exception:
                    log.warning("no conformer", exc_info=True)
                    out.append("")
            yield pd.Series(out, index=part.index, dtype="object")

    return rows.withColumn("conformer", run(structure))


def stand_in_conformer(structure: str) -> str:
    """A deterministic block of three-dimensional points, one for each letter of a structure."""
    letters = [c for c in structure if c.isalpha()]
    if not letters:
        return ""
    raw = hashlib.shake_256(structure.encode()).digest(6 * len(letters))
    points = (struct.unpack_from("<hhh", raw, 6 * i) for i in range(len(letters)))
    return "\n".join(f"{c} {x / 1000:.3f} {y / 1000:.3f} {z / 1000:.3f}" for c, (x, y, z) in zip(letters, points, strict=True))


class DockingProvider(ABC):
    """Docks ligands into a site. `needs` are modules, `name` is for logs."""

    name: str
    needs: tuple[str, ...] = ()
    #: Ligands that are docked in one call.
    chunk = 1000

    def require(self) -> None:
        for module in self.needs:
            try:
                importlib.import_module(module)
            except ImportError as e:
                raise ProviderNotAvailable(f"{self.name} needs the module {module}") from e

    @abstractmethod
    def dock(self, ligands: list[tuple[str, str]]) -> dict[str, list[tuple[int, float, float | None, float | None, str]]]:
        """Poses (mode, affinity, lower and upper rmsd, text) of ligands (id, conformer), as far as they succeed.

        May raise if a ligand breaks the whole call.
        """


class HashedDocking(DockingProvider):
    """A stand-in: affinities drawn from hashes; conformers that contain `bad` break a call."""

    name = "hashed"

    def __init__(self, modes: int = 3, bad: str = "\0") -> None:
        self.modes, self.bad = modes, bad

    def dock(self, ligands: list[tuple[str, str]]) -> dict[str, list[tuple[int, float, float | None, float | None, str]]]:
        if any(self.bad in c for _, c in ligands):
            raise RuntimeError("docking died")
        out = {}
        for name, conformer in ligands:
            raw = hashlib.sha256(conformer.encode()).digest()
            best = -12 + raw[0] / 24
            out[name] = [(m + 1, round(best + 0.3 * m, 3), 0.0 if not m else raw[m] / 64, 0.0 if not m else raw[m] / 32, "") for m in range(self.modes)]
        return out


def _contained(provider: DockingProvider, ligands: list[tuple[str, str]], again: bool = True) -> Iterator[tuple[str, list | None]]:
    """Results of all ligands: a call that dies is tried once more with what is open, then halved until the culprits stand alone."""
    try:
        found = provider.dock(ligands)
    except Exception as e:
        if again:
            yield from _contained(provider, ligands, False)
        elif len(ligands) == 1:
            log.warning("quarantined %s: %r", ligands[0][0], e)
            yield ligands[0][0], None
        else:
            half = len(ligands) // 2
            yield from _contained(provider, ligands[:half], False)
            yield from _contained(provider, ligands[half:], False)
        return
    yield from ((name, found.get(name, [])) for name, _ in ligands)


DOCKED = "id string, member_id string, site_id string, mode int, affinity_kcal_mol double, rmsd_lb double, rmsd_ub double, pose_pdbqt string, status string"


def docked(ligands: DataFrame, provider: DockingProvider, member: str, site: str, poses: bool = False) -> DataFrame:
    """Poses of ligands (`id, conformer`) at a site, with `status` docked; without pose texts unless asked for.

    A ligand without conformer comes out once as skipped, one that breaks docking as quarantined, one without
    result as missing, each with nulls for the numbers.
    """
    provider.require()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in parts:
            for i in range(0, len(whole), provider.chunk):
                part = whole.iloc[i : i + provider.chunk]
                fit = [(n, c) for n, c in zip(part["id"], part["conformer"], strict=True) if isinstance(c, str) and c]
                out = [(n, member, site, None, None, None, None, "", "skipped") for n, c in zip(part["id"], part["conformer"], strict=True) if not (isinstance(c, str) and c)]
                for name, found in _contained(provider, fit) if fit else []:
                    if found:
                        out += [(name, member, site, m, a, lo, up, text if poses else "", "docked") for m, a, lo, up, text in found]
                    else:
                        out.append((name, member, site, None, None, None, None, "", "missing" if found is not None else "quarantined"))
                frame = pd.DataFrame(out, columns=[c.split()[0] for c in DOCKED.split(", ")])
                yield frame.astype({"mode": "Int32"})

    return ligands.select("id", "conformer").mapInPandas(run, DOCKED)
