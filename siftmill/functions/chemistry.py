"""Providers that need chemistry libraries, each behind its imports, and the registries that name them."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Sequence
from pathlib import Path

import numpy as np

from .commands import CommandDocking, box_arguments
from .features import FEATURES
from .providers import DockingProvider, FeatureProvider, FingerprintFeature, ProviderNotAvailable
from .scores import CURVES

#: Of a conformer, the seed, the rounds of embedding and of relaxing, and the protonation variants that are made.
SEED, EMBED_ROUNDS, RELAX_ROUNDS, VARIANTS = 1000, 50, 50, 4


def _imported(name: str, what: str):
    try:
        return importlib.import_module(name)
    except ImportError as e:
        raise ProviderNotAvailable(f"{what} needs the module {name}") from e


class Conformers:
    """Builds the text of a molecule with hydrogens and places in space; None where that fails.

    The first protonation variant is taken, or the structure as it is. A relaxation that doesn't end in time is
    good enough, one that can't begin isn't.
    """

    needs = ("rdkit.Chem.AllChem", "dimorphite_dl")

    def require(self) -> Conformers:
        for module in self.needs:
            _imported(module, "conformers")
        return self

    def __call__(self, structure: str) -> str | None:
        chem, all_chem, protons = _imported("rdkit.Chem", "conformers"), _imported("rdkit.Chem.AllChem", "conformers"), _imported("dimorphite_dl", "conformers")
        charged = protons.protonate_smiles(structure, validate_output=True, max_variants=VARIANTS)
        molecule = chem.MolFromSmiles(charged[0] if charged else structure)
        if molecule is None:
            return None
        molecule = chem.AddHs(molecule)
        rules = all_chem.ETKDGv3()
        rules.randomSeed, rules.maxIterations = SEED, EMBED_ROUNDS
        if all_chem.EmbedMolecule(molecule, rules) < 0 or all_chem.MMFFOptimizeMolecule(molecule, maxIters=RELAX_ROUNDS) < 0:
            return None
        return chem.MolToMolBlock(molecule)


class PropertyScore(FeatureProvider):
    """The five numbers of a property score: weight, lipophilicity, polar surface, donors, and the score of all with the charge term."""

    name, needs = "cns_mpo", ("rdkit",)

    def vectors(self, structures: list[str]) -> list[list[float] | None]:
        chem, numbers = _imported("rdkit.Chem", self.name), _imported("rdkit.Chem.rdMolDescriptors", self.name)
        out: list[list[float] | None] = []
        for text in structures:
            molecule = chem.MolFromMolBlock(text) if "\n" in text else chem.MolFromSmiles(text)
            if molecule is None:
                out.append(None)
                continue
            weight, fat = numbers.CalcExactMolWt(molecule), numbers.CalcCrippenDescriptors(molecule)[0]
            surface, donors = numbers.CalcTPSA(molecule), float(numbers.CalcNumHBD(molecule))
            charged = any(a.GetSymbol() == "N" and a.GetFormalCharge() > 0 for a in molecule.GetAtoms())
            out.append([weight, fat, surface, donors, property_score(weight, fat, surface, donors, charged)])
        return out


def property_score(mw: float, clogd: float, tpsa: float, hbd: float, charged: bool) -> float:
    """The same score as functions.scores gives for columns, for single numbers."""
    terms = {n: float(np.interp(v, *zip(*CURVES[n], strict=True))) for n, v in (("mw", mw), ("clogd", clogd), ("tpsa", tpsa), ("hbd", hbd))}
    return 2 * terms["clogd"] + terms["mw"] + terms["tpsa"] + terms["hbd"] + (0.0 if charged else 1.0)


#: The library's class and options of every feature but the property score.
FINGERPRINTS: dict[str, tuple[str, dict[str, object]]] = {
    "atom_pair": ("AtomPairFingerprint", {"fp_size": 2048, "count": True}),
    "autocorr": ("AutocorrFingerprint", {"use_3D": True}),
    "descriptors": ("RDKit2DDescriptorsFingerprint", {}),
    "e3fp": ("E3FPFingerprint", {"fp_size": 1024}),
    "ecfp": ("ECFPFingerprint", {"fp_size": 1024}),
    "electroshape": ("ElectroShapeFingerprint", {}),
    "functional_groups": ("FunctionalGroupsFingerprint", {"count": True}),
    "morse": ("MORSEFingerprint", {}),
    "pharmacophore_3d": ("PharmacophoreFingerprint", {"fp_size": 1024, "use_3D": True, "variant": "folded"}),
    "rdf": ("RDFFingerprint", {}),
    "topological_torsion": ("TopologicalTorsionFingerprint", {"fp_size": 2048, "count": True}),
    "usrcat": ("USRCATFingerprint", {}),
    "whim": ("WHIMFingerprint", {}),
}


def feature_provider(name: str, **options: object) -> FeatureProvider:
    """The provider of a feature by its name; options go to its library. An unknown name is an error that lists the known ones."""
    if name == PropertyScore.name:
        return PropertyScore()
    if name not in FINGERPRINTS:
        raise ValueError(f"there is no feature {name}; there are {', '.join(sorted(FEATURES))}")
    transformer, fixed = FINGERPRINTS[name]
    return FingerprintFeature(name, transformer, **{**fixed, **options})


def feature_providers(names: Sequence[str]) -> list[FeatureProvider]:
    """Providers of several features, each once; no name is an error."""
    if not names:
        raise ValueError("no features")
    return [feature_provider(n) for n in dict.fromkeys(names)]


def prepared_ligand(conformer: str) -> str:
    """A conformer as PDBQT text; one that can't be prepared is an error."""
    chem, meeko = _imported("rdkit.Chem", "ligand preparation"), _imported("meeko", "ligand preparation")
    molecule = chem.MolFromMolBlock(conformer, removeHs=False)
    setups = meeko.MoleculePreparation().prepare(molecule) if molecule is not None else []
    if not setups:
        raise ValueError("the ligand gives no setup")
    text, good, reason = meeko.PDBQTWriterLegacy.write_string(setups[0])
    if not good:
        raise ValueError(f"the ligand can't be written: {reason}")
    return text


def prepared_receptor(structure: str, altloc: str = "A", allow_bad_residues: bool = False) -> str:
    """A protein structure (PDB text) as rigid PDBQT text."""
    meeko = _imported("meeko", "receptor preparation")
    chemistry = meeko.ResidueChemTemplates.create_from_defaults()
    made = meeko.Polymer.from_pdb_string(structure, chemistry, meeko.MoleculePreparation(), allow_bad_res=allow_bad_residues, default_altloc=altloc)
    rigid, _ = meeko.PDBQTWriterLegacy.write_from_polymer(made)
    return rigid


class GpuDocking(CommandDocking):
    """Docks batches of ligands with one call of the program `unidock`, into a box around a site's centre."""

    name = "gpu"

    def __init__(self, receptor: str, center: Sequence[float], edges: Sequence[float], mode: str = "balance", scoring: str = "vina", modes: int = 9) -> None:
        def command(files: list[Path], out: Path) -> list[str]:
            path = out.parent / "receptor.pdbqt"
            path.write_text(receptor)
            box = box_arguments(center, edges)
            return ["--receptor", str(path), "--gpu_batch", *map(str, files), "--search_mode", mode, "--scoring", scoring, *box, "--num_modes", str(modes), "--dir", str(out)]

        super().__init__("unidock", command, prepared_ligand)

    def require(self) -> None:
        super().require()
        for module in ("rdkit", "meeko"):
            _imported(module, self.name)


DOCKING: dict[str, Callable[..., DockingProvider]] = {"gpu": GpuDocking}


def docking_provider(name: str, **options: object) -> DockingProvider:
    """A docking provider by its name; an unknown one is an error that lists the known ones."""
    if name not in DOCKING:
        raise ValueError(f"there is no docking provider {name}; there are {', '.join(sorted(DOCKING))}")
    return DOCKING[name](**options)
