"""Screen configuration, checked before anything runs."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from ..functions.features import TRAINABLE

#: How far weights may be off one, and what a structure id looks like.
TOLERANCE = 1e-6
STRUCTURE_ID = re.compile(r"[0-9][A-Za-z0-9]{3}")


class ConfigError(ValueError):
    """A configuration that can't be run; names the field."""


def _check(fine: bool, message: str) -> None:
    if not fine:
        raise ConfigError(message)


def _only(data: dict[str, Any], known: set[str], where: str) -> None:
    _check(isinstance(data, dict), f"{where} must be an object")
    unknown = sorted(set(data) - known)
    _check(not unknown, f"{where} has unknown fields {unknown}")


def _distinct(values: list[str], what: str) -> None:
    twice = sorted({v for v in values if values.count(v) > 1})
    _check(not twice, f"{what} must be unique, but there are several {twice}")


@dataclass(frozen=True)
class Round:
    top: int
    random: int


@dataclass(frozen=True)
class Screen:
    """A screen: its sample of candidates, ensembles of weighted members, and rounds of the surrogate."""

    name: str
    candidates: str
    ensembles: dict[str, dict[str, float]]
    least_pocket_score: float
    features: tuple[str, ...]
    validation: int
    rounds: tuple[Round, ...]
    seed: int
    active_percentile: float
    model: dict[str, float] = field(default_factory=dict)

    @property
    def samples(self) -> int:
        return self.validation + sum(r.top + r.random for r in self.rounds)

    def require_fits(self, sample_features: set[str], sample_size: int) -> None:
        """Fails if the sample lacks features or rows that the screen needs."""
        lacking = sorted(set(self.features) - sample_features)
        _check(not lacking, f"the sample {self.candidates!r} lacks features {lacking}")
        _check(self.samples <= sample_size, f"the screen needs {self.samples} candidates, the sample {self.candidates!r} has {sample_size}")


def screen_of(data: dict[str, Any]) -> Screen:
    """A screen from a parsed document; keys that begin with `x-` are ignored, other unknown ones are errors."""
    data = {k: v for k, v in data.items() if not str(k).startswith("x-")}
    _only(data, {"name", "candidates", "targets", "filter"}, "the screen")
    targets, surrogate = data["targets"], data["filter"]["surrogate"]
    _only(targets, {"ensembles", "min_pocket_score"}, "targets")
    _only(surrogate, {"feature_types", "validation", "rounds", "random_seed", "active_percentile", "hyperparameters"}, "filter.surrogate")
    _check(bool(str(data["name"]).strip()), "name must not be blank")
    _check(len(targets["ensembles"]) > 0, "there must be an ensemble")
    _distinct([str(e["id"]).strip() for e in targets["ensembles"]], "ensemble ids")
    ensembles = {}
    for e in targets["ensembles"]:
        members = [(str(m["pdb_id"]).strip(), float(m["weight"])) for m in e["members"]]
        _distinct([m for m, _ in members], f"members of {e['id']}")
        for m, w in members:
            _check(STRUCTURE_ID.fullmatch(m) is not None, f"{m!r} is no structure id")
            _check(w > 0, f"the weight of {m} must be positive")
        total = sum(w for _, w in members)
        _check(math.isclose(total, 1, abs_tol=TOLERANCE), f"weights of {e['id']} must sum to 1, not {total}")
        ensembles[str(e["id"]).strip()] = dict(members)
    _check(targets["min_pocket_score"] >= 0, "min_pocket_score must not be negative")
    rounds = tuple(Round(int(r.get("top", 0)), int(r["random"])) for r in surrogate["rounds"])
    _check(len(rounds) > 0, "there must be a round")
    _check(all(r.top >= 0 and r.random > 0 for r in rounds), "rounds need a top of 0 or more and a random of 1 or more")
    _check(rounds[0].top == 0, "rounds[0].top must be 0, as there is no model before the first round")
    unknown = sorted(set(surrogate["feature_types"]) - set(TRAINABLE))
    _check(bool(surrogate["feature_types"]) and not unknown, f"features {unknown} can't be trained on")
    _check(surrogate["validation"] > 0, "validation must be positive")
    _check(0 < surrogate["active_percentile"] <= 100, "active_percentile must be above 0 and at most 100")
    return Screen(
        str(data["name"]).strip(), str(data["candidates"]), ensembles, float(targets["min_pocket_score"]), tuple(surrogate["feature_types"]),
        int(surrogate["validation"]), rounds, int(surrogate["random_seed"]), float(surrogate["active_percentile"]), dict(surrogate.get("hyperparameters", {})),
    )


def read_screen(path: str | Path) -> Screen:
    """A screen from a YAML file; needs PyYAML."""
    import yaml

    return screen_of(yaml.safe_load(Path(path).read_text(encoding="utf-8")))


@dataclass(frozen=True)
class Sample:
    """A named sample of the pool: its rows, features, and the folder of each stage."""

    rows: int
    features: tuple[str, ...]
    folders: dict[str, str]


@dataclass(frozen=True)
class Candidates:
    """The pool of candidates: where it lies, how it is sharded, and its samples by name."""

    base: str
    folders: dict[str, str]
    shards: int
    batch_bytes: int
    samples: dict[str, Sample]

    def sample(self, name: str) -> Sample:
        """A sample by its name; an unknown one is an error that lists the known ones."""
        _check(name in self.samples, f"there is no sample {name!r}; there are {sorted(self.samples)}")
        return self.samples[name]

    def sample_folder(self, name: str, stage: str) -> str:
        return f"{self.base}/samples/{name}/{self.sample(name).folders[stage]}"


#: Folders that a pool and a sample name.
POOL_FOLDERS, STAGES = ("base", "smiles", "parquet", "staging", "merged", "manifests"), ("raw", "preprocessed", "featurized")
_NAME = re.compile(r"[a-z0-9]+(?:[-_][a-z0-9]+)*")


def _folders(data: dict[str, Any], names: tuple[str, ...], where: str) -> dict[str, str]:
    """Relative folders, all given, none of them outside of its parent or inside of another."""
    flat = {k: v for k, v in data.items() if k != "shards"} | (data.get("shards") or {})
    _only(flat, set(names), where)
    _check(set(flat) == set(names), f"{where} lacks {sorted(set(names) - set(flat))}")
    for name, folder in flat.items():
        parts = str(folder).split("/")
        _check(all(p not in ("", ".", "..") for p in parts), f"{where}.{name} must be a folder below its parent, not {folder!r}")
    inner = sorted((str(v), k) for k, v in flat.items() if k != "base")
    for (a, first), (b, second) in ((x, y) for i, x in enumerate(inner) for y in inner[i + 1 :]):
        _check(a != b and not b.startswith(a + "/"), f"{where}.{second} lies in {where}.{first}")
    return {k: str(v) for k, v in flat.items()}


def candidates_of(data: dict[str, Any]) -> Candidates:
    """The pool and its samples from a parsed document; keys that begin with `x-` are ignored, other unknown ones are errors."""
    data = {k: v for k, v in data.items() if not str(k).startswith("x-")}
    _only(data, {"storage", "candidate_pool", "samples"}, "candidates")
    pool, samples = data["candidate_pool"], {}
    _only(pool, {"storage", "sharding"}, "candidate_pool")
    _only(pool["sharding"], {"max_batch_gib", "num_shards"}, "candidate_pool.sharding")
    sizes = [pool["sharding"]["max_batch_gib"], pool["sharding"]["num_shards"]]
    _check(all(isinstance(n, int) and n > 0 for n in sizes), "max_batch_gib and num_shards must be positive numbers")
    for name, sample in data["samples"].items():
        where = f"samples.{name}"
        _check(_NAME.fullmatch(str(name)) is not None, f"{name!r} is no name of a sample")
        _only(sample, {"num_samples", "storage", "feature_types"}, where)
        _check(isinstance(sample["num_samples"], int) and sample["num_samples"] > 0, f"{where}.num_samples must be positive")
        unknown = sorted(set(sample["feature_types"]) - set(TRAINABLE))
        _check(bool(sample["feature_types"]) and not unknown, f"{where} has unknown features {unknown}")
        _distinct(list(sample["feature_types"]), f"{where}.feature_types")
        samples[str(name)] = Sample(sample["num_samples"], tuple(sample["feature_types"]), _folders(sample["storage"], STAGES, f"{where}.storage"))
    base = _folders(data["storage"], ("base",), "storage")["base"]
    return Candidates(base, _folders(pool["storage"], POOL_FOLDERS, "candidate_pool.storage"), sizes[1], sizes[0] << 30, samples)


def checked(screens: list[Screen], candidates: Candidates) -> None:
    """Fails unless every screen's name is its own and its sample exists and has the rows and features it needs."""
    _distinct([s.name for s in screens], "screen names")
    for screen in screens:
        sample = candidates.sample(screen.candidates)
        screen.require_fits(set(sample.features), sample.rows)
