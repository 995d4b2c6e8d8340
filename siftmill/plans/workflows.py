"""The steps of a screen put together: load, sample, preprocess, featurize, targets. Each runs again only if what it was made of changed."""

from __future__ import annotations

import json
import posixpath
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.providers import FeatureProvider, featurized, with_conformers
from ..operators.cleaning import at_least
from ..operators.sampling import DEFAULT_SEED, quotas, sampled
from ..operators.sharding import require_written, unexpected_shards, write_shards
from ..operators.sites import pocket_sites
from ..runtime import path_exists, remove_path
from ..sources.smi import read_smi
from .files import LOCAL, Files, HadoopFiles
from .layout import Layout
from .manifest import Manifest, found, run_once
from .tasks import NAMED, write_sites

#: Fixed value: bytes of compressed input that one sharding step takes.
BATCH_BYTES = 10 << 30


def batches_of(files: Sequence[dict[str, Any]], limit: int) -> list[list[dict[str, Any]]]:
    """Files in the order of their paths, packed into batches of at most `limit` bytes, but one file at least."""
    out: list[list[dict[str, Any]]] = []
    filled = 0
    for entry in files:
        if not out or filled + entry["size"] > limit:
            out.append([])
            filled = 0
        out[-1].append(entry)
        filled += entry["size"]
    return out


def shards_there(spark: SparkSession, path: str) -> DataFrame:
    """`shard_id` of the folders of a sharded table; none for a missing path."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "shard_id int")
    files = HadoopFiles(spark)
    names = {posixpath.dirname(n).rpartition("=")[2] for n in files.listed(path, "shard_id=*/*.parquet")}
    return spark.createDataFrame([(int(n),) for n in sorted(names) if n.isdigit()], "shard_id int")


def layout_problems(spark: SparkSession, check: str, staging: Sequence[str], final: str, shards: int) -> list[str]:
    """What keeps a sharded load from going on, one line for each rule, with the first few examples.

    `final-in-range`: no final shard is outside of 0..shards-1. `staging-complete`: all folders of staged batches
    are there and finished. `merge-complete`: no staged file is left unmerged beside complete final shards.
    """
    files = HadoopFiles(spark)
    unfinished = [s for s in staging if not files.is_file(f"{s}/_SUCCESS")]
    rules = {
        "final-in-range": [("final shards outside the expected ones", [str(r[0]) for r in unexpected_shards(shards_there(spark, final), shards).orderBy("shard_id").collect()])],
        "staging-complete": [("staged batches are missing", unfinished)],
        "merge-complete": [("final shards are not finished", [] if files.is_file(f"{final}/_SUCCESS") else [final]), ("staged batches are left", [s for s in staging if path_exists(spark, s)])],
    }
    return [f"{what}: {len(bad)} (such as {', '.join(bad[:NAMED])})" for what, bad in rules[check] if bad]


def _require(problems: list[str]) -> None:
    if problems:
        raise ValueError("; ".join(problems))


def load_candidates(
    spark: SparkSession, source: str, root: str, pattern: str = "*.smi.gz", shards: int = 512, batch_bytes: int = BATCH_BYTES, missing: str = "error"
) -> dict[str, Any]:
    """Loads candidate lines into shards below `root`: plan, shard batch by batch, verify, merge, verify, clean. What was done.

    Batches of source files become staged tables, each with a manifest of its own, so a load that died goes on
    with the first batch that isn't finished. A load whose sources, shards and output are unchanged does
    nothing. Source files that were added, removed or resized make the whole load run again. A final shard
    outside the range is an error before anything is written, as the number of shards can't be changed in place.
    """
    files, staging, final, state = HadoopFiles(spark), f"{root}/staging", f"{root}/shards", f"{root}/state"
    sources = [{k: e[k] for k in ("path", "size")} for e in found(source, pattern, files=files)]
    if not sources:
        raise FileNotFoundError(f"no files {pattern} in {source}")
    wanted = {"source_files": sources, "shards": shards, "missing": missing}
    manifest = Manifest(f"{state}/load.json", files=files)
    if manifest.complete({**wanted, "merged": True}) and files.is_file(f"{final}/_SUCCESS"):
        return {"sharded": 0, "merged": False, "rows": manifest.load().data["rows"]}
    _require(layout_problems(spark, "final-in-range", [], final, shards))
    batches = batches_of(sources, batch_bytes)
    staged, ran = [f"{staging}/batch={i}" for i in range(len(batches))], 0
    for path, batch in zip(staged, batches, strict=True):

        def shard(path: str = path, batch: list[dict[str, Any]] = batch) -> dict[str, Any]:
            rows = read_smi(spark, [posixpath.join(source, e["path"]) for e in batch], missing=missing)
            write_shards(rows.select("smiles", "id"), path, shards)
            return {"rows": spark.read.parquet(path).count()}

        ran += run_once(f"{state}/{posixpath.basename(path)}.json", {"source_files": batch, "shards": shards, "missing": missing}, lambda path=path: files.is_file(f"{path}/_SUCCESS"), shard, files)
    _require(layout_problems(spark, "staging-complete", staged, final, shards))
    rows = sum(Manifest(f"{state}/{posixpath.basename(p)}.json", files=files).load().data["rows"] for p in staged)
    # Staged batches share their shards' numbers, so a merge moves rows between files of a shard only.
    write_shards(spark.read.option("basePath", staging).parquet(*staged).drop("batch"), final, shards)
    require_written(spark, final, rows)
    for path in staged:
        remove_path(spark, path)
    _require(layout_problems(spark, "merge-complete", staged, final, shards))
    Manifest(manifest.path, {**wanted, "merged": True, "rows": rows}, files).save()
    remove_path(spark, staging)
    return {"sharded": ran, "merged": True, "rows": rows}


def _step(spark: SparkSession, layout: Layout, source: str, target: str, wanted: dict[str, Any], make: Callable[[DataFrame], DataFrame]) -> bool:
    """Makes one sharded table of another unless it is there and was made of the same; whether it did."""
    files = HadoopFiles(spark)
    made_of = {**wanted, "source_files": [{k: e[k] for k in ("path", "size")} for e in found(source, "shard_id=*/*.parquet", files=files)]}
    if not made_of["source_files"]:
        raise FileNotFoundError(f"there are no shards at {source}")

    def run() -> dict[str, Any]:
        rows = make(spark.read.parquet(source))
        rows.write.mode("overwrite").partitionBy("shard_id").option("compression", "zstd").parquet(target)
        return {"rows": spark.read.parquet(target).count()}

    return run_once(layout.manifest(target), made_of, lambda: files.is_file(f"{target}/_SUCCESS"), run, files)


def sample_candidates(spark: SparkSession, layout: Layout, shards: str, name: str, total: int, number: int = 512, seed: int = DEFAULT_SEED) -> bool:
    """A named sample: as many rows of every shard as the total gives each, in the layout of shards."""
    each = quotas(total, number, floor=True)[0]
    return _step(spark, layout, shards, layout.shards(name, "raw"), {"total": total, "seed": seed}, lambda rows: sampled(rows, each, seed=seed))


def preprocess(spark: SparkSession, layout: Layout, name: str, build: Callable[[str], str | None], label: str) -> bool:
    """Conformers of a sample by `build`, which `label` names in the manifest."""
    return _step(spark, layout, layout.shards(name, "raw"), layout.shards(name, "preprocessed"), {"build": label}, lambda rows: with_conformers(rows, build))


def featurize(spark: SparkSession, layout: Layout, name: str, providers: Sequence[FeatureProvider]) -> bool:
    """Features of a preprocessed sample. Providers that the environment lacks are refused before anything is read."""
    for p in providers:
        p.require()
    wanted = {"features": sorted(p.name for p in providers)}
    return _step(spark, layout, layout.shards(name, "preprocessed"), layout.shards(name, "featurized"), wanted, lambda rows: featurized(rows, providers))


def load_targets(
    spark: SparkSession, layout: Layout, ensemble: str, pockets: DataFrame, atoms: DataFrame, detector: str, least_score: float, wanted: dict[str, Any]
) -> bool:
    """Sites of an ensemble's pockets, those of at least a score, as its document; unless it was made of the same `wanted`."""
    files, path = HadoopFiles(spark), f"{layout.ensemble(ensemble)}/binding_sites.json"

    def run() -> dict[str, Any]:
        sites = at_least(pocket_sites(pockets, atoms, detector).withColumn("ensemble_id", F.lit(ensemble)), "pocket_score", least_score)
        return {"sites": write_sites(sites, ensemble, path, files)}

    return run_once(layout.manifest(path), {**wanted, "least_score": least_score, "detector": detector}, lambda: files.is_file(path), run, files)


def plan_surrogate(root: str, features: str, conformers: str, plan: str, persisted: str, model: str | None = None, files: Files = LOCAL) -> dict[str, list[str]]:
    """The task list of a surrogate's sample: feature and conformer shards, which must have the same names, and the model.

    Paths are below `root`; the files with their sizes are kept beside the plan. No file for a pattern, or a shard that
    only one side has, is an error.
    """
    parts = {"features": found(root, features, files=files), "conformers": found(root, conformers, files=files), "models": found(root, model, files=files) if model else []}
    for name in ("features", "conformers"):
        if not parts[name]:
            raise FileNotFoundError(f"no {name} in {root}")
    names = {k: [posixpath.basename(e["path"]) for e in v] for k, v in parts.items()}
    only = {side: sorted(set(names[side]) - set(names[other])) for side, other in (("features", "conformers"), ("conformers", "features"))}
    if any(only.values()):
        raise ValueError(f"shards of features and conformers differ: only features {only['features']}, only conformers {only['conformers']}")
    Manifest(persisted, {"source_files": [e for v in parts.values() for e in v]}, files).save()
    files.write(plan, json.dumps(names, separators=(",", ":")).encode())
    return names
