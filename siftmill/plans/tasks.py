"""Task lists, site documents, guarded removal and one structured log line for each call."""

from __future__ import annotations

import functools
import json
import logging
import time
from collections.abc import Callable, Sequence
from pathlib import Path
from typing import Any, TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import remove_path
from .files import LOCAL, Files
from .manifest import Manifest, described

#: Examples that a failed check names.
NAMED = 5

T = TypeVar("T")
log = logging.getLogger("siftmill")


def write_plan(root: str | Path, pattern: str, plan: str | Path, persisted: str | Path, limit: int) -> list[list[str]]:
    """Packs the files of a folder into batches in path order and writes the task list and the files it was made of."""
    if limit < 1:
        raise ValueError(f"the limit must be positive, not {limit}")
    files = described((p for p in Path(root).glob(pattern) if p.is_file()), root)
    batches: list[list[str]] = []
    filled = 0
    for entry in files:
        if not batches or filled + entry["size"] > limit:
            batches.append([])
            filled = 0
        batches[-1].append(entry["path"])
        filled += entry["size"]
    Manifest(plan, {"batches": batches}).save()
    Manifest(persisted, {"source_files": files}).save()
    return batches


def write_sites(sites: DataFrame, ensemble: str, path: str | Path, files: Files = LOCAL) -> int:
    """Writes the sites of an ensemble as one document, in the order of member and site, null fields left out; their number.

    An ensemble without sites is an error. The document of an ensemble goes through the driver.
    """
    rows = sites.where(F.col("ensemble_id") == ensemble).orderBy("member_id", "site_id").select(F.to_json(F.struct(*(c for c in sites.columns if c != "ensemble_id"))).alias("j")).collect()
    if not rows:
        raise ValueError(f"{ensemble} has no sites")
    Manifest(path, {"ensemble_id": ensemble, "binding_sites": [json.loads(r.j) for r in rows]}, files).save()
    return len(rows)


def mark_success(path: str | Path, details: dict[str, Any] | None = None, files: Files = LOCAL) -> None:
    """Writes a marker that a step beside it succeeded, with what it is to be remembered by."""
    Manifest(path, {"status": "ok", **(details or {})}, files).save()


def clean_prefix(spark: SparkSession, root: str, prefix: str) -> None:
    """Deletes root/prefix; an empty prefix or one that leaves the root is refused."""
    parts = prefix.strip("/").split("/")
    if not prefix.strip("/") or ".." in parts or "." in parts:
        raise ValueError(f"refused to clean {prefix!r}")
    remove_path(spark, f"{root.rstrip('/')}/{'/'.join(parts)}")


def logged(run: Callable[..., T]) -> Callable[..., T]:
    """Logs one line for each call: name, arguments, seconds, and ok or the error."""

    @functools.wraps(run)
    def call(*args: Any, **kwargs: Any) -> T:
        began, line = time.monotonic(), {"call": run.__qualname__, "args": [repr(a) for a in args], "kwargs": {k: repr(v) for k, v in kwargs.items()}}
        try:
            out = run(*args, **kwargs)
        except BaseException as e:
            log.error(json.dumps(line | {"seconds": round(time.monotonic() - began, 3), "status": "error", "error": repr(e)}))
            raise
        log.info(json.dumps(line | {"seconds": round(time.monotonic() - began, 3), "status": "ok"}))
        return out

    return call


def require_distinct(values: Sequence[str], what: str) -> None:
    """Fails if a value occurs twice."""
    twice = sorted({v for v in values if values.count(v) > 1})
    if twice:
        raise ValueError(f"{what} must be unique, but there are several {twice}")
