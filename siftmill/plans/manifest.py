"""Manifests: what a finished step was made of, so that it needn't run again."""

from __future__ import annotations

import json
import posixpath
from collections.abc import Callable, Iterable
from pathlib import Path
from typing import Any

from .files import LOCAL, Files


def covers(wanted: Any, stored: Any) -> bool:
    """Whether all that is wanted is stored: objects may have more keys, lists agree in length and order, other values are equal."""
    if isinstance(wanted, dict):
        return isinstance(stored, dict) and all(k in stored and covers(v, stored[k]) for k, v in wanted.items())
    if isinstance(wanted, list):
        return isinstance(stored, list) and len(wanted) == len(stored) and all(map(covers, wanted, stored))
    return wanted == stored


def described(paths: Iterable[str | Path], root: str | Path, hashed: bool = False, files: Files = LOCAL) -> list[dict[str, Any]]:
    """Files by their path below root: size, time of change, and with `hashed` the SHA-256 of their content."""
    out = []
    for path in paths:
        size, modified = files.status(str(path))
        entry: dict[str, Any] = {"path": posixpath.relpath(str(path), str(root)), "size": size, "modified": modified}
        if hashed:
            entry["sha256"] = files.digest(str(path))
        out.append(entry)
    return sorted(out, key=lambda e: e["path"])


def found(root: str | Path, *patterns: str, hashed: bool = False, files: Files = LOCAL) -> list[dict[str, Any]]:
    """Entries of the files below root that any of the patterns names, each once."""
    names = sorted({n for p in patterns for n in files.listed(str(root), p)})
    return described((posixpath.join(str(root), n) for n in names), root, hashed, files)


def changed(entries: Iterable[dict[str, Any]], root: str | Path, files: Files = LOCAL) -> list[str]:
    """Paths of entries whose file is gone or differs in size or, if it was hashed, in content."""
    out = []
    for entry in entries:
        path = posixpath.join(str(root), entry["path"])
        if not files.is_file(path):
            out.append(entry["path"])
            continue
        now = described([path], root, "sha256" in entry, files)[0]
        if any(entry[k] != now[k] for k in ("size", "sha256") if k in entry):
            out.append(entry["path"])
    return out


class Manifest:
    """A JSON object in a file, on the driver's disk unless other `files` are given."""

    def __init__(self, path: str | Path, data: dict[str, Any] | None = None, files: Files = LOCAL) -> None:
        self.path, self.data, self.files = path, data if data is not None else {}, files

    def __eq__(self, other: object) -> bool:
        return self.data == (other.data if isinstance(other, Manifest) else other)

    __hash__ = None  # type: ignore[assignment]

    def exists(self) -> bool:
        return self.files.is_file(str(self.path))

    def load(self) -> Manifest:
        """Reads the file; a missing one is a FileNotFoundError."""
        if not self.exists():
            raise FileNotFoundError(f"there is no manifest {self.path}")
        self.data = json.loads(self.files.read(str(self.path)))
        return self

    def save(self) -> Manifest:
        """Writes the whole file or nothing."""
        self.files.write(str(self.path), json.dumps(self.data, indent=2, sort_keys=True).encode())
        return self

    def update(self, values: dict[str, Any]) -> Manifest:
        """Sets top-level keys and saves."""
        self.data |= values
        return self.save()

    def add_hashes(self, hashes: dict[str, str], key: str = "source_files") -> Manifest:
        """Gives entries of files their hashes; a file that has no entry is an error."""
        entries = {e["path"]: e for e in self.data.get(key, [])}
        if unknown := sorted(set(hashes) - set(entries)):
            raise ValueError(f"there are hashes of files that the manifest doesn't have: {unknown}")
        for path, value in hashes.items():
            entries[path]["sha256"] = value
        return self

    def sources(self, root: str | Path, key: str = "source_files") -> list[str]:
        """Paths of the files it was made of, below a root."""
        return [posixpath.join(str(root), e["path"]) for e in self.data.get(key, [])]

    def same_sources(self, root: str | Path, *patterns: str, key: str = "source_files") -> bool:
        """Whether the files that the patterns name now are those it was made of, by path and size; False without such a list."""
        if key not in self.data:
            return False
        return [(e["path"], e["size"]) for e in self.data[key]] == [(e["path"], e["size"]) for e in found(root, *patterns, files=self.files)]

    def complete(self, wanted: dict[str, Any]) -> bool:
        """Whether the stored object covers the wanted one; a file that is missing or can't be read doesn't."""
        try:
            return covers(wanted, json.loads(self.files.read(str(self.path))))
        except Exception:  # whatever the file system has against it, the step runs again
            return False


def gate(path: str | Path, wanted: dict[str, Any], result: str | Path, root: str | Path | None = None, patterns: Iterable[str] = ("*",), files: Files = LOCAL) -> bool:
    """Writes `true` or `false` into a file: whether a manifest covers what is wanted and, with a root, the files are those it was made of."""
    manifest = Manifest(path, files=files)
    matches = manifest.complete(wanted) and (root is None or manifest.load().same_sources(root, *patterns))
    files.write(str(result), b"true" if matches else b"false")
    return matches


def run_once(
    path: str | Path, wanted: dict[str, Any], output_exists: Callable[[], bool], run: Callable[[], dict[str, Any] | None], files: Files = LOCAL
) -> bool:
    """Runs a step unless its output exists and its manifest covers what is wanted; whether it ran.

    The manifest is saved after the step, with what the step returns, so a step that fails runs again.
    """
    if output_exists() and Manifest(path, files=files).complete(wanted):
        return False
    Manifest(path, {**wanted, **(run() or {})}, files).save()
    return True
