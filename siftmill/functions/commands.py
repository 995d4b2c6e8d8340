"""Docking and pocket detection by external programs, and scores of external models."""

from __future__ import annotations

import logging
import re
import shutil
import subprocess
import tempfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.pose_text import RESULT_LINE
from .features import flattened
from .names import LEAST_EDGE
from .providers import DockingProvider, ProviderNotAvailable

log = logging.getLogger(__name__)
_RESULT = re.compile(RESULT_LINE)


def parsed_poses(text: str) -> list[tuple[int, float, float, float, str]]:
    """Poses of one output text: mode, affinity, lower and upper rmsd, the text of their block."""
    text = re.sub(r"\r\n?", "\n", text)
    out = []
    for place, block in enumerate(re.split(r"(?m)^(?=MODEL)", text)):
        mode = max(1, place)
        out += [(mode, *map(float, m.groups()), block) for m in _RESULT.finditer(block)]
    return out


class CommandDocking(DockingProvider):
    """Docks by a program that reads ligand files and writes one output file for each, `<name>_out.pdbqt`.

    `command` makes the argument list from the ligand files and the output folder; `prepare` writes a
    ligand's conformer as the program reads it. A program that is not on the path makes the provider
    unavailable; a run that ends with an error is contained by the caller.
    """

    name = "command"

    def __init__(
        self, program: str, command: Callable[[list[Path], Path], list[str]], prepare: Callable[[str], str] = str, ending: str = ".pdbqt", timeout_s: float = 3600
    ) -> None:
        self.program, self.command, self.prepare, self.ending, self.timeout_s = program, command, prepare, ending, timeout_s

    def require(self) -> None:
        super().require()
        if shutil.which(self.program) is None:
            raise ProviderNotAvailable(f"the program {self.program} is not on the path")

    def dock(self, ligands: list[tuple[str, str]]) -> dict[str, list[tuple[int, float, float | None, float | None, str]]]:
        with tempfile.TemporaryDirectory() as scratch:
            folder, out = Path(scratch, "in"), Path(scratch, "out")
            folder.mkdir()
            out.mkdir()
            files = []
            for i, (_, conformer) in enumerate(ligands):
                files.append(folder / f"{i}{self.ending}")
                files[-1].write_text(self.prepare(conformer))
            subprocess.run([self.program, *self.command(files, out)], check=True, timeout=self.timeout_s, capture_output=True)
            found = {}
            for i, (name, _) in enumerate(ligands):
                outputs = list(out.glob(f"{i}_out.*"))
                if len(outputs) != 1:
                    log.warning("%s has %d outputs", name, len(outputs))
                    continue
                poses = parsed_poses(outputs[0].read_text(errors="replace"))
                if poses:
                    found[name] = poses
            return found


def box_arguments(center: Sequence[float], edges: Sequence[float]) -> list[str]:
    """Arguments of a search box, with edges of the least length or more."""
    pairs = [(f"--center_{a}", f"{c:.3f}") for a, c in zip("xyz", center, strict=True)]
    pairs += [(f"--size_{a}", f"{max(LEAST_EDGE, e):.3f}") for a, e in zip("xyz", edges, strict=True)]
    return [x for p in pairs for x in p]


def detected(structures: DataFrame, detect: Callable[[str, str], Sequence[dict[str, object]]], schema: str) -> DataFrame:
    """Pockets of structures (`member_id, content`) by `detect(member, content)`, rows of `schema` with `member_id` first.

    A structure may have none; a detection that fails fails the job, as a screen without a member is another screen.
    """

    names = [c.strip().split()[0] for c in schema.split(",")]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for member, content in zip(part["member_id"], part["content"], strict=True):
                rows = [{"member_id": member, **r} for r in detect(member, content)]
                yield pd.DataFrame(rows, columns=["member_id", *names])

    return structures.select("member_id", "content").mapInPandas(run, f"member_id string, {schema}")


def scored_by(rows: DataFrame, model: object, features: Sequence[str], score: str = "score") -> DataFrame:
    """Rows with the second class's probability by a model with `predict_proba`; null for rows with a missing value and for NaN.

    The model is broadcast once; its size is that of a fitted model, whatever the number of rows.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("float")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            out = np.full(len(part), np.nan, np.float32)
            there = np.array([v is not None and bool(np.isfinite(np.asarray(v, float)).all()) for v in part], bool)
            if there.any():
                out[there] = np.asarray(shared.value.predict_proba(np.stack([np.asarray(v, float) for v, t in zip(part, there, strict=True) if t])))[:, 1]
            yield pd.Series(out, index=part.index)

    return rows.withColumn(score, run(flattened(rows, features))).withColumn(score, F.when(~F.isnan(score), F.col(score)))
