"""Activity thresholds that are kept beside the labels they were taken from."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame

from ..operators.cleaning import negative
from ..operators.labels import nearest_quantile, require_threshold
from .files import LOCAL, Files
from .manifest import Manifest


def kept_threshold(labels: DataFrame, path: str | Path, percent: float, fingerprint: dict[str, object], column: str = "affinity_kcal_mol", files: Files = LOCAL) -> float:
    """The nearest-rank percentile of negative values; taken from the file if it was made of the same input and percentage."""
    wanted = {"percent": percent, "input": fingerprint}
    manifest = Manifest(path, files=files)
    if manifest.complete(wanted):
        return manifest.load().data["threshold"]
    value = require_threshold(nearest_quantile(negative(labels, column), column, percent))
    Manifest(path, {**wanted, "threshold": value}, files).save()
    return value
