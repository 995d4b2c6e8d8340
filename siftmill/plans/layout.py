"""Where a screen keeps its files."""

from __future__ import annotations

from dataclasses import dataclass

VALIDATION = "validation"


@dataclass(frozen=True)
class Layout:
    """Paths below one root; everything that writes or reads a screen takes them from here."""

    root: str
    screen: str

    @property
    def base(self) -> str:
        return f"{self.root.rstrip('/')}/screens/{self.screen}"

    @property
    def structures(self) -> str:
        return f"{self.base}/targets/pdbs"

    def ensemble(self, ensemble: str) -> str:
        return f"{self.base}/targets/ensembles/{ensemble}"

    def label(self, ensemble: str, site: str, label: str) -> str:
        return f"{self.base}/filter/surrogate/ensembles/{ensemble}/{site}/{label}"

    def features(self, ensemble: str, site: str, label: str) -> str:
        return f"{self.label(ensemble, site, label)}/features.parquet"

    def results(self, ensemble: str, site: str, label: str) -> str:
        return f"{self.label(ensemble, site, label)}/docking.results.parquet"

    def model(self, ensemble: str, site: str, label: str) -> str:
        return f"{self.label(ensemble, site, label)}/model"

    def manifest(self, path: str) -> str:
        return f"{path}.manifest.json"

    def sample(self, sample: str, stage: str) -> str:
        """A sample's folder of one stage: raw, preprocessed or featurized."""
        if stage not in ("raw", "preprocessed", "featurized"):
            raise ValueError(f"no stage {stage}")
        return f"{self.root.rstrip('/')}/candidates/samples/{sample}/{stage}"

    def shards(self, sample: str, stage: str) -> str:
        return f"{self.sample(sample, stage)}/shards"


def round_label(i: int) -> str:
    return f"round_{i}"


def labels_up_to(i: int) -> list[str]:
    """Labels of the rounds that the model after round i is trained on."""
    return [round_label(k) for k in range(i + 1)]
