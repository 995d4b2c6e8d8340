"""The active-learning loop of one site: a random round, then rounds of top-scored and random candidates."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cleaning import keep_first, negative, training_rows
from ..operators.labels import enrichment, labelled, nearest_quantile, require_threshold
from ..operators.sampling import not_selected, round_seeds, sampled, select_top_and_random
from ..operators.surrogate import Settings, prepared, save_model, scored, trained
from ..runtime import materialize
from .config import Round

#: Docks a selection: rows with `id` to rows with `id, mode, affinity_kcal_mol`.
Dock = Callable[[DataFrame], DataFrame]


@dataclass
class Outcome:
    """Selections and labels of every round, the activity threshold, and how well each model found the active."""

    threshold: float = 0.0
    selections: dict[str, DataFrame] = field(default_factory=dict)
    labels: dict[str, DataFrame] = field(default_factory=dict)
    metrics: dict[str, DataFrame] = field(default_factory=dict)


def run_rounds(
    candidates: DataFrame, dock: Dock, rounds: Sequence[Round], validation: int, percentile: float, features: Sequence[str],
    groups: Sequence[str] = ("shard_id",), seed: int = 1000, settings: Settings = Settings(), width: int | None = None,
    models: Callable[[str], str] | None = None,
) -> Outcome:
    """Runs all rounds over candidates (`id`, features and their `_valid` flags, groups).

    `validation` and the numbers of a round are for each group. The validation sample is docked first; its
    nearest-rank percentile of negative affinities is the threshold of activity. Every round leaves out all
    rows that were selected before, validation included; the first has no model and must be random. Each
    selection and its labels are written to the shared folder, so a later round doesn't run an earlier one again.
    `models` names the folder that a round's model is saved to, such as `Layout.model`.
    """
    if not rounds or rounds[0].top:
        raise ValueError("there must be a first round, and it must be random")
    seeds, out = round_seeds(seed, len(rounds)), Outcome()

    def taken(label: str, rows: DataFrame) -> None:
        out.selections[label] = materialize(rows, f"selected-{label}")
        out.labels[label] = materialize(dock(out.selections[label]), f"labels-{label}")

    def cleaned(labels: Sequence[str]) -> DataFrame:
        both = out.selections[labels[0]], out.labels[labels[0]]
        for label in labels[1:]:
            both = both[0].unionByName(out.selections[label], allowMissingColumns=True), both[1].unionByName(out.labels[label])
        rows = training_rows(both[0], both[1], [F.col("id")], [F.col("mode")])
        return prepared(labelled(rows, limit, "affinity_kcal_mol"), features, width=width)

    taken("validation", sampled(candidates, validation, groups=groups, seed=seeds["validation"]))
    best = keep_first(negative(out.labels["validation"]), ["id"], [F.col("mode")])
    limit = nearest_quantile(best, "affinity_kcal_mol", percentile)
    out.threshold = require_threshold(limit)
    limit = candidates.sparkSession.createDataFrame([(out.threshold,)], "threshold double")
    model = None
    for i, each in enumerate(rounds):
        label = f"round_{i}"
        rest = not_selected(candidates, *out.selections.values())
        if model is None or not each.top:
            pick = sampled(rest, each.top + each.random, groups=groups, seed=seeds[label])
        else:
            pick = select_top_and_random(scored(rest, model, features), each.top, each.random, "score", groups=groups, seed=seeds[label])
        taken(label, pick.drop("score", "eligible", "selection_group"))
        model = trained(cleaned([f"round_{k}" for k in range(i + 1)]), settings)
        if models:
            save_model(model, models(label))
        out.metrics[label] = enrichment(scored(cleaned(["validation"]).drop("x"), model, features), "score", "active", "id")
    return out
