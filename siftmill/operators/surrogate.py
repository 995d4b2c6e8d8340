"""A surrogate classifier: training table, model, scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.features import all_valid, flattened


@dataclass(frozen=True)
class Settings:
    """Of boosted trees: their number, learning rate, depth, least rows of a leaf, seed."""

    trees: int = 100
    rate: float = 0.05
    depth: int = 5
    leaf: int = 10
    seed: int = 1000


def _whole(width: int | None) -> Column:
    """Whether `__v` is there, has the width and finite values only."""
    finite = F.forall("__v", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    size = F.size("__v") == width if width is not None else F.lit(True)
    return F.coalesce(F.col("__v").isNotNull() & size & finite, F.lit(False))


def prepared(rows: DataFrame, features: Sequence[str], active: str = "active", width: int | None = None) -> DataFrame:
    """The rows with `x`, their features as one vector in the given order, and `y`.

    Rows with a missing or infinite value, and with `width` those of another number of values, are dropped.
    """
    return rows.withColumn("__v", flattened(rows, features)).where(_whole(width)).withColumn("x", array_to_vector("__v")).withColumn("y", F.col(active).cast("double")).drop("__v")


def trained(rows: DataFrame, settings: Settings = Settings()) -> PipelineModel:
    """Boosted trees on `x` and `y`; both classes must occur."""
    classes = rows.agg(F.countDistinct("y")).first()[0]
    if classes < 2:
        raise ValueError("training rows must hold active and inactive ones")
    trees = GBTClassifier(
        featuresCol="x", labelCol="y", maxIter=settings.trees, stepSize=settings.rate, maxDepth=settings.depth, minInstancesPerNode=settings.leaf, seed=settings.seed
    )
    return PipelineModel([trees.fit(rows)])


def scored(rows: DataFrame, model: PipelineModel, features: Sequence[str], score: str = "score") -> DataFrame:
    """All rows with `eligible` and, where they are, the probability of being active as float; otherwise null.

    A row is eligible if all its `_valid` columns are true, its number of values is that of the model, and all
    of them are finite.
    """
    width = model.stages[-1].numFeatures
    marked = rows.withColumn("__v", flattened(rows, features)).withColumn("eligible", all_valid(rows) & _whole(width))
    # Rows that aren't eligible go through the model as zeros, so that all rows are read once.
    zeros = F.array_repeat(F.lit(0.0), width)
    found = model.transform(marked.withColumn("x", array_to_vector(F.when(F.col("eligible"), F.col("__v")).otherwise(zeros))))
    return found.select(*rows.columns, "eligible", F.when(F.col("eligible"), vector_to_array("probability")[1].cast("float")).alias(score))


def save_model(model: PipelineModel, path: str) -> None:
    """Writes a model to a folder of any file system, in place of one that is there."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """A saved model; a missing path is an error."""
    return PipelineModel.load(path)
