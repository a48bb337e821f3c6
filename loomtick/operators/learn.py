"""A classifier with a confidence gate, and its frozen description."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_gated(train: DataFrame, features: Sequence[str], label: str, gate: float = 0.9, trees: int = 30, depth: int = 5, seed: int = 7) -> tuple[object, float]:
    """A forest over labels −1, 0, 1 (rows with NULLs are left out) and the confidence that a share ``gate`` of the training rows stays below.

    A different learner from gradient boosting, with the same gate.
    """
    usable = train.dropna(subset=[*features, label]).withColumn("_y", F.col(label).cast("double") + 1)
    model = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="_x"), RandomForestClassifier(featuresCol="_x", labelCol="_y", numTrees=trees, maxDepth=depth, seed=seed)]).fit(usable)
    limit = score(model, usable, features).agg(F.percentile("confianca", F.lit(gate))).first()[0]
    return model, float(limit)


def score(model: object, rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Adds ``classe`` (−1, 0, 1) and ``confianca``, the larger of the two directional probabilities; rows with NULL features get none."""
    out = model.transform(rows.dropna(subset=list(features)))
    p = vector_to_array("probability")
    up, down = F.coalesce(F.try_element_at(p, F.lit(3)), F.lit(0.0)), F.try_element_at(p, F.lit(1))
    return out.withColumns({"classe": (F.col("prediction") - 1).cast("bigint"), "confianca": F.greatest(up, down)}).drop("_x", "rawPrediction", "probability", "prediction")


def gated(scored: DataFrame, limit: float) -> DataFrame:
    return scored.where((F.col("confianca") >= limit) & (F.col("classe") != 0))


def artefact_hash(description: dict) -> str:
    """SHA-256 of a description with sorted keys."""
    return hashlib.sha256(json.dumps(description, sort_keys=True, ensure_ascii=False).encode()).hexdigest()
