"""The pair classifier: gradient-boosted trees of Spark ML, out-of-fold scores, and importance."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import feature_columns
from .sampling import group_folds

UNKNOWN = -1.0


@dataclass(frozen=True)
class ModelConfig:
    rounds: int = 40
    step: float = 0.05
    depth: int = 7
    least_rows: int = 50
    subsample: float = 0.8
    feature_share: str = "0.8"
    tolerance: float = 0.001
    seed: int = 42


def model_input(df: DataFrame, columns: list[str]) -> DataFrame:
    """Features without nulls: each nullable one becomes its value, or UNKNOWN, and a flag."""
    return df.select("*", *(F.coalesce(F.col(c).cast("double"), F.lit(UNKNOWN)).alias(f"_v_{c}") for c in columns), *(F.col(c).isNull().cast("double").alias(f"_u_{c}") for c in columns))


def train_full(df: DataFrame, columns: list[str] | None = None, config: ModelConfig = ModelConfig(), rounds: int | None = None, validation: str | None = None) -> PipelineModel:
    """A model of labelled pairs. validation names a boolean column of rows that stop training early."""
    columns = columns or feature_columns(df)
    gbt = GBTClassifier(labelCol="label", featuresCol="_features", maxIter=rounds or config.rounds, stepSize=config.step, maxDepth=config.depth, minInstancesPerNode=config.least_rows, subsamplingRate=config.subsample, featureSubsetStrategy=config.feature_share, seed=config.seed)
    if validation:
        gbt.setParams(validationIndicatorCol=validation, validationTol=config.tolerance)
    assembler = VectorAssembler(inputCols=[f"{p}{c}" for c in columns for p in ("_v_", "_u_")], outputCol="_features")
    return Pipeline(stages=[assembler, gbt]).fit(model_input(df, columns))


def predict(models: PipelineModel | list[PipelineModel], df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(s1_id, cand_id, prob[, label]): the mean probability of the models."""
    models, columns = models if isinstance(models, list) else [models], columns or feature_columns(df)
    out, extra = model_input(df, columns), [c for c in ("label",) if c in df.columns]
    for i, model in enumerate(models):
        out = model.transform(out).withColumn(f"_p{i}", vector_to_array("probability")[1]).drop("_features", "rawPrediction", "probability", "prediction")
    prob = sum((F.col(f"_p{i}") for i in range(1, len(models))), F.col("_p0")) / len(models)
    return out.select("s1_id", "cand_id", prob.alias("prob"), *extra)


def train_oof(df: DataFrame, n_folds: int = 5, config: ModelConfig = ModelConfig(), columns: list[str] | None = None) -> tuple[DataFrame, list[PipelineModel]]:
    """Every pair scored by the model that hasn't seen its query; that fold stops training early. The driver loops over folds only."""
    columns = columns or feature_columns(df)
    dealt, scored, models = df.join(group_folds(df, n_folds), "s1_id"), None, []
    for fold in range(n_folds):
        model = train_full(dealt.withColumn("_held", F.col("fold") == fold), columns, config, validation="_held")
        own = predict(model, dealt.where(F.col("fold") == fold), columns).withColumn("fold", F.lit(fold))
        scored, models = own if scored is None else scored.unionByName(own), [*models, model]
    return scored, models


def full_rounds(models: list[PipelineModel], n_folds: int, default: int) -> int:
    """Rounds for all rows: the folds' mean, raised as the rows are."""
    trees = [m.stages[-1].getNumTrees for m in models]
    return max(1, round(sum(trees) / len(trees) * n_folds / (n_folds - 1))) if trees and n_folds > 1 else default


def feature_importance(model: PipelineModel, columns: list[str]) -> list[tuple[str, float]]:
    """(feature, gain), highest first; a feature's value and its flag together."""
    gains = model.stages[-1].featureImportances.toArray()
    return sorted(((c, float(gains[2 * i] + gains[2 * i + 1])) for i, c in enumerate(columns)), key=lambda x: -x[1])


def split_counts(model: PipelineModel, columns: list[str]) -> list[tuple[str, int]]:
    """(feature, how many nodes split by it), most first; a feature's value and its flag together."""
    found = dict.fromkeys(range(len(columns)), 0)
    for tree in model.stages[-1].trees:
        for n in re.findall(r"feature (\d+) (?:<=|in)", tree.toDebugString):
            found[int(n) // 2] += 1
    return sorted(((columns[i], n) for i, n in found.items()), key=lambda x: (-x[1], x[0]))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
