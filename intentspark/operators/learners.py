"""Learned scorers on Spark ML: feature pipeline, families, probability calibration, weighted fits."""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentspark import fixed
from intentspark.errors import AnalysisError
from intentspark.operators.features import FeatureBuilder, MatrixBuilder, additive_parts
from intentspark.operators.scorers import WHOLE_NUMBERS, Additive, are_numbers, logistic_curve
from intentspark.operators.splits import fold_column, with_class_weight
from intentspark.operators.trees import Forest
from intentspark.roles import DEFAULT_ROLES

LABEL = fixed.TARGET


def logistic(rows: float, max_iter: int = 1000, weight: str | None = None, c: float = 1.0) -> LogisticRegression:
    """Ridge logistic regression whose penalty equals 1/C on the summed loss (rows = sum of weights)."""
    model = LogisticRegression(
        labelCol=LABEL, regParam=1.0 / (c * rows), elasticNetParam=0.0, standardization=False, maxIter=max_iter)
    return model.setWeightCol(weight) if weight else model


def decision_tree(rows: int) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=LABEL, maxDepth=4, minInstancesPerNode=max(10, int(rows * 0.02)), seed=fixed.SEED)


def weighted_forest(rows: int, weight: str | None = None, trees: int = 240) -> Forest:
    return forest({"trees": trees, "depth": 8, "leaf": max(6, int(rows * 0.01)), "features": "sqrt"}, weight)


def forest(params: dict, weight: str | None = None) -> Forest:
    """Random forest; an unlimited depth becomes Spark's maximum of 30."""
    model = Forest(
        labelCol=LABEL, numTrees=params["trees"], maxDepth=params["depth"] or 30, minInstancesPerNode=params["leaf"],
        featureSubsetStrategy=params["features"], seed=fixed.SEED, maxMemoryInMB=1024)
    return model.setWeightCol(weight) if weight else model


def boosting(params: dict, bins: int = 32) -> GBTClassifier:
    return GBTClassifier(
        labelCol=LABEL, maxIter=params["rounds"], stepSize=params["rate"], maxDepth=params["depth"],
        minInstancesPerNode=params["leaf"], subsamplingRate=params.get("subsample", 1.0), maxBins=bins, seed=fixed.SEED,
        maxMemoryInMB=1024, cacheNodeIds=True)


def family_estimator(family: str, params: dict) -> tuple[str, Estimator]:
    """(matrix branch, estimator) of a tuned family.

    The histogram family is the same learner with finer bins; leaf-count and L2 limits have no
    counterpart in Spark's boosted trees and are not imitated.
    """
    if family == "random_forest":
        return "tree", forest(params)
    if family == "gradient_boosting":
        return "linear", boosting(params)
    if family == "hist_gradient_boosting":
        return "linear", boosting(params, bins=255)
    raise AnalysisError(f"unknown model family {family}")


def family_grid(family: str) -> tuple[dict, ...]:
    return {
        "random_forest": fixed.FOREST_GRID,
        "gradient_boosting": fixed.BOOSTING_GRID,
        "hist_gradient_boosting": fixed.HIST_BOOSTING_GRID,
    }[family]


def matrix_pipeline(branch: str) -> Pipeline:
    return Pipeline(stages=[FeatureBuilder(), MatrixBuilder(branch=branch)])


@dataclass
class ModelScorer:
    """Scorer over a fitted pipeline: probability at 6 decimals, label by the larger class."""

    model: PipelineModel

    def score(self, df: DataFrame) -> DataFrame:
        raw = self.model.transform(df)
        p = vector_to_array("probability")[1]
        helpers = [c for c in raw.columns if c not in df.columns]
        return (
            raw.withColumn("p", F.round(p, 6)).withColumn("yhat", F.when(p > 0.5, 1).otherwise(0))
            .drop(*[c for c in helpers if c not in ("p", "yhat")])
        )

    def additive(self, *frames: dict[str, str]) -> Additive | None:
        """A logistic regression over the linear matrix as a sum; other learners are not one."""
        stages = self.model.stages
        if len(stages) != 3 or not isinstance(stages[2], LogisticRegressionModel) or stages[2].numClasses != 2:
            return None
        if not are_numbers(DEFAULT_ROLES.numeric, *frames) or not are_numbers(DEFAULT_ROLES.categorical, *frames, kinds=WHOLE_NUMBERS):
            return None
        if not all(level.lstrip("-").isdigit() for c in DEFAULT_ROLES.categorical for level in stages[1].learned()["levels"][c]):
            return None
        parts = additive_parts(stages[0].learned(), stages[1], stages[2].coefficients.toArray())
        return Additive(float(stages[2].intercept), parts, logistic_curve)


@dataclass
class CalibratedScorer:
    """Average of the fold models' sigmoid-calibrated probabilities."""

    parts: list[tuple[PipelineModel, float, float]] = field(default_factory=list)

    def score(self, df: DataFrame) -> DataFrame:
        columns = df.columns
        out = df
        names = []
        for i, (model, slope, intercept) in enumerate(self.parts):
            raw = model.transform(out)
            name = f"_p{i}"
            margin = raw_score(model)
            out = raw.withColumn(name, F.lit(1.0) / (F.lit(1.0) + F.exp(-(margin * slope + intercept))))
            names.append(name)
            out = out.select(*columns, *names)
        mean = reduce(lambda a, b: a + b, [F.col(n) for n in names]) / len(names)
        return out.withColumn("p", F.round(mean, 6)).withColumn("yhat", F.when(mean > 0.5, 1).otherwise(0)).drop(*names)


def raw_score(model: PipelineModel) -> Column:
    """Uncalibrated score: the margin where the learner has one, the probability for forests."""
    if type(model.stages[-1]).__name__.startswith(("RandomForest", "DecisionTree")):
        return vector_to_array("probability")[1]
    return vector_to_array("rawPrediction")[1]


def keep(df: DataFrame) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def dealt(df: DataFrame) -> DataFrame:
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, "row_id").sortWithinPartitions(*df.columns)


def prepared_inputs(train: DataFrame, branch: str) -> tuple[PipelineModel, DataFrame, list[str]]:
    """Fitted feature pipeline, the kept training columns and the names of those that go on beside the matrix.

    The feature fits read the training columns several times, so these are kept. Rows with a key are dealt to all tasks, in an
    order of their own: a file that scans as one split would leave every pass of a fit to one task, and the draws of forests
    and boosting follow the order.
    """
    extra = [c for c in ("row_id", "weight", "fold") if c in train.columns]
    inputs = train.select(*DEFAULT_ROLES.base_inputs, LABEL, *extra)
    inputs = keep(dealt(inputs) if "row_id" in extra else inputs)
    return matrix_pipeline(branch).fit(inputs), inputs, extra


def matrix(train: DataFrame, branch: str) -> tuple[PipelineModel, DataFrame]:
    """Fitted feature pipeline and the kept training matrix, which replaces the kept columns once it has been filled."""
    prepared, inputs, extra = prepared_inputs(train, branch)
    vectors = keep(prepared.transform(inputs).select("features", LABEL, *extra))
    vectors.count()
    inputs.unpersist()
    return prepared, vectors


def fit(train: DataFrame, branch: str, estimator: Estimator) -> ModelScorer:
    if isinstance(estimator, LogisticRegression):
        # it keeps the matrix itself, in blocks; a second copy, wide and dense, would crowd the memory of the executors
        prepared, inputs, extra = prepared_inputs(train, branch)
        model = estimator.fit(prepared.transform(inputs).select("features", LABEL, *[c for c in extra if c == "weight"]))
        inputs.unpersist()
        return joined(prepared, model)
    prepared, vectors = matrix(train, branch)
    model = estimator.fit(vectors)
    vectors.unpersist()
    return joined(prepared, model)


def joined(prepared: PipelineModel, model) -> ModelScorer:
    return ModelScorer(PipelineModel(stages=[*prepared.stages, model]))


def fit_logistic(train: DataFrame, balanced: bool = False, max_iter: int = 1000) -> ModelScorer:
    frame = with_class_weight(train) if balanced else train
    rows = frame.agg((F.sum("weight") if balanced else F.count(F.lit(1))).alias("n")).first()["n"]
    return fit(frame, "linear", logistic(float(rows), max_iter, "weight" if balanced else None))


def fit_tree(train: DataFrame) -> ModelScorer:
    return fit(train, "tree", decision_tree(train.count()))


def fit_weighted_forest(train: DataFrame, balanced: bool = True, trees: int = 240) -> ModelScorer:
    frame = with_class_weight(train) if balanced else train
    return fit(frame, "tree", weighted_forest(frame.count(), "weight" if balanced else None, trees))


def fit_platt(scores: DataFrame) -> tuple[float, float]:
    """Slope and intercept of an unpenalised logistic curve on (score, label) with smoothed targets.

    Each row enters twice, once per class, weighted by its smoothed target; identical scores are merged
    first, so the fit runs over distinct scores.
    """
    counts = scores.select(F.round("s", 6).alias("s"), LABEL).groupBy("s").agg(
        F.sum(F.when(F.col(LABEL) == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(LABEL) == 0, 1).otherwise(0)).alias("neg"))
    totals = counts.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).first()
    high = (totals["pos"] + 1.0) / (totals["pos"] + 2.0)
    low = 1.0 / (totals["neg"] + 2.0)
    rows = counts.select(
        array_to_vector(F.array("s")).alias("features"),
        F.explode(F.array(
            F.struct(F.lit(1.0).alias("label"), (F.col("pos") * high + F.col("neg") * low).alias("w")),
            F.struct(F.lit(0.0).alias("label"), (F.col("pos") * (1 - high) + F.col("neg") * (1 - low)).alias("w")),
        )).alias("r"),
    ).select("features", "r.label", "r.w").where(F.col("w") > 0)
    fitted = LogisticRegression(weightCol="w", regParam=0.0, maxIter=200).fit(rows)
    return float(fitted.coefficients[0]), float(fitted.intercept)


def fit_calibrated(train: DataFrame, branch: str, estimator: Estimator, folds: int = fixed.CALIBRATION_FOLDS,
                   key: str = "row_id", fold: Callable | None = None) -> CalibratedScorer:
    """Per fold: fit on the others, score the held-out fold, fit the curve on those scores. Folds are fitted at the same
    time; `fold(k, build)` may give a fold's model and curve that an earlier run has left instead of building them."""
    marked = train.withColumn("fold", fold_column(key, folds, f"{fixed.SEED}:calibration"))

    def part(k: int) -> tuple[PipelineModel, float, float]:
        model = fit(marked.where(F.col("fold") != k), branch, estimator.copy()).model
        held = model.transform(marked.where(F.col("fold") == k)).select(raw_score(model).alias("s"), LABEL)
        slope, intercept = fit_platt(held)
        if not (math.isfinite(slope) and math.isfinite(intercept)):
            raise AnalysisError("the calibration curve did not converge")
        return model, slope, intercept

    one = (lambda k: fold(k, lambda: part(k))) if fold else part
    with ThreadPoolExecutor(folds) as pool:
        return CalibratedScorer(list(pool.map(one, range(folds))))
