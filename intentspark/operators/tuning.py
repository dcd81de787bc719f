"""Candidate suites: grid search per family, imbalance strategies, fold stability."""

from __future__ import annotations

import hashlib
import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.errors import IllegalArgumentException

from intentspark import fixed
from intentspark.errors import AnalysisError
from intentspark.operators import learners
from intentspark.operators.metrics import METRICS, cv_summary, evaluate, evaluate_model
from intentspark.operators.resampling import smote, smote_mixed
from intentspark.operators.scorers import Scorer
from intentspark.operators.selection import champion_challenger, choose_variant, require_pair
from intentspark.operators.splits import assign_folds
from intentspark.roles import DEFAULT_ROLES
from intentspark.sources.sinks import load_model, read_stage, save_model, write_table

PARALLEL_FITS = 4
COUNTS = ("row_count", "tn", "fp", "fn", "tp")


@dataclass
class FamilyOutcome:
    family: str
    best: dict
    history: list[dict]
    variant: str
    scorer: Scorer
    metrics: dict = field(default_factory=dict)


class FitStore:
    """Fitted models under a folder every executor shares, each below a key of its content: data, family and parameters.

    A model is saved before its facts (metrics, calibration curve), and only a fit with facts counts, so a run that was
    ended leaves whole fits or nothing; the next run over the same rows fits what is absent."""

    def __init__(self, spark: SparkSession, folder: str, *data: DataFrame):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.data = [self.fingerprint(d) for d in data]

    @staticmethod
    def fingerprint(df: DataFrame) -> list[str]:
        """Row count and two order-free sums over the hashes of the modelling columns, from one pass."""
        columns = [c for c in ("row_id", *DEFAULT_ROLES.base_inputs, fixed.TARGET) if c in df.columns]
        h = F.xxhash64(*columns)
        row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(20,0)")).alias("a"), F.bit_xor(h).alias("b")).first()
        return [str(row["n"]), str(row["a"]), str(row["b"])]

    def key(self, *what) -> str:
        return hashlib.sha256(json.dumps([self.data, *what], sort_keys=True).encode()).hexdigest()[:32]

    def get(self, key: str) -> tuple[PipelineModel, dict] | None:
        facts = read_stage(self.spark, self.folder, f"{key}/facts")
        return None if facts is None else (load_model(f"{self.folder}/{key}/model"), json.loads(facts.first()["facts"]))

    def put(self, key: str, model: PipelineModel, facts: dict) -> None:
        save_model(model, f"{self.folder}/{key}/model")
        write_table(self.spark.createDataFrame([(json.dumps(facts),)], "facts string"), f"{self.folder}/{key}/facts")


def shared_store(spark: SparkSession, *data: DataFrame) -> FitStore | None:
    """A store below ``spark.checkpoint.dir``; none where the session names no shared folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    return FitStore(spark, f"{base.rstrip('/')}/fits", *data) if base else None


def measured(scorer: Scorer, frame: DataFrame, name: str, family: str) -> dict:
    """Metric row of a scorer on a frame as driver scalars; the rows are scored once, dealt to all tasks by their key."""
    if "row_id" in frame.columns:
        frame = frame.repartition(int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")), "row_id")
    scored = learners.keep(scorer.score(frame).select("p", "yhat", fixed.TARGET))
    row = evaluate_model(scored, name, family).first().asDict()
    scored.unpersist()
    return row


def metric_table(spark, rows: list[dict]) -> DataFrame:
    """Metric rows back as a table, one per model."""
    schema = ("model_name string, family string, positive_rate double, calibration_gap double, "
              + ", ".join(f"{m} double" for m in METRICS) + ", " + ", ".join(f"{c} bigint" for c in COUNTS))
    names = [part.split()[0] for part in schema.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)


def rank_tuple(m: dict) -> tuple:
    """Python twin of the ranking order, for comparisons between two fits in the loop."""
    known = lambda v: -1.0 if v is None else v
    gap = m.get("calibration_gap")
    return (known(m["pr_auc"]), known(m["balanced_accuracy"]), known(m["roc_auc"]), -m["brier_score"],
            -1.0 if gap is None else -gap)


def tune_family(family: str, train: DataFrame, validation: DataFrame, store: FitStore | None = None) -> FamilyOutcome:
    """Fits every candidate of the family's grid on one kept matrix, a few at a time; with a store only those it lacks.

    A candidate whose parameters are refused is recorded and skipped; if all are, so is the family. Any other error ends
    the tuning: a lost executor must not narrow the choice. The winner already
    fitted is the base variant, its calibrated twin is fitted next to it and the better one is chosen.
    """
    grid = list(learners.family_grid(family))
    branch, _ = learners.family_estimator(family, grid[0])
    held = [store.get(store.key(family, params)) if store else None for params in grid]
    prepared, vectors = learners.matrix(train, branch) if None in held else (None, None)

    def candidate(params: dict, known: tuple | None):
        if known is not None:
            return learners.ModelScorer(known[0]), known[1], None
        try:
            scorer = learners.joined(prepared, learners.family_estimator(family, params)[1].fit(vectors))
            m = measured(scorer, validation, f"{family}_base", family)
            if store:
                store.put(store.key(family, params), scorer.model, m)
            return scorer, m, None
        except IllegalArgumentException as error:  # parameters that the data cannot bear only cost this candidate
            return None, None, f"{type(error).__name__}: {str(error)[:200]}"

    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        results = list(pool.map(candidate, grid, held))
    if vectors is not None:
        vectors.unpersist()
    history, winner = [], None
    for i, (params, (scorer, m, error)) in enumerate(zip(grid, results), start=1):
        history.append({"candidate_id": f"{family}_{i}", "family": family, "params": params, "metrics": m, "error": error})
        if m is not None and (winner is None or rank_tuple(m) > rank_tuple(winner[1])):
            winner = (scorer, m, params)
    if winner is None:
        raise AnalysisError(f"no candidate of {family} could be fitted")
    scorer, base, params = winner
    variant, chosen = "base", base
    try:
        calibrated = calibrate(family, params, train, store)
        m = measured(calibrated, validation, f"{family}_sigmoid_calibrated", family)
        pair = metric_table(train.sparkSession, [{**base, "model_name": "base"}, {**m, "model_name": "sigmoid_calibrated"}])
        variant = choose_variant(pair).first()["selected_variant"]
        if variant == "sigmoid_calibrated":
            scorer, chosen = calibrated, m
    except AnalysisError as error:
        history.append({"candidate_id": f"{family}_calibrated", "family": family, "params": params, "metrics": None, "error": str(error)})
    return FamilyOutcome(family, params, history, variant, scorer, chosen)


def calibrate(family: str, params: dict, train: DataFrame, store: FitStore | None = None) -> learners.CalibratedScorer:
    """The calibrated twin of a candidate; with a store every fold's model and curve is a fit of its own."""
    branch, estimator = learners.family_estimator(family, params)
    if store is None:
        return learners.fit_calibrated(train, branch, estimator)

    def fold(k: int, build) -> tuple[PipelineModel, float, float]:
        key = store.key(family, params, "calibration", k)
        known = store.get(key)
        if known is None:
            model, slope, intercept = build()
            store.put(key, model, {"slope": slope, "intercept": intercept})
            return model, slope, intercept
        return known[0], known[1]["slope"], known[1]["intercept"]

    return learners.fit_calibrated(train, branch, estimator, fold=fold)


def history_table(spark, outcomes: list[FamilyOutcome]) -> DataFrame:
    rows = []
    for outcome in outcomes:
        for h in outcome.history:
            m = h["metrics"] or {}
            rows.append((h["candidate_id"], h["family"], json.dumps(h["params"]), h["params"] == outcome.best, outcome.variant,
                         *[m.get(n) for n in METRICS], m.get("calibration_gap"), h["error"]))
    return spark.createDataFrame(
        rows, "candidate_id string, family string, params string, is_best boolean, selected_variant string, "
        + ", ".join(f"{n} double" for n in METRICS) + ", calibration_gap double, error string")


def refit(outcome: FamilyOutcome, train: DataFrame) -> Scorer:
    """The chosen variant on the outer training set (train and validation), for the outer test."""
    branch, estimator = learners.family_estimator(outcome.family, outcome.best)
    if outcome.variant == "sigmoid_calibrated":
        return learners.fit_calibrated(train, branch, estimator)
    return learners.fit(train, branch, estimator)


def cv_stability(train: DataFrame, branch: str, estimator, folds: int = fixed.CV_FOLDS) -> DataFrame:
    """Per-metric spread of the model over hash folds; each fold is scored by the model that never saw it."""
    marked = assign_folds(train, folds=folds)
    scored = None
    for k in range(folds):
        scorer = learners.fit(marked.where(F.col("fold") != k), branch, estimator)
        held = scorer.score(marked.where(F.col("fold") == k)).select("fold", "p", "yhat", fixed.TARGET)
        scored = held if scored is None else scored.unionByName(held)
    return cv_summary(evaluate(scored, ["fold"]))


def champion_run(families: tuple[str, ...], train: DataFrame, validation: DataFrame, test: DataFrame,
                 store: FitStore | None = None) -> tuple[dict[str, Scorer], DataFrame]:
    """Tune every family, choose champion and challenger on validation rows, fit both anew on train and validation, and
    measure them on the outer test: {"champion": scorer, "challenger": scorer} and one row each with its role."""
    outcomes = {f: tune_family(f, train, validation, store) for f in families}
    spark = train.sparkSession
    choice = require_pair(champion_challenger(metric_table(spark, [{**o.metrics, "model_name": f, "family": f} for f, o in outcomes.items()])))
    outer = train.unionByName(validation)
    scorers = {role: refit(outcomes[choice[role]], outer) for role in ("champion", "challenger")}
    rows = [measured(scorers[role], test, choice[role], role) for role in scorers]
    return scorers, metric_table(spark, rows).withColumnRenamed("family", "role")


def fit_smote_logistic(train: DataFrame) -> Scorer:
    """Oversampling in the one-hot space of the training rows only, then logistic regression."""
    prepared, vectors = learners.matrix(train, "linear")
    rows = vectors.select("row_id", vector_to_array("features").alias("v"), fixed.TARGET)
    balanced = learners.keep(smote(rows).select(array_to_vector("v").alias("features"), F.col("label").alias(fixed.TARGET)))
    model = learners.logistic(float(balanced.count()), max_iter=2000).fit(balanced)
    balanced.unpersist()
    vectors.unpersist()
    return learners.joined(prepared, model)


def fit_smotenc_forest(train: DataFrame, trees: int = 240) -> Scorer:
    """Mixed-space oversampling on the ordinal matrix, then a plain forest."""
    prepared, vectors = learners.matrix(train, "tree")
    names = [*DEFAULT_ROLES.matrix_numeric, *DEFAULT_ROLES.matrix_categorical]
    values = vector_to_array("features")
    rows = vectors.select("row_id", fixed.TARGET, *[values[i].alias(n) for i, n in enumerate(names)])
    resampled = smote_mixed(rows, list(DEFAULT_ROLES.matrix_numeric), list(DEFAULT_ROLES.matrix_categorical))
    balanced = learners.keep(resampled.select(
        array_to_vector(F.array(*names)).alias("features"), F.col("label").alias(fixed.TARGET)))
    model = learners.weighted_forest(vectors.count(), None, trees).fit(balanced)
    balanced.unpersist()
    vectors.unpersist()
    return learners.joined(prepared, model)


def strategy_suite(train: DataFrame, evaluation: DataFrame, trees: int = 240) -> tuple[dict[str, Scorer], DataFrame]:
    """The five imbalance strategies, fitted on train, measured on rows that were never resampled."""
    fits = {
        "logistic_reference": ("linear_model", lambda: learners.fit_logistic(train, max_iter=2000)),
        "logistic_class_weight": ("linear_model", lambda: learners.fit_logistic(train, balanced=True, max_iter=2000)),
        "random_forest_class_weight": ("tree_model", lambda: learners.fit_weighted_forest(train, True, trees)),
        "smote_logistic": ("linear_model", lambda: fit_smote_logistic(train)),
        "smotenc_random_forest": ("tree_model", lambda: fit_smotenc_forest(train, trees)),
    }
    scorers, rows = {}, []
    for name, (family, build) in fits.items():
        scorers[name] = build()
        rows.append(measured(scorers[name], evaluation, name, family))
    return scorers, metric_table(train.sparkSession, rows)
