"""Registered queries that train models, at full size, on the whole training side of the table."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from intentspark import fixed
from intentspark.operators import explain, learners, resampling, tuning
from intentspark.plans.frames import lines, side
from intentspark.roles import DEFAULT_ROLES

def outer(spark, sf):
    """(outer training rows, held-out rows)."""
    frame = lines(spark, sf)
    return frame.where("split <> 'test'"), side(frame, "test")


def holdout(name, family, build):
    def run(spark, sf):
        train, test = outer(spark, sf)
        return tuning.metric_table(spark, [tuning.measured(build(train), test, name, family)])

    return run


def family_fit(family, index=0):
    def build(train):
        return learners.fit(train, *learners.family_estimator(family, learners.family_grid(family)[index]))

    return build


def calibrated_forest(train):
    return learners.fit_calibrated(train, *learners.family_estimator("random_forest", fixed.FOREST_GRID[0]))


def linear_rows(spark, sf):
    train, _ = outer(spark, sf)
    _, vectors = learners.matrix(train, "linear")
    return vectors.select("row_id", vector_to_array("features").alias("v"), fixed.TARGET)


def smote_resample(spark, sf):
    return resampling.smote(linear_rows(spark, sf)).groupBy("label", "synthetic").agg(
        F.count(F.lit(1)).alias("row_count"), F.round(F.avg(F.element_at("v", 1)), 4).alias("mean_first_feature"))


def smotenc_resample(spark, sf):
    train, _ = outer(spark, sf)
    _, vectors = learners.matrix(train, "tree")
    names = [*DEFAULT_ROLES.matrix_numeric, *DEFAULT_ROLES.matrix_categorical]
    values = vector_to_array("features")
    rows = vectors.select("row_id", fixed.TARGET, *[values[i].alias(n) for i, n in enumerate(names)])
    out = resampling.smote_mixed(rows, list(DEFAULT_ROLES.matrix_numeric), list(DEFAULT_ROLES.matrix_categorical))
    return out.groupBy("label", "synthetic").agg(
        F.count(F.lit(1)).alias("row_count"), F.round(F.avg("AnnualIncome"), 2).alias("mean_income"),
        F.countDistinct("ProductCategory").alias("categories"))


def tuning_history(family):
    """Every candidate of one family; the families are queries of their own."""
    def run(spark, sf):
        frame = lines(spark, sf)
        train, validation = side(frame, "train"), side(frame, "validation")
        return tuning.history_table(spark, [tuning.tune_family(family, train, validation, tuning.shared_store(spark, train, validation))])

    return run


def strategy_suite(spark, sf):
    frame = lines(spark, sf)
    _, table = tuning.strategy_suite(side(frame, "train"), side(frame, "validation"))
    return table


def cv_stability(spark, sf):
    train, _ = outer(spark, sf)
    branch, estimator = learners.family_estimator("random_forest", fixed.FOREST_GRID[0])
    return tuning.cv_stability(train, branch, estimator).withColumn(
        "fold_scores", F.array_join(F.transform("fold_scores", lambda v: F.format_number(v, 6)), "|"))


def permutation(spark, sf):
    train, test = outer(spark, sf)
    return explain.permutation_importance(test, learners.fit_logistic(train))


def shapley(spark, sf):
    train, test = outer(spark, sf)
    scorer = learners.fit_logistic(train)
    return explain.shapley_values(explain.attributions(explain.explained_rows(test), explain.background_sample(train), scorer))


QUERIES = {
    "logistic_holdout": holdout("logistic_regression", "linear_model", learners.fit_logistic),
    "tree_holdout": holdout("decision_tree", "tree_model", learners.fit_tree),
    "forest_holdout": holdout("random_forest_class_weight", "tree_model", learners.fit_weighted_forest),
    "gbt_holdout": holdout("gradient_boosting_base", "gradient_boosting", family_fit("gradient_boosting")),
    "hist_gbt_holdout": holdout("hist_gradient_boosting_base", "hist_gradient_boosting", family_fit("hist_gradient_boosting")),
    "calibrated_forest": holdout("random_forest_sigmoid_calibrated", "random_forest", calibrated_forest),
    "smote_resample": smote_resample,
    "smotenc_resample": smotenc_resample,
    "smote_logistic": holdout("smote_logistic", "linear_model", tuning.fit_smote_logistic),
    "tuning_forest": tuning_history("random_forest"),
    "tuning_gbt": tuning_history("gradient_boosting"),
    "tuning_hist_gbt": tuning_history("hist_gradient_boosting"),
    "strategy_suite": strategy_suite,
    "cv_stability": cv_stability,
    "permutation_importance": permutation,
    "shapley_values": shapley,
}
