"""Registered queries: splits, deterministic scorers, metrics, selection, fairness."""

from __future__ import annotations

from pyspark.sql import functions as F

from intentspark import fixed
from intentspark.operators import fairness, features, metrics, selection, splits
from intentspark.operators.scorers import PriorScorer, RandomScorer, RuleScorer, Scorecard, purchase_percent, score_discount, scorecard_drivers
from intentspark.plans.frames import clean_customers, lines, rule_scored_lines, scored_lines, side

KEYS = ["row_id", "split"]


def candidates(spark, sf, name="test"):
    """Metric rows of the four deterministic scorers on one side of the split."""
    frame = lines(spark, sf)
    train, held = side(frame, "train"), side(frame, name)
    prior = PriorScorer.fit(train)
    return metrics.evaluate_models(metrics.score_with_all(held, [
        ("majority_baseline", "dummy", prior),
        ("random_baseline", "dummy", RandomScorer(prior.prior)),
        ("rule_based_baseline", "heuristic", RuleScorer.fit(train)),
        ("scorecard", "heuristic", Scorecard()),
    ]))


def as_candidates(spark, sf, names: dict[str, str]):
    """Deterministic metric rows standing in for learned models of a selection rule."""
    mapped = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    rows = candidates(spark, sf).where(F.col("model_name").isin(*names))
    return rows.withColumn("model_name", mapped[F.col("model_name")])


def label_counts(df):
    return df.groupBy("split", F.col("PurchaseStatus").alias("label")).agg(F.count(F.lit(1)).alias("row_count"))


def scored_summary(df):
    """Score distribution of a scorer over the whole table."""
    return df.groupBy("p", "yhat").agg(F.count(F.lit(1)).alias("row_count"))


def threshold_gain(spark, sf):
    scored = rule_scored_lines(spark, sf)
    return metrics.threshold_transfer(side(scored, "validation"), side(scored, "test"))


def folds(spark, sf):
    frame = lines(spark, sf).where("split <> 'test'")
    return metrics.evaluate(Scorecard().score(splits.assign_folds(frame)), ["fold"])


def matrix_frame(spark, sf, branch):
    frame = clean_customers(spark, sf)
    engineered = features.FeatureBuilder().fit(side(frame, "train")).transform(frame)
    return features.MatrixBuilder(branch=branch).fit(side(engineered, "train")), engineered


def imputed(spark, sf):
    model, frame = matrix_frame(spark, sf, "linear")
    return features.imputed(model, frame)


def standardised(spark, sf):
    model, frame = matrix_frame(spark, sf, "linear")
    return features.standardised_summary(model, side(frame, "test"))


def one_hot(spark, sf):
    model, frame = matrix_frame(spark, sf, "linear")
    return features.one_hot_counts(model, side(frame, "test"))


def ordinal(spark, sf):
    model, frame = matrix_frame(spark, sf, "tree")
    codes = model.category_codes()
    return side(frame, "test").select("row_id", *[codes[c].cast("int").alias(c) for c in codes])


def checks(spark, sf):
    model, frame = matrix_frame(spark, sf, "linear")
    return features.matrix_checks(model, {n: side(frame, n) for n in ("train", "validation", "test")})


def design_matrix(spark, sf):
    model, frame = matrix_frame(spark, sf, "linear")
    return model.transform(frame).select("row_id", "split", F.col("features").cast("string").alias("features"))


def engineered(spark, sf):
    frame = clean_customers(spark, sf)
    model = features.FeatureBuilder().fit(side(frame, "train"))
    return model.transform(frame).select(
        "row_id", *fixed.ENGINEERED_CATEGORICAL,
        *[F.round(c, 6).alias(c) for c in fixed.ENGINEERED_NUMERIC[:2]], *fixed.ENGINEERED_NUMERIC[2:])


QUERIES = {
    "stratified_split": lambda s, d: label_counts(splits.hash_split(lines(s, d).drop("split"))),
    "stratified_split_exact": lambda s, d: splits.exact_split(clean_customers(s, d).drop("split")).select(*KEYS),
    "nested_split": lambda s, d: label_counts(lines(s, d)),
    "split_distribution": lambda s, d: splits.split_distribution(clean_customers(s, d)),
    "fold_assignment": lambda s, d: splits.assign_folds(clean_customers(s, d).where("split <> 'test'")).select("row_id", "fold"),
    "sample_rows": lambda s, d: splits.sample_rows(lines(s, d), 60).select("row_id", "Age", "PurchaseStatus"),
    "class_weights": lambda s, d: splits.class_weights(side(lines(s, d), "train")),
    "engineered_features": engineered,
    "imputed": imputed,
    "standardized": standardised,
    "one_hot": one_hot,
    "ordinal_encoded": ordinal,
    "design_matrix": design_matrix,
    "matrix_checks": checks,
    "baseline_prior": lambda s, d: scored_summary(PriorScorer.fit(side(lines(s, d), "train")).score(lines(s, d))),
    "baseline_random": lambda s, d: scored_summary(RandomScorer.fit(side(lines(s, d), "train")).score(lines(s, d))),
    "rule_baseline_score": lambda s, d: scored_summary(rule_scored_lines(s, d)),
    "scorecard": lambda s, d: scored_lines(s, d).select("row_id", "p", "yhat"),
    "scorecard_drivers": lambda s, d: scorecard_drivers(lines(s, d)).groupBy(
        F.array_join("drivers", "|").alias("drivers")).agg(F.count(F.lit(1)).alias("row_count")),
    "score_discount": lambda s, d: scored_lines(s, d).groupBy(
        purchase_percent(F.col("p")).alias("score_percent"), score_discount(purchase_percent(F.col("p"))).alias("discount_rate")
    ).agg(F.count(F.lit(1)).alias("row_count")),
    "classifier_metrics": candidates,
    "roc_auc": lambda s, d: metrics.evaluate(scored_lines(s, d), ["split"]).select("split", "roc_auc"),
    "average_precision": lambda s, d: metrics.evaluate(scored_lines(s, d), ["split"]).select("split", "pr_auc"),
    "pr_curve": lambda s, d: metrics.pr_curve(side(scored_lines(s, d), "test")),
    "calibration_curve": lambda s, d: metrics.calibration_curve(side(scored_lines(s, d), "test")),
    "threshold_metrics": lambda s, d: metrics.threshold_metrics(scored_lines(s, d), 0.5),
    "threshold_sweep": lambda s, d: metrics.threshold_sweep(scored_lines(s, d)),
    "optimal_threshold": lambda s, d: metrics.optimal_threshold(side(scored_lines(s, d), "validation")),
    "decision_bands": lambda s, d: metrics.with_decision_bands(
        metrics.optimal_threshold(side(scored_lines(s, d), "validation"))).select(
            "low_action_threshold", "binary_decision_threshold", "high_confidence_no_discount_threshold"),
    "threshold_transfer": threshold_gain,
    "intent_band_summary": lambda s, d: metrics.intent_band_summary(
        side(scored_lines(s, d), "test"), metrics.learn_bands(side(scored_lines(s, d), "validation"))),
    "calibration_followup": lambda s, d: metrics.calibration_followup(
        candidates(s, d), ("rule_based_baseline", "scorecard")).select("model_name", "calibration_gap", "brier_score"),
    "segment_performance": lambda s, d: metrics.segment_performance(scored_lines(s, d)),
    "cv_summary": lambda s, d: metrics.cv_summary(folds(s, d)).withColumn(
        "fold_scores", F.array_join(F.transform("fold_scores", lambda v: F.format_number(v, 6)), "|")),
    "recommend_baseline": lambda s, d: selection.recommend_baseline(as_candidates(s, d, {
        "rule_based_baseline": "logistic_regression", "scorecard": "decision_tree"})),
    "recommend_strategy": lambda s, d: selection.recommend_strategy(as_candidates(s, d, {
        "random_baseline": "logistic_reference", "rule_based_baseline": "logistic_class_weight", "scorecard": "smote_logistic"})),
    "model_ranking": lambda s, d: selection.rank_models(candidates(s, d)).select("model_name", "rank"),
    "choose_variant": lambda s, d: selection.choose_variant(as_candidates(s, d, {
        "scorecard": "base", "rule_based_baseline": "sigmoid_calibrated"})),
    "champion_challenger": lambda s, d: selection.champion_challenger(as_candidates(s, d, {
        "random_baseline": "random_forest", "scorecard": "gradient_boosting", "rule_based_baseline": "hist_gradient_boosting"})),
    "fairness_metrics": lambda s, d: fairness.fairness_metrics(scored_lines(s, d)),
    "fairness_gaps": lambda s, d: fairness.fairness_gaps(scored_lines(s, d)),
    "fairness_alerts": lambda s, d: fairness.fairness_alerts(fairness.fairness_gaps(scored_lines(s, d))),
    "fairness_top": lambda s, d: fairness.fairness_top(fairness.fairness_gaps(scored_lines(s, d))),
}
