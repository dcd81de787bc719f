import pytest
from pyspark.sql import functions as F

from intentspark import fixed
from intentspark.errors import ContractError
from intentspark.operators import fairness, gates, metrics, policy, profiling, selection, splits
from intentspark.operators.scorers import RuleScorer, Scorecard, score_discount
from intentspark.plans.frames import lines, scored_lines, side

BANDS = {"low": 0.2, "binary": 0.3, "high": 0.45}


def scored(spark, rows):
    return spark.createDataFrame(rows, "PurchaseStatus int, p double, yhat int")


def test_imbalance(spark):
    df = spark.createDataFrame([(0,)] * 80 + [(1,)] * 60, "PurchaseStatus int")
    row = profiling.imbalance_profile(df).first()
    assert row["severity"] == "mild" and row["minority_to_majority_ratio"] == 0.75 and row["minority_label"] == "1"


def test_threshold_metrics(spark):
    df = scored(spark, [(0, 0.1, 0), (0, 0.7, 1), (1, 0.6, 0), (1, 0.9, 1)])
    row = metrics.threshold_metrics(df, 0.65).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (1, 1, 1, 1)
    assert row["precision"] == row["recall"] == 0.5


def test_slice_metrics(spark):
    df = scored(spark, [(0, 0.2, 0), (0, 0.6, 1), (1, 0.7, 1), (1, 0.8, 1)])
    row = metrics.evaluate(df, slices=True).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (1, 1, 0, 2)
    assert row["precision"] == pytest.approx(0.666667)
    one_class = metrics.evaluate(df.where("PurchaseStatus = 1"), slices=True).first()
    assert one_class["roc_auc"] is None and one_class["balanced_accuracy"] is None


def test_ranking_metrics_with_ties(spark):
    df = scored(spark, [(0, 0.1, 0), (0, 0.4, 0), (1, 0.4, 0), (1, 0.8, 1)])
    row = metrics.evaluate(df).first()
    assert row["roc_auc"] == 0.875 and row["pr_auc"] == pytest.approx(0.833333)


def test_decision_bands_keep_order(spark):
    for centre in (0.22, 0.3, 0.5, 0.8):
        row = metrics.with_decision_bands(spark.createDataFrame([(centre,)], "threshold double")).first()
        assert 0 < row["low_action_threshold"] < row["binary_decision_threshold"] < row["high_confidence_no_discount_threshold"] < 1
    with pytest.raises(ContractError):
        metrics.learn_bands(scored(spark, []))


def test_cv_summary(spark):
    df = spark.createDataFrame(
        [(0, 0.8, 0.7, 0.8), (1, 0.81, 0.71, 0.81), (2, 0.82, 0.72, 0.82)], "fold int, pr_auc double, balanced_accuracy double, roc_auc double")
    got = {r["metric_name"]: r for r in metrics.cv_summary(df).collect()}
    assert got["pr_auc"]["mean_value"] == 0.81 and got["balanced_accuracy"]["std_value"] == 0.008165


def metric_rows(spark, rows):
    return spark.createDataFrame(
        [(n, ap, ba, auc, brier, gap, 0.6, 0.6) for n, ap, ba, auc, brier, gap in rows],
        "model_name string, pr_auc double, balanced_accuracy double, roc_auc double, brier_score double, "
        "calibration_gap double, recall double, precision double")


def test_selection_rules(spark):
    close = metric_rows(spark, [("logistic_regression", 0.8, 0.75, 0.8, 0.18, 0.03), ("decision_tree", 0.8, 0.76, 0.81, 0.17, 0.03)])
    assert selection.recommend_baseline(close).first()["recommended_model"] == "logistic_regression"
    families = metric_rows(spark, [
        ("random_forest", 0.820, 0.74, 0.85, 0.15, 0.04), ("gradient_boosting", 0.80, 0.73, 0.84, 0.16, 0.05),
        ("hist_gradient_boosting", 0.825, 0.745, 0.855, 0.15, 0.04)])
    row = selection.champion_challenger(families).first()
    assert (row["champion"], row["challenger"]) == ("random_forest", "hist_gradient_boosting")
    with pytest.raises(ContractError):
        selection.require_pair(selection.champion_challenger(families.where("model_name = 'random_forest'")))
    pair = metric_rows(spark, [("base", 0.8, 0.7, 0.8, 0.2, 0.06), ("sigmoid_calibrated", 0.799, 0.7, 0.8, 0.17, 0.03)])
    assert selection.choose_variant(pair).first()["selected_variant"] == "sigmoid_calibrated"


def test_rule_baseline(spark):
    df = spark.createDataFrame([(1, 5.0, 0), (9, 30.0, 1), (None, None, None)], "NumberOfPurchases int, TimeSpentOnWebsite double, LoyaltyProgram int")
    model = RuleScorer.fit(df)
    assert model.config() == {"purchase_threshold": 5.0, "time_threshold": 17.5}
    assert all(0 <= r["p"] <= 1 for r in model.score(df).collect())
    with pytest.raises(ContractError):
        RuleScorer.fit(df.drop("LoyaltyProgram"))


def test_score_bands_and_actions(spark):
    df = spark.createDataFrame(
        [(0.10, 0), (0.25, 0), (0.35, 0), (0.70, 0), (0.24, 3), (0.29, 4), (0.24, None)], "p double, DiscountsAvailed int")
    rows = policy.decide(df, BANDS).orderBy("p", "DiscountsAvailed").collect()
    by = {(r["p"], r["DiscountsAvailed"]): r for r in rows}
    assert [by[(p, 0)]["score_band"] for p in (0.10, 0.25, 0.35, 0.70)] == [b for b, _ in fixed.BAND_ACTIONS]
    assert by[(0.24, 3)]["recommended_action"] == "targeted_light_discount"
    assert by[(0.24, 3)]["guardrail_flags"] == ["discount_intensity_downgraded"]
    assert by[(0.29, 4)]["recommended_action"] == "manual_review_discount_cap"
    assert by[(0.29, 4)]["guardrail_flags"] == ["historical_discount_saturation", "threshold_boundary_review"]
    assert by[(0.24, None)]["proxy_incremental_value"] > 0
    assert len(rows) == 7


def test_band_validation_and_bad_scores(spark):
    for bad in ({"low": 0.2, "binary": 0.3}, {"low": 0.4, "binary": 0.3, "high": 0.5}):
        with pytest.raises(ContractError):
            policy.validate_bands(bad)
    df = spark.createDataFrame([(0.5,), (1.2,), (None,), (float("nan"),)], "p double")
    good, rejected = policy.split_bad_scores(df)
    assert good.count() == 1 and rejected.count() == 3
    kept, negative = policy.reject_negative_history(spark.createDataFrame([(1,), (-1,), (None,)], "DiscountsAvailed int"))
    assert kept.count() == 2 and negative.count() == 1


def test_fairness_and_guardrail(spark):
    df = scored(spark, [(0, 0.2, 0), (0, 0.6, 1), (1, 0.7, 1), (1, 0.8, 1)])
    row = fairness.overall_metrics(df).first()
    assert row["positive_prediction_rate"] == 0.75 and row["false_positive_rate"] == 0.5
    gaps = spark.createDataFrame([("Gender", "gender_0", "recall", 0.13), ("Gender", "gender_1", "recall", 0.11)],
                                 "segment_name string, segment_value string, metric_name string, gap_value double")
    assert fairness.fairness_alerts(gaps).count() == 1
    decided = spark.createDataFrame([(1, True), (1, True), (0, False), (0, False)], "LoyaltyProgram int, discount_offered boolean")
    status = {r["guardrail_id"]: r["status"] for r in policy.guardrail_status(decided, 0).collect()}
    assert status["loyalty_fairness_monitor"] == "alert"


def test_scorecard_profiles(spark):
    percents = spark.createDataFrame([(75,), (74,), (73,), (71,), (0,)], "s int")
    assert [r[0] for r in percents.select(score_discount(F.col("s"))).collect()] == [0.0, 0.01, 0.01, 0.02, 0.38]
    profiles = spark.createDataFrame(
        [(28, 1, 72663.35, 17, 1, 58.9, 1), (35, 0, 120000.0, 3, 2, 48.0, 0)],
        "Age int, Gender int, AnnualIncome double, NumberOfPurchases int, ProductCategory int, TimeSpentOnWebsite double, LoyaltyProgram int")
    strong, medium = policy.scorecard_offer(Scorecard().score(profiles)).orderBy("Age").collect()
    assert strong["risk_band"] == "high_confidence_no_discount" and strong["automatic_discount_rate"] == 0
    assert medium["risk_band"] in ("lower_targeting_band", "upper_targeting_band") and medium["automatic_discount_rate"] > 0


def test_split_invariants(spark, sf, monkeypatch):
    frame = lines(spark, sf)
    counts = {r["split"]: r["count"] for r in frame.groupBy("split").count().collect()}
    assert set(counts) == {"train", "validation", "test"} and sum(counts.values()) == frame.count()
    monkeypatch.setattr(splits, "prefix_digits", lambda rows: 2)
    exact = splits.exact_split(frame.drop("split"))
    for r in exact.groupBy("PurchaseStatus").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("split") == "test").alias("t")).collect():
        assert r["t"] == round(r["n"] * 0.2)
    with pytest.raises(ContractError):
        splits.exact_split(frame.where("PurchaseStatus = 1"))
    with pytest.raises(ContractError):
        splits.sample_rows(frame, 0)


def test_results_do_not_depend_on_partitioning(spark, sf):
    df = side(scored_lines(spark, sf), "test")
    assert metrics.evaluate(df).collect() == metrics.evaluate(df.repartition(13, "row_id")).collect()
    row = metrics.evaluate(df).first()
    assert row["tn"] + row["fp"] + row["fn"] + row["tp"] == row["row_count"] == df.count()


def test_stage_checks(spark):
    good = [("a", 10, 9, "m"), ("b", 10, 9, None), ("c", None, 9, "m")]
    schema = "stage string, raw_rows bigint, dedup_rows bigint, champion string"
    gates.require_consistent(spark.createDataFrame(good, schema))
    with pytest.raises(ContractError):
        gates.require_consistent(spark.createDataFrame(good + [("d", None, 9, "other")], schema))
    with pytest.raises(ContractError):
        gates.same_bands(BANDS, {**BANDS, "low": 0.1})
    checks = spark.createDataFrame([("a", True, True), ("b", False, True), ("c", True, False)], "check_id string, present boolean, passed boolean")
    rows = {r["check_id"]: r for r in gates.readiness(checks).collect()}
    assert rows["b"]["status"] == "missing" and rows["a"]["overall_status"] == "revision_needed"


def test_every_readiness_check_can_fail(spark):
    schema = ("scored_rows bigint, unusable_scores bigint, edge_rows bigint, edge_failures bigint, variant_rows bigint, "
              "unusable_variants bigint, compared_rows bigint, deterministic boolean, segments bigint, alerts bigint")
    good = {"scored_rows": 9, "unusable_scores": 0, "edge_rows": 4, "edge_failures": 0, "variant_rows": 8, "unusable_variants": 0,
            "compared_rows": 18, "deterministic": True, "segments": 3, "alerts": 2}
    planted = [({}, None, "ready"), ({"scored_rows": 0}, "scored_table", "missing"),
               ({"unusable_scores": 1}, "scored_table", "revision_needed"), ({"edge_rows": 0}, "edge_case_controls", "missing"),
               ({"edge_failures": 2}, "edge_case_controls", "revision_needed"), ({"variant_rows": 0}, "sensitivity_analysis", "missing"),
               ({"unusable_variants": 1}, "sensitivity_analysis", "revision_needed"), ({"compared_rows": 0}, "reproducibility", "missing"),
               ({"deterministic": None}, "reproducibility", "revision_needed"), ({"segments": 0}, "fairness_followup", "missing"),
               ({"alerts": None}, "fairness_followup", "revision_needed")]
    for change, wrong, overall in planted:
        figures = spark.createDataFrame([tuple({**good, **change}.values())], schema)
        rows = gates.readiness(gates.validation_checks(figures)).collect()
        assert len(rows) == 5 and {r["overall_status"] for r in rows} == {overall}
        assert {r["check_id"] for r in rows if r["status"] != "ready"} == ({wrong} if wrong else set())


def test_hot_paths_stay_in_the_jvm(spark, sf):
    """No Python in scoring, policy or metric plans, and no nested-loop or cartesian join."""
    for df in (policy.decide(scored_lines(spark, sf)), metrics.segment_performance(scored_lines(spark, sf)),
               metrics.threshold_sweep(scored_lines(spark, sf))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        for word in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in plan


def test_rows_without_a_usable_score_get_no_action_and_no_metrics(spark):
    nan = float("nan")
    df = spark.createDataFrame([(None, 0), (nan, 0), (1.7, 0), (-0.3, 0), (0.5, -2), (0.25, 0)], "p double, DiscountsAvailed int")
    rows = policy.decide(df).collect()
    flags = [(r["score_band"], r["recommended_action"] is None, r["requires_manual_review"], list(r["guardrail_flags"])) for r in rows]
    assert sorted(flags, key=str).count(("unscored", True, True, ["score_rejected"])) == 4
    assert ("high_confidence_no_discount", True, True, ["history_rejected"]) in flags
    good, bad = policy.split_bad_scores(df)
    assert good.count() == 2 and bad.count() == 4
    labelled = df.selectExpr("p", "1 as PurchaseStatus", "1 as yhat")
    for bad_value in (None, nan, 1.7, -0.3):
        part = labelled.where("p is null" if bad_value is None else f"p <=> double('{bad_value}')")
        with pytest.raises(Exception, match="no score in"):
            metrics.evaluate(part).collect()
    assert {r["policy_band"] for r in metrics.intent_band_summary(labelled, fixed.DEFAULT_BANDS).collect()} >= {"unscored"}


def test_alignment_fails_on_a_model_that_only_one_side_has(spark):
    schema = "model_name string, pr_auc double, balanced_accuracy double, brier_score double"
    one = spark.createDataFrame([("a", 0.5, None, 0.1)], schema)
    other = spark.createDataFrame([("b", 0.5, 0.4, 0.1)], schema)
    assert not any(r["aligned"] for r in policy.metric_alignment(one, other).collect())
    assert all(r["aligned"] for r in policy.metric_alignment(one, one).collect())


def test_stage_figures_must_be_reported_twice_and_agree(spark):
    schema = "stage string, raw_rows bigint, dedup_rows bigint, champion string"
    status = lambda rows: {r["check_id"]: r["status"] for r in gates.stage_consistency(spark.createDataFrame(rows, schema)).collect()}
    assert set(status([("a", 5, 4, "m"), ("b", 5, 4, "m")]).values()) == {"passed"}
    assert set(status([("a", 5, 4, "m"), ("b", None, None, None)]).values()) == {"failed"}
    assert set(status([("a", 5, 4, "m"), ("b", 6, 3, "n")]).values()) == {"failed"}


def test_offsets_of_every_level(spark, monkeypatch):
    from intentspark.functions import quantiles

    monkeypatch.setattr(quantiles, "LEVEL_DIGITS", 1)
    monkeypatch.setattr(quantiles, "BUCKET_ROWS", 1)
    monkeypatch.setattr(quantiles, "prefix_digits", lambda rows, bucket_rows=1: 3)
    df = spark.range(4_000).withColumn("g", F.col("id") % 3).withColumn("h", F.md5(F.col("id").cast("string")))
    for by in ((), ("g",)):
        ranked = quantiles.hash_rank(df, "h", "pos", 4_000, by)
        rows = sorted((*[r[c] for c in by], r["h"], r["pos"]) for r in ranked.collect())
        at = {}
        for *group, _, pos in rows:
            at[tuple(group)] = at.get(tuple(group), 0) + 1
            assert pos == at[tuple(group)]
        assert sum(at.values()) == 4_000
        plan = ranked._jdf.queryExecution().executedPlan().toString()
        assert by or plan.count("windowspecdefinition") > 2


def test_gaps_read_the_rows_once(spark, sf):
    gaps = fairness.fairness_gaps(scored_lines(spark, sf))
    assert gaps._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1
