"""Registered queries: policy, contracts, batch scoring, what-if, gates, cases, explanations."""

from __future__ import annotations

from pyspark.sql import functions as F

from intentspark import fixed
from intentspark.functions.scalars import usable_score
from intentspark.operators import cases, contract, explain, fairness, gates, metrics, policy, whatif
from intentspark.operators.scorers import RuleScorer, Scorecard
from intentspark.plans.frames import clean_customers, customers, lines, rule_scored_lines, scored_lines, side
from intentspark.roles import DEFAULT_ROLES
from intentspark.sources.bindings import profile_row_id

PASS = ("profile_id",)
INPUTS = DEFAULT_ROLES.contract_inputs


def decided_lines(spark, sf):
    return policy.decide(scored_lines(spark, sf))


def flat(df):
    """Array columns as pipe-separated text."""
    for c, t in df.dtypes:
        if t == "array<string>":
            df = df.withColumn(c, F.array_join(c, "|"))
        elif t.startswith("array"):
            df = df.withColumn(c, F.array_join(F.col(c).cast("array<string>"), "|"))
    return df


def policy_frame(spark, sf):
    keep = ["row_id", "p", "yhat", "score_band", "base_action", "recommended_action", "recommended_discount_rate",
            "requires_manual_review", "guardrail_flags", "primary_channel", "baseline_expected_margin",
            "action_expected_margin", "expected_probability_after_action", "proxy_incremental_value", "discount_offered"]
    return flat(side(decided_lines(spark, sf), "test").select(*keep))


def score_rejects(spark, sf):
    """Decisions over scores and histories of which some are damaged by a rule on a field."""
    k, p = F.col("NumberOfPurchases"), F.col("p")
    damaged = scored_lines(spark, sf).withColumns({
        "p": F.when(k == 3, F.lit(None)).when(k == 5, F.lit(float("nan"))).when(k == 7, F.lit(1.7)).when(k == 11, F.lit(-0.3)).otherwise(p),
        "DiscountsAvailed": F.when(k == 13, F.lit(-2)).otherwise(F.col("DiscountsAvailed"))})
    decided = policy.decide(damaged)
    return flat(decided.groupBy("score_band", F.coalesce("recommended_action", F.lit("none")).alias("action"), "requires_manual_review", "guardrail_flags").agg(
        F.count(F.lit(1)).alias("row_count")))


def guardrails(spark, sf):
    scored = scored_lines(spark, sf)
    alerts = fairness.fairness_alerts(fairness.fairness_gaps(scored)).agg(F.count(F.lit(1)).alias("n"))
    return policy.guardrail_status(policy.decide(scored), alerts.scalar())


def alignment(spark, sf):
    """Metrics of a second evaluation under another partitioning against the first."""
    scored = scored_lines(spark, sf)
    fresh = scored.repartition("row_id")
    stored = metrics.evaluate(scored).withColumn("model_name", F.lit("scorecard"))
    return policy.metric_alignment(stored, metrics.evaluate(fresh).withColumn("model_name", F.lit("scorecard")))


def raw_requests(spark, sf):
    """Customer rows as they arrive: text fields, some of them damaged by a rule on the key."""
    k = F.col("profile_id")
    text = lambda c: F.col(c).cast("string")
    return customers(spark, sf).select(
        "profile_id",
        F.when(k % 13 == 0, "abc").when(k % 17 == 0, "99").otherwise(text("Age")).alias("Age"),
        F.when(k % 19 == 0, " ").otherwise(text("Gender")).alias("Gender"),
        F.when(k % 23 == 0, "Infinity").otherwise(text("AnnualIncome")).alias("AnnualIncome"),
        F.when(k % 29 == 0, "2.5").otherwise(F.concat(F.lit(" "), text("NumberOfPurchases"))).alias("NumberOfPurchases"),
        F.when(k % 31 == 0, "7").otherwise(text("ProductCategory")).alias("ProductCategory"),
        F.when(k % 37 == 0, "1e9").otherwise(text("TimeSpentOnWebsite")).alias("TimeSpentOnWebsite"),
        text("LoyaltyProgram").alias("LoyaltyProgram"),
        F.when(k % 41 == 0, "-1").otherwise(text("DiscountsAvailed")).alias("DiscountsAvailed"))


def contract_violations(spark, sf):
    rules = contract.learn_rules(clean_customers(spark, sf))
    checked = contract.check_rows(raw_requests(spark, sf), rules, PASS)
    return checked.select("profile_id", F.array_join("violations", "|").alias("violations"))


def contract_summary(spark, sf):
    rules = contract.learn_rules(clean_customers(spark, sf))
    return contract.contract_summary(raw_requests(spark, sf), rules, PASS)


def score_batch(spark, sf):
    rules = contract.learn_rules(clean_customers(spark, sf))
    return contract.batch_score(raw_requests(spark, sf), rules, Scorecard(), passthrough=PASS)


def line_rules(spark, sf):
    return contract.learn_rules(lines(spark, sf))


def line_batch_score(spark, sf):
    """Whole fact table through validate, score, decide; roll-up of the output contract."""
    frame = lines(spark, sf).select("row_id", *INPUTS)
    decisions, rejects = contract.batch_score(frame, line_rules(spark, sf), Scorecard(), passthrough=("row_id",))
    return cases.scoring_overview(decisions, rejects)


def input_rules(spark, sf):
    return flat(contract.rules_table(spark, contract.learn_rules(clean_customers(spark, sf))))


def rule_rounding(spark, sf):
    return flat(contract.widen_rules(contract.rules_table(spark, contract.learn_rules(clean_customers(spark, sf)))))


def drift(spark, sf):
    """Rules learned on the training customers against rules of all customers."""
    frame = clean_customers(spark, sf)
    stored = contract.rules_table(spark, contract.learn_rules(side(frame, "train")))
    return gates.contract_drift(stored, contract.rules_table(spark, contract.learn_rules(frame)))


def edge_matrix(spark, sf):
    """Every boundary and every invalid change applied to every customer that the contract accepts."""
    frame = clean_customers(spark, sf)
    return contract.mutation_matrix(frame, contract.learn_rules(frame))


def what_if(spark, sf, operator):
    """A what-if operator over all rows that keep the contract."""
    frame = lines(spark, sf)
    rules = line_rules(spark, sf)
    valid, _ = contract.split_valid(frame.select("row_id", *INPUTS), rules, ("row_id",))
    return operator(valid, rules, Scorecard())


def variants(spark, sf):
    return what_if(spark, sf, whatif.sensitivity_variants)


def reference(spark, sf):
    return cases.reference_cases(side(scored_lines(spark, sf), "test"))


def outer_background(frame):
    """Background rows from everything that isn't held out."""
    return explain.background_sample(frame.where("split <> 'test'"))


def explained(spark, sf, scorer=None):
    """Every test row with its attributions."""
    frame = lines(spark, sf)
    return explain.attributions(explain.explained_rows(side(frame, "test")), outer_background(frame), scorer or Scorecard())


def shared(spark, sf):
    rule = RuleScorer.fit(side(lines(spark, sf), "train"))
    return explain.shared_drivers(explain.shapley_global(explained(spark, sf)), explain.shapley_global(explained(spark, sf, rule)))


def explain_join(spark, sf):
    """Every test decision with its drivers; how often each feature leads, per action."""
    decided = side(decided_lines(spark, sf), "test").select("row_id", "recommended_action")
    joined = decided.join(explain.driver_lists(explained(spark, sf)), "row_id", "left")
    return joined.groupBy("recommended_action", F.col("drivers")[0].alias("strongest_driver")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count("drivers").alias("explained_rows"))


def case_policy(spark, sf):
    picked = reference(spark, sf)
    drivers = explain.driver_lists(explain.attributions(explain.explained_rows(picked), outer_background(lines(spark, sf)), Scorecard()))
    decided = cases.case_policy(picked, drivers)
    return flat(decided.select("case_id", "row_id", "p", "score_band", "recommended_action", "requires_manual_review",
                               "guardrail_flags", "top_drivers"))


def union(spark, sf):
    scored = scored_lines(spark, sf)
    return cases.case_union({name: cases.reference_cases(side(scored, name)) for name in ("test", "validation")})


def scoring_log(spark, sf):
    first = side(decided_lines(spark, sf), "test")
    again = policy.decide(Scorecard().score(side(lines(spark, sf), "test").repartition("row_id")))
    return cases.scoring_log(first, again)


def replay(spark, sf):
    """Scorecard decisions replayed under the rule baseline, by agreement."""
    joined = whatif.replay_alignment(decided_lines(spark, sf), policy.decide(rule_scored_lines(spark, sf)))
    return joined.groupBy("action_match", "band_match", "manual_review_match", "aligned").agg(
        F.count(F.lit(1)).alias("row_count"), F.max("probability_delta").alias("max_probability_delta"))


def champion(frame):
    """One row: the better of scorecard and rule baseline on the validation rows that they can score."""
    rows = None
    for name, scorer in (("scorecard", Scorecard()), ("rule_baseline", RuleScorer.fit(side(frame, "train")))):
        good, _ = policy.split_bad_scores(scorer.score(side(frame, "validation")).select("p", "yhat", fixed.TARGET))
        one = good.withColumn("model_name", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    order = F.struct(*[F.coalesce(m, F.lit(-1.0)) for m in ("pr_auc", "balanced_accuracy")], "model_name")
    return metrics.evaluate(rows, ["model_name"]).agg(F.max_by("model_name", order).alias("champion"))


def stages(spark, sf):
    """Row counts and champion that each stage finds on its own path through the data."""
    raw, clean = customers(spark, sf), clean_customers(spark, sf)
    every, none = F.count(F.lit(1)), F.lit(None).cast("bigint")
    stage = lambda name, figures, best: figures.select(
        F.lit(name).alias("stage"), "raw_rows", "dedup_rows", (best.scalar() if best is not None else F.lit(None).cast("string")).alias("champion"))
    audit = raw.groupBy(*fixed.PROFILE_COLUMNS).count().agg(F.sum("count").alias("raw_rows"), every.alias("dedup_rows"))
    modelling = clean.groupBy("split").count().agg(none.alias("raw_rows"), F.sum("count").alias("dedup_rows"))
    decided = policy.decide(Scorecard().score(clean)).agg(none.alias("raw_rows"), every.alias("dedup_rows"))
    identity = profile_row_id(raw).agg(every.alias("raw_rows"), F.count_distinct("row_id").alias("dedup_rows"))
    return stage("audit", audit, None).unionByName(stage("modelling", modelling, champion(clean))).unionByName(
        stage("policy", decided, champion(clean.repartition("row_id")))).unionByName(stage("identity", identity, None))


def readiness(spark, sf):
    """The checklist over figures that each validation step finds on the whole tables, one row each."""
    every, unusable = F.count(F.lit(1)), F.count_if(~usable_score(F.col("p")))
    edge = edge_matrix(spark, sf).agg(F.struct(every.alias("rows"), F.count_if(F.col("status") != "passed").alias("failures")))
    rerun = whatif.rerun_consistency(lines(spark, sf), Scorecard()).select(F.struct("compared_rows", "deterministic"))
    moved = what_if(spark, sf, whatif.variant_totals).agg(F.struct(
        F.coalesce(F.sum("variant_count"), F.lit(0)).alias("rows"), F.coalesce(F.sum("unusable_count"), F.lit(0)).alias("unusable")))
    gaps = fairness.fairness_gaps(scored_lines(spark, sf)).agg(F.struct(
        every.alias("segments"), F.count_if(fairness.wide_gap()).alias("alerts")))
    return gates.readiness(gates.validation_checks(scored_lines(spark, sf).agg(
        every.alias("scored_rows"), unusable.alias("unusable_scores")).select(
        "*", edge.scalar().alias("edge"), moved.scalar().alias("moved"), rerun.scalar().alias("rerun"),
        gaps.scalar().alias("gaps")).select(
        "scored_rows", "unusable_scores", F.col("edge.rows").alias("edge_rows"), F.col("edge.failures").alias("edge_failures"),
        F.col("moved.rows").alias("variant_rows"), F.col("moved.unusable").alias("unusable_variants"),
        "rerun.compared_rows", "rerun.deterministic", "gaps.segments", "gaps.alerts")))


QUERIES = {
    "score_bands": lambda s, d: decided_lines(s, d).groupBy("score_band").agg(F.count(F.lit(1)).alias("row_count")),
    "boundary_review": lambda s, d: scored_lines(s, d).groupBy(
        policy.boundary_review(fixed.DEFAULT_BANDS).alias("near_threshold")).agg(F.count(F.lit(1)).alias("row_count")),
    "proxy_value": lambda s, d: decided_lines(s, d).groupBy("recommended_action").agg(
        *[F.round(F.avg(c), 6).alias(c) for c in (
            "baseline_expected_margin", "action_expected_margin", "expected_probability_after_action", "proxy_incremental_value")]),
    "policy_actions": lambda s, d: flat(decided_lines(s, d).groupBy(
        "score_band", "base_action", "recommended_action", "requires_manual_review", "guardrail_flags", "primary_channel"
    ).agg(F.count(F.lit(1)).alias("row_count"))),
    "score_rejects": score_rejects,
    "policy_frame": policy_frame,
    "policy_band_summary": lambda s, d: policy.policy_band_summary(decided_lines(s, d)),
    "action_mix": lambda s, d: policy.action_mix(decided_lines(s, d)),
    "loyalty_monitor": lambda s, d: policy.loyalty_monitor(decided_lines(s, d)),
    "portfolio_value": lambda s, d: policy.portfolio_value(decided_lines(s, d)),
    "action_catalog": lambda s, d: flat(policy.action_catalog_usage(decided_lines(s, d))),
    "guardrail_status": guardrails,
    "scorecard_offer": lambda s, d: policy.scorecard_offer(scored_lines(s, d)).groupBy(
        "risk_band", "action", "requires_manual_review", "automatic_discount_rate", "discounted_price", "predicted_label"
    ).agg(F.count(F.lit(1)).alias("row_count")),
    "metric_alignment": alignment,
    "input_rules": input_rules,
    "rule_rounding": rule_rounding,
    "contract_violations": contract_violations,
    "contract_summary": contract_summary,
    "batch_score": lambda s, d: flat(score_batch(s, d)[0]),
    "scoring_overview": line_batch_score,
    "scoring_log": scoring_log,
    "replay_alignment": replay,
    "edge_case_matrix": edge_matrix,
    "sensitivity_variants": lambda s, d: what_if(s, d, whatif.variant_totals).drop("unusable_count"),
    "sensitivity_summary": lambda s, d: whatif.sensitivity_overview(what_if(s, d, whatif.row_sensitivity)),
    "rerun_consistency": lambda s, d: whatif.rerun_consistency(lines(s, d), Scorecard()),
    "contract_drift": drift,
    "stage_consistency": lambda s, d: gates.stage_consistency(stages(s, d)),
    "readiness": readiness,
    "reference_cases": lambda s, d: reference(s, d).select("case_id", "row_id", "p", "yhat", fixed.TARGET),
    "case_policy": case_policy,
    "case_checks": lambda s, d: cases.case_checks(policy.decide(reference(s, d))),
    "case_union": union,
    "explain_join": explain_join,
    "permutation_importance_scorecard": lambda s, d: explain.permutation_importance(side(lines(s, d), "test"), Scorecard()),
    "shapley_scorecard": lambda s, d: explain.shapley_values(explained(s, d)),
    "shapley_global": lambda s, d: explain.shapley_global(explained(s, d)),
    "top_contributions": lambda s, d: explain.top_contributions(explained(s, d)),
    "shapley_dependence": lambda s, d: explain.dependence_points(explained(s, d)),
    "shared_drivers": shared,
}
