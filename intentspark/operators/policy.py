"""Offer policy: score bands, guardrails, proxy value, roll-ups. All per-row work is column expressions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from intentspark import fixed
from intentspark.errors import ContractError
from intentspark.functions.scalars import flag_list, lenient_double, usable_score
from intentspark.operators.scorers import purchase_percent, score_discount

SATURATED = "historical_discount_saturation"
DOWNGRADED = "discount_intensity_downgraded"
BOUNDARY = "threshold_boundary_review"
BAD_SCORE, BAD_HISTORY = "score_rejected", "history_rejected"
UNSCORED = "unscored"


def validate_bands(bands: dict[str, float]) -> dict[str, float]:
    missing = sorted({"low", "binary", "high"} - set(bands))
    if missing:
        raise ContractError(f"decision bands lack {', '.join(missing)}")
    low, binary, high = (float(bands[k]) for k in ("low", "binary", "high"))
    if not 0.0 < low < binary < high < 1.0:
        raise ContractError("decision bands must rise strictly inside (0, 1)")
    return {"low": low, "binary": binary, "high": high}


def score_band(bands: dict[str, float]) -> Column:
    return band_choice(bands, [band for band, _ in fixed.BAND_ACTIONS], UNSCORED)


def base_action(bands: dict[str, float]) -> Column:
    return band_choice(bands, [action for _, action in fixed.BAND_ACTIONS])


def split_bad_scores(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a probability in [0, 1], the others)."""
    good = usable_score(F.col("p"))
    return scored.where(good), scored.where(~good)


def boundary_review(bands: dict[str, float]) -> Column:
    """True near any band edge. Scores have 6 decimals; the slack only absorbs binary representation."""
    near = F.lit(False)
    for name, margin in fixed.REVIEW_MARGIN.items():
        near = near | (F.abs(F.col("p") - F.lit(bands[name])) <= F.lit(margin + 1e-9))
    return near


def band_choice(bands: dict[str, float], values: list[str], unscored: str | None = None) -> Column:
    """One of four values by score band, lower edges included; ``unscored`` without a usable score."""
    p = F.col("p")
    return (
        F.when(~usable_score(p), F.lit(unscored)).when(p < bands["low"], values[0]).when(p < bands["binary"], values[1])
        .when(p < bands["high"], values[2]).otherwise(values[3])
    )


def action_catalog(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [(a, d, u, c, ch, list(b)) for a, d, u, c, ch, b in fixed.ACTION_CATALOG],
        "action string, discount_rate double, expected_uplift double, contact_cost double, channel string, "
        "target_bands array<string>")


def proxy_value(p: Column, discount: Column, uplift: Column, cost: Column,
                order_value: float = fixed.REFERENCE_ORDER_VALUE,
                margin_rate: float = fixed.REFERENCE_MARGIN_RATE) -> dict[str, Column]:
    """Expected margin without and with the action, and the difference."""
    if order_value <= 0 or margin_rate <= 0:
        raise ContractError("order value and margin rate must be positive")
    margin = order_value * margin_rate
    reached = F.least(F.lit(fixed.PROBABILITY_CEILING), p + uplift)
    kept = F.greatest(F.lit(0.0), F.lit(margin) - discount * order_value)
    before = p * margin
    after = reached * kept - cost
    return {
        "baseline_expected_margin": F.round(before, 6),
        "action_expected_margin": F.round(after, 6),
        "expected_probability_after_action": F.round(reached, 6),
        "proxy_incremental_value": F.round(after - before, 6),
    }


def recommend(scored: DataFrame, bands: dict[str, float] | None = None, history: str = "DiscountsAvailed") -> DataFrame:
    """Adds band, base and recommended action, review mark and flags. Rows keep their columns, none is dropped.

    Guardrails are phrased on the score and the history, so the whole step is one projection. A row without a usable
    score or with a negative history gets no action: it is flagged for manual review.
    """
    bands = validate_bands(bands or fixed.DEFAULT_BANDS)
    p = F.col("p")
    past = F.coalesce(lenient_double(history), F.lit(0.0)) if history in scored.columns else F.lit(0.0)
    bad_score, bad_history = ~usable_score(p), past < 0
    rejected = bad_score | bad_history
    standard = (p >= bands["low"]) & (p < bands["binary"])
    discounted = (p >= bands["low"]) & (p < bands["high"])
    saturated = discounted & (past >= fixed.DISCOUNT_CAP_HISTORY)
    downgraded = standard & (past >= fixed.DISCOUNT_DOWNGRADE_HISTORY) & (past < fixed.DISCOUNT_CAP_HISTORY)
    near = boundary_review(bands)
    return scored.select(
        "*", score_band(bands).alias("score_band"), base_action(bands).alias("base_action"),
        F.when(rejected, F.lit(None)).when(saturated, "manual_review_discount_cap").when(downgraded, fixed.BAND_ACTIONS[2][1])
        .otherwise(base_action(bands)).alias("recommended_action"),
        (rejected | saturated | near).alias("requires_manual_review"),
        flag_list((bad_score, BAD_SCORE), (bad_history, BAD_HISTORY), (~rejected & saturated, SATURATED),
                  (~rejected & downgraded, DOWNGRADED), (~rejected & near, BOUNDARY)).alias("guardrail_flags"))


#: What the numbers of `recommend_arrays` stand for; no usable score is the last band, no action is -1.
BANDS = tuple(band for band, _ in fixed.BAND_ACTIONS) + (UNSCORED,)
ACTIONS = tuple(action for _, action in fixed.BAND_ACTIONS) + ("manual_review_discount_cap",)


def recommend_arrays(p: np.ndarray, past: np.ndarray, bands: dict[str, float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``recommend`` over arrays: numbers of band and recommended action, review mark. NULL scores arrive as NaN."""
    low, binary, high = bands["low"], bands["binary"], bands["high"]
    usable = (p >= 0.0) & (p <= 1.0)
    base = (p >= low).astype(np.int32) + (p >= binary) + (p >= high)
    saturated = (p >= low) & (p < high) & (past >= fixed.DISCOUNT_CAP_HISTORY)
    downgraded = (p >= low) & (p < binary) & (past >= fixed.DISCOUNT_DOWNGRADE_HISTORY) & (past < fixed.DISCOUNT_CAP_HISTORY)
    rejected = ~usable | (past < 0)
    near = np.zeros(p.shape, bool)
    for name, margin in fixed.REVIEW_MARGIN.items():
        near |= np.abs(p - bands[name]) <= margin + 1e-9
    action = np.select([rejected, saturated, downgraded], [-1, len(ACTIONS) - 1, 2], base)
    return np.where(usable, base, len(BANDS) - 1), action, rejected | saturated | near


def decide(scored: DataFrame, bands: dict[str, float] | None = None, history: str = "DiscountsAvailed") -> DataFrame:
    """``recommend`` plus discount, channel and proxy value from the five-row catalog, broadcast."""
    catalog = action_catalog(scored).select(
        F.col("action").alias("recommended_action"), F.col("discount_rate").alias("recommended_discount_rate"),
        F.col("expected_uplift").alias("_uplift"), F.col("contact_cost").alias("_cost"),
        F.col("channel").alias("primary_channel"))
    joined = recommend(scored, bands, history).join(F.broadcast(catalog), "recommended_action", "left")
    value = proxy_value(F.col("p"), F.col("recommended_discount_rate"), F.col("_uplift"), F.col("_cost"))
    return (
        joined.withColumns(value)
        .withColumn("discount_offered", F.col("recommended_discount_rate") > 0)
        .drop("_uplift", "_cost")
    )


def reject_negative_history(df: DataFrame, history: str = "DiscountsAvailed") -> tuple[DataFrame, DataFrame]:
    bad = F.coalesce(lenient_double(history) < 0, F.lit(False))
    return df.where(~bad), df.where(bad)


def _share(count: str = "row_count") -> Column:
    return F.round(F.col(count) / F.sum(count).over(Window.partitionBy()), 6)


def _mean(column: str) -> Column:
    return F.round(F.avg(F.col(column).cast("double")), 6)


def policy_band_summary(decided: DataFrame, target: str = fixed.TARGET) -> DataFrame:
    return (
        decided.groupBy("score_band").agg(
            F.count(F.lit(1)).alias("row_count"),
            _mean(target).alias("observed_purchase_rate"),
            _mean("p").alias("average_predicted_probability"),
            _mean("recommended_discount_rate").alias("average_discount_rate"),
            _mean("requires_manual_review").alias("manual_review_share"),
            _mean("proxy_incremental_value").alias("average_proxy_incremental_value"))
        .withColumn("share", _share())
    )


def action_mix(decided: DataFrame) -> DataFrame:
    return (
        decided.groupBy("recommended_action").agg(
            F.count(F.lit(1)).alias("row_count"),
            _mean("p").alias("average_predicted_probability"),
            _mean("recommended_discount_rate").alias("average_discount_rate"),
            _mean("proxy_incremental_value").alias("average_proxy_incremental_value"))
        .withColumn("share", _share())
    )


def loyalty_monitor(decided: DataFrame, group: str = "LoyaltyProgram") -> DataFrame:
    """Discount and review shares per loyalty group, and the gap between members and others."""
    everything = Window.partitionBy()
    summary = (
        decided.where(lenient_double(group).isNotNull())
        .groupBy(lenient_double(group).cast("int").alias("loyalty")).agg(
            F.count(F.lit(1)).alias("row_count"),
            _mean("discount_offered").alias("discount_action_share"),
            _mean("requires_manual_review").alias("manual_review_share"),
            _mean("proxy_incremental_value").alias("average_proxy_incremental_value"))
    )
    share_of = lambda g: F.max(F.when(F.col("loyalty") == g, F.col("discount_action_share"))).over(everything)
    return summary.withColumn("observed_discount_action_gap", F.round(F.abs(share_of(1) - share_of(0)), 6))


def portfolio_value(decided: DataFrame) -> DataFrame:
    v = F.col("proxy_incremental_value")
    return decided.agg(
        F.round(F.avg(v), 6).alias("average_value"),
        # summed as a decimal: the total must not depend on the order partitions are added in
        F.sum(v.cast("decimal(28,6)")).cast("double").alias("total_value"),
        F.round(F.avg((v > 0).cast("double")), 6).alias("positive_share"))


def action_catalog_usage(decided: DataFrame) -> DataFrame:
    """Every catalog action with how often the policy chose it (0 where it never did)."""
    used = decided.groupBy(F.col("recommended_action").alias("action")).agg(F.count(F.lit(1)).alias("row_count"))
    return action_catalog(decided).join(F.broadcast(used), "action", "left").withColumn(
        "row_count", F.coalesce("row_count", F.lit(0)))


def guardrail_status(decided: DataFrame, alert_count: int | Column) -> DataFrame:
    """Guardrail table; the loyalty monitor turns to alert on a wide gap or any fairness alert."""
    alerts = alert_count if isinstance(alert_count, Column) else F.lit(alert_count)
    group = lenient_double("LoyaltyProgram")
    offered = F.col("discount_offered").cast("double")
    gap = F.round(F.abs(F.avg(F.when(group == 1, offered)) - F.avg(F.when(group == 0, offered))), 6)
    observed = decided.agg(gap.alias("observed_gap"))
    alert = (alerts > 0) | F.coalesce(F.col("observed_gap") > fixed.LOYALTY_GAP_ALERT, F.lit(False))
    row = lambda name, severity, status, g: F.struct(
        F.lit(name).alias("guardrail_id"), severity.alias("severity"), status.alias("status"),
        g.cast("double").alias("observed_gap"))
    rows = [row(n, F.lit(s), F.lit(st), F.lit(None)) for n, s, st in fixed.GUARDRAILS]
    rows.append(row(
        "loyalty_fairness_monitor", F.when(alert, "high").otherwise("medium"),
        F.when(alert, "alert").otherwise("watch"), F.col("observed_gap")))
    return observed.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def scorecard_offer(scored: DataFrame, bands: dict[str, float] | None = None,
                    list_price: int = fixed.SCORECARD_LIST_PRICE) -> DataFrame:
    """Scorecard variant of the policy: a boundary review replaces the action, the score sets the discount."""
    bands = validate_bands(bands or fixed.DEFAULT_BANDS)
    distance = F.least(F.abs(F.col("p") - bands["binary"]), F.abs(F.col("p") - bands["high"]))
    near = distance <= F.lit(fixed.SCORECARD_REVIEW_DISTANCE + 1e-9)
    rate = F.col("automatic_discount_rate")
    return (
        scored.withColumn("predicted_label", F.when(F.col("p") >= bands["binary"], 1).otherwise(0))
        .withColumn("risk_band", score_band(bands))
        .withColumn("requires_manual_review", near)
        .withColumn("action", F.when(near, "manual_review_discount_cap").otherwise(base_action(bands)))
        .withColumn("score_percent", purchase_percent(F.col("p")))
        .withColumn("automatic_discount_rate", score_discount(F.col("score_percent")))
        .withColumn("discounted_price", F.floor(F.lit(list_price) * (F.lit(1.0) - rate) + F.lit(0.5)).cast("bigint"))
        .withColumn("apply_discount", rate > 0)
    )


def metric_alignment(stored: DataFrame, fresh: DataFrame, tolerance: float = fixed.ALIGNMENT_TOLERANCE) -> DataFrame:
    """Stored against recomputed metrics per model; ``aligned`` is false beyond the tolerance and where only one side has the model or a value."""
    names = ("pr_auc", "balanced_accuracy", "brier_score")
    long = lambda df, value: df.select("model_name", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric_name"), F.col(m).alias(value)) for m in names])).alias("e")).select(
            "model_name", "e.*")
    joined = long(stored, "stored_value").withColumn("in_stored", F.lit(True)).join(
        long(fresh, "fresh_value").withColumn("in_fresh", F.lit(True)), ["model_name", "metric_name"], "full")
    delta = F.round(F.abs(F.col("stored_value") - F.col("fresh_value")), 9)
    both_undefined = F.col("in_stored").isNotNull() & F.col("in_fresh").isNotNull() & F.col("stored_value").isNull() & F.col("fresh_value").isNull()
    return joined.withColumn("delta", delta).withColumn("aligned", F.coalesce(delta <= tolerance, both_undefined)).drop("in_stored", "in_fresh")
