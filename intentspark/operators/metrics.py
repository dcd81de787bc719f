"""Distributed evaluation of binary scores.

Every curve metric starts from the score ladder: positives and negatives per distinct score. Scores
carry 6 decimals, so a ladder has at most 1,000,001 rungs per group however many rows were scored;
the running totals are taken over rungs, never over rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from intentspark import fixed
from intentspark.errors import ContractError
from intentspark.functions.scalars import ratio, required_score, rounded_score, usable_score

METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc", "balanced_accuracy", "brier_score")


def score_ladder(scored: DataFrame, by: list[str], target: str = fixed.TARGET) -> DataFrame:
    """(group, p): positives, negatives, and how many of each were labelled positive."""
    y, p = F.col(target), rounded_score(required_score(F.col("p")))
    return scored.groupBy(*by, p.alias("p")).agg(
        F.sum(F.when(y == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(y == 0, 1).otherwise(0)).alias("neg"),
        F.sum(F.when((y == 1) & (F.col("yhat") == 1), 1).otherwise(0)).alias("tp"),
        F.sum(F.when((y == 0) & (F.col("yhat") == 1), 1).otherwise(0)).alias("fp"),
    )


def climb(ladder: DataFrame, by: list[str]) -> DataFrame:
    """Running positives and negatives from the highest score down, this rung included."""
    down = Window.partitionBy(*by).orderBy(F.col("p").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return ladder.withColumn("cum_pos", F.sum("pos").over(down)).withColumn("cum_neg", F.sum("neg").over(down))


def _curve_sums() -> list[Column]:
    """Additive parts of all metrics over the rungs of a climbed ladder."""
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    cum_pos, cum_neg = F.col("cum_pos").cast("double"), F.col("cum_neg").cast("double")
    return [
        F.sum("pos").alias("P"), F.sum("neg").alias("N"), F.sum("tp").alias("tp"), F.sum("fp").alias("fp"),
        F.sum(neg * (cum_pos - pos / 2)).alias("auc_sum"),
        F.sum(pos * cum_pos / (cum_pos + cum_neg)).alias("ap_sum"),
        F.sum(pos * (F.lit(1.0) - F.col("p")) * (F.lit(1.0) - F.col("p")) + neg * F.col("p") * F.col("p")).alias("sq"),
    ]


def _metrics(sums: DataFrame, by: list[str], slices: bool = False, extra: list[str] | None = None) -> DataFrame:
    """All metrics from the additive parts, rounded to 6 decimals."""
    cells = sums.select(
        *by, *(extra or []), (F.col("P") + F.col("N")).alias("row_count"), "P", "N",
        (F.col("N") - F.col("fp")).alias("tn"), "fp", (F.col("P") - F.col("tp")).alias("fn"), "tp",
        "auc_sum", "ap_sum", "sq")
    both = (F.col("P") > 0) & (F.col("N") > 0)
    precision = ratio(F.col("tp"), F.col("tp") + F.col("fp"), 0.0)
    recall = ratio(F.col("tp"), F.col("P"), 0.0)
    specificity = ratio(F.col("tn"), F.col("N"))
    balanced = (recall + specificity) / 2
    if not slices:
        # the usual definition averages recall over the classes that occur
        balanced = F.when(both, balanced).when(F.col("P") > 0, recall).otherwise(specificity)
    f1 = ratio(2 * precision * recall, precision + recall, 0.0)
    r6 = lambda c: F.round(c, 6)
    return cells.select(
        *by, "row_count",
        r6(ratio(F.col("P"), F.col("row_count"))).alias("positive_rate"),
        r6(ratio(F.col("tp") + F.col("tn"), F.col("row_count"))).alias("accuracy"),
        r6(precision).alias("precision"), r6(recall).alias("recall"), r6(f1).alias("f1"),
        r6(F.when(both, F.col("auc_sum") / (F.col("P").cast("double") * F.col("N")))).alias("roc_auc"),
        r6(F.when(both, F.col("ap_sum") / F.col("P"))).alias("pr_auc"),
        r6(balanced).alias("balanced_accuracy"),
        r6(F.col("sq") / F.col("row_count")).alias("brier_score"),
        "tn", "fp", "fn", "tp", *(extra or []),
    )


def evaluate(scored: DataFrame, by: list[str] | None = None, target: str = fixed.TARGET,
             slices: bool = False) -> DataFrame:
    """One row per group: confusion cells and all metrics, rounded to 6 decimals.

    ``slices`` switches the undefined cases to the slice rules: NULL specificity and balanced accuracy
    when a group has no negatives.
    """
    by = by or []
    sums = climb(score_ladder(scored, by, target), by).groupBy(*by).agg(*_curve_sums())
    return _metrics(sums, by, slices)


def pr_curve(scored: DataFrame, by: list[str] | None = None, target: str = fixed.TARGET) -> DataFrame:
    """Precision and recall at every distinct score used as a cut."""
    by = by or []
    group = Window.partitionBy(*by)
    rungs = climb(score_ladder(scored, by, target), by).withColumn("all_pos", F.sum("pos").over(group))
    return rungs.select(
        *by, F.col("p").alias("threshold"),
        F.round(ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")), 6).alias("precision"),
        F.round(ratio(F.col("cum_pos"), F.col("all_pos"), 1.0), 6).alias("recall"),
    )


def _binned(ladder: DataFrame, by: list[str], bins: int) -> DataFrame:
    """Adds ``bin_index`` to every rung: how many interior quantile edges of the score lie below it.

    The ladder is a sufficient statistic for the score's quantiles: edges are looked up in its running
    counts, within the same window pass, so rows are read once and no join is needed.
    """
    count = F.col("pos") + F.col("neg")
    up = Window.partitionBy(*by).orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    ranked = ladder.withColumn("upto", F.sum(count).over(up)).withColumn("n", F.sum(count).over(whole))
    index = F.lit(0)
    for i in range(1, bins):
        h = (F.col("n") - 1) * i / bins
        low = F.min(F.when(F.col("upto") > F.floor(h), F.col("p"))).over(whole)
        high = F.min(F.when(F.col("upto") > F.ceil(h), F.col("p"))).over(whole)
        edge = F.when(high == low, low).otherwise(low + (h - F.floor(h)) * (high - low))
        index = index + F.when(F.col("p") > edge, 1).otherwise(0)
    return ranked.withColumn("bin_index", index)


def _bin_rates() -> tuple[Column, Column]:
    count = F.col("pos") + F.col("neg")
    total = F.sum(count).cast("double")
    return F.round(F.sum("pos") / total, 6), F.round(F.sum(F.col("p") * count) / total, 6)


def calibration_curve(scored: DataFrame, bins: int = fixed.CALIBRATION_BINS, target: str = fixed.TARGET,
                      by: list[str] | None = None) -> DataFrame:
    """Observed rate against mean score in quantile bins of the score; empty bins do not appear."""
    by = by or []
    observed, predicted = _bin_rates()
    return _binned(score_ladder(scored, by, target), by, bins).groupBy(*by, "bin_index").agg(
        F.sum(F.col("pos") + F.col("neg")).alias("row_count"), observed.alias("true_rate"), predicted.alias("mean_probability"))


def evaluate_models(scored: DataFrame, target: str = fixed.TARGET, bins: int = fixed.CALIBRATION_BINS) -> DataFrame:
    """Metric rows with calibration gap of all models in a frame (model_name, family, p, yhat, label).

    One chain: ladder, running totals, sums per calibration bin, sums per model.
    """
    by = ["model_name", "family"]
    rungs = _binned(climb(score_ladder(scored, by, target), by), by, bins)
    observed, predicted = _bin_rates()
    per_bin = rungs.groupBy(*by, "bin_index").agg(*_curve_sums(), F.abs(observed - predicted).alias("bin_gap"))
    sums = per_bin.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("P", "N", "tp", "fp", "auc_sum", "ap_sum", "sq")],
        F.round(F.avg("bin_gap"), 6).alias("calibration_gap"))
    return _metrics(sums, by, extra=["calibration_gap"])


def score_with_all(df: DataFrame, scorers: list[tuple[str, str, object]], target: str = fixed.TARGET) -> DataFrame:
    """Rows scored by several scorers in one scan: (model_name, family, p, yhat, label)."""
    columns, entries = df.columns, []
    for i, (name, family, scorer) in enumerate(scorers):
        entry = F.struct(F.lit(name).alias("model_name"), F.lit(family).alias("family"), "p", "yhat")
        df = scorer.score(df).withColumn(f"_s{i}", entry).select(*columns, *[f"_s{j}" for j in range(i + 1)])
        entries.append(f"_s{i}")
    return df.select(target, F.explode(F.array(*entries)).alias("s")).select(target, "s.*")


def named(scored: DataFrame, model: str, family: str, target: str = fixed.TARGET) -> DataFrame:
    return scored.select(F.lit(model).alias("model_name"), F.lit(family).alias("family"), "p", "yhat", target)


def evaluate_model(scored: DataFrame, model: str, family: str, target: str = fixed.TARGET) -> DataFrame:
    return evaluate_models(named(scored, model, family, target), target)


def _cell_metrics(df: DataFrame) -> DataFrame:
    precision = ratio(F.col("tp"), F.col("tp") + F.col("fp"), 0.0)
    recall = ratio(F.col("tp"), F.col("tp") + F.col("fn"), 0.0)
    specificity = ratio(F.col("tn"), F.col("tn") + F.col("fp"), 0.0)
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return df.select(
        "*",
        F.round(precision, 6).alias("precision"), F.round(recall, 6).alias("recall"),
        F.round(ratio(2 * precision * recall, precision + recall, 0.0), 6).alias("f1"),
        F.round((recall + specificity) / 2, 6).alias("balanced_accuracy"),
        F.round(ratio(F.col("tp") + F.col("fp"), n), 6).alias("predicted_positive_rate"),
    )


def threshold_metrics(scored: DataFrame, cut: float | Column, target: str = fixed.TARGET) -> DataFrame:
    """Confusion cells and metrics with the label p >= cut."""
    cut = cut if isinstance(cut, Column) else F.lit(float(cut))
    y, hit = F.col(target), required_score(F.col("p")) >= cut
    cells = scored.agg(
        F.count_if((y == 0) & ~hit).alias("tn"), F.count_if((y == 0) & hit).alias("fp"),
        F.count_if((y == 1) & ~hit).alias("fn"), F.count_if((y == 1) & hit).alias("tp"))
    return _cell_metrics(cells.select(F.round(cut, 6).alias("threshold"), "*"))


def sweep_thresholds(points: int = fixed.SWEEP_POINTS) -> list[float]:
    step = (fixed.SWEEP_STOP - fixed.SWEEP_START) / (points - 1)
    return [round(fixed.SWEEP_START + i * step, 3) for i in range(points)]


def threshold_sweep(scored: DataFrame, thresholds: list[float] | None = None, target: str = fixed.TARGET) -> DataFrame:
    """Metrics at every threshold from one pass: rows are counted by the last threshold they reach."""
    cuts = thresholds or sweep_thresholds()
    scored = scored.select(required_score(F.col("p")).alias("p"), target)
    reached = F.lit(0)
    for t in cuts:
        reached = reached + F.when(F.col("p") >= F.lit(t), 1).otherwise(0)
    y = F.col(target)
    counts = scored.groupBy(reached.alias("level")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    empty = scored.sparkSession.createDataFrame(
        [(i, 0, 0, float(t)) for i, t in enumerate([-1.0, *cuts])],
        "level int, pos bigint, neg bigint, threshold double")
    levels = counts.withColumn("threshold", F.lit(None).cast("double")).unionByName(empty).groupBy("level").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.max("threshold").alias("threshold"))
    # at most len(cuts) + 1 rows from here on
    everything = Window.partitionBy()
    down = Window.orderBy(F.col("level").desc()).rowsBetween(Window.unboundedPreceding, 0)
    cells = levels.select(
        "level", "threshold",
        F.sum("pos").over(down).alias("tp"), F.sum("neg").over(down).alias("fp"),
        F.sum("pos").over(everything).alias("P"), F.sum("neg").over(everything).alias("N"),
    ).where(F.col("level") > 0).select(
        "threshold", (F.col("N") - F.col("fp")).alias("tn"), "fp", (F.col("P") - F.col("tp")).alias("fn"), "tp")
    return _cell_metrics(cells)


def optimal_threshold(scored: DataFrame, thresholds: list[float] | None = None, target: str = fixed.TARGET) -> DataFrame:
    """Best sweep row: enough precision first, then F1, recall, precision and closeness to 0.5."""
    sweep = threshold_sweep(scored, thresholds, target)
    feasible = F.col("precision") >= fixed.SWEEP_MIN_PRECISION
    quality = F.struct(
        feasible.alias("a"), F.col("f1").alias("b"), F.col("recall").alias("c"), F.col("precision").alias("d"),
        (-F.round(F.abs(F.col("threshold") - 0.5), 6)).alias("e"), (-F.col("threshold")).alias("f"))
    return sweep.agg(F.max_by(F.struct(*sweep.columns), quality).alias("best")).select("best.*")


def with_decision_bands(df: DataFrame, center: str = "threshold") -> DataFrame:
    """Low and high band edges around a centre, pushed apart where the limits would collapse them."""
    c = F.col(center)
    low = F.round(F.greatest(F.lit(fixed.BAND_LOW_FLOOR), c - fixed.BAND_HALF_WIDTH), 6)
    high = F.round(F.least(F.lit(fixed.BAND_HIGH_CEILING), c + fixed.BAND_HALF_WIDTH), 6)
    wide_low = F.round(F.greatest(F.lit(fixed.BAND_FALLBACK_LOW), c - fixed.BAND_FALLBACK_WIDTH), 6)
    wide_high = F.round(F.least(F.lit(fixed.BAND_FALLBACK_HIGH), c + fixed.BAND_FALLBACK_WIDTH), 6)
    return (
        df.withColumn("low_action_threshold", F.when(low >= c, wide_low).otherwise(low))
        .withColumn("binary_decision_threshold", F.round(c, 6))
        .withColumn("high_confidence_no_discount_threshold", F.when(high <= c, wide_high).otherwise(high))
    )


def learn_bands(scored: DataFrame, target: str = fixed.TARGET) -> dict[str, float]:
    """Decision bands of a scored validation set as driver scalars."""
    row = with_decision_bands(optimal_threshold(scored, target=target)).first()
    if row is None or row["tn"] + row["fp"] + row["fn"] + row["tp"] == 0:
        raise ContractError("a threshold cannot be chosen on an empty table")
    return {
        "low": row["low_action_threshold"], "binary": row["binary_decision_threshold"],
        "high": row["high_confidence_no_discount_threshold"],
    }


def intent_band(bands: dict[str, float]) -> Column:
    return (
        F.when(~usable_score(F.col("p")), "unscored")
        .when(F.col("p") < bands["low"], "low_intent_holdout")
        .when(F.col("p") < bands["high"], "mid_band_targeted_offer")
        .otherwise("high_confidence_no_discount")
    )


def intent_band_summary(scored: DataFrame, bands: dict[str, float], target: str = fixed.TARGET) -> DataFrame:
    everything = Window.partitionBy()
    return (
        scored.groupBy(intent_band(bands).alias("policy_band"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.round(F.avg(target), 6).alias("observed_purchase_rate"),
            F.round(F.avg("p"), 6).alias("average_probability"))
        .withColumn("share", F.round(F.col("row_count") / F.sum("row_count").over(everything), 6))
    )


def threshold_transfer(validation: DataFrame, holdout: DataFrame, target: str = fixed.TARGET) -> DataFrame:
    """The cut is chosen on validation; the holdout only shows its effect."""
    cut = optimal_threshold(validation, target=target).first()["threshold"]
    return threshold_metrics(holdout, cut, target)


def calibration_followup(metrics: DataFrame, models: tuple[str, ...]) -> DataFrame:
    return metrics.where(
        F.col("model_name").isin(*models)
        & ((F.col("calibration_gap") > 0.05) | (F.col("brier_score") > 0.2)))


def age_band(column: str = "Age") -> Column:
    return _band_name(_business_band(F.col(column), fixed.AGE_BANDS), fixed.AGE_BANDS)


def income_band(column: str = "AnnualIncome") -> Column:
    return _band_name(_business_band(F.col(column), fixed.INCOME_BANDS), fixed.INCOME_BANDS)


def _business_band(value: Column, bands) -> Column:
    """Position of the right-closed band; the very lowest edge belongs to the first one, NULL outside."""
    x = value.try_cast("double")
    code = F.when(x == bands[0][1], 0)
    for i, (_, low, high) in enumerate(bands):
        code = code.when((x > low) if high is None else (x > low) & (x <= high), i)
    return code


def _band_name(code: Column, bands) -> Column:
    name = F.lit("unknown")
    for i, (label, _, _) in enumerate(bands):
        name = F.when(code == i, label).otherwise(name)
    return name


SEGMENTS = ("Gender", "LoyaltyProgram", "ProductCategory", "AgeBand", "IncomeBand")
SEGMENT_PREFIX = {"Gender": "gender_", "LoyaltyProgram": "loyalty_", "ProductCategory": "category_"}


def _segment_rows(scored: DataFrame, with_income: bool) -> DataFrame:
    """Each row once per segment, as two small integers, so the rows being grouped stay fixed-width."""
    codes = [F.col(c) for c in SEGMENT_PREFIX] + [_business_band(F.col("Age"), fixed.AGE_BANDS)]
    if with_income:
        codes.append(_business_band(F.col("AnnualIncome"), fixed.INCOME_BANDS))
    entries = F.explode(F.array(*[
        F.struct(F.lit(i).alias("segment"), c.cast("int").alias("code")) for i, c in enumerate(codes)]))
    return scored.select("p", "yhat", fixed.TARGET, entries.alias("s")).select("p", "yhat", fixed.TARGET, "s.segment", "s.code")


def _named_segments(cells: DataFrame) -> DataFrame:
    """Names attached to the few result rows."""
    value = F.when(F.col("segment") == 3, _band_name(F.col("code"), fixed.AGE_BANDS)).when(
        F.col("segment") == 4, _band_name(F.col("code"), fixed.INCOME_BANDS))
    name = F.lit(None).cast("string")
    for i, segment in enumerate(SEGMENTS):
        name = F.when(F.col("segment") == i, segment).otherwise(name)
        if segment in SEGMENT_PREFIX:
            value = value.when(F.col("segment") == i, F.concat(
                F.lit(SEGMENT_PREFIX[segment]), F.coalesce(F.col("code").cast("string"), F.lit("nan"))))
    return cells.select(name.alias("segment_name"), value.alias("segment_value"), "*").drop("segment", "code")


def evaluate_segments(scored: DataFrame, with_income: bool = True) -> DataFrame:
    """Slice metrics per (segment_name, segment_value), all segments in one pass."""
    return _named_segments(evaluate(_segment_rows(scored, with_income), ["segment", "code"], slices=True))


def confusion_cube(scored: DataFrame, with_income: bool = False) -> DataFrame:
    """tn, fp, fn, tp per (segment_name, segment_value) in one grouping by cell; scores are checked, not grouped."""
    y, hat = F.col(fixed.TARGET) == 1, F.col("yhat") == 1
    cell = lambda c: F.sum(F.when(c & required_score(F.col("p")).isNotNull(), 1).otherwise(0))
    return _named_segments(_segment_rows(scored, with_income).groupBy("segment", "code").agg(
        cell(~y & ~hat).alias("tn"), cell(~y & hat).alias("fp"), cell(y & ~hat).alias("fn"), cell(y & hat).alias("tp")))


def segment_performance(scored: DataFrame, min_rows: int = fixed.MIN_SEGMENT_ROWS) -> DataFrame:
    return evaluate_segments(scored).where(F.col("row_count") >= min_rows).drop("accuracy", "brier_score")


def cv_summary(fold_metrics: DataFrame) -> DataFrame:
    """Mean, population deviation and fold scores of each tracked metric."""
    names = ("pr_auc", "balanced_accuracy", "roc_auc")
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("metric_name"), F.col(m).alias("value")) for m in names]))
    return (
        fold_metrics.select("fold", rows.alias("r")).select("fold", "r.*").where(F.col("value").isNotNull())
        .groupBy("metric_name")
        .agg(
            F.round(F.avg("value"), 6).alias("mean_value"),
            F.round(F.stddev_pop("value"), 6).alias("std_value"),
            F.transform(F.array_sort(F.collect_list(F.struct("fold", "value"))), lambda s: s["value"]).alias("fold_scores"),
        )
    )
