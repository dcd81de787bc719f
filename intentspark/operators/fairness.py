"""Group fairness: rates per group, absolute gaps to the overall rates, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from intentspark import fixed
from intentspark.functions.scalars import ratio
from intentspark.operators.metrics import confusion_cube, evaluate, evaluate_segments

GAP_METRICS = ("recall", "precision", "positive_prediction_rate", "false_positive_rate", "false_negative_rate")


def _with_rates(metrics: DataFrame) -> DataFrame:
    return metrics.drop("accuracy", "brier_score").select(
        "*",
        F.round(ratio(F.col("tp") + F.col("fp"), F.col("row_count"), 0.0), 6).alias("positive_prediction_rate"),
        F.round(ratio(F.col("fp"), F.col("fp") + F.col("tn")), 6).alias("false_positive_rate"),
        F.round(ratio(F.col("fn"), F.col("fn") + F.col("tp")), 6).alias("false_negative_rate"),
    )


def fairness_metrics(scored: DataFrame, min_rows: int = fixed.MIN_SEGMENT_ROWS) -> DataFrame:
    groups = evaluate_segments(scored, with_income=False)
    return _with_rates(groups).where(F.col("row_count") >= min_rows)


def overall_metrics(scored: DataFrame) -> DataFrame:
    return _with_rates(evaluate(scored, slices=True))


def fairness_gaps(scored: DataFrame, min_rows: int = fixed.MIN_SEGMENT_ROWS) -> DataFrame:
    """(group, metric): absolute gap to the overall value, NULL where either side is undefined.

    The rows are read once, into confusion counts per segment cell. Every row has exactly one Gender value, so the
    cells of that segment add up to the whole table; the window goes over the few cells.
    """
    names = ("tn", "fp", "fn", "tp")
    everything = Window.partitionBy()
    cells = confusion_cube(scored).select(
        "segment_name", "segment_value", F.struct(*names).alias("own"),
        F.struct(*[F.sum(F.when(F.col("segment_name") == "Gender", F.col(c))).over(everything).alias(c) for c in names]).alias("all"))

    def rate(side: str, metric: str) -> Column:
        tn, fp, fn, tp = (F.col(f"{side}.{c}") for c in names)
        parts = {"recall": (tp, tp + fn, 0.0), "precision": (tp, tp + fp, 0.0), "positive_prediction_rate": (tp + fp, tn + fp + fn + tp, 0.0),
                 "false_positive_rate": (fp, fp + tn, None), "false_negative_rate": (fn, fn + tp, None)}
        part, whole, empty = parts[metric]
        return F.round(ratio(part, whole) if empty is None else ratio(part, whole, empty), 6)

    rows = F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric_name"), rate("own", m).alias("group_value_of_metric"), rate("all", m).alias("overall_value"),
                 F.round(F.abs(rate("own", m) - rate("all", m)), 6).alias("gap_value"))
        for m in GAP_METRICS]))
    size = sum((F.col(f"own.{c}") for c in names[1:]), F.col("own.tn"))
    return cells.withColumn("row_count", size).where(F.col("row_count") >= min_rows).select(
        "segment_name", "segment_value", "row_count", rows.alias("r")).select("segment_name", "segment_value", "row_count", "r.*")


def wide_gap(threshold: float = fixed.FAIRNESS_GAP) -> Column:
    return F.col("gap_value") >= threshold


def fairness_alerts(gaps: DataFrame, threshold: float = fixed.FAIRNESS_GAP) -> DataFrame:
    return gaps.where(wide_gap(threshold)).select(
        "segment_name", "segment_value", "metric_name", "gap_value")


def fairness_top(gaps: DataFrame, size: int = 8) -> DataFrame:
    """Segments with the widest recall or false-positive-rate gap."""
    gap = lambda m: F.coalesce(F.max(F.when(F.col("metric_name") == m, F.col("gap_value"))), F.lit(0.0))
    return (
        gaps.groupBy("segment_name", "segment_value")
        .agg(gap("recall").alias("recall_gap"), gap("false_positive_rate").alias("false_positive_rate_gap"))
        .orderBy(F.greatest("recall_gap", "false_positive_rate_gap").desc(), "segment_name", "segment_value")
        .limit(size)
    )
