"""Gates across stages: contract drift, row and champion consistency, readiness."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from intentspark import fixed
from intentspark.errors import ContractError


def contract_drift(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Column by column, which part of a stored rule no longer holds."""
    columns = ("kind", "min_value", "max_value", "allowed_values", "example_value")
    a = stored.select("column_name", F.lit(True).alias("in_stored"), *[F.col(c).alias(f"a_{c}") for c in columns])
    b = current.select("column_name", F.lit(True).alias("in_current"), *[F.col(c).alias(f"b_{c}") for c in columns])
    joined = a.join(b, "column_name", "full")
    changed = F.array_compact(F.array(*[
        F.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), F.lit(c)) for c in columns]))
    status = (
        F.when(F.col("in_stored").isNull(), "added").when(F.col("in_current").isNull(), "removed")
        .when(F.size(changed) > 0, "changed").otherwise("same"))
    return joined.select(
        "column_name", status.alias("status"),
        F.when(status == "changed", F.array_join(changed, "|")).otherwise("").alias("changed_parts"))


def require_no_drift(drift: DataFrame) -> None:
    if not drift.where(F.col("status") != "same").isEmpty():
        raise ContractError("the stored input contract no longer matches the data")


def same_bands(first: dict[str, float], second: dict[str, float]) -> None:
    if first != second:
        raise ContractError("decision bands differ between stages")


def stage_consistency(stages: DataFrame) -> DataFrame:
    """Checks over (stage, raw_rows, dedup_rows, champion): at least two stages must report a figure, all the same one."""
    agree = lambda c: (F.count_distinct(c) == 1) & (F.count(c) >= 2)
    one = stages.agg(
        agree("raw_rows").alias("raw"), agree("dedup_rows").alias("dedup"), agree("champion").alias("champion"),
        F.count(F.lit(1)).alias("stages"), F.max("raw_rows").alias("raw_rows"), F.max("dedup_rows").alias("dedup_rows"))
    row = lambda check, ok, figure: F.struct(
        F.lit(check).alias("check_id"), F.when(ok, "passed").otherwise("failed").alias("status"), figure.alias("figure"))
    return one.select(F.explode(F.array(
        row("raw_row_count_alignment", F.col("raw"), F.col("raw_rows")),
        row("dedup_row_count_alignment", F.col("dedup"), F.col("dedup_rows")),
        row("champion_alignment", F.col("champion"), F.col("stages")),
    )).alias("r")).select("r.*")


def require_consistent(stages: DataFrame) -> None:
    failed = [r["check_id"] for r in stage_consistency(stages).where("status = 'failed'").collect()]
    if failed:
        raise ContractError(f"stages disagree: {', '.join(failed)}")


def validation_checks(figures: DataFrame) -> DataFrame:
    """(check_id, present, passed) from one row of figures: a check is present if its step saw rows, and passes if the
    step found nothing wrong. Fairness alerts are followed up, not forbidden: that check passes once they are counted."""
    check = lambda name, seen, passed: F.struct(
        F.lit(name).alias("check_id"), F.coalesce(F.col(seen) > 0, F.lit(False)).alias("present"),
        F.coalesce(passed, F.lit(False)).alias("passed"))
    return figures.select(F.explode(F.array(
        check("scored_table", "scored_rows", F.col("unusable_scores") == 0),
        check("edge_case_controls", "edge_rows", F.col("edge_failures") == 0),
        check("sensitivity_analysis", "variant_rows", F.col("unusable_variants") == 0),
        check("reproducibility", "compared_rows", F.col("deterministic")),
        check("fairness_followup", "segments", F.col("alerts") >= 0),
    )).alias("c")).select("c.*")


def readiness(checks: DataFrame) -> DataFrame:
    """Checklist from (check_id, present, passed) with the overall state, the worst of all, on each row."""
    ready, missing, revision = fixed.READINESS_STATES
    everything = Window.partitionBy()
    status = F.when(~F.col("present"), missing).when(~F.col("passed"), revision).otherwise(ready)
    severity = F.when(F.col("status") == revision, 2).when(F.col("status") == missing, 1).otherwise(0)
    worst = F.max(severity).over(everything)
    return checks.withColumn("status", status).select(
        "check_id", "status",
        F.when(worst == 2, revision).when(worst == 1, missing).otherwise(ready).alias("overall_status"))
