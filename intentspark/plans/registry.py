"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from intentspark.operators.policy import decide, policy_band_summary
from intentspark.operators.scorers import Scorecard
from intentspark.plans import audit_queries, decision_queries, metric_queries, model_queries
from intentspark.plans.frames import clean_customers


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = Scorecard().score(clean_customers(spark, sf_dir))
    return policy_band_summary(decide(scored))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**audit_queries.QUERIES, **metric_queries.QUERIES, **decision_queries.QUERIES, **model_queries.QUERIES}
