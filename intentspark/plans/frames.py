"""Frames the registered queries start from. Each query rebuilds its own, so queries stay independent."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from intentspark import fixed
from intentspark.operators.audit import deduplicate
from intentspark.operators.scorers import RuleScorer, Scorecard
from intentspark.operators.splits import nested_split
from intentspark.sources.bindings import customer_profile, line_profile, profile_row_id

COLUMNS = list(fixed.PROFILE_COLUMNS)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_profile(spark, sf_dir)


def clean_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated customers with their stable identity and the nested split.

    Fits read this frame several times and it ends a chain of joins and groupings, so it is kept;
    blocks that do not fit in memory go to disk and lost ones are recomputed.
    """
    clean = nested_split(profile_row_id(deduplicate(customers(spark, sf_dir), COLUMNS, keep="profile_id")))
    return clean.persist(StorageLevel.MEMORY_AND_DISK)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested_split(line_profile(spark, sf_dir))


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole fact table scored by the scorecard."""
    return Scorecard().score(lines(spark, sf_dir))


def rule_scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole fact table scored by the rule baseline, whose medians come from the train side only."""
    frame = lines(spark, sf_dir)
    return RuleScorer.fit(frame.where("split = 'train'")).score(frame)


def side(df: DataFrame, name: str) -> DataFrame:
    return df.where(df.split == name)
