"""Labelled documents for the two classifiers: folds by checksum, a bounded sample that does not depend on partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, rows: int) -> DataFrame:
    """(doc_id, text, y): at most `rows` labelled documents outside fold `held`, those of smallest hash.

    Several labels of one document are averaged; copies of one text count once, so that they do not weigh in."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).where(fold(F.col("doc_id"), folds) != held)
    chosen = known.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return found.groupBy(F.xxhash64("text").alias("h"), F.length("text").alias("n")).agg(
        F.min_by("text", "doc_id").alias("text"), F.min_by("y", "doc_id").alias("y"), F.min("doc_id").alias("doc_id")).select("doc_id", "text", "y")
