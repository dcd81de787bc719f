"""A training corpus from `documents`: quality filter, near-duplicate removal, removal of repeated passages, mixing of
sources to weights, tokens.

Every stage reads the written result of the one before. All but the last return the columns of `documents`; `n_chars` is
counted anew where a stage changes texts. Rows with a NULL doc_id pass the duplicate stages; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intentspark.llm import bpe, jaccard, mixing, quality, suffixes
from intentspark.llm.common import keep, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on `labels` and these documents, doesn't reject."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, carry=True).where(F.col("score") >= quality.THRESHOLD).select("row.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first, of each class of texts whose five-word shingles are alike to 0.8."""
    return jaccard.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less the bytes of strings of 100 bytes that start earlier; parts of a cut character go too, and documents of
    which nothing is left."""
    cut = suffixes.as_text(suffixes.remove_repeats(docs))
    less = F.col("n_removed") > 0
    changed = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    fields = [F.when(less, changed[c]).otherwise(F.col("row")[c]).alias(c) if c in changed else F.col("row")[c].alias(c) for c in docs.columns]
    return cut.where(~less | (F.col("kept") != "")).select(*fields)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents beyond the budget go, those of small sources repeat up to three times."""
    measured = keep(lambda: mixing.sized(docs, carry=True), "mix")
    return mixing.expand(mixing.mix(measured)).withColumn("n_chars", F.coalesce(F.length("text"), "n_chars").cast("long")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and checksums of the ids and of the bytes they decode to, one row per row of the mix."""
    return bpe.digest(bpe.decode(bpe.encode(docs)), carry=("ids",))


STAGES = [("quality", good_quality), ("near_copies", without_near_copies), ("repeats", without_repeats), ("mixing", mixed), ("tokens", tokens)]

#: Trained scores and token ids have no SQL; tests hold each stage against brute force on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name)
    return docs
