"""The registered queries of the dealt operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intentspark.llm import ann, bpe, chat, divergence, jaccard, mixing, packing, periodic, quality, simhash, substring, suffixes, toxicity
from intentspark.llm.common import table


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(chat.format_examples(chat.with_probe(table(spark, sf_dir, "conversations"))))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"))))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_documents(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.with_neighbours(lambda: simhash.compare_documents(table(spark, sf_dir, "documents")))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents")))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.collapse(periodic.with_planted_periods(table(spark, sf_dir, "documents"))))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {"op1_ann": op1_ann, "op2_chat": op2_chat, "op3_toxicity": op3_toxicity, "op4_substring": op4_substring, "op5_bpe": op5_bpe, "op6_quality": op6_quality, "op7_jaccard": op7_jaccard, "op8_simhash": op8_simhash, "op9_mixing": op9_mixing, "op10_suffix": op10_suffix,
           "op11_packing": op11_packing, "op12_runs": op12_runs, "op13_divergence": op13_divergence}
ORACLE_SQL = {"op2_chat": chat.SQL, "op9_mixing": mixing.SQL, "op13_divergence": divergence.SQL}
