"""Leakage-safe splits, folds, samples and class weights, all driven by a stable row hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from intentspark import fixed
from intentspark.errors import ContractError
from intentspark.functions.quantiles import prefix_digits, prefix_offsets
from intentspark.functions.scalars import hex_threshold, salted_hash


def check_classes(df: DataFrame, target: str = fixed.TARGET) -> None:
    """At least two classes with at least two rows each, or the split is refused."""
    row = df.groupBy(target).agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("classes"), F.min("n").alias("smallest")).first()
    if row["classes"] < 2:
        raise ContractError("a stratified split needs at least two classes")
    if row["smallest"] < 2:
        raise ContractError("a stratified split needs at least two rows in every class")


def hash_split(df: DataFrame, key: str = "row_id", size: float = fixed.TEST_SIZE, seed: int = fixed.SEED) -> DataFrame:
    """Adds ``split`` = test / train. A row's side depends on its key alone: no shuffle, stable as rows arrive."""
    return df.withColumn("split", F.when(salted_hash(key, seed) < hex_threshold(size), "test").otherwise("train"))


def nested_split(df: DataFrame, key: str = "row_id", test_size: float = fixed.TEST_SIZE,
                 validation_size: float = fixed.VALIDATION_SIZE, seed: int = fixed.SEED) -> DataFrame:
    """Adds ``split`` = test / validation / train; the inner draw uses its own salt."""
    if not 0.05 <= test_size <= 0.4 or not 0.1 <= validation_size <= 0.4 or seed < 0:
        raise ContractError("test size in [0.05, 0.4], validation size in [0.1, 0.4], seed >= 0")
    return df.withColumn(
        "split",
        F.when(salted_hash(key, seed) < hex_threshold(test_size), "test")
        .when(salted_hash(key, f"{seed}:inner") < hex_threshold(validation_size), "validation")
        .otherwise("train"),
    )


def exact_split(df: DataFrame, key: str = "row_id", target: str = fixed.TARGET, size: float = fixed.TEST_SIZE,
                seed: int = fixed.SEED) -> DataFrame:
    """Adds ``split`` with exactly round(n_class * size) test rows in every class.

    Ranking a whole class would put half the table in one task. Only the counts per (class, hash
    prefix) are ordered; they name the one prefix in which the class's cut falls, and only rows of that
    prefix are ranked. The prefix is as long as the number of rows asks for.
    """
    check_classes(df, target)
    digits = prefix_digits(df.count())
    # the full hash orders rows inside a prefix and the key settles equal hashes
    hashed = df.withColumn("_h", F.md5(F.concat(F.col(key), F.lit(f":{seed}")))).withColumn(
        "_b", F.substring("_h", 1, digits))
    sizes = hashed.groupBy(target, F.col("_b").alias("_bucket")).agg(F.count(F.lit(1)).alias("_size"))
    wanted = sizes.groupBy(target).agg(F.round(F.sum("_size") * F.lit(size)).cast("bigint").alias("_want"))
    cuts = (
        sizes.join(prefix_offsets(sizes, digits, (target,)), [target, "_bucket"]).join(wanted, target)
        .where((F.col("_offset") + F.col("_size") >= F.col("_want")) & (F.col("_offset") < F.col("_want")))
        .select(target, F.col("_bucket").alias("_cut"), (F.col("_want") - F.col("_offset")).alias("_take"))
    )
    joined = hashed.join(F.broadcast(cuts), target, "left")
    position = F.row_number().over(Window.partitionBy(target, "_b").orderBy("_h", key))
    at_cut = joined.where(F.col("_b") == F.col("_cut")).withColumn(
        "split", F.when(position <= F.col("_take"), "test").otherwise("train"))
    elsewhere = joined.where((F.col("_b") != F.col("_cut")) | F.col("_cut").isNull()).withColumn(
        "split", F.when(F.col("_b") < F.col("_cut"), "test").otherwise("train"))
    return elsewhere.unionByName(at_cut).drop("_h", "_b", "_cut", "_take")


def split_distribution(df: DataFrame, target: str = fixed.TARGET) -> DataFrame:
    per_split = Window.partitionBy("split")
    return (
        df.groupBy("split", F.col(target).alias("label")).agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("rate", F.round(F.col("row_count") / F.sum("row_count").over(per_split), 6))
    )


def fold_column(key: str, folds: int, salt: str):
    """Fold number from hash bits; the hash is independent of the label, so classes spread evenly."""
    return (F.conv(salted_hash(key, salt), 16, 10).cast("bigint") % folds).cast("int")


def assign_folds(df: DataFrame, key: str = "row_id", folds: int = fixed.CV_FOLDS, seed: int = fixed.SEED) -> DataFrame:
    return df.withColumn("fold", fold_column(key, folds, f"{seed}:fold"))


def sample_rows(df: DataFrame, size: int, key: str = "row_id", seed: int = fixed.SEED) -> DataFrame:
    """At most ``size`` rows without replacement, chosen by hash order (a distributed top-n)."""
    if size <= 0:
        raise ContractError("sample size must be positive")
    return df.orderBy(F.md5(F.concat(F.col(key), F.lit(f":{seed}:sample"))), key).limit(size)


def class_weights(df: DataFrame, target: str = fixed.TARGET) -> DataFrame:
    """Balanced weight of each class: n / (number of classes * class size)."""
    everything = Window.partitionBy()
    return (
        df.groupBy(F.col(target).alias("label")).agg(F.count(F.lit(1)).alias("class_count"))
        .withColumn(
            "weight",
            F.round(F.sum("class_count").over(everything)
                    / (F.count(F.lit(1)).over(everything) * F.col("class_count")), 6),
        )
    )


def with_class_weight(df: DataFrame, target: str = fixed.TARGET, name: str = "weight") -> DataFrame:
    """Adds the balanced weight; the two weights are driver scalars, so no join."""
    counts = {r[target]: r["count"] for r in df.groupBy(target).count().collect()}
    n = sum(counts.values())
    weight = F.lit(1.0)
    for label, count in counts.items():
        weight = F.when(F.col(target) == label, F.lit(n / (len(counts) * count))).otherwise(weight)
    return df.withColumn(name, weight)
