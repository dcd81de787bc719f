"""Bindings of the profile contract onto the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intentspark import fixed

CUTOFF = "2001-04-01"
LINE_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_suppkey", "l_quantity", "l_discount", "l_linestatus")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer plus planted exact duplicates.

    Lines are summed per order before they meet the orders, so the join is one row to one row however
    many lines a single order has; a hot customer only ever costs partial aggregates.
    """
    known = F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp_ntz")
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.sum("l_quantity").alias("qty"),
            F.count("l_quantity").alias("qty_n"),
            F.count_if(F.col("l_discount") >= 0.09).alias("deep"),
        )
    )
    orders = table(spark, sf_dir, "orders").join(lines, "o_orderkey", "left")
    history = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count_if(known).alias("n_orders"),
        F.count_if(known & (F.col("o_orderpriority") == "1-URGENT")).alias("n_urgent"),
        F.max(F.when(~known, 1).otherwise(0)).alias("y"),
        (F.sum(F.when(known, F.col("qty"))) / F.nullif(F.sum(F.when(known, F.col("qty_n"))), F.lit(0))).alias("q"),
        F.sum(F.when(known, F.col("deep"))).alias("d"),
    )
    category = (
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", 0)
        .when(F.col("c_mktsegment") == "BUILDING", 1)
        .when(F.col("c_mktsegment") == "FURNITURE", 2)
        .when(F.col("c_mktsegment") == "HOUSEHOLD", 3)
        .otherwise(4)
    )
    copies = F.when(F.col("c_custkey") % 14 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        table(spark, sf_dir, "customer")
        .join(history, "c_custkey", "left")
        .withColumn("_copy", F.explode(copies))
        .select(
            F.col("c_custkey").alias("profile_id"),
            (F.lit(18) + F.col("c_custkey") % 53).cast("int").alias("Age"),
            (F.col("c_custkey") % 2).cast("int").alias("Gender"),
            F.col("c_acctbal").alias("AnnualIncome"),
            F.coalesce("n_orders", F.lit(0)).cast("int").alias("NumberOfPurchases"),
            category.cast("int").alias("ProductCategory"),
            F.round("q", 6).alias("TimeSpentOnWebsite"),
            F.when(F.coalesce("n_urgent", F.lit(0)) >= 3, 1).otherwise(0).alias("LoyaltyProgram"),
            F.least(F.lit(5), F.coalesce("d", F.lit(0))).cast("int").alias("DiscountsAvailed"),
            F.coalesce("y", F.lit(0)).cast("int").alias("PurchaseStatus"),
        )
    )


def line_profile(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """One row per line item with a planted label; narrow.

    With ``partitions`` the scanned rows are dealt out over so many tasks first, for a file that scans as one split."""
    scanned = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    key = F.md5(F.concat(
        F.col("l_orderkey"), F.lit(":"), F.col("l_linenumber"), F.lit(":"), F.col("l_partkey"), F.lit(":"),
        F.col("l_suppkey"), F.lit(":"), F.round(F.col("l_extendedprice") * 100).cast("bigint"),
    ))
    noise = F.conv(F.substring("row_id", 1, 6), 16, 10).cast("double") / F.lit(16777216.0)
    score = (
        F.lit(0.45) * F.col("LoyaltyProgram")
        + F.lit(0.35) * F.when(F.col("NumberOfPurchases") >= 10, 1).otherwise(0)
        + F.lit(0.20) * F.when(F.col("TimeSpentOnWebsite") >= 25, 1).otherwise(0)
        + F.lit(0.6) * (noise - F.lit(0.5))
    )
    return (
        (scanned.repartition(partitions, *LINE_COLUMNS[:4]) if partitions else scanned)
        .select(
            key.alias("row_id"),
            (F.lit(18) + F.col("l_partkey") % 53).cast("int").alias("Age"),
            (F.col("l_suppkey") % 2).cast("int").alias("Gender"),
            F.col("l_extendedprice").alias("AnnualIncome"),
            (F.col("l_orderkey") % 21).cast("int").alias("NumberOfPurchases"),
            (F.col("l_partkey") % 5).cast("int").alias("ProductCategory"),
            F.col("l_quantity").alias("TimeSpentOnWebsite"),
            F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("LoyaltyProgram"),
            F.floor(F.col("l_discount") * 50 + F.lit(1e-9)).cast("int").alias("DiscountsAvailed"),
        )
        .withColumn("PurchaseStatus", F.when(score >= F.lit(0.55), 1).otherwise(0))
    )


def profile_row_id(df: DataFrame) -> DataFrame:
    """Stable identity of a customer profile from integer parts; money goes in as cents."""
    parts = []
    for name in fixed.PROFILE_COLUMNS:
        column = F.col(name)
        if name in ("AnnualIncome", "TimeSpentOnWebsite"):
            column = F.round(column * (100 if name == "AnnualIncome" else 1_000_000)).cast("bigint")
        parts += [F.coalesce(column.cast("string"), F.lit("")), F.lit(":")]
    return df.withColumn("row_id", F.md5(F.concat(*parts[:-1])))
