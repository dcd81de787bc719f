"""Registered queries: scans, audit, profiling, bands."""

from __future__ import annotations

from pyspark.sql import functions as F

from intentspark import fixed
from intentspark.functions.scalars import lenient_double
from intentspark.operators import audit, features, metrics, profiling
from intentspark.plans.frames import COLUMNS, clean_customers, customers, lines, side
from intentspark.roles import DEFAULT_ROLES
from intentspark.sources.bindings import profile_row_id
from intentspark.sources.contracts import schema_diff
from intentspark.sources.readers import csv_reader, scan_profile, scan_summary, split_rejects
from intentspark.sources.sinks import scratch_path

NUMERIC = list(fixed.NUMERIC)
SAFE = list(fixed.SAFE_NUMERIC)
CODED = [*fixed.CATEGORICAL, "DiscountsAvailed"]


def noisy_text(df):
    """Purchase counts spelled the way files spell them: padded, decimal, or not a number."""
    k, n = F.col("profile_id"), F.col("NumberOfPurchases").cast("string")
    return df.select("profile_id", F.when(k % 7 == 0, "n/a").when(k % 11 == 0, F.concat(F.lit(" "), n, F.lit(" ")))
                     .when(k % 5 == 0, F.concat(n, F.lit(".5"))).otherwise(n).alias("raw"))


def csv_rejects(spark, sf):
    """Customers written as CSV text with some damaged fields, scanned again: rows on either side, and per column."""
    k = F.col("profile_id")
    damaged = {"Age": F.when(k % 13 == 0, "abc"), "AnnualIncome": F.when(k % 17 == 0, "1,5"), "TimeSpentOnWebsite": F.when(k % 19 == 0, "")}
    text = [F.coalesce(damaged.get(c, F.lit(None)), F.col(c).cast("string")).alias(c) for c in COLUMNS]
    path = scratch_path(spark, "csv")
    customers(spark, sf).select(*text).write.option("header", True).csv(path)
    good, bad = split_rejects(scan_profile(spark, path, reader=csv_reader()))
    return scan_summary(good, COLUMNS).withColumn("rejected_rows", bad.agg(F.count(F.lit(1)).alias("n")).scalar())


def spelled_label(df):
    k, y = F.col("profile_id") % 5, F.col("PurchaseStatus").cast("string")
    return df.select(F.when(k == 0, F.concat(y, F.lit(".0"))).when(k == 1, F.concat(F.lit(" "), y))
                     .when(k == 2, F.lit("unknown")).when(k == 3, F.lit(None)).otherwise(y).alias("label"))


def feature_bands(spark, sf):
    frame = clean_customers(spark, sf)
    model = features.FeatureBuilder().fit(side(frame, "train"))
    return model.transform(frame).groupBy(*fixed.ENGINEERED_CATEGORICAL[:3], "split").agg(
        F.count(F.lit(1)).alias("row_count"))


def feature_edges(spark, sf):
    model = features.FeatureBuilder().fit(side(clean_customers(spark, sf), "train"))
    return model.edge_table(spark)


def fixed_bands(spark, sf):
    return customers(spark, sf).groupBy(metrics.age_band().alias("age_band"), metrics.income_band().alias("income_band")).agg(
        F.count(F.lit(1)).alias("row_count"))


QUERIES = {
    "customer_profile": customers,
    "scan_profile": lambda s, d: scan_summary(scan_profile(s, d, reader=customers), COLUMNS),
    "csv_rejects": csv_rejects,
    "schema_diff": lambda s, d: schema_diff(customers(s, d), fixed.PROFILE_COLUMNS),
    "coerce_numeric": lambda s, d: noisy_text(customers(s, d)).select(
        "profile_id", lenient_double("raw").alias("value")),
    "binary_like_values": lambda s, d: audit.binary_like_values(spelled_label(customers(s, d)), "label"),
    "role_projection": lambda s, d: customers(s, d).select("profile_id", *DEFAULT_ROLES.base_inputs),
    "numeric_checks": lambda s, d: audit.numeric_checks(customers(s, d)),
    "row_identity": lambda s, d: profile_row_id(customers(s, d)).select("profile_id", "row_id"),
    "column_profile": lambda s, d: audit.column_profile(customers(s, d), COLUMNS),
    "category_preview": lambda s, d: audit.category_preview(
        customers(s, d), [*fixed.CATEGORICAL, "NumberOfPurchases", fixed.TARGET]),
    "target_distribution": lambda s, d: audit.target_distribution(customers(s, d)),
    "target_verdict": lambda s, d: audit.target_verdict(customers(s, d)),
    "missing_summary": lambda s, d: audit.missing_summary(customers(s, d), COLUMNS),
    "duplicate_summary": lambda s, d: audit.duplicate_summary(customers(s, d), COLUMNS),
    "duplicate_preview": lambda s, d: audit.duplicate_preview(customers(s, d), COLUMNS),
    "dedup": lambda s, d: audit.deduplicate(customers(s, d), COLUMNS),
    "go_decision": lambda s, d: audit.go_decision(customers(s, d), COLUMNS),
    "leakage_risk": lambda s, d: audit.leakage_risk(customers(s, d)),
    "numeric_summary": lambda s, d: profiling.numeric_summary(clean_customers(s, d), NUMERIC),
    "purchase_rate_by_category": lambda s, d: profiling.rate_by_category(clean_customers(s, d), CODED),
    "purchase_rate_lookup": lambda s, d: profiling.lookup_rate(
        profiling.rate_by_category(clean_customers(s, d), list(fixed.CATEGORICAL)),
        customers(s, d).select(
            F.lit("ProductCategory").alias("column_name"),
            (F.col("NumberOfPurchases") % 8).cast("string").alias("value")).distinct()),
    "purchase_rate_by_band": lambda s, d: profiling.rate_by_band(clean_customers(s, d), NUMERIC),
    "quantile_bands": lambda s, d: profiling.quantile_bands(clean_customers(s, d), NUMERIC),
    "target_correlation": lambda s, d: profiling.target_correlation(clean_customers(s, d), NUMERIC),
    "correlation_matrix": lambda s, d: profiling.correlation_matrix(clean_customers(s, d), [*NUMERIC, fixed.TARGET]),
    "segment_profiles": lambda s, d: profiling.segment_profiles(clean_customers(s, d)),
    "anomaly_segments": lambda s, d: profiling.anomaly_segments(clean_customers(s, d)),
    "iqr_outliers": lambda s, d: profiling.iqr_outliers(side(clean_customers(s, d), "train"), SAFE),
    "target_raw_vs_dedup": lambda s, d: profiling.raw_vs_dedup(customers(s, d), COLUMNS),
    "numeric_histogram": lambda s, d: profiling.numeric_histogram(clean_customers(s, d), NUMERIC),
    "imbalance_profile": lambda s, d: profiling.imbalance_profile(side(lines(s, d), "train")),
    "feature_edges": feature_edges,
    "feature_bands": feature_bands,
    "fixed_bands": fixed_bands,
}
