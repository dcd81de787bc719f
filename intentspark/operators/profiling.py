"""Exploration: summaries, category and band rates, correlations, segments, anomalies, histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from intentspark import fixed
from intentspark.functions.quantiles import band_index, exact_quantiles, quantile_edges
from intentspark.functions.scalars import lenient_double, ratio
from intentspark.operators.audit import unpivot_aggregates
from intentspark.roles import DEFAULT_ROLES, RoleSpec


def numeric_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, median, sample deviation, range and bias-corrected skew per column."""
    medians = exact_quantiles(df, {c: [0.5] for c in columns})

    def skew(c):
        x = lenient_double(c)
        n = F.count(x).cast("double")
        return F.round(F.when(n > 2, F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2)), 6)

    return unpivot_aggregates(df, columns, "column_name", {
        "mean_value": lambda c: F.round(F.avg(lenient_double(c)), 6),
        "std_value": lambda c: F.round(F.stddev_samp(lenient_double(c)), 6),
        "min_value": lambda c: F.round(F.min(lenient_double(c)), 6),
        "max_value": lambda c: F.round(F.max(lenient_double(c)), 6),
        "skew_value": skew,
        "median_value": lambda c: F.first(F.round(F.lit(medians[c][0]), 6)),
    })


def rate_by_category(df: DataFrame, columns: list[str], target: str = fixed.TARGET) -> DataFrame:
    """Row count and label mean per value of each column (NULL group kept), one scan for all columns."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns
    ]))
    return (
        df.select(pairs.alias("e"), F.col(target).alias("y")).select("e.*", "y")
        .groupBy("column_name", "value")
        .agg(F.count("y").alias("row_count"), F.round(F.avg("y"), 6).alias("purchase_rate"))
    )


def lookup_rate(rates: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rate of each wanted (column_name, value); 0 where the value was never seen."""
    return wanted.join(rates, ["column_name", "value"], "left").select(
        "column_name", "value", F.coalesce("purchase_rate", F.lit(0.0)).alias("purchase_rate"))


def with_bands(df: DataFrame, columns: list[str], count: int = 4) -> tuple[DataFrame, dict]:
    """Adds ``<column>_band`` (0-based, NULL for NULL); columns with one value get band 0 everywhere."""
    edges, _ = quantile_edges(df, columns, count)
    for c in columns:
        e = edges[c]
        df = df.withColumn(f"{c}_band", F.lit(0) if e is None else band_index(lenient_double(c), e))
    return df, edges


def quantile_bands(df: DataFrame, columns: list[str], count: int = 4) -> DataFrame:
    """Band table: column, index, exact lower and upper edge, rows inside."""
    return rate_by_band(df, columns, count).drop("purchase_rate")


def rate_by_band(df: DataFrame, columns: list[str], count: int = 4, target: str = fixed.TARGET) -> DataFrame:
    banded, edges = with_bands(df, columns, count)
    pairs = F.explode(F.array(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"{c}_band").alias("band_index"),
            (F.lit(None) if edges[c] is None else F.get(
                F.array(*[F.lit(v) for v in edges[c]]), F.col(f"{c}_band"))).cast("double").alias("lower_edge"),
            (F.lit(None) if edges[c] is None else F.get(
                F.array(*[F.lit(v) for v in edges[c]]), F.col(f"{c}_band") + 1)).cast("double").alias("upper_edge"),
            F.col(c).isNotNull().alias("present"),
        )
        for c in columns
    ]))
    return (
        banded.select(pairs.alias("e"), F.col(target).alias("y")).select("e.*", "y")
        .where(F.col("present") & F.col("y").isNotNull())
        .groupBy("column_name", "band_index", "lower_edge", "upper_edge")
        .agg(F.count("y").alias("row_count"), F.round(F.avg("y"), 6).alias("purchase_rate"))
        .withColumn("lower_edge", F.round("lower_edge", 6))
        .withColumn("upper_edge", F.round("upper_edge", 6))
    )


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair (pairwise complete rows), all pairs in one aggregation."""
    x = {c: lenient_double(c) for c in columns}
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[F.corr(x[a], x[b]).alias(f"{a}|{b}") for a, b in pairs])
    cells = []
    for a, b in pairs:
        value = F.round(F.col(f"`{a}|{b}`"), 6)
        cells.append(F.struct(F.lit(a).alias("left_column"), F.lit(b).alias("right_column"), value.alias("correlation")))
        if a != b:
            cells.append(F.struct(
                F.lit(b).alias("left_column"), F.lit(a).alias("right_column"), value.alias("correlation")))
    return wide.select(F.explode(F.array(*cells)).alias("e")).select("e.*")


def target_correlation(df: DataFrame, columns: list[str], target: str = fixed.TARGET) -> DataFrame:
    return unpivot_aggregates(df, columns, "column_name", {
        "correlation": lambda c: F.round(F.corr(lenient_double(c), lenient_double(target)), 6),
    }).orderBy(F.col("correlation").desc(), "column_name")


def segment_profiles(df: DataFrame, size: int = 10, roles: RoleSpec = DEFAULT_ROLES) -> DataFrame:
    """Largest age-band x income-band x loyalty segments with their label rate."""
    banded, _ = with_bands(df, ["Age", "AnnualIncome"])
    return (
        banded.groupBy(
            F.col("Age_band").alias("age_band"), F.col("AnnualIncome_band").alias("income_band"), "LoyaltyProgram")
        .agg(F.count(roles.target).alias("row_count"), F.round(F.avg(roles.target), 6).alias("purchase_rate"))
        .orderBy(F.col("row_count").desc(), F.col("purchase_rate").desc(), "age_band", "income_band", "LoyaltyProgram")
        .limit(size)
    )


def anomaly_segments(df: DataFrame, roles: RoleSpec = DEFAULT_ROLES) -> DataFrame:
    """High-income rows, and long visits with little history: counts and label rates."""
    q = exact_quantiles(df, {
        "AnnualIncome": [0.95], "TimeSpentOnWebsite": [0.95], "NumberOfPurchases": [0.25]})
    income, time, history = (lenient_double(c) for c in ("AnnualIncome", "TimeSpentOnWebsite", "NumberOfPurchases"))
    rich = income >= q["AnnualIncome"][0]
    curious = (time >= q["TimeSpentOnWebsite"][0]) & (history <= q["NumberOfPurchases"][0])
    y = F.col(roles.target)
    return df.agg(
        F.count_if(rich).alias("high_income_row_count"),
        F.round(F.avg(F.when(rich, y)), 6).alias("high_income_purchase_rate"),
        F.count_if(curious).alias("high_time_low_history_row_count"),
        F.round(F.avg(F.when(curious, y)), 6).alias("high_time_low_history_purchase_rate"),
    )


def iqr_outliers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Interquartile fences and how many rows lie outside; rows are never removed."""
    q = exact_quantiles(df, {c: [0.25, 0.75] for c in columns})
    fences = {c: (a - 1.5 * (b - a), b + 1.5 * (b - a)) for c, (a, b) in q.items() if a is not None}

    def outside(c):
        low, high = fences[c]
        return F.count_if((lenient_double(c) < low) | (lenient_double(c) > high))

    return unpivot_aggregates(df, list(fences), "column_name", {
        "lower_bound": lambda c: F.first(F.round(F.lit(fences[c][0]), 6)),
        "upper_bound": lambda c: F.first(F.round(F.lit(fences[c][1]), 6)),
        "outlier_count": outside,
    })


def raw_vs_dedup(df: DataFrame, columns: list[str], target: str = fixed.TARGET) -> DataFrame:
    """Label counts before and after removing exact duplicates, from one grouping of the table."""
    everything = Window.partitionBy()
    counts = (
        df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
        .groupBy(F.col(target).alias("label"))
        .agg(F.sum("copies").alias("raw_count"), F.count(F.lit(1)).alias("dedup_count"))
    )
    return counts.select(
        F.col("label").cast("string").alias("label"), "raw_count", "dedup_count",
        F.round(F.col("raw_count") / F.sum("raw_count").over(everything), 6).alias("raw_rate"),
        F.round(F.col("dedup_count") / F.sum("dedup_count").over(everything), 6).alias("dedup_rate"),
        (F.sum("raw_count").over(everything) - F.sum("dedup_count").over(everything)).alias("dropped_rows"),
    )


def numeric_histogram(df: DataFrame, columns: list[str], bins: int = 20) -> DataFrame:
    """Equal-width counts between each column's minimum and maximum."""
    bounds = df.agg(*[f(lenient_double(c)).alias(f"{name}_{c}") for c in columns
                      for name, f in (("lo", F.min), ("hi", F.max))]).first()
    entries = []
    for c in columns:
        low, high = bounds[f"lo_{c}"], bounds[f"hi_{c}"]
        if low is None:
            continue
        width = (high - low) / bins
        x = lenient_double(c)
        index = F.lit(0) if width == 0 else F.least(
            F.floor((x - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
        entries.append(F.struct(
            F.lit(c).alias("column_name"), F.when(x.isNotNull(), index).alias("bin_index"),
            F.lit(low).alias("low"), F.lit(width).alias("width")))
    return (
        df.select(F.explode(F.array(*entries)).alias("e")).select("e.*").where(F.col("bin_index").isNotNull())
        .groupBy("column_name", "bin_index", "low", "width").agg(F.count(F.lit(1)).alias("row_count"))
        .select("column_name", "bin_index", F.round(F.col("low") + F.col("bin_index") * F.col("width"), 4).alias("bin_start"),
                "row_count")
    )


def imbalance_profile(df: DataFrame, target: str = fixed.TARGET) -> DataFrame:
    """Minority and majority class, their ratio and its severity."""
    counts = df.groupBy(F.col(target).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    ratio_value = F.round(ratio(F.col("minority_count"), F.col("majority_count")), 6)
    return (
        counts.agg(
            # first label wins a tie on either side
            F.min(F.struct("n", "label")).alias("small"),
            F.max(F.struct(F.col("n"), (-F.col("label")).alias("neg"))).alias("large"),
        )
        .select(
            F.col("small.label").cast("string").alias("minority_label"),
            (-F.col("large.neg")).cast("string").alias("majority_label"),
            F.col("small.n").alias("minority_count"),
            F.col("large.n").alias("majority_count"),
        )
        .withColumn("minority_to_majority_ratio", ratio_value)
        .withColumn(
            "severity",
            F.when(F.col("minority_to_majority_ratio") >= fixed.MILD_RATIO, "mild")
            .when(F.col("minority_to_majority_ratio") >= fixed.MODERATE_RATIO, "moderate")
            .otherwise("severe"),
        )
    )
