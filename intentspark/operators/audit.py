"""Data-quality audit: column profile, target, missing cells, duplicates, domain rules, leakage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from intentspark import fixed
from intentspark.errors import ContractError
from intentspark.functions.scalars import binary_like, lenient_double
from intentspark.roles import DEFAULT_ROLES, RoleSpec


def unpivot_aggregates(df: DataFrame, columns: list[str], name: str, measures: dict) -> DataFrame:
    """One row per column from a single global aggregation.

    ``measures`` maps an output name to a function column name -> aggregate Column (or None).
    """
    aggregates = []
    for i, c in enumerate(columns):
        aggregates += [m(c).alias(f"{key}_{i}") for key, m in measures.items() if m(c) is not None]
    wide = df.agg(*aggregates)
    present = set(wide.columns)
    rows = F.explode(F.array(*[
        F.struct(
            F.lit(c).alias(name),
            *[
                (F.col(f"{key}_{i}") if f"{key}_{i}" in present else F.lit(None)).alias(key)
                for key in measures
            ],
        )
        for i, c in enumerate(columns)
    ]))
    return wide.select(rows.alias("r")).select("r.*")


def column_profile(df: DataFrame, columns: list[str], roles: RoleSpec = DEFAULT_ROLES,
                   approximate: bool = False) -> DataFrame:
    """Non-null, null and distinct counts per column, minimum and maximum of the numeric ones."""
    ranged = set(roles.all_numeric)
    if approximate:
        return unpivot_aggregates(df, columns, "column_name", {
            "non_null_count": F.count,
            "null_count": lambda c: F.count_if(F.col(c).isNull()),
            "unique_count": F.approx_count_distinct,
            "min_value": lambda c: F.min(lenient_double(c)) if c in ranged else None,
            "max_value": lambda c: F.max(lenient_double(c)) if c in ranged else None,
        })
    # Exact distinct counts: count(distinct) per column would expand every row once per column and
    # carry all of them through two shuffles; grouping the unpivoted values is the same work once,
    # with map-side combining.
    values = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v"),
                 (lenient_double(c) if c in ranged else F.lit(None).cast("double")).alias("x"))
        for c in columns
    ]))
    return (
        df.select(values.alias("e")).select("e.*")
        .groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        .groupBy("column_name").agg(
            F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("n"))), F.lit(0)).alias("non_null_count"),
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
            F.count("v").alias("unique_count"),
            F.min("lo").alias("min_value"),
            F.max("hi").alias("max_value"),
        )
    )


def category_preview(df: DataFrame, columns: list[str], size: int = 10) -> DataFrame:
    """First distinct values of each column in sorted order, at most ``size`` of them."""
    values = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns
    ]))
    distinct = df.select(values.alias("e")).select("e.*").where(F.col("value").isNotNull()).distinct()
    order = Window.partitionBy("column_name").orderBy("value")
    # rank <= k is pushed below the exchange as a per-partition group limit
    return distinct.withColumn("position", F.row_number().over(order)).where(F.col("position") <= size)


def target_distribution(df: DataFrame, target: str = fixed.TARGET) -> DataFrame:
    everything = Window.partitionBy()
    return (
        df.groupBy(F.col(target).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("rate", F.round(F.col("row_count") / F.sum("row_count").over(everything), 6))
    )


def target_verdict(df: DataFrame, target: str = fixed.TARGET) -> DataFrame:
    value = binary_like(target)
    return df.agg(
        F.count_if(F.col(target).isNull()).alias("missing_target_count"),
        F.count_if(value == "0").alias("zero_count"),
        F.count_if(value == "1").alias("one_count"),
        F.count_if(~value.isin("0", "1")).alias("other_count"),
    ).withColumn(
        "is_binary_and_complete",
        (F.col("missing_target_count") == 0) & (F.col("other_count") == 0)
        & (F.col("zero_count") > 0) & (F.col("one_count") > 0),
    )


def require_binary_target(df: DataFrame, target: str = fixed.TARGET) -> None:
    if not target_verdict(df, target).first()["is_binary_and_complete"]:
        raise ContractError(f"{target} is not a complete 0/1 label")


def binary_like_values(df: DataFrame, column: str) -> DataFrame:
    return (
        df.where(F.col(column).isNotNull()).select(binary_like(column).alias("value"))
        .groupBy("value").agg(F.count(F.lit(1)).alias("row_count"))
    )


def missing_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column missing count and ratio, with the table totals on every row; one pass."""
    missing = [F.when(F.col(c).isNull(), 1).otherwise(0) for c in columns]
    row_missing = missing[0]
    for m in missing[1:]:
        row_missing = row_missing + m
    wide = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(row_missing > 0).alias("rows_with_missing"),
        F.sum(row_missing).alias("total_missing_cells"),
        *[F.count_if(F.col(c).isNull()).alias(f"m_{c}") for c in columns],
    )
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"m_{c}").alias("missing_count")) for c in columns
    ]))
    return wide.select("n", "rows_with_missing", "total_missing_cells", rows.alias("r")).select(
        "r.column_name", "r.missing_count",
        F.round(F.col("r.missing_count") / F.col("n"), 6).alias("missing_ratio"),
        "rows_with_missing", "total_missing_cells",
    )


def duplicate_groups(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct rows with their number of copies; copies combine map-side, so a hot group is cheap."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))


def duplicate_summary(df: DataFrame, columns: list[str], target: str = fixed.TARGET) -> DataFrame:
    """Extra rows, their rate, and the label counts over all members of repeated groups."""
    copies = F.col("copies")
    member = lambda label: F.coalesce(
        F.sum(F.when((copies > 1) & (F.col(target) == label), copies)), F.lit(0))
    return duplicate_groups(df, columns).agg(
        F.sum(copies - 1).alias("duplicate_row_count"),
        F.round(F.sum(copies - 1) / F.sum(copies), 6).alias("duplicate_rate"),
        F.count_if(copies > 1).alias("duplicate_group_count"),
        member(0).alias("duplicate_members_label_0"),
        member(1).alias("duplicate_members_label_1"),
    )


def duplicate_preview(df: DataFrame, columns: list[str], size: int = 5) -> DataFrame:
    groups = duplicate_groups(df, columns).where(F.col("copies") > 1)
    return groups.orderBy(F.col("copies").desc(), *columns).limit(size)


def deduplicate(df: DataFrame, columns: list[str], keep: str | None = None) -> DataFrame:
    """One row per distinct value combination (NULL equals NULL); ``keep`` retains its smallest value."""
    if keep is None:
        return df.select(*columns).dropDuplicates()
    return df.groupBy(*columns).agg(F.min(keep).alias(keep))


def outside_range(column: str) -> Column:
    low, high = fixed.PLAUSIBLE_RANGE[column]
    x = lenient_double(column)
    condition = F.lit(False)
    if low is not None:
        condition = condition | (x < low)
    if high is not None:
        condition = condition | (x > high)
    return condition


def numeric_checks(df: DataFrame, roles: RoleSpec = DEFAULT_ROLES) -> DataFrame:
    """Range, mean, implausible and non-integer counts of every numeric column in one pass."""
    return unpivot_aggregates(df, list(roles.all_numeric), "column_name", {
        "min_value": lambda c: F.round(F.min(lenient_double(c)), 6),
        "max_value": lambda c: F.round(F.max(lenient_double(c)), 6),
        "mean_value": lambda c: F.round(F.avg(lenient_double(c)), 6),
        "suspicious_count": lambda c: F.count_if(outside_range(c)),
        "integer_violations": lambda c: (
            F.count_if(lenient_double(c) % 1 != 0) if c in roles.integer_like else F.count_if(F.lit(False))
        ),
    })


def leakage_matrix(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [tuple(r) for r in fixed.LEAKAGE_MATRIX], "column_name string, availability_stage string, risk_level string")


def leakage_risk(df: DataFrame, roles: RoleSpec = DEFAULT_ROLES) -> DataFrame:
    """Risk of each present column, its model use, and how strongly it moves with the label."""
    present = [c for c in df.columns if c in {r[0] for r in fixed.LEAKAGE_MATRIX}]
    strength = unpivot_aggregates(df, present, "column_name", {
        "non_null_count": F.count,
        "label_correlation": lambda c: F.round(F.corr(lenient_double(c), lenient_double(roles.target)), 6),
    })
    return strength.join(F.broadcast(leakage_matrix(df)), "column_name").withColumn(
        "model_input", F.col("column_name").isin(*roles.base_inputs))


def go_decision(df: DataFrame, columns: list[str], expected: tuple[str, ...] = fixed.PROFILE_COLUMNS,
                target: str = fixed.TARGET, identity: tuple[str, ...] = ("profile_id", "row_id", "split")) -> DataFrame:
    """Go / Conditional Go / No Go from the schema, label, duplicate and leakage findings.

    A column of the table that is missing or unexpected (identity columns aside) is a schema issue."""
    issues = bool((set(df.columns) - set(identity)) ^ set(expected))
    high_risk = any(risk == "high" for _, _, risk in fixed.LEAKAGE_MATRIX)
    copies, label = F.col("copies"), binary_like(target)
    verdict = duplicate_groups(df, columns).agg(
        F.sum(copies).alias("row_count"),
        F.round(F.sum(copies - 1) / F.sum(copies), 6).alias("duplicate_rate"),
        (
            (F.count_if(F.col(target).isNull()) == 0) & (F.count_if(~label.isin("0", "1")) == 0)
            & (F.count_if(label == "0") > 0) & (F.count_if(label == "1") > 0)
        ).alias("target_valid"),
    )
    return verdict.withColumn(
        "decision",
        F.when(F.lit(issues) | ~F.col("target_valid"), "No Go")
        .when((F.col("duplicate_rate") > 0) | F.lit(high_risk), "Conditional Go")
        .otherwise("Go"),
    )
