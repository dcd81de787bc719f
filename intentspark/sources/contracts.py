"""Schema contracts: required columns and a schema difference table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentspark.errors import ContractError


def require_columns(df: DataFrame, required: tuple[str, ...]) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ContractError(f"required columns are missing: {', '.join(missing)}")
    return df


def schema_diff(df: DataFrame, expected: tuple[str, ...]) -> DataFrame:
    """One row per expected or present column: status, type and non-null count (one pass)."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = list(expected) + [c for c in df.columns if c not in expected]
    status = {
        c: "matched" if c in types and c in expected else "missing" if c not in types else "unexpected" for c in names
    }
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    rows = F.explode(F.array(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(status[c]).alias("status"),
            F.lit(types.get(c)).cast("string").alias("data_type"),
            (F.col(c) if c in types else F.lit(0).cast("bigint")).alias("non_null_count"),
        )
        for c in names
    ]))
    return counts.select(rows.alias("r")).select("r.*")
