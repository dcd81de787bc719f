"""Table scans with typed failures and a counted reject side for malformed CSV rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intentspark.errors import SourceError
from intentspark.functions.scalars import lenient_double
from intentspark.roles import PROFILE_SCHEMA

CORRUPT = "_corrupt_record"
Reader = Callable[[SparkSession, str], DataFrame]


def csv_reader(schema: T.StructType = PROFILE_SCHEMA) -> Reader:
    """Reader for headed CSV with a declared schema; malformed rows keep their text in ``CORRUPT``.

    All fields are read as text, so that the mark is an expression over every one of them: whatever a query selects or
    counts, the same rows are malformed (a field that is no value of its type, too few or too many fields).
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(CORRUPT, T.StringType())])

    def read(spark: SparkSession, path: str) -> DataFrame:
        raw = (
            spark.read.schema(text)
            .option("header", True)
            .option("mode", "PERMISSIVE")
            .option("enforceSchema", False)
            .option("columnPruning", False)
            .option("columnNameOfCorruptRecord", CORRUPT)
            .csv(path)
        )
        typed = {f.name: F.trim(F.col(f.name)).try_cast(f.dataType) for f in schema.fields}
        malformed = F.col(CORRUPT).isNotNull()
        for name, value in typed.items():
            malformed = malformed | (F.coalesce(F.trim(F.col(name)) != "", F.lit(False)) & value.isNull())
        line = F.coalesce(F.col(CORRUPT), F.concat_ws(",", *[F.coalesce(F.col(n), F.lit("")) for n in typed]))
        return raw.select(*[v.alias(n) for n, v in typed.items()], F.when(malformed, line).alias(CORRUPT))

    return read


def parquet_reader(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_profile(spark: SparkSession, path: str, reader: Reader | None = None) -> DataFrame:
    """Scan a profile table; the reader may be injected. NaN becomes NULL on the way in."""
    reader = reader or (parquet_reader if path.rstrip("/").endswith(".parquet") else csv_reader())
    try:
        df = reader(spark, path)
        empty = not df.columns
    except (AnalysisException, PySparkException, OSError) as error:
        raise SourceError(f"cannot read {path}: {type(error).__name__}") from error
    if empty:
        raise SourceError(f"no columns in {path}")
    fractional = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select([lenient_double(c).alias(c) if c in fractional else F.col(c) for c in df.columns])


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the raw-text column, malformed rows)."""
    if CORRUPT not in df.columns:
        return df, df.limit(0)
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT), df.where(F.col(CORRUPT).isNotNull())


def scan_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Row, complete-row and per-column counts of a scan in one pass."""
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    aggregates = [F.count(F.lit(1)).alias("row_count"), F.count_if(complete).alias("complete_rows")]
    aggregates += [F.count(c).alias(f"non_null_{c}") for c in columns]
    return df.agg(*aggregates)
