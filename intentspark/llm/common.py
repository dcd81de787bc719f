"""Table access, intermediate tables and column expressions shared by the operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, in every operator that counts or compares words.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="intentspark-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor shares: `spark.checkpoint.dir`. Where that is unset, a local session (tests) gets one of
    our own; on a cluster no executor could read such a folder, so it is an error there."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("intermediate tables need a folder that all executors share: set spark.checkpoint.dir")
    return (base or _own_folder()).rstrip("/")


#: Spark drops the shuffle files of a query when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """Writes the table that `make` plans into the shared folder and returns the written table: lineage ends here, and a
    lost executor costs no recomputation. The shuffle files of that plan, which nothing reads again, go at its end."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df = make()
        schema, path = df.schema, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, before) if before is not None else spark.conf.unset(DROP_SHUFFLES)
    return spark.read.schema(schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_missing(df: DataFrame, **types: str) -> DataFrame:
    """`df` with every named column: a column that is absent is added as NULL."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns})


def word_count(text: Column) -> Column:
    """Number of words; NULL counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
