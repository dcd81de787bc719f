"""Batch scoring over a stream: validation, scoring and policy are stateless, so they run unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from intentspark.errors import ContractError
from intentspark.operators.contract import Rule, output_contract, split_valid
from intentspark.operators.policy import decide
from intentspark.operators.scorers import Scorer


def profile_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                   max_files: int = 1000) -> DataFrame:
    """Files that arrive in a folder as a stream of profile rows."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).format(fmt).load(path)


def checkpoint_root(spark: SparkSession, given: str | None) -> str:
    root = given or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        raise ContractError("a stream needs a checkpoint folder: pass one or set spark.checkpoint.dir")
    return root.rstrip("/")


def score_stream(stream: DataFrame, rules: list[Rule], scorer: Scorer, out: str, bands: dict[str, float] | None = None,
                 passthrough: tuple[str, ...] = (), checkpoint: str | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    """Starts two file sinks under ``out``: decisions and rejects. Each keeps its own progress, so both
    are exactly-once and survive a restart."""
    root = checkpoint_root(stream.sparkSession, checkpoint)
    valid, rejects = split_valid(stream, rules, passthrough)
    decisions = output_contract(decide(scorer.score(valid), bands), passthrough)

    def start(df: DataFrame, name: str) -> StreamingQuery:
        return (
            df.writeStream.outputMode("append").format("parquet").trigger(availableNow=True)
            .option("path", f"{out.rstrip('/')}/{name}").option("checkpointLocation", f"{root}/{name}").start()
        )

    return start(decisions, "decisions"), start(rejects, "rejects")
