"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentspark.llm.common import keep


def starred(now: DataFrame) -> DataFrame:
    """One round over edges (hi, lo)."""
    both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
    low = large.groupBy("hi").agg(F.min("lo").alias("m"))
    small = large.join(low, "hi").select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")).select("e.*")
    return small.where("hi <> lo").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b): root is the least node of its component.

    Each round links every node's greater neighbours to its least neighbour, then its lesser ones; the edges end as stars
    around the roots after a number of rounds that grows with the logarithm of the largest component. Each round's edges
    are a written table. A hub's edges are only ever aggregated or joined, never gathered."""
    now = keep(lambda: edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    state = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first())
    seen = state(now)
    while True:
        now = keep(lambda now=now: starred(now), "edges")
        after = state(now)
        if after == seen:
            break
        seen = after
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
