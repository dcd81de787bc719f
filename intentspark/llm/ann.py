"""Approximate nearest neighbours by a permutation index, for the largest inner product.

A vector is represented by its nearest pivots in order (the first `PREFIX` of `PIVOTS`). Vectors are dealt to blocks; a
block posts each vector in the inverted file of every pivot of its prefix, with its place. A query walks the files of
its own prefix pivots and sums, per posted vector, 2 (PREFIX - later place): a constant less the footrule distance of the
two prefixes. Equal vectors are one, with the k + 1 least vec_ids, all that a result can name; vectors of one prefix are one
posting. The best `SHARE` of the block's different prefixes by footrule (at least `FLOOR`), with all that tie with the last,
are reranked with exact products in double precision, and each query's best per block are merged.

The pivots are a bounded sample: the `PIVOTS` different vectors of smallest hash. Inner products become distances by one
extra component sqrt(M^2 - |x|^2), M the largest norm in the table; queries have 0 there. Every vector is indexed.
Blocks of vectors meet blocks of queries (a stated query set against all rows), so a task holds one block of each.

Defined results: vectors that are null, zero, of another length than most or hold null or non-finite components take no
part, nor do rows without vec_id; repeated rows count once; ties go to the smaller vec_id; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from intentspark.llm.common import keep

PIVOTS, PREFIX, SHARE, FLOOR = 256, 64, 0.2, 500
BLOCK, QUERY_BLOCK = 15_000, 2_000
SCHEMA = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Distinct (vec_id, v) with finite, non-zero vectors of the commonest length, components as doubles."""
    v = F.col(vector).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select("vec_id", v.alias("v")).where(F.col("vec_id").isNotNull() & good)
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("v") == (common[0]["n"] if common else 0)).distinct()


def footrule_prefixes(x: np.ndarray, largest: float, pivots: np.ndarray, prefix: int, query: bool) -> np.ndarray:
    """The nearest pivots of every row, nearest first. A query has any length and no extra component."""
    squared = (x * x).sum(axis=1)
    extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, largest * largest - squared))
    near = x @ pivots[:, :-1].T + extra[:, None] * pivots[:, -1][None]
    return np.argsort(-near, axis=1, kind="stable")[:, :prefix]


class Block:
    """The inverted files of one block of vectors: equal vectors are one, and those of one prefix are posted once."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, largest: float, pivots: np.ndarray, prefix: int):
        x = np.ascontiguousarray(x)
        _, first, vector = np.unique(x.view(f"V{x.shape[1] * x.itemsize}").ravel(), return_index=True, return_inverse=True)
        order = np.lexsort((ids, vector))
        self.ids, self.x, self.prefix = ids[order], x[first], prefix
        self.edges = np.searchsorted(vector[order], np.arange(len(first) + 1))
        places, self.posting = np.unique(footrule_prefixes(self.x, largest, pivots, prefix, False), axis=0, return_inverse=True)
        self.posting, self.postings = self.posting.ravel(), len(places)
        flat = np.argsort(places.ravel(), kind="stable")
        edges = np.searchsorted(places.ravel()[flat], np.arange(len(pivots) + 1))
        self.files = [((flat[a:b] // places.shape[1]).astype(np.int32), (flat[a:b] % places.shape[1]).astype(np.int32)) for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def search(self, query_id: int, q: np.ndarray, nearest: np.ndarray, k: int, share: float, floor: int) -> tuple[np.ndarray, np.ndarray]:
        alike = np.zeros(self.postings, np.int64)
        for place, pivot in enumerate(nearest):
            rows, theirs = self.files[pivot]
            alike[rows] += 2 * (self.prefix - np.maximum(theirs, place))
        size = min(len(alike), max(floor, math.ceil(share * len(alike))))
        last = np.partition(alike, len(alike) - size)[len(alike) - size]
        found = np.flatnonzero((alike >= last)[self.posting])
        scores = (self.x[found] * q).sum(axis=1)
        copies = self.edges[found + 1] - self.edges[found]
        rows = np.repeat(self.edges[found] - (np.cumsum(copies) - copies), copies) + np.arange(copies.sum())
        ids, scores = self.ids[rows], np.repeat(scores, copies)
        best = np.lexsort((ids, -scores))
        best = best[ids[best] != query_id][:k]
        return ids[best], scores[best]


def search(vectors: DataFrame, is_query: Column, k: int = 20, pivots: int = PIVOTS, prefix: int = PREFIX, share: float = SHARE, floor: int = FLOOR, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` nearest found of every row that `is_query` holds for."""
    rows = keep(lambda: usable(vectors), "vectors")
    facts = rows.agg(F.count(F.when(is_query, 1)).alias("q"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).alias("m")).first()
    copy = F.row_number().over(W.partitionBy("v").orderBy("vec_id"))
    named = keep(lambda: rows.withColumn("copy", copy).where(F.col("copy") <= k + 1), "different")
    sample = named.where("copy = 1").orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()
    different = list({tuple(r["v"]): None for r in sample})
    if not different:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    largest = float(facts["m"])
    points = np.array(different)
    points = np.column_stack([points, np.sqrt(np.maximum(0.0, largest * largest - (points * points).sum(axis=1)))])
    prefix = min(prefix, len(points))
    across, down = math.ceil(named.count() / block), math.ceil(max(1, facts["q"]) / QUERY_BLOCK)
    dealt = lambda n, by: F.pmod(F.xxhash64(by, F.lit(7)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    stored = named.select("vec_id", "v", F.lit(0).alias("side"), dealt(across, "v").alias("i"), every(down).alias("j"))
    asked = rows.where(is_query).select("vec_id", "v", F.lit(1).alias("side"), dealt(down, "vec_id").alias("j"), every(across).alias("i"))
    met = stored.unionByName(asked).withColumn("pair", F.col("i") * down + F.col("j")).select("pair", "side", "vec_id", "v").repartitionById(across * down, "pair")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held).combine_chunks()
        pair, side, ids = (t[c].to_numpy() for c in ("pair", "side", "vec_id"))
        x = t["v"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        for p in np.unique(pair):
            own, ask = np.flatnonzero((pair == p) & (side == 0)), np.flatnonzero((pair == p) & (side == 1))
            if not len(own) or not len(ask):
                continue
            files = Block(ids[own], x[own], largest, points, prefix)
            nearest = footrule_prefixes(x[ask], largest, points, prefix, True)
            for a in range(0, len(ask), 500):
                found = [(ids[row], *files.search(ids[row], x[row], near, k, share, floor)) for row, near in zip(ask[a : a + 500], nearest[a : a + 500], strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([np.full(len(i), q) for q, i, _ in found]), pa.int64()), pa.array(np.concatenate([i for _, i, _ in found]), pa.int64()),
                    pa.array(np.concatenate([s for _, _, s in found]), pa.float64())], ["query_id", "vec_id", "score"])

    best = met.mapInArrow(meet, SCHEMA).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
