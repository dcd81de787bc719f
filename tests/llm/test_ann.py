"""The permutation index against brute force."""

import numpy as np
from pyspark.sql import functions as F

from intentspark.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(ids, x, query, k):
    scores = [(-float(np.dot(x[i].astype(float), x[query].astype(float))), ids[i]) for i in range(len(ids)) if ids[i] != ids[query]]
    return sorted(scores)[:k]


def table(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(c) for c in v], 0) for i, v in zip(ids, x)], SCHEMA)


def test_recall_with_blocks_and_unequal_norms(spark):
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(3000, 24)) + 1.5 * rng.normal(size=(12, 24))[rng.integers(0, 12, 3000)]).astype(np.float32)
    x *= rng.uniform(0.5, 1.5, 3000)[:, None].astype(np.float32)
    ids = np.arange(3000)
    got = ann.search(table(spark, ids, x), F.col("vec_id") % 100 == 0, k=10, floor=50, block=900).collect()
    found = 0
    for q in range(0, 3000, 100):
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        assert all(abs(s - float(np.dot(x[v].astype(float), x[q].astype(float)))) < 1e-9 for _, v, s in mine)
        assert [(-s, v) for _, v, s in mine] == sorted((-s, v) for _, v, s in mine)
        found += len({m[1] for m in mine} & {i for _, i in brute(ids, x, q, 10)})
    assert found >= 0.9 * 300


def test_recall_on_the_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows])
    got = ann.search(spark.read.parquet(f"{sf}/embeddings.parquet"), F.col("vec_id") % 20 == 0, floor=60).collect()
    hits = sum(len({r["vec_id"] for r in got if r["query_id"] == ids[q]} & {i for _, i in brute(ids, x, q, 20)}) for q in range(len(ids)) if ids[q] % 20 == 0)
    assert hits >= 0.9 * 20 * sum(i % 20 == 0 for i in ids)


def test_bad_vectors_ties_and_few_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (20, [nan, 1.0]), (None, [1.0, 1.0])]
    got = ann.search(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA), F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [(0, 1, 1, 1.0), (0, 2, 2, 1.0)]
    assert ann.search(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0


def test_copies_of_one_vector_take_no_place_of_others(spark):
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(1500, 24)) + 1.5 * rng.normal(size=(12, 24))[rng.integers(0, 12, 1500)]).astype(np.float32)
    ids = np.arange(1500)
    x[ids % 3 == 1] = 0.7 * x[0]
    queries = [q for q in ids[ids % 3 == 0][np.argsort(-(x[ids % 3 == 0] @ x[0]))[:15]].tolist()]
    got = ann.search(table(spark, ids, x), F.col("vec_id").isin(queries), k=10, floor=50, block=2000).collect()
    found = sum(len({r["vec_id"] for r in got if r["query_id"] == q} & {i for _, i in brute(ids, x, q, 10)}) for q in queries)
    assert found >= 0.9 * 150


def test_a_block_keeps_copies_once_and_goes_past_ties():
    x = np.array([[1.0, 0.0]] * 6 + [[0.0, 1.0], [2.0, 0.0]])
    pivots = np.array([[1.0, 0.0, 1.0], [0.0, 1.0, 1.0]])
    block = ann.Block(np.arange(8), x, 2.0, pivots, 2)
    near = ann.footrule_prefixes(x[:1], 2.0, pivots, 2, True)[0]
    found, scores = block.search(0, x[0], near, 3, 0.1, 1)
    assert found.tolist() == [7, 1, 2] and scores.tolist() == [2.0, 1.0, 1.0]
