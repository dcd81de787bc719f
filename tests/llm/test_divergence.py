"""Prices of term trees against plain sums, and the audit against SQL."""

import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from intentspark.llm import divergence, queries
from tests.llm.rows import SCHEMA, documents, empty


def plain_share(count, total):
    return 1 + (1_000_000_000 * (count + 2)) // total


@pytest.mark.parametrize("terms", [1, 2, 5, 64, 77])
def test_trees(terms):
    rng = np.random.default_rng(terms)
    counts = rng.integers(0, 4, (9, terms)) * (rng.random((9, terms)) < 0.4)
    counts[3], counts[4] = 0, counts[2]
    counts[5, 0] = 10**12
    totals = counts.sum(axis=1) + 2 * terms
    source, place = np.nonzero(counts)
    trees = divergence.Trees(source, place, counts[source, place], 9, terms)
    for a in range(8):
        others = np.arange(a + 1, 9)
        want = []
        for b in others:
            p = [(plain_share(int(counts[a, t]), int(totals[a])), plain_share(int(counts[b, t]), int(totals[b]))) for t in range(terms)]
            want.append(sum((x - y) * (x - y) // (x + y) for x, y in p))
        assert trees.price(a, others, totals).tolist() == want
    assert trees.root[2] == trees.root[4] and trees.root[3] == 0


def test_equal_subtrees_are_one_node():
    place = np.arange(64)
    trees = divergence.Trees(np.zeros(64, int), place, np.full(64, 7), 2, 64)
    assert [len(level) for level in trees.left] == [2] * 6  # the empty node and one more on every level


def sql_rows(rows):
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    con = duckdb.connect()
    con.register("documents", pa.table({n: pa.array([r[n] for r in rows], pa.string() if n in ("text", "lang", "source") else pa.int64()) for n in names}))
    return sorted(con.execute(divergence.SQL).fetchall())


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_against_sql(spark, monkeypatch):
    rng = random.Random(8)
    words = [f"t{chr(97 + i)}" for i in range(26)] + ["É", "é", "ÀB", "ab'c", "x1y", "日本"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(150)] + ["", None, "tA tA tA", "rare", "ta " * 50_000]
    docs = documents(spark, texts, sources=[rng.choice(["a", "B", "é", None, "z"]) for _ in texts])
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "xx").when(F.col("doc_id") % 7 == 0, None).when(F.col("doc_id") % 50 == 1, "few").otherwise("en"))
    clash = docs.withColumns({c: F.lit(1) for c in ("term", "n", "docs", "words", "vocabulary", "block", "total", "value", "rank", "item", "part", "one")})
    want = sql_rows(docs.collect())
    assert any(r[0] == "few" and r[4] == 0 for r in want) and any(r[2] == "term" for r in want)
    assert rows_of(divergence.audit(clash)) == want
    monkeypatch.setattr(divergence, "WALKED", 8)
    assert rows_of(divergence.audit(docs, block=4)) == want


def test_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert rows_of(queries.op13_divergence(spark, sf)) == sql_rows(rows)


def test_nothing(spark):
    assert divergence.audit(empty(spark)).count() == 0
    assert divergence.audit(documents(spark, ["one two"])).count() == 0
