"""Lyndon arrays and runs against their definitions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from intentspark.llm import periodic, queries
from tests.llm.rows import documents, empty


def plain_runs(words, least=6, times=4):
    n, out, taken = len(words), [], set()
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i:
                length = j - i + q
                if length >= max(least, times * q) and not any(a <= i and i + length <= a + m and q % p == 0 for a, m, p in taken):
                    out.append((i, length, q))
                    taken.add((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def next_smaller(s):
    """Longest Lyndon prefix: the way to the next smaller suffix."""
    return [next((j for j in range(i + 1, len(s)) if s[j:] < s[i:]), len(s)) - i for i in range(len(s))]


@pytest.mark.parametrize("seed", range(40))
def test_first_phase(seed):
    rng = random.Random(seed)
    s = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 60))]
    if seed % 3 == 0:
        s = (s[:7] * 9)[:60]
    length, group = periodic.lyndon_groups(s)
    assert length.tolist() == next_smaller(s)
    prefix = [tuple(s[i : i + n]) for i, n in enumerate(length.tolist())]
    assert all((group[i] == group[j]) == (prefix[i] == prefix[j]) and (group[i] < group[j]) == (prefix[i] < prefix[j]) for i in range(len(s)) for j in range(len(s)))


def texts_with_runs(seed, number=60):
    rng = random.Random(seed)
    out = []
    for _ in range(number):
        words = []
        for _ in range(rng.randint(0, 6)):
            part = [str(rng.randrange(rng.choice([2, 3, 50]))) for _ in range(rng.randint(1, 9))]
            words += part * rng.randint(1, 7) + part[: rng.randint(0, len(part))]
        out.append(words)
    return out


@pytest.mark.parametrize("seed", range(8))
def test_runs_against_all_periods(seed):
    texts = texts_with_runs(seed)
    if seed == 0:
        texts += [["a"] * 5, ["a"] * 6, ["a", "b"] * 4, ["a", "b"] * 3, list("abaababaabaab" * 12), [], ["x"]]
    number = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}, key=hash))}
    words = np.array([number[w] for t in texts for w in t], np.int64)
    found = periodic.find_runs(words, np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    assert found == [plain_runs(t) for t in texts]


def expected(doc_id, text, plant):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if plant and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    stay = [w for i, w in enumerate(words) if not any(a + q <= i < a + m for a, m, q in runs)]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{a},{m},{q}\n" for a, m, q in runs)), sha(" ".join(stay)))


FIELDS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def same(rows, texts, plant):
    assert sorted(map(repr, (expected(d, t, plant) for d, t in texts))) == sorted(repr(tuple(r[f] for f in FIELDS)) for r in rows)


def test_digest_and_edges(spark):
    texts = [" ".join(t) for t in texts_with_runs(3, 40)] + ["", None, "  lead  and\ttail \n", "ha " * 20_000, "é è " * 7 + "end", "same same same same same same", "same same same same same same"]
    ids = [*range(len(texts) - 2), 5, None]
    docs = documents(spark, texts, ids).withColumns({c: F.lit(9) for c in ("row", "runs", "best", "start", "_", "collapsed", "_h", "_n")})
    same(periodic.digest(periodic.collapse(docs)).collect(), list(zip(ids, texts)), False)
    same(periodic.digest(periodic.collapse(periodic.with_planted_periods(docs))).collect(), list(zip(ids, texts)), True)
    assert set(periodic.collapse(docs).select("row.*").columns) == {*docs.columns, "_"} - {"text"}


def test_long_period_in_a_long_text(spark):
    rng = random.Random(5)
    part = [f"w{rng.randrange(3000)}" for _ in range(7_000)]
    words = [f"v{i}" for i in range(500)] + part * 5 + part[:123]
    row = periodic.collapse(documents(spark, [" ".join(words)])).first()
    assert [tuple(r) for r in row["runs"]] == [(500, 35_123, 7_000)] and row["collapsed"].split() == words[:7_500]


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    same(queries.op12_runs(spark, sf).collect(), [(r["doc_id"], r["text"]) for r in docs], True)


def test_nothing(spark):
    assert periodic.digest(periodic.collapse(empty(spark))).count() == 0
