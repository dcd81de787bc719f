"""Word and byte repeats against dictionaries of all runs."""

import hashlib
import random
import re
from dataclasses import replace

import numpy as np
import pytest

from intentspark.llm import queries, repeats, substring, suffixes
from tests.llm.rows import documents, empty


def runs(rows, split, width, within):
    """For every row which symbols are covered by a run that also starts earlier."""
    first = {}
    for doc_id, text in rows:
        s = split(text or "")
        for i in range(len(s) - width + 1):
            if doc_id is not None:
                k = tuple(s[i : i + width]) if isinstance(s, list) else s[i : i + width]
                at = (doc_id, i if within else 0)
                first[k] = min(first.get(k, at), at)
    out = []
    for doc_id, text in rows:
        s = split(text or "")
        gone = np.zeros(len(s), bool)
        for i in range(len(s) - width + 1):
            k = tuple(s[i : i + width]) if isinstance(s, list) else s[i : i + width]
            if doc_id is not None and first[k] < (doc_id, i if within else 0):
                gone[i : i + width] = True
        out.append((doc_id, s, gone))
    return out


words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)


def check_words(got, rows):
    want = [(d, len(s), int(g.sum()), hashlib.sha256(" ".join(np.array(s, object)[~g]).encode()).hexdigest()) for d, s, g in runs(rows, words, 13, False)]
    assert sorted(map(repr, want)) == sorted(repr((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"])) for r in got)


def check_bytes(got, rows):
    want = []
    for d, s, g in runs(rows, lambda t: t.encode(), 100, True):
        spans = int((np.diff(g.astype(int), prepend=0) > 0).sum())
        want.append((d, len(s), int(g.sum()), spans, hashlib.sha256(np.frombuffer(s, np.uint8)[~g].tobytes()).hexdigest()))
    assert sorted(map(repr, want)) == sorted(repr((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])) for r in got)


@pytest.fixture(scope="module")
def shared_passages():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 4)))
    passages = [[word() for _ in range(rng.randint(5, 60))] for _ in range(12)]
    texts = []
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            a = rng.randint(0, 8)
            parts.append(rng.choice([" ", "\n", "  "]).join(p[a : a + rng.randint(8, 60)]) if rng.random() < 0.7 else " ".join(word() for _ in range(rng.randint(1, 30))))
        texts.append(" ".join(parts))
    texts += [texts[3], texts[3], "", None, "ab " * 400, "ab " * 400, "x" * 150, "x" * 99, texts[5]]
    ids = list(range(1000, 1000 - len(texts), -1))
    ids[7], ids[8], ids[9], ids[-1] = None, ids[10], ids[11], ids[5]
    return list(zip(ids, texts))


def test_covers():
    assert all(repeats.is_cover(k.cover, k.modulus) and k.anchor + k.modulus - 1 == k.width for k in (substring.KIND, suffixes.KIND))


@pytest.mark.parametrize("flush,segment", [(1_000_000, 2_000_000), (50, 130)])
def test_words_and_bytes_against_all_runs(spark, shared_passages, monkeypatch, flush, segment):
    for module in (substring, suffixes):
        monkeypatch.setattr(module, "KIND", replace(module.KIND, flush=flush, segment=segment, piece=1 if flush == 50 else 1_000_000))
    docs = documents(spark, [t for _, t in shared_passages], [d for d, _ in shared_passages]).withColumnRenamed("source", "whole_source")
    check_words(substring.digest(docs).collect(), shared_passages)
    check_bytes(suffixes.digest(docs).collect(), shared_passages)


def test_queries_on_the_table(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check_words(queries.op4_substring(spark, sf).collect(), rows)
    check_bytes(queries.op10_suffix(spark, sf).collect(), rows)


@pytest.mark.parametrize("tasks", [1, 2, 3, 7, 24, 422, 1000])
def test_marks_reach_their_owner_in_few_rows(tasks):
    """Documents found by all tasks: a task sends to the root of their number, not to all, and nothing is lost on the way."""
    docs = np.arange(5_000)
    found = [(docs, docs * 3, docs % 40)]
    first = list(repeats.marks_by_owner(found, tasks, tasks - 1))
    assert sum(b.num_rows for b in first) <= 1.1 * tasks**0.5 + 2
    owners = np.unique(repeats.owner(repeats.A.scramble(docs.view(np.uint64), 12), tasks))
    halves = [set(repeats.halfway(owners, t, tasks).tolist()) for t in range(tasks)]
    assert set().union(*halves) <= set(range(tasks)) and max(map(len, halves)) <= 1.1 * tasks**0.5 + 2
    to, got = {}, []
    for b in first:
        for i in range(b.num_rows):
            part = list(repeats.passed_on(tasks)(iter([b.slice(i, 1)])))
            assert sum(p.num_rows for p in part) <= tasks**0.5
            for p in part:
                assert not set(p.column("bucket").to_pylist()) & set(to), "an owner gets marks of a task from one place"
                to |= dict.fromkeys(p.column("bucket").to_pylist())
                got += repeats.collect_packed(iter([p]), False)[0]
    d, k, p = (np.concatenate(c) for c in zip(*got, strict=True))
    assert sorted(zip(d.tolist(), k.tolist(), p.tolist())) == [(i, i * 3, i % 40) for i in range(5_000)]


def test_nothing(spark):
    assert substring.digest(empty(spark)).count() == 0 and suffixes.digest(empty(spark)).count() == 0
