"""The chosen-path join against all pairs."""

import random
import re

import numpy as np
import pytest

from intentspark.llm import jaccard, queries
from tests.llm.rows import documents, empty


def plain(rows):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        s = frozenset(tuple(w[a : a + 5]) for a in range(max(1, len(w) - 4))) if w else frozenset()
        sets.setdefault(s, []).append(i)
    keys = list(sets)
    post = {}
    for k, s in enumerate(keys):
        for g in s:
            post.setdefault(g, []).append(k)
    shared = {}
    for ks in post.values():
        for a in range(len(ks)):
            for b in range(a):
                shared[ks[b], ks[a]] = shared.get((ks[b], ks[a]), 0) + 1
    up, links = list(range(len(keys))), [0] * len(keys)
    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for (a, b), n in shared.items():
        if n >= 0.8 * (len(keys[a]) + len(keys[b]) - n) - 1e-9:
            links[a] += 1
            links[b] += 1
            up[root(a)] = root(b)
    least = {}
    for k, s in enumerate(keys):
        least[root(k)] = min(least.get(root(k), 10**18), *sets[s])
    return sorted((i, least[root(k)], links[k], len(sets[s])) for k, s in enumerate(keys) for i in sets[s])


def rows_of(df):
    return sorted((r["doc_id"], r["class_id"], r["n_links"], r["n_copies"]) for r in df.collect())


def varied(rng, words, share):
    return [w if rng.random() > share else f"e{rng.randrange(10**6)}" for w in words]


def test_classes_and_links_equal_all_pairs(spark, sf):
    rng = random.Random(4)
    texts = []
    for _ in range(20):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(20, 200))]
        texts += [" ".join(varied(rng, base, rng.choice([0, 0.005, 0.02, 0.05]))) for _ in range(rng.randint(1, 12))]
    texts += ["", None, "a b", "a  b", "a b c d e", "one"]
    rows = list(enumerate(texts))
    assert rows_of(jaccard.link_documents(documents(spark, texts))) == plain(rows)
    table = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert rows_of(queries.op7_jaccard(spark, sf)) == plain(table)


def test_a_large_group_is_split_compared_in_blocks_and_counted(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", 20)
    monkeypatch.setattr(jaccard, "BLOCK", 32)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(varied(rng, base, 0.012)) for _ in range(150)] + [" ".join(f"u{rng.randrange(10**6)}" for _ in range(30)) for _ in range(60)]
    assert rows_of(jaccard.link_documents(documents(spark, texts))) == plain(list(enumerate(texts)))


def bridged():
    """Signatures of i, j, x, y: x and y agree in 52 places, i and x, j and y in 42, all other pairs in 30."""
    rng = np.random.default_rng(3)
    x, y, i, j = rng.permuted(np.tile(np.arange(256, dtype=np.uint8), (4, 1)), axis=1)[:, :64] // 4 + np.arange(4, dtype=np.uint8)[:, None] * 64
    y[:52], i[22:] = x[:52], x[22:]
    j[22:] = y[22:]
    return np.array([i, j, x, y])


def test_a_pair_is_linked_when_both_are_like_others_first():
    marks = bridged()
    a, b = jaccard.link_bucket(list("ijxy"), marks)
    assert set(a) == {"i"} and sorted(b) == ["j", "x", "y"]
    far = (np.arange(64, dtype=np.uint8)[None] * 4 + 1) % 251 + np.zeros((1, 1), np.uint8)
    a, b = jaccard.link_bucket([*"ijxy", "far", "z"], np.concatenate([marks, far, marks[:1]]), np.array([0, 0, 0, 0, 0, 1]))
    assert list(zip(a, b)) == [("i", "z")]


def test_families_joined_by_bridging_pairs_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", 8)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rng = random.Random(9)
    texts = []
    for f in range(4):
        part = lambda n, tag: [f"{tag}{f}x{i}" for i in range(n)]
        shared, left, right = part(280, "s"), part(34, "l"), part(34, "r")
        x, y = left + shared, shared + right
        i, j = left + shared[:220] + part(60, "i"), part(60, "j") + shared[60:] + right
        texts += [" ".join(x), " ".join(y)] + [" ".join(varied(rng, base, 0.002)) for base in (i, j) for _ in range(40)]
    rng.shuffle(texts)
    assert rows_of(jaccard.link_documents(documents(spark, texts))) == plain(list(enumerate(texts)))


def test_gaps_repeated_ids_and_one_of_each(spark):
    same = " ".join(f"w{i}" for i in range(40))
    texts, ids = [same, same + " more", None, "", same, "other words here", "quite different words"], [7, 3, None, 2, 9, 5, 5]
    docs = documents(spark, texts, ids)
    got = rows_of(jaccard.link_documents(docs.where("doc_id is not null")))
    assert got == sorted([(7, 3, 1, 2), (3, 3, 1, 1), (2, 2, 0, 1), (9, 3, 1, 2), (5, 5, 0, 1), (5, 5, 0, 1)])
    assert jaccard.link_documents(docs).count() == 7
    kept = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in jaccard.one_of_each(docs).collect())
    assert kept == [(False, 0, ""), (True, 2, ""), (True, 3, same + " more"), (True, 5, "other words here")]
    assert jaccard.link_documents(empty(spark)).count() == 0


def test_runs_reach_the_recall():
    assert jaccard.runs_needed(0.9) <= jaccard.runs_needed(0.9999) == 4


def test_forest_connects_what_the_links_connect():
    a, b = np.array([5, 3, 2, 8]), np.array([3, 1, 8, 9])
    top, node = jaccard.forest(a, b, 10)
    assert dict(zip(node.tolist(), top.tolist())) == {3: 1, 5: 1, 8: 2, 9: 2}


@pytest.mark.parametrize("n", [0, 1])
def test_shared_counts_of_few_sets(n):
    assert jaccard.shared_counts([np.array([1, 2], np.uint64)] * (n + 1)).shape == (n + 1, n + 1)
