"""Each stage of the pipeline against brute force on its own input."""

import re

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from intentspark.llm.common import keep, table
from tests.llm.rows import documents, empty
from tests.llm.test_formats import plain_targets, sha
from tests.llm.test_jaccard import plain
from tests.llm.test_repeats import runs

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, sf):
    docs, seen = table(spark, sf, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        seen.append(docs.collect())
        docs = keep(lambda: stage(spark, docs, sf), name)
        assert name == "tokens" or docs.columns == COLUMNS
    seen.append(docs.collect())
    given, good, single, cut, mix, out = seen
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    left = {r["doc_id"] for r in good}
    known = [(r["doc_id"] in left) == (labels[r["doc_id"]] == 1) for r in given if r["doc_id"] in labels]
    assert np.mean(known) > 0.95 and set(good) <= set(given)
    assert {r["doc_id"] for r in single} == {c for _, c, _, _ in plain([(r["doc_id"], r["text"]) for r in good])} and set(single) <= set(good)
    want = {}
    for doc_id, s, gone in runs([(r["doc_id"], r["text"]) for r in single], lambda t: t.encode(), 100, True):
        text = np.frombuffer(s, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
        if text or not gone.any():
            want[doc_id] = text
    assert {r["doc_id"]: r["text"] for r in cut} == want and all(r["n_chars"] == len(r["text"]) for r in cut if r["text"] is not None)
    sizes, taken, n = {}, {}, lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    for r in cut:
        sizes[r["source"]] = sizes.get(r["source"], 0) + n(r["text"])
    for r in mix:
        taken[r["source"]] = taken.get(r["source"], 0) + n(r["text"])
    assert taken == {s: round(t) for s, t in plain_targets(sizes).items() if round(t)}
    assert sorted((r["doc_id"], r["decoded_sha256"]) for r in out) == sorted((r["doc_id"], sha(r["text"])) for r in mix)
    assert all(len(r["ids"]) == r["n_tokens"] for r in out)


def test_stages_with_gaps_and_nothing(spark, sf):
    names = ("row", "key", "whole", "places", "kept", "n_removed", "score", "size", "target", "taken", "source_size", "mix_row", "rec", "root", "i", "side", "first")
    for docs in (documents(spark, ["plain words in a row here", None, "", "", "x " * 20_000], ids=[1, 2, 3, 3, None], sources=["a", None, "b", "b", "a"]), empty(spark)):
        docs = docs.withColumns({n: F.lit(7) for n in names})
        for name, stage in corpus_pipeline.STAGES:
            docs = keep(lambda: stage(spark, docs, sf), name)
            assert name == "tokens" or docs.columns == [*COLUMNS, *names]
        docs.collect()
