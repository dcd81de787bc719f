"""Packing against the tokenizer itself, a plain sum-of-squares search and the rules of a packing."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from intentspark.llm import packing, queries
from tests.llm.rows import documents, empty

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
ids_of = lambda text: [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


def plain_packing(lengths, capacity):
    """Every choice tried, its sum of squares counted anew."""
    gaps = []
    for size in lengths:
        squares = lambda: sum(n * n for n in np.unique([g for g in gaps if 0 < g], return_counts=True)[1].tolist())
        tried = {}
        for gap in sorted({g for g in gaps if g >= size}):
            at = gaps.index(gap)
            gaps[at] -= size
            tried[gap] = squares()
            gaps[at] += size
        gaps.append(capacity - size)
        new = squares()
        gaps.pop()
        best = min(tried, key=lambda g: (tried[g], g), default=None)
        if best is not None and tried[best] <= new:
            gaps[gaps.index(best)] -= size
        else:
            gaps.append(capacity - size)
    return gaps


def check(rows, texts, capacity=2048):
    """`texts` are (doc_id, text); rows of one doc_id must be equal texts or they are told apart by nothing."""
    want = []
    for doc_id, text in texts:
        ids = ids_of(text)
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a : a + capacity]
            want.append((doc_id, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(map(repr, want)) == sorted(repr((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])) for r in rows)
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in held.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1].tolist()] and ends[-1] <= capacity
    return len(held), sum(r["length"] for r in rows)


@pytest.mark.parametrize("seed", range(6))
def test_choices_against_every_choice(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 31, 120)
    sequence, offset, gaps = packing.sum_of_squares(lengths, 30)
    assert sorted(gaps.tolist()) == sorted(plain_packing(lengths.tolist(), 30))
    for s in range(len(gaps)):
        mine = sequence == s
        assert offset[mine].tolist() == [0, *np.cumsum(lengths[mine])[:-1].tolist()] and 30 - lengths[mine].sum() == gaps[s]


AWKWARD = ["", None, "it's THE <|endoftext|>x<|startoftext|> end", "é café  nbsp　wide line", "Σίσυφος ΟΔΟΣ İstanbul", "１２３ ½ ﬁ 한국어 日本語",
           "tab\tnew\nline\x1cfs", "x" * 5000, " \n ", "don't 'll we've", "́ alone", "word " * 6000, "same text", "same text"]


def test_awkward_texts(spark):
    docs = documents(spark, AWKWARD, ids=[*range(len(AWKWARD) - 2), None, None]).withColumns({c: F.lit(1) for c in ("piece", "ids", "part", "item", "bucket", "length", "start", "row")})
    check(packing.pack(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])
    carried = packing.tokenize(docs, carry=True)
    assert sorted(map(repr, (r["row"] for r in carried.where("piece = 0").collect()))) == sorted(map(repr, docs.collect()))
    assert carried.where("piece > 0 and row is not null").isEmpty()


def test_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    import pyarrow as pa

    words, texts = packing.Words(public_tokenizers.path("word_bpe_49k.json")), ["a b c d", "e f g", "", "a h b"]
    for _ in range(3):
        ids, edges = words.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:])] == [ids_of(t) for t in texts]


def test_query_and_levels(spark, sf):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    used, tokens = check(queries.op11_packing(spark, sf).collect(), texts)
    assert used <= -(-tokens // 2048) * 1.02 + 1
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    packed = packing.pack(docs, capacity=512, group=40)
    used, tokens = check(packed.collect(), texts, 512)
    assert used <= tokens / 512 * 1.1
    whole = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in packing.sequences(packed).collect()}
    every = {d: ids_of(t) for d, t in texts}
    for r in packed.collect():
        assert whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == every[r["doc_id"]][r["start"] : r["start"] + r["length"]]


def test_nothing_fits_together(spark):
    docs = documents(spark, ["word " * 299] * 90)
    rows = packing.pack(docs, capacity=512, group=10).collect()
    assert len({r["sequence_id"] for r in rows}) == 90


def test_nothing(spark):
    assert packing.pack(empty(spark)).count() == 0 and packing.sequences(packing.pack(empty(spark))).count() == 0
