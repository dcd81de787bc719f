"""Toxicity and quality against held-out labels, and the channel's readings."""

import numpy as np
import pyarrow as pa
import pytest

from intentspark.llm import quality, queries, toxicity
from tests.llm.rows import documents, empty

LABELS = "doc_id long, quality int, toxic int"
BIG = "/root/testdata/sf0.1"


def held_out(spark, query, label):
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    r = query(spark, BIG).join(labels, "doc_id").toPandas()
    r = r[r.held_out]
    return r.predicted.to_numpy(), r[label].to_numpy(), r.score.to_numpy()


def auc(score, y):
    order = np.argsort(np.argsort(score))
    n = y.sum()
    return (order[y == 1].sum() - n * (n - 1) / 2) / (n * (len(y) - n))


def test_quality_on_held_out_rows(spark):
    predicted, y, score = held_out(spark, queries.op6_quality, "quality")
    assert (predicted == y).mean() > 0.98 and auc(score, y) > 0.97 and ((score >= 0) & (score <= 1)).all()


def test_toxicity_on_held_out_rows(spark):
    predicted, y, score = held_out(spark, queries.op3_toxicity, "toxic")
    assert (predicted == y).mean() > 0.97 and auc(score, y) > 0.93
    assert (predicted[y == 0] == 0).mean() > 0.98


def test_channel_restores_leetspeak_separators_and_repetition(spark):
    channel = toxicity.Channel(toxicity.character_counts(spark.read.parquet(f"{BIG}/documents.parquet")))
    for hidden, plain in (("1d10t", "idiot"), ("m0r0n", "moron"), ("$tup1d", "stupid"), ("i.d.i.o.t", "idiot"), ("iiidiooot", "idiot"), ("l0ser!!", "loser"),
                          ("w-o-r-t-h-l-e-s-s", "worthless"), ("sc*um", "scum"), ("CLOWN,", "clown"), ("thing", "thing")):
        assert channel.read(hidden) == plain
    assert channel.read("555-5132").split() == [] and channel.spaced("idiot") == "idiot"


def test_spaced_words_are_found_in_texts(spark):
    channel = toxicity.Channel(toxicity.character_counts(documents(spark, ["such an idiot here"] * 3)))
    found = toxicity.found_features(toxicity.pa.array(["you i d i o t there", "i d", None, ""]), channel, None)
    assert "idiot" in found[0] and found[1:] == [set(), set(), set()]


def test_channel_searches_foreign_letters_doubles_leading_signs_spaced_runs_and_long_tokens(spark):
    channel = toxicity.Channel(toxicity.character_counts(spark.read.parquet(f"{BIG}/documents.parquet")))
    for hidden, plain in (("\u0456diot", "idiot"), ("idi\u043et", "idiot"), ("iddiot", "idiot"), ("morron", "moron"), ("m\u00f6ron", "moron"), ("|diot", "idiot"), ("!diot", "idiot"), ("(lown", "clown"), ("idiot!", "idiot"), ("(idiot)", "idiot")):
        assert plain in channel.read(hidden).split()
    assert "moron" in channel.spaced("amoron").split() and "idiot" in channel.spaced("youidiot").split()
    assert "idiot" in channel.read("-".join(["the"] * 30 + ["1d10t"])).split()
    for word in ("iddi0t", "m\u00f6r0n", "ha++ed", "(l0wn!"):
        assert channel.restore(channel.lattice(word)) == channel.restore_listed([channel.lattice(word)])[0]


@pytest.mark.parametrize("module", [quality, toxicity])
def test_gaps_ties_empty_tables_and_missing_labels(spark, module):
    docs = documents(spark, ["good words here today", None, "", "bad bad bad bad", "bad bad bad bad", "x " * 30_000], ids=[1, 2, 3, 4, 4, None])
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (4, None, None), (None, 1, 1), (77, 1, 1)], LABELS)
    for known in (labels, labels.limit(0)):
        got = module.classify(docs, known).collect()
        assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
        assert len({r["score"] for r in got if r["doc_id"] == 4}) == 1 and len({r["score"] for r in got if r["doc_id"] in (2, 3)}) == 1
    assert module.classify(empty(spark), labels).count() == 0


def test_sieve_stops_no_word_that_holds_a_feature():
    """Hidden words in every disguise the channel knows: features found with the sieve are those found without."""
    import random

    import pyarrow as pa

    from intentspark.llm import toxicity

    rng, counts = random.Random(4), np.zeros(toxicity.SYMBOLS**3, np.int64)
    plain = ["moron", "idiot", "stupid", "loser", "pathetic", "hello", "gentle", "lilies", "class", "assist", "coco", "müll"]
    batch = pa.RecordBatch.from_arrays([pa.array([" ".join(rng.choice(plain) for _ in range(400))])], ["text"])
    toxicity.count_trigrams(batch, counts)
    wanted = {f: i for i, f in enumerate(sorted({f for w in plain[:5] + ["müll", "lilies"] for f in toxicity.features(w)}))}
    signs = {}
    for sign, letters in toxicity.STANDS_FOR.items():
        for x in letters:
            signs.setdefault(x, []).append(sign)

    def hide(word):
        out = rng.choice(["", "", "(", "!", "|", ".", "\"", "(!"])
        for c in word:
            c = rng.choice(signs[c]) if c in signs and rng.random() < 0.35 else c
            out += (c * rng.randint(2, 4) if rng.random() < 0.15 else c) + (rng.choice(".-_*!|(+7 ") if rng.random() < 0.12 else "")
        return rng.choice([str, str.upper, str.title])(out) + rng.choice(["", "", "!", "!!!", ".", "s", "1"])

    texts = pa.array([" ".join(hide(rng.choice(plain)) for _ in range(rng.randint(0, 4))) for _ in range(2_000)] + ["", None, "123 !!! ...", "i d i o t x"])
    every = toxicity.found_features(texts, toxicity.Channel(counts), wanted)
    assert toxicity.found_features(texts, toxicity.Channel(counts), wanted, toxicity.Sieve(wanted)) == every
    assert sum(map(bool, every)) > 500
    assert toxicity.Sieve({}).passes(["idiot"]) == [] and "gentle" not in [plain[i] for i in toxicity.Sieve(wanted).passes(plain)]


def test_neighbours_are_the_same_in_blocks_of_any_size(monkeypatch):
    """The working arrays cover a block of words; sums are those of the whole batch."""
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["Alpha", "beta,", "42", "ga-mma"], n)) if n else "" for n in (40, 0, 1, 300, 2, 7)]
    batch = pa.RecordBatch.from_arrays([pa.array([*texts, None])], ["text"])
    index = quality.index_vectors()
    want = np.zeros(quality.BUCKETS * (quality.DIM + 1), np.int64)
    words, first = quality.tokens(batch.column(0))
    for a, b in zip(first[:-1], first[1:]):
        for i in range(a, b):
            want[quality.BUCKETS * quality.DIM + words[i]] += 1
            for j in range(max(a, i - quality.SPAN), min(b, i + quality.SPAN + 1)):
                if i != j:
                    want[words[i] * quality.DIM : (words[i] + 1) * quality.DIM] += index[words[j]]
    for block in (1, 2, 7, 2**16):
        monkeypatch.setattr(quality, "BLOCK", block)
        got = np.zeros_like(want)
        quality.count_neighbours(index)(batch, got)
        assert (got == want).all()
