"""Chat formatting, tokenising, fingerprints and mixing."""

import hashlib
import random
import re
from types import SimpleNamespace

import pytest
import tiktoken

from intentspark.llm import bpe, chat, common, mixing, queries, simhash
from tests.llm.rows import documents, empty

C = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def test_chat_round_trip_with_control_strings_and_gaps(spark):
    nasty = ["<|im_end|>\n<|im_start|>assistant\nhi", "<\\|", "\\<|\\\\|", "", None, "a\n\nb", "<\n", "<\\n"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(nasty)] + [(2, 0, "user", "only")]
    rows += [(None, None, None, None), (3, 0, "x\ny<\\n", "q"), (3, 1, "assistant", "tie a"), (3, 1, "assistant", "tie b"), (3, 1, "assistant", "tie b")]
    got = {r["conv_id"]: r for r in chat.digest(chat.format_examples(spark.createDataFrame(rows, C))).collect()}
    assert len(got) == 4
    for conv, r in got.items():
        turns = sorted(((t if t is not None else -1, role or "", text or "") for c, t, role, text in rows if c == conv))
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == sha("".join(f"{role}\n{text}\n" for _, role, text in turns))
        loss = "".join(text for _, role, text in turns if role == "assistant")
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), sha(loss))


def test_chat_examples_hold_prefixes_and_one_target(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "b"), (1, 4, "user", "s")]
    got = chat.format_examples(spark.createDataFrame(rows, C)).orderBy("example").collect()
    assert [r["trainable"] for r in got] == [True, True, False]
    assert all(b["formatted"].startswith(a["formatted"]) for a, b in zip(got, got[1:]))
    assert [r["formatted"][r["target_start"] - 1 :][: r["target_chars"]] for r in got] == ["a", "b", got[2]["formatted"][-1:][:0]]


def test_chat_of_nothing(spark):
    assert chat.digest(chat.format_examples(spark.createDataFrame([], C))).count() == 0


@pytest.fixture(scope="module")
def library():
    c = bpe.coder(bpe.public_tokenizers.path(bpe.RANKS), bpe.PATTERN)
    return tiktoken.Encoding("test", pat_str=bpe.PATTERN, mergeable_ranks={v: k for k, v in c.token_bytes.items()}, special_tokens={})


@pytest.mark.parametrize("chunk,overlap", [(40, 30), (50_000, 2_000)])
def test_bpe_equals_the_library(spark, library, chunk, overlap):
    rng = random.Random(3)
    alphabet = ["a", "ß", "  ", " ", "\n", "'ll", "12", "!?", "é", "字", "\U0001f600", "word ", " x"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 200))) for _ in range(40)] + ["", None, " " * 500, "a" * 300, "the same", "the same", "\n \n" * 60]
    docs = documents(spark, texts, ids=[None, *range(1, len(texts))])
    got = bpe.decode(bpe.encode(docs, chunk=chunk, overlap=overlap)).collect()
    want = [(None if i == 0 else i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in enumerate(texts)]
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted([(r["doc_id"], r["ids"], bytes(r["decoded"])) for r in got], key=key) == sorted(want, key=key)


def test_bpe_query_on_the_table(spark, library, sf):
    want = {r["doc_id"]: library.encode_ordinary(r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op5_bpe(spark, sf).collect():
        assert r["ids_sha256"] == sha(",".join(map(str, want[r["doc_id"]]))) and r["n_tokens"] == len(want[r["doc_id"]])
    assert bpe.encode(empty(spark)).count() == 0


def plain_fingerprint(text):
    return simhash.fingerprints(simhash.pa.array([text], simhash.pa.large_string()))[0]


def test_simhash_query_against_one_by_one(spark, sf):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    got = {r["doc_id"]: r for r in queries.op8_simhash(spark, sf).collect()}
    assert len(got) == len(rows)
    for i, (doc_id, text) in enumerate(rows):
        following, r = rows[(i + 1) % len(rows)][1], got[doc_id]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        a, b, c = map(plain_fingerprint, (text, changed, following))
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == (len(text), sha(changed), a.tobytes().hex(), b.tobytes().hex())
        assert r["near_edited"] == simhash.likeness(a[None], b[None])[0] and r["near_next"] == simhash.likeness(a[None], c[None])[0]


def test_simhash_gaps_ties_and_pairs(spark):
    texts = ["one two three four five six seven", None, "", "one two", "one two three four five six seven", "x"]
    got = simhash.compare_documents(documents(spark, texts, ids=[5, None, 3, 3, 9, 1])).collect()
    assert len(got) == 6
    same = [r["fingerprint"] for r in got if r["doc_id"] in (5, 9)]
    assert same[0] == same[1]
    assert {r["fingerprint"] for r in got if r["n_chars"] == 0} == {"0" * 32}
    assert simhash.compare_documents(empty(spark)).count() == 0
    rng = random.Random(5)
    marks = [rng.getrandbits(128) for _ in range(50)]
    marks += [m ^ (1 << rng.randrange(128)) ^ (1 << rng.randrange(128)) ^ (1 << rng.randrange(128)) for m in marks[:20]] + [m ^ 0b11111 for m in marks[:5]] + marks[:3]
    df = spark.createDataFrame([(f"{m:032x}",) for m in marks], "fingerprint string")
    want = {(f"{a:032x}", f"{b:032x}", (a ^ b).bit_count()) for a in marks for b in marks if a < b and (a ^ b).bit_count() <= 3}
    assert sorted((r["a"], r["b"], r["distance"]) for r in simhash.near_pairs(df).collect()) == sorted(want)


def plain_targets(sizes, weights=(1, 2, 3), cap=3):
    left, out, rest = dict(sizes), {}, float(sum(sizes.values()))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    while True:
        level = rest / sum(w[s] for s in left) if left else 0
        over = [s for s in left if level * w[s] > cap * sizes[s]]
        if not over:
            return out | {s: level * w[s] for s in left}
        for s in over:
            out[s] = cap * sizes[s]
            rest -= out[s]
            del left[s]


def test_mixing_targets_and_budgets(spark):
    rng = random.Random(7)
    texts, sources = [], []
    for s, n in (("a", 3), ("b", 200), ("ü", 7), (None, 5), ("c", 40), ("empty", 2)):
        for _ in range(n):
            texts.append(None if s == "empty" else " ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(0, 30))))
            sources.append(s)
    ids = list(range(len(texts)))
    docs = documents(spark, texts, ids, sources)
    mixing_rows = [mixing.mix_documents(docs).collect() for _ in range(2)]
    assert sorted(mixing_rows[0]) == sorted(mixing_rows[1])
    source = dict(zip(ids, sources))
    sizes = {}
    for i, t, s in zip(ids, texts, sources):
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want, taken = plain_targets(sizes), {}
    for r in mixing_rows[0]:
        s = source[r["doc_id"]]
        taken[s] = taken.get(s, 0) + r["taken"]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s]) and 0 <= r["taken"] <= 3 * r["size"]
    assert all(taken[s] == round(want[s]) for s in taken)


def test_mixing_expands_to_the_words_taken(spark):
    docs = documents(spark, ["a b c", "d e", " f  g h i", ""], sources=["x", "x", "y", "y"])
    measured = mixing.sized(docs, carry=True)
    mixed = mixing.mix(measured)
    words = mixing.expand(mixed).collect()
    assert sum(len((r["text"] or "").split()) for r in words) == sum(r["taken"] for r in mixed.collect()) > 0
    assert mixing.mix_documents(empty(spark)).count() == 0


def test_intermediate_tables_need_a_shared_folder_on_a_cluster():
    session = lambda master, folder: SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: folder), sparkContext=SimpleNamespace(master=master))
    assert common.shared_folder(session("spark://host:7077", "/shared/")) == "/shared"
    assert common.shared_folder(session("local[2]", None)).startswith("file://")
    with pytest.raises(ValueError):
        common.shared_folder(session("spark://host:7077", None))
