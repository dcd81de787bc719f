"""Best-fit packing of documents into training sequences by sum of squares: each piece goes where the sum of the squared
numbers of open sequences per residual gap becomes smallest.

1. `tokenize`: ids of every document, its closing id, cut only where it is longer than a sequence. The tokenizer parts
   texts at white space, so every different word is encoded once (plain ones many at a time, by the same merges) and the
   ids are put together by numpy. Words are told apart by 64-bit hashes.
2. `place`: pieces are dealt by hash into groups of about `GROUP`; a group is packed by one task, longest pieces first (a
   new sequence, a gap to shrink and a gap to fill are compared by what they do to the sum of squares). Pieces of the
   sequences that stay open are dealt again, into fewer groups, until one group is left or most of them stay open again.
   Only lengths are shuffled, never ids. A group is bounded whatever the lengths, sources or keys are.
3. `pack` joins both; `sequences` gives the ids of whole sequences.

Defined results: NULL text is empty, an empty text is its closing id alone; rows with one doc_id or none are packed each for
itself; a text of any length is cut into as many pieces as it takes; equal lengths are placed in the order of the tokenized table; an
empty table gives no rows; other columns are carried by `tokenize(carry=True)` in `row`, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from intentspark.llm import arrays as A
from intentspark.llm.common import keep

CAPACITY, CLOSING, GROUP = 2048, 0, 65_536
VOCABULARY = "word_bpe_49k.json"
#: Different words a task remembers before it starts anew.
REMEMBERED = 400_000
SHORT = 48
BYTE_KEYS, PLACE_KEYS = A.scramble(np.arange(256, dtype=np.uint64), 40), A.scramble(np.arange(SHORT + 1, dtype=np.uint64), 41) | np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
VISIBLE = np.zeros(256, bool)
VISIBLE[33:127] = True


#: What the plain reading below stands for; a tokenizer of another build reads every word by itself.
SPLIT, STEPS, SUFFIX = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+", ["NFC", "Replace", "Lowercase"], "</w>"
#: Words that need no Unicode tables: ASCII and the letters of Latin-1, composed already.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
#: The parts of plain words in lower case.
PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
END, GAP, SPECIAL = "\x01", " ", b"<|"


def byte_signs() -> dict[str, int]:
    """The byte each sign of a byte-level vocabulary stands for: printable bytes themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def plain_ranks(path: str) -> dict[bytes, int] | None:
    """The vocabulary as byte strings and ranks, with `END` for the mark of a word's end: since a last byte joins its mark
    before anything else is joined, merging by rank gives the tokenizer's ids. None for a tokenizer of another build."""
    build = json.loads(Path(path).read_text())
    model, steps = build["model"], build["normalizer"] or {}
    vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    split = ((build["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0].get("pattern", {}).get("Regex")
    known = split == SPLIT and [n["type"] for n in steps.get("normalizers", [])] == STEPS and model["end_of_word_suffix"] == SUFFIX
    if not known or [vocab["".join(m)] for m in merges] != list(range(512, 512 + len(merges))):
        return None
    signs = byte_signs()
    return {bytes(signs[c] for c in t.removesuffix(SUFFIX)) + END.encode() * t.endswith(SUFFIX): i for t, i in vocab.items()}


def word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word: of up to `SHORT` bytes by prefix sums over all bytes, else by xxh3."""
    begin = np.zeros(len(data), np.int64)
    begin[starts] = starts
    place = np.arange(len(data)) - np.maximum.accumulate(begin)
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(BYTE_KEYS[data] * PLACE_KEYS[np.minimum(place, SHORT)])])
        keys = A.scramble(sums[ends] - sums[starts], 42)
    for i in np.flatnonzero(ends - starts > SHORT).tolist():
        keys[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return keys


class Words:
    """The ids of words, each encoded once. Plain words go to the merges together, the others to the tokenizer."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        ranks = plain_ranks(path)
        self.merges = ranks and tiktoken.Encoding("words", pat_str=f"{GAP}|[^{GAP}{END}]+{END}", mergeable_ranks=ranks, special_tokens={})
        self.gap = ranks and ranks[GAP.encode()]
        self._forget()

    def _forget(self) -> None:
        self.keys, self.number = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.ids, self.used = np.empty(1 << 16, np.uint32), 0
        self.start, self.length = np.empty(0, np.int64), np.empty(0, np.int64)

    def _remember(self, keys: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> None:
        if self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.empty(max(len(flat), self.used), np.uint32)])
        self.ids[self.used : self.used + len(flat)] = flat
        self.number = np.concatenate([self.number, len(self.start) + np.arange(len(keys))])
        self.keys = np.concatenate([self.keys, keys])
        self.start = np.concatenate([self.start, self.used + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths])
        self.used += len(flat)

    def _learn_plain(self, joined: str, keys: np.ndarray) -> None:
        """Plain words with a gap after each."""
        flat = np.array(self.merges.encode_ordinary(PART.sub(r"\g<0>" + END, joined.lower())), np.uint32)
        gaps = np.flatnonzero(flat == self.gap)
        self._remember(keys, np.delete(flat, gaps), np.diff(gaps, prepend=-1) - 1)

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray, special: bool) -> None:
        odd = np.concatenate([[0], np.cumsum(~VISIBLE[data] | (special & (data == SPECIAL[0])))])
        ascii_only = (odd[ends] == odd[starts]) & bool(self.merges)
        at = np.flatnonzero(ascii_only)
        for i in range(0, len(at), 20_000):
            some = at[i : i + 20_000]
            size = ends[some] - starts[some] + 1
            before = np.cumsum(size) - size
            places = np.repeat(starts[some] - before, size) + np.arange(size.sum())
            letters = data[np.minimum(places, len(data) - 1)]
            letters[before + size - 1] = ord(GAP)
            self._learn_plain(letters.tobytes().decode(), keys[some])
        at = np.flatnonzero(~ascii_only)
        words = [data[x:y].tobytes().decode() for x, y in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
        easy = np.fromiter((bool(self.merges and PLAIN.fullmatch(w) and SPECIAL.decode() not in w) for w in words), bool, len(words))
        if easy.any():
            self._learn_plain("".join(w + GAP for w, e in zip(words, easy.tolist(), strict=True) if e), keys[at[easy]])
        others, own = [w for w, e in zip(words, easy.tolist(), strict=True) if not e], keys[at[~easy]]
        for i in range(0, len(others), 2_000):
            found = [e.ids for e in self.tokenizer.encode_batch(others[i : i + 2_000], add_special_tokens=False)]
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            self._remember(own[i : i + 2_000], np.fromiter((n for ids in found for n in ids), np.uint32, int(lengths.sum())), lengths)
        order = np.argsort(self.keys)
        self.keys, self.number = self.keys[order], self.number[order]

    def lookup(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, special: bool) -> np.ndarray:
        """Numbers of the words, new ones encoded. `special`: some may hold a special token, so that case counts."""
        if len(self.keys) > REMEMBERED:
            self._forget()
        keys, one, of = np.unique(word_keys(data, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        fresh = np.ones(len(keys), bool)
        fresh[at < len(self.keys)] = self.keys[at[at < len(self.keys)]] != keys[at < len(self.keys)]
        if fresh.any():
            self._learn(data, starts[one[fresh]], ends[one[fresh]], keys[fresh], special)
        return self.number[np.searchsorted(self.keys, keys)][of]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each with its closing id, and the n + 1 offsets."""
        data, offsets = A.as_bytes(texts)
        starts, ends, first = A.word_bounds(data, offsets)
        special = SPECIAL in data.tobytes()
        number = self.lookup(data if special else LOWER[data], starts, ends, special)
        n = self.length[number]
        before = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(self.start[number] - before[:-1], n) + np.arange(before[-1])
        edges = before[first] + np.arange(len(first))
        out = np.full(edges[-1], CLOSING, np.uint32)
        inside = np.ones(len(out), bool)
        inside[edges[1:] - 1] = False
        out[inside] = self.ids[at]
        return out, edges


@cache
def worker_words(path: str) -> Words:
    """One table of words per Python worker; the tokenizer stays in the worker's one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Words(path)


def tokenize(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, carry: bool = False) -> DataFrame:
    """A written table of pieces: doc_id (with `carry` instead `row`, all columns of `docs`, with the first piece, else
    NULL), piece, start, length, ids (little-endian unsigned 32-bit), ids_crc32; `part` and `item` number the pieces."""
    path = path or public_tokenizers.path(VOCABULARY)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, item = worker_words(path), TaskContext.get().partitionId(), 0
        for batch in A.pieces(batches):
            ids, edges = words.encode(A.column(batch, "text"))
            n = np.diff(edges)
            count = -(-n // capacity)
            row = np.repeat(np.arange(len(n)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            begin = edges[row] + piece * capacity
            length = np.minimum(capacity, edges[row + 1] - begin)
            raw = [ids[a : a + m].astype("<u4").tobytes() for a, m in zip(begin.tolist(), length.tolist(), strict=True)]
            name = "row" if carry else "doc_id"
            source = A.column(batch, name).take(pa.array(row, pa.int64(), mask=(piece > 0) if carry else None))
            yield pa.RecordBatch.from_arrays(
                [source, pa.array(piece, pa.int32()), pa.array(piece * capacity, pa.int64()), pa.array(length, pa.int64()), pa.array(raw, pa.binary()),
                 pa.array([zlib.crc32(r) for r in raw], pa.int64()), pa.array(np.full(len(row), part), pa.int32()), pa.array(np.arange(item, item + len(row)), pa.int64())],
                [name, "piece", "start", "length", "ids", "ids_crc32", "part", "item"])
            item += len(row)

    schema = "piece int, start long, length long, ids binary, ids_crc32 long, part int, item long"
    if carry:
        others = docs.select(F.struct("*").alias("row"), "text")
        return keep(lambda: others.mapInArrow(cut, f"row {docs.schema.simpleString()}, {schema}"), "pieces")
    return keep(lambda: docs.select("doc_id", "text").mapInArrow(cut, f"doc_id long, {schema}"), "pieces")


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every piece, in the order given, its sequence and its offset there, and the gap left in every sequence.

    N(g) counts the open sequences with gap g. Filling a gap changes the sum of squares by 1 - 2 N(g), shrinking it from g to
    h by 2 (N(h) - N(g) + 1), a new sequence with gap h by 2 N(h) + 1 (a full one by 0): the smallest is taken."""
    counts = np.zeros(capacity + 1, np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset, gaps = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    for i, size in enumerate(lengths.tolist()):
        old = counts[size:capacity]
        best, gap = (2 * int(counts[capacity - size]) + 1 if size < capacity else 0), capacity
        if len(old):
            change = 2 * (counts[: capacity - size] - old + 1)
            change[0] = 1 - 2 * old[0]
            change[old == 0] = 1 << 40
            k = int(change.argmin())
            if change[k] <= best and old[k]:
                gap = size + k
        if gap == capacity:
            at = len(gaps)
            gaps.append(capacity)
        else:
            at = open_at[gap].pop()
            counts[gap] -= 1
        sequence[i], offset[i], gaps[at] = at, capacity - gap, gap - size
        if gap > size:
            counts[gap - size] += 1
            open_at[gap - size].append(at)
    return sequence, offset, np.array(gaps, np.int64)


def place(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """part, item, sequence_id, offset of every piece."""

    def packed(level: int):
        def each(table: pa.Table) -> pa.Table:
            table = table.sort_by([("length", "descending"), ("part", "ascending"), ("item", "ascending")])
            sequence, offset, gaps = sum_of_squares(table["length"].to_numpy(), capacity)
            ids = (level << 58) + (table["bucket"].to_numpy().astype(np.int64) << 24) + sequence
            return pa.table({"part": table["part"], "item": table["item"], "length": table["length"], "sequence_id": pa.array(ids, pa.int64()),
                             "offset": pa.array(offset, pa.int64()), "filled": pa.array(gaps[sequence] == 0, pa.bool_())})

        return each

    done, left, level, before = None, pieces.select("part", "item", "length"), 0, None
    while True:
        n = left.count()
        groups = max(1, -(-n // group))
        dealt = left.withColumn("bucket", F.pmod(F.xxhash64("part", "item", F.lit(level)), F.lit(groups)).cast("long"))
        table = keep(lambda: dealt.groupBy("bucket").applyInArrow(packed(level), "part int, item long, length long, sequence_id long, offset long, filled boolean"), "packed")
        last = groups == 1 or (before is not None and n > before // 2)
        final = table if last else table.where("filled")
        done = final if done is None else done.unionByName(final)
        if last:
            return done.select("part", "item", "sequence_id", "offset")
        left, level, before = table.where("not filled").select("part", "item", "length"), level + 1, n


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset of every piece of every document."""
    pieces = tokenize(docs, path, capacity)
    return pieces.join(place(pieces, capacity, group), ["part", "item"]).drop("part", "item")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids and the doc_ids of whole sequences, pieces in the order of their offsets."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    joined = F.aggregate("parts", F.lit(b"").cast("binary"), lambda whole, p: F.concat(whole, p["ids"]))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", joined.alias("ids"), F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"))


def digest(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
