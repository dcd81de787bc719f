"""Byte-level BPE encoding and decoding with a given vocabulary.

A long text is cut into chunks that overlap. Chunks are pre-tokenised in parallel; a chunk's first matches may be out of
step, so neighbours are stitched at the first boundary in their overlap that both have: from a true boundary on, matches
depend on the following text only. Then the matches between the stitches are encoded, chunk by chunk in parallel, and put
together per document. Where two neighbours share no boundary (an overlap inside one endless word), the document is
pre-tokenised whole. A boundary near a chunk's end is not trusted: the match before it could have run on.
Texts of one chunk need no stitching and no shuffle. Decoding concatenates the tokens' bytes.

Defined results: NULL text is empty and gives no tokens; doc_ids may be NULL or repeat, every row is encoded by itself; an
empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentspark.llm import arrays as A
from intentspark.llm.common import keep

RANKS, PATTERN = "byte_bpe_multi_50k.tiktoken", public_tokenizers.PATTERN
CHUNK, OVERLAP = 50_000, 2_000
#: Different matches whose ids a worker remembers.
REMEMBERED = 60_000


class Coder:
    """One vocabulary, loaded once per worker."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.matches = regex.compile(pattern).findall
        self.library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.token_bytes = {v: k for k, v in ranks.items()}
        self.known: dict[str, tuple[int, ...]] = {}

    def ids(self, parts: list[str]) -> list[int]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, new = self.known, self.library._encode_single_piece
        for part in set(parts).difference(known):
            known[part] = tuple(new(part))
        return list(chain.from_iterable(map(known.__getitem__, parts)))

    def encode(self, text: str) -> list[int]:
        return self.ids(self.matches(text))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> Coder:
    return Coder(path, pattern)


def cut(text: str, chunk: int, overlap: int) -> list[str]:
    return [text[i : i + chunk + overlap] for i in range(0, max(1, len(text)), chunk)]


def stitches(lengths: list[int], part: int, last: bool, chunk: int, overlap: int) -> tuple[list[int], list[int]]:
    """A chunk's boundaries in the text, as far as its neighbours need them: those in its first `overlap` code points, and
    the trusted ones in the overlap with the next chunk."""
    at, head, tail, base = 0, [], [], part * chunk
    for n in [0, *lengths]:
        at += n
        if at < overlap // 2:
            head.append(base + at)
        if not last and chunk <= at < chunk + overlap // 2:
            tail.append(base + at)
    return head, tail


def encode(docs: DataFrame, path: str | None = None, pattern: str = PATTERN, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id and ids (array of int) of every row."""
    path = path or public_tokenizers.path(RANKS)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    short = F.length("text") <= chunk

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, pattern)
        for batch in A.pieces(batches):
            ids = pa.array([c.encode(t) for t in A.column(batch, "text").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([A.column(batch, "doc_id"), ids], ["doc_id", "ids"])

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.pieces(batches):
            for row, text, n in zip(A.column(batch, "row").to_pylist(), A.column(batch, "text").to_pylist(), A.column(batch, "doc_id"), strict=True):
                parts = cut(text, chunk, overlap)
                yield pa.RecordBatch.from_arrays([pa.array([row] * len(parts)), pa.array([n.as_py()] * len(parts), n.type), pa.array(range(len(parts)), pa.int32()),
                                                  pa.array([len(parts)] * len(parts), pa.int32()), pa.array(parts)], ["row", "doc_id", "part", "parts", "text"])

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, pattern)
        for batch in A.pieces(batches):
            lengths = [list(map(len, c.matches(t))) for t in A.column(batch, "text").to_pylist()]
            found = [stitches(n, p, p + 1 == of, chunk, overlap) for n, p, of in zip(lengths, A.column(batch, "part").to_pylist(), A.column(batch, "parts").to_pylist(), strict=True)]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lengths, longs), pa.array([h for h, _ in found], longs), pa.array([t for _, t in found], longs)],
                                             [*batch.schema.names, "lengths", "head", "tail"])

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, pattern)
        for batch in A.pieces(batches):
            out = []
            for text, part, lengths, first, end in zip(*(A.column(batch, x).to_pylist() for x in ("text", "part", "lengths", "first", "end")), strict=True):
                at, parts = part * chunk, []
                for n in lengths:
                    if first <= at and (end is None or at < end):
                        parts.append(text[at - part * chunk : at - part * chunk + n])
                    at += n
                out.append(c.ids(parts))
            yield pa.RecordBatch.from_arrays([*(A.column(batch, x) for x in ("row", "doc_id", "part")), pa.array(out, pa.list_(pa.int32()))], ["row", "doc_id", "part", "ids"])

    base = "row long, doc_id long, part int, parts int, text string"
    cuts = rows.where(~short).withColumn("row", F.monotonically_increasing_id()).mapInArrow(A.tidy(chunked), base).repartition("row", "part")
    found = keep(lambda: cuts.mapInArrow(A.tidy(matched), base + ", lengths array<bigint>, head array<bigint>, tail array<bigint>"), "bpe")
    ahead = found.select("row", (F.col("part") - 1).alias("part"), F.col("head").alias("next_head"))
    seams = found.select("row", "part", "parts", "tail").join(ahead, ["row", "part"], "left").withColumn("end", F.array_min(F.array_intersect("tail", "next_head")))
    broken = seams.where("part + 1 < parts and end is null").select("row").distinct()
    ends = seams.select("row", "part", "end")
    starts = seams.where("part + 1 < parts").select("row", (F.col("part") + 1).alias("part"), F.col("end").alias("first"))
    stitched = (found.select("row", "doc_id", "part", "text", "lengths").join(broken, "row", "left_anti").join(ends, ["row", "part"])
                .join(starts, ["row", "part"], "left").withColumn("first", F.coalesce("first", F.lit(0).cast("long"))))
    encoded = stitched.mapInArrow(A.tidy(between), "row long, doc_id long, part int, ids array<int>").groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("part", "ids"))).alias("all"))
    stitched_ids = encoded.select("doc_id", F.flatten(F.transform("all", lambda x: x["ids"])).alias("ids"))
    again = found.join(broken, "row", "left_semi").groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("part", F.substring("text", 1, chunk).alias("text")))).alias("all"))
    again = again.select("doc_id", F.array_join(F.transform("all", lambda x: x["text"]), "").alias("text")).mapInArrow(A.tidy(whole), "doc_id long, ids array<int>")
    return rows.where(short).mapInArrow(A.tidy(whole), "doc_id long, ids array<int>").unionByName(stitched_ids).unionByName(again)


def decode(encoded: DataFrame, path: str | None = None, pattern: str = PATTERN) -> DataFrame:
    """Adds `decoded`, the tokens' bytes end to end."""
    path = path or public_tokenizers.path(RANKS)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                out = pa.array([c.decode(ids) for ids in A.column(part, "ids").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, out], [*part.schema.names, "decoded"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(A.tidy(decoded), f"{fields}, decoded binary")


def digest(decoded: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    return decoded.select(
        "doc_id", *carry, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
