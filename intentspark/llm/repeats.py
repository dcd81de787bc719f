"""Repeated runs across documents by difference-cover anchors, shared by the word and the byte operator.

A run of `width` symbols repeats if it also starts earlier. Comparing the run at every position means one shuffled record
per symbol; instead short anchors are compared at the positions whose residue modulo v lies in a difference cover D: for
any two residues some shift below v brings both into D, so two equal runs share an anchor of width - v + 1 symbols at the
same shift. Then three steps:

1. anchors: every task hashes its anchors, finds those that repeat among its own and sends one of each kind to the task
   that owns the hash; what repeats there or anywhere is a candidate;
2. extension: documents with candidates (of equal texts only the first document) send the full runs around them: words as
   a hash of each run; bytes as stretches of text, each of consecutive runs with one owner, which hold a hundred runs in
   little more than the bytes of one. Equal runs meet at one task, and all but the earliest are marked;
3. marks go back to their documents in two steps, to one of the tasks that serve a group of owners and from there to the
   owner: a row from every task to every other would make the square of their number, the root of tasks groups make less.

An anchor or run of any frequency costs a task one record, since it is aggregated before the shuffle. Nothing is paired.
Records are packed: hashes, documents with counts, position differences. Runs are compared by 64 bits beyond those that
choose the task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentspark.llm import arrays as A
from intentspark.llm.common import keep, partitions


PACKED = "bucket int, kind int, docs binary, keys binary, counts binary, places binary, hashes binary"
MARKED = "doc_id long, key long, places binary"


@dataclass(frozen=True)
class Kind:
    """What repeats: runs of `width` symbols; `modulus` and `cover` choose the anchors.

    With `gram` (symbols of one byte) runs travel as pieces of text, dealt by the least hash of `gram` symbols in them.
    `read` gives a batch's symbols, as they are stored, and each text's offsets; `widen` turns stored symbols to 64 bits.
    With `within` an earlier start in the same document counts too. A task reads pieces of about `piece` bytes, sends after `flush` records and takes a text
    of more than `segment` symbols in parts."""

    width: int
    modulus: int
    cover: tuple[int, ...]
    within: bool
    read: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]
    widen: Callable[[np.ndarray], np.ndarray]
    flush: int = 400_000
    segment: int = 2_000_000
    piece: int = 500_000
    gram: int = 0

    @property
    def anchor(self) -> int:
        return self.width - self.modulus + 1


def is_cover(cover: tuple[int, ...], modulus: int) -> bool:
    return {(a - b) % modulus for a in cover for b in cover} == set(range(modulus))


def segments(batches: Iterator[pa.RecordBatch], kind: Kind) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, int]]:
    """(rows, symbols, offsets, base): pieces of the input; a text beyond `segment` symbols comes in overlapping parts,
    of which `base` is the place in the text, so that each run lies in exactly one part."""
    for batch in A.pieces(batches, size=kind.piece):
        stored, first = kind.read(batch)
        if batch.num_rows > 1 or len(stored) <= kind.segment:
            yield batch, kind.widen(stored), first, 0
            continue
        for base in range(0, len(stored), kind.segment):
            part = stored[base : base + kind.segment + kind.width - 1]
            yield batch, kind.widen(part), np.array([0, len(part)]), base


def pack_places(row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes]:
    """The different rows (in order), how many places each has, and the differences of the places, in two planes."""
    begin = np.flatnonzero(np.diff(row, prepend=-1))
    step = np.diff(place, prepend=0)
    step[begin] = place[begin]
    return row[begin], np.diff(np.append(begin, len(row))), A.blob((step & 0xFFFF).astype(np.uint16)) + A.blob((step >> 16).astype(np.uint16))


def unpack_places(counts: np.ndarray, packed: bytes) -> np.ndarray:
    low, high = np.frombuffer(packed, np.uint16).reshape(2, -1).astype(np.int64)
    total = np.cumsum(low + (high << 16))
    begin = np.cumsum(counts) - counts
    return total - np.repeat(np.concatenate([[0], total])[begin], counts)


def owner(hashes: np.ndarray, tasks: int) -> np.ndarray:
    return (((hashes >> np.uint64(40)) * np.uint64(tasks)) >> np.uint64(24)).astype(np.int64)


def packed_row(bucket: int, kind: int, docs: np.ndarray, keys: np.ndarray, row: np.ndarray, place: np.ndarray, hashes: bytes = b"") -> tuple:
    rows, counts, places = pack_places(row, place)
    return bucket, kind, A.blob(docs[rows]), A.blob(keys[rows]), A.blob(counts.astype(np.uint32)), places, hashes


def packed_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [f.split()[0] for f in PACKED.split(", ")])


def sorted_marks(docs: np.ndarray, keys: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different marks in order: the documents, their keys, and for each mark its document's number and its place."""
    order = np.lexsort((place, keys, docs))
    docs, keys, place = docs[order], keys[order], place[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (keys[1:] != keys[:-1])
    fresh = new.copy()
    fresh[1:] |= place[1:] != place[:-1]
    row = np.cumsum(new) - 1
    return docs[new], keys[new], row[fresh], place[fresh]


def halfway(owners: np.ndarray, task: int, tasks: int) -> np.ndarray:
    """The task that takes marks of `task` for these owners: owners come in about root of `tasks` groups, and all tasks
    are shared out among the groups, so no task sends to more than the groups or, from there, to more than a group."""
    size = isqrt(tasks)
    lanes = max(1, tasks // -(-tasks // size))
    return owners // size * lanes + task % lanes


def marks_by_owner(found: list[tuple[np.ndarray, ...]], tasks: int, task: int | None = None) -> Iterator[pa.RecordBatch]:
    """Marks (documents, keys, places) packed for the tasks that own the documents, one row for each; those that `task`
    has found go halfway first."""
    if not sum(len(places) for _, _, places in found):
        return
    docs, keys, row, place = sorted_marks(*(np.concatenate(c) for c in zip(*found, strict=True)))
    to = owner(A.scramble(docs.view(np.uint64), 12), tasks)[row]
    to = to if task is None else halfway(to, task, tasks)
    by = np.argsort(to, kind="stable")
    edges = np.searchsorted(to[by], np.arange(tasks + 1))
    yield packed_batch([packed_row(t, 0, docs, keys, row[m], place[m]) for t in np.flatnonzero(np.diff(edges)).tolist() for m in [by[edges[t] : edges[t + 1]]]])


def passed_on(tasks: int):
    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from marks_by_owner(collect_packed(batches, False)[0], tasks)

    return passed


def marked_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document with all its places."""
    marks, _ = collect_packed(batches, False)
    if not marks:
        return
    docs, keys, row, place = sorted_marks(*(np.concatenate(c) for c in zip(*marks, strict=True)))
    _, counts, _ = pack_places(row, place)
    ends = np.cumsum(counts)
    packed = [pack_places(row[e - c : e], place[e - c : e])[2] for c, e in zip(counts.tolist(), ends.tolist(), strict=True)]
    for i in range(0, len(docs), 5_000):
        yield pa.RecordBatch.from_arrays([pa.array(docs[i : i + 5_000], pa.int64()), pa.array(keys[i : i + 5_000], pa.int64()), pa.array(packed[i : i + 5_000], pa.binary())], ["doc_id", "key", "places"])


class Gathered:
    """Records of one task, grown until they are sent."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.docs: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []
        self.rows = self.size = 0

    def add(self, batch: pa.RecordBatch, row: np.ndarray, place: np.ndarray, *hashes: np.ndarray) -> None:
        self.parts.append((row + self.rows, place, *hashes))
        self.docs.append(A.column(batch, "doc_id").to_numpy())
        self.keys.append(A.column(batch, "key").to_numpy())
        self.rows += batch.num_rows
        self.size += len(row)

    def take(self) -> tuple[np.ndarray, ...]:
        columns = [np.concatenate(c) for c in zip(*self.parts, strict=True)]
        out = np.concatenate(self.docs), np.concatenate(self.keys), *columns
        self.__init__()
        return out


def send_anchors(kind: Kind, tasks: int):
    inside = np.zeros(kind.modulus, bool)
    inside[list(kind.cover)] = True

    def packed(g: Gathered, turn: int) -> Iterator[pa.RecordBatch]:
        docs, keys, row, place, h = g.take()
        order = np.argsort(h, kind="stable")
        new = np.concatenate([[True], h[order][1:] != h[order][:-1]])
        repeated = ~new | np.concatenate([~new[1:], [False]])
        again = np.sort(order[repeated])
        if len(again):
            yield packed_batch([packed_row(turn % tasks, 0, docs, keys, row[again], place[again])])
        sent = np.sort(order[new])
        to = owner(h[sent], tasks)
        by = np.argsort(to, kind="stable")
        edges = np.searchsorted(to[by], np.arange(tasks + 1))
        rows = []
        for b in np.flatnonzero(np.diff(edges)).tolist():
            mine = sent[by[edges[b] : edges[b + 1]]]
            low = h[mine]
            hashes = A.blob(low.astype(np.uint32)) + A.blob((low >> np.uint64(32)).astype(np.uint16))
            rows.append(packed_row(b, 1, docs, keys, row[mine], place[mine], hashes))
        yield packed_batch(rows)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, turn = Gathered(), 0
        for batch, symbols, first, base in segments(batches, kind):
            hashes = A.rolling(symbols, kind.anchor)
            n = np.diff(first)
            row = np.repeat(np.arange(len(n)), n)[: len(hashes)]
            place = np.arange(len(hashes)) - first[row] + base
            use = inside[place % kind.modulus] & (place - base + kind.anchor <= n[row])
            at = np.flatnonzero(use)
            g.add(batch, row[at], place[at], hashes[at])
            if g.size >= kind.flush:
                yield from packed(g, turn)
                turn += 7
        if g.size:
            yield from packed(g, turn)

    return send


def collect_packed(batches: Iterator[pa.RecordBatch], wide: bool) -> tuple[list[tuple[np.ndarray, ...]], tuple[np.ndarray, ...] | None]:
    """The task's marks (documents, keys, places) and its records: documents and keys, and for each record the number of
    its document, its place and its hash (`wide`: 64 bits)."""
    marks, tables, parts, rows = [], [], [], 0
    for batch in batches:
        for _, what, docs, keys, counts, places, hashes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            counts = np.frombuffer(counts, np.uint32).astype(np.int64)
            docs, keys, place = np.frombuffer(docs, np.int64), np.frombuffer(keys, np.int64), unpack_places(counts, places)
            if what == 0:
                marks.append((np.repeat(docs, counts), np.repeat(keys, counts), place))
                continue
            if wide:
                h = np.frombuffer(hashes, np.uint64)
            else:
                n = 4 * len(place)
                h = np.frombuffer(hashes[:n], np.uint32).astype(np.uint64) | (np.frombuffer(hashes[n:], np.uint16).astype(np.uint64) << np.uint64(32))
            tables.append((docs, keys))
            parts.append((np.repeat(np.arange(rows, rows + len(docs), dtype=np.uint32), counts), place.astype(np.uint32), h))
            rows += len(docs)
    if not parts:
        return marks, None
    docs, keys = (np.concatenate(c) for c in zip(*tables, strict=True))
    columns = []
    for k in range(3):
        columns.append(np.concatenate([p[k] for p in parts]))
    return marks, (docs, keys, *columns)


def repeated_anchors(tasks: int):
    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, records = collect_packed(batches, False)
        if records is not None:
            docs, keys, row, place, h = records
            order = np.argsort(h)
            h = h[order]
            same = h[1:] == h[:-1]
            hit = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
            marks.append((docs[row[hit]], keys[row[hit]], place[hit].astype(np.int64)))
        yield from marks_by_owner(marks, tasks, TaskContext.get().partitionId())

    return repeated


def earliest(docs: np.ndarray, place: np.ndarray, *hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Records in order of (hash, document, place); for each, whether it is the first of its hash, and the first's document and place."""
    order = np.lexsort((place, docs, *hashes))
    new = np.ones(len(order), bool)
    new[1:] = np.any([h[order][1:] != h[order][:-1] for h in hashes], axis=0)
    first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    return order, new, docs[first], place[first]


def candidate_runs(batch: pa.RecordBatch, kind: Kind, n: np.ndarray, first: np.ndarray, starts: int, base: int) -> np.ndarray:
    """Starts, among the symbols of a batch, of the runs that hold a repeated anchor at a place of the cover."""
    near = np.zeros(starts + 1, np.int32)
    for i, packed_places in enumerate(A.column(batch, "places").to_pylist()):
        if n[i] < kind.width:
            continue
        place = unpack_places(np.array([len(packed_places) // 4]), packed_places) - base
        place = place[(place >= 0) & (place < n[i])]
        np.add.at(near, first[i] + np.clip(place - kind.modulus + 1, 0, n[i] - kind.width), 1)
        np.add.at(near, first[i] + np.clip(place, -1, n[i] - kind.width) + 1, -1)
    return np.flatnonzero(np.cumsum(near[:-1]) > 0)


def least_of(hashes: np.ndarray, window: int) -> np.ndarray:
    """The least of each `window` hashes in a row, by doubling."""
    size = 1
    while size < window:
        step = min(size, window - size)
        hashes = np.minimum(hashes[:-step], hashes[step:])
        size += step
    return hashes


def stretch_bytes(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    before = np.cumsum(size) - size
    return data[np.repeat(at - before, size) + np.arange(size.sum())]


def send_stretches(kind: Kind, tasks: int):
    """Runs as stretches of text: consecutive runs whose least gram has one owner go there together. Of equal stretches
    a task sends the earliest and marks the others."""

    def packed(g: Gathered, turn: int) -> Iterator[pa.RecordBatch]:
        texts, g.texts = np.concatenate(g.texts), []
        docs, keys, row, place, runs, to, h = g.take()
        size = runs + kind.width - 1
        begin = np.cumsum(size) - size
        order, new, first_doc, first_place = earliest(docs[row], place, h, runs)
        doc = docs[row][order]
        later = (doc > first_doc) | ((place[order] > first_place) if kind.within else False)
        again = np.sort(order[later])
        if len(again):
            each = np.repeat(again, runs[again])
            step = np.arange(len(each)) - np.repeat(np.cumsum(runs[again]) - runs[again], runs[again])
            d, k, r, p = sorted_marks(docs[row[each]], keys[row[each]], place[each] + step)
            yield packed_batch([packed_row(turn % tasks, 0, d, k, r, p)])
        sent = np.sort(order[~later])
        by = np.argsort(to[sent], kind="stable")
        edges = np.searchsorted(to[sent][by], np.arange(tasks + 1))
        rows = []
        for b in np.flatnonzero(np.diff(edges)).tolist():
            mine = sent[by[edges[b] : edges[b + 1]]]
            raw = A.blob(runs[mine].astype(np.uint32)) + A.blob(stretch_bytes(texts, begin[mine], size[mine]))
            rows.append(packed_row(b, 1, docs, keys, row[mine], place[mine], raw))
        yield packed_batch(rows)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, turn = Gathered(), 0
        g.texts = []
        for batch, symbols, first, base in segments(batches, kind):
            n, starts = np.diff(first), len(symbols) - kind.width + 1
            at = candidate_runs(batch, kind, n, first, starts, base) if starts > 0 else np.empty(0, np.int64)
            if not len(at):
                continue
            to = owner(A.scramble(least_of(A.rolling(symbols, kind.gram), kind.width - kind.gram + 1), 7), tasks)[at]
            row = np.searchsorted(first, at, side="right") - 1
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1] + 1) | (to[1:] != to[:-1]) | (row[1:] != row[:-1])
            begin = np.flatnonzero(new)
            runs = np.diff(np.append(begin, len(at)))
            stored = kind.read(batch)[0][base : base + len(symbols)] if base or batch.num_rows == 1 else kind.read(batch)[0]
            with np.errstate(over="ignore"):
                whole = np.add.reduceat(A.rolling(symbols, kind.width)[at] * A.scramble((np.arange(len(at)) - np.repeat(begin, runs)).astype(np.uint64), 6), begin)
            g.add(batch, row[begin], at[begin] - first[row[begin]] + base, runs, to[begin], whole)
            g.texts.append(stretch_bytes(stored, at[begin], runs + kind.width - 1))
            if sum(map(len, g.texts)) >= 4 * kind.flush:
                yield from packed(g, turn)
                turn += 7
        if g.size:
            yield from packed(g, turn)

    return send


def collect_stretches(batches: Iterator[pa.RecordBatch], kind: Kind) -> tuple[list[tuple[np.ndarray, ...]], tuple[np.ndarray, ...] | None]:
    """As `collect_packed`, a record per run: stretches are hashed here."""
    marks, tables, parts, rows = [], [], [], 0
    for batch in batches:
        for _, what, docs, keys, counts, places, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            counts = np.frombuffer(counts, np.uint32).astype(np.int64)
            docs, keys, place = np.frombuffer(docs, np.int64), np.frombuffer(keys, np.int64), unpack_places(counts, places)
            if what == 0:
                marks.append((np.repeat(docs, counts), np.repeat(keys, counts), place))
                continue
            runs = np.frombuffer(raw, np.uint32, len(place)).astype(np.int64)
            hashes = A.rolling(kind.widen(np.frombuffer(raw, np.uint8, offset=4 * len(place))), kind.width)
            size = runs + kind.width - 1
            step = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
            tables.append((docs, keys))
            parts.append((np.repeat(np.repeat(np.arange(rows, rows + len(docs), dtype=np.uint32), counts), runs), (np.repeat(place, runs) + step).astype(np.uint32),
                          hashes[np.repeat(np.cumsum(size) - size, runs) + step]))
            rows += len(docs)
    if not parts:
        return marks, None
    docs, keys = (np.concatenate(c) for c in zip(*tables, strict=True))
    return marks, (docs, keys, *[np.concatenate([p[k] for p in parts]) for k in range(3)])


def send_runs(kind: Kind, tasks: int):
    def packed(g: Gathered, turn: int) -> Iterator[pa.RecordBatch]:
        docs, keys, row, place, high, low = g.take()
        order, new, first_doc, first_place = earliest(docs[row], place, low, high)
        doc = docs[row][order]
        later = (doc > first_doc) | ((place[order] > first_place) if kind.within else False)
        again = np.sort(order[later])
        if len(again):
            yield packed_batch([packed_row(turn % tasks, 0, docs, keys, row[again], place[again])])
        sent = np.sort(order[~later])
        to = owner(high[sent], tasks)
        by = np.argsort(to, kind="stable")
        edges = np.searchsorted(to[by], np.arange(tasks + 1))
        rows = []
        for b in np.flatnonzero(np.diff(edges)).tolist():
            mine = sent[by[edges[b] : edges[b + 1]]]
            rows.append(packed_row(b, 1, docs, keys, row[mine], place[mine], A.blob(low[mine])))
        yield packed_batch(rows)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, turn = Gathered(), 0
        for batch, symbols, first, base in segments(batches, kind):
            n, starts = np.diff(first), len(symbols) - kind.width + 1
            if starts <= 0:
                continue
            at = candidate_runs(batch, kind, n, first, starts, base)
            if not len(at):
                continue
            row = np.searchsorted(first, at, side="right") - 1
            g.add(batch, row, at - first[row] + base, A.rolling(symbols, kind.width)[at], A.rolling(A.scramble(symbols, 5), kind.width)[at])
            if g.size >= kind.flush:
                yield from packed(g, turn)
                turn += 7
        if g.size:
            yield from packed(g, turn)

    return send


def later_runs(kind: Kind, tasks: int):
    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, records = collect_stretches(batches, kind) if kind.gram else collect_packed(batches, True)
        if records is not None:
            docs, keys, row, place, h = records
            order = np.argsort(h)
            h = h[order]
            new = np.concatenate([[True], h[1:] != h[:-1]])
            del h
            rank = np.unique(docs, return_inverse=True)[1].astype(np.uint64)
            when = ((rank[row] << np.uint64(32)) | place)[order]
            first = np.repeat(np.minimum.reduceat(when, np.flatnonzero(new)), np.diff(np.append(np.flatnonzero(new), len(new))))
            hit = when > first if kind.within else (when >> np.uint64(32)) > (first >> np.uint64(32))
            del when, first
            hit = order[hit]
            marks.append((docs[row[hit]], keys[row[hit]], place[hit].astype(np.int64)))
        yield from marks_by_owner(marks, tasks, TaskContext.get().partitionId())

    return later


def mark_repeats(docs: DataFrame, kind: Kind) -> DataFrame:
    """doc_id, key, whole, places: for documents with repeated runs the packed starts of those runs; `whole` for those
    whose text an earlier document has. `docs` has doc_id, text and key, a hash of the text; a NULL doc_id takes no part."""
    assert is_cover(kind.cover, kind.modulus)
    tasks = 2 * partitions(docs.sparkSession)
    rows = docs.where("doc_id is not null").select("doc_id", "key", F.coalesce("text", F.lit("")).alias("text"))
    texts = rows.select("doc_id", "key", F.xxhash64(F.lit(17), "text").alias("key2"), F.octet_length("text").alias("n"))
    firsts = texts.groupBy("key", "key2", "n").agg(F.min("doc_id").alias("first"))
    copies = texts.join(firsts, ["key", "key2", "n"]).where(F.col("doc_id") > F.col("first")).select("doc_id", "key").distinct()
    to_owner = lambda packed: packed.repartitionById(tasks, "bucket")
    marks = lambda packed: to_owner(to_owner(packed).mapInArrow(A.tidy(passed_on(tasks)), PACKED)).mapInArrow(A.tidy(marked_documents), MARKED)
    near = keep(lambda: marks(to_owner(rows.mapInArrow(A.tidy(send_anchors(kind, tasks)), PACKED)).mapInArrow(A.tidy(repeated_anchors(tasks)), PACKED)), "anchors")
    of_firsts = near.join(firsts.select(F.col("first").alias("doc_id"), "key"), ["doc_id", "key"])
    around = lambda: rows.join(of_firsts.hint("shuffle_hash"), ["doc_id", "key"])
    send = send_stretches if kind.gram else send_runs
    later = lambda: marks(to_owner(around().mapInArrow(A.tidy(send(kind, tasks)), PACKED)).mapInArrow(A.tidy(later_runs(kind, tasks)), PACKED))
    return keep(lambda: later().select("doc_id", "key", F.lit(False).alias("whole"), "places").unionByName(
        copies.select("doc_id", "key", F.lit(True).alias("whole"), F.lit(None).cast("binary").alias("places"))), "marks")


def covered(n: int, whole: bool, places: bytes | None, width: int) -> np.ndarray:
    """Which of n symbols a marked run covers."""
    if whole and n >= width:
        return np.ones(n, bool)
    if not places:
        return np.zeros(n, bool)
    edge = np.zeros(n + 1, np.int64)
    at = unpack_places(np.array([len(places) // 4]), places)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return np.cumsum(edge[:-1]) > 0


def with_marks(docs: DataFrame, kind: Kind) -> DataFrame:
    """row (all columns of `docs`, the text among them), whole, places."""
    keyed = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))
    marks = mark_repeats(keyed.select("doc_id", "key", F.col("row.text").alias("text")), kind)
    return keyed.join(marks.hint("shuffle_hash"), ["doc_id", "key"], "left").select("row", "whole", "places")


def marked_rows(batches: Iterator[pa.RecordBatch], size: int = 2_000_000) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of `with_marks` and their texts."""
    for batch in batches:
        texts = A.column(batch, "row").field("text")
        for start, rows in A.sliced(texts, size):
            yield batch.slice(start, rows), texts.slice(start, rows)
