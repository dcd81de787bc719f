"""Periodic runs of words by Baier grouping: phase one of the suffix sorter gives the Lyndon arrays under both orders of the
words; consecutive equal Lyndon roots are extended through longest common extensions into runs.

Phase one keeps the places of a text in groups of equal Lyndon prefixes, ordered by prefix. The highest group that is left
is taken; each of its places points to the nearest place before it in a lower group; places with pointers get the group's
prefix appended as often as they are pointed to and move to a group of their own, just above the old one. At the end a
place's group is its longest Lyndon prefix: the Lyndon array, and equal groups are equal roots. Every run with at least
three full periods shows under one of the two orders as a root that stands at i, i + q and i + 2q.

A run of period q and length L >= max(6, 4q) holds max(2, 3q - 3) or more places in a row whose four words recur within q
words. Places that cannot belong to such a stretch are left out before the sorting, which loses no run (the extension goes
over the whole text); texts without repetition cost a few numpy passes. Every document is one unit of work of its task:
no shuffle, nothing is shared between documents.

Defined results: NULL and empty texts have no words and no runs; a text of any length is searched whole; rows are searched each
for itself, so repeated rows and ties of doc_id change nothing and a NULL doc_id passes; an empty table gives no rows;
other columns pass in `row`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentspark.llm import arrays as A
from intentspark.llm.common import WORD

LEAST, TIMES = 6, 4
GRAM = 4
#: How often the stretches are narrowed; what is left is searched, so fewer rounds cost time but no run.
ROUNDS = 32
RUN = "struct<start: bigint, length: bigint, period: bigint>"
RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def lyndon_groups(symbols: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For every place the length of its longest Lyndon prefix (the text's end counts as the smallest symbol) and its group:
    places of one group have the same prefix."""
    n = len(symbols)
    order = sorted(range(n), key=symbols.__getitem__)
    where, group, end_of, length, prev = [0] * n, [0] * n, [0] * n, [1] * n, [-1] * n
    start = 0
    for at, i in enumerate(order):
        where[i] = at
        if at and symbols[i] != symbols[order[at - 1]]:
            end_of[start] = at
            start = at
        group[i] = start
    if n:
        end_of[start] = n
    end = n
    while end:
        start = group[order[end - 1]]
        width = length[start]
        pointed: dict[int, int] = {}
        for i in order[start:end] if end - start == 1 else sorted(order[start:end]):
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = prev[p]
            prev[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        end = start
        by_count: dict[int, list[int]] = {}
        for p, k in pointed.items():
            by_count.setdefault(k, []).append(p)
        for k in sorted(by_count, reverse=True):
            moved = by_count[k]
            touched: dict[int, int] = {}
            for p in moved:  # to the back of its group
                g = group[p]
                if g not in touched:
                    touched[g] = end_of[g]
                back = end_of[g] - 1
                end_of[g] = back
                other, at = order[back], where[p]
                order[back], order[at] = p, other
                where[p], where[other] = back, at
            for g, old_end in touched.items():
                fresh = end_of[g]
                length[fresh] = length[g] + k * width
                end_of[fresh] = old_end
                if fresh != g:
                    for at in range(fresh, old_end):
                        group[order[at]] = fresh
    groups = np.array(group, np.int64)
    return np.array(length, np.int64)[groups] if n else groups, groups


def extension(words: np.ndarray, a: int, b: int) -> int:
    """Length of the longest common prefix of the suffixes at a and b, a < b."""
    rest, done, step = len(words) - b, 0, 16
    while done < rest:
        m = min(step, rest - done)
        same = words[a + done : a + done + m] == words[b + done : b + done + m]
        if not same.all():
            return done + int(same.argmin())
        done, step = done + m, 4 * step
    return rest


def candidate_stretches(words: np.ndarray, first: np.ndarray, gram: int = GRAM) -> list[tuple[int, int, int]]:
    """(text, from, to): parts of the texts outside of which no run of the wanted length can lie."""
    n = len(words) - gram + 1
    if n <= 0:
        return []
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    with np.errstate(over="ignore"):
        keys = A.rolling(A.scramble(words.astype(np.uint64), 31), gram) + A.scramble(text[:n].astype(np.uint64), 32)
    order = np.argsort(keys, kind="stable")
    again = np.flatnonzero(keys[order][1:] == keys[order][:-1])
    distance = np.full(n, len(words), np.int64)
    distance[order[again]] = order[again + 1] - order[again]
    whole = text[gram - 1 :] == text[:n]
    near = whole & (distance < len(words))
    near[near] &= text[np.flatnonzero(near) + distance[near]] == text[:n][near]
    for _ in range(ROUNDS):
        edges = np.flatnonzero(np.diff(np.concatenate([[False], near, [False]]).astype(np.int8)))
        begin, stop = edges[::2], edges[1::2]
        size = stop - begin
        at = np.flatnonzero(near)
        keep = (distance[at] <= np.repeat((size + 3) // 3, size)) & np.repeat(size >= 2, size)
        if keep.all():
            break
        near[at[~keep]] = False
    edges = np.flatnonzero(np.diff(np.concatenate([[False], near, [False]]).astype(np.int8)))
    begin, stop = edges[::2], edges[1::2]
    out: list[tuple[int, int, int]] = []
    for a, b in zip(begin.tolist(), stop.tolist(), strict=True):
        t = int(text[a])
        end = min(int(first[t + 1]), b + (b - a + 3) // 3 + gram - 1)
        if out and out[-1][0] == t and a <= out[-1][2]:
            out[-1] = (t, out[-1][1], max(out[-1][2], end))
        else:
            out.append((t, a, end))
    return out


def runs_around(words: np.ndarray, begin: int, stop: int, least: int = LEAST, times: int = TIMES) -> set[tuple[int, int, int]]:
    """(start, length, period) of the runs of a text that have a part of three periods in words[begin:stop]."""
    part = np.unique(words[begin:stop], return_inverse=True)[1]
    found, back = set(), words[::-1]
    for ranks in (part, part.max(initial=0) - part):
        length, group = lyndon_groups(ranks.tolist())
        n, i = len(group), np.arange(len(group))
        at = i[i + 2 * length < n]
        q = length[at]
        at = at[(group[at + q] == group[at]) & (group[at + 2 * q] == group[at])]
        q = length[at]
        at = at[(at < q) | (group[np.maximum(at - q, 0)] != group[at])]
        for a, q in zip((at + begin).tolist(), length[at].tolist(), strict=True):
            right = extension(words, a, a + q)
            left = extension(back, len(words) - a - q, len(words) - a)
            if left + q + right >= max(least, times * q):
                found.add((a - left, left + q + right, q))
    return found


def find_runs(words: np.ndarray, first: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """The runs of every text, by start and period. `words` numbers the words of all texts end to end."""
    out: list[set[tuple[int, int, int]]] = [set() for _ in range(len(first) - 1)]
    for t, a, b in candidate_stretches(words, first):
        base = int(first[t])
        out[t] |= runs_around(words[base : first[t + 1]], a - base, b - base)
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period; ties: smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, stay: np.ndarray) -> list[bytes]:
    """The words of each text that stay, joined by one space."""
    line = np.full(len(data) + 1, 0x20, np.uint8)
    line[: len(data)] = data
    use = np.zeros(len(data) + 2, np.int8)
    np.add.at(use, starts[stay], 1)
    np.add.at(use, ends[stay], -1)
    use = np.cumsum(use[:-1]) > 0
    number = np.flatnonzero(stay)
    text = np.searchsorted(first, number, side="right") - 1
    more = np.zeros(len(number), bool)
    more[:-1] = text[1:] == text[:-1]
    space = ends[number[more]]
    line[space] = 0x20
    use[space] = True
    size = np.zeros(len(first), np.int64)
    np.add.at(size, text + 1, ends[number] - starts[number] + more)
    raw, edges = line[use].tobytes(), np.cumsum(size).tolist()
    return [raw[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def collapse(docs: DataFrame) -> DataFrame:
    """n_words, runs, best (the strongest run) and collapsed (each run reduced to its first period, words joined by one
    space) beside `row`, all columns of `docs` but the text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.pieces(batches):
            data, offsets = A.as_bytes(A.column(batch, "text"))
            starts, ends, first = A.word_bounds(data, offsets)
            words = A.distinct_words(data, starts, ends)[1].astype(np.int64)
            runs = find_runs(words, first)
            gone = np.zeros(len(words) + 1, np.int64)
            for base, mine in zip(first.tolist(), runs, strict=False):
                for start, length, period in mine:
                    gone[base + start + period] += 1
                    gone[base + start + length] -= 1
            kept = _joined(data, starts, ends, first, np.cumsum(gone[:-1]) == 0)
            record = lambda run: run and dict(zip(("start", "length", "period"), run, strict=True))
            yield pa.RecordBatch.from_arrays(
                [A.column(batch, "row"), pa.array(np.diff(first), pa.int64()), pa.array([[record(r) for r in rs] for rs in runs], pa.list_(RUN_TYPE)),
                 pa.array([record(strongest(rs)) for rs in runs], RUN_TYPE), pa.array(kept, pa.binary()).cast(pa.string())],
                ["row", "n_words", "runs", "best", "collapsed"])

    others = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"], F.lit(None).cast("boolean").alias("_")).alias("row"), "text")
    return others.mapInArrow(each, f"row {others.schema['row'].dataType.simpleString()}, n_words long, runs array<{RUN}>, best {RUN}, collapsed string")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the texts, chosen by the crc32 of doc_id, repeat a stretch of words to their end."""
    docs = docs.select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    fields = docs.withColumn("_h", h).withColumn("_w", F.when(F.col("_h") % 10 == 0, words)).withColumn("_n", F.size("_w").cast("long"))
    fields = fields.withColumn("_a", F.expr("if(_n > 0, (_h div 10) % _n, 0)")).withColumn("_p", F.expr("1 + (_n - _a) div (3 + (_h div 10) % 8)"))
    planted = F.array_join(F.expr("transform(sequence(0L, _n - 1), i -> element_at(_w, cast(if(i < _a, i, _a + (i - _a) % _p) + 1 as int)))"), " ")
    return fields.withColumn("text", F.when(F.col("_n") > 0, planted).otherwise(F.col("text"))).select(*docs.columns)


def digest(collapsed: DataFrame) -> DataFrame:
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[f].cast("string") for f in ("start", "length", "period")]), F.lit("\n"))))
    return collapsed.select(
        "row.doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
