"""N-gram Jaccard join by chosen paths, on sets of five-word shingles.

Every different set has a signature of min-wise hashes. A run deals the sets to buckets by a few chosen signature places
and their values; a bucket of more than `SMALL` sets is split again by places chosen for that bucket, down to `DEPTH`.
Small buckets and what is left of the large ones (sets so alike that no place splits them) are compared all with all on
8-bit signatures, the latter in blocks. A bucket gives a spanning forest of its graph of alike sets, not pairs. Runs with
other places repeat until the chance that a pair at the threshold meets in none falls below 1 - `RECALL`.

Components of these links hold all candidate pairs. Within a component every pair is verified on the whole sets, blocks of
`BLOCK` against blocks, by counts of shared shingles; a set's links are counted, and only the links of a spanning forest
are handed on, whose components are the classes.

Defined results: texts with one set of shingles are one set (NULL is empty, fewer than five words are one shingle, all
texts without words are one set); a row with a NULL doc_id is in no class and links to nothing; rows that repeat a doc_id
are each in the class of their text; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentspark.llm import arrays as A
from intentspark.llm.common import keep, partitions
from intentspark.llm.components import components

WORDS, SIMILARITY = 5, 0.8
PLACES, CHOSEN, SMALL, DEPTH, BLOCK, RECALL = 64, 2, 256, 3, 512, 0.9999
#: Places of 64 that agree at least: 4 standard deviations below what a similarity of 0.8 gives.
AGREE = 38
LINKS = "a binary, b binary"


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The different shingle hashes of all texts, ascending within each text, and the offsets of each text."""
    data, offsets = A.as_bytes(texts)
    starts, ends, first = A.word_bounds(data, offsets)
    words = A.word_hashes(data, starts, ends)
    n_words = np.diff(first)
    n = np.maximum(n_words - WORDS + 1, (n_words > 0).astype(np.int64))
    text = np.repeat(np.arange(len(n)), n)
    at = np.repeat(first[:-1] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    hashed = A.scramble(words[at], 1)
    for k in range(1, WORDS):
        inside = at + k < first[1:][text]
        hashed = A.joined(hashed, np.where(inside, words[np.minimum(at + k, max(0, len(words) - 1))], np.uint64(k)) if len(at) else hashed, k)
    order = np.lexsort((hashed, text))
    text, hashed = text[order], hashed[order]
    new = np.ones(len(order), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashed[1:] != hashed[:-1])
    return hashed[new], np.searchsorted(text[new], np.arange(len(n) + 1))


def set_ids(hashes: np.ndarray, first: np.ndarray) -> list[bytes]:
    """16 bytes for each set, the same for equal sets."""
    rows = np.flatnonzero(np.diff(first))
    out = np.zeros((len(first) - 1, 2), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(2 if len(rows) else 0):
            out[rows, k] = A.scramble(np.add.reduceat(A.scramble(hashes, 30 + k), first[:-1][rows]), 40)
    return [r.tobytes() for r in out]


def signatures(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(n, PLACES) 16-bit min-wise hashes."""
    out = np.zeros((len(first) - 1, PLACES), np.uint16)
    rows = np.flatnonzero(np.diff(first))
    factors = A.scramble(np.arange(PLACES, dtype=np.uint64), 50) | np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(PLACES if len(rows) else 0):
            out[rows, k] = (A.scramble(np.minimum.reduceat(hashes * factors[k], first[:-1][rows]), 51) >> np.uint64(48)).astype(np.uint16)
    return out


def embed(docs: DataFrame) -> DataFrame:
    """doc_id, rec (the set's id), signature of every row with a doc_id."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.pieces(batches, size=1_000_000):
            hashes, first = shingles(A.column(batch, "text"))
            marks = signatures(hashes, first)
            yield pa.RecordBatch.from_arrays([A.column(batch, "doc_id"), pa.array(set_ids(hashes, first), pa.binary()), pa.array([m.tobytes() for m in marks], pa.binary())], ["doc_id", "rec", "signature"])

    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(A.tidy(each), "doc_id long, rec binary, signature binary")


def child_paths(paths: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """(n, CHOSEN) buckets: of each row's path, places chosen by the path, with the row's values there."""
    out = np.empty((len(paths), CHOSEN), np.uint64)
    for c in range(CHOSEN):
        place = (A.scramble(paths, 60 + c) % np.uint64(PLACES)).astype(np.int64)
        value = marks[np.arange(len(paths)), place].astype(np.uint64)
        out[:, c] = A.joined(A.scramble(paths, 70), (place.astype(np.uint64) << np.uint64(16)) | value, 3)
    return out


def split(rows: DataFrame) -> DataFrame:
    """(path, rec, signature) -> a row in each of the chosen buckets below its path."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 20_000):
                part = batch.slice(a, 20_000)
                marks = np.frombuffer(b"".join(A.column(part, "signature").to_pylist()), np.uint16).reshape(-1, PLACES)
                below = child_paths(A.column(part, "path").to_numpy().view(np.uint64), marks)
                for c in range(CHOSEN):
                    yield pa.RecordBatch.from_arrays([pa.array(below[:, c].view(np.int64)), A.column(part, "rec"), A.column(part, "signature")], ["path", "rec", "signature"])

    return rows.mapInArrow(A.tidy(each), "path long, rec binary, signature binary")


def alike(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """(n, m) whether rows agree in `AGREE` places at least."""
    if len(left) * len(right) <= 1024:
        return (left[:, None] == right[None]).sum(axis=2) >= AGREE
    agree = np.zeros((len(left), len(right)), np.uint8)
    for k in range(left.shape[1]):
        agree += left[:, k, None] == right[None, :, k]
    return agree >= AGREE


def across(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between two blocks, one for each pair of groups that the blocks form by themselves and that have like rows."""
    a, b = np.nonzero(alike(left, right))
    seen = np.unique(np.column_stack([groups(left)[a], groups(right)[b]]), axis=0)
    return seen[:, 0], seen[:, 1]


def groups(marks: np.ndarray) -> np.ndarray:
    """For each row the first row of its group."""
    out = np.arange(len(marks))
    top, node = forest(*np.nonzero(np.triu(alike(marks, marks), 1)), len(marks))
    out[node] = top
    return out


def link_bucket(recs: list[bytes], marks: np.ndarray, side: np.ndarray | None = None) -> tuple[list[bytes], list[bytes]]:
    """Links of one bucket (a forest, at most one a row), or between the two sides of a pair of blocks."""
    if side is None or not side.any():
        a, b = forest(*np.nonzero(np.triu(alike(marks, marks), 1)), len(recs))
    else:
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        i, j = across(marks[left], marks[right])
        a, b = left[i], right[j]
    return [recs[i] for i in a.tolist()], [recs[i] for i in b.tolist()]


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(root, node) for each node that the links a-b connect to a lesser one."""
    root = np.arange(n)
    while len(a):
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (before == root).all() and (root[a] == root[b]).all():
            break
    node = np.flatnonzero(root != np.arange(n))
    return root[node], node


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key in turn, from batches in the order of the keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows - 1, bool)
        for k in keys:
            v = A.column(batch, k).to_numpy(zero_copy_only=False)
            change |= v[1:] != v[:-1]
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            part = batch.slice(a, b - a)
            if held and any(A.column(held[-1], k)[0].as_py() != A.column(part, k)[0].as_py() for k in keys):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def short_marks(signature: list[bytes]) -> np.ndarray:
    return (np.frombuffer(b"".join(signature), np.uint16).reshape(-1, PLACES) & 0xFF).astype(np.uint8)


def compare_small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the buckets of a partition in order of path."""
    out_a: list[bytes] = []
    out_b: list[bytes] = []
    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([held, t]).combine_chunks() if held is not None else t
        path = t["path"].to_numpy()
        last = int(np.searchsorted(path[::-1] != path[-1], True)) if len(path) else 0
        done, held = t.slice(0, len(path) - last), t.slice(len(path) - last)
        compare_paths(done, out_a, out_b)
        if out_a:
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.binary()), pa.array(out_b, pa.binary())], ["a", "b"])
            out_a, out_b = [], []
    if held is not None:
        compare_paths(held, out_a, out_b)
        if out_a:
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.binary()), pa.array(out_b, pa.binary())], ["a", "b"])


def compare_paths(t: pa.Table, out_a: list[bytes], out_b: list[bytes]) -> None:
    path = t["path"].to_numpy()
    edges = np.concatenate([[0], np.flatnonzero(np.diff(path)) + 1, [len(path)]]) if len(path) else np.zeros(1, np.int64)
    for i in np.flatnonzero(np.diff(edges) > 1).tolist():
        part = t.slice(edges[i], edges[i + 1] - edges[i])
        a, b = link_bucket(part["rec"].to_pylist(), short_marks(part["signature"].to_pylist()))
        out_a += a
        out_b += b


def compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in grouped(batches, ["path", "i", "j"]):
        a, b = link_bucket(part["rec"].to_pylist(), short_marks(part["signature"].to_pylist()), part["side"].to_numpy())
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def in_block_pairs(rows: DataFrame, group: str, size: str, block: int) -> DataFrame:
    """Each row once for every pair (i <= j) of blocks of its group that has its own block; `side` 1 is block j of i < j.

    A group of n rows has n / block blocks, so a row is copied as many times: the work of brute force, block by block."""
    blocks = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64("rec", F.lit(5)), F.col("blocks")).cast("int")
    dealt = rows.withColumn("blocks", blocks).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other"), "side": (F.col("own") > F.col("other")).cast("int")}).drop("blocks", "own", "other")


def runs_needed(recall: float = RECALL, similarity: float = SIMILARITY) -> int:
    """Runs until a pair at the threshold meets in one of them with probability `recall`, at the full depth."""
    meets = 1.0
    for _ in range(DEPTH):
        meets = 1 - (1 - similarity * meets) ** CHOSEN
    runs, missed = 0, 1.0
    while missed > 1 - recall:
        runs, missed = runs + 1, missed * (1 - meets)
    return runs


def candidate_links(recs: DataFrame) -> DataFrame:
    """(a, b): links between sets whose components hold every pair of like sets. `recs` has rec and signature."""
    n = partitions(recs.sparkSession)
    rows = recs.select(F.explode(F.sequence(F.lit(1).cast("long"), F.lit(runs_needed()).cast("long"))).alias("path"), "rec", "signature")
    links = None
    for depth in range(DEPTH):
        rows = keep(lambda rows=rows: split(rows), "paths")
        sizes = keep(lambda rows=rows: rows.groupBy("path").count().where(F.col("count") > SMALL), "sizes")
        small = rows.join(sizes.select("path"), "path", "left_anti").repartition(n, "path").sortWithinPartitions("path", "rec").mapInArrow(A.tidy(compare_small), LINKS)
        links = small if links is None else links.unionByName(small)
        rows = rows.join(sizes, "path")
        if sizes.isEmpty():
            return links
        if depth + 1 < DEPTH:
            rows = rows.drop("count")
    dealt = in_block_pairs(rows, "path", "count", BLOCK).select("path", "i", "j", "side", "rec", "signature")
    return links.unionByName(dealt.repartition(n, "path", "i", "j").sortWithinPartitions("path", "i", "j", "rec").mapInArrow(A.tidy(compare_blocks), LINKS))


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets share."""
    n, sizes = len(sets), np.array([len(s) for s in sets])
    _, code, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row, common = np.repeat(np.arange(n), sizes), seen[code] > 1
    number = np.cumsum(seen > 1) - 1
    row, code = row[common], number[code[common]]
    out = np.zeros((n, n), np.float32)
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    width = 2048
    edges = np.searchsorted(code, np.arange(0, (code[-1] if len(code) else 0) + width + 1, width))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        if b > a:
            has = np.zeros((n, width), np.float32)
            has[row[a:b], code[a:b] - k * width] = 1
            out += has @ has.T
    return out


def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For pairs of blocks with their texts: each set's number of links there, and a spanning forest's links."""
    for part in grouped(batches, ["root", "i", "j"]):
        recs, side = part["rec"].to_pylist(), part["side"].to_numpy()
        hashes, first = shingles(part["text"].combine_chunks())
        sets = [hashes[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        sizes = np.diff(first).astype(np.float64)
        both = shared_counts(sets)
        like = both >= SIMILARITY * (sizes[:, None] + sizes[None] - both) - 1e-6
        np.fill_diagonal(like, False)
        if side.any():
            like &= side[:, None] != side[None]
        a, b = np.nonzero(np.triu(like))
        top, node = forest(a, b, len(recs))
        up = dict(zip(node.tolist(), top.tolist(), strict=True))
        counts = like.sum(axis=1)
        use = np.flatnonzero(counts)
        if len(use):
            yield pa.RecordBatch.from_arrays([pa.array([recs[i] for i in use], pa.binary()), pa.array(counts[use], pa.int64()), pa.array([recs[up.get(i, i)] for i in use.tolist()], pa.binary())], ["rec", "n_links", "top"])


def link_documents(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (the least doc_id of the class), n_links (other sets like the document's), n_copies (documents with
    its set, itself included). One row per row of `docs`."""
    n = partitions(docs.sparkSession)
    placed = keep(lambda: embed(docs), "embedded")
    recs = keep(lambda: placed.groupBy("rec").agg(F.min("doc_id").alias("first"), F.count("*").alias("n_copies"), F.first("signature").alias("signature")), "sets")
    near = components(candidate_links(recs.select("rec", "signature")))
    sized = near.join(near.groupBy("root").agg(F.count("*").alias("size")), "root").join(recs.select(F.col("rec").alias("node"), F.col("first").alias("doc_id")), "node")
    texts = docs.where("doc_id is not null").select("doc_id", "text").join(sized.hint("shuffle_hash"), "doc_id")
    named = texts.withColumnRenamed("node", "rec").mapInArrow(A.tidy(_own_set), "root binary, rec binary, size long, text string")
    one = named.dropDuplicates(["root", "rec"]) if _repeats_ids(placed) else named
    dealt = in_block_pairs(one, "root", "size", BLOCK).select("root", "i", "j", "side", "rec", "text")
    checked = keep(lambda: dealt.repartition(n, "root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(A.tidy(verify), "rec binary, n_links long, top binary"), "links")
    counts = checked.groupBy("rec").agg(F.sum("n_links").alias("n_links"))
    classes = components(checked.select(F.col("rec").alias("a"), F.col("top").alias("b")))
    known = recs.select("rec", "first", "n_copies").join(counts, "rec", "left").join(classes.withColumnRenamed("node", "rec"), "rec", "left").withColumn("root", F.coalesce("root", "rec"))
    least = known.groupBy("root").agg(F.min("first").alias("class_id"))
    result = known.join(least, "root").select("rec", "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "n_copies")
    out = placed.select("doc_id", "rec").join(result, "rec").select("doc_id", "class_id", "n_links", "n_copies")
    unnamed = docs.where("doc_id is null").select("doc_id", F.lit(None).cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("n_copies"))
    return out.unionByName(unnamed)


def _own_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Only rows whose text has the set they are joined with; a doc_id may stand for several texts."""
    for batch in A.pieces(batches, size=1_000_000):
        ids = set_ids(*shingles(A.column(batch, "text")))
        own = pa.array([a == b for a, b in zip(ids, A.column(batch, "rec").to_pylist(), strict=True)])
        yield pa.RecordBatch.from_arrays([A.column(batch, c).filter(own) for c in ("root", "rec", "size", "text")], ["root", "rec", "size", "text"])


def _repeats_ids(placed: DataFrame) -> bool:
    return not placed.groupBy("doc_id").count().where("count > 1").isEmpty()


def one_of_each(docs: DataFrame) -> DataFrame:
    """The first document of each class (rows with a NULL doc_id all stay; of rows that repeat one, the least text)."""
    firsts = link_documents(docs).where("class_id = doc_id or doc_id is null").select("doc_id").where("doc_id is not null").distinct()
    kept = docs.join(firsts, "doc_id", "left_semi")
    if not docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        rest = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
        kept = kept.groupBy("doc_id").agg(F.min(F.struct("text", *rest)).alias("r")).select("doc_id", "r.*").select(*docs.columns)
    return kept.unionByName(docs.where("doc_id is null"))
