"""SimHash document fingerprints: hashes of five-word terms, weighted by their counts, vote on 128 signed bits.

`with_next` deals documents to ranges of doc_id, so that a document and the next one meet in one task: the cut points are
approximate quantiles (one number per task), and each range also gets a copy of the following range's first document.
`near_pairs` finds all pairs of different fingerprints within a Hamming radius r: the bits are cut into r + 1 blocks, of
which at least one must agree; each block's table is joined on it, and a pair counts in the first block that agrees.

Defined results: NULL text is empty; a text of fewer than five words is one term; a text without words has fingerprint 0;
a NULL doc_id comes first in the order; rows with one doc_id follow by text; the document after the last is the first; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentspark.llm import arrays as A
from intentspark.llm.common import keep, partitions

BITS, TERM_WORDS, RADIUS = 128, 5, 3
LOWEST = -(2**63)


def fingerprints(texts: pa.Array) -> np.ndarray:
    """(n, BITS / 8) bytes: bit b is set where the terms' hashes have more ones than zeros in b."""
    out = np.zeros((len(texts), BITS // 8), np.uint8)
    data, offsets = A.as_bytes(texts)
    size = max(1, 1_000_000)
    group = offsets[:-1] // size
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        part, local = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        starts, ends, first = A.word_bounds(part, local)
        words = A.word_hashes(part, starts, ends)
        n_words = np.diff(first)
        terms = np.maximum(n_words - TERM_WORDS + 1, (n_words > 0).astype(np.int64))
        if not terms.sum():
            continue
        at = np.repeat(first[:-1] - (np.cumsum(terms) - terms), terms) + np.arange(terms.sum())
        last = np.repeat(first[1:], terms)
        hashed = A.scramble(words[at], 1)
        for k in range(1, TERM_WORDS):
            inside = at + k < last
            hashed = A.joined(hashed, np.where(inside, words[np.minimum(at + k, len(words) - 1)], np.uint64(k)), k)
        rows = np.flatnonzero(terms)
        begin = (np.cumsum(terms) - terms)[rows]
        for lane in range(BITS // 64):
            bits = np.unpackbits(A.scramble(hashed, 10 + lane).view(np.uint8).reshape(-1, 8), axis=1)
            votes = np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
            out[a + rows, lane * 8 : lane * 8 + 8] = np.packbits(2 * votes > terms[rows][:, None], axis=1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits, 0 to 1."""
    return 1.0 - np.unpackbits(a ^ b, axis=1).sum(axis=1) / BITS


def edited(text: str, following: str) -> str:
    """The last floor(n/2) code points replaced by as many (or all) of the next text's first."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, guest, sorted: every row is followed by the next document; a partition's last row is a guest."""
    spark = docs.sparkSession
    n = partitions(spark)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(LOWEST)).cast("long").alias("place"))
    cuts = sorted(set(map(int, rows.approxQuantile("place", [i / n for i in range(1, n)], 0.1 / n)))) if n > 1 else []

    @F.pandas_udf("int")
    def range_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(cuts, np.int64), place.to_numpy(), side="right").astype(np.int32))

    dealt = rows.withColumn("range", range_of("place") if cuts else F.lit(0)).withColumn("guest", F.lit(0))
    firsts = sorted((r["range"], r["first"]) for r in rows.select("place").withColumn("range", range_of("place") if cuts else F.lit(0)).groupBy("range").agg(F.min("place").alias("first")).collect())
    if not firsts:
        return dealt.select("doc_id", "text", "guest")
    following = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}

    @F.pandas_udf("int")
    def host_of(place: pd.Series) -> pd.Series:
        return place.map(following).astype("int32")

    guests = rows.where(F.col("place").isin(list(following))).withColumn("range", host_of("place")).withColumn("guest", F.lit(1))
    return dealt.unionByName(guests).repartitionById(len(cuts) + 1, "range").sortWithinPartitions("range", "guest", "place", "text").select("doc_id", "text", "guest", "range")


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in A.pieces(batches):
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        held = table.slice(len(table) - 1)
        texts, ids = table["text"].to_pylist(), table["doc_id"].to_pylist()
        own = table["guest"].to_numpy()[:-1] == 0
        own = np.flatnonzero(own & (np.diff(table["range"].to_numpy()) == 0))
        if not len(own):
            continue
        marks = fingerprints(pa.array(texts, pa.large_string()))
        changed = [edited(texts[i], texts[i + 1]) for i in own]
        altered = fingerprints(pa.array(changed, pa.large_string()))
        yield pa.RecordBatch.from_arrays([
            pa.array([ids[i] for i in own], pa.int64()), pa.array([len(texts[i]) for i in own], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
            pa.array([marks[i].tobytes().hex() for i in own]), pa.array([x.tobytes().hex() for x in altered]),
            pa.array(likeness(marks[own], altered)), pa.array(likeness(marks[own], marks[own + 1])),
        ], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def compare_documents(docs: DataFrame) -> DataFrame:
    """Fingerprint of every document and of its edited text, and how alike they and the next document's are."""
    return with_next(docs).mapInArrow(_compare, SCHEMA)


def near_pairs(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (a < b) of different fingerprints at most `radius` bits apart. `marked` has a hexadecimal `fingerprint`."""
    width = BITS // 4 // (radius + 1)
    blocks = [F.substring("fingerprint", 1 + i * width, width if i < radius else BITS // 4) for i in range(radius + 1)]
    words = [F.conv(F.substring("fingerprint", 1 + i * 8, 8), 16, 10).cast("long") for i in range(BITS // 32)]
    distinct = marked.select("fingerprint").distinct().select("fingerprint", F.array(*words).alias("words"), F.array(*blocks).alias("blocks"))
    posted = distinct.select("fingerprint", "words", "blocks", F.posexplode("blocks").alias("place", "block"))
    a, b = posted.alias("a"), posted.alias("b")
    apart = sum((F.bit_count(F.col("a.words")[i].bitwiseXOR(F.col("b.words")[i])) for i in range(1, BITS // 32)), F.bit_count(F.col("a.words")[0].bitwiseXOR(F.col("b.words")[0])))
    earlier = [(F.col("a.place") <= i) | (F.col("a.blocks")[i] != F.col("b.blocks")[i]) for i in range(radius)]
    meets = (F.col("a.place") == F.col("b.place")) & (F.col("a.block") == F.col("b.block")) & (F.col("a.fingerprint") < F.col("b.fingerprint")) & (apart <= radius)
    for no_earlier in earlier:
        meets = meets & no_earlier
    return a.join(b, meets).select(F.col("a.fingerprint").alias("a"), F.col("b.fingerprint").alias("b"), apart.alias("distance"))


def with_neighbours(compared: Callable[[], DataFrame], radius: int = RADIUS) -> DataFrame:
    """Adds n_within: how many other fingerprints lie within the radius of the document's."""
    done = keep(compared, "simhash")
    pairs = near_pairs(done, radius)
    counts = pairs.select(F.explode(F.array("a", "b")).alias("fingerprint")).groupBy("fingerprint").agg(F.count("*").alias("n_within"))
    return done.join(counts, "fingerprint", "left").withColumn("n_within", F.coalesce("n_within", F.lit(0)))
