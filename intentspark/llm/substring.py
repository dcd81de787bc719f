"""Substring dedup over words by difference-cover anchors: each word covered by a run of 13 words that also starts in a
document with a smaller doc_id is removed.

Anchors of seven words at the places whose residue modulo 7 is 0, 1 or 3 find the candidates; see `repeats`.

Defined results: NULL text has no words; a document with a NULL doc_id is kept whole and is nobody's earlier document; rows
of one doc_id are not earlier than each other; an empty table gives no rows; other columns pass through `remove_repeats` in `row`, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentspark.llm import arrays as A
from intentspark.llm import repeats


def read_words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = A.as_bytes(A.column(batch, "text"))
    starts, ends, first = A.word_bounds(data, offsets)
    return A.word_hashes(data, starts, ends), first


KIND = repeats.Kind(width=13, modulus=7, cover=(0, 1, 3), within=False, read=read_words, widen=lambda words: A.scramble(words, 2))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in repeats.marked_rows(batches):
        data, offsets = A.as_bytes(texts)
        starts, ends, first = A.word_bounds(data, offsets)
        kept, removed = [], []
        for i, (whole, places) in enumerate(zip(A.column(batch, "whole").to_pylist(), A.column(batch, "places").to_pylist(), strict=True)):
            gone = repeats.covered(first[i + 1] - first[i], bool(whole), places, KIND.width)
            stay = np.flatnonzero(~gone) + first[i]
            raw = data.data
            kept.append(b" ".join([bytes(raw[a:b]) for a, b in zip(starts[stay].tolist(), ends[stay].tolist(), strict=True)]))
            removed.append(int(gone.sum()))
        yield pa.RecordBatch.from_arrays([A.column(batch, "row"), pa.array(np.diff(first), pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                                         ["row", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """n_words, n_removed and kept, the remaining words joined by one space, beside `row`, all columns of `docs`."""
    return repeats.with_marks(docs, KIND).mapInArrow(_cut, f"row {docs.schema.simpleString()}, n_words long, n_removed long, kept string")


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs.select("doc_id", "text")).select("row.doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
