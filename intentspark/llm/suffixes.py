"""Suffix dedup over bytes by a difference-cover sample of suffixes: each byte covered by a string of 100 bytes that also
starts earlier (in a smaller doc_id, or before in the same document) is removed.

The difference-cover construction sorts the suffixes at the places of a cover, names them by rank, goes on with the names
and merges the other suffixes. Two things follow from asking for common prefixes of 100 bytes only. The recursion may end
as soon as a name stands for 100 bytes; and a suffix matters only if its prefix occurs twice, which the sample shows: of
two equal prefixes some shift below the modulus has both places in the cover. So with modulus 57 and the cover of eight
places (three sampled suffixes in 21 bytes instead of the two in three of triples) the sampled suffixes are named by their
first 44 bytes, the names sorted, and those without a twin dropped; the suffixes within reach of a name that has one are
named by their first 100 bytes, sorted with the places (document, start), and neighbours with equal names compared: all
but the first of each are repeats. Names are hashes, so the order among different prefixes is arbitrary; only equality is
used. See `repeats` for the distribution. README tells why the full suffix array isn't built.

Defined results: NULL text is empty; a document with a NULL doc_id is kept whole and takes no part; rows of one doc_id are
one document, earlier starts count by place; an empty table gives no rows; other columns pass through `remove_repeats` in `row`, whatever
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

TABLE = A.scramble(np.arange(256, dtype=np.uint64), 9)


def read_bytes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return A.as_bytes(A.column(batch, "text"))


KIND = repeats.Kind(width=100, modulus=57, cover=(0, 1, 3, 13, 32, 36, 43, 52), within=True, read=read_bytes, widen=lambda data: TABLE[data], gram=16)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in repeats.marked_rows(batches):
        data, offsets = A.as_bytes(texts)
        kept, removed, spans = [], [], []
        for i, (whole, places) in enumerate(zip(A.column(batch, "whole").to_pylist(), A.column(batch, "places").to_pylist(), strict=True)):
            gone = repeats.covered(int(offsets[i + 1] - offsets[i]), bool(whole), places, KIND.width)
            kept.append(data[offsets[i] : offsets[i + 1]][~gone].tobytes())
            removed.append(int(gone.sum()))
            spans.append(int((np.diff(gone.astype(np.int8), prepend=0) > 0).sum()))
        yield pa.RecordBatch.from_arrays([A.column(batch, "row"), pa.array(np.diff(offsets), pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                                         ["row", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """n_bytes, n_removed, n_spans and kept, the remaining bytes (not always valid UTF-8), beside `row`, all columns of `docs`."""
    return repeats.with_marks(docs, KIND).mapInArrow(A.tidy(_cut), f"row {docs.schema.simpleString()}, n_bytes long, n_removed long, n_spans long, kept binary")


def as_text(cut: DataFrame) -> DataFrame:
    """`kept` as text: bytes of a character that was cut are left out."""

    def text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = pa.array([b.decode("utf-8", "ignore") for b in A.column(batch, "kept").to_pylist()], pa.string())
            yield batch.set_column(batch.schema.get_field_index("kept"), "kept", kept)

    fields = ", ".join(f"{f.name} {'string' if f.name == 'kept' else f.dataType.simpleString()}" for f in cut.schema)
    return cut.mapInArrow(A.tidy(text), fields)


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs.select("doc_id", "text")).select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
