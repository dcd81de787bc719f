"""Corpus-wide sums of a vector of fixed length: every task adds up its own documents and hands on one vector in blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from intentspark.llm import arrays as A
from intentspark.llm.common import partitions

BLOCK = 2048


def corpus_sum(docs: DataFrame, length: int, add: Callable[[pa.RecordBatch, np.ndarray], None], size: int = 2_000_000) -> np.ndarray:
    """The sum over all documents of what `add(batch, vector)` adds to an int64 vector of `length`, exact in any order.
    A batch holds about `size` bytes of text.

    `length` is a parameter of the caller, not of the data: it bounds what a task sends and what comes to the driver."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(-(-length // BLOCK) * BLOCK, np.int64)
        for batch in A.pieces(batches, size=size):
            add(batch, vector)
        blocks = vector.reshape(-1, BLOCK)
        for i in np.flatnonzero(blocks.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([A.blob(blocks[i])], pa.binary())], ["block", "part"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(A.column(batch, "block").to_pylist(), A.column(batch, "part").to_pylist(), strict=True):
                sums.setdefault(i, np.zeros(BLOCK, np.int64))
                sums[i] += np.frombuffer(part, np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([A.blob(v) for v in sums.values()], pa.binary())], ["block", "part"])

    schema = "block int, part binary"
    out = np.zeros(-(-length // BLOCK) * BLOCK, np.int64)
    for row in docs.mapInArrow(A.tidy(each), schema).repartitionById(partitions(docs.sparkSession), "block").mapInArrow(A.tidy(total), schema).collect():
        out[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = np.frombuffer(row["part"], np.int64)
    return out[:length]
