"""Numpy helpers over Arrow columns: texts as bytes, words, hashes, rows of packed arrays."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15))

#: Gives what the C allocator holds unused back to the system; absent where the C library has no such call.
TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`work`, after whose last batch memory that it freed goes back to the system. Workers outlive their tasks, and the
    allocators would hold it, next to the memory of whatever runs after."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        hand_back()

    return run


def hand_back() -> None:
    pa.default_memory_pool().release_unused()
    if TRIM is not None:
        TRIM(0)


def scramble(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective mix of 64-bit values; another seed gives an independent one."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) & (2**64 - 1))
        x ^= x >> np.uint64(30)
        x *= MIX[0]
        x ^= x >> np.uint64(27)
        x *= MIX[1]
        x ^= x >> np.uint64(31)
    return x


def joined(left: np.ndarray, right: np.ndarray, seed: int) -> np.ndarray:
    """Hash of the concatenation of what two hashes stand for."""
    with np.errstate(over="ignore"):
        out = left * np.uint64((0xD6E8FEB86659FD93 + 2 * seed) & (2**64 - 1))
        out += right
        out ^= out >> np.uint64(29)
        out *= MIX[0]
        out ^= out >> np.uint64(32)
    return out


def rolling(symbols: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` symbols, by doubling: entry i covers symbols i .. i + width - 1."""
    n = len(symbols) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, have, power, size, rest = None, 0, symbols, 1, width
    while rest:
        if rest & 1:
            out = power if out is None else joined(out[: len(power) - have], power[have:], 64 + size)
            have += size
        rest >>= 1
        if rest:
            power = joined(power[:-size], power[size:], size)
            size *= 2
    return out[:n]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def as_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts (null: empty) end to end, and the n + 1 offsets."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    texts = texts.fill_null("")
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def sliced(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """(start, rows) of slices of about `size` bytes of text."""
    lengths = np.diff(as_bytes(texts)[1])
    group = (np.cumsum(lengths) - lengths) // size if len(lengths) else lengths
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(lengths)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b > a:
            yield a, b - a


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about `size` bytes of text, so that numpy's working arrays stay small."""
    for batch in batches:
        for start, rows in sliced(column(batch, text), size):
            yield batch.slice(start, rows)


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and each text's first word as offsets into them."""
    inside = ~SPACE[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | fresh[:-1]))
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    ends = np.flatnonzero(inside & (~after | fresh[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit xxh3 of every word: each different word of the piece is hashed once."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    packed = data[~SPACE[data]]
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)]).dictionary_encode()
    table = np.fromiter(map(xxhash.xxh3_64_intdigest, words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    return table[words.indices.to_numpy()]


def blob(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def distinct_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The different words and, for every word, which of them it is."""
    if not len(starts):
        return [], np.empty(0, np.int64)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[~SPACE[data]])]).dictionary_encode()
    return words.dictionary.to_pylist(), words.indices.to_numpy()
