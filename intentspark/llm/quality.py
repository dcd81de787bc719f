"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer numpy network whose
probabilities are calibrated by temperature.

A text is read as runs of letters, digits or other signs; each run gives a word (lower case, hashed to `BUCKETS`) and its
shape (kind, case, length, whether it repeats the run before). A word's vector is the sum of the sparse random index
vectors of its neighbours over all documents: exact integer sums of a fixed length. A document is the mean and the spread
of its words' normalised vectors, weighted by their rarity. The network is fitted on a bounded sample of labelled
documents (`TRAIN_ROWS`), on a seventh of which the temperature is chosen.

Defined results: NULL text is empty; empty texts get the score of the zero vector; without labels of both kinds every
score is the labels' mean (0.5 without any); repeated rows are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentspark.llm import arrays as A
from intentspark.llm.labelled import fold, training_rows
from intentspark.llm.totals import corpus_sum

BUCKETS, SHAPES, DIM, SPAN = 2**14, 1024, 32, 2
HIDDEN, EPOCHS, TRAIN_ROWS = 24, 60, 20_000
FOLDS, HELD, THRESHOLD = 5, 0, 0.3
#: Bytes of text, and words of one text, worked on at once: numpy's working arrays are some hundred times as large.
SLICE, BLOCK = 250_000, 2**16

KIND = np.full(256, 3, np.uint8)
KIND[A.SPACE] = 0
KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
KIND[48:58] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
UPPER = np.zeros(256, bool)
UPPER[65:91] = True


def index_vectors() -> np.ndarray:
    """Sparse ternary index vector of each bucket: two ones, two minus ones, from its hash."""
    out = np.zeros((BUCKETS, DIM), np.int8)
    rows = np.arange(BUCKETS, dtype=np.uint64)
    for k in range(4):
        out[np.arange(BUCKETS), (A.scramble(rows, 20 + k) % np.uint64(DIM)).astype(np.int64)] += 1 if k % 2 else -1
    return out


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all texts' words and shapes in turn, and the offsets of each text."""
    data, offsets = A.as_bytes(texts)
    kind = KIND[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    change = np.concatenate([[True], kind[1:] != kind[:-1]]) if len(data) else np.empty(0, bool)
    edges = np.flatnonzero(change | fresh[:-1])
    stops = np.append(edges[1:], len(data))
    solid = kind[edges] > 0 if len(edges) else np.empty(0, bool)
    starts, stops = edges[solid], stops[solid]
    if not len(starts):
        return np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    with np.errstate(over="ignore"):  # polynomial of the lower-case bytes, from one pass of prefix sums
        base = np.uint64(0x9E3779B97F4A7C15)
        power = np.cumprod(np.full(64, base, np.uint64))
        place = np.arange(len(data)) - _run_start(starts, len(data))
        spread = A.scramble(LOWER[data].astype(np.uint64), 3) * power[place % 64]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(spread)])
        hashed = A.scramble(sums[stops] - sums[starts], 4)
    capitals = np.concatenate([[0], np.cumsum(UPPER[data])])
    upper, length = capitals[stops] - capitals[starts], stops - starts
    case = np.where(upper == 0, 0, np.where((upper == length) & (length > 1), 2, 1))
    again = np.concatenate([[False], hashed[1:] == hashed[:-1]])
    shape = ((kind[starts].astype(np.int64) * 3 + case) * 8 + np.minimum(length, 8) - 1) * 2 + again
    out = np.empty(2 * len(starts), np.int64)
    out[0::2] = SHAPES + (hashed % np.uint64(BUCKETS - SHAPES)).astype(np.int64)
    out[1::2] = shape
    return out, 2 * np.searchsorted(starts, offsets)


def _run_start(starts: np.ndarray, n: int) -> np.ndarray:
    """For every byte the start of the run it lies in (bytes between runs: of the run before)."""
    mark = np.zeros(n, np.int64)
    mark[starts] = starts
    return np.maximum.accumulate(mark)


def count_neighbours(index: np.ndarray):
    def add_block(words: np.ndarray, text: np.ndarray, a: int, b: int, vector: np.ndarray) -> None:
        """The neighbours of words a to b; those of the words beside them are read, not counted."""
        low, high = max(0, a - SPAN), min(len(words), b + SPAN)
        own, inside = index[words[low:high]], text[low:high]
        around = np.zeros_like(own)
        for d in range(1, SPAN + 1):
            near = (inside[d:] == inside[:-d])[:, None]
            around[:-d] += own[d:] * near
            around[d:] += own[:-d] * near
        mine = words[a:b]
        order = np.argsort(mine, kind="stable")
        ids, begin = np.unique(mine[order], return_index=True)
        sums = vector[: BUCKETS * DIM].reshape(BUCKETS, DIM)
        sums[ids] += np.add.reduceat(around[a - low : b - low][order], begin, axis=0, dtype=np.int64)

    def add(batch: pa.RecordBatch, vector: np.ndarray) -> None:
        words, first = tokens(A.column(batch, "text"))
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for a in range(0, len(words), BLOCK):
            add_block(words, text, a, min(a + BLOCK, len(words)), vector)
        vector[BUCKETS * DIM : BUCKETS * (DIM + 1)] += np.bincount(words, minlength=BUCKETS)

    return add


def word_vectors(docs: DataFrame) -> np.ndarray:
    """(BUCKETS, DIM): normalised context vectors, longer for rarer words."""
    sums = corpus_sum(docs.select("text"), BUCKETS * (DIM + 1), count_neighbours(index_vectors()), SLICE)
    context, seen = sums[: BUCKETS * DIM].reshape(BUCKETS, DIM).astype(np.float64), sums[BUCKETS * DIM :]
    norm = np.sqrt((context**2).sum(axis=1))
    rarity = np.log1p(seen.sum() / np.maximum(seen, 1)) / 10
    return (context / np.maximum(norm, 1e-12)[:, None] * rarity[:, None]).astype(np.float32)


def pool(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the word vectors of each text, and its length."""
    words, first = tokens(texts)
    n = np.diff(first)
    out = np.zeros((len(texts), 2 * DIM + 1), np.float64)
    rows = np.flatnonzero(n)
    if len(rows):
        own = vectors[words]
        mean = np.add.reduceat(own, first[:-1][rows], axis=0) / n[rows][:, None]
        square = np.add.reduceat(own * own, first[:-1][rows], axis=0) / n[rows][:, None]
        out[rows, :DIM], out[rows, DIM : 2 * DIM] = mean, np.sqrt(np.maximum(0, square - mean * mean))
    out[:, -1] = np.log1p(n) / 10
    return out


class Network:
    """One hidden layer of tanh units and a logistic output, trained by Adam; `temperature` divides the output."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.temperature, self.constant = 1.0, None
        if len(np.unique(y)) < 2:
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        self.w = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        check = rng.permutation(len(x)) % 7 == 0
        check = check if len(np.unique(y[check])) == 2 and len(np.unique(y[~check])) == 2 else np.zeros(len(x), bool)
        self._fit((x[~check] - self.mean) / self.scale, y[~check], rng)
        if check.any():
            logits = self._logit((x[check] - self.mean) / self.scale)
            grid = np.exp(np.linspace(np.log(0.5), np.log(8), 60))
            loss = [np.mean(np.logaddexp(0, -np.where(y[check] == 1, logits, -logits) / t)) for t in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def _logit(self, z: np.ndarray) -> np.ndarray:
        return np.tanh(z @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3][0]

    def _fit(self, z: np.ndarray, y: np.ndarray, rng: np.random.Generator, size: int = 128, rate: float = 3e-3, decay: float = 1e-4) -> None:
        moments, squares, step = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(z))
            for a in range(0, len(z), size):
                x, t = z[order[a : a + size]], y[order[a : a + size]]
                hidden = np.tanh(x @ self.w[0] + self.w[1])
                error = (1 / (1 + np.exp(-np.clip(hidden @ self.w[2] + self.w[3][0], -50, 50))) - t) / len(t)
                back = error[:, None] * self.w[2][None] * (1 - hidden**2)
                step += 1
                for i, g in enumerate((x.T @ back + decay * self.w[0], back.sum(axis=0), hidden.T @ error + decay * self.w[2], error.sum(keepdims=True))):
                    moments[i] = 0.9 * moments[i] + 0.1 * g
                    squares[i] = 0.999 * squares[i] + 0.001 * g * g
                    self.w[i] -= rate * (moments[i] / (1 - 0.9**step)) / (np.sqrt(squares[i] / (1 - 0.999**step)) + 1e-8)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = self._logit((x - self.mean) / self.scale) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, held: int = HELD, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, Network]:
    """Word vectors from all documents and the network from the labelled sample."""
    vectors = word_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.pieces(batches, size=SLICE):
            x = pool(A.column(batch, "text"), shared.value)
            yield pa.RecordBatch.from_arrays([A.column(batch, "doc_id"), A.column(batch, "y"), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    sample = training_rows(docs, labels, label, folds, held, rows).mapInArrow(A.tidy(features), "doc_id long, y int, x array<double>").toArrow().sort_by("doc_id")
    x = np.array(sample["x"].to_pylist(), np.float64).reshape(len(sample), 2 * DIM + 1)
    return vectors, Network(x, sample["y"].to_numpy().astype(np.float64))


def score(docs: DataFrame, model: tuple[np.ndarray, Network], carry: bool = False) -> DataFrame:
    """`doc_id` and `score`; with `carry` instead `row`, all columns of `docs`, and `score`."""
    vectors = docs.sparkSession.sparkContext.broadcast(model[0])
    network = model[1]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = A.column(batch, "row").field("text") if carry else A.column(batch, "text")
            for start, rows in A.sliced(texts, SLICE):
                s = pa.array(network.score(pool(texts.slice(start, rows), vectors.value)))
                yield pa.RecordBatch.from_arrays([A.column(batch, name).slice(start, rows), s], [name, "score"])

    name = "row" if carry else "doc_id"
    if not carry:
        return docs.select("doc_id", "text").mapInArrow(A.tidy(scored), "doc_id long, score double")
    return docs.select(F.struct("*").alias("row")).mapInArrow(A.tidy(scored), f"row {docs.schema.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    return score(docs, fit(docs, labels)).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
