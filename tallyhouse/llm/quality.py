"""Quality classifier: random-indexing vectors pooled per document, and a small network.

*Vectors.* Each word, and each shape of a word (runs of letters, digits and signs), has a row
in a hashed table of fixed size, so words of a large vocabulary share rows. A row is the sum of the
random index vectors of the neighbours that the word has in all documents, scaled to length one:
one narrow pass, with one partial table for each core, which Spark adds up. A document is the mean
of the rows of its words and of its shapes.

*Network.* Two layers in numpy, fitted on nine tenths of a bounded sample of labelled rows; the last
tenth sets the temperature of the logit, which calibrates the probabilities.

A null or empty text has zero vectors and gets the score that the network gives them; a word that no
document holds has none. Without labels of both classes every score is 0.5. Rows are scored one by
one, so repeated rows get equal scores; very long texts are read in full and pooled in steps. Empty
tables give no rows. A column of the input called ``score`` is replaced, others stay.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .frames import enrich, map_arrow
from .text import SOLID, Words, range_hash, slices
from .text import _BASES, _BYTE

DIM = 32
WORD_ROWS, SHAPE_ROWS = 1 << 16, 1 << 12
#: entries of 1 or -1 in an index vector
ENTRIES = 4
NEIGHBOURS = 2
HIDDEN = 32
EPOCHS = 30
#: table rows that are added up together
CHUNK = 1 << 11

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("0") : ord("9") + 1] = ord("0")
_CLASS[ord("A") : ord("Z") + 1] = ord("A")
_CLASS[ord("a") : ord("z") + 1] = ord("a")
_CLASS[128:] = ord("a")


def _index_vectors(rows: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Sparse random vectors: the places of their entries, and the entries."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, DIM, (ENTRIES, rows)), rng.choice([-1.0, 1.0], (ENTRIES, rows))


def _rows_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of the words (lower-cased by the caller's Words) and of their shapes."""
    kinds = _CLASS[words.raw]
    new = np.ones(len(kinds), bool)
    new[1:] = kinds[1:] != kinds[:-1]
    new[words.starts] = True
    before = np.r_[0, np.cumsum(new)]
    shape = range_hash(_BYTE[kinds[new]], before[words.starts], before[words.ends], _BASES[0])
    return (words.hashes() % np.uint64(WORD_ROWS)).astype(np.int64), (shape % np.uint64(SHAPE_ROWS)).astype(np.int64)


def _add_contexts(total: np.ndarray, rows: np.ndarray, text: np.ndarray, index: tuple[np.ndarray, np.ndarray]) -> None:
    """Add the index vectors of the neighbours of each word to its table row."""
    own, near = [], []
    for step in range(1, NEIGHBOURS + 1):
        inside = text[step:] == text[:-step]
        left, right = rows[:-step][inside], rows[step:][inside]
        own += [left, right]
        near += [right, left]
    own, near = np.concatenate(own) * DIM, np.concatenate(near)
    for places, entries in zip(*index):
        total += np.bincount(own + places[near], entries[near], len(total))


def _pool(table: np.ndarray, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean table row of each text, in steps that bound the memory."""
    out = np.zeros((len(first) - 1, DIM), np.float32)
    full = np.flatnonzero(np.diff(first))
    start = 0
    while start < len(full):
        begin = first[full[start]]
        stop = max(start + 1, int(np.searchsorted(first[full + 1], begin + 50_000, "right")))
        own = full[start:stop]
        out[own] = np.add.reduceat(table[rows[begin : first[own[-1] + 1]]], first[own] - begin, axis=0)
        start = stop
    return out / np.maximum(np.diff(first), 1)[:, None].astype(np.float32)


@dataclass
class Model:
    word_table: np.ndarray
    shape_table: np.ndarray
    layers: tuple[np.ndarray, ...] | None = None
    centre: np.ndarray | None = None
    spread: np.ndarray | None = None
    temperature: float = 1.0

    def features(self, texts: pa.Array) -> np.ndarray:
        words = Words(texts, SOLID, lower=False)
        word, shape = _rows_of(words)
        size = np.log1p(words.counts)[:, None].astype(np.float32) / 10
        return np.hstack([_pool(self.word_table, word, words.first), _pool(self.shape_table, shape, words.first), size])

    def logit(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum((x - self.centre) / self.spread @ w1 + b1, 0) @ w2 + b2

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.layers is None:
            return np.full(len(texts), 0.5)
        z = self.logit(self.features(texts)).astype(float) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def _tables(texts: DataFrame) -> Model:
    """Word and shape vectors of all texts (``text``).

    A task reads several splits, so that there are no more partial tables than a few for each core,
    however many texts there are. Entries are whole numbers: the order of the parts does not matter.
    """
    context = texts.sparkSession.sparkContext
    sizes = (WORD_ROWS, SHAPE_ROWS)

    def run(batches):
        index = [_index_vectors(n, 6 + k) for k, n in enumerate(sizes)]
        total = [np.zeros(n * DIM) for n in sizes]
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column("text"), SOLID, lower=False)
                for k, rows in enumerate(_rows_of(words)):
                    if len(rows) > NEIGHBOURS:
                        _add_contexts(total[k], rows, words.of_text, index[k])
        for k, own in enumerate(np.split(np.concatenate(total), sum(sizes) // CHUNK)):
            if own.any():
                sums = own.astype("<i8").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([sums], pa.binary())], ["chunk", "sums"])

    def add(batches):
        # one chunk after the other
        last, total = None, None
        for batch in batches:
            for k, sums in zip(batch.column("chunk").to_pylist(), batch.column("sums")):
                own = np.frombuffer(sums.as_py(), "<i8")
                if k != last and last is not None:
                    yield _chunk(last, total)
                last, total = k, own if k != last else total + own
        if last is not None:
            yield _chunk(last, total)

    tasks = 2 * max(context.defaultParallelism, 8)
    partial = map_arrow(texts.select("text").coalesce(tasks), run, "chunk int, sums binary")
    by_chunk = partial.repartition("chunk").sortWithinPartitions("chunk")
    sums = np.zeros(sum(sizes) * DIM)
    for row in map_arrow(by_chunk, add, "chunk int, sums binary").collect():  # one table of fixed size
        sums[row["chunk"] * CHUNK * DIM :][: CHUNK * DIM] = np.frombuffer(row["sums"], "<i8")
    table = sums.reshape(-1, DIM)
    return Model(_unit(table[:WORD_ROWS]), _unit(table[WORD_ROWS:]))


def _chunk(k: int, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["chunk", "sums"])


def _train(model: Model, x: np.ndarray, y: np.ndarray) -> None:
    rng = np.random.default_rng(6)
    check = rng.random(len(y)) < 0.1
    model.centre, model.spread = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = (x - model.centre) / model.spread
    fit = np.flatnonzero(~check)
    w = [rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(fit), max(1, len(fit) // 64)):
            hidden = np.maximum(z[rows] @ w[0] + w[1], 0)
            error = (1 / (1 + np.exp(-np.clip(hidden @ w[2] + w[3], -30, 30))) - y[rows]) / len(rows)
            back = error[:, None] * w[2] * (hidden > 0)
            grads = [z[rows].T @ back + 1e-3 * w[0], back.sum(axis=0), hidden.T @ error + 1e-3 * w[2], error.sum(keepdims=True)]
            step += 1
            for i, g in enumerate(grads):  # Adam
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] -= 0.003 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    model.layers = tuple(w)
    held = check if 0 < y[check].sum() < check.sum() else np.ones(len(y), bool)
    logit, truth = model.logit(x[held]), y[held]

    def loss(t: float) -> float:
        return float(np.mean(np.logaddexp(0, logit / t) - truth * logit / t))

    model.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))


def learn(sample: DataFrame, texts: DataFrame | None = None) -> Model:
    """Vectors of all ``texts`` (``text``; by default the sample's) and the network of a bounded sample (``text``, ``label``)."""
    model = _tables(sample if texts is None else texts)

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                x = model.features(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.tolist(), pa.list_(pa.float32())), part.column("label")], ["x", "label"]
                )

    rows = map_arrow(sample, run, "x array<float>, label int").toPandas()  # bounded by the sample
    if rows["label"].nunique() == 2:
        x, y = np.array(rows["x"].tolist(), np.float64), rows["label"].to_numpy(float)
        order = np.lexsort((y, x[:, 0], x[:, -1]))  # whatever order the rows came in
        _train(model, x[order], y[order])
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents with ``score``, 0 to 1: higher, likelier of label 1. One narrow pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # tables of fixed size

    def rows(part: pa.RecordBatch) -> dict:
        return {"score": shared.value.score(part.column(text_col))}

    return enrich(docs, "score double", rows, text_col)
