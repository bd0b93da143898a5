"""Quality rules and an isolation forest over their statistics.

The base rule drops documents of fewer than ten words or with many repeated words. Of the rest
isolation forests judge the rule statistics: documents that random splits isolate early are
anomalous. One forest looks at the shares of kinds of characters, one at the statistics of
words and lines (duplicate lines, repeated words, number and length of words): in one forest
anomalies of one kind would hide those of the other. They are grown on a bounded sample of labelled
rows, whose labels set a threshold for each, one after the other over what is left: the best separation of labels 0
and 1 that rejects at most ``FALSE_REJECTS`` of label 1. Without labels of both classes only the
base rule rejects.

A null or empty text has no words and fails the base rule. An anomaly equal to the threshold is kept. Rows are
judged one by one, so repeated rows and the order of rows change nothing; a very long text is a row
like any other. An empty table gives no rows. Columns of the input called like an added one are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .frames import enrich, map_arrow
from .text import SOLID, Words, cover, per_text, range_hash, slices, window_hashes
from .text import _BASES, _BYTE

FIELDS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, anomaly double, kept boolean"
)
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
#: Small trees: with more rows the anomalies of one kind hide each other.
TREES, TREE_ROWS, DEPTH = 200, 32, 7
FALSE_REJECTS = 0.005
#: the statistics of each forest: kinds of characters; words and lines
FORESTS = (slice(0, 4), slice(4, 8))


def _flag(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL, _SHOUT, _UPPER = _flag(SYMBOLS), _flag(b"!"), _flag(bytes(range(65, 91)))
_LETTER = _flag(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
_FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80


def _repeated(keys: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(several: equal to another of its text, later: equal to an earlier one of its text)."""
    order = np.lexsort((np.arange(len(keys)), keys, text))
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = (keys[order][1:] == keys[order][:-1]) & (text[order][1:] == text[order][:-1])
    several, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    several[order], later[order] = same[1:] | same[:-1], same[:-1]
    return several, later


def statistics(texts: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The counts of the base rule, and the statistics that the forest looks at."""
    words = Words(texts, SOLID, lower=False)
    raw, n = words.raw, words.counts

    def count(table: np.ndarray) -> np.ndarray:
        return per_text(words.offsets, table[raw])

    inside = cover(words.starts, words.ends, len(raw))
    word_chars = per_text(words.offsets, inside & _FIRST_BYTE[raw])
    breaks = np.flatnonzero(raw == 10)
    starts = np.unique(np.r_[breaks + 1, words.offsets[:-1]])
    starts = starts[starts < len(raw)]
    text_of = np.searchsorted(words.offsets, starts, "right") - 1
    # a line ends at the next break or with its text
    stops = words.offsets[text_of + 1]
    if len(breaks):
        at = np.searchsorted(breaks, starts)
        stops = np.where(at < len(breaks), np.minimum(breaks[np.minimum(at, len(breaks) - 1)], stops), stops)
    filled = np.searchsorted(words.starts, stops) > np.searchsorted(words.starts, starts)
    starts, stops, text_of = starts[filled], stops[filled], text_of[filled]
    _, again = _repeated(range_hash(_BYTE[raw], starts, stops, _BASES[0]), text_of)
    n_dup = np.bincount(text_of[again], minlength=len(n))
    n_lines = np.bincount(text_of, minlength=len(n))

    at = words.windows(WINDOW)
    several, _ = _repeated(window_hashes(words.hashes(), at, WINDOW), np.searchsorted(words.first, at, "right") - 1)
    n_repeat = per_text(words.first, cover(at[several], at[several] + WINDOW, len(words.starts)))
    counts = {
        "n_words": n,
        "word_chars": word_chars,
        "n_symbols": count(_SYMBOL),
        "n_dup_lines": n_dup,
        "n_repeat_words": n_repeat,
    }
    one = np.maximum(n, 1)
    features = [
        counts["n_symbols"] / one,
        count(_SHOUT) / one,
        count(_UPPER) / np.maximum(word_chars, 1),
        count(_LETTER) / np.maximum(np.diff(words.offsets), 1),
        n_dup / np.maximum(n_lines, 1),
        n_repeat / one,
        np.log1p(n),
        word_chars / one,
    ]
    return counts, np.column_stack(features)


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < 10) | (100 * counts["n_repeat_words"] > 20 * counts["n_words"])


def _average_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among n rows."""
    n = np.maximum(n, 1).astype(float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / n, n - 1)


@dataclass
class Forest:
    """Trees as arrays: node i splits into 2 i + 1 and 2 i + 2; leaves carry a path length."""

    feature: np.ndarray
    cut: np.ndarray
    path: np.ndarray
    columns: slice = slice(None)
    threshold: float = np.inf

    def anomaly(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / expected path), near 1 for what is isolated early."""
        x = x[:, self.columns]
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, cut, path in zip(self.feature, self.cut, self.path):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                split = feature[node]
                below = np.where(x[rows, np.maximum(split, 0)] < cut[node], 2 * node + 1, 2 * node + 2)
                node = np.where(split >= 0, below, node)
            total += path[node]
        return 2.0 ** -(total / len(self.feature) / _average_path(np.array([TREE_ROWS]))[0])


def grow(x: np.ndarray, columns: slice = slice(None), seed: int = 8) -> Forest:
    x = x[:, columns]
    rng, nodes = np.random.default_rng(seed), 2 ** (DEPTH + 1) - 1
    forest = Forest(np.full((TREES, nodes), -1), np.zeros((TREES, nodes)), np.zeros((TREES, nodes)), columns)
    for tree in range(TREES):
        todo = [(0, 0, x[rng.choice(len(x), min(TREE_ROWS, len(x)), replace=False)])]
        while todo:
            node, depth, rows = todo.pop()
            low, high = rows.min(axis=0), rows.max(axis=0)
            open_ = np.flatnonzero(high > low)
            if depth == DEPTH or len(rows) < 2 or not len(open_):
                forest.path[tree, node] = depth + _average_path(np.array([len(rows)]))[0]
                continue
            f = rng.choice(open_)
            cut = rng.uniform(low[f], high[f])
            forest.feature[tree, node], forest.cut[tree, node] = f, cut
            todo += [(2 * node + 1, depth + 1, rows[rows[:, f] < cut]), (2 * node + 2, depth + 1, rows[rows[:, f] >= cut])]
    return forest


def learn(sample: DataFrame) -> list[Forest]:
    """Forests and thresholds from a bounded sample (``text``, ``label``)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                counts, x = statistics(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.tolist(), pa.list_(pa.float64())), pa.array(base_failed(counts)), part.column("label")],
                    ["x", "failed", "label"],
                )

    rows = map_arrow(sample, run, "x array<double>, failed boolean, label int")
    rows = rows.orderBy("x", "label").toPandas()  # bounded by the sample
    rows = rows[~rows["failed"]]
    if rows["label"].nunique() < 2:
        return []
    x, y = np.array(rows["x"].tolist()), rows["label"].to_numpy()
    forests, left = [], np.ones(len(y), bool)
    for columns in FORESTS:
        forest = grow(x, columns)
        scores = forest.anomaly(x)
        forest.threshold = _threshold(scores[left & (y == 1)], scores[left & (y == 0)])
        left &= scores <= forest.threshold
        forests.append(forest)
    return forests


def _threshold(good: np.ndarray, bad: np.ndarray) -> float:
    """The anomaly above which most of label 0 and next to nothing of label 1 lies; infinite without both."""
    if not len(good) or not len(bad):
        return np.inf
    tried = np.quantile(np.r_[good, bad], np.linspace(0, 1, 2001))
    wrong = 1 - np.searchsorted(np.sort(good), tried, "right") / len(good)
    right = 1 - np.searchsorted(np.sort(bad), tried, "right") / len(bad)
    return float(tried[int(np.where(wrong <= FALSE_REJECTS, right - wrong, -1).argmax())])


def judge(docs: DataFrame, forests: list[Forest], text_col: str = "text") -> DataFrame:
    """The documents with the columns of FIELDS; ``anomaly`` is the largest of the forests. One narrow pass."""
    shared = docs.sparkSession.sparkContext.broadcast(forests)  # TREES trees of bounded depth each

    def rows(part: pa.RecordBatch) -> dict:
        counts, x = statistics(part.column(text_col))
        failed = base_failed(counts)
        anomaly, odd = np.zeros(len(x)), np.zeros(len(x), bool)
        for forest in shared.value:
            own = forest.anomaly(x)
            anomaly, odd = np.maximum(anomaly, own), odd | (own > forest.threshold)
        return {**counts, "base_failed": failed, "anomaly": anomaly, "kept": ~failed & ~odd}

    return enrich(docs, FIELDS, rows, text_col)
