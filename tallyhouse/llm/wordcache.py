"""Ids of words, computed once for each distinct word of a worker.

A tokenizer that never looks across white space gives a text the ids of its words in a row.
A worker keeps the ids of the distinct words it has seen as flat arrays, up to a bound on
their number; above it, it starts anew, which costs time and changes no result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .text import Words

MOST_WORDS = 2_000_000
#: words that are encoded at once
STEP = 50_000


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each range, one range after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class _Level:
    """Sorted hashes, and where their ids are."""

    def __init__(self, keys: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.starts, self.sizes = keys[order], starts[order].astype(np.int32), sizes[order].astype(np.int32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def joined(self, other: _Level) -> _Level:
        return _Level(*(np.r_[a, b] for a, b in zip(vars(self).values(), vars(other).values())))


_NONE = _Level(np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32))


class WordCache:
    """``encode`` maps a list of words to (ids of all words in a row, number of each).

    New words go to a small level, which is merged into the large one from time to time.
    """

    def __init__(
        self,
        encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]],
        most_ids: int = 1 << 31,
        most_words: int = MOST_WORDS,
    ):
        self.encode = encode
        self.most_words = most_words
        self.kind = np.uint16 if most_ids <= 1 << 16 else np.int32
        self.clear()

    def clear(self) -> None:
        self.large = self.small = _NONE
        self.ids, self.used = np.zeros(1 << 16, self.kind), 0

    def __len__(self) -> int:
        return len(self.large.keys) + len(self.small.keys)

    def _add(self, keys: np.ndarray, words: Words, places: list[int]) -> None:
        found = [self.encode([words.word(i) for i in places[k : k + STEP]]) for k in range(0, len(places), STEP)]
        ids, sizes = (np.concatenate(x) for x in zip(*found))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.r_[self.ids, np.zeros_like(self.ids)]
        self.ids[self.used : self.used + len(ids)] = ids
        self.small = self.small.joined(_Level(keys, self.used + np.cumsum(sizes) - sizes, sizes))
        self.used += len(ids)
        if 4 * len(self.small.keys) > len(self.large.keys):
            self.large, self.small = self.large.joined(self.small), _NONE

    def __call__(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words of a slice, and the number of ids of each word."""
        distinct, one, slot = np.unique(words.hashes(), return_index=True, return_inverse=True)
        new = np.flatnonzero(~(self.large.find(distinct)[1] | self.small.find(distinct)[1]))
        if len(self) and len(self) + len(new) > self.most_words:
            self.clear()
            new = np.arange(len(distinct))
        if len(new):
            self._add(distinct[new], words, one[new].tolist())
        starts, sizes = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        for level in (self.large, self.small):
            at, known = level.find(distinct)
            starts[known], sizes[known] = level.starts[at[known]], level.sizes[at[known]]
        sizes = sizes[slot]
        return self.ids[ragged(starts[slot], sizes)].astype(np.int32), sizes
