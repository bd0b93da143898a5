"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

A window is ``WINDOW`` consecutive words of an item (all words of a shorter item). A document
contains a window when its words stand consecutively in the document; containment is total,
so of the window's shingles ordered by rarity only the first, the rarest in the corpus, is a
necessary prefix token. Every document shingle is joined with these tokens; the token's place
in the window gives the one place where the window can start, which has to leave room on both
sides (positional and length bounds); what is left is verified word by word.

Null texts have no words, null item texts no windows. Repeated documents and items are judged
each on its own; several items may share a window. An empty benchmark hits nothing.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import enrich, map_arrow
from .text import ALNUM, Words, cover, per_text, slices, window_hashes

WINDOW = 13
SHINGLE = 3
#: Bytes of item texts that are broadcast at once. A larger benchmark is joined in blocks.
BLOCK_BYTES = 4 << 20
HIT_FIELDS = "n_words bigint, n_hit bigint, items array<string>, hit_runs array<int>"


class ItemWindows:
    """The distinct windows of a block of items, with the word hashes they consist of."""

    def __init__(self, ids: list[str], texts: list[str], window: int = WINDOW):
        words = Words(pa.array(texts, pa.string()), ALNUM)
        hashes = words.hashes()
        found: dict[bytes, set[str]] = {}
        for item, first, last in zip(ids, words.first[:-1], words.first[1:]):
            size = min(window, last - first)
            for start in range(first, last - size + 1 if size else first):
                found.setdefault(hashes[start : start + size].tobytes(), set()).add(item)
        self.items = [sorted(items) for items in found.values()]
        self.sizes = np.array([len(key) // 8 for key in found], np.int64)
        self.words = np.zeros((len(found), window), np.uint64)
        for i, key in enumerate(found):
            self.words[i, : self.sizes[i]] = np.frombuffer(key, np.uint64)

    def shingles(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, window, offset, length) of every shingle of every window."""
        parts = []
        for size in np.unique(self.sizes):
            rows = np.flatnonzero(self.sizes == size)
            length = min(SHINGLE, size)
            for offset in range(size - length + 1):
                flat = self.words[rows, :size].ravel()
                starts = np.arange(len(rows)) * size + offset
                hashes = window_hashes(flat, starts, length)
                parts.append((hashes, rows, np.full(len(rows), offset), np.full(len(rows), length)))
        return tuple(np.concatenate(x) for x in zip(*parts))

    def prefix(self, counts: dict[int, int]) -> None:
        """Keep the rarest shingle of each window, sorted by hash, one list per length."""
        hashes, window, offset, length = self.shingles()
        seen = np.fromiter((counts.get(h, 0) for h in hashes.view(np.int64).tolist()), np.int64)
        order = np.lexsort((offset, hashes, seen, window))
        rarest = order[np.r_[True, np.diff(window[order]) > 0]]
        self.tokens = {}
        for n in np.unique(length[rarest]):
            own = rarest[length[rarest] == n]
            own = own[np.argsort(hashes[own], kind="stable")]
            self.tokens[int(n)] = (hashes[own], window[own], offset[own])

    def hits(self, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of every occurrence in a slice of documents."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for length, (tokens, window, offset) in self.tokens.items():
            at = words.windows(length)
            keys = window_hashes(hashes, at, length)
            left = np.searchsorted(tokens, keys, "left")
            inside = np.flatnonzero(tokens[np.minimum(left, len(tokens) - 1)] == keys)
            left, at = left[inside], at[inside]
            many = np.searchsorted(tokens, keys[inside], "right") - left
            at = np.repeat(at, many)
            token = np.repeat(left - np.cumsum(many) + many, many) + np.arange(len(at))
            start, row = at - offset[token], window[token]
            text = np.searchsorted(words.first, at, "right") - 1
            room = (start >= words.first[text]) & (start + self.sizes[row] <= words.first[text + 1])
            start, row = start[room], row[room]
            same = np.ones(len(start), bool)
            for k in range(self.words.shape[1]):
                inner = k < self.sizes[row]
                at_k = np.minimum(start + k, len(hashes) - 1)
                same &= ~inner | (hashes[at_k] == self.words[row, k])
            found.append((start[same], row[same]))
        return tuple(np.concatenate(x) for x in zip(*found))


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> list[DataFrame]:
    """Parts of the items, each of at most BLOCK_BYTES where no single item is larger."""
    items = items.where(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text")
    )
    size = F.sum(F.octet_length("text"))
    total = items.agg(size.alias("n")).first()["n"] or 0
    blocks = math.ceil(2 * total / BLOCK_BYTES) if total > BLOCK_BYTES else int(total > 0)
    part = F.pmod(F.xxhash64("item", "text"), F.lit(max(1, blocks)))
    return [items.where(part == i) for i in range(blocks)]


def shingle_counts(docs: DataFrame, text_col: str, wanted: dict[int, np.ndarray]) -> dict[int, int]:
    """How often each wanted shingle occurs in all documents; as many rows as are wanted."""

    def run(batches):
        total = {length: np.zeros(len(keys), np.int64) for length, keys in wanted.items()}
        for batch in batches:
            for part in slices(batch, text_col):
                words = Words(part.column(text_col), ALNUM)
                hashes = words.hashes()
                for length, keys in wanted.items():
                    own = window_hashes(hashes, words.windows(length), length)
                    at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                    total[length] += np.bincount(at[keys[at] == own], minlength=len(keys))
        for length, keys in wanted.items():
            seen = np.flatnonzero(total[length])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[seen].view(np.int64)), pa.array(total[length][seen])], ["shingle", "n"]
            )

    counted = map_arrow(docs.select(text_col), run, "shingle bigint, n bigint")
    rows = counted.groupBy("shingle").agg(F.sum("n").alias("n")).collect()
    return {row["shingle"]: row["n"] for row in rows}


def find_items(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Documents with ``n_words``, ``n_hit``, ``items`` and ``hit_runs`` (start, end, ...).

    One pass over the documents for the rarity of shingles and one for the join, per block
    of items; nothing is shuffled but the shingle counts.
    """
    out, joined = docs, False
    for block in item_blocks(items, item_id, item_text):
        rows = block.collect()  # at most about BLOCK_BYTES
        index = ItemWindows([r["item"] for r in rows], [r["text"] for r in rows], window)
        if not len(index.sizes):
            continue
        hashes, _, _, length = index.shingles()
        wanted = {int(n): np.unique(hashes[length == n]) for n in np.unique(length)}
        index.prefix(shingle_counts(docs, text_col, wanted))
        out = _join(out, docs.sparkSession.sparkContext.broadcast(index), text_col, joined)
        joined = True
    return out if joined else enrich(docs, HIT_FIELDS, lambda part: _unhit(part, text_col), text_col)


def _unhit(part: pa.RecordBatch, text_col: str) -> dict:
    n = part.num_rows
    return {
        "n_words": Words(part.column(text_col), ALNUM).counts,
        "n_hit": np.zeros(n, np.int64),
        "items": pa.array([[]] * n, pa.list_(pa.string())),
        "hit_runs": pa.array([[]] * n, pa.list_(pa.int32())),
    }


def _join(docs: DataFrame, shared, text_col: str, joined: bool) -> DataFrame:
    """Add the hits of one block of items to those found before."""

    def rows(part: pa.RecordBatch) -> dict:
        index = shared.value
        words = Words(part.column(text_col), ALNUM)
        start, window = index.hits(words, words.hashes())
        runs, items = ([[] for _ in range(part.num_rows)] for _ in "ab")
        if joined:
            runs, items = part.column("hit_runs").to_pylist(), part.column("items").to_pylist()
        ends = start + index.sizes[window]
        first = words.first
        earlier = [(i, r) for i, r in enumerate(runs) if r]
        old = np.array([(first[i] + a, first[i] + b) for i, r in earlier for a, b in zip(r[::2], r[1::2])], np.int64)
        old = old.reshape(-1, 2)
        hit = cover(np.r_[start, old[:, 0]], np.r_[ends, old[:, 1]], len(words.starts))
        text = np.searchsorted(first, start, "right") - 1
        for i in np.unique(text).tolist():
            own = {item for w in np.unique(window[text == i]).tolist() for item in index.items[w]}
            items[i] = sorted(own.union(items[i]))
            flags = np.r_[False, hit[first[i] : first[i + 1]], False]
            runs[i] = np.flatnonzero(flags[1:] != flags[:-1]).tolist()
        return {
            "n_words": words.counts,
            "n_hit": per_text(first, hit),
            "items": pa.array(items, pa.list_(pa.string())),
            "hit_runs": pa.array(runs, pa.list_(pa.int32())),
        }

    return enrich(docs, HIT_FIELDS, rows, text_col)


def contaminated() -> F.col:
    """The rule on ``n_hit`` and ``n_words``: at least a twentieth of the words is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
