"""Substring dedup with fixed-block anchors.

A window is ``WINDOW`` consecutive words of a document. A word is removed when a window that
covers it has a word sequence that also starts anywhere else. The work goes in four steps:

1. *Index and probe.* Non-overlapping blocks of ``BLOCK`` words of every document are the
   reference; every rolling run of ``BLOCK`` words probes them. Any window contains a whole
   block of its own document (``2 * BLOCK - 1 <= WINDOW``), so of two equal windows each
   contains a probe that hits a block of the other.
2. *Hits* go back to their documents.
3. *Extend.* Windows around hits are compared over their whole length: equal ones are the
   steps of maximal exact repeats.
4. *Remove* what the repeated windows cover, judged on the input.

Documents are dealt into parts by a hash of identifier and text, and probes into buckets by
hash. A part sends one packed message to each bucket: hashes and places, a few bytes a word.
A run that occurs several times in one part is sent once, with a mark, so that a passage
of any number of documents costs a bucket at most one entry for each part.

Null texts have no words. Equal rows count as two documents: their windows repeat. Texts
shorter than a window are kept. Clashing names of the input are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import give_back, ship, without
from .text import SOLID, Words, cover, mix, per_text, slices, window_hashes

WINDOW = 35
BLOCK = 18
PART_BYTES = 4 << 20
RESULT = "n_words bigint, n_removed bigint, kept_text string"
_MESSAGE = "target int, part int, places binary, keys binary, more binary, marks binary"
_BACK = "part int, places binary"
_SALT = np.uint64(0xA0761D6478BD642F)


class Part:
    """Word hashes of the documents of a part, in an order that depends on nothing else."""

    def __init__(self, docs: pa.Table):
        self.docs = docs.sort_by([("_k1", "ascending"), ("_k2", "ascending")]).combine_chunks()
        hashes, counts, self.words = [], [], []
        for batch in self.docs.select(["_text"]).to_batches():
            for piece in slices(batch, "_text"):
                words = Words(piece.column("_text"), SOLID, lower=False)
                hashes.append(words.hashes())
                counts.append(words.counts)
                self.words.append(words)
        self.hashes = np.concatenate(hashes)
        self.counts = np.concatenate(counts)
        self.first = np.r_[0, np.cumsum(self.counts)]

    def windows(self, size: int) -> np.ndarray:
        start = np.arange(max(0, len(self.hashes) - size + 1))
        end = np.repeat(self.first[1:], self.counts)[: len(start)]
        return start[end - start >= size]

    def place_in_text(self, at: np.ndarray) -> np.ndarray:
        return at - np.repeat(self.first[:-1], self.counts)[at]


def pack(places: np.ndarray) -> bytes:
    """Ascending places as differences, by byte planes: the upper ones compress to nothing."""
    step = np.diff(places, prepend=0).astype("<u4")
    return np.ascontiguousarray(step.view(np.uint8).reshape(-1, 4).T).tobytes()


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.int64)


def repeated_here(keys: np.ndarray, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flags of keys that occur several times, one place of each key, whether one is marked)."""
    order = np.argsort(keys)
    runs = np.flatnonzero(np.r_[True, np.diff(keys[order]) != 0]) if len(keys) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[runs, len(keys)])
    several = np.empty(len(keys), bool)
    several[order] = np.repeat(sizes > 1, sizes)
    any_marked = np.add.reduceat(marked[order].astype(np.int64), runs) > 0 if len(keys) else marked
    return several, order[runs], any_marked


def messages(part: int, buckets: int, at, keys, more, marks) -> pa.Table:
    """One row for each bucket with the entries that belong to it, ordered by place."""
    target = ((keys >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((at, target))
    target, at, keys, more, marks = (x[order] for x in (target, at, keys, more, marks))
    cuts = np.flatnonzero(np.r_[True, np.diff(target) != 0]) if len(target) else np.zeros(0, np.int64)
    ends = np.r_[cuts[1:], len(target)]
    pairs = list(zip(cuts.tolist(), ends.tolist()))
    return pa.table(
        {
            "target": pa.array(target[cuts], pa.int32()),
            "part": pa.array(np.full(len(cuts), part), pa.int32()),
            "places": pa.array([pack(at[a:b]) for a, b in pairs], pa.binary()),
            "keys": pa.array([keys[a:b].astype("<u4").tobytes() for a, b in pairs], pa.binary()),
            "more": pa.array([more[a:b].tobytes() for a, b in pairs], pa.binary()),
            "marks": pa.array([np.packbits(marks[a:b]).tobytes() for a, b in pairs], pa.binary()),
        }
    )


def _probes(buckets: int) -> Callable:
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table) -> pa.Table:
        part = Part(docs)
        at = part.windows(BLOCK)
        keys = window_hashes(part.hashes, at, BLOCK)
        block = part.place_in_text(at) % BLOCK == 0
        several, one, is_block = repeated_here(keys, block)
        # marks: two bits, part of the reference and repeated
        marks = np.stack([is_block, several[one]], axis=1)
        give_back()
        return messages(key[0].as_py(), buckets, at[one], keys[one], np.zeros((len(one), 0), np.uint8), marks)

    return run


def _received(table: pa.Table, width: int) -> tuple[np.ndarray, ...]:
    """Entries of all messages to a bucket: number of the message, place, keys, marks."""
    places = [unpack(x) for x in table["places"].to_pylist()]
    sizes = [len(x) for x in places]
    keys = [np.frombuffer(x, "<u4") for x in table["keys"].to_pylist()]
    more = [np.frombuffer(x, np.uint8).reshape(n, -1) for x, n in zip(table["more"].to_pylist(), sizes) if n]
    marks = [
        np.unpackbits(np.frombuffer(x, np.uint8), count=n * width).reshape(n, width).astype(bool)
        for x, n in zip(table["marks"].to_pylist(), sizes)
    ]
    message = np.repeat(np.arange(len(sizes)), sizes)
    return message, np.concatenate(places), np.concatenate(keys), np.concatenate(more), np.concatenate(marks)


def _back(table: pa.Table, message: np.ndarray, places: np.ndarray) -> pa.Table:
    """One row for each part that gets places back."""
    parts = table["part"].to_numpy()
    cuts = np.searchsorted(message, np.arange(len(parts) + 1))
    rows = [(parts[i], pack(places[cuts[i] : cuts[i + 1]])) for i in range(len(parts)) if cuts[i + 1] > cuts[i]]
    return pa.table({"part": pa.array([r[0] for r in rows], pa.int32()), "places": pa.array([r[1] for r in rows], pa.binary())})


def _block_hits(table: pa.Table) -> pa.Table:
    """Probes whose run is a block of the reference and occurs more than once."""
    message, places, keys, _, marks = _received(table, 2)
    order = np.argsort(keys)
    runs = np.flatnonzero(np.r_[True, np.diff(keys[order]) != 0])
    sizes = np.diff(np.r_[runs, len(keys)])
    block = np.add.reduceat(marks[order, 0].astype(np.int64), runs) > 0
    hit = np.zeros(len(keys), bool)
    # what repeats within its own part is known there
    hit[order] = np.repeat(block & (sizes > 1), sizes)
    hit &= ~marks[:, 1]
    return _back(table, message[hit], places[hit])


def _given(back: pa.Table, size: int) -> np.ndarray:
    flags = np.zeros(size, bool)
    for places in back["places"].to_pylist():
        flags[unpack(places)] = True
    return flags


def _extend(buckets: int) -> Callable:
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, back: pa.Table) -> pa.Table:
        part = Part(docs)
        at = part.windows(BLOCK)
        hit = _given(back, len(part.hashes) + 1)
        several, _, _ = repeated_here(window_hashes(part.hashes, at, BLOCK), np.zeros(len(at), bool))
        hit[at[several]] = True
        seen = np.r_[0, np.cumsum(hit)]
        start = part.windows(WINDOW)
        start = start[seen[start + WINDOW - BLOCK + 1] > seen[start]]
        keys = window_hashes(part.hashes, start, WINDOW)
        several, one, _ = repeated_here(keys, np.zeros(len(keys), bool))
        start, keys = start[one], keys[one]
        second = window_hashes(mix(part.hashes ^ _SALT), start, WINDOW, 1)
        more = np.stack([(keys >> np.uint64(32)).astype("<u4"), second.astype("<u4")], axis=1).view(np.uint8)
        return messages(key[0].as_py(), buckets, start, keys, more, several[one][:, None])

    return run


def _same_windows(table: pa.Table) -> pa.Table:
    """Windows that also start in another part; those of their own part are known there."""
    message, places, keys, more, marks = _received(table, 1)
    more = np.ascontiguousarray(more).view("<u4")
    order = np.lexsort((more[:, 1], more[:, 0], keys))
    new = np.r_[True, (np.diff(keys[order]) != 0) | (np.diff(more[order], axis=0) != 0).any(axis=1)]
    runs = np.flatnonzero(new)
    sizes = np.diff(np.r_[runs, len(keys)])
    hit = np.zeros(len(keys), bool)
    hit[order] = np.repeat(sizes > 1, sizes)
    hit &= ~marks[:, 0]
    return _back(table, message[hit], places[hit])


def kept_text(words: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    text = words.of_text[keep]
    starts, ends = words.starts[keep], words.ends[keep]
    follows = np.zeros(len(text), bool)
    follows[:-1] = text[1:] == text[:-1]
    raw = words.raw.copy()
    raw[ends[follows]] = 0x20
    used = cover(starts, ends + follows, len(raw))
    sizes = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(used, out=sizes[1:])
    offsets = sizes[words.offsets]
    return pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw[used].tobytes())
    )


def _remove(names: list[str]) -> Callable:
    def run(docs: pa.Table, back: pa.Table) -> pa.Table:
        part = Part(docs)
        start = part.windows(WINDOW)
        several, _, _ = repeated_here(window_hashes(part.hashes, start, WINDOW), np.zeros(len(start), bool))
        flags = _given(back, len(part.hashes) + 1)
        flags[start[several]] = True
        found = np.flatnonzero(flags)
        gone = cover(found, found + WINDOW, len(part.hashes))
        give_back()
        texts, done = [], 0
        for words in part.words:
            texts.append(kept_text(words, ~gone[done : done + len(words.starts)]).cast(pa.string()))
            done += len(words.starts)
        out = {name: part.docs[name] for name in names}
        out |= {"n_words": part.counts, "n_removed": per_text(part.first, gone), "kept_text": pa.chunked_array(texts)}
        return pa.table(out)

    return run


def parts_of(docs: DataFrame, text_col: str, part_bytes: int) -> int:
    """Number of parts: of a size that one task holds easily, and work for all tasks."""
    size = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(size / part_bytes))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART_BYTES
) -> DataFrame:
    """The documents with ``n_words``, ``n_removed`` and ``kept_text``."""
    ship(docs.sparkSession)
    result = T._parse_datatype_string(RESULT)
    kept = without(docs, [*result.names, "_k1", "_k2", "_part", "_text"])
    names = kept.columns
    parts = parts_of(docs, text_col, part_bytes)
    keyed = docs.select(
        *(docs[c] for c in names),
        docs[text_col].alias("_text"),
        F.xxhash64(F.lit(1), docs[id_col]).alias("_k1"),
        F.xxhash64(docs[id_col], docs[text_col]).alias("_k2"),
    ).withColumn("_part", F.pmod(F.hash("_k1", "_k2"), F.lit(parts)).cast("int"))
    if text_col in names:
        keyed = keyed.drop(text_col)
    by_part = keyed.groupBy("_part")

    def back_to_parts(sent: DataFrame, judge: Callable):
        return sent.groupBy("target").applyInArrow(judge, _BACK).withColumnRenamed("part", "_part").groupBy("_part")

    probes = by_part.applyInArrow(_probes(parts), _MESSAGE)
    hits = back_to_parts(probes, _block_hits)
    windows = by_part.cogroup(hits).applyInArrow(_extend(parts), _MESSAGE)
    found = back_to_parts(windows, _same_windows)
    inner = ["_text" if n == text_col else n for n in names]
    schema = T.StructType([*(T.StructField(i, docs.schema[n].dataType) for i, n in zip(inner, names)), *result.fields])
    out = by_part.cogroup(found).applyInArrow(_remove(inner), schema)
    return out.withColumnRenamed("_text", text_col) if text_col in names else out
