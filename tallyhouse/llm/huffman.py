"""Canonical length-limited Huffman coding of ids, with bit-offset checkpoints.

Codes are at most ``limit`` bits long, so one table look-up decodes an id. The bits of a
block are independent of all others; every ``CHECKPOINT`` ids the bit offset is noted, and
all stretches between checkpoints are decoded side by side.
"""

from __future__ import annotations

import numpy as np

CHECKPOINT = 256


def code_lengths(counts: np.ndarray, limit: int = 16) -> np.ndarray:
    """Optimal code length of each id under the limit, 0 where the count is 0 (package-merge)."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit codes of {limit} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64)
    level, leaf_flags = weights, [np.ones(len(used), bool)]
    for _ in range(limit - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.r_[weights, pairs]
        order = np.argsort(both, kind="stable")
        level = both[order]
        leaf_flags.append(order < len(used))
    lengths = np.zeros(len(used), np.int64)
    taken = 2 * len(used) - 2
    for flags in reversed(leaf_flags):
        leaves = int(flags[:taken].sum())
        lengths[:leaves] += 1
        taken = 2 * (taken - leaves)
    out[used] = lengths
    return out


class Code:
    """Codes and decoding table that follow from the lengths alone."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        used = np.flatnonzero(lengths)
        used = used[np.lexsort((used, lengths[used]))]
        self.limit = int(self.lengths.max(initial=1))
        room = np.int64(1) << (self.limit - self.lengths[used])
        ends = np.cumsum(room)
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[used] = ((ends - room) >> (self.limit - self.lengths[used])).astype(np.uint64)
        self.symbol = np.zeros(1 << self.limit, np.int32)
        self.step = np.ones(1 << self.limit, np.int64)
        self.symbol[: int(room.sum())] = np.repeat(used, room)
        self.step[: int(room.sum())] = np.repeat(self.lengths[used], room)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits of a block, and the bit offset of every CHECKPOINT-th id."""
        size = self.lengths[ids]
        ends = np.cumsum(size)
        at = ends - size
        shift = (64 - size - (at & 31)).astype(np.uint64)
        value = self.codes[ids] << shift
        word = at >> 5
        out = np.zeros((int(ends[-1]) >> 5) + 2 if len(ids) else 1, np.uint32)
        if len(ids):
            first = np.flatnonzero(np.r_[True, np.diff(word) != 0])
            joined = np.add.reduceat(value, first)
            out[word[first]] += (joined >> np.uint64(32)).astype(np.uint32)
            out[word[first] + 1] += (joined & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return out.astype(">u4").tobytes(), at[::CHECKPOINT].astype("<u4")

    def decode(self, blocks: list[tuple[bytes, np.ndarray, int]]) -> list[np.ndarray]:
        """The ids of (bits, checkpoints, number of ids) blocks."""
        bits = np.frombuffer(b"".join(b for b, _, _ in blocks) + bytes(8), np.uint8).astype(np.uint32)
        window = (bits[:-3] << 24) | (bits[1:-2] << 16) | (bits[2:-1] << 8) | bits[3:]
        base = np.cumsum([0, *(8 * len(b) for b, _, _ in blocks)])[:-1]
        at = np.concatenate([np.asarray(c, np.int64) + o for (_, c, _), o in zip(blocks, base)])
        left = np.concatenate(
            [np.minimum(CHECKPOINT, n - CHECKPOINT * np.arange(len(c))) for _, c, n in blocks]
        ).astype(np.int64)
        out = np.zeros((len(at), CHECKPOINT), np.int32)
        lanes = np.argsort(-left, kind="stable")
        at, live = at[lanes], np.searchsorted(-left[lanes], -np.arange(CHECKPOINT), "left")
        for k in range(int(left.max(initial=0))):
            now = at[: live[k]]
            seen = (window[now >> 3] << (now & 7).astype(np.uint32)) >> np.uint32(32 - self.limit)
            out[lanes[: live[k]], k] = self.symbol[seen]
            at[: live[k]] += self.step[seen]
        flat = out[np.arange(CHECKPOINT)[None, :] < left[:, None]]
        return np.split(flat, np.cumsum([n for _, _, n in blocks])[:-1])
