"""The prefix trie against brute force: long conversations, shared heads, nulls, ties, hot nodes."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyhouse.llm import running, trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, n_convs string, depth string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "mine", "mine") for r in rows], SCHEMA)


def paths(rows, rebuild):
    """The turns of every conversation, in order."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in turns.items()}
    if not rebuild:
        return own
    taken = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    # the remainder has the sign of the id, as in SQL
    base = {c: int(c / 100) * 100 for c in own}
    return {c: own.get(base[c], [])[: taken[c]] + p[taken[c] :] for c, p in own.items()}


def nodes(found):
    members, ends = defaultdict(list), defaultdict(list)
    for conv, path in found.items():
        ends[tuple(path)].append(conv)
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(conv)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1]) if path else 0
    return sorted(
        (
            min(convs),
            len(path),
            min(members[path[:-1]]) if path else None,
            len(convs),
            children[path],
            leaves[path],
            saved[path],
            hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest(),
        )
        for path, convs in members.items()
    )


def built(df, rebuild, **options):
    placed = trie.numbered(df)
    turns = trie.with_shared_heads(placed) if rebuild else trie.as_they_are(placed)
    return sorted(map(tuple, trie.prefix_trie(turns, **options).collect()))


def conversations(seed):
    """Few different turns, so that paths share much; one conversation of many blocks, one that repeats it."""
    draw = random.Random(seed)
    rows = []
    for conv in [*range(-3, 40), 100, 101, 150, 207, 300]:
        for turn in range(draw.randint(1, 9)):
            rows.append((conv, turn, draw.choice(["user", None]), draw.choice(["a", "bb", "é漢", None])))
    for conv in (60, 61):
        rows += [(conv, turn, "user", f"turn {turn % 7}") for turn in range(75 + conv)]
    return rows


@pytest.mark.parametrize("rebuild", [False, True])
def test_against_brute_force(spark, rebuild):
    rows = conversations(7)
    assert built(frame(spark, rows), rebuild) == nodes(paths(rows, rebuild))


def test_blocks_stretches_and_hot_parents(spark, monkeypatch):
    """The same trie from narrow blocks, short stretches and with every parent or none broadcast."""
    rows = conversations(8)
    want = nodes(paths(rows, True))
    monkeypatch.setattr(trie, "STRETCH", 3)
    monkeypatch.setattr(trie, "PIECE", 12)
    for hot_share in (1, 10**9):
        assert built(frame(spark, rows), True, width=2, hot_share=hot_share) == want


def test_nulls_ties_and_empty(spark):
    rows = [
        (7, None, None, None),
        (7, 3, "user", ""),
        (7, 3, "user", ""),
        (None, 1, "user", "of no conversation"),
        (8, None, "", ""),
        (8, 1, "user", ""),
        (9, 5, "user", "x" * 300_000),
    ]
    found = built(frame(spark, rows), False)
    assert found == nodes(paths(rows, False))
    # 7 and 8 share two turns; a null text is an empty one and repeated rows are turns of their own
    assert [(r[0], r[1], r[3]) for r in found if r[0] == 7] == [(7, 0, 3), (7, 1, 2), (7, 2, 2), (7, 3, 1)]
    assert built(frame(spark, []), False) == [] and built(frame(spark, []), True) == []


def test_equal_turns_do_not_depend_on_the_order_of_rows(spark):
    rows = [(1, 4, "user", text) for text in ("one", "two", "three")]
    first = built(frame(spark, rows), False)
    assert first == built(frame(spark, rows[::-1]), False) and len(first) == 4


def test_turnless_conversations_end_in_the_root(spark):
    # conversations without a base whose own turns are all replaced
    gone = [c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 >= 2][:5]
    rows = [(c, t, "user", "a") for c in gone for t in range(2)]
    found = built(frame(spark, rows), True)
    want = hashlib.sha256(",".join(map(str, gone)).encode()).hexdigest()
    assert found == [(min(gone), 0, None, 5, 0, 1, 0, want)]


def test_running_totals(spark):
    """One key with most rows over many ranges, null keys, totals and exclusive ors."""
    draw = np.random.default_rng(1)
    keys = [1] * 600 + [2, 3, 3] + [None] * 40 + list(range(10, 60))
    rows = [(k, i, int(draw.integers(0, 100)), int(draw.integers(-(2**62), 2**62))) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "k int, i int, v bigint, x bigint").repartition(5)
    totals = {"v": "before", "x": "mixed"}
    found = running.with_running(df, ["k"], ["i"], totals, xor=("x",))
    assert found.columns == ["k", "i", "v", "x", "before", "mixed"]
    sums, xors, want = Counter(), Counter(), []
    for k, i, v, x in rows:
        want.append((i, sums[k], xors[k]))
        sums[k] += v
        xors[k] ^= x
    assert sorted((r.i, r.before, r.mixed) for r in found.collect()) == want
