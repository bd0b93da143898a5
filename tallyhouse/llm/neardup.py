"""Near duplicates by a multi-index Hamming join over b-bit MinHash signatures.

The set of a document is its distinct shingles of ``SHINGLE`` words. Its signature has
``POSITIONS`` minima of ``2**BITS`` values each; the distance of two signatures is the number
of positions in which they differ. Documents at the required similarity differ in the rest of
the positions on average (15 % at 85), and in more than ``max_distance`` about once in 10**5 pairs.

*Pigeonhole.* The positions are split into more than half as many chunks as ``max_distance``,
so signatures within it have a chunk with at most one error. *Enumeration.* Each
chunk is indexed once for each of its positions with that position left out; signatures that
agree in one of these keys meet in a group, so no pair within the distance is missed.
*Distance.* The signatures of a group are compared and only those within ``max_distance`` are
linked; equal groups of several chunks are compared once, large ones in blocks spread over tasks.

Equal sets are joined first (one row for any number of copies). Signatures linked by their distance
form families; within a family all full sets are compared, in blocks, and the tasks return a
spanning forest of the true links. No pairs of a group are emitted.

Documents without words have an empty set and are linked with nothing. A null id takes part;
a component is named by the smallest id in it. Repeated rows are copies of each other. Texts of
any length are read whole, a slice of a batch at a time; an empty table gives an empty result.
Only the id and the text of ``docs`` are read, so other columns may have any name.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .components import components
from .frames import map_arrow, ship
from .text import SOLID, Words, mix, slices, window_hashes

SHINGLE = 5
POSITIONS = 128
BITS = 8
#: Share of the pairs at the required similarity that may differ in more positions than looked for.
MISSED = 1 / 40_000
#: Keys of a bucket of the index, about.
BUCKET_KEYS = 2_000_000
#: Signatures of one side of a comparison in one task, and members of a group that are compared pair by pair.
SIGNATURES = 16_384
SHORT = 16
#: Rows, and shingles, of one side of a comparison in one task.
BLOCK = 1000
BLOCK_SHINGLES = 1_000_000
_RNG = np.random.default_rng(85)
_MULTIPLIERS = _RNG.integers(0, 2**31, POSITIONS).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_SALTS = _RNG.integers(0, 2**63, 2, dtype=np.uint64)


def max_distance(percent: int) -> int:
    """Positions in which signatures at ``percent`` similarity differ at most, but for MISSED (37 at 85)."""
    p, above = percent / 100, 1.0
    for k in range(POSITIONS):
        above -= math.comb(POSITIONS, k) * (1 - p) ** k * p ** (POSITIONS - k)
        if above <= MISSED:
            return k
    return POSITIONS


def chunk_cuts(percent: int) -> np.ndarray:
    """The bounds of the chunks: one of them has at most one error (19 chunks at 85)."""
    return np.linspace(0, POSITIONS, max_distance(percent) // 2 + 2).astype(int)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, grouped by text, and the n + 1 offsets."""
    words = Words(texts, SOLID)
    hashes = words.hashes()
    at = words.windows(SHINGLE)
    found, text = window_hashes(hashes, at, SHINGLE), np.searchsorted(words.first, at, "right") - 1
    for size in range(1, SHINGLE):  # a shorter text is one shingle
        short = np.flatnonzero(words.counts == size)
        found = np.r_[found, window_hashes(hashes, words.first[short], size)]
        text = np.r_[text, short]
    order = np.lexsort((found, text))
    found, text = found[order], text[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    found, text = found[new], text[new]
    return found, np.searchsorted(text, np.arange(len(texts) + 1))


def signatures(found: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The b-bit minima of the sets that begin at ``starts`` (none is empty)."""
    base = (found >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), POSITIONS), np.uint8)
    for k, multiplier in enumerate(_MULTIPLIERS):
        least = np.minimum.reduceat(base * multiplier, starts)
        least ^= least >> np.uint32(16)
        out[:, k] = (least * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)
    return out


def _describe(text_col: str):
    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                found, cuts = shingle_sets(part.column(text_col))
                sizes = np.diff(cuts)
                full = np.flatnonzero(sizes)
                names = np.zeros((len(sizes), 2), np.uint64)
                rows: list = [None] * len(sizes)
                if len(full):
                    for k in range(2):
                        names[full, k] = np.add.reduceat(mix(found ^ _SALTS[k]), cuts[:-1][full])
                    packed = signatures(found, cuts[:-1][full])
                    for i, row in zip(full.tolist(), packed):
                        rows[i] = row.tobytes()
                keys = [names[i].tobytes() if sizes[i] else None for i in range(len(sizes))]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("row"),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(keys, pa.binary()),
                        pa.array(rows, pa.binary()),
                    ],
                    ["id", "row", "n_shingles", "cls", "signature"],
                )

    return run


def _index_keys(splits: int, cuts: np.ndarray):
    """Messages of (class, keys) to the buckets of the keys.

    All keys of a chunk go to one bucket, or to ``splits`` of them by hash, so a class has at
    most one entry in the forest of each chunk and split, whatever the number of tasks.
    """
    chunks = len(cuts) - 1

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sig = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint8).reshape(n, POSITIONS)
            values = mix(sig.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.arange(POSITIONS, dtype=np.uint64))
            keys = np.empty((n, POSITIONS), np.uint64)
            for a, b in zip(cuts[:-1], cuts[1:]):
                whole = values[:, a:b].sum(axis=1, dtype=np.uint64)
                for k in range(a, b):  # the chunk without position k
                    keys[:, k] = mix(whole - values[:, k] + np.uint64(k))
            flat = keys.ravel()
            owner = np.repeat(np.arange(n), POSITIONS)
            chunk = np.tile(np.repeat(np.arange(chunks), np.diff(cuts)), n)
            target = chunk * splits + ((flat >> np.uint64(20)) % np.uint64(splits)).astype(np.int64)
            order = np.lexsort((owner, target))
            flat, owner, target = flat[order], owner[order], target[order]
            ends = np.searchsorted(target, np.arange(chunks * splits + 1))
            names = batch.column("cls").to_pylist()
            out = []
            for bucket in np.unique(target).tolist():
                own = owner[ends[bucket] : ends[bucket + 1]]
                who, count = np.unique(own, return_counts=True)
                out.append(
                    (
                        bucket,
                        b"".join([names[i] for i in who.tolist()]),
                        count.astype(np.uint8).tobytes(),
                        flat[ends[bucket] : ends[bucket + 1]].tobytes(),
                    )
                )
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                ["target", "classes", "counts", "keys"],
            )

    return run


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable node of each of n nodes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _edges(names: list[bytes], label: np.ndarray) -> pa.Table:
    child = np.flatnonzero(label != np.arange(len(label)))
    return pa.table(
        {
            "a": pa.array([names[i] for i in child.tolist()], pa.binary()),
            "b": pa.array([names[i] for i in label[child].tolist()], pa.binary()),
        }
    )


def _agreeing(table: pa.Table) -> pa.Table:
    """The groups of classes that agree in keys of a bucket; equal groups of other buckets get the same number."""
    names = b"".join(table["classes"].to_pylist())
    codes = np.frombuffer(names, np.uint64).reshape(-1, 2)
    counts = np.concatenate([np.frombuffer(x, np.uint8) for x in table["counts"].to_pylist()])
    keys = np.concatenate([np.frombuffer(x, np.uint64) for x in table["keys"].to_pylist()])
    owner = np.repeat(np.arange(len(codes)), counts)
    order = np.argsort(keys)
    keys, owner = keys[order], owner[order]
    same = np.flatnonzero(keys[1:] == keys[:-1])
    label = _forest(owner[same], owner[same + 1], len(codes))
    number = np.zeros(len(codes), np.uint64)
    np.add.at(number, label, mix(codes[:, 0] ^ (codes[:, 1] << np.uint64(1))))
    size = np.bincount(label, minlength=len(codes))
    member = np.flatnonzero(size[label] > 1)
    return pa.table(
        {
            "grp": pa.array(number[label[member]].view(np.int64)),
            "size": pa.array(size[label[member]].astype(np.int64)),
            "cls": pa.array([names[16 * i : 16 * i + 16] for i in member.tolist()], pa.binary()),
        }
    )


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions in which the rows of two matrices of signatures differ (``a`` may be one row)."""
    lanes = (a != b).view(np.uint64).sum(axis=1, dtype=np.uint64)  # bytes of 16 at most
    return (lanes * np.uint64(0x0101010101010101)) >> np.uint64(56)


def _spread(found: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within the distance that connect all that are connected: each row is held against those not yet reached."""
    left, a, b = np.arange(len(found)), [], []
    own = found
    while len(left):
        reached, left, own = [int(left[0])], left[1:], own[1:]
        while reached and len(left):
            pivot = reached.pop()
            near = distances(found[pivot : pivot + 1], own) <= limit
            if near.any():
                a += [pivot] * int(near.sum())
                b += left[near].tolist()
                reached += left[near].tolist()
                left, own = left[~near], own[~near]
    return np.array(a, np.int64), np.array(b, np.int64)


def close_pairs(group: np.ndarray, found: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one group (``group`` ascends) within the distance, enough to connect all such pairs."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[starts, len(group)])
    short = np.repeat(sizes <= SHORT, sizes)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for step in range(1, SHORT):
        first = np.flatnonzero((group[step:] == group[:-step]) & short[step:])
        for part in np.array_split(first, len(first) // 100_000 + 1):
            near = part[distances(found[part], found[part + step]) <= limit]
            a.append(near)
            b.append(near + step)
    for start, size in zip(starts[sizes > SHORT].tolist(), sizes[sizes > SHORT].tolist()):
        one, other = _spread(found[start : start + size], limit)
        a.append(one + start)
        b.append(other + start)
    return np.concatenate(a), np.concatenate(b)


def _hamming(limit: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("grp")
        found = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint8).reshape(-1, POSITIONS)
        a, b = close_pairs(table["grp"].to_numpy(), found, limit)
        return _edges(table["cls"].to_pylist(), _forest(a, b, len(found)))

    return run


def links_of(table: pa.Table, tenths: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a, b) of rows with 100 * intersection >= tenths * union, enough to connect all.

    Intersections are products of 0/1 rows over the shingles that occur twice or more; a
    shingle of one row counts in its size only.
    """
    found, cuts = shingle_sets(table["_text"].combine_chunks())
    sizes = np.diff(cuts)
    values, column, times = np.unique(found, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times > 1)
    place = np.full(len(values), -1)
    place[shared] = np.arange(len(shared))
    row, column = np.repeat(np.arange(len(sizes)), sizes), place[column]
    row, column = row[column >= 0], column[column >= 0]
    n = len(sizes)
    both = np.zeros((n, n), np.float32)
    for start in range(0, len(shared), 4096):
        own = (column >= start) & (column < start + 4096)
        flags = np.zeros((n, min(4096, len(shared) - start)), np.float32)
        flags[row[own], column[own] - start] = 1
        both += flags @ flags.T
    both = np.rint(both).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - both
    a, b = np.nonzero(np.triu(100 * both >= tenths * union, 1))
    return a, b


def _verify(percent: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("cls")
        names = table["cls"].to_pylist()
        first = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]]
        names = [names[i] for i in first]
        a, b = links_of(table.take(pa.array(first)), percent)
        return _edges(names, _forest(a, b, len(names)))

    return run


def families(signed: DataFrame, percent: int = 85) -> DataFrame:
    """``node`` and ``root`` of the classes (``cls``, ``signature``) that links within ``max_distance`` connect.

    A class without such a link is in no row. The members of a group meet in one task up to
    ``SIGNATURES`` of them, larger groups as pairs of blocks.
    """
    cuts = chunk_cuts(percent)
    chunks = len(cuts) - 1
    splits = math.ceil((signed.count() + 1) * POSITIONS / chunks / BUCKET_KEYS)
    sent = map_arrow(signed, _index_keys(splits, cuts), "target int, classes binary, counts binary, keys binary")
    groups = sent.groupBy("target").applyInArrow(_agreeing, "grp bigint, size bigint, cls binary")
    blocks = F.ceil(F.col("size") / SIGNATURES).cast("int")
    members = groups.distinct().join(signed, "cls").withColumn("blocks", blocks)
    members = members.withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.when(F.col("blocks") > 1, F.col("grp")).otherwise(F.pmod("grp", F.lit(chunks * splits))).alias("unit"),
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "grp",
        "cls",
        "signature",
    )
    limit = max_distance(percent)
    return components(members.groupBy("unit", "i", "j").applyInArrow(_hamming(limit), "a binary, b binary"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85
) -> DataFrame:
    """For each row ``id``, ``row`` (hash of its text), ``n_shingles``, ``component_id``, ``kept``."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("row"), docs[text_col].alias("_text"))
    path = scratch_path(spark, "signatures")
    fields = f"id {docs.schema[id_col].dataType.simpleString()}, row bigint, n_shingles bigint, cls binary, signature binary"
    map_arrow(rows, _describe("_text"), fields).write.parquet(path)
    described = spark.read.parquet(path)

    classes = described.where("cls IS NOT NULL").groupBy("cls")
    signed = classes.agg(F.first("signature").alias("signature"))
    named = classes.agg(
        F.min(F.struct(F.col("id"), F.col("row"))).alias("one"), F.min("id").alias("least"), F.max("n_shingles").alias("n")
    )
    family = families(signed, percent)

    # rows of one family are compared in blocks: every pair of blocks meets in one task
    wanted = family.join(named.select(F.col("cls").alias("node"), "one.id", "one.row", "n"), "node")
    blocks = F.ceil(F.greatest(F.count("*") / F.lit(BLOCK), F.sum("n") / F.lit(BLOCK_SHINGLES)))
    wanted = wanted.join(wanted.groupBy("root").agg(blocks.cast("int").alias("blocks")), "root")
    wanted = wanted.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    wanted = wanted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.col("node").alias("cls"),
        "root",
        "id",
        "row",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
    )
    texts = rows.alias("d").join(
        wanted.alias("w"), (F.col("d.row") == F.col("w.row")) & F.col("d.id").eqNullSafe(F.col("w.id"))
    )
    texts = texts.select("w.root", "w.i", "w.j", "w.cls", "d._text")
    linked = components(texts.groupBy("root", "i", "j").applyInArrow(_verify(percent), "a binary, b binary"))

    group = named.join(linked.withColumnRenamed("node", "cls"), "cls", "left")
    group = group.select("cls", "least", F.coalesce("root", "cls").alias("root"))
    least = group.groupBy("root").agg(F.min("least").alias("component"))
    group = group.join(least, "root").select("cls", "component")
    out = described.select("id", "row", "n_shingles", "cls").join(group, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select("id", "row", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("id").eqNullSafe(F.col("component_id"))
    )
