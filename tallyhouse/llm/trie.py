"""Prefix trie of conversations: one node for every distinct sequence of first turns.

A turn is named by a 128-bit digest of role and text, and a conversation becomes rows of ``WIDTH``
positional turn columns: its first turns, then the next ones, and so on. One ``ROLLUP`` over these columns
gives all prefixes that end in a block at once, ``grouping_id`` tells how long each is. Blocks
after the first are grouped by the node that the block before ends in; that node is named by the exclusive or
of the position-bound digests of the turns so far, so that blocks of all depths are rolled
up together, however long a conversation is.

Sums over subtrees need no walk over the trie. A node belongs to the smallest conversation that passes it;
what a conversation owns is the end of its path. So the sum over a subtree is the
sum of all that its members own (a second ``ROLLUP``), less what the node's owner owns above it (a
running total along its path).

* Text is read once, for the digests. What moves afterwards is about 40 bytes a turn, and
  every group is combined before the shuffle: a first turn or a whole conversation that a third of all
  conversations share is a row for each task.
* One conversation with a third of all turns: places and paths are running totals over ranges
  (:mod:`.running`), and facts of a conversation are joined to its rows by stretches of ``STRETCH`` rows.
* Nodes look up their parent's owner; parents of more than a thousandth of all nodes (a thousand at most)
  are broadcast, so none is a hot key.
* The ids of conversations that end in a node are packed into pieces where they are sorted, and hashed
  piece by piece as a stream; no group is ever held whole.

Null role or text counts as empty; turns are ordered by turn, null first, equal ones by their
digest, so repeated rows are turns of their own. Rows without a conversation id belong to none and are left
out. Very long texts only meet the digest. An empty table has no nodes. Other columns
of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .frames import map_arrow
from .running import with_place, with_running

#: turns of a block
WIDTH = 8
#: rows of one conversation that are joined to its facts under one key
STRETCH = 4096
#: a parent is broadcast when more than one of so many nodes is its child
HOT_SHARE = 1000
#: bytes of a piece of ids
PIECE = 1 << 20


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def numbered(conversations: DataFrame, conv_col: str = "conv_id", order_col: str = "turn") -> DataFrame:
    """``conv``, ``at`` (place from 0) and the digest ``a``, ``b`` and ``chars`` (of the text) of every turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    mark = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(order_col).alias("turn"),
        F.conv(F.substring(mark, 1, 16), 16, -10).cast("long").alias("a"),
        F.conv(F.substring(mark, 17, 16), 16, -10).cast("long").alias("b"),
        F.length(text).cast("long").alias("chars"),
    )
    # stored, as the sort looks at its rows twice
    return with_place(_stored(rows, "turns"), ["conv"], ["turn", "a", "b"], "at").drop("turn")


def with_facts(rows: DataFrame, facts: DataFrame, place: str, last: str) -> DataFrame:
    """Join facts of a conversation (one row of ``conv``) to its rows, ``STRETCH`` places under one key.

    ``last`` is the largest ``place`` of the conversation's rows.
    """
    stretches = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"{last} div {STRETCH}"))).alias("_stretch")
    each = facts.select("*", stretches)
    return rows.withColumn("_stretch", F.expr(f"{place} div {STRETCH}")).join(each, ["conv", "_stretch"]).drop("_stretch")


def as_they_are(placed: DataFrame) -> DataFrame:
    """Numbered turns as rows of :func:`prefix_trie`."""
    sizes = placed.groupBy("conv").agg((F.max("at") + 1).alias("n_turns"), F.max("at").alias("_last"))
    return with_facts(placed, sizes, "at", "_last").drop("_last")


def with_shared_heads(placed: DataFrame, every: int = 100, most: int = 5) -> DataFrame:
    """Conversations that begin with turns of the first of their hundred, as rows of :func:`prefix_trie`.

    Of conversation c the first h turns are those of c - c % ``every`` (all if fewer, none if it is absent; the
    remainder has the sign of c), where h is the crc32 of c's decimal text modulo ``most`` + 1; its own follow from the h-th on. A
    conversation that is left without turns is one row whose ``at`` is null.
    """
    taken = F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)
    turn = F.struct("at", "a", "b", "chars")
    # at most five turns of one conversation in a hundred
    heads = (
        placed.where((F.col("conv") % every == 0) & (F.col("at") < most))
        .groupBy("conv")
        .agg(F.sort_array(F.collect_list(turn)).alias("head"))
        .withColumnRenamed("conv", "_base")
    )
    sizes = placed.groupBy("conv").agg(F.max("at").alias("_last")).withColumn("_taken", taken)
    base = F.col("conv") - F.col("conv") % every
    head = F.slice(F.coalesce("head", F.array().cast("array<struct<at: bigint, a: bigint, b: bigint, chars: bigint>>")), F.lit(1), F.col("_taken").cast("int"))
    facts = sizes.join(heads, base == F.col("_base"), "left").select("conv", "_last", "_taken", head.alias("head"))
    rest = F.greatest(F.col("_last") + 1 - F.col("_taken"), F.lit(0))
    n_turns = F.size("head") + rest
    facts = _stored(facts.withColumn("n_turns", n_turns), "conversations")

    own = with_facts(placed, facts.select("conv", "_last", "_taken", "n_turns", F.size("head").alias("_given")), "at", "_last")
    own = own.where(F.col("at") >= F.col("_taken")).withColumn("at", F.col("at") - F.col("_taken") + F.col("_given"))
    columns = ["conv", "at", "a", "b", "chars", "n_turns"]
    given = facts.select("conv", "n_turns", F.inline("head"))
    none = facts.where("n_turns = 0").select("conv", *(F.lit(None).cast("long").alias(c) for c in columns[1:5]), "n_turns")
    return own.select(*columns).unionByName(given.select(*columns)).unionByName(none)


def _term(a: Column, b: Column, place: Column) -> tuple[Column, Column]:
    """A turn at its place, as the two numbers that name the path it ends."""
    return F.xxhash64(a, b, place), F.xxhash64(place, b, a)


def _blocks(turns: DataFrame, width: int) -> DataFrame:
    """``conv``, ``block``, ``n_turns``, the turn columns ``t0``.. and ``pa``, ``pb``: the node that the block before ends in, ``ea``, ``eb``: the one that this ends in."""
    placed = turns.withColumn("block", F.coalesce(F.expr(f"at div {width}"), F.lit(0)))
    one, other = _term(F.col("a"), F.col("b"), F.col("at"))
    turn = F.when(F.col("at").isNotNull(), F.struct("at", "a", "b", "chars"))
    there = F.col("at").isNotNull()
    rows = placed.groupBy("conv", "block").agg(
        F.max("n_turns").alias("n_turns"),
        F.sort_array(F.collect_list(turn)).alias("turns"),
        F.coalesce(F.bit_xor(F.when(there, one)), F.lit(0)).alias("xa"),
        F.coalesce(F.bit_xor(F.when(there, other)), F.lit(0)).alias("xb"),
    )
    rows = _stored(rows, "blocks")
    rows = with_running(rows, ["conv"], ["block"], {"xa": "pa", "xb": "pb"}, xor=("xa", "xb"))
    columns = [F.get("turns", F.lit(i)) for i in range(width)]
    slim = [F.when(t.isNotNull(), F.struct(t["a"].alias("a"), t["b"].alias("b"), t["chars"].alias("chars"))) for t in columns]
    ends = (F.col("pa").bitwiseXOR(F.col("xa")).alias("ea"), F.col("pb").bitwiseXOR(F.col("xb")).alias("eb"))
    names = [t.alias(f"t{i}") for i, t in enumerate(slim)]
    return _stored(rows.select("conv", "block", "n_turns", *names, "pa", "pb", *ends), "blocks")


def _rolled_up(blocks: DataFrame, width: int, measures: str) -> DataFrame:
    """All prefixes of blocks with their measures: ``depth``, ``ka``, ``kb`` (the node), ``qa``, ``qb`` (its parent) and ``chars``."""
    turns = [f"t{i}" for i in range(width)]
    rolled = blocks.sparkSession.sql(
        f"""
        SELECT block, pa, pb, {", ".join(turns)}, grouping_id() AS rolled, {measures}
        FROM {{blocks}}
        GROUP BY block, pa, pb, ROLLUP({", ".join(turns)})
        """,
        blocks=blocks,
    )
    level = F.lit(width) - F.bit_count("rolled")
    rolled = rolled.withColumn("level", level)
    # a prefix longer than its conversations is none, and later blocks begin below a node of the block before
    real = F.when(F.col("level") == 0, F.col("block") == 0)
    for i, turn in enumerate(turns):
        real = real.when(F.col("level") == i + 1, F.col(turn).isNotNull())
    rolled = rolled.where(real)
    keys = {"ka": F.col("pa"), "kb": F.col("pb")}
    parents = dict(keys)
    chars = F.lit(0).cast("long")
    for i, turn in enumerate(turns):
        t = F.col(turn)
        terms = _term(t["a"], t["b"], F.col("block") * width + i)
        for (own, above), term in zip((("ka", "qa"), ("kb", "qb")), terms):
            parents[own] = parents[own].bitwiseXOR(F.when(F.col("level") > i + 1, term).otherwise(F.lit(0)))
            keys[own] = keys[own].bitwiseXOR(F.when(F.col("level") > i, term).otherwise(F.lit(0)))
        chars = F.when(F.col("level") == i + 1, t["chars"]).otherwise(chars)
    return rolled.select(
        (F.col("block") * width + F.col("level")).alias("depth"),
        *(column.alias(name) for name, column in keys.items()),
        parents["ka"].alias("qa"),
        parents["kb"].alias("qb"),
        chars.alias("chars"),
        *(m.rsplit(" ", 1)[1] for m in measures.split(", ")),
    )


def _owners_of_parents(nodes: DataFrame, hot_share: int) -> DataFrame:
    """``owner``, ``depth`` and ``parent``, the owner of the node above, where that is another conversation."""
    bound = max(nodes.count() // hot_share, 1)
    first = nodes.where((F.col("above") == 0) & (F.col("depth") > 0)).select(
        "owner", "depth", (F.col("depth") - 1).alias("_d"), F.col("qa").alias("_a"), F.col("qb").alias("_b")
    )
    with_children = nodes.where("n_children > 0").select(
        F.col("depth").alias("_d"), F.col("ka").alias("_a"), F.col("kb").alias("_b"), F.col("owner").alias("parent"), "n_children"
    )
    hot, others = (with_children.where(c).drop("n_children") for c in (F.col("n_children") > bound, F.col("n_children") <= bound))
    # every node has one parent, so no more than hot_share of them have so many children
    marked = first.join(F.broadcast(hot), ["_d", "_a", "_b"], "left")
    cold = marked.where(F.col("parent").isNull()).drop("parent").join(others, ["_d", "_a", "_b"])
    found = marked.where(F.col("parent").isNotNull()).unionByName(cold)
    return found.select("owner", "depth", "parent")


_KEY = ["depth", "ka", "kb"]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pack sorted ids into one row for each node and at most PIECE bytes."""
    key, first, ids, size = None, None, [], 0
    done: list[tuple] = []

    def batch():
        columns = list(zip(*done))
        done.clear()
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4])], names=[*_KEY, "first", "ids"]
        )

    held = 0
    for part in batches:
        for *node, conv in zip(*(part.column(c).to_pylist() for c in [*_KEY, "conv"])):
            if node != key or size >= PIECE:
                if ids:
                    done.append((*key, first, ",".join(ids)))
                    held += size + 40
                    if held >= PIECE:
                        yield batch()
                        held = 0
                key, first, ids, size = node, conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
    if ids:
        done.append((*key, first, ",".join(ids)))
    if done:
        yield batch()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each node, which come in order."""
    key, state, done = None, None, []

    def batch():
        columns = list(zip(*done))
        done.clear()
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3])], names=[*_KEY, "ends"])

    for part in batches:
        for *node, ids in zip(*(part.column(c).to_pylist() for c in [*_KEY, "ids"])):
            if node == key:
                state.update(b",")
            else:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = node, hashlib.sha256()
            state.update(ids.encode())
        if len(done) >= 10_000:
            yield batch()
    if key is not None:
        done.append((*key, state.hexdigest()))
    if done:
        yield batch()


def _ends(blocks: DataFrame, width: int) -> DataFrame:
    """``ends``, the hash of the ids of conversations that end in a node, for nodes where any does."""
    last = F.greatest(F.expr(f"(n_turns - 1) div {width}"), F.lit(0))
    ending = blocks.where(F.col("block") == last).select(
        F.col("n_turns").cast("long").alias("depth"), F.col("ea").alias("ka"), F.col("eb").alias("kb"), "conv"
    )
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*_KEY, "conv"]
    ordered = ending.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    kinds = ", ".join(f"{k} bigint" for k in _KEY)
    pieces = map_arrow(ordered, _pieces, f"{kinds}, first bigint, ids string")
    joined = pieces.repartition(parts, *_KEY).sortWithinPartitions(*_KEY, "first")
    return map_arrow(joined, _hashes, f"{kinds}, ends string")


def prefix_trie(turns: DataFrame, width: int = WIDTH, hot_share: int = HOT_SHARE) -> DataFrame:
    """The nodes of the trie over rows ``conv``, ``at``, ``a``, ``b``, ``chars``, ``n_turns``.

    ``conv_id`` (the smallest member) and ``depth`` name a node. ``parent_conv_id``, ``n_convs`` (members),
    ``n_children``, ``n_leaves`` (childless nodes in its subtree), ``saved_tokens`` (over the subtree: members less
    one times the code points of the last text) and ``ends_sha256`` (of the ids that end here).
    """
    blocks = _blocks(turns, width)
    nodes = _stored(_rolled_up(blocks, width, "min(conv) AS owner, count(*) AS n_convs"), "nodes")
    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("qa").alias("ka"), F.col("qb").alias("kb")
    ).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = nodes.withColumn("saves", (F.col("n_convs") - 1) * F.col("chars")).withColumn("one", F.lit(1).cast("long"))
    nodes = _stored(nodes, "nodes")
    # along the path that a conversation owns
    nodes = with_running(nodes, ["owner"], ["depth"], {"saves": "saved_above", "one": "above"})

    owned = nodes.groupBy("owner").agg(
        F.sum("saves").alias("owned"), F.sum(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaf")
    )
    last = blocks.groupBy("conv").agg(F.max("block").alias("_last"))
    # a conversation owns nothing where all its nodes are passed by a smaller one
    facts = last.join(owned.withColumnRenamed("owner", "conv"), "conv", "left").fillna(0, ["owned", "leaf"])
    weighed = with_facts(blocks, facts, "block", "_last")
    sums = _rolled_up(weighed, width, "min(conv) AS owner, sum(owned) AS owned, sum(leaf) AS n_leaves")

    sums = sums.select("owner", "depth", "owned", "n_leaves")
    found = nodes.join(sums, ["owner", "depth"])
    found = found.join(_owners_of_parents(nodes, hot_share), ["owner", "depth"], "left")
    found = found.join(_ends(blocks, width), _KEY, "left")
    own_parent = F.when(F.col("above") > 0, F.col("owner"))
    return found.select(
        F.col("owner").alias("conv_id"),
        F.col("depth").cast("long").alias("depth"),
        F.coalesce("parent", own_parent).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.col("n_leaves").cast("long").alias("n_leaves"),
        (F.col("owned") - F.col("saved_above")).cast("long").alias("saved_tokens"),
        F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
