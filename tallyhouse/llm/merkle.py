"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf, leaves stand in order within their group, and 16 consecutive nodes become their
parent until one node is left; the groups' last nodes form a tree of the same kind up to the root.
Nodes are labelled by (level, group, place), children before parents. The priority queue is an
external one: a table of messages in the shared folder, each a child's digest under the label of its
parent. A step of the sweep takes all messages of the smallest level out of it, Spark's shuffle
brings those of one label together in the order of their senders (16 at most), and the digests of
the parents are the messages of the next level. A reversed sweep from the root down sends each run
the steps of the proof above it; runs of leaves work out the proofs of their leaves.

* The text is read once and hashed there; afterwards only digests move. A level is a sixteenth of
  the one below, so the first one costs nearly everything, and the number of steps is the
  logarithm of the largest group. A label has at most 16 messages, so a group with a third of all
  rows is dealt out like any other.
* The places of leaves come from a sort by range (:mod:`.running`), never from one task.
* Every level is stored before the next one reads it.

Leaves of one group are ordered by id, null first, equal ids by their digest; so equal rows
are neighbours and have proofs of their own. A null in a hashed column counts as ``-``; a null
group is a group. An empty or very long text is hashed like any other. An empty table gives no rows.
Only the named columns are read, so other columns may be called anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .running import with_place

ARITY = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(*parts: Column) -> Column:
    """SHA-256 of parts, as bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def hex_text(value: Column) -> Column:
    return F.lower(F.hex(value))


def field(value: Column) -> Column:
    """Length in bytes, colon, value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def tampered_text(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def is_tampered(id_column: Column) -> Column:
    """Rows that the check of the manifest alters: 5 divides crc32 of the id as text."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def leaves(docs: DataFrame, id_col: str, group_col: str, text_col: str, columns: tuple[str, ...]) -> DataFrame:
    """``id``, ``grp``, ``leaf`` and, where the row is tampered with, the digest ``altered``."""

    def leaf(alter: bool) -> Column:
        return digest(*(field(tampered_text(docs[c]) if alter and c == text_col else docs[c]) for c in columns))

    altered = F.when(is_tampered(docs[id_col]) & docs[text_col].isNotNull(), leaf(True))
    return docs.select(
        docs[id_col].alias("id"), docs[group_col].alias("grp"), leaf(False).alias("leaf"), altered.alias("altered")
    )


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _deliver(messages: DataFrame) -> DataFrame:
    """Take one level out of the queue: each label (group, run) with its messages in sender order."""
    label = ["grp", F.expr(f"place div {ARITY}").alias("run")]
    senders = F.sort_array(F.collect_list(F.struct("place", *[c for c in messages.columns if c not in ("grp", "place")])))
    return messages.groupBy(*label).agg(senders.alias("members"))


def sweep_up(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The runs of every level, lowest first, and ``grp``, ``top`` of every group.

    ``messages``: ``grp``, ``place``, ``digest`` and further columns. A run 0 of one member is a group
    that has come to its last node.
    """
    levels, tops = [], []
    queue = messages
    done = (F.col("run") == 0) & (F.size("members") == 1)
    while True:
        runs = _stored(_deliver(queue), "merkle-runs")
        levels.append(runs)
        tops.append(runs.where(done).select("grp", F.get("members", F.lit(0))["digest"].alias("top")))
        joined = F.concat_ws("", F.transform("members", lambda m: hex_text(m["digest"])))
        queue = runs.where(~done).select("grp", F.col("run").alias("place"), digest(joined).alias("digest"))
        if queue.isEmpty():
            break
    ends = tops[0]
    for top in tops[1:]:
        ends = ends.unionByName(top)
    return levels, ends


def _others(at: Column) -> Column:
    """The members of a run to the left and to the right of one of them, as bytes."""

    def joined(part: Column) -> Column:
        return F.unhex(F.array_join(F.transform(part, lambda m: F.hex(m["digest"])), ""))

    before = F.slice("members", F.lit(1), at)
    after = F.slice("members", at + 2, F.lit(ARITY))
    return F.struct(joined(before).alias("before"), joined(after).alias("after"))


def _members(runs: DataFrame, *kept: str) -> DataFrame:
    """Every member of runs that know the steps above them, with its own steps."""
    each = runs.select("*", F.posexplode("members").alias("_at", "member"))
    # a last node has no siblings and no step of its own
    alone = (F.col("run") == 0) & (F.size("members") == 1)
    own = F.when(alone, F.slice(F.array(_others(F.col("_at"))), 1, 0)).otherwise(F.array(_others(F.col("_at"))))
    return each.select("grp", "member", F.concat(own, F.col("steps")).alias("steps"), *kept)


def sweep_down(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """``grp``, ``member``, ``steps`` (lowest first) and the columns of ``above`` for each member of the lowest level.

    ``above``: ``grp``, ``steps`` from the group's last node on, and further columns.
    """
    kept = [c for c in above.columns if c not in ("grp", "steps")]
    to_top = above.withColumnRenamed("grp", "_grp")
    messages = None
    for level in range(len(levels) - 1, -1, -1):
        runs = levels[level]
        columns = [F.col(c) for c in (*runs.columns, "steps", *kept)]
        alone = (F.col("run") == 0) & (F.size("members") == 1)
        known = runs.where(alone).join(to_top, F.col("grp").eqNullSafe(F.col("_grp"))).select(*columns)
        if messages is not None:
            addressed = F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("run") == F.col("_to"))
            known = known.unionByName(runs.where(~alone).join(messages, addressed).select(*columns))
        reached = _members(known, *kept)
        if level:
            sent = reached.select(F.col("grp").alias("_grp"), F.col("member")["place"].alias("_to"), "steps", *kept)
            messages = _stored(sent, "merkle-steps")
    return reached


def fold(start: Column, steps: Column) -> Column:
    """The root that a digest and the steps of its proof lead to."""
    one = lambda acc, s: digest(hex_text(F.concat(s["before"], acc, s["after"])))
    return F.aggregate(steps, start, one)


def proof_of(steps: Column) -> Column:
    """Hash of all siblings, level by level."""
    siblings = F.transform(steps, lambda s: F.concat(hex_text(s["before"]), hex_text(s["after"])))
    return F.sha2(F.array_join(siblings, ""), 256)


def manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "source",
    text_col: str = "text",
    columns: tuple[str, ...] = COLUMNS,
) -> DataFrame:
    """``id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` (digests in hex) and ``verified``.

    Proofs are checked against rows whose text was lower-cased where 5 divides the crc32 of the id.
    """
    # stored, as the sort looks at its rows twice
    found = _stored(leaves(docs, id_col, group_col, text_col, columns), "leaves")
    placed = with_place(found, ["grp"], ["id", "leaf"], "place")
    levels, subroots = sweep_up(placed.select("grp", "place", F.col("leaf").alias("digest"), "id", "altered"))
    # the groups' last nodes are the leaves of one more tree
    listed = with_place(subroots.withColumn("_all", F.lit(0)), ["_all"], ["grp"], "place")
    listed = listed.select(F.lit(0).alias("grp"), "place", F.col("top").alias("digest"), F.col("grp").alias("own"))
    upper, roots = sweep_up(listed)
    above = roots.select("grp", F.col("top").alias("root"), F.array().cast("array<struct<before: binary, after: binary>>").alias("steps"))
    spread = sweep_down(upper, above)
    groups = spread.select(F.col("member")["own"].alias("grp"), "steps", "root", F.col("member")["digest"].alias("subroot"))
    found = sweep_down(levels, _stored(groups, "merkle-groups"))
    member = F.col("member")
    folded = fold(F.coalesce(member["altered"], member["digest"]), F.col("steps"))
    return found.select(
        member["id"].alias("id"),
        hex_text(member["digest"]).alias("leaf"),
        hex_text(F.col("subroot")).alias("subroot"),
        hex_text(F.col("root")).alias("root"),
        proof_of(F.col("steps")).alias("proof_sha256"),
        hex_text(folded).alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )
