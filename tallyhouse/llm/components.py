"""Connected components of a graph given as rows, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import scratch_path


#: Neighbours from which a node is hot, and hot nodes at most.
HOT = 1000
HOT_NODES = 1000


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _with_smallest(own: DataFrame, hot: int) -> DataFrame:
    """Each edge (u, v) with m, the smallest of u and its neighbours.

    The smallest are stored, so the plan of the edges is in this one's plan once or twice. The
    answers of nodes with more than ``hot`` neighbours are broadcast, so their edges stay
    where they are; the others meet theirs in a join.
    """
    seen = Observation()
    smallest = own.groupBy("u").agg(F.least(F.min("v"), "u").alias("m"), F.count("*").alias("n"))
    smallest = _stored(smallest.observe(seen, F.count_if(F.col("n") > hot).alias("hot")), "smallest")
    if not seen.get["hot"]:
        return own.join(smallest.drop("n"), "u")
    few = F.broadcast(smallest.where(F.col("n") > hot).drop("n"))
    rest = own.join(few.select("u"), "u", "left_anti").join(smallest.where(F.col("n") <= hot).drop("n"), "u")
    return own.join(few, "u").unionByName(rest)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for every node of edges ``a``, ``b``.

    Every step groups with a combine before the shuffle. A node with more than ``HOT`` neighbours, and
    more than a share of all edges that lets ``HOT_NODES`` have them, is looked up in a broadcast. Each
    star is stored in the shared folder, so plans stay small (the driver keeps and compiles them) and
    lost executors recompute at most one star.
    """
    # stored once: what finds the edges would run again for each use of them
    state = _stored(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u != v"), "edges")
    # a step has two rows for an edge of the state, and no step adds edges
    hot, before = max(HOT, 2 * state.count() // HOT_NODES), None
    while True:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_smallest(both, hot).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = _stored(large.where("u != v").distinct(), "large")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        small = _with_smallest(down, hot)
        rewired = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))
        )
        seen = Observation()
        hashes = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        rewired = rewired.where("u != v").distinct().observe(seen, F.count("*").alias("n"), hashes.alias("hashes"))
        state = _stored(rewired, "components")
        mark = seen.get
        if before == mark:
            roots = state.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
        before = mark
