"""Connected components as DataFrame passes (alternating large-star and small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, release


#: A node is heavy that has at least so many edges, and at least this share of all: at most 2 * SHARE nodes are.
HEAVY, SHARE = 1000, 10_000


def _with_least(edges: DataFrame, total: int, done: list[DataFrame]) -> DataFrame:
    """(u, v, m) for every edge; m is the least v of its u. done: gets the tables that the result reads.

    The minimum is combined before the shuffle. Edges of heavy nodes don't meet in one task: the heavy nodes' minima,
    a table whose size HEAVY and SHARE bound, go to where the edges are.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    if total < HEAVY:
        return edges.join(least.drop("n"), "u")
    least = materialise(least, "least")
    done.append(least)
    heavy = F.broadcast(least.where(F.col("n") >= max(HEAVY, total // SHARE)).select("u", "m"))
    light = edges.join(heavy.select("u"), "u", "left_anti").join(least.where(F.col("n") < max(HEAVY, total // SHARE)).select("u", "m"), "u")
    return light.unionByName(edges.join(heavy, "u").select("u", "v", "m"))


def connected_components(edges: DataFrame, u: str = "u", v: str = "v", most: int = 60) -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node it reaches.

    Edges that are null at either end, loops and repeated edges count for nothing. Nodes may be of any orderable
    type. Only sets of edges move. Each round is written to the shared folder; release() of the result deletes the last.
    """

    def stats(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % F.lit(1 << 31))).first())

    pairs = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"), (F.col(u).isNotNull() & F.col(v).isNotNull() & (F.col(u) != F.col(v))).alias("ok"))
    now = materialise(pairs.where("ok").select("u", "v").distinct(), "edges")
    seen = stats(now)
    for _ in range(most):
        if not seen[0]:
            break
        done = [now]
        both = _with_least(now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v"))), 2 * seen[0], done)
        large = materialise(both.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), "large")
        done.append(large)
        small = _with_least(large, seen[0], done)
        # every node's edge to its least, and its other neighbours' edges to that
        after = materialise(small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct(), "edges")
        for table in done:
            release(table)
        was, now, seen = seen, after, stats(after)
        if was == seen:
            break
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    out = now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    out.shared_path = now.shared_path
    return out
